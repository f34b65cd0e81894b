from decimal import Decimal

from tidemark.operators import reconcile as rc

ROWS = "order_id bigint, customer_id bigint, status string, amount decimal(18,2), updated_ms bigint"


def df(spark, rows):
    return spark.createDataFrame(rows, ROWS)


def test_parity(spark, spec):
    t = df(spark, [(1, 1, "PAID", Decimal("1.00"), 5), (2, None, None, None, None)])
    s = rc.summary(rc.compare(t, t, spec)).first()
    assert s["verdict"] == "parity" and s["drift"] == 0 and s["rows_source"] == 2


def test_classes_and_drift(spark, spec):
    truth = df(spark, [(1, 1, "PAID", Decimal("10.00"), 5), (2, 1, "NEW", Decimal("5.00"), 5),
                       (3, 1, "NEW", Decimal("7.00"), 5)])
    lake = df(spark, [(1, 1, "SHIPPED", Decimal("10.00"), 5), (3, 1, "NEW", Decimal("4.50"), 5),
                      (4, 1, "NEW", Decimal("-2.00"), 5), (4, 1, "NEW", Decimal("-2.00"), 5)])
    keys = {r["order_id"]: (r["class"], r["drift"]) for r in rc.compare(truth, lake, spec).collect()}
    assert keys == {1: ("mismatch", Decimal("0.00")), 2: ("missing", Decimal("5.00")),
                    3: ("mismatch", Decimal("2.50")), 4: ("extra", Decimal("2.00"))}
    s = rc.summary(rc.compare(truth, lake, spec)).first()
    assert (s["missing"], s["extra"], s["mismatch"], s["duplicate_in_lake"]) == (1, 1, 2, 1)
    assert s["rows_lake"] == 3 and s["drift"] == Decimal("9.50") and s["verdict"] == "drift"


def test_status_only_mismatch_fails_with_zero_drift(spark, spec):
    t = df(spark, [(1, 1, "PAID", Decimal("1.00"), 5)])
    lake = df(spark, [(1, 1, "NEW", Decimal("1.00"), 5)])
    s = rc.summary(rc.compare(t, lake, spec)).first()
    assert s["verdict"] == "drift" and s["mismatch"] == 1 and s["drift"] == 0


def test_samples_are_first_keys_per_class(spark, spec):
    truth = df(spark, [(k, 1, "A", Decimal(k), 1) for k in range(20)])
    keys = rc.compare(truth, df(spark, []), spec)
    got = [r["order_id"] for r in rc.samples(keys, spec, 5).orderBy("rn").collect()]
    assert got == [0, 1, 2, 3, 4]
