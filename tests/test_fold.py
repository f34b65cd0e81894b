from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators import counters as co
from tidemark.operators import fold as fo

SCHEMA = "order_id bigint, customer_id bigint, status string, amount decimal(18,2), " \
         "updated_ms bigint, op string, _lsn bigint, seq bigint"


def changes(spark, events):
    """events: (key, lsn, op, amount) in arrival order."""
    rows = [(k, 1, "PAID", None if op == "d" else Decimal(str(amt)), lsn, op, lsn, i)
            for i, (k, lsn, op, amt) in enumerate(events)]
    return spark.createDataFrame(rows, SCHEMA)


def live(spark, spec, events, mode="lsn"):
    df = fo.fold_live(changes(spark, events), spec, mode, ("seq",))
    return {r["order_id"]: str(r["amount"]) for r in df.collect()}


def test_out_of_order_last_writer_wins(spark, spec):
    for order in ([(1, 10, "u", 10), (1, 20, "u", 99)], [(1, 20, "u", 99), (1, 10, "u", 10)]):
        assert live(spark, spec, order) == {1: "99.00"}


def test_duplicates_are_idempotent_and_counted(spark, spec):
    df = changes(spark, [(1, 5, "u", 42)] * 3)
    assert live(spark, spec, [(1, 5, "u", 42)] * 3) == {1: "42.00"}
    stats = co.merge_stats(co.applied_flags(df, spec, ("seq",))).first()
    assert (stats["seen"], stats["applied"], stats["ignored"]) == (3, 1, 2)


def test_delete_not_resurrected_by_late_update(spark, spec):
    assert live(spark, spec, [(1, 30, "d", None), (1, 20, "u", 5)]) == {}


def test_reinsert_after_delete(spark, spec):
    assert live(spark, spec, [(1, 30, "d", None), (1, 40, "c", 7)]) == {1: "7.00"}


def test_lsn_tie_first_arrival_stays(spark, spec):
    assert live(spark, spec, [(1, 5, "u", 1), (1, 5, "u", 2)]) == {1: "1.00"}


def test_tombstone_kept_in_state(spark, spec):
    state = fo.fold_state(changes(spark, [(1, 30, "d", None)]), spec, "lsn", ("seq",)).collect()
    assert [(r["order_id"], r["_lsn"], r["_deleted"]) for r in state] == [(1, 30, True)]


def test_arrival_mode_diverges_and_bad_mode(spark, spec):
    assert live(spark, spec, [(1, 20, "u", 99), (1, 10, "u", 10)], mode="arrival") == {1: "10.00"}
    with pytest.raises(ValueError):
        fo.fold_state(changes(spark, [(1, 1, "u", 1)]), spec, "nope", ("seq",))


CANON = [(k, k * 10 + v, "d" if v == 3 and k % 3 == 0 else ("c" if v == 0 else "u"), k * 100 + v)
         for k in range(1, 9) for v in range(4 if k % 3 == 0 else 3)]
TRUTH = {k: f"{k * 100 + 2}.00" for k in range(1, 9) if k % 3 != 0}


@settings(max_examples=6, deadline=None)
@given(st.permutations(CANON), st.lists(st.integers(0, len(CANON) - 1), max_size=6))
def test_any_delivery_order_with_duplicates_folds_to_truth(spark, spec, order, dups):
    delivered = list(order) + [order[i] for i in dups]
    assert live(spark, spec, delivered) == TRUTH


def test_applied_flags_match_sequential_fold(spark, spec):
    events = [(1, 3, "u", 1), (1, 1, "u", 1), (2, 2, "u", 1), (1, 5, "d", None), (1, 4, "u", 1),
              (2, 2, "u", 1), (2, 9, "u", 1)]
    flags = co.applied_flags(changes(spark, events), spec, ("seq",)).orderBy("seq").collect()
    hw, expected = {}, []
    for k, lsn, _, _ in events:
        expected.append(k not in hw or lsn > hw[k])
        hw[k] = max(hw.get(k, lsn), lsn)
    assert [r["applied"] for r in flags] == expected


def test_hot_key_spans_chunks(spark, spec):
    """One key across many arrival chunks: chunked running max equals the sequential one."""
    events = [(1, (i * 7919) % 503, "u", i) for i in range(300)]
    df = changes(spark, events)
    flags = co.applied_flags(df, spec, ("seq",), chunk_span=16).orderBy("seq").collect()
    best, expected = None, []
    for _, lsn, _, _ in events:
        expected.append(best is None or lsn > best)
        best = lsn if best is None else max(best, lsn)
    assert [r["applied"] for r in flags] == expected
