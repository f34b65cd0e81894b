import json

import pytest

from conftest import envelope, lines_df
from tidemark.operators import decode as dc


def decode_rows(spark, spec, lines):
    return dc.decode(lines_df(spark, lines), spec, keep=("_seq",)).orderBy("_seq").collect()


def test_insert_and_delete_images(spark, spec):
    ins, dele = decode_rows(spark, spec, [envelope("c", 5, key=7), envelope("d", 9, key=7)])
    assert (ins["op"], ins["order_id"], ins["_lsn"], ins["_reject"]) == ("u", 7, 5, "ok")
    assert (dele["op"], dele["order_id"], dele["_lsn"]) == ("d", 7, 9)
    assert dele["amount"] is None and dele["status"] is None  # after is dropped for deletes


def test_delete_ignores_sent_after_image(spark, spec):
    env = json.loads(envelope("d", 3, key=4))
    env["after"] = {"order_id": 99, "amount": "5.00"}
    (row,) = decode_rows(spark, spec, [json.dumps(env)])
    assert row["order_id"] == 4 and row["amount"] is None


def test_quoted_lsn_and_half_even(spark, spec):
    env = json.loads(envelope("u", 5, amount="12.345"))
    env["source"]["lsn"] = "5"
    (row,) = decode_rows(spark, spec, [json.dumps(env)])
    assert row["_lsn"] == 5 and str(row["amount"]) == "12.34"
    (row2,) = decode_rows(spark, spec, [envelope("u", 6, amount="12.355")])
    assert str(row2["amount"]) == "12.36"


def test_event_time_fallback(spark, spec):
    rows = decode_rows(spark, spec, [envelope("u", 5, ts_ms=0, source_ts=7),
                                     envelope("u", 6, ts_ms=11, source_ts=7),
                                     envelope("u", 8, ts_ms=0, source_ts=0)])
    assert [r["ts_ms"] for r in rows] == [7, 11, 0]


def test_wrapped_payload(spark, spec):
    wrapped = '{"schema":{"type":"struct"},"payload":' + envelope("r", 4, key=3) + "}"
    (row,) = decode_rows(spark, spec, [wrapped])
    assert (row["_reject"], row["op"], row["order_id"], row["_lsn"]) == ("ok", "u", 3, 4)


@pytest.mark.parametrize("line,reason", [
    ("not json", "bad_json"),
    (envelope("x", 1), "unknown_op"),
    (json.dumps({"op": "c", "after": {"order_id": 1}, "source": {}}), "bad_lsn"),
    (json.dumps({"op": "c", "after": {"order_id": 1}, "source": {"lsn": "abc"}}), "bad_lsn"),
    (json.dumps({"op": "c", "after": None, "source": {"lsn": 1}}), "no_image"),
    (json.dumps({"op": "c", "after": {"order_id": None, "amount": "1"}, "source": {"lsn": 1}}), "no_key"),
    (json.dumps({"op": "c", "after": {"amount": "1"}, "source": {"lsn": 1}}), "no_key"),
    (envelope("u", 3, amount="abc"), "bad_value"),
    ("   ", "skipped"),
    (None, "skipped"),
])
def test_reject_reasons(spark, spec, line, reason):
    (row,) = decode_rows(spark, spec, [line])
    assert row["_reject"] == reason


def test_strict_mode_fails_the_job(spark, spec):
    decoded = dc.decode(lines_df(spark, [envelope("c", 1), envelope("x", 2)]), spec)
    with pytest.raises(Exception, match="rejected change event"):
        dc.accepted(decoded, "strict").collect()
    assert dc.accepted(decoded, "quarantine").count() == 1
    assert [r["_reject"] for r in dc.rejected(decoded).collect()] == ["unknown_op"]
    with pytest.raises(ValueError):
        dc.accepted(decoded, "lenient")


def test_timestamp_column_from_epoch_ms(spark):
    from tidemark.spec import Column, TableSpec
    spec = TableSpec("events", "id", (Column("id", "int"), Column("at", "ts")))
    line = json.dumps({"op": "c", "after": {"id": 1, "at": 1700000000123}, "source": {"lsn": 3}})
    (row,) = dc.decode(lines_df(spark, [line]), spec).collect()
    assert row["_reject"] == "ok" and str(row["at"]) == "2023-11-14 22:13:20.123000"
    bad = json.dumps({"op": "c", "after": {"id": 1, "at": "soon"}, "source": {"lsn": 3}})
    (row,) = dc.decode(lines_df(spark, [bad]), spec).collect()
    assert row["_reject"] == "bad_value"
