import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidemark.session import local_session  # noqa: E402
from tidemark.spec import orders_spec  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = local_session(shuffle_partitions=8)
    yield s


@pytest.fixture(scope="session")
def spec():
    return orders_spec()


def envelope(op, lsn, key=1, amount="10.00", status="PAID", before=None, ts_ms=None, source_ts=None,
             after=True):
    """One change envelope as a JSON line."""
    image = {"order_id": key, "customer_id": 7, "status": status, "amount": amount, "updated_ms": lsn}
    env = {"op": op, "before": before, "after": image if (after and op != "d") else None,
           "ts_ms": lsn if ts_ms is None else ts_ms,
           "source": {"table": "orders", "lsn": lsn, "ts_ms": lsn if source_ts is None else source_ts}}
    if op == "d" and before is None:
        env["before"] = {"order_id": key}
    return json.dumps(env)


def lines_df(spark, lines, with_seq=True):
    rows = [(line, i) for i, line in enumerate(lines)]
    return spark.createDataFrame(rows, "value string, _seq bigint")
