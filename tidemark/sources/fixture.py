"""A change log derived from the ``orders`` table, row-locally, with no global sort.

Every order key gets an insert (v=0), three updates (v=1..3) and, for every seventh key, a delete
(v=4). Each event has a unique LSN. Its arrival ``slot`` is its position pushed forward by a
bounded pseudo-random delay, and every 50th position is delivered twice, so the log is
out-of-order and at-least-once the way a change topic is. Arrival order is ``(slot, pos, dup)``.
Because every column is a closed-form function of one ``orders`` row, the log grows with the table
and the same SQL reproduces it in any engine (see ``plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..spec import LSN, ORDER_STATUSES, TableSpec, orders_spec

# Fixed values of the fixture log.
UPDATES_PER_KEY = 3
DELETE_EVERY = 7
EVENTS_PER_KEY = 5  # position stride: insert, three updates, optional delete
DELAY_MULT = 48271
DELAY_ADD = 12345
DELAY_MOD = 2147483647
DISORDER = 600
REDELIVER_EVERY = 50
TS_BASE_MS = 1_650_000_000_000
TS_STEP_MS = 1000
BATCH_SPAN = 500
DELIVERY_ORDERINGS = 3

ARRIVAL = ("slot", "pos", "dup")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_changelog(spark: SparkSession, sf_dir: str, spec: TableSpec | None = None) -> DataFrame:
    """Delivered change log over ``orders``: one row per delivered event, already decoded.

    Columns: the spec columns (null except the key for deletes), ``op`` (c/u/d), ``_lsn``,
    ``ts_ms`` and the arrival coordinates ``slot``, ``pos``, ``dup``.
    """
    spec = spec or orders_spec()
    key = F.col("order_id")
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("bigint").alias("order_id"),
        F.col("o_custkey").cast("bigint").alias("_cust"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("_base"),
    )
    all_versions = F.array(*[F.lit(v) for v in range(UPDATES_PER_KEY + 2)])
    kept_versions = F.array(*[F.lit(v) for v in range(UPDATES_PER_KEY + 1)])
    versions = orders.select(
        "*", F.explode(F.when(key % DELETE_EVERY == 0, all_versions).otherwise(kept_versions)).alias("_v")
    )
    v = F.col("_v")
    pos = key * EVENTS_PER_KEY + v
    is_delete = v == UPDATES_PER_KEY + 1
    lsn = pos + 1
    ts_ms = F.lit(TS_BASE_MS) + lsn * TS_STEP_MS
    statuses = F.array(*[F.lit(s) for s in ORDER_STATUSES])
    live = lambda c: F.when(~is_delete, c)  # noqa: E731 - deletes carry only the key
    events = versions.select(
        key.alias("order_id"),
        live(F.col("_cust")).alias("customer_id"),
        live(F.element_at(statuses, ((key + v) % len(ORDER_STATUSES) + 1).cast("int"))).alias("status"),
        live((F.col("_base") + v.cast("decimal(18,2)")).cast("decimal(18,2)")).alias("amount"),
        live(ts_ms).alias("updated_ms"),
        F.when(v == 0, F.lit("c")).when(is_delete, F.lit("d")).otherwise(F.lit("u")).alias("op"),
        lsn.alias(LSN),
        ts_ms.alias("ts_ms"),
        (pos + ((pos * DELAY_MULT + DELAY_ADD) % DELAY_MOD) % (DISORDER + 1)).alias("slot"),
        pos.alias("pos"),
    )
    redelivered = F.when(F.col("pos") % REDELIVER_EVERY == 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))
    return events.select("*", F.explode(redelivered).alias("dup"))


def with_batch(changes: DataFrame, span: int = BATCH_SPAN, slot: str = "slot") -> DataFrame:
    """Micro-batch id of each delivered event: consecutive arrival slots of width ``span``."""
    return changes.withColumn("batch", F.floor(F.col(slot) / F.lit(span)).cast("bigint"))


def canonical_log(changes: DataFrame) -> DataFrame:
    """Each event exactly once (the source's own log, before redelivery)."""
    return changes.where(F.col("dup") == 0)


def reorderings(changes: DataFrame, n: int) -> DataFrame:
    """The same delivered events under ``n`` delivery orders, tagged ``ordering`` 0..n-1.

    Ordering 0 is the log as delivered; ordering i > 0 re-draws each event's forward delay with
    another multiplier, and odd orderings also reverse the arrival of redelivered copies.
    """
    tag = F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("ordering")
    tagged = changes.select("*", tag)
    i = F.col("ordering").cast("bigint")
    pos = F.col("pos")
    delay = ((pos * (DELAY_MULT + i * 2) + DELAY_ADD + i) % DELAY_MOD) % (DISORDER + 1)
    slot = F.when(i == 0, F.col("slot")).otherwise(pos + delay)
    dup = F.when(i % 2 == 1, 1 - F.col("dup")).otherwise(F.col("dup"))
    return tagged.withColumn("slot", slot).withColumn("dup", dup)
