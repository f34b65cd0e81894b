"""Running maxima over chunks of chunks, against a plain loop."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changelog as cl
from tidemark.operators import counters as co
from tidemark.operators.ordered import chunk_at, chunk_of, prior_max


def plain(rows, strictly=False):
    out = []
    for k, o, v in rows:
        out.append((k, o, v, max((b for a, p, b in rows if a == k and (p < o)), default=None)))
    return out


@pytest.mark.parametrize("levels", [1, 2, 3, 4])
def test_levels_agree(spark, levels):
    rng = random.Random(levels)
    rows = [(0 if rng.random() < 0.5 else rng.randrange(1, 6), o, rng.randrange(1000)) for o in range(400)]
    df = spark.createDataFrame(rows, "k long, o long, v long")
    out = prior_max(df, ["k"], ["o"], F.col("v"), "before", chunk_of("o", 2), levels=levels, fan=3)
    assert sorted(map(tuple, out.select("k", "o", "v", "before").collect())) == sorted(plain(rows))
    strict = prior_max(df, ["k"], ["o"], F.col("v"), "before", chunk_of("o", 2), strictly_lower=True, levels=levels, fan=3)
    assert sorted(map(tuple, strict.select("k", "o", "v", "before").collect())) == sorted(plain(rows))


def test_levels_with_tagged_chunks(spark, spec):
    """Partition and offset: chunks of a hot key go by partition, then offset, in three levels."""
    rng = random.Random(7)
    rows = [(1, p, o, rng.randrange(500)) for p in range(3) for o in range(60)]
    df = spark.createDataFrame(rows, "order_id long, partition int, offset long, _lsn long")
    out = prior_max(df, ["order_id"], ("partition", "offset"), F.col("_lsn"), "before",
                    chunk_at(("partition", "offset"), "offset", 2), levels=3, fan=4)
    best, want = None, {}
    for k, p, o, v in rows:
        want[p, o] = best
        best = v if best is None else max(best, v)
    assert {(r["partition"], r["offset"]): r["before"] for r in out.collect()} == want


def test_applied_flags_in_tiny_chunks(spark, spec):
    rng = random.Random(3)
    events = [(rng.randrange(3), i, rng.randrange(200)) for i in range(300)]
    df = spark.createDataFrame(events, "order_id long, seq long, _lsn long")
    flags = co.applied_flags(df, spec, ("seq",), chunk_span=1)
    marks, applied = {}, 0
    for k, _, lsn in events:
        if lsn > marks.get(k, -1):
            marks[k], applied = lsn, applied + 1
    assert flags.where("applied").count() == applied


def test_prior_images_shuffle_the_rows_once(spark, spec):
    """An image comes with the running maximum; no join over all rows fetches it."""
    log = spark.range(40).select(
        F.floor(F.col("id") / 8).alias("order_id"), F.lit(1).cast("long").alias("customer_id"), F.lit("NEW").alias("status"),
        F.col("id").cast("decimal(18,2)").alias("amount"), F.col("id").alias("updated_ms"),
        F.when(F.col("id") % 8 == 5, "d").otherwise("u").alias("op"), F.col("id").alias("_lsn"))
    log = log.unionByName(log.where("_lsn % 3 = 0"))
    for span in (1, 3, 1 << 20):
        imaged = cl.with_before_images(log, spec, chunk_span=span)
        assert imaged.count() == log.count()
        for r in imaged.collect():
            none = r["_lsn"] % 8 in (0, 6)  # the first change of a key, and the one after its delete
            assert r["before_updated_ms"] == (None if none else r["_lsn"] - 1)
    plan = imaged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") <= 1
