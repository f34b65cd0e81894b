"""DataFrame helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path
from tidemark.streaming import fs

_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def importable(spark: SparkSession) -> None:
    """Let Python workers started from now on import this package from where the driver has it, as they
    must when it is run from a checkout that is not on their path. An installed package needs nothing."""
    environment = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    have = environment.get("PYTHONPATH", "")
    if root not in have.split(os.pathsep):
        environment["PYTHONPATH"] = f"{root}{os.pathsep}{have}" if have else root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage, survives lost executors, and gives
    later joins a plain scan on either side, whose skewed partitions Spark can split."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    written = _written.get()
    if written is not None:
        written.append(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def passing_tables(spark: SparkSession) -> Iterator[list[str]]:
    """Lists the paths that ``stored`` writes inside, oldest first, and deletes on leaving those that are still
    listed. For a step whose result is written by then and taken off the list; nothing lazy may still read the others."""
    paths: list[str] = []
    token = _written.set(paths)
    try:
        yield paths
    finally:
        _written.reset(token)
        for path in paths:
            fs.remove(spark, path)


def clash_free(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra columns of any name cannot clash with an operator's own."""
    importable(df.sparkSession)
    return df.select(*[F.col(f"`{c}`") for c in columns])


def hashed_sample(df: DataFrame, limit: int, *columns: str) -> DataFrame:
    """At most ``limit`` rows of ``df``, those with the least hash of ``columns``: the same at any
    partitioning. Rows are counted first and thinned by their hash, so that what the tasks hand to the
    one that takes the least is about four times the sample and not the sample times their number."""
    thin = max(1, df.count() // (4 * limit))
    key = F.xxhash64(*columns)
    # Thinning keeps the low end of the hash range, which the least hashes are in.
    edge = -(1 << 63) + ((1 << 64) // thin) - 1
    return df.where(key <= F.lit(edge)).orderBy(key, *columns).limit(limit)


def hashed_values(values: DataFrame, limit: int) -> DataFrame:
    """At most ``limit`` distinct values of a one-column table, those with the least hash. Distinct values are counted by a
    sketch and thinned by their hash before they are made distinct, so only some four times the sample is shuffled,
    however often a value repeats. Thinning that left too few, should the sketch be far off, is undone."""
    (name,) = values.columns
    key = F.xxhash64(name)
    thin = max(1, values.agg(F.approx_count_distinct(name)).first()[0] // (4 * limit))
    edge = -(1 << 63) + ((1 << 64) // thin) - 1
    few = stored(values.where(key <= F.lit(edge)).distinct(), "sampled-values")
    if thin > 1 and few.count() < limit:
        few = values.distinct()
    return few.orderBy(key, name).limit(limit)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once: a lambda's variable, which the optimizer never copies
    into the places of its use, as it may do with a column."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected edge list of longs: rows ``(node, component)``, where
    ``component`` is the smallest node reachable. Nodes without an edge do not appear.

    Alternating large-star and small-star (Kiveris et al., 2014): every round re-hangs each node on
    the smallest neighbour, which at least halves path lengths, until the edge list is a set of
    stars. Each half-round stores the per-node minimum, an aggregate with map-side combine; the join
    back then has two plain scans below it, so the rows of a hub are split by adaptive execution.
    """
    star = stored(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "cc-edges")
    if star.isEmpty():
        return star.select(F.col("u").alias("node"), F.col("v").alias("component"))
    before = None
    for _ in range(max_rounds):
        # Large star: neighbours above u move to the smallest neighbour of u.
        both = star.union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-min")
        star = stored(
            both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(),
            "cc-large")
        # Small star: u and its neighbours below it move to the smallest of them.
        least = stored(star.groupBy("u").agg(F.min("v").alias("m")), "cc-min")
        moved = star.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        star = stored(moved.union(least).distinct(), "cc-small")
        now = star.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return star.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
