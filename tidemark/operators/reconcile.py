"""Reconciliation: does the lake table equal the source truth, key by key, and what is the drift
worth?

One full outer join on the key classifies every key as match, missing (in truth, not in lake),
extra (in lake, not in truth) or mismatch (in both, some spec column differs; ``_lsn`` is not
compared). Columns are compared in canonical form -- decimals at their scale, half-even; ints as
BIGINT; the rest as text; null equals null. Drift is ``abs(source - lake)`` of the value column
with an absent side or null value counting as 0, summed exactly in decimal.

Both sides reach the join already hash-partitioned by key (the truth is a fold, the lake is
grouped to count duplicate keys), so the join adds no shuffle of its own. Only the one-row
summary and bounded samples ever reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import canonical
from ..spec import TableSpec

# Key classes and verdicts.
MATCH = "match"
MISSING = "missing"
EXTRA = "extra"
MISMATCH = "mismatch"
DRIFT_CLASSES = (MISSING, EXTRA, MISMATCH)
PARITY = "parity"
DRIFT = "drift"
DRIFT_TYPE = "decimal(38,2)"
SAMPLE_TEXT = 5
SAMPLE_JSON = 50


def canonical_rows(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows projected onto the spec in comparison form (extra columns such as ``_lsn`` dropped)."""
    return rows.select(*[canonical(F.col(c.name), c).alias(c.name) for c in spec.columns])


def _image(spec: TableSpec) -> F.Column:
    return F.struct(*[canonical(F.col(c.name), c).alias(c.name) for c in spec.columns
                      if c.name != spec.key])


def _value(spec: TableSpec, image: str) -> F.Column:
    if spec.value_column is None:
        return F.lit(0).cast(DRIFT_TYPE)
    return F.col(f"{image}.{spec.value_column}").cast(DRIFT_TYPE)


def compare(truth: DataFrame, lake: DataFrame, spec: TableSpec) -> DataFrame:
    """Per key: ``key, class, drift, source_value, lake_value, lake_copies``.

    A key the lake holds more than once is compared copy by copy (through the least and greatest
    copy): it matches only if every copy equals the truth.
    """
    key = spec.key
    src = truth.select(key, _image(spec).alias("_s"), F.lit(True).alias("_in_src"))
    lk = lake.groupBy(key).agg(
        F.count(F.lit(1)).alias("lake_copies"),
        F.min(_image(spec)).alias("_lo"),
        F.max(_image(spec)).alias("_hi"))
    both = src.join(lk, key, "full_outer")
    differs = F.lit(False)
    for n in spec.value_names:
        for side in ("_lo", "_hi"):
            differs = differs | ~F.col(f"_s.{n}").eqNullSafe(F.col(f"{side}.{n}"))
    in_src = F.col("_in_src").isNotNull()
    in_lake = F.col("lake_copies").isNotNull()
    cls = (F.when(in_src & ~in_lake, F.lit(MISSING))
           .when(~in_src & in_lake, F.lit(EXTRA))
           .when(differs, F.lit(MISMATCH))
           .otherwise(F.lit(MATCH)))
    s_val, l_val = _value(spec, "_s"), _value(spec, "_hi")
    drift = F.abs(F.coalesce(s_val, F.lit(0)) - F.coalesce(l_val, F.lit(0))).cast(DRIFT_TYPE)
    return both.select(key, cls.alias("class"), drift.alias("drift"),
                       s_val.alias("source_value"), l_val.alias("lake_value"),
                       F.coalesce(F.col("lake_copies"), F.lit(0)).alias("lake_copies"))


def summary(keys: DataFrame) -> DataFrame:
    """One row: rows_source, rows_lake, missing, extra, mismatch, duplicate_in_lake, drift,
    verdict ('parity' iff no key is missing, extra or mismatched; drift does not decide)."""
    cls = F.col("class")
    agg = keys.agg(
        F.count_if(cls != EXTRA).alias("rows_source"),
        F.count_if(cls != MISSING).alias("rows_lake"),
        F.count_if(cls == MISSING).alias("missing"),
        F.count_if(cls == EXTRA).alias("extra"),
        F.count_if(cls == MISMATCH).alias("mismatch"),
        F.count_if(F.col("lake_copies") > 1).alias("duplicate_in_lake"),
        F.coalesce(F.sum("drift"), F.lit(0)).cast(DRIFT_TYPE).alias("drift"))
    ok = (F.col("missing") + F.col("extra") + F.col("mismatch")) == 0
    return agg.withColumn("verdict", F.when(ok, F.lit(PARITY)).otherwise(F.lit(DRIFT)))


def drift_by_class(keys: DataFrame) -> DataFrame:
    return keys.groupBy("class").agg(
        F.count(F.lit(1)).alias("keys"), F.sum("drift").cast(DRIFT_TYPE).alias("drift"))


def samples(keys: DataFrame, spec: TableSpec, n: int = SAMPLE_TEXT) -> DataFrame:
    """First ``n`` keys of each drift class, by key. ``row_number() <= n`` lets Catalyst keep
    only the top ``n`` per class inside each task before the shuffle, so a class holding most
    keys never lands whole in one task."""
    w = Window.partitionBy("class").orderBy(spec.key)
    ranked = keys.where(F.col("class") != MATCH).select(
        "class", spec.key, F.row_number().over(w).alias("rn"))
    return ranked.where(F.col("rn") <= n)


# Key groups whose digests are compared before any row is.
DIGEST_GROUPS = 1 << 16


def digests(rows: DataFrame, spec: TableSpec, groups: int = DIGEST_GROUPS) -> DataFrame:
    """Per key group: ``group, rows`` and two digests of its canonical rows that do not depend on their
    order (a sum and an exclusive or of different row hashes)."""
    image = [canonical(F.col(c.name), c) for c in spec.columns]
    return rows.groupBy(group_of(spec, groups).alias("group")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(*image).cast("decimal(38,0)")).alias("sum"),
        F.bit_xor(F.xxhash64(F.lit(spec.name), *image)).alias("xor"))


def group_of(spec: TableSpec, groups: int) -> F.Column:
    return F.pmod(F.xxhash64(canonical(F.col(spec.key), spec.column(spec.key))), F.lit(groups)).cast("int")


def differing(truth: DataFrame, lake: DataFrame, spec: TableSpec, groups: int = DIGEST_GROUPS) -> DataFrame:
    """Per key group of either side: ``group, rows`` and whether the sides differ in it. Equal digests and
    counts mean that the lake holds every key of the truth once, with its row, and no other."""
    ours, theirs = digests(truth, spec, groups).alias("s"), digests(lake, spec, groups).alias("l")
    same = F.col("s.rows").eqNullSafe(F.col("l.rows")) & F.col("s.sum").eqNullSafe(F.col("l.sum")) & F.col(
        "s.xor").eqNullSafe(F.col("l.xor"))
    return ours.join(theirs, "group", "full_outer").select("group", F.coalesce("s.rows", "l.rows").alias("rows"), (~same).alias("differs"))


def summary_by_digest(truth: DataFrame, lake: DataFrame, spec: TableSpec, groups: int = DIGEST_GROUPS) -> DataFrame:
    """The same row as ``summary(compare(truth, lake))``. Only groups with different digests are compared
    key by key, so tables in parity are read once and none of their rows is shuffled by this operator."""
    group = differing(truth, lake, spec, groups).persist()
    try:
        equal = group.agg(F.sum(F.when(~F.col("differs"), F.col("rows"))), F.count_if("differs")).first()  # one row
        numbers = [r["group"] for r in group.where("differs").select("group").collect()]  # at most ``groups``
    finally:
        group.unpersist()
    if numbers:
        other = truth.sparkSession.createDataFrame([(n,) for n in numbers], "group int")

        def part(rows: DataFrame) -> DataFrame:
            return rows.withColumn("group", group_of(spec, groups)).join(F.broadcast(other), "group", "left_semi").drop("group")

        found = summary(compare(part(truth), part(lake), spec))
    else:
        empty = truth.sparkSession.createDataFrame([], spec.row_schema())
        found = summary(compare(empty, empty, spec))
    same = F.lit(equal[0] or 0).cast("bigint")
    return found.withColumns({"rows_source": F.col("rows_source") + same, "rows_lake": F.col("rows_lake") + same})
