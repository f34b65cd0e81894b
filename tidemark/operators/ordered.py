"""Skew-safe running maxima within a group ("what was the largest value before this row?").

A plain ``max(...).over(partitionBy(key).orderBy(order).rowsBetween(unboundedPreceding, -1))``
puts every row of a key into one task; a key holding a third of the stream would then hold a
third of the data in one sort. Instead the ordered axis is cut into chunks:

1. ``max(value)`` per ``(key, chunk)`` -- a hash aggregate with map-side combine;
2. a running max over those chunk maxima per key -- one row per chunk, not per event;
3. a running max within each ``(key, chunk)`` window -- bounded by the chunk width;
4. the answer is the greater of (2) for the chunk and (3) for the row.

The row-level shuffle is on ``(key, chunk)``, so a hot key spreads over as many tasks as it has
chunks. Step 2 works the same way on its smaller rows: chunks are cut into chunks of ``FAN``, their maxima
go up (an up-sweep) and the maxima before each come back down, level by level, so that no window ever holds
more than ``FAN`` chunks below the top; with the widths below, a key's top window has a row for every
268 million deliveries. ``chunk`` must be non-decreasing along ``order`` (e.g.
``floor(first_order_col / span)``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default chunk widths, in units of the first ordering column.
ARRIVAL_CHUNK = 1 << 16
BATCH_CHUNK = 1 << 10
LSN_CHUNK = 1 << 20
# Levels of chunk maxima, and chunks of one level that make one of the next.
LEVELS = 2
FAN = 1 << 12


def chunk_of(col: str, span: int) -> SparkColumn:
    return F.floor(F.col(col) / F.lit(span)).cast("bigint")


def chunk_at(order: Sequence[str], position: str, span: int) -> SparkColumn:
    """Chunk along ``order`` of which ``position`` is the column that counts: the columns before it,
    then its value in steps of ``span``. Never decreases along the order."""
    before = list(order)[:list(order).index(position)]
    step = chunk_of(position, span)
    return F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(before)], step.alias("step")) if before else step


def _coarser(chunk: str, kind: T.DataType, fan: int) -> SparkColumn:
    """``fan`` neighbouring chunks as one: the last step count divided, what tags it kept."""
    if not isinstance(kind, T.StructType):
        return F.floor(F.col(chunk) / F.lit(fan)).cast("bigint")
    *tags, step = kind.names
    return F.struct(*[F.col(f"{chunk}.{t}").alias(t) for t in tags],
                    F.floor(F.col(f"{chunk}.{step}") / F.lit(fan)).cast("bigint").alias(step))


def _before_chunks(maxima: DataFrame, by: Sequence[str], levels: int, fan: int) -> DataFrame:
    """Rows ``by..., _chunk, _cmax`` -> ``by..., _chunk, _before_chunk``: the maximum over the group's
    earlier chunks."""
    if levels <= 1:
        earlier = Window.partitionBy(*by).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
        return maxima.select(*by, "_chunk", F.max("_cmax").over(earlier).alias("_before_chunk"))
    tagged = maxima.withColumn("_upper", _coarser("_chunk", maxima.schema["_chunk"].dataType, fan))
    above = tagged.groupBy(*by, F.col("_upper").alias("_chunk")).agg(F.max("_cmax").alias("_cmax"))
    above = _before_chunks(above, by, levels - 1, fan).select(
        *by, F.col("_chunk").alias("_upper"), F.col("_before_chunk").alias("_before_upper"))
    inside = Window.partitionBy(*by, "_upper").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    own = tagged.withColumn("_before_own", F.max("_cmax").over(inside))
    return own.join(above, [*by, "_upper"]).select(
        *by, "_chunk", F.greatest("_before_upper", "_before_own").alias("_before_chunk"))


def prior_max(df: DataFrame, by: Sequence[str], order: Sequence[str], value: SparkColumn,
              out: str, chunk: SparkColumn, strictly_lower: bool = False,
              maxima_of: DataFrame | None = None, levels: int = LEVELS, fan: int = FAN) -> DataFrame:
    """``df`` plus column ``out``: max of ``value`` over earlier rows (by ``order``) of the same
    ``by`` group; null for the first row. ``value`` may be a struct (compared field by field),
    which makes it a "latest earlier row" lookup when its first field is the order key.

    With ``strictly_lower`` (one integral order column), rows tied on the order value do not see
    each other: "earlier" means a strictly lower order value. ``levels`` of chunk maxima stand above the
    rows, each of ``fan`` chunks of the one below.
    """
    # ``maxima_of``: rows with the same chunk maxima that are cheaper to get than ``df`` itself (the log
    # that ``df`` was folded from), so that ``df`` is not computed twice.
    by = list(by)
    if strictly_lower and len(order) != 1:
        raise ValueError("strictly_lower needs exactly one integral order column")
    base = df.withColumn("_chunk", chunk).withColumn("_val", value)
    wide = base if maxima_of is None else maxima_of.withColumn("_chunk", chunk).withColumn("_val", value)
    chunk_max = wide.groupBy(*by, "_chunk").agg(F.max("_val").alias("_cmax"))
    # Most groups lie in one chunk and have none before it; only the others take part in the join.
    before_chunk = _before_chunks(chunk_max, by, levels, fan).where("_before_chunk is not null")
    within = Window.partitionBy(*by, "_chunk").orderBy(*order)
    within = (within.rangeBetween(Window.unboundedPreceding, -1) if strictly_lower
              else within.rowsBetween(Window.unboundedPreceding, -1))
    # A row without group or place has no earlier rows and no place among them: it is left out.
    placed = reduce(and_, [F.col(c).isNotNull() for c in [*by, "_chunk"]])
    rows = base.where(placed).withColumn("_before_in", F.max("_val").over(within))
    return (rows.join(before_chunk, [*by, "_chunk"], "left")
            .withColumn(out, F.greatest(F.col("_before_chunk"), F.col("_before_in")))
            .drop("_chunk", "_val", "_before_chunk", "_before_in"))
