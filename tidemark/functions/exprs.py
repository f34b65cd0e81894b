"""Scalar column expressions shared by the operators (all JVM-side built-ins, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column as SparkColumn
from pyspark.sql import functions as F

from ..spec import DECIMAL_PRECISION, Column

# Legal change ops and their normalised forms.
UPSERT_OPS = ("c", "u", "r")
DELETE_OP = "d"
UPSERT = "u"


def col_(c: str | SparkColumn) -> SparkColumn:
    return F.col(c) if isinstance(c, str) else c


def normalise_op(op: str | SparkColumn) -> SparkColumn:
    """c/u/r -> 'u', d -> 'd' (callers reject anything else first)."""
    return F.when(col_(op) == DELETE_OP, F.lit(DELETE_OP)).otherwise(F.lit(UPSERT))


def is_legal_op(op: str | SparkColumn) -> SparkColumn:
    return col_(op).isin(*UPSERT_OPS, DELETE_OP)


def money_from_text(text: str | SparkColumn, scale: int) -> SparkColumn:
    """Text -> DECIMAL(18, scale), rounded half-even; unparseable -> null."""
    wide = col_(text).try_cast(f"decimal(38,{max(scale, 10)})")
    return F.bround(wide, scale).try_cast(f"decimal({DECIMAL_PRECISION},{scale})")


def epoch_ms_to_ntz(ms: str | SparkColumn) -> SparkColumn:
    """Epoch milliseconds -> TIMESTAMP_NTZ without going through the session time zone."""
    return F.timestamp_add(
        "MILLISECOND", col_(ms), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def coerce_text(text: str | SparkColumn, column: Column) -> SparkColumn:
    """Typed value of one image field parsed as text; null when it cannot be coerced."""
    t = col_(text)
    if column.type == "int":
        return t.try_cast("bigint")
    if column.type == "decimal":
        return money_from_text(t, column.scale)
    if column.type == "ts":
        ms = t.try_cast("bigint")
        return F.when(ms.isNotNull(), epoch_ms_to_ntz(ms)).otherwise(t.try_cast("timestamp_ntz"))
    return t


def coerce_typed(value: str | SparkColumn, column: Column) -> SparkColumn:
    """Project an already-typed value onto the spec's type (decimals rounded half-even)."""
    v = col_(value)
    if column.type == "decimal":
        return F.bround(v.cast(f"decimal(38,{max(column.scale, 10)})"), column.scale).cast(
            f"decimal({DECIMAL_PRECISION},{column.scale})")
    return v.cast(column.spark_type())


def event_time(envelope_ts: str | SparkColumn, source_ts: str | SparkColumn) -> SparkColumn:
    """Envelope ts_ms, else source ts_ms, else 0; a zero counts as missing."""
    env = col_(envelope_ts).try_cast("bigint")
    src = col_(source_ts).try_cast("bigint")
    return F.coalesce(F.nullif(env, F.lit(0)), F.nullif(src, F.lit(0)), F.lit(0).cast("bigint"))


def decimal_text(value: str | SparkColumn) -> SparkColumn:
    """Decimal -> text with trailing zeros dropped ('12.50' -> '12.5'), as change feeds send it."""
    s = col_(value).cast("string")
    return F.regexp_replace(F.regexp_replace(s, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def canonical(value: str | SparkColumn, column: Column) -> SparkColumn:
    """Comparison form of a column: decimals to scale (half-even), ints as BIGINT, rest as text."""
    v = col_(value)
    if column.type == "decimal":
        return coerce_typed(v, column)
    if column.type == "int":
        return v.cast("bigint")
    return v.cast("string")
