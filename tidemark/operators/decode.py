"""Decode JSON change envelopes into flat, typed change rows, naming every rejected line.

Rules: ops c/u/r are upserts and d deletes (anything else is rejected); the LSN comes from
``source.lsn`` (quoted or not); the row image is ``before`` for deletes and ``after`` otherwise and
must carry a non-null key; deletes drop ``after``; event time is envelope ``ts_ms``, else
``source.ts_ms``, else 0, with zero counting as missing. A ``{"schema", "payload"}`` wrapper is
unwrapped; null and blank lines are skipped. Every scalar is parsed as text and coerced with
``try_cast`` / half-even rounding, so "5" is a valid LSN and "12.345" becomes 12.34.

A line holds exactly one JSON object. ``from_json`` alone would read the first value of a line and
ignore what follows, so the line is parsed as the first element of an array that ends in a sentinel:
only a single well-formed object leaves the array with these two elements. The sentinel carries the line's
own digest, which the line cannot contain, so no line can bring a sentinel of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import DELETE_OP, coerce_text, event_time, is_legal_op, normalise_op
from ..spec import LSN, TableSpec

# Reject reasons, in the order they are tested.
OK = "ok"
SKIPPED = "skipped"
BAD_JSON = "bad_json"
UNKNOWN_OP = "unknown_op"
BAD_LSN = "bad_lsn"
NO_IMAGE = "no_image"
NO_KEY = "no_key"
BAD_VALUE = "bad_value"
REASON = "_reject"
_END = "_end"
BEFORE = "before_"

ON_ERROR = ("strict", "quarantine")


def _with_object(df: DataFrame, text: F.Column, spec: TableSpec, name: str) -> DataFrame:
    """Add the envelope that ``text`` consists of; null unless it is one JSON object and nothing else."""
    schema = T.ArrayType(spec.envelope_parse_schema(_END))
    df = _evaluate_once(df, F.sha2(text, 256), "_d")
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit(f',{{"{_END}":"'), F.col("_d"), F.lit('"}]')), schema)
    df = _evaluate_once(df, parsed, "_a")
    first, last = F.get("_a", F.lit(0)), F.get("_a", F.lit(1))
    alone = (F.size("_a") == 2) & (last.getField(_END) == F.col("_d"))
    return df.withColumn(name, F.when(alone, first)).drop("_a", "_d")


def decode(lines: DataFrame, spec: TableSpec, value: str = "value",
           keep: Sequence[str] = (), before: bool = False) -> DataFrame:
    """Every input line -> one row: ``keep...``, the typed spec columns, ``op`` (u/d), ``_lsn``,
    ``ts_ms``, ``_reject`` (ok | skipped | bad_json | unknown_op | bad_lsn | no_image | no_key |
    bad_value) and the raw ``value`` text. With ``before``, the typed prior image as well, in
    ``before_<column>``."""
    text = F.col(value).cast("string")
    outer = _with_object(lines.select(*keep, text.alias(value)), F.col(value), spec, "_o")
    inner = _with_object(outer, F.col("_o.payload"), spec, "_i")
    unwrapped = F.when(F.col("_o.payload").isNotNull(), F.col("_i")).otherwise(F.col("_o"))
    env = _evaluate_once(inner, unwrapped, "e").drop("_o", "_i")

    op = F.col("e.op")
    is_delete = op == DELETE_OP
    image = F.when(is_delete, F.col("e.before")).otherwise(F.col("e.after"))
    lsn = F.col("e.source.lsn").try_cast("bigint")
    # Typed values are read by the reject rules, by every filter on the result and by the result.
    env = _evaluate_once(env, F.struct(*[coerce_text(image.getField(c.name), c).alias(c.name) for c in spec.columns]), "t")
    typed = {c.name: F.col("t").getField(c.name) for c in spec.columns}
    bad_value = F.lit(False)
    for c in spec.columns:
        if c.name != spec.key and c.type != "str":
            raw = F.col("e.after").getField(c.name)
            bad_value = bad_value | (~is_delete & raw.isNotNull() & typed[c.name].isNull())
    blank = F.col(value).isNull() | (F.trim(F.col(value)) == "")
    reason = (
        F.when(blank, F.lit(SKIPPED))
        .when(F.col("e").isNull(), F.lit(BAD_JSON))
        .when(op.isNull() | ~is_legal_op(op), F.lit(UNKNOWN_OP))
        .when(lsn.isNull(), F.lit(BAD_LSN))
        .when(image.isNull(), F.lit(NO_IMAGE))
        .when(typed[spec.key].isNull(), F.lit(NO_KEY))
        .when(bad_value, F.lit(BAD_VALUE))
        .otherwise(F.lit(OK))
    )
    env = _evaluate_once(env, reason, REASON)
    images = [coerce_text(F.col("e.before").getField(c.name), c).alias(BEFORE + c.name) for c in spec.columns] if before else []
    return env.select(
        *keep,
        typed[spec.key].alias(spec.key),
        *[F.when(~is_delete, typed[n]).alias(n) for n in spec.value_names],
        normalise_op(op).alias("op"),
        lsn.alias(LSN),
        event_time(F.col("e.ts_ms"), F.col("e.source.ts_ms")).alias("ts_ms"),
        *images,
        F.col(REASON),
        F.col(value),
    )


def _evaluate_once(df: DataFrame, expr, name: str) -> DataFrame:
    """Add ``expr`` as column ``name`` behind a one-element generator.

    Filters on decoded columns would otherwise be pushed below the projection with the JSON
    parse inlined at every reference (and, on a joined input, into the join condition), parsing
    each line many times. A generator output cannot be inlined, so the parse runs once per line.
    """
    return df.select("*", F.explode(F.array(expr)).alias(name))


def accepted(decoded: DataFrame, on_error: str = "quarantine") -> DataFrame:
    """Good rows of ``decode``. ``strict`` fails the job on the first rejected line (a bad
    event stops the run); ``quarantine`` leaves rejects to ``rejected``. Skipped lines vanish."""
    if on_error not in ON_ERROR:
        raise ValueError(f"unknown on_error {on_error!r}")
    reason = F.col(REASON)
    if on_error == "strict":
        fail = F.when(~reason.isin(OK, SKIPPED),
                      F.raise_error(F.concat(F.lit("rejected change event: "), reason)))
        decoded = decoded.where(F.coalesce(fail.cast("boolean"), F.lit(True)))
    return decoded.where(reason == OK).drop(REASON, "value")


def rejected(decoded: DataFrame) -> DataFrame:
    """Side output of ``decode``: rejected lines with their reason and raw text."""
    return decoded.where(~F.col(REASON).isin(OK, SKIPPED)).select(REASON, "value")


def reject_counts(decoded: DataFrame) -> DataFrame:
    return decoded.groupBy(F.col(REASON).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
