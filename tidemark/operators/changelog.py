"""Change-log images and envelopes.

``with_before_images`` gives every change its key's prior row image (what a change feed sends as
``before``); ``to_envelopes`` renders changes as JSON change envelopes, the inverse of
``operators.decode``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import DELETE_OP, decimal_text
from ..spec import LSN, TableSpec
from .ordered import LSN_CHUNK, chunk_of, prior_max

BEFORE = "before_"


def with_before_images(log: DataFrame, spec: TableSpec, chunk_span: int = LSN_CHUNK) -> DataFrame:
    """Change log -> plus ``before_<col>`` = the key's previous row image.

    Redelivered copies (equal LSN) do not see each other, so they carry the same image.

    The previous image is that of the latest lower-LSN change of the key; it is null for a first insert and
    after a delete. It comes with its LSN through a skew-safe running max, so the rows are shuffled once;
    besides, only the last image of each (key, chunk) is.
    """
    is_live = F.coalesce(F.col("op") != DELETE_OP, F.lit(False))
    image = F.when(is_live, F.struct(*[F.col(n) for n in spec.column_names]))
    # LSNs differ but for redelivered copies; of those, one with an image counts.
    last = F.struct(F.col(LSN).alias("lsn"), is_live.alias("live"), image.alias("image"))
    # One level of chunk maxima: a row for a million LSNs of a key.
    marked = prior_max(log, [spec.key], [LSN], last, "_prev", chunk_of(LSN, chunk_span), strictly_lower=True, levels=1)
    return marked.select(*log.columns, *[F.col(f"_prev.image.{n}").alias(BEFORE + n) for n in spec.column_names])


def _image_json(spec: TableSpec, prefix: str = "") -> F.Column:
    fields = []
    for c in spec.columns:
        v = F.col(prefix + c.name)
        fields.append((decimal_text(v) if c.type == "decimal" else v).alias(c.name))
    return F.struct(*fields)


def to_envelopes(changes: DataFrame, spec: TableSpec, table: str | None = None,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Changes with ``before_*`` images -> one JSON envelope per row in column ``value``.

    ``{"op", "before", "after", "ts_ms", "source": {"table", "lsn", "ts_ms"}}``; decimals are
    sent as text without trailing zeros, deletes carry only ``before``.
    """
    is_delete = F.col("op") == DELETE_OP
    has_before = F.col(BEFORE + spec.key).isNotNull()
    env = F.struct(
        F.col("op").alias("op"),
        F.when(has_before, _image_json(spec, BEFORE)).alias("before"),
        F.when(~is_delete, _image_json(spec)).alias("after"),
        F.col("ts_ms").alias("ts_ms"),
        F.struct(F.lit(table or spec.name).alias("table"), F.col(LSN).alias("lsn"),
                 F.col("ts_ms").alias("ts_ms")).alias("source"),
    )
    return changes.select(*keep, F.to_json(env).alias("value"))
