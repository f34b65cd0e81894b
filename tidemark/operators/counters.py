"""Merge counters and per-batch net changes, computed from the log instead of a sequential loop.

An event is *applied* iff its key is unseen or its LSN is strictly greater than every LSN of that
key delivered before it (the running high-water-mark in arrival order); otherwise it is ignored
as stale or duplicate. ``seen = applied + ignored``. The final state does not depend on arrival
order; the counters do, so they need the arrival columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import DELETE_OP
from ..spec import DELETED, LSN, TableSpec
from . import fold as fo
from .ordered import ARRIVAL_CHUNK, BATCH_CHUNK, chunk_at, chunk_of, prior_max

# Net-change actions and probe verdicts.
ACTION_UPSERT = "upsert"
ACTION_DELETE = "delete"
VERDICT_NEW = "new"
VERDICT_APPLY = "apply"
VERDICT_STALE = "stale"


def applied_flags(changes: DataFrame, spec: TableSpec, arrival: Sequence[str],
                  chunk_span: int = ARRIVAL_CHUNK, position: str | None = None) -> DataFrame:
    """Each delivered event plus ``_prior_lsn`` (high-water-mark before it) and ``applied``.

    ``position`` is the arrival column that counts deliveries, the first one by default; with
    Kafka's ``(partition, offset)`` it is ``offset``. The arrival columns before it tag its chunks.
    """
    flagged = prior_max(changes, [spec.key], arrival, F.col(LSN), "_prior_lsn",
                        chunk_at(arrival, position or arrival[0], chunk_span))
    return flagged.withColumn(
        "applied", F.col("_prior_lsn").isNull() | (F.col(LSN) > F.col("_prior_lsn")))


def merge_stats(flags: DataFrame) -> DataFrame:
    """One row: seen, applied, ignored."""
    return flags.agg(
        F.count(F.lit(1)).alias("seen"),
        F.count_if(F.col("applied")).alias("applied"),
        F.count_if(~F.col("applied")).alias("ignored"))


def batch_stats(flags: DataFrame, batch: str = "batch") -> DataFrame:
    """Per micro-batch: delivered, applied, ignored."""
    return flags.groupBy(batch).agg(
        F.count(F.lit(1)).alias("delivered"),
        F.count_if(F.col("applied")).alias("applied"),
        F.count_if(~F.col("applied")).alias("ignored"))


def run_stats(flags: DataFrame, state: DataFrame, batch: str = "batch") -> DataFrame:
    """One row: delivered, applied, ignored, batches, live_rows.

    The two one-row aggregates are stacked with a union and collapsed, not joined.
    """
    counts = flags.agg(
        F.count(F.lit(1)).alias("delivered"),
        F.count_if(F.col("applied")).alias("applied"),
        F.count_if(~F.col("applied")).alias("ignored"),
        F.count_distinct(F.col(batch)).alias("batches"))
    live = state.agg(F.count_if(~F.col(DELETED)).alias("live_rows"))
    both = counts.unionByName(live, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in ("delivered", "applied", "ignored", "batches", "live_rows")])


def batch_net_changes(changes: DataFrame, spec: TableSpec, arrival: Sequence[str],
                      batch: str = "batch", chunk_span: int = BATCH_CHUNK) -> DataFrame:
    """Per batch, the keys whose state it changed, at their end-of-batch state.

    A key changes in batch n iff the greatest LSN it has in n beats the greatest LSN it had in
    all earlier batches; its end-of-batch state is then that batch's winning change.
    Output: batch, key, value columns, _lsn, action ('upsert' | 'delete').
    """
    per_batch = fo.fold_state(changes, spec, fo.MODE_LSN, arrival, by=(batch,))
    ranked = prior_max(per_batch, [spec.key], [batch], F.col(LSN), "_prev_lsn",
                       chunk_of(batch, chunk_span), maxima_of=changes, levels=1)  # a row for 1,024 batches
    changed = ranked.where(F.col("_prev_lsn").isNull() | (F.col(LSN) > F.col("_prev_lsn")))
    return changed.select(
        batch, spec.key, *spec.value_names, LSN,
        F.when(F.col(DELETED), F.lit(ACTION_DELETE)).otherwise(F.lit(ACTION_UPSERT)).alias("action"))


def against_prior_batches(changes: DataFrame, spec: TableSpec, batch: str = "batch",
                          chunk_span: int = BATCH_CHUNK) -> DataFrame:
    """Every delivered event next to its key's stored state as of the end of the previous batch:
    ``stored_lsn``, ``stored_deleted`` and ``verdict`` ('new' | 'apply' | 'stale')."""
    key = spec.key
    # Fixed-width buffers only, so the row-level aggregate is a hash aggregate.
    per_batch = changes.groupBy(batch, key).agg(
        F.max(LSN).alias("_l"), F.max_by(F.col("op") == DELETE_OP, F.col(LSN)).alias("_d")).select(
            batch, key, F.struct(F.col("_l").alias("l"), F.col("_d").alias("d")).alias("_m"))
    stored = prior_max(per_batch, [key], [batch], F.col("_m"), "_stored", chunk_of(batch, chunk_span), levels=1)
    stored = stored.select(batch, key, F.col("_stored.l").alias("stored_lsn"),
                           F.col("_stored.d").alias("stored_deleted"))
    return with_verdict(changes.join(stored, [batch, key], "inner"))


def probe_state(batch_changes: DataFrame, state: DataFrame, spec: TableSpec) -> DataFrame:
    """Each change of one incoming batch next to the stored state of its key.

    One left join; of the state only key, LSN and the delete flag are read.
    """
    key = spec.key
    stored = state.select(key, F.col(LSN).alias("stored_lsn"), F.col(DELETED).alias("stored_deleted"))
    return with_verdict(batch_changes.join(stored, key, "left"))


def applied_to_state(flags: DataFrame, state: DataFrame, spec: TableSpec) -> DataFrame:
    """Flags of one batch corrected by the stored state: an event is applied iff its LSN beats both
    the stored one and all earlier ones of its key in the batch."""
    probed = probe_state(flags, state, spec)
    beaten = F.greatest(F.col("_prior_lsn"), F.col("stored_lsn"))  # nulls are skipped
    return probed.withColumn("applied", beaten.isNull() | (F.col(LSN) > beaten))


def with_verdict(df: DataFrame) -> DataFrame:
    return df.withColumn(
        "verdict",
        F.when(F.col("stored_lsn").isNull(), F.lit(VERDICT_NEW))
        .when(F.col(LSN) > F.col("stored_lsn"), F.lit(VERDICT_APPLY))
        .otherwise(F.lit(VERDICT_STALE)))
