"""Applying a batch of changes to stored state.

``merge_guarded`` is the LSN-guarded merge: ``fold(state UNION batch)``, with stored rows winning
LSN ties (they arrived first). Deletes stay in the state as tombstones, so a late lower-LSN
upsert can never resurrect a deleted key, within a batch or across batches.

``net_changes`` + ``apply_changes`` are the sink form: split a batch into the rows to upsert and
the keys to delete (only where the batch beats the stored LSN), then rewrite a live-rows table
with a left-anti join on the changed keys plus a union of the upserts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import DELETED, LSN, TableSpec
from . import fold as fo

TIER = "_tier"


def merge_guarded(state: DataFrame, batch: DataFrame, spec: TableSpec,
                  arrival: Sequence[str] = ()) -> DataFrame:
    """State (with tombstones) + change batch -> new state (with tombstones)."""
    stored = fo.state_as_changes(state, spec).withColumn(TIER, F.lit(0))
    incoming = batch.select(spec.key, *spec.value_names, LSN, "op", *arrival).withColumn(TIER, F.lit(1))
    both = stored.unionByName(incoming, allowMissingColumns=True)
    return fo.fold_state(both, spec, fo.MODE_LSN, (TIER, *arrival))


def net_changes(state: DataFrame, batch: DataFrame, spec: TableSpec,
                arrival: Sequence[str] = ()) -> DataFrame:
    """Keys whose state this batch changes, at their new state: the batch's winning change per
    key where its LSN beats the stored one (or the key is new). Adds ``action``."""
    key = spec.key
    winners = fo.fold_state(batch, spec, fo.MODE_LSN, arrival)
    stored = state.select(key, F.col(LSN).alias("_stored_lsn"))
    probed = winners.join(stored, key, "left")
    changed = probed.where(F.col("_stored_lsn").isNull() | (F.col(LSN) > F.col("_stored_lsn")))
    return changed.drop("_stored_lsn").withColumn(
        "action", F.when(F.col(DELETED), F.lit("delete")).otherwise(F.lit("upsert")))


def apply_changes(live: DataFrame, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Live table + net changes -> live table: drop every changed key (deletes and upserts
    alike; deleting an absent key is a no-op), then add the upserted rows."""
    key = spec.key
    cols = [key, *spec.value_names, LSN]
    kept = live.select(*cols).join(changes.select(key), key, "left_anti")
    upserts = changes.where(F.col("action") == "upsert").select(*cols)
    return kept.unionByName(upserts)
