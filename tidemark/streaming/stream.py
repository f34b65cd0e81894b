"""Structured Streaming: change envelopes -> decode -> per-epoch dedup -> state table.

Every micro-batch is decoded, cut to one change per key and committed as one epoch of the state
table (``streaming.state``). There is no watermark: a late change is never dropped by time, it
is ordered by its LSN when the state is folded. Exactly-once comes from two things together: the
checkpoint gives each epoch a stable id and its input, and an epoch that is already committed is
skipped, so a replay after a crash changes nothing; a replay under a new checkpoint only adds
duplicates, which the fold absorbs.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import counters as co
from ..operators import decode as dc
from ..operators import fold as fo
from ..spec import LSN, TableSpec
from . import fs
from .state import BULK, StateTable

KAFKA_ARRIVAL = ("partition", "offset")
KAFKA_POSITION = "offset"

#: Delivery position of a line in change files: when its file was written, its name, then the place in
#: it. Spark packs splits by size, so the position must not depend on how they were packed.
FILE_ARRIVAL = ("_written", "_file", "_block", "_row")
FILE_POSITION = "_row"


def placed(lines: DataFrame) -> DataFrame:
    """``value`` text read from files, plus the split each line comes from."""
    meta = F.col("_metadata")
    return lines.select("value", meta["file_modification_time"].alias("_written"), meta["file_path"].alias("_file"),
                        meta["file_block_start"].alias("_block"))


def numbered(lines: DataFrame) -> DataFrame:
    """``placed`` lines plus their place in the split: the low 33 bits number the rows of a task, in the
    order in which it reads its splits. (A stream's plan may not number rows; its micro-batches may.)"""
    return lines.withColumn(FILE_POSITION, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))


def delivered(lines: DataFrame) -> DataFrame:
    """``value`` text read from files, plus its ``FILE_ARRIVAL`` columns (file order, then line order)."""
    return numbered(placed(lines))


def kafka_options(bootstrap: str, topic: str, starting_offsets: str = "earliest",
                  max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Options for ``spark.readStream.format("kafka")`` over one change topic."""
    opts = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
            "startingOffsets": starting_offsets, "failOnDataLoss": "true"}
    if max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return opts


def kafka_source(spark: SparkSession, bootstrap: str, topic: str,
                 starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Change topic as a stream of ``value`` text with arrival ``(partition, offset)``.

    Needs the Kafka connector on the classpath. The topic must be keyed by the primary key, so
    that one key's changes stay in one partition and ``(partition, offset)`` orders them.
    """
    raw = (spark.readStream.format("kafka")
           .options(**kafka_options(bootstrap, topic, starting_offsets, max_offsets_per_trigger))
           .load())
    return raw.select(F.col("value").cast("string").alias("value"), "partition", "offset")


def text_source(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                max_bytes_per_trigger: int | None = None) -> DataFrame:
    """JSON-lines change files (a directory, a glob or one file) as a stream of ``value`` text with
    the splits it comes from (``placed``)."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    elif max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", str(max_bytes_per_trigger))
    if "*" not in path and fs.is_file(spark, path):
        folder, _, name = path.rpartition("/")
        reader, path = reader.option("pathGlobFilter", name), folder or "/"
    return placed(reader.load(path))


def run_id(checkpoint: str) -> str:
    """Stable per checkpoint: restarts reuse epoch directories, a new checkpoint gets new ones."""
    return "r" + hashlib.sha1(checkpoint.encode()).hexdigest()[:12]


def line_counters() -> list[F.Column]:
    """Aggregates over decoded lines: what came in, and what became of it."""
    reason = F.col(dc.REASON)
    return [F.count(F.lit(1)).alias("delivered"),
            F.count_if(reason == dc.OK).alias("accepted"),
            F.count_if(reason == dc.SKIPPED).alias("skipped"),
            F.count_if(~reason.isin(dc.OK, dc.SKIPPED)).alias("rejected"),
            F.count_if((reason == dc.OK) & (F.col("op") == "d")).alias("deletes"),
            F.max(F.when(reason == dc.OK, F.col(LSN))).alias("max_lsn")]


def event_counters() -> list[F.Column]:
    """Aggregates over flagged events."""
    return [F.count_if(F.col("applied")).alias("applied"), F.count_if(~F.col("applied")).alias("ignored")]


STATS = "epoch long, delivered long, accepted long, skipped long, rejected long, deletes long, max_lsn long, applied long, ignored long"


def epoch_path(root: str, run: str, epoch_id: int) -> str:
    return f"{root}/{run}/e{int(epoch_id):012d}"


def cut(lines: DataFrame, events: int, order: Sequence[str], split: Sequence[str] = FILE_ARRIVAL[:-1],
        row: str = FILE_POSITION) -> DataFrame:
    """Lines that carry an event (neither null nor blank), with their place ``_place`` (from 0) in delivery
    order and the number ``_cut`` of their batch of ``events`` lines; the last batch is what is left.

    An index of the splits, one row each, says how many lines come before a split; a line's place is that
    and its place in the split. Only the index is sorted as a whole, never the lines; it goes to every task, so
    the lines are not shuffled either. Index and lines come
    from one listing of files, which Spark packs into the same tasks, so the rows are numbered alike in both.
    """
    text = lines.where(F.col("value").isNotNull() & (F.trim("value") != ""))
    index = text.groupBy(*split).agg(F.min(row).alias("_first"), F.count(F.lit(1)).alias("_lines"))
    earlier = Window.orderBy(*[c for c in order if c in split]).rowsBetween(Window.unboundedPreceding, -1)
    index = index.withColumn("_before", F.coalesce(F.sum("_lines").over(earlier), F.lit(0))).drop("_lines")
    placed_text = text.join(F.broadcast(index), list(split)).withColumn("_place", F.col("_before") + F.col(row) - F.col("_first"))
    return placed_text.withColumn("_cut", F.floor(F.col("_place") / F.lit(events)).cast("bigint")).drop("_first", "_before")


def epoch_writer(state: StateTable, spec: TableSpec, run: str, arrival: Sequence[str] = FILE_ARRIVAL,
                 position: str | None = FILE_POSITION, on_error: str = "quarantine",
                 rejects_root: str | None = None, stats_root: str | None = None, done: list[int] | None = None,
                 events_per_epoch: int | None = None, compact_after: int | None = None):
    """The ``foreachBatch`` function: decode, commit the epoch, side-output rejects and a one-row
    progress record per epoch. ``done`` gets the ids of the epochs seen.

    The counters are observed in the pass that writes the epoch, against the state before it, of which only
    the files are read that the epoch's keys can meet. A replay that finds the epoch committed but not
    counted counts it against the state as of the commit before. With ``events_per_epoch``, a micro-batch
    is committed as epochs of that many events each, in one write. With ``compact_after``, the state is
    compacted once that many commits wait.
    """
    order = tuple(arrival)

    def flagged(events: DataFrame, as_of: int | None) -> DataFrame:
        flags = co.applied_flags(events, spec, order, position=position)
        if not state.exists():
            return flags
        return co.applied_to_state(flags, state.probe(events.select(spec.key), as_of), spec)

    def write(batch: DataFrame, epoch_id: int) -> None:
        lines = numbered(batch) if FILE_POSITION in order and FILE_POSITION not in batch.columns else batch
        keep = order
        if events_per_epoch:
            lines, keep = cut(lines, events_per_epoch, order), (*order, "_cut")
        decoded = dc.decode(lines, spec, keep=keep)
        if rejects_root or stats_root:  # the batch is read by the probe and the marks besides the write
            decoded = (decoded if rejects_root else decoded.drop("value")).persist()  # only rejects need the text
        try:
            name = (f"{run}-{int(epoch_id)}", BULK) if events_per_epoch else (run, int(epoch_id))
            stats = stats_root and epoch_path(stats_root, run, epoch_id)
            counting = bool(stats) and not fs.committed(state.spark, stats)
            number = state.number(*name) if counting else None
            seen, judged = Observation(), Observation()
            events = dc.accepted(decoded.observe(seen, *line_counters()) if counting else decoded, on_error)
            if counting:
                judged_events = flagged(events, None if number is None else number - 1).observe(judged, *event_counters())
                if number is not None:
                    judged_events.write.format("noop").mode("overwrite").save()
                # A key's flags do not change which of its changes wins.
                events = judged_events
            if rejects_root:
                dc.rejected(decoded).write.mode("overwrite").parquet(epoch_path(rejects_root, run, epoch_id))
            if events_per_epoch:
                written = state.write_epochs(events, "_cut", name[0], order)
            else:
                written = state.write_epoch(events, name[1], run, order)
            if counting and (written or number is not None):
                counts = {"epoch": int(epoch_id), **seen.get, **judged.get}
                state.spark.createDataFrame([counts], STATS).coalesce(1).write.mode("overwrite").parquet(stats)
            if compact_after:
                state.upkeep(compact_after)
            if done is not None:
                done.append(int(epoch_id))
        finally:
            if decoded.is_cached:
                decoded.unpersist()

    return write


def catalog_writer(spec: TableSpec, table: str, arrival: Sequence[str] = KAFKA_ARRIVAL,
                   on_error: str = "quarantine", run_sql: Callable[[SparkSession, str], object] | None = None):
    """The ``foreachBatch`` function for a table of a catalog with row-level operations: decode, one
    change per key, then the generated LSN-guarded ``MERGE``. A replayed batch changes nothing, since
    no LSN of it beats what the table holds."""
    run_sql = run_sql or (lambda session, text: session.sql(text))

    def write(batch: DataFrame, epoch_id: int) -> None:
        decoded = dc.accepted(dc.decode(batch, spec, keep=arrival), on_error)
        latest = fo.dedup_latest(decoded, spec, (), arrival)
        view = f"tidemark_{spec.name}_{int(epoch_id)}_{uuid.uuid4().hex[:8]}"
        latest.createOrReplaceTempView(view)
        try:
            run_sql(batch.sparkSession, spec.merge_sql(table, view))
        finally:
            batch.sparkSession.catalog.dropTempView(view)

    return write


def merge_topic(spark: SparkSession, bootstrap: str, topic: str, table: str, checkpoint: str, spec: TableSpec,
                starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                on_error: str = "quarantine", available_now: bool = False):
    """The production job: change topic -> decode -> one change per key -> MERGE into a catalog table."""
    spark.sql(spec.create_table_ddl(table))
    source = kafka_source(spark, bootstrap, topic, starting_offsets, max_offsets_per_trigger)
    stream = source.writeStream.foreachBatch(catalog_writer(spec, table, KAFKA_ARRIVAL, on_error)).option(
        "checkpointLocation", checkpoint)
    return (stream.trigger(availableNow=True) if available_now else stream).start()


def merge_stream(source: DataFrame, state: StateTable, spec: TableSpec, checkpoint: str,
                 arrival: Sequence[str] = FILE_ARRIVAL, position: str | None = FILE_POSITION,
                 on_error: str = "quarantine", rejects_root: str | None = None, stats_root: str | None = None,
                 available_now: bool = True, processing_time: str | None = None, done: list[int] | None = None,
                 events_per_epoch: int | None = None, compact_after: int | None = None):
    """Start the streaming merge; returns the ``StreamingQuery``."""
    writer = epoch_writer(state, spec, run_id(checkpoint), arrival, position, on_error, rejects_root,
                          stats_root, done, events_per_epoch, compact_after)
    stream = source.writeStream.foreachBatch(writer).option("checkpointLocation", checkpoint)
    if available_now:
        stream = stream.trigger(availableNow=True)
    elif processing_time:
        stream = stream.trigger(processingTime=processing_time)
    return stream.start()
