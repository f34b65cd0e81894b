"""Keyed state inside the stream: the fold as a streaming aggregation.

``groupBy(key).agg(min_by(row, order))`` in update mode keeps the winning change of every key, tombstones
included, in Spark's state store (RocksDB, so it lives on disk beside the executors and is checkpointed to
the shared folder). Each micro-batch puts out the keys it brought changes for, with their state after it, so
a reader needs only the latest output of a key and no comparison of LSNs. There is no watermark: a key's
state is kept for good, as a late change may come at any time. A restart goes on from the checkpoint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.exprs import DELETE_OP
from ..operators import decode as dc
from ..spec import DELETED, LSN, TableSpec
from . import fs

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: What a query is started with. A commit writes the changes of its micro-batch, not the store's files, which
#: go out now and then; and only the last versions are kept, as a restart goes on from the last one.
STORE = {
    PROVIDER: ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.minBatchesToRetain": "2",
}
UPDATE = "_update"


def keyed_state(changes: DataFrame, spec: TableSpec, arrival: tuple[str, ...] = ()) -> DataFrame:
    """Stream of changes -> stream of states: ``key, <value columns>, _lsn, _deleted`` of the winning change.

    On an LSN tie the first arrival wins, as far as the stream knows it (a stream's plan may not number
    rows); what is then still equal goes by its values.
    """
    deleted = F.col("op") == DELETE_OP
    row = F.struct(*[F.when(~deleted, F.col(n)).alias(n) for n in spec.value_names], F.col(LSN), deleted.alias(DELETED))
    order = F.struct((-F.col(LSN)).alias("lsn"), *[F.col(a) for a in arrival], row.alias("row"))
    return changes.groupBy(spec.key).agg(F.min_by(row, order).alias("w")).select(spec.key, "w.*")


def start(source: DataFrame, spec: TableSpec, root: str, checkpoint: str, on_error: str = "quarantine",
          arrival: tuple[str, ...] = ("_written", "_file", "_block"), available_now: bool = True):
    """Run the stream of lines ``source`` into ``root``: a Parquet folder for each micro-batch with the
    states it changed. A replayed micro-batch is skipped if it was written, else written again."""
    spark = source.sparkSession
    states = keyed_state(dc.accepted(dc.decode(source, spec, keep=arrival), on_error), spec, arrival)

    def write(batch: DataFrame, epoch_id: int) -> None:
        path = f"{root}/u{int(epoch_id):012d}"
        if not fs.committed(spark, path):
            batch.write.mode("overwrite").parquet(path)

    before = {name: spark.conf.get(name, None) for name in STORE}
    for name, value in STORE.items():  # read when the query starts
        spark.conf.set(name, value)
    try:
        stream = states.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        return (stream.trigger(availableNow=True) if available_now else stream).start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def read_state(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    """One row per key, tombstones included: its latest output."""
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/u(\d+)/[^/]+$", 1).cast("bigint")
    rows = spark.read.schema(spec.state_schema()).parquet(f"{root}/u*").select("*", number.alias(UPDATE))
    last = Window.partitionBy(spec.key).orderBy(F.col(UPDATE).desc())
    return rows.withColumn("_rank", F.row_number().over(last)).where("_rank = 1").drop("_rank", UPDATE)
