"""Initial-snapshot bootstrap: a table's rows as snapshot-read ('r') change events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column as SparkColumn
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..spec import LSN, TableSpec

SNAPSHOT_OP = "r"


def snapshot_events(rows: DataFrame, spec: TableSpec, snapshot_lsn: int | SparkColumn,
                    arrival: Sequence[str] = ()) -> DataFrame:
    """Rows of a consistent snapshot taken at ``snapshot_lsn`` -> upsert events at that LSN.

    Any change after the snapshot has a greater LSN and wins; arrival columns are set to -1 so
    the snapshot counts as delivered before the stream.
    """
    lsn = snapshot_lsn if isinstance(snapshot_lsn, SparkColumn) else F.lit(int(snapshot_lsn))
    return rows.select(
        *[F.col(c.name).cast(c.spark_type()).alias(c.name) for c in spec.columns],
        F.lit(SNAPSHOT_OP).alias("op"), lsn.cast("bigint").alias(LSN),
        *[F.lit(-1).cast("bigint").alias(a) for a in arrival])
