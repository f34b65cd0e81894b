"""Minimal file-system probes (metadata only; no data passes through the driver).

Through Hadoop's FileSystem API, so any URI the cluster can write works (HDFS, object stores, local). A
client without a JVM gateway cannot see the cluster's storage, and its own disk is not that storage: the
probes then raise instead of reporting nothing.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession, path: str):
    try:
        sc = spark.sparkContext
        jvm = sc._jvm
    except Exception as error:  # noqa: BLE001 - whatever a client without a gateway raises
        raise RuntimeError(f"cannot probe {path!r}: this session has no JVM gateway") from error
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return bool(fs.exists(p))


def matches(spark: SparkSession, path: str) -> bool:
    """True if anything is at ``path``, which may be a glob."""
    p, fs = _hadoop(spark, path)
    return bool(fs.globStatus(p))


def is_file(spark: SparkSession, path: str) -> bool:
    p, fs = _hadoop(spark, path)
    return bool(fs.exists(p)) and bool(fs.getFileStatus(p).isFile())


def committed(spark: SparkSession, path: str) -> bool:
    """True once a Spark write to ``path`` has committed (its ``_SUCCESS`` marker exists)."""
    return exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-directories of ``path`` (empty if it does not exist)."""
    p, fs = _hadoop(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def committed_children(spark: SparkSession, path: str) -> list[str]:
    """Names of the committed sub-directories of ``path``, by one glob."""
    p, fs = _hadoop(spark, f"{path.rstrip('/')}/*/_SUCCESS")
    return sorted(s.getPath().getParent().getName() for s in fs.globStatus(p) or [])


def named(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names in ``path`` that fit the glob ``pattern``; only these leave the file system's side."""
    p, fs = _hadoop(spark, f"{path.rstrip('/')}/{pattern}")
    return sorted(s.getPath().getName() for s in fs.globStatus(p) or [])


def last_named(spark: SparkSession, path: str, pattern: str) -> str | None:
    """The greatest name in ``path`` that fits the glob ``pattern``, None if there is none."""
    p, fs = _hadoop(spark, f"{path.rstrip('/')}/{pattern}")
    found = fs.globStatus(p)  # sorted
    return found[len(found) - 1].getPath().getName() if found else None


def remove(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop(spark, path)
    fs.delete(p, True)
