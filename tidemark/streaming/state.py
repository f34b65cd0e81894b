"""A replay-safe state table as a directory convention over ordinary Parquet writes.

Layout under ``root``::

    epochs/c<n>.<run>.<epoch>/   commit n: one epoch of a run (or ``bulk``: many), one row per
                                 (epoch, key), tombstones included, column ``_epoch``
    parts/c<n>/                  rows that the compaction up to commit n wrote: one row per key, in files
                                 that each hold a key range of their own
    base/b<n>/                   the compacted state of all commits up to n: a row for each of its files,
                                 with the file's least and greatest key and its number of rows
    log/c<n>.<run>.<epoch>/      the commit log: number, run, epoch, time and rows of each epoch; never retired

A write counts once its ``_SUCCESS`` marker exists. Commit numbers rise over all runs, so they say which
of two changes with equal LSNs came first, whichever run brought it. An epoch that its run has committed
is skipped, so replaying a micro-batch after a crash between the write and the checkpoint commit is a
no-op; a replay under a new run only adds duplicates, which the fold absorbs. A base's name says which
commits it covers, so readers need one listing of names: they take the newest base with the commits after
it and never see half an epoch. One writer at a time.

Key ranges. The files of a base do not overlap, so a set of keys can only meet the files whose ranges they
fall in. A probe reads those alone; a read passes on, without a shuffle, the files that later commits do not
touch; a compaction folds and rewrites the files that they touch and names the others again. What these
cost follows the changes, not the state. ``retire`` deletes what the kept bases do not name.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import fold as fo
from ..operators.ranges import range_number
from ..spec import DELETED, LSN, TableSpec
from . import fs

EPOCH = "_epoch"
COMMIT = "_commit"
RANGE = "_range"
BULK = "bulk"
NEVER_COMMITTED = 0
#: Rows of a file of a base; a range that has grown to more is cut into several.
FILE_ROWS = 2_000_000
_NAME = re.compile(r"c(\d+)\.(.+)\.(bulk|\d+)$")


@dataclass(frozen=True, order=True)
class Commit:
    number: int
    run: str
    epoch: str  # decimal, or BULK
    path: str


@dataclass(frozen=True)
class File:
    """A file of a base: its path under the root, its key range and its rows."""

    path: str
    least: object
    greatest: object
    rows: int


class StateTable:
    def __init__(self, spark: SparkSession, root: str, spec: TableSpec, file_rows: int = FILE_ROWS):
        self.spark = spark
        self.root = root.rstrip("/")
        self.spec = spec
        self.file_rows = file_rows

    # -- names -------------------------------------------------------------------------------------

    def _parse(self, names: list[str]) -> list[Commit]:
        found = [(_NAME.match(n), n) for n in names]
        return sorted(Commit(int(m[1]), m[2], m[3], f"{self.root}/epochs/{n}") for m, n in found if m)

    def commits(self) -> list[Commit]:
        """Committed and retained writes, oldest first."""
        return self._parse(fs.committed_children(self.spark, f"{self.root}/epochs"))

    def bases(self) -> list[int]:
        names = fs.committed_children(self.spark, f"{self.root}/base")
        return sorted(int(n[1:]) for n in names if n.startswith("b"))

    def _last(self, every: list[Commit]) -> int:
        return max([c.number for c in every] + self.bases(), default=NEVER_COMMITTED)

    def _next(self) -> int:
        """The number of the next write: above all commits, those that never committed included."""
        name = fs.last_named(self.spark, f"{self.root}/epochs", "c[0-9]*.*.*")  # names sort by number
        return self._last(self._parse([name] if name else [])) + 1

    def _place(self, run: str, epoch: str) -> tuple[str, bool]:
        """Where an epoch goes, and whether its run has committed it. A write that never committed is
        written again in its place. Asks for names that fit and no list of all commits, whose number grows."""
        if not re.fullmatch(r"[\w-]+", run):
            raise ValueError(f"run id {run!r}: letters, digits, _ and - only")
        fitting = f"c[0-9]*.{run}.{epoch}"
        for c in self._parse(fs.named(self.spark, f"{self.root}/epochs", fitting)):
            return c.path, fs.committed(self.spark, c.path)
        # A retired epoch is known from the log alone.
        for name in fs.named(self.spark, f"{self.root}/log", fitting):
            if fs.committed(self.spark, f"{self.root}/log/{name}"):
                return f"{self.root}/epochs/{name}", True
        return f"{self.root}/epochs/c{self._next():012d}.{run}.{epoch}", False

    def number(self, run: str, epoch: int | str) -> int | None:
        """The commit number of an epoch (or ``BULK``), retired ones included; None if it is not committed."""
        path, done = self._place(run, str(epoch))
        return int(_NAME.search(path)[1]) if done else None

    # -- writing -----------------------------------------------------------------------------------

    def write_epoch(self, changes: DataFrame, epoch: int, run: str, arrival: Sequence[str] = ()) -> bool:
        """Commit one micro-batch; False if this (run, epoch) was already committed. Metrics that ``changes``
        observes are taken in the same pass."""
        path, done = self._place(run, str(int(epoch)))
        if done:
            self._logged(path)
            return False
        counted = Observation()
        rows = fo.fold_state(changes, self.spec, fo.MODE_LSN, arrival).withColumn(EPOCH, F.lit(int(epoch)).cast("bigint"))
        rows.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
        self._log(path, self.spark.range(1).select(F.lit(int(epoch)).cast("bigint").alias("epoch"),
                                                   F.lit(counted.get["rows"]).cast("bigint").alias("rows")))
        return True

    def write_epochs(self, changes: DataFrame, epoch_col: str, run: str, arrival: Sequence[str] = ()) -> bool:
        """Commit many epochs in one write (bulk load): deduplicated per (epoch, key)."""
        path, done = self._place(run, BULK)
        if done:
            self._logged(path)
            return False
        rows = fo.fold_state(changes.withColumn(EPOCH, F.col(epoch_col).cast("bigint")),
                             self.spec, fo.MODE_LSN, arrival, by=(EPOCH,))
        rows.write.mode("overwrite").parquet(path)
        self._logged(path)
        return True

    def _log(self, path: str, epochs: DataFrame) -> None:
        """Log the commit at ``path``: a row for each of its epochs (``epoch, rows``)."""
        m = _NAME.search(path)
        epochs.select(F.lit(int(m[1])).cast("bigint").alias("number"), F.lit(m[2]).alias("run"), "epoch",
                      F.current_timestamp().alias("committed_at"), "rows").coalesce(1).write.mode("overwrite").parquet(
                          f"{self.root}/log/{path.rpartition('/')[2]}")

    def _logged(self, path: str) -> None:
        """Log a committed write that the log does not have, from its rows."""
        if not fs.committed(self.spark, f"{self.root}/log/{path.rpartition('/')[2]}"):
            self._log(path, self.spark.read.parquet(path).groupBy(F.col(EPOCH).alias("epoch")).agg(F.count(F.lit(1)).alias("rows")))

    def replace(self, state: DataFrame) -> str:
        """Make ``state`` (key, value columns, LSN, delete flag) the whole table, over all commits so far."""
        n = self._next()
        rows = state.select(*self._columns, F.lit(0).alias(RANGE))
        return self._write_base(n, rows, state.count(), [])

    # -- reading -----------------------------------------------------------------------------------

    @property
    def _columns(self) -> list[str]:
        return [self.spec.key, *self.spec.value_names, LSN, DELETED]

    def exists(self) -> bool:
        return fs.exists(self.spark, f"{self.root}/epochs") or fs.exists(self.spark, f"{self.root}/base")

    def layout(self, as_of: int | None = None) -> tuple[str | None, list[Commit]]:
        """(newest base or None, commits it does not cover), up to commit ``as_of``."""
        if not self.exists():
            raise FileNotFoundError(f"no state table at {self.root}")
        bases = [n for n in self.bases() if as_of is None or n <= as_of]
        covered = bases[-1] if bases else NEVER_COMMITTED
        rest = [c for c in self.commits() if c.number > covered and (as_of is None or c.number <= as_of)]
        if as_of is not None and not bases and (not rest or rest[0].number > 1) and as_of > NEVER_COMMITTED and self.bases():
            raise ValueError(f"commit {as_of} is older than the oldest kept base")
        return (f"{self.root}/base/b{covered:012d}" if bases else None), rest

    def files(self, base: str | None) -> list[File]:
        """The files of a base by key range: as many as the base has files, never rows."""
        if base is None:
            return []
        found = self.spark.read.parquet(base).orderBy("least").collect()
        return [File(r["path"], r["least"], r["greatest"], r["rows"]) for r in found]

    def _read_files(self, files: list[File]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], self.spec.state_schema()).select(*self._columns)
        return self.spark.read.schema(self.spec.state_schema()).parquet(
            *[f"{self.root}/{f.path}" for f in files]).select(*self._columns)

    def _read_commits(self, commits: list[Commit]) -> DataFrame | None:
        """Rows of commits with their ``COMMIT`` number and ``EPOCH``."""
        if not commits:
            return None
        number = F.regexp_extract(F.col("_metadata.file_path"), r"/c(\d+)\.[^/]+/[^/]+$", 1).cast("bigint")
        schema = T.StructType([*self.spec.state_schema().fields, T.StructField(EPOCH, T.LongType())])
        return self.spark.read.schema(schema).parquet(*[c.path for c in commits]).select(
            *self._columns, EPOCH, number.alias(COMMIT))

    def _fold(self, files: DataFrame, later: DataFrame | None, extra: Sequence[str] = ()) -> DataFrame:
        """One row per key. On an LSN tie the base, then the earlier commit, then the earlier epoch wins."""
        rows = files.withColumn(EPOCH, F.lit(-1).cast("bigint")).withColumn(COMMIT, F.lit(NEVER_COMMITTED).cast("bigint"))
        rows = rows if later is None else rows.unionByName(later)
        changes = rows.withColumn("op", F.when(F.col(DELETED), F.lit("d")).otherwise(F.lit("u")))
        return fo.fold_state(changes, self.spec, fo.MODE_LSN, (COMMIT, EPOCH), by=extra)

    def _met(self, keys: DataFrame, files: list[File]) -> set[int]:
        """Numbers of the files whose ranges some of the keys fall in: at most as many as there are files."""
        if not files:
            return set()
        number = range_number(F.col(self.spec.key), [f.least for f in files])
        return {r.n for r in keys.select(number.alias("n")).distinct().collect()}

    def read_state(self, as_of: int | None = None) -> DataFrame:
        """One row per key (tombstones included), as of commit ``as_of`` (default: now). Files of the base
        that no later commit touches are passed on as they are. Raises if there is no table."""
        base, commits = self.layout(as_of)
        files, later = self.files(base), self._read_commits(commits)
        if later is None:
            return self._read_files(files)
        met = self._met(later, files)
        folded = self._fold(self._read_files([f for i, f in enumerate(files) if i in met]), later)
        rest = [f for i, f in enumerate(files) if i not in met]
        return folded.unionByName(self._read_files(rest)) if rest else folded

    def read_live(self, as_of: int | None = None) -> DataFrame:
        return fo.live_rows(self.read_state(as_of))

    def probe(self, keys: DataFrame, as_of: int | None = None) -> DataFrame:
        """State rows of the given keys (a column named like the spec's key, repeats allowed), read from the
        files of the base that they can meet and from the commits after it."""
        base, commits = self.layout(as_of)
        files, later = self.files(base), self._read_commits(commits)
        met = self._met(keys, files)
        wanted = keys.select(self.spec.key)
        found = self._read_files([f for i, f in enumerate(files) if i in met]).join(wanted, self.spec.key, "left_semi")
        return found if later is None else self._fold(found, later.join(wanted, self.spec.key, "left_semi"))

    def history(self) -> DataFrame:
        """The commit log: number, run, epoch, committed_at and rows of every epoch ever committed."""
        if not fs.committed_children(self.spark, f"{self.root}/log"):
            return self.spark.createDataFrame([], "number long, run string, epoch long, committed_at timestamp, rows long")
        return self.spark.read.parquet(f"{self.root}/log/*")

    def inspect(self) -> DataFrame:
        """One row: live_rows, snapshots (epochs ever committed, of all runs, retired ones included)."""
        live = self.read_state().agg(F.count_if(~F.col(DELETED)).alias("live_rows"))
        snaps = self.history().agg(F.count_distinct("run", "epoch").alias("snapshots"))
        both = live.unionByName(snaps, allowMissingColumns=True)
        return both.agg(F.max("live_rows").alias("live_rows"), F.max("snapshots").alias("snapshots"))

    # -- upkeep ------------------------------------------------------------------------------------

    def compact(self, drop_tombstones_below_lsn: int | None = None) -> str:
        """Fold the commits after the newest base into a new base, rewriting the files that they touch. A
        tombstone is dropped only below an LSN nothing older than which can still arrive (default: never);
        dropping rewrites every file."""
        base, commits = self.layout()
        files, later = self.files(base), self._read_commits(commits)
        covered = self._last(self.commits())
        if base and not commits:
            covered += 1  # nothing new; a base of its own all the same, for another retention rule
        whole = drop_tombstones_below_lsn is not None
        met = set(range(len(files))) if whole else self._met(later, files) if later is not None else set()
        touched = [f for i, f in enumerate(files) if i in met]
        state = self._fold(self._read_files(touched), later)
        if whole:
            state = state.where(~(F.col(DELETED) & (F.col(LSN) < F.lit(drop_tombstones_below_lsn))))
        rows = state.withColumn(RANGE, range_number(F.col(self.spec.key), [f.least for f in files]))
        most = sum(f.rows for f in touched) + (later.count() if later is not None else 0)
        return self._write_base(covered, rows, most, [f for i, f in enumerate(files) if i not in met])

    def _write_base(self, number: int, rows: DataFrame, most: int, kept: list[File]) -> str:
        """Write ``rows`` (with their ``RANGE``) in files of about ``file_rows`` rows, none over two ranges,
        then the base that names them and the ``kept`` files."""
        key, part = self.spec.key, f"parts/c{number:012d}"
        base = f"{self.root}/base/b{number:012d}"
        dealt = rows.repartitionByRange(max(1, -(-most // self.file_rows)), RANGE, key) if most else rows.limit(0)
        dealt.sortWithinPartitions(RANGE, key).write.mode("overwrite").partitionBy(RANGE).parquet(f"{self.root}/{part}")
        kind = self.spec.column(key).spark_type()
        schema = T.StructType([T.StructField("path", T.StringType()), T.StructField("least", kind),
                               T.StructField("greatest", kind), T.StructField("rows", T.LongType())])
        index = self.spark.createDataFrame([(f.path, f.least, f.greatest, f.rows) for f in kept], schema)
        if most:
            path = F.regexp_extract(F.col("_metadata.file_path"), rf"({part}/.+)$", 1)
            index = index.unionByName(self.spark.read.schema(self.spec.state_schema()).parquet(f"{self.root}/{part}").select(
                path.alias("path"), F.col(key).alias("k")).groupBy("path").agg(
                    F.min("k").alias("least"), F.max("k").alias("greatest"), F.count(F.lit(1)).alias("rows")))
        index.coalesce(1).write.mode("overwrite").parquet(base)
        return base

    def retire(self, keep_bases: int = 1) -> int:
        """Delete the bases before the newest ``keep_bases``, the files that the kept ones do not name, and
        the commits that the oldest kept one covers; returns how many directories and files went. Readers
        that started before may still need them, so run it when none older than the kept bases is left."""
        bases = self.bases()
        if not bases or keep_bases < 1:
            return 0
        kept = bases[-keep_bases:]
        gone = [f"{self.root}/base/b{n:012d}" for n in bases[:-keep_bases]]
        gone += [c.path for c in self.commits() if c.number <= kept[0]]
        named = reduce(set.union, ({f.path for f in self.files(f"{self.root}/base/b{n:012d}")} for n in kept))
        for n in bases[:-keep_bases]:
            gone += [f"{self.root}/{f.path}" for f in self.files(f"{self.root}/base/b{n:012d}") if f.path not in named]
        gone = list(dict.fromkeys(gone))  # old bases may name a file together
        for path in gone:
            fs.remove(self.spark, path)
        return len(gone)

    def upkeep(self, compact_after: int, keep_bases: int = 2) -> bool:
        """Compact once ``compact_after`` commits wait to be folded, then retire; True if it did."""
        if not self.exists() or len(self.layout()[1]) < max(1, compact_after):
            return False
        self.compact()
        self.retire(keep_bases)
        return True
