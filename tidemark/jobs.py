"""Job entry points: ``run`` (stream changes into the state table), ``reconcile`` (compare the
table with the source truth folded from the same log), ``inspect``, ``history`` and ``upkeep``, with exit
codes a scheduler can gate on: 0 parity / success, 1 drift, 2 bad arguments or a rejected event,
3 missing input or engine error.

Only one-row summaries and capped key samples are collected to the driver.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import decode as dc
from .operators import fold as fo
from .operators import reconcile as rc
from .spec import TableSpec, orders_spec
from .streaming import fs
from .streaming import stream as sm
from .streaming.state import StateTable

EXIT_OK, EXIT_DRIFT, EXIT_BAD_INPUT, EXIT_ENGINE = 0, 1, 2, 3


@dataclass
class RunStats:
    delivered: int = 0
    applied: int = 0
    ignored: int = 0
    epochs: int = 0
    live_rows: int = 0


@dataclass
class Verdict:
    rows_source: int = 0
    rows_lake: int = 0
    missing: int = 0
    extra: int = 0
    mismatch: int = 0
    duplicate_in_lake: int = 0
    drift: str = "0.00"
    verdict: str = rc.PARITY
    samples: dict = field(default_factory=dict)

    @property
    def ok(self) -> bool:
        return self.verdict == rc.PARITY


def read_log(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame:
    """Decoded change log from JSON-lines files, strict: a rejected line fails the job.
    The delivery position is ``streaming.stream.FILE_ARRIVAL`` (file order, then line order)."""
    lines = sm.delivered(spark.read.text(path))
    return dc.accepted(dc.decode(lines, spec, keep=sm.FILE_ARRIVAL), "strict")


#: Commits that wait before ``run`` compacts them.
COMPACT_AFTER = 16


def run(spark: SparkSession, stream_path: str, state_root: str, spec: TableSpec | None = None,
        mode: str = fo.MODE_LSN, files_per_trigger: int | None = None,
        checkpoint: str | None = None, bytes_per_trigger: int | None = None,
        batch_size: int | None = None, compact_after: int | None = COMPACT_AFTER) -> RunStats:
    """Merge what is new in the stream, in epochs of ``batch_size`` events if that is given. The counters
    are those of this run: of the epochs it committed, or of the whole log in arrival mode, which folds all
    of it and replaces the table. The state is compacted and retired once ``compact_after`` commits wait."""
    spec = spec or orders_spec()
    fo.check_mode(mode)
    if batch_size is not None and batch_size < 1:
        raise ValueError(f"batch size {batch_size} is below 1")
    if not fs.matches(spark, stream_path):
        raise FileNotFoundError(stream_path)
    state = StateTable(spark, state_root, spec)
    if mode == fo.MODE_LSN:
        checkpoint = checkpoint or f"{state.root}/_checkpoint"
        done: list[int] = []
        stats = f"{state.root}/_stats"
        sm.merge_stream(sm.text_source(spark, stream_path, files_per_trigger, bytes_per_trigger), state, spec, checkpoint,
                        on_error="strict", stats_root=stats, done=done, events_per_epoch=batch_size,
                        compact_after=compact_after).awaitTermination()
        counts = _counted(spark, [sm.epoch_path(stats, sm.run_id(checkpoint), e) for e in done])
    else:
        # Negative control: last arrival wins. A later run has a longer log, so it replaces the table.
        changes = read_log(spark, stream_path, spec)
        state.replace(fo.fold_state(changes, spec, fo.MODE_ARRIVAL, sm.FILE_ARRIVAL))
        seen = changes.count()
        counts = {"seen": seen, "applied": seen}
    info = state.inspect().first() if state.exists() else {"snapshots": 0, "live_rows": 0}
    return RunStats(delivered=counts["seen"], applied=counts["applied"], ignored=counts["seen"] - counts["applied"],
                    epochs=info["snapshots"], live_rows=info["live_rows"])


def _counted(spark: SparkSession, records: list[str]) -> dict[str, int]:
    """Counters summed over the progress records of micro-batches."""
    if not records:
        return {"seen": 0, "applied": 0}
    total = spark.read.schema(sm.STATS).parquet(*records).agg(F.sum("accepted"), F.sum("applied")).first()
    return dict(zip(("seen", "applied"), (n or 0 for n in total)))


def reconcile(spark: SparkSession, stream_path: str, state_root: str,
              spec: TableSpec | None = None, sample: int = rc.SAMPLE_JSON) -> Verdict:
    spec = spec or orders_spec()
    if not fs.matches(spark, stream_path):
        raise FileNotFoundError(stream_path)
    lake = StateTable(spark, state_root, spec).read_live()  # raises if there is no table
    truth = fo.fold_live(read_log(spark, stream_path, spec), spec, fo.MODE_LSN, sm.FILE_ARRIVAL)
    keys = rc.compare(truth, lake, spec).persist()
    try:
        row = rc.summary(keys).first().asDict()
        samples: dict = {c: [] for c in rc.DRIFT_CLASSES}
        for r in rc.samples(keys, spec, sample).orderBy("class", "rn").collect():
            samples[r["class"]].append(r[spec.key])
    finally:
        keys.unpersist()
    row["drift"] = f"{row['drift']:.2f}"
    return Verdict(**row, samples=samples)


def _existing(spark: SparkSession, state_root: str, spec: TableSpec | None) -> StateTable:
    state = StateTable(spark, state_root, spec or orders_spec())
    if not state.exists():
        raise FileNotFoundError(state_root)
    return state


def inspect(spark: SparkSession, state_root: str, spec: TableSpec | None = None) -> dict:
    return _existing(spark, state_root, spec).inspect().first().asDict()


def history(spark: SparkSession, state_root: str, last: int, spec: TableSpec | None = None) -> list[dict]:
    """The ``last`` newest entries of the commit log, newest first."""
    log = _existing(spark, state_root, spec).history()
    return [r.asDict() for r in log.orderBy(F.desc("number"), F.desc("epoch")).limit(last).collect()]


def upkeep(spark: SparkSession, state_root: str, keep_bases: int = 2, drop_tombstones_below_lsn: int | None = None,
           spec: TableSpec | None = None) -> dict:
    """Compact the state table now and retire what the newest ``keep_bases`` bases do not need."""
    state = _existing(spark, state_root, spec)
    waiting = len(state.layout()[1])
    state.compact(drop_tombstones_below_lsn)
    return {"folded": waiting, "retired": state.retire(keep_bases), "files": len(state.files(state.layout()[0]))}


def merge_topic(spark: SparkSession, bootstrap: str, topic: str, table: str, checkpoint: str,
                starting_offsets: str = "earliest", max_offsets_per_trigger: int | None = None,
                available_now: bool = False, spec: TableSpec | None = None) -> None:
    """Run the change topic into a catalog table until it is stopped (or, available now, caught up)."""
    sm.merge_topic(spark, bootstrap, topic, table, checkpoint, spec or orders_spec(), starting_offsets,
                   max_offsets_per_trigger, "strict", available_now).awaitTermination()


# -- rendering -------------------------------------------------------------------------------------

def _table(rows: list[tuple]) -> str:
    """Rows of text in columns, each as wide as its widest cell; the first column to the left."""
    cells = [[f"{c:,}" if isinstance(c, int) else str(c) for c in row] for row in rows]
    wide = [max(len(row[i]) for row in cells) for i in range(len(cells[0]))]
    return "\n".join("  ".join(c.ljust(w) if i == 0 else c.rjust(w) for i, (c, w) in enumerate(zip(row, wide))).rstrip()
                     for row in cells)


def render_stats(s: RunStats, mode: str) -> str:
    return _table([("mode", "events", "applied", "ignored", "epochs", "live rows"),
                   (mode, s.delivered, s.applied, s.ignored, s.epochs, s.live_rows)])


def render_text(v: Verdict, shown: int = rc.SAMPLE_TEXT) -> str:
    """A line for each class of keys that drifted, then the verdict."""
    rows = [("class", "keys", "first keys")]
    rows += [(cls, getattr(v, cls), ", ".join(map(str, v.samples.get(cls, [])[:shown])) or "-") for cls in rc.DRIFT_CLASSES]
    if v.duplicate_in_lake:
        rows.append(("duplicate", v.duplicate_in_lake, "-"))
    sides = f"{v.rows_source:,} keys in the source, {v.rows_lake:,} in the table, {float(v.drift):,.2f} apart"
    return f"{_table(rows)}\n{v.verdict.upper()}: {sides}"


def render_json(v: Verdict) -> str:
    out = asdict(v)
    out["samples"] = {k: vals[:rc.SAMPLE_JSON] for k, vals in v.samples.items()}
    return json.dumps(out, indent=2)
