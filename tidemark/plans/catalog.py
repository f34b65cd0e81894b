"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame over the given tables.

Every query starts from the fixture change log derived from ``orders`` (``sources.fixture``), so
its work grows with the table. Column names match the SQL in ``plans.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changelog as cl
from ..operators import counters as co
from ..operators import decode as dc
from ..operators import fold as fo
from ..operators import merge as mg
from ..sources import snapshot as snap
from ..streaming import keyed
from ..streaming import stream as sm
from ..streaming.state import StateTable
from ..operators import reconcile as rc
from ..functions.exprs import coerce_text
from ..sources import fixture as fx
from ..session import scratch_path
from ..spec import LSN, Column, TableSpec, orders_spec

SPEC = orders_spec()
ROW = [SPEC.key, *SPEC.value_names, LSN]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def register(fn):
        QUERIES[name] = fn
        return fn
    return register


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.orders_changelog(spark, sf_dir, SPEC)


# -- folds -------------------------------------------------------------------------------------

@query("fold_lsn")
def fold_lsn(spark, sf_dir):
    return fo.fold_live(log(spark, sf_dir), SPEC, fo.MODE_LSN, fx.ARRIVAL)


@query("fold_lsn_state")
def fold_lsn_state(spark, sf_dir):
    return fo.fold_state(log(spark, sf_dir), SPEC, fo.MODE_LSN, fx.ARRIVAL)


@query("fold_arrival")
def fold_arrival(spark, sf_dir):
    return fo.fold_live(log(spark, sf_dir), SPEC, fo.MODE_ARRIVAL, fx.ARRIVAL)


@query("fold_redelivered")
def fold_redelivered(spark, sf_dir):
    """The delivered log plus every event redelivered once more folds to the same state."""
    changes = log(spark, sf_dir)
    again = fx.canonical_log(changes).withColumn("dup", F.lit(2))
    return fo.fold_live(changes.unionByName(again), SPEC, fo.MODE_LSN, fx.ARRIVAL)


@query("fold_order_independent")
def fold_order_independent(spark, sf_dir):
    """Fold the same events under several delivery orders; every live row must come out of
    every ordering (``orderings`` = number of orders that produced it)."""
    changes = log(spark, sf_dir)
    tagged = fx.reorderings(changes, fx.DELIVERY_ORDERINGS)
    state = fo.fold_state(tagged, SPEC, fo.MODE_LSN, fx.ARRIVAL, by=("ordering",))
    return (fo.live_rows(state).groupBy(*ROW)
            .agg(F.count(F.lit(1)).alias("orderings")))


@query("dedup_to_latest")
def dedup_to_latest(spark, sf_dir):
    return fo.dedup_latest(fx.with_batch(log(spark, sf_dir)), SPEC, ("batch",), fx.ARRIVAL)


# -- counters and net changes ------------------------------------------------------------------

def flags(spark, sf_dir):
    return co.applied_flags(fx.with_batch(log(spark, sf_dir)), SPEC, fx.ARRIVAL)


@query("applied_events")
def applied_events(spark, sf_dir):
    return flags(spark, sf_dir).select("slot", "pos", "dup", "batch", SPEC.key, LSN, "op", "applied")


@query("merge_stats")
def merge_stats(spark, sf_dir):
    return co.merge_stats(flags(spark, sf_dir))


@query("batch_stats")
def batch_stats(spark, sf_dir):
    return co.batch_stats(flags(spark, sf_dir))


@query("pipeline_stats")
def pipeline_stats(spark, sf_dir):
    state = fo.fold_state(log(spark, sf_dir), SPEC, fo.MODE_LSN, fx.ARRIVAL)
    return co.run_stats(flags(spark, sf_dir), state)


@query("batch_net_changes")
def batch_net_changes(spark, sf_dir):
    return co.batch_net_changes(fx.with_batch(log(spark, sf_dir)), SPEC, fx.ARRIVAL)


@query("batch_changed_keys")
def batch_changed_keys(spark, sf_dir):
    return batch_net_changes(spark, sf_dir).select("batch", SPEC.key)


@query("batch_against_state")
def batch_against_state(spark, sf_dir):
    probed = co.against_prior_batches(fx.with_batch(log(spark, sf_dir)), SPEC)
    return probed.select("slot", "pos", "dup", "batch", SPEC.key, LSN,
                         "stored_lsn", "stored_deleted", "verdict")


# -- change-log images, envelopes and decode ---------------------------------------------------

IMAGE_COLS = [SPEC.key, *SPEC.value_names]


@query("changelog_before_after")
def changelog_before_after(spark, sf_dir):
    imaged = cl.with_before_images(fx.canonical_log(log(spark, sf_dir)), SPEC)
    return imaged.select(SPEC.key, LSN, "op", *[cl.BEFORE + n for n in SPEC.value_names],
                         *SPEC.value_names)


def envelopes(spark, sf_dir, changes=None):
    changes = changes if changes is not None else log(spark, sf_dir)
    return cl.to_envelopes(cl.with_before_images(changes, SPEC), SPEC, keep=fx.ARRIVAL)


DECODED = [*fx.ARRIVAL, SPEC.key, *SPEC.value_names, "op", LSN, "ts_ms"]


@query("decode_envelope")
def decode_envelope(spark, sf_dir):
    decoded = dc.decode(envelopes(spark, sf_dir), SPEC, keep=fx.ARRIVAL)
    return dc.accepted(decoded, "strict").select(*DECODED)


@query("decode_wrapped")
def decode_wrapped(spark, sf_dir):
    env = envelopes(spark, sf_dir)
    wrapped = env.select(*fx.ARRIVAL, F.concat(
        F.lit('{"schema":{"type":"struct","name":"envelope"},"payload":'), F.col("value"),
        F.lit("}")).alias("value"))
    decoded = dc.decode(wrapped, SPEC, keep=fx.ARRIVAL)
    return dc.accepted(decoded, "strict").select(*DECODED)


# Fixed value: lines of a change file at most. The files are compressed, so each is read by one task.
LINES_PER_FILE = 50_000


@query("json_round_trip")
def json_round_trip(spark, sf_dir):
    """Envelopes written as JSON lines to the shared folder, read back and decoded."""
    path = scratch_path(spark, "jsonl")
    envelopes(spark, sf_dir).write.mode("overwrite").option("compression", "gzip").option(
        "maxRecordsPerFile", LINES_PER_FILE).json(path)
    lines = spark.read.json(path, schema="slot BIGINT, pos BIGINT, dup INT, value STRING")
    decoded = dc.decode(lines, SPEC, keep=fx.ARRIVAL)
    return dc.accepted(decoded, "strict").select(*DECODED)


@query("decode_op_counts")
def decode_op_counts(spark, sf_dir):
    decoded = dc.accepted(dc.decode(envelopes(spark, sf_dir), SPEC), "strict")
    return decoded.groupBy("op").agg(F.count(F.lit(1)).alias("n"))


@query("decode_event_time")
def decode_event_time(spark, sf_dir):
    """Envelope ts_ms zero or absent on some events, source ts_ms absent on some: the event
    time falls back envelope -> source -> 0."""
    changes = log(spark, sf_dir)
    env_ts = (F.when(F.col("pos") % 4 == 0, F.lit(0)).when(F.col("pos") % 4 == 1, F.lit(None))
              .otherwise(F.col("ts_ms")).cast("bigint"))
    src_ts = F.when(F.col("pos") % 8 == 1, F.lit(None)).otherwise(F.col("ts_ms")).cast("bigint")
    imaged = cl.with_before_images(changes, SPEC)
    env = F.struct(
        F.col("op"), F.when(F.col("op") == "d", F.struct(*IMAGE_COLS)).alias("before"),
        F.when(F.col("op") != "d", F.struct(*IMAGE_COLS)).alias("after"),
        env_ts.alias("ts_ms"),
        F.struct(F.lit(SPEC.name).alias("table"), F.col(LSN).alias("lsn"), src_ts.alias("ts_ms")).alias("source"))
    lines = imaged.select(*fx.ARRIVAL, F.to_json(env).alias("value"))
    decoded = dc.accepted(dc.decode(lines, SPEC, keep=fx.ARRIVAL), "strict")
    return decoded.select(*fx.ARRIVAL, SPEC.key, LSN, "ts_ms")


# Fault injection for decode_rejects, by position modulo FAULT_EVERY.
FAULT_EVERY = 997
FAULTS = {1: "bad_json", 2: "unknown_op", 3: "bad_lsn", 4: "no_image", 5: "no_key",
          6: "bad_value", 7: "blank", 8: "null", 9: "trailing text", 10: "two envelopes",
          11: "own sentinel and trailing text", 12: "own sentinel and a second envelope"}
OWN_SENTINEL = ',{"_end":"1"}]'


@query("decode_rejects")
def decode_rejects(spark, sf_dir):
    """Every delivered line decoded after faults are injected into some of them; count per
    reason (blank and null lines are skipped, not rejected)."""
    fault = F.col("pos") % FAULT_EVERY
    changes = log(spark, sf_dir)
    imaged = cl.with_before_images(changes, SPEC)
    is_del = F.col("op") == "d"
    key_or_null = F.when(fault == 5, F.lit(None)).otherwise(F.col(SPEC.key))
    bkey_or_null = F.when(fault == 5, F.lit(None)).otherwise(F.col(cl.BEFORE + SPEC.key))
    amount = F.when(fault == 6, F.lit("abc")).otherwise(F.col("amount").cast("string"))
    after = F.struct(key_or_null.alias(SPEC.key), "customer_id", "status",
                     amount.alias("amount"), "updated_ms")
    before = F.struct(bkey_or_null.alias(SPEC.key),
                      *[F.col(cl.BEFORE + n).alias(n) for n in SPEC.value_names])
    env = F.struct(
        F.when(fault == 2, F.lit("x")).otherwise(F.col("op")).alias("op"),
        F.when(F.col(cl.BEFORE + SPEC.key).isNotNull() & ~((fault == 4) & is_del), before).alias("before"),
        F.when(~is_del & (fault != 4), after).alias("after"),
        F.col("ts_ms"),
        F.struct(F.lit(SPEC.name).alias("table"),
                 F.when(fault == 3, F.lit("x1")).otherwise(F.col(LSN).cast("string")).alias("lsn"),
                 F.col("ts_ms")).alias("source"))
    rendered = imaged.select("pos", F.to_json(env).alias("_t"))
    truncated = F.expr("substring(_t, 1, length(_t) - 1)")
    lines = rendered.select(
        F.when(fault == 1, truncated).when(fault == 7, F.lit("   ")).when(fault == 8, F.lit(None))
        .when(fault == 9, F.concat("_t", F.lit(" junk"))).when(fault == 10, F.concat("_t", "_t"))
        .when(fault == 11, F.concat("_t", F.lit(OWN_SENTINEL + " junk"))).when(fault == 12, F.concat("_t", F.lit(OWN_SENTINEL), "_t"))
        .otherwise(F.col("_t")).alias("value"))
    return dc.reject_counts(dc.decode(lines, SPEC)).select("reason", "n")


# -- typed projection and reconciliation ---------------------------------------------------------

@query("typed_projection")
def typed_projection(spark, sf_dir):
    """Upsert images sent as text with a third decimal place, coerced back onto the spec:
    ints via try_cast, money rounded half-even ('12.345' -> 12.34, '12.355' -> 12.36)."""
    changes = log(spark, sf_dir).where(F.col("op") != "d")
    text = {
        "customer_id": F.col("customer_id").cast("string"),
        "status": F.col("status"),
        "amount": (F.col("amount") + F.lit(0.005).cast("decimal(4,3)")).cast("decimal(18,3)").cast("string"),
        "updated_ms": F.col("updated_ms").cast("string"),
    }
    return changes.select(*fx.ARRIVAL, SPEC.key, *[
        coerce_text(text[n], SPEC.column(n)).alias(n) for n in SPEC.value_names])


def truth(spark, sf_dir):
    return fo.fold_live(log(spark, sf_dir), SPEC, fo.MODE_LSN, fx.ARRIVAL)


def arrival_lake(spark, sf_dir):
    """The lake a last-arrival-wins consumer would have written (the negative control)."""
    return fo.fold_live(log(spark, sf_dir), SPEC, fo.MODE_ARRIVAL, fx.ARRIVAL)


def drift_keys(spark, sf_dir):
    return rc.compare(truth(spark, sf_dir), arrival_lake(spark, sf_dir), SPEC)


# Fixed value: the lake for recon_missing lost every key of one partition out of this many.
LOST_PARTITIONS = 101


@query("canonical_rows")
def canonical_rows(spark, sf_dir):
    src = rc.canonical_rows(truth(spark, sf_dir), SPEC).select(F.lit("source").alias("side"), "*")
    lake = rc.canonical_rows(arrival_lake(spark, sf_dir), SPEC).select(F.lit("lake").alias("side"), "*")
    return src.unionByName(lake)


@query("recon_keys")
def recon_keys(spark, sf_dir):
    return drift_keys(spark, sf_dir).select(SPEC.key, "class", "drift")


@query("recon_missing")
def recon_missing(spark, sf_dir):
    """Truth against a correct lake that lost one key partition: those live keys are missing."""
    t = truth(spark, sf_dir)
    lossy = t.where(F.col(SPEC.key) % LOST_PARTITIONS != 0)
    keys = rc.compare(t, lossy, SPEC)
    return keys.where(F.col("class") == rc.MISSING).select(SPEC.key, "drift")


@query("recon_extra")
def recon_extra(spark, sf_dir):
    return drift_keys(spark, sf_dir).where(F.col("class") == rc.EXTRA).select(SPEC.key, "drift")


@query("recon_mismatch")
def recon_mismatch(spark, sf_dir):
    return (drift_keys(spark, sf_dir).where(F.col("class") == rc.MISMATCH)
            .select(SPEC.key, "source_value", "lake_value", "drift"))


@query("recon_summary")
def recon_summary(spark, sf_dir):
    return rc.summary(drift_keys(spark, sf_dir))


@query("recon_drift")
def recon_drift(spark, sf_dir):
    return rc.drift_by_class(drift_keys(spark, sf_dir))


@query("recon_samples")
def recon_samples(spark, sf_dir):
    return rc.samples(drift_keys(spark, sf_dir), SPEC).withColumn("rn", F.col("rn").cast("int"))


# -- guarded merge, state table, streaming -------------------------------------------------------

def halves(changes: DataFrame):
    """Split a batched log at the middle batch (a scalar subquery, no driver round trip)."""
    cut = F.floor(changes.agg(F.max("batch")).scalar() / F.lit(2))
    return changes.where(F.col("batch") < cut), changes.where(F.col("batch") >= cut)


@query("merge_guarded")
def merge_guarded(spark, sf_dir):
    """State folded from the first half of the batches, then the rest merged in with the LSN
    guard: late lower-LSN events of the second half must neither overwrite nor resurrect."""
    early, late = halves(fx.with_batch(log(spark, sf_dir)))
    state = fo.fold_state(early, SPEC, fo.MODE_LSN, fx.ARRIVAL)
    return mg.merge_guarded(state, late, SPEC, fx.ARRIVAL)


@query("apply_changes")
def apply_changes(spark, sf_dir):
    """Live table of the first half, then the second half's net changes applied as a sink
    would: delete changed keys, insert upserted rows."""
    early, late = halves(fx.with_batch(log(spark, sf_dir)))
    state = fo.fold_state(early, SPEC, fo.MODE_LSN, fx.ARRIVAL)
    changes = mg.net_changes(state, late, SPEC, fx.ARRIVAL)
    return mg.apply_changes(fo.live_rows(state), changes, SPEC)


def bulk_state(spark, sf_dir) -> StateTable:
    st = StateTable(spark, scratch_path(spark, "state"), SPEC)
    st.write_epochs(fx.with_batch(log(spark, sf_dir)), "batch", "bulk", fx.ARRIVAL)
    return st


@query("state_read_live")
def state_read_live(spark, sf_dir):
    return bulk_state(spark, sf_dir).read_live()


@query("inspect_table")
def inspect_table(spark, sf_dir):
    return bulk_state(spark, sf_dir).inspect()


# Fixed value: sequential rounds of merge_microbatches.
ROUNDS = 4


@query("merge_microbatches")
def merge_microbatches(spark, sf_dir):
    """The log merged round by round into the state table, one committed epoch per round."""
    changes = fx.with_batch(log(spark, sf_dir))
    last = changes.agg(F.max("batch")).scalar()
    rnd = F.floor(F.col("batch") * F.lit(ROUNDS) / (last + F.lit(1)))
    st = StateTable(spark, scratch_path(spark, "state"), SPEC)
    for r in range(ROUNDS):
        st.write_epoch(changes.where(rnd == r), r, "seq", fx.ARRIVAL)
    return st.read_live()


@query("resolve_on_read")
def resolve_on_read(spark, sf_dir):
    """Append-only epochs resolved at read time: half the log appended and compacted into a
    base, the other half appended on top."""
    early, late = halves(fx.with_batch(log(spark, sf_dir)))
    st = StateTable(spark, scratch_path(spark, "state"), SPEC)
    st.write_epochs(early, "batch", "a", fx.ARRIVAL)
    st.compact()
    st.write_epochs(late, "batch", "b", fx.ARRIVAL)
    return st.read_live()


@query("bootstrap_from_snapshot")
def bootstrap_from_snapshot(spark, sf_dir):
    """An initial snapshot (live rows at LSN S, as 'r' events) plus the stream of changes after
    S fold to the same table as the whole log."""
    changes = log(spark, sf_dir)
    cut = F.floor(changes.agg(F.max(LSN)).scalar() / F.lit(2))
    before = fx.canonical_log(changes).where(F.col(LSN) <= cut)
    snapshot = snap.snapshot_events(fo.live_rows(fo.fold_state(before, SPEC, fo.MODE_LSN, fx.ARRIVAL)),
                                    SPEC, cut, fx.ARRIVAL)
    stream = changes.where(F.col(LSN) > cut)
    return fo.fold_live(snapshot.unionByName(stream, allowMissingColumns=True), SPEC,
                        fo.MODE_LSN, fx.ARRIVAL)


# Fixed value: input bytes of a micro-batch of the streaming queries.
BYTES_PER_TRIGGER = 32 << 20


def stream_into(spark, src_dir: str, st: StateTable, checkpoint: str) -> None:
    q = sm.merge_stream(sm.text_source(spark, src_dir, max_bytes_per_trigger=BYTES_PER_TRIGGER), st, SPEC,
                        checkpoint, on_error="strict")
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def write_lines(lines, path: str) -> None:
    """Add ``value`` lines to the change files in ``path``."""
    lines.select("value").write.mode("append").option("compression", "gzip").option(
        "maxRecordsPerFile", LINES_PER_FILE).text(path)


def write_change_files(spark, sf_dir) -> str:
    """The envelopes as text files, in their natural partitions: the merge does not
    depend on the order of delivery, so they need not be sorted into files."""
    src_dir = scratch_path(spark, "changes")
    write_lines(envelopes(spark, sf_dir), src_dir)
    return src_dir


@query("stream_merge")
def stream_merge(spark, sf_dir):
    """Change files streamed (availableNow) through decode and per-epoch merge into the state."""
    src_dir = write_change_files(spark, sf_dir)
    st = StateTable(spark, scratch_path(spark, "state"), SPEC)
    stream_into(spark, src_dir, st, scratch_path(spark, "ckpt"))
    return st.read_live()


@query("stream_replay")
def stream_replay(spark, sf_dir):
    """The same stream run, restarted on its checkpoint (nothing new: no-op), compacted, then
    replayed in full under a fresh checkpoint (all duplicates): the table must not change."""
    src_dir = write_change_files(spark, sf_dir)
    st = StateTable(spark, scratch_path(spark, "state"), SPEC)
    ckpt = scratch_path(spark, "ckpt")
    stream_into(spark, src_dir, st, ckpt)
    stream_into(spark, src_dir, st, ckpt)
    st.compact()
    stream_into(spark, src_dir, st, scratch_path(spark, "ckpt"))
    return st.read_live()


@query("recon_parity")
def recon_parity(spark, sf_dir):
    """The reconciliation verdict for a correctly merged table: the state table written epoch by
    epoch from the delivered log against the truth folded from the same log."""
    lake = bulk_state(spark, sf_dir).read_live()
    return rc.summary(rc.compare(truth(spark, sf_dir), lake, SPEC))


# -- Kafka coordinates, several runs, streaming verdicts, a second table -------------------------

# Partitions of the change topic; offsets rise with the slot within a partition.
TOPIC_PARTITIONS = 4
KAFKA = ("partition", "offset")


def topic(spark, sf_dir):
    """The log as a change topic keyed by the primary key: arrival ``(partition, offset)``."""
    step = F.lit(2 * fx.EVENTS_PER_KEY)
    return (fx.with_batch(log(spark, sf_dir))
            .withColumn("partition", (F.col(SPEC.key) % TOPIC_PARTITIONS).cast("int"))
            .withColumn("offset", F.col("slot") * step + (F.col("pos") % fx.EVENTS_PER_KEY) * 2 + F.col("dup")))


@query("applied_events_partitioned")
def applied_events_partitioned(spark, sf_dir):
    flags_ = co.applied_flags(topic(spark, sf_dir), SPEC, KAFKA, position="offset")
    return flags_.select(*KAFKA, SPEC.key, LSN, "applied")


@query("merge_batches_kafka_shape")
def merge_batches_kafka_shape(spark, sf_dir):
    """What the catalog writer does for each batch of a topic: one change per key, merged by LSN."""
    latest = fo.dedup_latest(topic(spark, sf_dir), SPEC, ("batch",), KAFKA)
    return fo.fold_live(latest, SPEC, fo.MODE_LSN, ("batch",))


@query("state_two_runs")
def state_two_runs(spark, sf_dir):
    """Two runs whose epochs both start at 0: the second also redelivers events of the first with
    their LSN and another payload, which must change nothing, before and after compaction."""
    early, late = halves(fx.with_batch(log(spark, sf_dir)))
    forged = early.where((F.col("pos") % fx.REDELIVER_EVERY == 0) & (F.col("op") != "d")).withColumn(
        "amount", (F.col("amount") + 1000).cast("decimal(18,2)")).withColumn("batch", F.lit(0).cast("bigint"))
    st = StateTable(spark, scratch_path(spark, "state"), SPEC)
    st.write_epochs(early, "batch", "first", fx.ARRIVAL)
    st.write_epochs(late.withColumn("batch", F.col("batch") % 3).unionByName(forged), "batch", "second", fx.ARRIVAL)
    st.compact()
    st.retire()
    st.write_epoch(forged, 0, "third", fx.ARRIVAL)
    return st.read_live()


def rounds(spark, sf_dir):
    changes = fx.with_batch(log(spark, sf_dir))
    last = changes.agg(F.max("batch")).scalar()
    return changes.withColumn("round", F.floor(F.col("batch") * F.lit(ROUNDS) / (last + F.lit(1))).cast("int"))


@query("epoch_verdicts")
def epoch_verdicts(spark, sf_dir):
    """Per micro-batch, its events by their verdict against the state stored before it, and how many
    of them were applied (the stored state and earlier events of the batch both count)."""
    changes = rounds(spark, sf_dir)
    st = StateTable(spark, scratch_path(spark, "state"), SPEC)
    out = None
    for r in range(ROUNDS):
        batch = changes.where(F.col("round") == r)
        stored = st.read_state() if r else spark.createDataFrame([], SPEC.state_schema())
        seen = co.applied_to_state(co.applied_flags(batch, SPEC, fx.ARRIVAL), stored, SPEC)
        counts = seen.groupBy("round", "verdict").agg(F.count(F.lit(1)).alias("n"), F.count_if("applied").alias("n_applied"))
        out = counts if out is None else out.unionByName(counts)
        st.write_epoch(batch, r, "seq", fx.ARRIVAL)
    return out


@query("decode_before_images")
def decode_before_images(spark, sf_dir):
    """The prior images that the envelopes carry, as decoded and typed from the text."""
    decoded = dc.accepted(dc.decode(envelopes(spark, sf_dir), SPEC, keep=fx.ARRIVAL, before=True), "strict")
    return decoded.select(*fx.ARRIVAL, LSN, *[dc.BEFORE + n for n in SPEC.column_names])


TICKETS = TableSpec("tickets", "ticket", (Column("ticket", "str"), Column("opened", "ts"), Column("note", "str"),
                                          Column("fee", "decimal", 3)), "fee")


@query("fold_second_spec")
def fold_second_spec(spark, sf_dir):
    """Another table through JSON and back: a string key, a timestamp, money of three places. Each order
    is a ticket of two versions, sent in reverse; every fifth one is deleted in the second."""
    orders = fx.read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("bigint").alias("k"), F.col(
        "o_totalprice").cast("decimal(18,2)").alias("p"), F.explode(F.array(F.lit(1), F.lit(0))).alias("v"))
    k, v = F.col("k"), F.col("v")
    gone = (v == 1) & (k % 5 == 0)
    image = F.struct(
        F.concat(F.lit("T-"), k.cast("string")).alias("ticket"), (F.lit(1_600_000_000_000) + k * 1000 + v).alias("opened"),
        F.when(k % 2 == 0, F.lit("even \"quoted\"")).alias("note"),
        ((F.col("p") + v) / 8).cast("decimal(18,6)").cast("string").alias("fee"))
    env = F.struct(F.when(gone, F.lit("d")).otherwise(F.lit("u")).alias("op"), F.when(gone, image).alias("before"),
                   F.when(~gone, image).alias("after"), F.struct((k * 2 + v).alias("lsn")).alias("source"))
    lines = orders.select(F.to_json(env).alias("value"), k.alias("row"))
    changes = dc.accepted(dc.decode(lines, TICKETS, keep=("row",)), "strict")
    return fo.fold_live(changes, TICKETS, fo.MODE_LSN, ("row",))


# -- state by key ranges, commit log, keyed streams, event batches, digests ------------------------

# Fixed value: files that a base of the queries below is cut into, whatever its size.
BASE_FILES = 16


def ranged_state(spark, changes) -> StateTable:
    """An empty state table whose bases have about ``BASE_FILES`` files for the keys of ``changes``."""
    keys = changes.agg(F.approx_count_distinct(SPEC.key)).first()[0]  # one row
    return StateTable(spark, scratch_path(spark, "state"), SPEC, file_rows=max(1, keys // BASE_FILES))


@query("probe_pruned")
def probe_pruned(spark, sf_dir):
    """The last round's events next to the state that the rounds before it left, compacted: of that only the
    files are read that the round's keys can meet."""
    changes = rounds(spark, sf_dir)
    st = ranged_state(spark, changes)
    st.write_epoch(changes.where(F.col("round") < ROUNDS - 2), 0, "seq", fx.ARRIVAL)
    st.compact()
    st.write_epoch(changes.where(F.col("round") == ROUNDS - 2), 1, "seq", fx.ARRIVAL)
    batch = changes.where(F.col("round") == ROUNDS - 1)
    probed = co.probe_state(batch, st.probe(batch), SPEC)
    return probed.select(*fx.ARRIVAL, SPEC.key, LSN, "stored_lsn", "stored_deleted", "verdict")


@query("compact_incremental")
def compact_incremental(spark, sf_dir):
    """Rounds merged with a compaction after each but the last, which rewrites the files it touches, and
    retirement of what the newest base does not name."""
    changes = rounds(spark, sf_dir)
    st = ranged_state(spark, changes)
    for r in range(ROUNDS):
        st.write_epoch(changes.where(F.col("round") == r), r, "seq", fx.ARRIVAL)
        if r < ROUNDS - 1:
            st.compact()
            st.retire()
    return st.read_state()


# Fixed value: the commit that state_as_of reads at.
AS_OF = 2


@query("state_as_of")
def state_as_of(spark, sf_dir):
    """The table, tombstones included, as it was after commit ``AS_OF``, read after later commits and a
    compaction that covers them."""
    changes = rounds(spark, sf_dir)
    st = ranged_state(spark, changes)
    for r in range(ROUNDS):
        st.write_epoch(changes.where(F.col("round") == r), r, "seq", fx.ARRIVAL)
        if r in (0, ROUNDS - 2):
            st.compact()
    return st.read_state(as_of=AS_OF)


@query("snapshot_history")
def snapshot_history(spark, sf_dir):
    """The commit log of two runs after their commits were compacted and retired: a bulk load, then rounds."""
    changes = rounds(spark, sf_dir)
    st = ranged_state(spark, changes)
    st.write_epochs(changes.where("round < 2"), "batch", "load", fx.ARRIVAL)
    for r in range(2, ROUNDS):
        st.write_epoch(changes.where(F.col("round") == r), r, "seq", fx.ARRIVAL)
    st.compact()
    st.retire()
    return st.history().select("number", "run", "epoch", "rows")


@query("stream_state_store")
def stream_state_store(spark, sf_dir):
    """The log through a streaming aggregation that keeps each key's state in Spark's state store: half of
    the change files, then, restarted on its checkpoint, the other half. The latest output of a key counts,
    so late changes of the second half must lose against state of the first. The envelopes are rendered
    before the log is split, as the prior image of a change may lie in the other half."""
    src, root, ckpt, rendered = (scratch_path(spark, label) for label in ("changes", "keyed", "ckpt", "rendered"))
    imaged = cl.with_before_images(fx.with_batch(log(spark, sf_dir)), SPEC)
    cl.to_envelopes(imaged, SPEC, keep=("batch",)).write.option("compression", "zstd").parquet(rendered)
    for part in halves(spark.read.schema("batch BIGINT, value STRING").parquet(rendered)):
        write_lines(part, src)
        run = keyed.start(sm.text_source(spark, src, max_bytes_per_trigger=BYTES_PER_TRIGGER), SPEC, root, ckpt, "strict")
        run.awaitTermination()
    return keyed.read_state(spark, root, SPEC)


@query("epoch_counters")
def epoch_counters(spark, sf_dir):
    """Counters of each round, observed in the pass that commits it to the state table."""
    changes = rounds(spark, sf_dir)
    imaged = cl.to_envelopes(cl.with_before_images(changes, SPEC), SPEC, keep=(*fx.ARRIVAL, "round"))
    st = ranged_state(spark, changes)
    stats, src = scratch_path(spark, "stats"), scratch_path(spark, "rounds")
    imaged.write.partitionBy("round").parquet(src)  # rendered once, read by round
    imaged = spark.read.schema(imaged.schema).parquet(src)
    write = sm.epoch_writer(st, SPEC, "seq", fx.ARRIVAL, "slot", "strict", stats_root=stats, compact_after=2)
    for r in range(ROUNDS):
        write(imaged.where(F.col("round") == r).drop("round"), r)
    return spark.read.schema(sm.STATS).parquet(f"{stats}/*/*").select(
        "epoch", "delivered", "accepted", "rejected", "deletes", "max_lsn", "applied", "ignored")


# Fixed value: events of a batch of batches_of_500.
EVENTS_PER_BATCH = 500
NAME_ARRIVAL = ("_file", "_block", "_row")


@query("batches_of_500")
def batches_of_500(spark, sf_dir):
    """Change files in order of arrival, cut into batches of 500 events each in file order: counters per batch."""
    src = scratch_path(spark, "changes")
    # As many ranges as Spark finds fit, and rendered after the sort: images are shorter than their text.
    sorted_ = cl.with_before_images(log(spark, sf_dir), SPEC).repartitionByRange(*fx.ARRIVAL).sortWithinPartitions(*fx.ARRIVAL)
    write_lines(cl.to_envelopes(sorted_, SPEC), src)
    lines = sm.cut(sm.delivered(spark.read.text(src)), EVENTS_PER_BATCH, NAME_ARRIVAL)
    events = dc.accepted(dc.decode(lines, SPEC, keep=("_place", "_cut")), "strict")
    return co.batch_stats(co.applied_flags(events, SPEC, ("_place",)), "_cut").withColumnRenamed("_cut", "batch")


@query("recon_by_digest")
def recon_by_digest(spark, sf_dir):
    """The verdict on the last-arrival-wins lake, comparing key by key only where digests differ."""
    return rc.summary_by_digest(truth(spark, sf_dir), arrival_lake(spark, sf_dir), SPEC)


@query("recon_by_digest_parity")
def recon_by_digest_parity(spark, sf_dir):
    """The verdict on a correctly merged table, from digests alone."""
    return rc.summary_by_digest(truth(spark, sf_dir), bulk_state(spark, sf_dir).read_live(), SPEC)
