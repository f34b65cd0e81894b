"""Batches of a number of events, counters of the write pass, and keyed state inside the stream."""

import json

import pytest
from conftest import envelope
from pyspark.sql import functions as F

from tidemark import __main__ as cli
from tidemark import jobs
from tidemark.operators import decode as dc
from tidemark.operators import reconcile as rc
from tidemark.plans import catalog
from tidemark.session import scratch_path
from tidemark.streaming import fs, keyed
from tidemark.streaming import stream as sm
from tidemark.streaming.state import StateTable


def write_files(spark, path, *files):
    for lines in files:
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(path)


def test_batches_of_n_events(spark, spec):
    src, root = scratch_path(spark, "test-n"), scratch_path(spark, "test-n-state")
    # Blank lines are no events; batches go over file ends; the last one is what is left.
    write_files(spark, src, [envelope("c", 1, key=1), "", envelope("c", 2, key=2)], ["  ", envelope("u", 3, key=1)],
                [envelope("u", 2, key=1), envelope("d", 5, key=2), envelope("c", 6, key=3), envelope("u", 7, key=3)])
    stats = jobs.run(spark, src, root, batch_size=3)
    assert (stats.delivered, stats.applied, stats.ignored, stats.epochs, stats.live_rows) == (7, 6, 1, 3, 2)
    log = sorted((r["epoch"], r["rows"]) for r in StateTable(spark, root, spec).history().collect())
    assert log == [(0, 2), (1, 3), (2, 1)]
    # A second run takes what is new, and counts against what the first one stored.
    write_files(spark, src, [envelope("u", 6, key=3), envelope("u", 8, key=3)])
    again = jobs.run(spark, src, root, batch_size=3)
    assert (again.delivered, again.applied, again.ignored, again.epochs) == (2, 1, 1, 4)
    assert jobs.run(spark, src, root, batch_size=3).delivered == 0
    with pytest.raises(ValueError):
        jobs.run(spark, src, root, batch_size=0)


def test_places_of_lines(spark):
    src = scratch_path(spark, "test-cut")
    spark.range(1000).repartitionByRange(5, "id").sortWithinPartitions("id").select(F.col("id").cast("string").alias("value")).write.text(src)
    cut = sm.cut(sm.delivered(spark.read.text(src)), 64, ("_file", "_block", "_row"))
    assert {int(r["value"]): r["_cut"] for r in cut.collect()} == {i: i // 64 for i in range(1000)}


def test_cut_shuffles_no_line(spark):
    src = scratch_path(spark, "test-cut-plan")
    spark.range(1000).repartition(5).select(F.col("id").cast("string").alias("value")).write.text(src)
    cut = sm.cut(sm.delivered(spark.read.text(src)), 64, ("_file", "_block", "_row"))
    assert sorted(r["_place"] for r in cut.collect()) == list(range(1000))
    plan = cut._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan


def test_round_trip_files_are_compressed(spark, monkeypatch):
    sf, path = scratch_path(spark, "test-trip"), scratch_path(spark, "test-trip-files")
    write_orders(spark, sf, 500)
    monkeypatch.setattr(catalog, "scratch_path", lambda *_: path)
    assert catalog.json_round_trip(spark, sf).count() == catalog.log(spark, sf).count()
    written = spark.read.format("binaryFile").load(path).agg(F.sum("length")).first()[0]
    assert written < spark.read.text(path).agg(F.sum(F.length("value"))).first()[0] / 4


def lines_of(spark, rows):
    return spark.createDataFrame(rows, "seq long, value string")


def test_counters_of_the_write_pass_and_their_replay(spark, spec):
    st = StateTable(spark, scratch_path(spark, "test-seen"), spec)
    stats = scratch_path(spark, "test-stats")
    write = sm.epoch_writer(st, spec, "run", ("seq",), "seq", "quarantine", stats_root=stats)
    first = lines_of(spark, [(0, envelope("c", 1, key=1)), (1, envelope("u", 5, key=1)), (2, envelope("u", 4, key=1)), (3, "{"), (4, None)])
    second = lines_of(spark, [(5, envelope("u", 5, key=1)), (6, envelope("d", 6, key=1)), (7, envelope("c", 1, key=2))])
    write(first, 0)
    write(second, 1)

    def told():
        rows = spark.read.schema(sm.STATS).parquet(f"{stats}/*/*").orderBy("epoch").collect()
        return [tuple(r[c] for c in ("epoch", "delivered", "accepted", "skipped", "rejected", "deletes", "max_lsn", "applied", "ignored"))
                for r in rows]

    want = [(0, 5, 3, 1, 1, 0, 5, 2, 1), (1, 3, 3, 0, 0, 1, 6, 2, 1)]
    assert told() == want
    # Lost between the commit and the record: the replay counts against the state before the commit.
    for epoch in (0, 1):
        fs.remove(spark, sm.epoch_path(stats, "run", epoch))
        write((first, second)[epoch], epoch)
        assert told() == want
    assert st.inspect().first()["snapshots"] == 2


def test_keyed_state_survives_a_restart(spark, spec):
    src, root, ckpt = (scratch_path(spark, x) for x in ("test-keyed", "test-keyed-out", "test-keyed-ckpt"))
    write_files(spark, src, [envelope("c", 10, key=1, amount="1"), envelope("d", 20, key=2), envelope("c", 5, key=3, amount="3")])
    before = spark.conf.get(keyed.PROVIDER, None)
    keyed.start(sm.text_source(spark, src), spec, root, ckpt).awaitTermination()
    assert spark.conf.get(keyed.PROVIDER, None) == before
    write_files(spark, src, [envelope("u", 9, key=1, amount="9"), envelope("c", 15, key=2, amount="2"), envelope("u", 6, key=3, amount="4")])
    keyed.start(sm.text_source(spark, src), spec, root, ckpt).awaitTermination()
    state = {r["order_id"]: (r["_lsn"], r["_deleted"], r["amount"] and str(r["amount"])) for r in keyed.read_state(spark, root, spec).collect()}
    assert state == {1: (10, False, "1.00"), 2: (20, True, None), 3: (6, False, "4.00")}
    providers = spark.read.text(f"{ckpt}/offsets/0").collect()
    assert any("RocksDB" in r["value"] for r in providers)


def write_orders(spark, path, n):
    spark.range(n).select(F.col("id").alias("o_orderkey"), (F.col("id") % 9).alias("o_custkey"),
                          (F.col("id") + 0.25).alias("o_totalprice")).write.parquet(f"{path}/orders.parquet")


def test_keyed_stream_renders_images_before_it_splits_the_log(spark):
    """Deletes of the second half whose last image lies in the first, across the middle of the log."""
    sf = scratch_path(spark, "test-halves")
    write_orders(spark, sf, 2000)
    want = catalog.fold_lsn_state(spark, sf)
    got = catalog.stream_state_store(spark, sf).select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_change_files_are_compressed_and_the_store_keeps_few_versions(spark, spec):
    src, root, ckpt = (scratch_path(spark, x) for x in ("test-lines", "test-kept-out", "test-kept-ckpt"))
    lines = [envelope("c", i + 1, key=i) for i in range(500)]
    catalog.write_lines(spark.createDataFrame([(x,) for x in lines], "value string"), src)
    assert spark.read.format("binaryFile").load(src).agg(F.sum("length")).first()[0] < len("".join(lines)) / 4
    keyed.start(sm.text_source(spark, src), spec, root, ckpt).awaitTermination()
    assert keyed.read_state(spark, root, spec).count() == 500
    (conf,) = [r["value"] for r in spark.read.text(f"{ckpt}/offsets/0").collect() if "RocksDB" in r["value"]]
    assert keyed.STORE[keyed.PROVIDER] in conf
    assert fs.matches(spark, f"{ckpt}/state/0/*/*.changelog")


def test_a_write_lists_no_other_commits(spark, spec, monkeypatch):
    """What one commit asks of the file system does not grow with the commits before it."""
    st = StateTable(spark, scratch_path(spark, "test-many"), spec)
    events = dc.accepted(dc.decode(lines_of(spark, [(0, envelope("c", 1))]), spec))
    st.write_epoch(events, 0, "run")
    st.write_epoch(events, 1, "run")
    listed = []
    for name in ("children", "committed_children", "named"):
        def counted(*args, real=getattr(fs, name, lambda *_: [])):
            listed.extend(found := real(*args))
            return found
        monkeypatch.setattr(fs, name, counted, raising=False)
    assert [st.number("run", e) for e in (0, 1, 2)] == [1, 2, None]
    assert st.number("other", 1) is None
    assert st.write_epoch(events, 2, "run") and not st.write_epoch(events, 1, "run")
    assert len(listed) <= 3  # the epochs asked for, found
    assert [c.number for c in st.commits()] == [1, 2, 3]


def test_counting_caches_no_text(spark, spec, monkeypatch):
    cached = []
    frame = type(spark.range(1))
    real = frame.persist
    monkeypatch.setattr(frame, "persist", lambda self, *a: cached.append(self.columns) or real(self, *a))
    st = StateTable(spark, scratch_path(spark, "test-slim"), spec)
    write = sm.epoch_writer(st, spec, "run", ("seq",), "seq", "quarantine", stats_root=scratch_path(spark, "test-slim-stats"))
    write(lines_of(spark, [(0, envelope("c", 1, key=1)), (1, "{")]), 0)
    assert cached and all("value" not in columns for columns in cached)


# -- strict lines ------------------------------------------------------------------------------------

def test_no_line_brings_its_own_sentinel(spark, spec):
    good = envelope("c", 1)
    for extra in (',{"_end":"1"}] junk', ',{"_end":"1"}]' + good, ',{"_end":"1"}', " junk", good, "]", ',"_end"'):
        out = dc.decode(lines_of(spark, [(0, good + extra)]), spec).first()
        assert out["_reject"] == dc.BAD_JSON, extra
    own = good[:-1] + ',"_end":"1"}'  # an unknown field of a single object
    assert dc.decode(lines_of(spark, [(0, own), (1, f'{{"schema":1,"payload":{good}}}')]), spec).where("_reject = 'ok'").count() == 2


# -- digests -----------------------------------------------------------------------------------------

def test_digests_find_what_rows_would(spark, spec):
    base = spark.range(500).select(
        F.col("id").alias("order_id"), F.lit(1).cast("long").alias("customer_id"), F.lit("PAID").alias("status"),
        F.col("id").cast("decimal(18,2)").alias("amount"), F.lit(None).cast("long").alias("updated_ms"))
    other = base.where("order_id <> 7").unionByName(base.where("order_id = 9")).withColumn(
        "amount", F.when(F.col("order_id") == 11, F.lit(0).cast("decimal(18,2)")).otherwise(F.col("amount"))).unionByName(
            base.where("order_id = 3").withColumn("order_id", F.lit(900).cast("long")))
    for lake in (base, other, base.limit(0)):
        for groups in (1, 64, rc.DIGEST_GROUPS):
            assert rc.summary_by_digest(base, lake, spec, groups).first() == rc.summary(rc.compare(base, lake, spec)).first()
    assert rc.summary_by_digest(base.limit(0), base.limit(0), spec).first()["verdict"] == rc.PARITY


def test_parity_compares_no_row(spark, spec):
    base = spark.range(50).select(
        F.col("id").alias("order_id"), F.lit(1).cast("long").alias("customer_id"), F.lit("PAID").alias("status"),
        F.col("id").cast("decimal(18,2)").alias("amount"), F.lit(None).cast("long").alias("updated_ms"))
    out = rc.summary_by_digest(base, base.repartition(3), spec)
    assert out.first()["rows_lake"] == 50
    assert "Range (" not in out._jdf.queryExecution().executedPlan().toString()


# -- commands ----------------------------------------------------------------------------------------

def test_upkeep_history_and_event_batches_as_commands(spark, capsys):
    src, root = scratch_path(spark, "test-cli"), scratch_path(spark, "test-cli-state")
    write_files(spark, src, [envelope("c", i + 1, key=i) for i in range(10)])
    assert cli.main(["run", "--stream", src, "--state", root, "--batch-size", "4"], spark=spark) == 0
    assert "10" in capsys.readouterr().out
    assert cli.main(["upkeep", "--state", root, "--keep-bases", "1"], spark=spark) == 0
    assert capsys.readouterr().out.strip() == "folded=1, retired=1, files=1"
    assert cli.main(["history", "--state", root, "--last", "2"], spark=spark) == 0
    assert len(capsys.readouterr().out.strip().splitlines()) == 2
    assert cli.main(["inspect", "--state", root], spark=spark) == 0
    assert capsys.readouterr().out.strip() == "live_rows=10, snapshots=3"
    assert cli.main(["reconcile", "--stream", src, "--state", root, "--json"], spark=spark) == 0
    assert json.loads(capsys.readouterr().out)["verdict"] == rc.PARITY
    for command in ("upkeep", "history", "inspect"):
        assert cli.main([command, "--state", "/nonexistent/s"], spark=spark) == 3
