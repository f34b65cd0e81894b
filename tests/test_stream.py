import re
import time

from conftest import envelope
from test_fold import changes

from tidemark import jobs
from tidemark.operators import counters as co
from tidemark.operators import fold as fo
from tidemark.session import scratch_path
from tidemark.streaming import stream as sm
from tidemark.streaming.state import StateTable


def test_probe_state_prunes_and_classifies(spark, spec):
    state = fo.fold_state(changes(spark, [(1, 10, "u", 1), (2, 20, "d", None)]), spec, "lsn", ("seq",))
    batch = changes(spark, [(1, 5, "u", 2), (1, 11, "u", 3), (2, 20, "d", None), (3, 1, "c", 4)])
    got = sorted((r["order_id"], r["_lsn"], r["stored_lsn"], r["verdict"])
                 for r in co.probe_state(batch, state, spec).collect())
    assert got == [(1, 5, 10, "stale"), (1, 11, 10, "apply"), (2, 20, 20, "stale"), (3, 1, None, "new")]


def test_stream_with_rejects_stats_and_replay(spark, spec):
    src = scratch_path(spark, "test-stream-src")
    files = [[envelope("c", 1, key=1), envelope("c", 2, key=2), "not json"],
             [envelope("u", 5, key=1, amount="3.00"), envelope("d", 6, key=2), ""],
             [envelope("u", 4, key=1, amount="9.00"), envelope("u", 3, key=2, amount="8.00")]]
    for i, lines in enumerate(files):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
            .write.text(f"{src}/part{i}")
    root = scratch_path(spark, "test-stream-state")
    st = StateTable(spark, root, spec)
    ckpt = scratch_path(spark, "test-stream-ckpt")
    for _ in range(2):  # second run: restart on the same checkpoint, nothing new
        q = sm.merge_stream(sm.text_source(spark, f"{src}/*", 1), st, spec, ckpt,
                            rejects_root=f"{root}/_rejects", stats_root=f"{root}/_stats")
        q.awaitTermination()
    live = {r["order_id"]: str(r["amount"]) for r in st.read_live().collect()}
    assert live == {1: "3.00"}
    stats = spark.read.parquet(f"{root}/_stats/*/*").agg(
        {"delivered": "sum", "accepted": "sum", "rejected": "sum", "skipped": "sum"}).first()
    assert (stats["sum(delivered)"], stats["sum(accepted)"], stats["sum(rejected)"],
            stats["sum(skipped)"]) == (8, 6, 1, 1)
    assert spark.read.parquet(f"{root}/_rejects/*/*").count() == 1
    # full replay under a fresh checkpoint: only duplicates, same table
    q = sm.merge_stream(sm.text_source(spark, f"{src}/*", 2), st, spec, scratch_path(spark, "c2"))
    q.awaitTermination()
    assert {r["order_id"]: str(r["amount"]) for r in st.read_live().collect()} == live


def test_file_order_is_delivery_order(spark, spec):
    """A small file delivered first, a larger one after it: arrival and counters follow that order."""
    src = scratch_path(spark, "test-order")
    first = [envelope("c", 20, key=1, amount="20.00")]
    second = [envelope("c", 10, key=1, amount="10.00")] + [envelope("c", 100 + k, key=k) for k in range(2, 52)]
    for i, lines in enumerate((first, second)):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{src}/p{i}")
        time.sleep(1.1)  # file times of some stores have whole seconds
    stats = jobs.run(spark, f"{src}/*", scratch_path(spark, "test-order-lsn"))
    assert (stats.delivered, stats.applied, stats.ignored) == (52, 51, 1)
    root = scratch_path(spark, "test-order-arrival")
    jobs.run(spark, f"{src}/*", root, mode="arrival")
    live = StateTable(spark, root, spec).read_live()
    assert str(live.where("order_id = 1").first()["amount"]) == "10.00"
    # a third file: the next arrival run takes it, and an LSN run counts only what is new
    spark.createDataFrame([(envelope("u", 5, key=1, amount="7.00"),)], "value string").write.text(f"{src}/p2")
    jobs.run(spark, f"{src}/*", root, mode="arrival")
    assert str(StateTable(spark, root, spec).read_live().where("order_id = 1").first()["amount"]) == "7.00"


def test_each_run_counts_its_own_epochs(spark, spec):
    src, root = scratch_path(spark, "test-runs"), scratch_path(spark, "test-runs-state")
    spark.createDataFrame([(envelope("c", k, key=k),) for k in range(1, 21)], "value string").coalesce(1).write.text(f"{src}/a")
    assert jobs.run(spark, f"{src}/*", root).delivered == 20
    spark.createDataFrame([(envelope("u", 5, key=9, amount="1.00"),), (envelope("u", 50, key=3),)], "value string").coalesce(
        1).write.text(f"{src}/b")
    again = jobs.run(spark, f"{src}/*", root)
    assert (again.delivered, again.applied, again.ignored, again.live_rows) == (2, 1, 1, 20)
    assert jobs.run(spark, f"{src}/*", root).delivered == 0


def test_one_file_as_input(spark, spec):
    src = scratch_path(spark, "test-one")
    spark.createDataFrame([(envelope("c", 1),)], "value string").coalesce(1).write.text(src)
    name = spark.read.text(src).select("_metadata.file_path").first()[0]
    assert jobs.run(spark, name, scratch_path(spark, "test-one-state")).live_rows == 1


def test_catalog_writer_merges_one_change_per_key(spark, spec):
    said = []

    def run_sql(session, text):
        session.sql("EXPLAIN " + text)  # parses; running it needs a catalog with row-level operations
        view = re.search(r"USING (\w+) s", text)[1]
        said.append([(r["order_id"], r["op"], r["_lsn"]) for r in session.table(view).orderBy("order_id").collect()])

    lines = [(envelope("c", 1, key=1), 0, 0), (envelope("u", 3, key=1), 0, 1), (envelope("d", 2, key=2), 1, 0), ("junk", 1, 1)]
    batch = spark.createDataFrame(lines, "value string, partition int, offset bigint")
    write = sm.catalog_writer(spec, "lake.orders", run_sql=run_sql)
    write(batch, 0)
    write(batch, 1)
    assert said == [[(1, "u", 3), (2, "d", 2)]] * 2
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tidemark_")]


def test_kafka_options():
    opts = sm.kafka_options("broker:9092", "db.public.orders", max_offsets_per_trigger=1000)
    assert opts["subscribe"] == "db.public.orders" and opts["startingOffsets"] == "earliest"
    assert opts["maxOffsetsPerTrigger"] == "1000"
