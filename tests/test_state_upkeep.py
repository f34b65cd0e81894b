"""Key ranges, incremental compaction, pruned probes, the commit log and reads as of a commit."""

import pytest
from pyspark.sql import functions as F
from test_fold import changes
from test_merge_state import live_map

from tidemark.operators import fold as fo
from tidemark.operators.ranges import range_number
from tidemark.session import scratch_path
from tidemark.spec import Column, TableSpec
from tidemark.streaming import fs
from tidemark.streaming.state import StateTable


@pytest.mark.parametrize("least", [[], [5], [5, 9], [1, 3, 3, 70, 71], list(range(0, 1000, 7))])
def test_range_number_of_integers(spark, least):
    found = spark.range(-3, 1005, 3).select("id", range_number(F.col("id"), least).alias("n")).collect()
    for r in found:
        assert r["n"] == max(0, sum(b <= r["id"] for b in least) - 1) if len(least) > 1 else r["n"] == 0


def test_range_number_of_text_and_null(spark):
    least = ["", "b", "ba", "é"]
    df = spark.createDataFrame([("a",), ("b",), ("baz",), ("z",), ("ë",), (None,)], "k string")
    assert [r["n"] for r in df.select(range_number(F.col("k"), least).alias("n")).collect()] == [0, 1, 2, 2, 3, 0]


def loaded(spark, spec, keys, file_rows=10, key=lambda i: i):
    st = StateTable(spark, scratch_path(spark, "test-ranges"), spec, file_rows=file_rows)
    st.write_epoch(changes(spark, [(i, i + 1, "c", i) for i in range(keys)]), 0, "load", ("seq",))
    st.compact()
    return st


def rows_at(spark, st, number):
    return spark.read.parquet(f"{st.root}/parts/c{number:012d}").count()


def test_compaction_rewrites_only_touched_ranges(spark, spec):
    st = loaded(spark, spec, 200)
    files = st.files(st.layout()[0])
    assert len(files) >= 15 and all(a.greatest < b.least for a, b in zip(files, files[1:]))
    st.write_epoch(changes(spark, [(57, 1000, "u", 5.5), (58, 1001, "d", None)]), 1, "load", ("seq",))
    want = live_map(st.read_live())
    assert want[57] == "5.50" and 58 not in want and len(want) == 199
    st.compact()
    met = next(f for f in files if f.least <= 57 <= f.greatest)
    assert rows_at(spark, st, 2) <= 2 * met.rows < 50
    after = st.files(st.layout()[0])
    assert {f.path for f in files} - {f.path for f in after} <= {f.path for f in files if f.least <= 58 and f.greatest >= 57}
    assert sum(f.rows for f in after) == 200 and live_map(st.read_live()) == want
    # A key beyond all ranges goes to the last one, which is cut when it has grown.
    st.write_epoch(changes(spark, [(i, i + 1, "c", i) for i in range(1000, 1045)]), 2, "load", ("seq",))
    st.compact()
    last = st.files(st.layout()[0])
    assert all(a.greatest < b.least for a, b in zip(last, last[1:])) and sum(f.rows for f in last) == 245
    assert len([f for f in last if f.least >= 1000 or f.greatest >= 1000]) >= 3
    assert live_map(st.read_live()) == {**want, **{i: f"{i}.00" for i in range(1000, 1045)}}


def test_two_compactions_equal_the_whole_fold(spark, spec):
    log = [(i * 7 % 40, i, "d" if i % 11 == 0 else "u", i) for i in range(1, 300)]
    st = StateTable(spark, scratch_path(spark, "test-fold"), spec, file_rows=7)
    for epoch, at in enumerate((0, 100, 200)):
        st.write_epoch(changes(spark, log[at:at + 100]), epoch, "a", ("seq",))
        if epoch < 2:
            st.compact()
            st.retire()
    whole = fo.fold_state(changes(spark, log), spec, "lsn", ("seq",))
    assert sorted(map(tuple, st.read_state().collect())) == sorted(map(tuple, whole.select(*st.read_state().columns).collect()))


def test_probe_reads_no_more_files_of_a_larger_state(spark, spec):
    read = []
    for keys in (100, 400):
        st = loaded(spark, spec, keys)
        wanted = spark.createDataFrame([(31,), (33,), (31,), (9999,)], "order_id long")
        found = st.probe(wanted)
        assert {r["order_id"]: r["_lsn"] for r in found.collect()} == {31: 32, 33: 34}
        read.append(len(found.inputFiles()))
    assert read[0] == read[1] <= 3
    st.write_epoch(changes(spark, [(33, 2000, "d", None)]), 1, "load", ("seq",))
    assert {r["order_id"]: r["_deleted"] for r in st.probe(wanted).collect()} == {31: False, 33: True}


def test_untouched_files_are_not_shuffled_by_a_read(spark, spec):
    st = loaded(spark, spec, 200)
    assert "Exchange" not in st.read_state()._jdf.queryExecution().executedPlan().toString()
    st.write_epoch(changes(spark, [(3, 1000, "u", 1)]), 1, "load", ("seq",))
    plan = st.read_state()._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and st.read_state().count() == 200


def test_text_keys(spark):
    spec = TableSpec("t", "name", (Column("name", "str"), Column("n", "int")))
    rows = spark.range(100).select(F.format_string("k%04d", "id").alias("name"), F.col("id").alias("n"), F.lit("c").alias("op"),
                                   F.col("id").alias("_lsn"))
    st = StateTable(spark, scratch_path(spark, "test-text"), spec, file_rows=10)
    st.write_epoch(rows, 0, "a")
    st.compact()
    st.write_epoch(rows.where("n = 50").withColumn("_lsn", F.lit(1000).cast("long")).withColumn("n", F.lit(-1).cast("long")), 1, "a")
    st.compact()
    assert rows_at(spark, st, 2) < 30
    got = {r["name"]: r["n"] for r in st.read_live().collect()}
    assert len(got) == 100 and got["k0050"] == -1


def test_history_and_snapshots_survive_retirement(spark, spec):
    st = StateTable(spark, scratch_path(spark, "test-log"), spec)
    bulk = changes(spark, [(i, i + 1, "c", i) for i in range(6)]).withColumn("b", F.col("order_id") % 2)
    st.write_epochs(bulk, "b", "load", ("seq",))
    st.write_epoch(changes(spark, [(1, 50, "u", 1), (1, 51, "u", 2)]), 0, "run", ("seq",))
    before = st.inspect().first()
    st.compact()
    st.retire()
    assert st.commits() == [] and st.inspect().first() == before and before["snapshots"] == 3
    assert sorted((r["number"], r["run"], r["epoch"], r["rows"]) for r in st.history().collect()) == [
        (1, "load", 0, 3), (1, "load", 1, 3), (2, "run", 0, 1)]
    # A retired epoch is still known as committed.
    assert not st.write_epoch(changes(spark, [(1, 99, "u", 9)]), 0, "run", ("seq",))
    assert st.number("run", 0) == 2 and st.number("run", 1) is None


def test_a_commit_without_log_entry_is_logged_by_its_replay(spark, spec):
    st = StateTable(spark, scratch_path(spark, "test-log"), spec)
    batch = changes(spark, [(1, 1, "c", 1), (2, 2, "c", 2)])
    st.write_epoch(batch, 0, "run", ("seq",))
    fs.remove(spark, f"{st.root}/log")
    assert st.history().count() == 0
    assert not st.write_epoch(batch, 0, "run", ("seq",))
    assert [(r["number"], r["rows"]) for r in st.history().collect()] == [(1, 2)]


def test_reads_as_of_a_commit(spark, spec):
    st = StateTable(spark, scratch_path(spark, "test-as-of"), spec)
    seen = [{}]
    for epoch in range(5):
        st.write_epoch(changes(spark, [(epoch, epoch + 1, "c", epoch), (0, 10 + epoch, "u", 100 + epoch)]), epoch, "a", ("seq",))
        seen.append(live_map(st.read_live()))
        if epoch in (1, 3):
            st.compact()
    for number in range(1, 6):
        assert live_map(st.read_live(as_of=number)) == seen[number]
    st.retire(keep_bases=1)
    assert live_map(st.read_live(as_of=4)) == seen[4] and live_map(st.read_live(as_of=5)) == seen[5]
    with pytest.raises(ValueError, match="older than the oldest kept base"):
        st.read_live(as_of=3)


def test_upkeep_bounds_what_waits(spark, spec):
    st = StateTable(spark, scratch_path(spark, "test-upkeep"), spec)
    waiting = []
    for epoch in range(6):
        st.write_epoch(changes(spark, [(epoch, epoch + 1, "c", epoch)]), epoch, "a", ("seq",))
        st.upkeep(compact_after=2)
        waiting.append(len(st.layout()[1]))
    assert waiting == [1, 0, 1, 0, 1, 0] and len(st.bases()) == 2 and len(live_map(st.read_live())) == 6


def test_empty_states(spark, spec):
    st = StateTable(spark, scratch_path(spark, "test-empty"), spec)
    st.write_epoch(changes(spark, []), 0, "a", ("seq",))
    assert st.read_state().count() == 0
    st.compact()
    assert st.read_state().count() == 0 and st.probe(spark.range(3).select(F.col("id").alias("order_id"))).count() == 0
    st.write_epoch(changes(spark, [(1, 1, "c", 1)]), 1, "a", ("seq",))
    st.compact()
    assert live_map(st.read_live()) == {1: "1.00"}
