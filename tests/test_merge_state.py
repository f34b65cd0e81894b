import pytest
from test_fold import changes

from tidemark.operators import fold as fo
from tidemark.operators import merge as mg
from tidemark.session import scratch_path
from tidemark.streaming.state import StateTable


def live_map(df):
    return {r["order_id"]: str(r["amount"]) for r in df.collect()}


def test_delete_then_late_update_across_batches(spark, spec):
    state = fo.fold_state(changes(spark, [(1, 30, "d", None)]), spec, "lsn", ("seq",))
    state = mg.merge_guarded(state, changes(spark, [(1, 20, "u", 5)]), spec, ("seq",))
    assert live_map(fo.live_rows(state)) == {}
    state = mg.merge_guarded(state, changes(spark, [(1, 40, "c", 7)]), spec, ("seq",))
    assert live_map(fo.live_rows(state)) == {1: "7.00"}


def test_stored_row_wins_lsn_tie(spark, spec):
    state = fo.fold_state(changes(spark, [(1, 5, "u", 1)]), spec, "lsn", ("seq",))
    state = mg.merge_guarded(state, changes(spark, [(1, 5, "u", 2)]), spec, ("seq",))
    assert live_map(fo.live_rows(state)) == {1: "1.00"}


def test_apply_changes_upsert_and_delete(spark, spec):
    state = fo.fold_state(changes(spark, [(1, 1, "c", 10), (2, 2, "c", 20)]), spec, "lsn", ("seq",))
    batch = changes(spark, [(1, 3, "u", 11.5), (3, 4, "c", 30), (2, 5, "d", None), (9, 0, "d", None)])
    net = mg.net_changes(state, batch, spec, ("seq",))
    assert sorted((r["order_id"], r["action"]) for r in net.collect()) == [
        (1, "upsert"), (2, "delete"), (3, "upsert"), (9, "delete")]
    out = mg.apply_changes(fo.live_rows(state), net, spec)
    assert live_map(out) == {1: "11.50", 3: "30.00"}


def test_state_table_epochs_replay_and_compaction(spark, spec):
    st = StateTable(spark, scratch_path(spark, "test-state"), spec)
    assert st.write_epoch(changes(spark, [(1, 10, "c", 1), (2, 11, "c", 2)]), 0, "run", ("seq",))
    assert not st.write_epoch(changes(spark, [(1, 99, "u", 9)]), 0, "run", ("seq",))  # replay: skipped
    assert st.write_epoch(changes(spark, [(2, 30, "d", None), (1, 5, "u", 3)]), 1, "run", ("seq",))
    assert live_map(st.read_live()) == {1: "1.00"}
    st.compact()
    assert live_map(st.read_live()) == {1: "1.00"}
    # a late, lower-LSN insert for the deleted key after compaction must not resurrect it
    assert st.write_epoch(changes(spark, [(2, 20, "u", 8), (3, 1, "c", 4)]), 2, "run", ("seq",))
    assert live_map(st.read_live()) == {1: "1.00", 3: "4.00"}
    info = st.inspect().first()
    assert (info["live_rows"], info["snapshots"]) == (2, 3)
    # tombstone retention: dropping tombstones below LSN 31 forgets key 2 entirely
    st.compact(drop_tombstones_below_lsn=31)
    assert st.read_state().where("order_id = 2").count() == 0
    assert live_map(st.read_live()) == {1: "1.00", 3: "4.00"}


def test_equal_lsn_of_a_later_run_loses(spark, spec):
    st = StateTable(spark, scratch_path(spark, "test-tie"), spec)
    for epoch in range(4):
        assert st.write_epoch(changes(spark, [(1, 5 if epoch == 3 else epoch, "u", 1)]), epoch, "a", ("seq",))
    assert st.write_epoch(changes(spark, [(1, 5, "u", 2)]), 0, "b", ("seq",))
    assert live_map(st.read_live()) == {1: "1.00"}
    assert st.inspect().first()["snapshots"] == 5


def test_retired_commits_are_not_read_again(spark, spec):
    st = StateTable(spark, scratch_path(spark, "test-retire"), spec)
    for epoch in range(5):
        st.write_epoch(changes(spark, [(epoch, epoch + 1, "c", epoch)]), epoch, "a", ("seq",))
    before = live_map(st.read_live())
    st.compact()
    base, rest = st.layout()
    assert base and rest == []
    assert st.retire() == 5 and st.commits() == []
    assert live_map(st.read_live()) == before
    assert st.write_epoch(changes(spark, [(9, 1, "c", 9)]), 0, "b", ("seq",))
    assert [c.number for c in st.commits()] == [6] and len(live_map(st.read_live())) == 6


def test_missing_table_raises(spark, spec):
    with pytest.raises(FileNotFoundError):
        StateTable(spark, scratch_path(spark, "test-nothing"), spec).read_state()


def test_restart_keeps_high_water_mark(spark, spec):
    """A fresh process reading the state table still knows each key's LSN."""
    root = scratch_path(spark, "test-restart")
    StateTable(spark, root, spec).write_epoch(changes(spark, [(1, 50, "u", 5)]), 0, "a", ("seq",))
    again = StateTable(spark, root, spec)
    again.write_epoch(changes(spark, [(1, 40, "u", 4)]), 0, "b", ("seq",))
    assert live_map(again.read_live()) == {1: "5.00"}
