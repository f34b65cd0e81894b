"""Conversation repair against its SQL, against all edits of short conversations, and in small blocks."""

import hashlib
import itertools
import random
import re

import duckdb
import pyarrow as pa
import pytest

from tidemark.llm import conversation_repair as op
from tidemark.llm.queries import ORACLE, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", *op.COUNTS[1:], "audit", "repaired_sha256"]


def in_sql(rows):
    con = duckdb.connect()
    kinds = {"conv_id": pa.int64(), "turn": pa.int64(), "role": pa.string(), "text": pa.string()}
    con.register("conversations", pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], names=list(kinds)))
    return sorted(map(tuple, con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({op.oracle()})").fetchall()), key=repr)


def in_spark(df, **bounds):
    return sorted((tuple(r) for r in op.summary(df, **bounds).select(*COLUMNS).collect()), key=repr)


def cases():
    rng = random.Random(5)
    rows = [(None, 1, "user", "Hi."), (None, 2, "assistant", "Yes."), (1, None, None, None), (1, None, "user", "Null turn."),
            (2, 5, "", "No role."), (2, 5, "", "No role."), (2, 5, "assistant", "Same turn!"), (3, 0, "user", " \t\n"),
            (4, -7, "system", "Só: ñ é."), (4, 9_000_000_000_000_000_001, "user", "Far? "), (5, 0, "tool", "x"),
            (6, 0, "user", "long " * 40_000 + "."), (6, 1, "assistant", "end ")]
    for conv in range(10, 90):
        for turn in range(rng.randrange(1, 12)):
            if rng.random() < 0.9:
                rows.append((conv, turn * rng.choice((1, 1, 2)), rng.choice(("user", "assistant", "system", "user", "User", None)),
                             rng.choice(("Ok.", "Why?", "cut off", "", " ", "One. Two", "More!\n", None))))
    return rows


def test_matches_sql(spark):
    rows = cases()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' as conv", "1 as present_", "0 as fault", "'y' as by")
    want = in_sql(rows)
    assert in_spark(op.damaged(df)) == want
    # Every block holds one or two rows: all conversations are spilled, traced back and replayed.
    assert in_spark(op.damaged(df), block_rows=2) == want
    assert in_spark(op.damaged(df), block_bytes=1) == want


def plain(rows):
    """Cheapest, then ASCII-least edits of (role, text, doomed, open) rows, by trying all of them."""
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        for ins in itertools.product(range(3), repeat=len(rows) + 1):
            if sum(ins) > 2:
                continue
            out, cost, ok = [], 5 * sum(ins), True
            for i, (edit, (role, text, doomed, cut)) in enumerate(zip(edits, rows)):
                out += [("I", "")] * ins[i]
                if edit == "D":
                    cost += 2
                    continue
                ok &= not doomed
                cost += 5 * cut + (edit == "R")
                out.append((edit, role if edit == "K" else None))
            out += [("I", "")] * ins[-1]
            odd = len(out) % 2
            ok &= len(out) != 1
            for at, (edit, role) in enumerate(out):
                due = "s" if odd and at == 0 else "ua"[(at - odd) % 2]
                ok &= role[:1] == due if edit == "K" else due != "s"
            if ok:
                audit = "".join("I" * ins[i] + e for i, e in enumerate(edits)) + "I" * ins[-1]
                best = min(best or (1 << 30, ""), (cost, audit))
    return best


def test_cheapest_of_all_edits():
    rng = random.Random(11)
    for _ in range(150):
        rows = [(rng.choice(("user", "assistant", "system", "tool")), "t", rng.random() < 0.15, rng.random() < 0.25)
                for _ in range(rng.randrange(0, 6))]
        costs, ranks, total, moves = (0, op.NEVER, op.NEVER, op.NEVER), (0, 0, 0, 0), 0, b""
        for role, _, doomed, cut in rows:
            base, costs, ranks, back = op.step(costs, ranks, role[0], doomed, cut and not doomed)
            total, moves = total + base, moves + back
        cost, state, inserts = op.finish(costs, ranks)
        got = (total + cost, op.trace(moves, state)[0] + "I" * inserts)
        assert got == plain([(r, t, d, c and not d) for r, t, d, c in rows]), rows


def test_repaired_rows_and_giant(spark):
    n = 3000
    rows = [(1, i, "user" if i % 3 else "assistant", f"Line {i % 2900}" + "." * (i % 7 > 0)) for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    whole = op.summary(df).first()
    assert in_spark(df, block_rows=64) == [tuple(whole[c] for c in COLUMNS)]
    lines = op.repaired(df, block_rows=64).orderBy("place").collect()
    assert [r.place for r in lines] == list(range(len(lines)))
    assert re.fullmatch("(s?(ua)+)?", "".join(r.role[0] for r in lines))
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in lines).encode()).hexdigest() == whole.repaired_sha256
    assert len(whole.audit.replace("I", "")) == n and whole.duplicate == n - len({r[2:] for r in rows}) > 0


def test_empty_and_registered(spark, tmp_path):
    df = spark.createDataFrame([], SCHEMA)
    assert in_spark(op.damaged(df)) == [] == op.repaired(df).collect()
    spark.createDataFrame(cases(), SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    got = QUERIES["op13_conversation_repair"](spark, str(tmp_path))
    assert sorted(got.columns) == sorted(COLUMNS) and "op13_conversation_repair" in ORACLE
    assert got.count() == len({r[0] for r in cases()})


def test_one_shuffle_for_the_stream(spark):
    plan = op._faults(op.damaged(spark.createDataFrame(cases(), SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan


@pytest.mark.parametrize("initial", ["s", "u", "a", "", "é"])
def test_step_is_total(initial):
    for doomed, cut in ((False, False), (True, False), (False, True)):
        base, costs, ranks, back = op.step((0, op.NEVER, op.NEVER, op.NEVER), (0, 0, 0, 0), initial, doomed, cut)
        assert min(costs) == 0 and len(back) == 4 and base >= 0
