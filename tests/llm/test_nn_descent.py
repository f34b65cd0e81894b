"""NN-descent against all pairs."""

import numpy as np

from tidemark.llm import nn_descent as op
from tidemark.llm.queries import QUERIES

ROWS = "vec_id long, embedding array<float>, label int, component_id int"


def plain(rows):
    ids, units = [], []
    for i, v in rows:
        ids.append(i)
        a = np.array([np.nan if x is None else x for x in v or []], float)
        units.append(a / np.linalg.norm(a) if len(a) and np.isfinite(a).all() and a.any() else None)
    near = {i: set() for i in ids}
    for x in range(len(ids)):
        for y in range(x):
            if units[x] is not None and units[y] is not None and len(units[x]) == len(units[y]) and units[x] @ units[y] >= 0.9:
                near[ids[x]].add(ids[y])
                near[ids[y]].add(ids[x])
    low = {i: i for i in ids}
    for _ in ids:
        new = {i: min([low[i], *(low[j] for j in near[i])]) for i in ids}
        if new == low:
            break
        low = new
    return {i: (len(near[i]), low[i]) for i in ids}


def test_groups_of_copies_and_odd_rows(spark):
    r = np.random.default_rng(6)
    rows = [(i, r.normal(size=16).tolist()) for i in range(700)]
    centre = r.normal(size=16)
    rows += [(1000 + i, (centre + r.normal(size=16) * 0.05).tolist()) for i in range(400)]  # more than any list holds
    for k in range(25):
        c = r.normal(size=16)
        rows += [(2000 + 10 * k + i, (c * (1 + i) + r.normal(size=16) * 0.1).tolist()) for i in range(3)]
    rows += [(5000, None), (5001, []), (5002, [0.0] * 16), (5003, [float("nan")] * 16), (5004, [None] + [1.0] * 15),
             (5005, [float("inf")] + [1.0] * 15), (5006, [1.0, 2.0]), (5007, [1.0, 2.0]), (5008, rows[0][1])]
    expected = plain([(i, np.array(v, np.float32).tolist() if v and None not in v else v) for i, v in rows])
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in [*rows, rows[3], (None, rows[3][1])]], ROWS)
    got = op.near_duplicates(df).collect()
    assert len(got) == len(rows) + 1
    assert {x.vec_id: (x.n_links, x.component_id) for x in got if x.vec_id is not None} == expected
    assert all(x.kept == (x.vec_id == x.component_id) for x in got if x.vec_id is not None)
    assert [(x.n_links, x.component_id, x.kept) for x in got if x.vec_id is None] == [(0, None, True)]


def test_recall_on_the_given_table(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    x = np.array([r.embedding for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    ids = [r.vec_id for r in rows]
    links = {i: int(n) for i, n in zip(ids, (x @ x.T >= 0.9).sum(1) - 1)}
    got = {r.vec_id: r.n_links for r in QUERIES["op5_nn_descent"](spark, sf).collect()}
    assert set(got) == set(links) and all(got[i] <= links[i] for i in ids)
    queries = [i for i in ids if i % 20 == 0]
    assert sum(got[i] for i in queries) >= 0.9 * sum(links[i] for i in queries)
    assert sum(got.values()) >= 0.98 * sum(links.values())


def test_empty(spark):
    assert op.near_duplicates(spark.createDataFrame([], ROWS)).collect() == []
    assert op.near_duplicates(spark.createDataFrame([(1, None, 0, 0)], ROWS)).first().n_links == 0


def _judged(spark, rows):
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], ROWS)
    return {x.vec_id: (x.n_links, x.component_id) for x in op.near_duplicates(df).collect()}


def test_two_large_groups_that_link_across(spark):
    """More near copies on both sides than a list holds, all pairs across at 0.9 to 0.95."""
    r = np.random.default_rng(7)
    one, other = np.linalg.qr(r.normal(size=(64, 2)))[0].T
    other = 0.93 * one + (1 - 0.93 ** 2) ** 0.5 * other
    rows = [(i, r.normal(size=64).tolist()) for i in range(500)]
    for g, centre in enumerate((one, other)):
        rows += [(1000 + 1000 * g + i, (centre + r.normal(size=64) * 0.004).tolist()) for i in range(200)]
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    got = _judged(spark, rows)
    assert got[2000] == (399, 1000)
    assert got == plain(rows)


def test_many_exact_copies(spark):
    r = np.random.default_rng(8)
    rows = [(i, np.array(r.normal(size=16), np.float32).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(470)] + [(2000, (np.array(rows[0][1]) * 2).tolist())]
    got = _judged(spark, rows)
    assert len({c for i, (_, c) in got.items() if i >= 1000}) == 1
    assert got == plain(rows)


def test_short_recall_is_made_good(spark, monkeypatch):
    """One poor tree and no refinement: the large group hides what the small ones lose."""
    monkeypatch.setattr(op, "MAX_AUDITS", 1)
    monkeypatch.setattr(op, "TREES", 1)
    monkeypatch.setattr(op, "_refine", lambda vectors, graph, n, *_: graph)
    r = np.random.default_rng(9)
    rows = [(i, r.normal(size=16).tolist()) for i in range(600)]
    centre = r.normal(size=16)
    rows += [(1000 + i, (centre + r.normal(size=16) * 0.03).tolist()) for i in range(300)]
    for k in range(60):
        c = r.normal(size=16)
        rows += [(2000 + 10 * k + i, (c + r.normal(size=16) * 0.25).tolist()) for i in range(4)]
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    assert _judged(spark, rows) == plain(rows)
