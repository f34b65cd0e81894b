"""Whitening against a plain covariance of whole numbers, and the rules for unusable vectors."""

import numpy as np
import pytest

from tidemark.llm import embedding_whitening as op
from tidemark.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>"
COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def plain(vectors, components=op.COMPONENTS):
    """{id: deviation}, eigenvalues, covariance and centred rows of {id: list of floats}."""
    ids = sorted(vectors)
    x = [[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in vectors[i]] for i in ids]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    deviation = {i: sum((n * a - s) ** 2 for a, s in zip(row, sums)) for i, row in zip(ids, x)}
    centred = np.array([[(n * a - s) / n for a, s in zip(row, sums)] for row in x])
    v = centred.T @ centred / n
    values = np.linalg.eigvalsh(v)[::-1]
    return ids, deviation, values[:components], v, centred


def check(rows, vectors, components=op.COMPONENTS):
    ids, deviation, values, v, centred = plain(vectors, components)
    k = int((values > values.max() * op.RANK_FLOOR).sum())
    assert len(rows) == len(ids) * k
    place = {i: at for at, i in enumerate(ids)}
    w = np.zeros((len(ids), k))
    for r in rows:
        w[place[r.vec_id], r.component - 1] = r.whitened
        assert r.n == len(ids) and r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(values[r.component - 1] / np.trace(v), rel=1e-9)
        assert 0 <= r.identity_error < 1e-8
    # The columns are unit eigenvectors: V W = W diag(values) and W'W = 1 / values.
    back = np.linalg.lstsq(centred, w, rcond=None)[0]
    assert np.abs(v @ back - back * values[:k]).max() < 1e-6 * values.max()
    np.testing.assert_allclose(back.T @ back, np.diag(1 / values[:k]), atol=1e-9 * (1 / values[:k]).max())
    np.testing.assert_allclose(w.T @ w / len(ids), np.eye(k), atol=1e-8)


@pytest.mark.parametrize("block_rows", [7, 1024])
def test_whole_table(spark, block_rows):
    rng = np.random.default_rng(3)
    mix = rng.normal(size=(6, 6))
    vectors = {i: (rng.normal(size=6) @ mix).tolist() for i in range(300)}
    rows = list(vectors.items()) + [(1000, None), (1001, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (1002, [float("nan")] * 6),
                                    (1003, [1.0, 2.0]), (1004, []), (1005, [float("inf")] + [0.0] * 5)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 as x", "2 as block", "3 as n", "'a' as vec_ids")
    out = op.whiten(df, block_rows=block_rows)
    assert out.columns == COLUMNS
    check(out.collect(), vectors)
    check(op.whiten(df, components=2, block_rows=block_rows).collect(), vectors, 2)


def test_rank_and_ties(spark):
    # Two of four dimensions vary; every vector twice, one without id.
    rows = [(i % 40, [float(i % 40), float((i % 40) ** 2), 1.0, float(i % 40)]) for i in range(80)] + [(None, [3.0, 9.0, 1.0, 3.0])]
    out = op.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.component for r in out} == {1, 2} and len(out) == 2 * 81
    assert sum(r.vec_id is None for r in out) == 2
    a, b = ({r.component: r.whitened for r in out if r.vec_id == i} for i in (3, None))
    assert a[1] == pytest.approx(b[1], abs=1e-9) and a[2] == pytest.approx(b[2], abs=1e-9)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_nothing_to_whiten(spark, rows):
    out = op.whiten(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == COLUMNS and out.collect() == []


def test_deviation_beyond_64_bits():
    x = np.array([[1_000_000, 5], [1_000_000 + (1 << 40), -5]], np.int64)
    n, sums = 1 << 20, np.array([1_000_000 << 20, 0], object)
    assert op._deviation(x, n, sums) == [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]


def test_registered(spark):
    rows = QUERIES["op12_embedding_whitening"](spark, "/root/testdata/sf0.001").collect()
    given = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()
    vectors = {r.vec_id: r.embedding for r in given if r.embedding is not None and all(c is not None and np.isfinite(c) for c in r.embedding)}
    check(rows, vectors)
