"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

    y(x) = w0 + sum_i w_i x_i + 1/2 sum_f [ (sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2 ]

The pairwise term is taken with the sum-of-squares identity, so scoring is linear in the number of
non-zero features. Words are lower-cased runs of letters and digits hashed to ``BUCKETS``, valued
log(1 + count) and scaled to length one; then come the standardised statistics of ``features.STRUCTURE``,
among them the metadata column ``n_chars``. Labels, lang, source and doc_id are never inputs.

Fitting takes a bounded sample, ``MAX_TRAIN`` labelled rows outside the held-out fold in the order of a
hash of their id, sent to the driver as sparse features; scoring covers every document in its own task
without a shuffle.

Rows. A null text is an empty one and gets a score like any other. A null ``n_chars`` counts as
measured. A null id is held out. Ids repeated in the labels take their largest label; repeated
documents come back as often. Without a usable label of each class the score is the share of ones
among the labels (0.5 without any). Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.features import STRUCTURE, hashed_words, structure
from tidemark.llm.frames import clash_free, hashed_sample
from tidemark.llm.textblocks import batches_in_blocks, list_array

BUCKETS = 1 << 13
RANK = 6
MAX_TRAIN = 6000
EPOCHS = 12
THRESHOLD = 0.3
FOLDS = 5


@dataclass(frozen=True)
class Machine:
    """Fitted weights; ``bias`` alone decides where no model could be fitted."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def score(self, rows: np.ndarray, columns: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        linear = np.bincount(rows, weights=self.weights[columns] * values, minlength=n)
        scaled = self.factors[columns] * values[:, None]
        total = np.stack([np.bincount(rows, weights=scaled[:, f], minlength=n) for f in range(scaled.shape[1])], axis=1)
        squares = np.bincount(rows, weights=(scaled ** 2).sum(1), minlength=n)
        z = self.bias + linear + 0.5 * ((total ** 2).sum(1) - squares)
        return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def word_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows, columns, counts = hashed_words(texts, BUCKETS)
    values = np.log1p(counts)
    norm = np.sqrt(np.bincount(rows, weights=values ** 2, minlength=len(texts)))
    return rows, columns, values / norm[rows] if len(rows) else values


def _sparse(texts: list[bytes], n_chars: list, mean: np.ndarray, scale: np.ndarray):
    """Features of a block: words, then standardised statistics clipped to three deviations."""
    n, k = len(texts), len(STRUCTURE)
    rows, columns, values = word_features(texts)
    dense = np.clip((structure(texts, n_chars) - mean) / scale, -3, 3)
    rows = np.concatenate([rows, np.repeat(np.arange(n), k)])
    columns = np.concatenate([columns, np.tile(np.arange(BUCKETS, BUCKETS + k), n)])
    return rows, columns, np.concatenate([values, dense.ravel()])


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(True))


def _inputs(docs: DataFrame) -> DataFrame:
    return clash_free(docs, "doc_id", "text", "n_chars").select(
        "doc_id", F.col("text").cast("binary").alias("text"), F.col("n_chars").cast("long").alias("n_chars"))


def _raw_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "label", "columns", "values", "dense"]
    for batch, texts in batches_in_blocks(batches, "text"):
        rows, columns, values = word_features(texts)
        per = np.bincount(rows, minlength=len(texts))
        dense = structure(texts, batch.column(2).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(3).cast(pa.int32()),
             list_array(pa.array(columns.astype(np.int32)), per), list_array(pa.array(values.astype(np.float32)), per),
             list_array(pa.array(dense.ravel()), np.full(len(texts), dense.shape[1]))], names)


def training_rows(docs: DataFrame, labels: DataFrame, label: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled documents outside the held-out fold, by the hash of their id."""
    labelled = clash_free(labels, "doc_id", label).where(F.col(label).isNotNull() & ~held_out()).groupBy("doc_id").agg(
        F.max(label).alias("label"))
    chosen = hashed_sample(labelled, limit, "doc_id")
    # The sample's size is bounded by ``limit``, so sending it to every task is safe.
    return docs.join(F.broadcast(chosen), "doc_id")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", limit: int = MAX_TRAIN) -> Machine:
    sample = training_rows(_inputs(docs), labels, label, limit).mapInArrow(
        _raw_features, "doc_id long, label int, columns array<int>, values array<float>, dense array<double>")
    rows = sorted(sample.collect(), key=lambda r: (r.doc_id, len(r.columns), tuple(r.dense)))
    k = len(STRUCTURE)
    y = np.array([min(1, max(0, r.label)) for r in rows], float)
    plain = Machine(0.0, np.zeros(BUCKETS + k), np.zeros((BUCKETS + k, RANK)), np.zeros(k), np.ones(k))
    if not len(y) or y.min() == y.max():
        share = np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3)
        return Machine(float(np.log(share / (1 - share))), plain.weights, plain.factors, plain.mean, plain.scale)
    dense = np.array([r.dense for r in rows])
    mean, scale = dense.mean(0), np.maximum(dense.std(0), 1e-6)
    dense = np.clip((dense - mean) / scale, -3, 3)
    tail = np.arange(BUCKETS, BUCKETS + k)
    columns = [np.concatenate([np.array(r.columns, np.int64), tail]) for r in rows]
    values = [np.concatenate([np.array(r["values"], float), d]) for r, d in zip(rows, dense)]
    return _descend(columns, values, y, mean, scale)


def _descend(columns, values, y, mean, scale) -> Machine:
    """Adam on the log loss, in a fixed order of batches, on the bounded sample."""
    random = np.random.default_rng(7)
    size = BUCKETS + len(mean)
    share = y.mean()
    theta = np.concatenate([np.zeros((size, 1)), random.normal(0, 0.02, (size, RANK))], axis=1)
    bias = np.log(share / (1 - share))
    m, v, mb, vb, step = np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0, 0
    for epoch in range(EPOCHS):
        order = random.permutation(len(y))
        rate = 0.02 * (1 - 0.9 * epoch / EPOCHS)
        for at in range(0, len(order), 128):
            pick = order[at:at + 128]
            col = np.concatenate([columns[i] for i in pick])
            x = np.concatenate([values[i] for i in pick])
            row = np.repeat(np.arange(len(pick)), [len(columns[i]) for i in pick])
            now = Machine(bias, theta[:, 0], theta[:, 1:], mean, scale)
            error = (now.score(row, col, x, len(pick)) - y[pick]) / len(pick)
            scaled = theta[col, 1:] * x[:, None]
            total = np.add.reduceat(scaled, np.flatnonzero(np.r_[True, row[1:] != row[:-1]]), axis=0)
            slope = (error[row] * x)[:, None]
            used, place = np.unique(col, return_inverse=True)
            grad = np.zeros((len(used), 1 + RANK))
            np.add.at(grad, place, np.concatenate([slope, slope * (total[row] - scaled)], axis=1))
            grad += 1e-5 * theta[used]
            step += 1
            m[used] = 0.9 * m[used] + 0.1 * grad
            v[used] = 0.999 * v[used] + 0.001 * grad ** 2
            theta[used] -= rate * (m[used] / (1 - 0.9 ** step)) / (np.sqrt(v[used] / (1 - 0.999 ** step)) + 1e-8)
            gb = error.sum()
            mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb ** 2
            bias -= rate * (mb / (1 - 0.9 ** step)) / (np.sqrt(vb / (1 - 0.999 ** step)) + 1e-8)
    return Machine(float(bias), theta[:, 0].copy(), theta[:, 1:].copy(), mean, scale)


def with_score(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """The documents with all their columns and their score, in one pass without a shuffle."""
    if name in docs.columns:
        raise ValueError(f"the documents already have a column {name}")
    rows = docs.select("*", F.col("text").cast("binary").alias("_text"), F.col("n_chars").cast("long").alias("_chars"))
    width = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches_in_blocks(batches, "_text"):
            found, columns, values = _sparse(texts, batch.column(width + 1).to_pylist(), machine.mean, machine.scale)
            p = machine.score(found, columns, values, len(texts))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(width)], pa.array(p)], [*batch.schema.names[:width], name])

    return rows.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, DoubleType())]))


def score(docs: DataFrame, machine: Machine, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    scored = with_score(clash_free(docs, "doc_id", "text", "n_chars"), machine)
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
