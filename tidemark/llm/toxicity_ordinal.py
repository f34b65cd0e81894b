"""Toxicity: cumulative-link ordinal regression over sparse word features.

    P(severity >= k | x) = sigmoid(w . x - b_k),   b_1 < b_2 < ... < b_K

One weight vector serves every threshold; the ordered ``b`` are kept apart by a positive gap. The output
is the probability of each grade's threshold and the expected severity, the sum of these.

Grades. The labels only say toxic or not. A labelled toxic row is graded by the density of toxic words
in it: the lexicon is the set of word buckets that the labels themselves tie to toxic rows (log odds over
``LEXICON_ODDS`` and at least ``LEXICON_ROWS`` toxic rows), the density is the share of the row's features in
it, and the grade is its third among the labelled toxic rows (1, 2 or 3). Grade 0 is not toxic. The same
crc32 fold as the quality classifier's stays out of the fit.

Features are lower-cased plain words and their first 4, 5 and 6 bytes (stems), hashed to ``BUCKETS``, valued by ``value`` (a logarithm of their number): one insult in a long
document must count like one in a short one. Labels, lang, source and doc_id are never inputs. The fit
takes a bounded sample of ``MAX_TRAIN`` labelled rows; scoring covers every document without a shuffle.

Rows. A null text is empty and gets the severity of an empty text. Repeated rows come back as often; a
null id is never used in the fit. With no toxic label every severity is 0. Extra columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.features import hashed_words
from tidemark.llm.frames import clash_free
from tidemark.llm.quality_fm import held_out, training_rows
from tidemark.llm.textblocks import batches_in_blocks, list_array

BUCKETS = 1 << 17
#: First bytes of a word that are features beside it, for stems with changing ends.
PREFIXES = (4, 5, 6)
MAX_TRAIN = 8000
GRADES = 3
#: Probability of grade 1 or more from which a document is flagged.
FLAG = 0.5
LEXICON_ODDS = 3.0
LEXICON_ROWS = 5
STEPS = 600
#: Penalty on absolute weights: ordinary words weigh exactly nothing, or a long clean text would outweigh one insult.
L1 = 5e-4


def value(counts: np.ndarray) -> np.ndarray:
    """A feature's value: 1 where it occurs once, 2 where three times, 3 where seven times."""
    return np.log2(1.0 + counts)


@dataclass(frozen=True)
class Ordinal:
    weights: np.ndarray
    thresholds: np.ndarray

    def at_least(self, rows: np.ndarray, columns: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
        """P(severity >= k) for k = 1..GRADES, shape (n, GRADES)."""
        z = np.bincount(rows, weights=self.weights[columns] * value(counts), minlength=n) if len(rows) else np.zeros(n)
        return 1 / (1 + np.exp(-np.clip(z[:, None] - self.thresholds[None, :], -35, 35)))


def _inputs(docs: DataFrame) -> DataFrame:
    return clash_free(docs, "doc_id", "text").withColumn("text", F.col("text").cast("binary"))


def _raw_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, texts in batches_in_blocks(batches, "text"):
        rows, columns, counts = hashed_words(texts, BUCKETS, PREFIXES)
        per = np.bincount(rows, minlength=len(texts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()), batch.column(2).cast(pa.int32()),
             list_array(pa.array(columns.astype(np.int32)), per), list_array(pa.array(counts.astype(np.int32)), per)],
            ["doc_id", "label", "columns", "counts"])


@dataclass(frozen=True)
class Sample:
    """Labelled rows as flat arrays: row ``i`` has the features ``begin[i]:begin[i + 1]``."""

    toxic: np.ndarray
    begin: np.ndarray
    columns: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, table: pa.Table) -> Sample:
        """Rows by id, then by size and content, so that their order does not depend on the tasks'."""
        sums = pa.compute.list_value_length(table["columns"])
        flat = [table[c].combine_chunks() for c in ("columns", "counts")]
        lengths = sums.to_numpy().astype(np.int64)
        begin = np.concatenate(([0], np.cumsum(lengths)))
        columns, counts = (f.flatten().to_numpy() for f in flat)
        weight = np.add.reduceat(columns.astype(np.int64), begin[:-1][lengths > 0]) if len(columns) else np.zeros(0, np.int64)
        content = np.zeros(len(lengths), np.int64)
        content[lengths > 0] = weight
        order = np.lexsort((content, lengths, table["doc_id"].to_numpy()))
        places = np.repeat(begin[:-1][order], lengths[order])
        places += np.arange(len(columns)) - np.repeat(np.cumsum(lengths[order]) - lengths[order], lengths[order])
        return cls((table["label"].to_numpy()[order] > 0).astype(int), np.concatenate(([0], np.cumsum(lengths[order]))),
                   columns[places], counts[places])

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.toxic), dtype=np.int32), np.diff(self.begin))

    def per_row(self, values: np.ndarray) -> np.ndarray:
        """Sum of one value for each feature over each row."""
        total = np.concatenate(([0.0], np.cumsum(values, dtype=float)))
        return total[self.begin[1:]] - total[self.begin[:-1]]


def grade(sample: Sample) -> np.ndarray:
    """Severity grades 0..GRADES of the labelled rows (see the module's text)."""
    toxic = sample.toxic
    with_toxic = np.bincount(sample.columns[toxic[sample.rows] == 1], minlength=BUCKETS)
    seen = np.stack([np.bincount(sample.columns, minlength=BUCKETS) - with_toxic, with_toxic])
    n = np.array([(toxic == 0).sum(), (toxic == 1).sum()])
    share = (seen + 0.5) / (n[:, None] + 1)
    odds = np.log(share[1] / (1 - share[1])) - np.log(share[0] / (1 - share[0]))
    lexicon = (odds > LEXICON_ODDS) & (seen[1] >= min(LEXICON_ROWS, max(1, n[1] // 4)))
    density = sample.per_row(sample.counts * lexicon[sample.columns]) / np.maximum(1, sample.per_row(sample.counts))
    out = np.zeros(len(toxic), int)
    hit = np.flatnonzero(toxic == 1)
    place = np.empty(len(hit), int)
    place[np.argsort(density[hit], kind="stable")] = np.arange(len(hit))
    out[hit] = 1 + place * GRADES // max(1, len(hit))
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = MAX_TRAIN) -> Ordinal:
    features = training_rows(_inputs(docs), labels, label, limit).mapInArrow(
        _raw_features, "doc_id long, label int, columns array<int>, counts array<int>")
    # One row of each id, so that the sample is bounded by its ids: the fewest features, then the least.
    one = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.size("columns"), "columns", "counts"))
    sample = Sample.of(features.withColumn("one", one).where("one = 1").drop("one").toArrow())
    if not sample.toxic.any():
        return Ordinal(np.zeros(BUCKETS), np.full(GRADES, 35.0))
    return _descend(sample, grade(sample))


def likelihood(z: np.ndarray, grades: np.ndarray, first: float, gaps: np.ndarray
               ) -> tuple[float, np.ndarray, np.ndarray]:
    """Mean negative log likelihood of the grades, and its slopes by z and by (first, gaps)."""
    n = len(grades)
    b = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
    p = 1 / (1 + np.exp(-np.clip(z[:, None] - b[None, :], -35, 35)))  # P(>= k)
    upper = np.concatenate([np.ones((n, 1)), p], axis=1)[np.arange(n), grades]
    lower = np.concatenate([p, np.zeros((n, 1))], axis=1)[np.arange(n), grades]
    mass = np.maximum(upper - lower, 1e-9)
    d_upper, d_lower = upper * (1 - upper) / mass, lower * (1 - lower) / mass
    g_b = np.zeros(GRADES)
    at = grades > 0
    np.add.at(g_b, grades[at] - 1, d_upper[at] / n)
    at = grades < GRADES
    np.add.at(g_b, grades[at], -d_lower[at] / n)
    g_gap = np.array([g_b[k + 1:].sum() * np.exp(gaps[k]) for k in range(GRADES - 1)])
    return float(-np.log(mass).mean()), -(d_upper - d_lower) / n, np.concatenate([[g_b.sum()], g_gap])


def _descend(sample: Sample, grades: np.ndarray) -> Ordinal:
    """Full-batch proximal Adam on the cumulative-link likelihood. Thresholds are b_1 and positive gaps.

    The features are held twice, by row and by feature, each in 32-bit arrays, so that both sums of a step
    are sums over neighbours.
    """
    used = np.flatnonzero(np.bincount(sample.columns, minlength=BUCKETS))
    number = np.zeros(BUCKETS, np.int32)
    number[used] = np.arange(len(used), dtype=np.int32)
    column, x = number[sample.columns], value(sample.counts).astype(np.float32)
    by_column = np.argsort(column, kind="stable").astype(np.int32)
    rows_of, x_of = sample.rows[by_column], x[by_column]
    edge = np.concatenate(([0], np.cumsum(np.bincount(column, minlength=len(used))))).astype(np.int64)
    del by_column
    full = np.flatnonzero(np.diff(sample.begin))
    starts = sample.begin[full]
    w = np.zeros(len(used))
    first, gaps = 2.0, np.zeros(GRADES - 1)
    state = np.zeros((2, len(used) + GRADES))
    for step in range(1, STEPS + 1):
        z = np.zeros(len(grades))
        if len(full):
            z[full] = np.add.reduceat(w.astype(np.float32)[column] * x, starts, dtype=float)
        _, slope, g_b = likelihood(z, grades, first, gaps)
        g_w = np.add.reduceat(slope.astype(np.float32)[rows_of] * x_of, edge[:-1], dtype=float) if len(used) else w
        g = np.concatenate([g_w, g_b])
        state[0] = 0.9 * state[0] + 0.1 * g
        state[1] = 0.999 * state[1] + 0.001 * g ** 2
        rate = 0.05 / (np.sqrt(state[1] / (1 - 0.999 ** step)) + 1e-6)
        move = rate * state[0] / (1 - 0.9 ** step)
        w -= move[:len(used)]
        w = np.sign(w) * np.maximum(np.abs(w) - np.minimum(rate[:len(used)] * L1, 0.05), 0)
        first -= move[len(used)]
        gaps = np.clip(gaps - move[len(used) + 1:], -4, 3)
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return Ordinal(weights, first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))]))


def score(docs: DataFrame, model: Ordinal) -> DataFrame:
    """``doc_id, held_out, p_1, p_2, p_3, severity, toxic``: severity is expected, 0 to GRADES."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches_in_blocks(batches, "text"):
            rows, columns, counts = hashed_words(texts, BUCKETS, PREFIXES)
            p = model.at_least(rows, columns, counts, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(p[:, k].copy()) for k in range(GRADES)], pa.array(p.sum(1))],
                ["doc_id", *[f"p_{k + 1}" for k in range(GRADES)], "severity"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    probabilities = ", ".join(f"p_{k + 1} double" for k in range(GRADES))
    return _inputs(docs).mapInArrow(run, f"doc_id {kind}, {probabilities}, severity double").select(
        "doc_id", held_out().alias("held_out"), *[f"p_{k + 1}" for k in range(GRADES)], "severity",
        (F.col("p_1") >= FLAG).alias("toxic"))
