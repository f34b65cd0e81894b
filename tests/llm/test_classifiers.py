"""Quality and toxicity: held-out accuracy, and rows of every odd kind."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality_fm, toxicity_ordinal
from tidemark.llm.features import hashed_words, structure
from tidemark.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"
DOCS = "doc_id long, text string, n_chars long, score double, label int"
ODD = [(1, None, None, 0.0, 1), (2, "", 0, 0.0, 1), (3, "a " * 40000, 5, 0.0, 1), (4, "same", 4, 0.0, 1), (4, "same", 4, 0.0, 1),
       (None, "x\ny", -3, 0.0, 1)]


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def test_quality_on_the_held_out_fold(spark, labels):
    got = QUERIES["op1_quality_fm"](spark, SF).join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    good = [r for r in got if r.quality == 1]
    bad = [r for r in got if r.quality == 0]
    assert sum(r.predicted for r in good) / len(good) > 0.98
    assert sum(1 - r.predicted for r in bad) / len(bad) > 0.9


def test_toxicity_on_the_held_out_fold(spark, labels):
    got = QUERIES["op8_toxicity_ordinal"](spark, SF).join(labels.select("doc_id", F.col("toxic").alias("y")), "doc_id").where(
        "held_out").select("p_1", "p_2", "p_3", "severity", "toxic", "y").collect()
    toxic, clean = [r for r in got if r.y == 1], [r for r in got if r.y == 0]
    assert sum(r.toxic for r in toxic) / len(toxic) > 0.8
    assert sum(r.toxic for r in clean) / len(clean) < 0.01
    assert all(r.p_1 >= r.p_2 >= r.p_3 and abs(r.severity - r.p_1 - r.p_2 - r.p_3) < 1e-9 for r in got)


def test_sum_of_squares_equals_all_pairs():
    r = np.random.default_rng(2)
    m = quality_fm.Machine(0.3, r.normal(size=9), r.normal(size=(9, 4)), np.zeros(0), np.ones(0))
    x = r.normal(size=9)
    z = 0.3 + m.weights @ x + sum(m.factors[i] @ m.factors[j] * x[i] * x[j] for i in range(9) for j in range(i))
    got = m.score(np.zeros(9, int), np.arange(9), x, 1)[0]
    assert abs(got - 1 / (1 + np.exp(-z))) < 1e-12


def test_odd_rows_and_no_labels(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int, text string")
    got = quality_fm.score(docs, quality_fm.fit(docs, none)).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {0.5}
    assert {r.predicted for r in got} == {1} and [r.held_out for r in got if r.doc_id is None] == [True]
    got = toxicity_ordinal.score(docs, toxicity_ordinal.fit(docs, none)).collect()
    assert len(got) == len(ODD) and not any(r.toxic for r in got)
    one = spark.createDataFrame([(4, 1, 1, "z"), (2, 0, 0, "z"), (2, None, None, "z"), (3, 1, 0, "z"), (1, 0, 0, "z")],
                                "doc_id long, quality int, toxic int, text string")
    assert quality_fm.score(docs, quality_fm.fit(docs, one)).count() == len(ODD)
    assert toxicity_ordinal.score(docs, toxicity_ordinal.fit(docs, one)).count() == len(ODD)
    empty = spark.createDataFrame([], DOCS)
    assert quality_fm.score(empty, quality_fm.fit(empty, none)).count() == 0
    assert toxicity_ordinal.score(empty, toxicity_ordinal.fit(empty, none)).count() == 0


def test_features_by_hand():
    rows, cols, counts = hashed_words([b"A a b", b"", b"b"], 1 << 20)
    assert rows.tolist().count(0) == 2 and sorted(counts.tolist()) == [1, 1, 2] and 1 not in rows
    s = structure([b"A a!\nA a!", b""], [9, None])
    names = dict(zip(__import__("tidemark.llm.features", fromlist=["STRUCTURE"]).STRUCTURE, s[0]))
    assert names["distinct_words"] == 0.5 and names["distinct_lines"] == 0.5 and names["upper"] == 0.5
    assert np.isfinite(s).all()


def test_ordinal_slopes_are_those_of_the_likelihood():
    rng = np.random.default_rng(5)
    z, grades = rng.normal(size=40), rng.integers(0, toxicity_ordinal.GRADES + 1, 40)
    first, gaps = 0.3, np.array([0.1, -0.4])
    loss, slope, g_b = toxicity_ordinal.likelihood(z, grades, first, gaps)
    b = first + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
    plain = 0.0
    for v, k in zip(z, grades):
        at_least = [1.0, *[1 / (1 + np.exp(t - v)) for t in b], 0.0]
        plain -= np.log(at_least[k] - at_least[k + 1]) / len(z)
    assert abs(loss - plain) < 1e-12
    h = 1e-6

    def moved(i, by):
        v, t = z.copy(), np.concatenate([[first], gaps])
        if i < len(z):
            v[i] += by
        else:
            t[i - len(z)] += by
        return toxicity_ordinal.likelihood(v, grades, t[0], t[1:])[0]

    for i, g in enumerate(np.concatenate([slope, g_b])):
        assert abs((moved(i, h) - moved(i, -h)) / (2 * h) - g) < 1e-6


def test_sample_keeps_one_row_of_an_id(spark):
    docs = spark.createDataFrame([(i % 7, f"nice words {i}", "en") for i in range(300)] + [(8, "vile scum idiot", "en")] * 50,
                                 "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i == 8)) for i in range(9)], "doc_id long, toxic int")
    model = toxicity_ordinal.fit(docs, labels)
    again = toxicity_ordinal.fit(docs.repartition(7), labels)
    assert np.array_equal(model.weights, again.weights)
