"""Removal of repeated 13-word windows against a plain count of all windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from tidemark.llm import phrase_automata as op
from tidemark.llm.queries import QUERIES

DOCS = "doc_id long, text string, seed long, hash long, kept string"


def plain(rows, window=13):
    """Words kept, words, words removed of each row."""
    split = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (d, _), words in zip(rows, split):
        if d is not None:
            for i in range(len(words) - window + 1):
                key = tuple(words[i:i + window])
                first[key] = min(first.get(key, d), d)
    out = []
    for (d, _), words in zip(rows, split):
        gone = set()
        for i in range(len(words) - window + 1):
            if d is not None and first.get(tuple(words[i:i + window]), d) < d:
                gone.update(range(i, i + window))
        out.append((str(d), " ".join(w for i, w in enumerate(words) if i not in gone), len(words), len(gone)))
    return sorted(out)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(8)
    word = lambda: f"w{r.randrange(60)}" if r.random() < 0.7 else f"r{r.randrange(9999)}"
    passages = [[word() for _ in range(n)] for n in (12, 13, 14, 30, 80)]
    out = []
    for i in range(80):
        words = [word() for _ in range(r.randrange(60))]
        for _ in range(r.randrange(4)):
            p = r.choice(passages)
            a = r.randrange(3)
            at = r.randrange(len(words) + 1)
            words[at:at] = p[a:len(p) - r.randrange(3)]
        out.append((i * 3 % 80, r.choice([" ", "\n", "\t "]).join(words)))
    common = " ".join(passages[3])
    out += [(200 + i, f"{word()} {common} {' '.join(word() for _ in range(20))}") for i in range(40)]
    out += [(300, None), (301, ""), (302, " \n"), (303, "Is onhe. " * 300), (304, "Is onhe. " * 40), (304, "Is onhe. " * 40),
            (304, common), (None, common), (-5, common), (305, "long " + " ".join(word() for _ in range(30000)))]
    return out


def found(df):
    return sorted((str(r.doc_id), r.kept, r.n_words, r.n_removed) for r in df.collect())


def test_equals_plain_count(spark, rows):
    df = spark.createDataFrame([(d, t, 1, 2, "k") for d, t in rows], DOCS)
    expected = plain(rows)
    assert sum(x[3] for x in expected) > 2000
    assert found(op.dedup(df)) == expected


def test_hot_seeds_and_many_shards(spark, rows, monkeypatch):
    monkeypatch.setattr(op, "HOT_LEAST", 5)
    monkeypatch.setattr(op, "SHARD_PASSAGES", 40)
    df = spark.createDataFrame([(d, t, 1, 2, "k") for d, t in rows], DOCS)
    assert found(op.dedup(df)) == plain(rows)


def test_without_filter(spark, rows):
    df = spark.createDataFrame([(d, t, 1, 2, "k") for d, t in rows], DOCS)
    assert found(op.dedup(df, filter_bits=0)) == plain(rows)


def test_other_window(spark, rows):
    df = spark.createDataFrame([(d, t, 1, 2, "k") for d, t in rows], DOCS)
    assert found(op.dedup(df, window=4)) == plain(rows, 4)


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    expected = [(d, n, g, hashlib.sha256(k.encode()).hexdigest()) for d, k, n, g in plain(rows)]
    got = [(str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op9_phrase_automata"](spark, sf).collect()]
    assert sorted(got) == sorted(expected)


A = b"one two three four five"
B = b"nine two three four two three four"


def test_automaton_locates_every_occurrence():
    low = op.locate([A, B], np.array([1, 7]), np.array([1, 9]), 3)
    assert low[0].tolist() == [op.NEVER, 1, op.NEVER] and low[1].tolist() == [7, 1, 7, 7, 1]


def test_the_automaton_decides_and_not_the_hash(monkeypatch):
    want = [x.tolist() for x in op.locate([A, B, A], np.array([1, 7, 3]), np.array([1, 9, 3]), 3)]
    monkeypatch.setattr(op, "window_hashes", lambda words, k: np.zeros(len(words) - k + 1, np.uint64))
    assert [x.tolist() for x in op.locate([A, B, A], np.array([1, 7, 3]), np.array([1, 9, 3]), 3)] == want


def test_more_words_than_characters():
    numbers = np.array([0, 1, -1, (1 << 20) + 5, 70_000])
    text, width = op._as_text(numbers, 1 << 21)
    assert width == 2 and len(text) == 10 and len({text[i:i + 2] for i in range(0, 10, 2)}) == 5
    assert op._as_text(numbers[:2], 2)[1] == 1


def thue_morse(flip):
    return "".join("ab"[bin(i).count("1") % 2 ^ flip] for i in range(1024))


def test_one_word_that_differs(spark):
    """Twelve words equal and one different, whose hashes agree in full (Thue-Morse) or by half."""
    block = op.Block([thue_morse(0).encode(), thue_morse(1).encode()])
    starts, ends = block.segments(op.WHITE)
    hashes = block.hashes(starts, ends)
    assert hashes[0] == hashes[1]
    other = " ".join(f"t{i}" for i in range(12))
    rows = [(1, f"{other} {thue_morse(0)}"), (2, f"{other} {thue_morse(1)}"), (3, f"{other} {thue_morse(0)}")]
    rows += [(10 + i, f"user{n} logged in from the same old place at the very same hour") for i, n in enumerate((12222, 46022) * 9)]
    df = spark.createDataFrame([(d, t, 1, 2, "k") for d, t in rows], DOCS)
    assert found(op.dedup(df)) == plain(rows)


def test_empty(spark):
    assert op.dedup(spark.createDataFrame([], DOCS)).collect() == []
