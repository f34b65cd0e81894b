"""PPM language identification: exact code lengths against a plain coder, and held-out accuracy."""

import collections
import math
import random
import zlib

import numpy as np
import pytest

from tidemark.llm import language_ppm as op
from tidemark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string"


def plain_counts(texts):
    """{order: {context: {symbol: n}}} of the texts, each after ``ORDER`` line feeds."""
    out = [collections.defaultdict(collections.Counter) for _ in range(op.ORDER + 1)]
    for text in texts:
        padded = b"\n" * op.ORDER + text
        for at in range(op.ORDER, len(padded)):
            for k in range(op.ORDER + 1):
                out[k][padded[at - k:at]][padded[at]] += 1
    return out


def plain_bits(counts, text, least=1):
    """Code length by the definition, symbol by symbol, with exclusion."""
    padded, total = b"\n" * op.ORDER + text, 0.0
    for at in range(op.ORDER, len(padded)):
        excluded = set()
        for k in range(op.ORDER, -1, -1):
            seen = counts[k].get(padded[at - k:at], {})
            if k and sum(seen.values()) < least:
                seen = {}
            left = {s: n for s, n in seen.items() if s not in excluded}
            if not left:
                continue
            escape = len(left) if len(seen) < 256 else 0
            space = sum(left.values()) + escape
            if padded[at] in left:
                total -= math.log2(left[padded[at]] / space)
                break
            total -= math.log2(escape / space)
            excluded |= set(left)
        else:
            total += math.log2(max(256 - len(excluded), 1))
    return total


def tree(counts, least=1):
    keys, ns = [], []
    for k, contexts in enumerate(counts):
        flat = sorted((int.from_bytes(c, "big") << 8 | s, n) for c, seen in contexts.items()
                      if k == 0 or sum(seen.values()) >= least for s, n in seen.items())
        keys.append(np.array([a for a, _ in flat], np.uint32))
        ns.append(np.array([b for _, b in flat], np.int64))
    return op.Tree(keys, ns)


@pytest.mark.parametrize("least", [1, 4, 64, 10_000])
def test_exact_code_length(least):
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"abcab \xc3\xa9") for _ in range(rng.randrange(0, 60))) for _ in range(40)]
    counts = plain_counts(texts)
    model = {"x": tree(counts, least)}
    asked = texts[:10] + [b"", b"zzz", b"abz\x00ab", bytes(range(256))]
    got = op.code_lengths(asked, model)[:, 0]
    np.testing.assert_allclose(got, [plain_bits(counts, t, least) for t in asked], rtol=1e-9)


def test_probabilities_sum_to_one():
    counts = plain_counts([b"the cat sat on the mat", b"that hat", bytes(range(256))])
    model = tree(counts)
    for context in (b"the", b"\n\n\n", b"at ", b"qqq", b"zzt"):
        codes = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint32)
        assert np.exp2(-model.bits(codes)).sum() == pytest.approx(1, abs=1e-9)


def test_slices_do_not_matter(monkeypatch):
    texts = [b"one two three", b"", b"four", b"x" * 50]
    whole = plain_counts(texts)
    model = {"a": tree(whole)}
    want = op.code_lengths(texts, model)
    monkeypatch.setattr(op, "SLICE", 7)
    np.testing.assert_allclose(op.code_lengths(texts, model), want)


def is_held_out(i):
    return i is None or zlib.crc32(str(i).encode()) % 5 == 0


WORDS = {"en": "the of and house water light thing with", "de": "der die und haus wasser licht ding für"}


def rows():
    rng = random.Random(4)
    out = [(i, " ".join(rng.choice(WORDS[lang].split()) for _ in range(12)), lang)
           for i in range(120) for lang in [("en", "de")[i % 2]]]
    return out + [(500, None, "en"), (501, "", "de"), (502, "12 34 !?", "en"), (None, "der die und", "xx"), (503, "haus " * 60_000, None),
                  (504, "the light thing", None), (504, "the light thing", None)]


def test_counts_and_predictions(spark):
    given = rows()
    df = spark.createDataFrame(given, SCHEMA).repartition(3).selectExpr("*", "'en' as lang_pred", "1 as n", "2 as told", "3 as gram")
    trees = op.fit(df)
    assert list(trees) == ["de", "en"]
    for lang, model in trees.items():
        counts = plain_counts([t.encode() for i, t, own in given if own == lang and t is not None and not is_held_out(i)])
        for k, level in enumerate(model.levels):
            want = {(int.from_bytes(c, "big") << 8 | s): n for c, seen in counts[k].items() for s, n in seen.items()}
            assert dict(zip(level.keys.tolist(), np.round(np.exp2(level.log_n)).astype(int).tolist())) == want
    out = op.predict(df, trees).collect()
    assert len(out) == len(given)
    by = collections.defaultdict(list)
    for r in out:
        by[r.doc_id].append(r)
        assert r.held_out == is_held_out(r.doc_id) and 0 <= r.score <= 1
    assert all(by[i][0].lang_pred == lang for i, _, lang in given[:120])
    assert [(by[i][0].lang_pred, by[i][0].score) for i in (500, 501, 502)] == [("und", 0.0)] * 3
    assert by[503][0].lang_pred == "de" and [r.lang_pred for r in by[504]] == ["en", "en"] and by[None][0].lang_pred == "de"


def test_bounded_trees(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    full = sum(len(v.keys) for t in op.fit(df).values() for v in t.levels[1:])
    trees = op.fit(df, full // 2)
    assert 0 < sum(len(v.keys) for t in trees.values() for v in t.levels[1:]) <= full // 2
    out = op.predict(df, trees).where("doc_id < 120").collect()
    assert all(r.lang_pred == ("en", "de")[r.doc_id % 2] for r in out)


def test_nothing_learnt(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert op.predict(empty, op.fit(empty)).collect() == []
    df = spark.createDataFrame([(1, "words", None), (2, None, "en")], SCHEMA)
    assert {(r.doc_id, r.lang_pred, r.score) for r in op.predict(df, op.fit(df)).collect()} == {(1, "und", 0.0), (2, "und", 0.0)}


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op11_language_ppm"](spark, sf)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    told = spark.read.parquet(f"{sf}/documents.parquet").where("lang is not null").select("doc_id", "lang")
    right = [r.lang == r.lang_pred for r in got.where("held_out and lang_pred <> 'und'").join(told, "doc_id").collect()]
    assert sum(right) >= 0.98 * len(right) > 100
