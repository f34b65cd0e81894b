"""Chunked encoding, decoding and transducer counts against the tokenizers library, whole texts."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from tidemark.llm import bpe_chunks, token_fst
from tidemark.llm.queries import QUERIES

ODD = ["", "   ", None, "a", "don't I'll'S 'tis", "x<|endoftext|>y<|startoftext|><|endoftext|>", "Σας ΌΣΟΣ", "İstanbul",
       "e\u0301 \u0301a", "日本語 テキスト" * 300, "\u00a0a\u00a0b\u3000c", "😀😀🎉" * 500, " " * 9000 + "a", "ab" * 6000,
       "tail " * 2000, "!!!??? ..." * 300, "<|endoftext|>" * 400, "e\u0301" * 5000, "x e\u0301" * 3000, "a\x00b\x7f", "½ Ⅷ ² ﬁ"]
DOCS = "doc_id long, text string, ids string, n_tokens long"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe_chunks.VOCABULARY)


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(4)
    passage = " ".join(f"word{r.randrange(999)}" for _ in range(600))
    rows = [(i, t) for i, t in enumerate(ODD)]
    rows += [(100 + i, "".join(r.choice(["ab", " ", "C", "é", "\n", "'s", "12", "."]) for _ in range(3000))) for i in range(5)]
    rows += [(200 + i, passage[i * 7:] + f" end{i} " + passage) for i in range(8)] + [(None, "no id"), (3, "a"), (3, "a")]
    return rows, spark.createDataFrame([(d, t, "i", 0) for d, t in rows], DOCS)


def test_ids_and_text_are_the_library_s(spark, docs, library):
    rows, df = docs
    got = bpe_chunks.decode(bpe_chunks.encode(df)).collect()
    expected = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((str(d), str(ids), library.decode(ids, skip_special_tokens=False)))
    assert sorted((str(r.doc_id), str(list(r.ids)), r.decoded) for r in got) == sorted(expected)


def test_joins_are_repaired(library):
    encoder = bpe_chunks.Encoder(bpe_chunks.VOCABULARY)
    r = random.Random(1)
    text = "".join(r.choice("abcdefgh <|é") for _ in range(20000)).encode()
    starts, _ = bpe_chunks.cuts(bpe_chunks.Block([text]))
    assert len(starts) > 10
    ids = encoder.texts([text, text])
    assert ids[0] == ids[1] and len(encoder._joins) > 5
    assert list(memoryview(ids[0]).cast("I")) == library.encode(text.decode(), add_special_tokens=False).ids


def test_counts_are_the_library_s(docs, library):
    rows, df = docs
    got = token_fst.token_counts(df).collect()
    expected = [(str(d), len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for d, t in rows]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == sorted(expected)
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got) and any(r.over_limit for r in got)


def test_words_with_equal_hashes(library):
    """Thue-Morse words: their polynomial hashes agree whatever the base, their tokens do not."""
    a, b = ("".join("ab"[bin(i).count("1") % 2 ^ flip] for i in range(1024)) for flip in (0, 1))
    counter = token_fst.Counter(token_fst.VOCABULARY)
    texts = [f"x {a}x {b}x y", f"x {b}q {a}q y {b} z {a} {a} z", f"{a} {b}"]
    got = counter.texts([t.encode() for t in texts])
    assert got.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_maps_compose_in_any_order():
    counter = token_fst.Counter(token_fst.VOCABULARY)
    text = b"some words, don't <|endoftext|> break anywhere at all"
    for size in (1, 2, 3, 7, 100):
        maps = []
        for at in range(0, len(text), size):
            part = text[at:at + size]
            words = part.split()
            inner = words[0 if part[:1].isspace() else 1: len(words) if part[-1:].isspace() else -1]
            maps.append(counter._map(part, sum(map(counter.word, inner))))
        left = maps[0]
        for m in maps[1:]:
            left = token_fst.compose(left, m, counter.word)
        assert token_fst.scan(maps, counter.word) == token_fst.scan([left], counter.word) == sum(
            map(counter.word, text.split()))


def test_queries_on_the_given_tables(spark, library):
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    counts = {r.doc_id: r.n_tokens for r in QUERIES["op10_token_fst"](spark, sf).collect()}
    got = QUERIES["op2_bpe_chunks"](spark, sf).collect()
    assert len(got) == len(text) == len(counts)
    for r in got:
        ids = library.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == counts[r.doc_id] == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_empty_table(spark):
    empty = spark.createDataFrame([], DOCS)
    assert bpe_chunks.digests(empty).count() == 0 and token_fst.token_counts(empty).count() == 0
