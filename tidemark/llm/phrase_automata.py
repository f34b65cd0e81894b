"""Substring dedup with repeated-phrase automata.

A word is removed if some ``WINDOW`` consecutive words that cover it also start in a document with a smaller
id. Windows that recur are found and located in four steps.

1. *Seeds.* Of the ``SEED``-word phrases inside a window the one with the least hash is its seed: equal
   windows have equal seeds, and neighbouring windows mostly share theirs, so a document has a seed for
   some five words. Seeds of two documents or more are *recurring*; all other windows cannot recur.
2. *Passages.* Around every recurring seed a document has a passage: the words of all windows with that
   seed. Equal passages are one row, with the smallest and the largest document they occur in.
3. *Automata.* Passages, with their words, are dealt to shards by their seed. A shard numbers its distinct
   words, compiles the windows that may occur in two documents, as sequences of word numbers, into an
   Aho-Corasick automaton, and streams its passages through it. The automaton decides which windows are
   equal: its hits give every occurrence of a window and so the first and last document it occurs in. Hashes
   only choose which windows to compile; windows that share the hash of a compiled one but are not hit are
   compiled next, until none is left.
4. *Removal.* The windows' first documents go back to the documents that hold the passage; words covered by
   a window with a smaller first document are removed.

Documents learn which of their seeds recur from a Bloom filter of at most ``FILTER_BITS``, so their texts
are not shuffled for it; a filter's false positives only add passages that step 3 does not confirm. More
recurring seeds than it can hold are joined to the documents instead.

Hot groups. Steps 1 and 2 are aggregates with map-side combine, step 4 joins two plain scans, whose skewed
partitions Spark splits. A seed in more than ``1 / HOT_SHARE`` of the documents (at least ``HOT_LEAST``) may
have as many different surroundings: its passages are single windows, dealt by their own hash, not by the
seed; at most ``HOT_SHARE`` times the seeds of an average document are hot, which bounds what tasks are sent.

Rows. Null and empty texts have no words. A document without id, or of fewer than ``WINDOW`` words, neither
removes nor loses words. Rows of one id do not remove each other's words, and each is judged by its own
text; repeated rows come back as often. Extra columns are ignored; empty tables give no rows. A very long
document is a block of its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import Any

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.frames import clash_free, stored
from tidemark.llm.textblocks import Block, WHITE, batches_in_blocks, mix, window_hashes

WINDOW = 13
SEED = 5
FILTER_BITS = 1 << 26
FILTER_HASHES = 3
#: Filter bits for each recurring seed; beyond FILTER_BITS / PER_SEED seeds the exact join is taken.
PER_SEED = 10
_SEGMENTS = 256
HOT_SHARE = 20_000
HOT_LEAST = 2_000
#: Passages of a shard. An automaton looks its root's children up one by one, so small ones build much faster.
SHARD_PASSAGES = 400
NEVER = np.iinfo(np.int64).max


class Runs:
    """The windows of a block by their seeds: runs of windows of one document that share a seed."""

    def __init__(self, texts: list[bytes], window: int):
        self.block = block = Block(texts)
        self.starts, self.ends = block.segments(WHITE)
        self.doc = block.documents_of(self.starts)
        self.words = block.hashes(self.starts, self.ends)
        n = len(self.words) - window + 1
        if n <= 0:
            self.first = self.last = np.zeros(0, np.int64)
            self.seed = np.zeros(0, np.int64)
            return
        grams = window_hashes(self.words, min(SEED, window))
        width = window - min(SEED, window) + 1
        # Sliding minimum with its leftmost place.
        place = np.arange(n) + np.lib.stride_tricks.sliding_window_view(grams, width)[:n].argmin(1)
        good = self.doc[:n] == self.doc[window - 1:]
        new = np.ones(n, bool)
        new[1:] = (place[1:] != place[:-1]) | (self.doc[1:n] != self.doc[:n - 1]) | ~good[:-1]
        new &= good
        self.first = np.flatnonzero(new)
        stop = np.flatnonzero(new | ~good)
        nxt = np.searchsorted(stop, self.first, side="right")
        self.last = np.append(stop, n)[nxt] - 1
        self.seed = grams[place[self.first]].view(np.int64)

    def passages(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The words from ``first`` to ``last``, both included, one space between them."""
        size = self.ends - self.starts
        begin = np.cumsum(size + 1) - (size + 1)
        plain = np.full(int((size + 1).sum()), 0x20, np.uint8)
        inside = np.ones(len(plain), bool)
        inside[begin + size] = False
        plain[inside] = self.block.a[~WHITE[self.block.a]]
        data = plain.tobytes()
        return [data[a:b] for a, b in zip(begin[first].tolist(), (begin + size)[last].tolist())]


def digest(passage: bytes) -> bytes:
    """128 bits that tell passages apart."""
    return hashlib.blake2b(passage, digest_size=16).digest()


def _texts(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` and ``row``, which tells rows of one id with different texts apart."""
    return clash_free(docs, "doc_id", "text").select(
        "doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("row"))


def seeds(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``seed, doc_id``, once for each document row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches_in_blocks(batches, "text"):
            runs = Runs(texts, window)
            doc = runs.doc[runs.first]
            order = np.lexsort((runs.seed, doc))
            d, s = doc[order], runs.seed[order]
            keep = np.ones(len(d), bool)
            keep[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
            ids = batch.column(0).cast(pa.int64()).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays([pa.array(s[keep]), pa.array(ids[d[keep]])], ["seed", "doc_id"])

    return _texts(docs).where("doc_id is not null").mapInArrow(run, "seed long, doc_id long")


def _bit_places(seed: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The segment of the filter each seed falls in, and its bits there: shapes (n,), (n, FILTER_HASHES)."""
    h = mix(seed.view(np.uint64) ^ np.uint64(0x5BD1E995))
    segment = (h >> np.uint64(56)).astype(np.int64)
    own = bits // _SEGMENTS
    places = np.stack([mix(h + np.uint64(i + 1)) % np.uint64(own) for i in range(FILTER_HASHES)], axis=1)
    return segment, places.astype(np.int64)


def _filter(recurring: DataFrame, count: int) -> tuple[int, bytes]:
    """Bloom filter of the recurring seeds, built in segments by tasks; its size is bounded beforehand."""
    bits = 1 << 16
    while bits < PER_SEED * count:
        bits *= 2

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seed = batch.column(0).to_numpy(zero_copy_only=False)
            segment, _ = _bit_places(seed, bits)
            yield pa.RecordBatch.from_arrays([pa.array(segment), batch.column(0)], ["segment", "seed"])

    def build(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        own = np.zeros(bits // _SEGMENTS, np.uint8)
        own[_bit_places(rows.seed.to_numpy(), bits)[1].ravel()] = 1
        return pd.DataFrame({"segment": [key[0]], "bits": [np.packbits(own).tobytes()]})

    parts = recurring.select("seed").mapInArrow(tag, "segment long, seed long").groupBy("segment").applyInPandas(
        build, "segment long, bits binary").collect()
    size = bits // _SEGMENTS // 8
    out = bytearray(bits // 8)
    for part in parts:
        out[part.segment * size:(part.segment + 1) * size] = part.bits
    return bits, bytes(out)


def _passes(seed: np.ndarray, bits: int, table: np.ndarray) -> np.ndarray:
    segment, places = _bit_places(seed, bits)
    at = segment[:, None] * (bits // _SEGMENTS) + places
    return ((table[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(1)


def _marked(docs: DataFrame, found: DataFrame, recurring: DataFrame, filter_bits: int
            ) -> tuple[DataFrame, Callable[[np.ndarray, pa.RecordBatch, np.ndarray], np.ndarray]]:
    """Documents, and the test of which seeds of a batch recur: by a filter, or by joined lists of seeds."""
    count = recurring.count()
    if count * PER_SEED <= filter_bits:
        bits, table = _filter(recurring, count)

        def passes(seed, batch, doc):
            return _passes(seed, bits, np.frombuffer(table, np.uint8))

        return _texts(docs), passes
    lists = stored(found.join(recurring.select("seed"), "seed").groupBy("doc_id").agg(
        F.sort_array(F.collect_set("seed")).alias("seeds")), "phrase-lists")  # a document's length bounds its list

    def listed(seed, batch, doc):
        out = np.zeros(len(seed), bool)
        own = batch.column(3)
        for d in np.unique(doc).tolist():
            at = np.flatnonzero(doc == d)
            out[at] = np.isin(seed[at], np.array(own[d].as_py() or [], np.int64))
        return out

    return _texts(docs).join(lists, "doc_id", "left").select("doc_id", "text", "row", "seeds"), listed


def _passages(docs: DataFrame, passes, hot: np.ndarray, window: int, content: bool) -> DataFrame:
    """A row for each passage of each document: ``seed, hash, doc_id`` and ``words, hot`` or ``row, place``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches_in_blocks(batches, "text"):
            runs = Runs(texts, window)
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            doc = runs.doc[runs.first]
            at = np.flatnonzero(known[doc] & passes(runs.seed, batch, doc)) if len(doc) else np.zeros(0, np.int64)
            first, last, seed = runs.first[at], runs.last[at], runs.seed[at]
            single = np.isin(seed, hot)
            if single.any():  # one passage for each window
                per = np.where(single, last - first + 1, 1)
                step = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
                first, last, seed, single = (np.repeat(x, per) for x in (first, last, seed, single))
                first = first + step
                last = np.where(single, first, last)
            if not len(first):
                continue
            end = last + window - 1  # the last word
            words = runs.passages(first, end)
            own = runs.doc[first]
            ids = batch.column(0).cast(pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)[own]  # known, see above
            arrays = [pa.array(seed), pa.array([digest(w) for w in words], pa.binary()), pa.array(ids)]
            names = ["seed", "hash", "doc_id"]
            if content:
                arrays += [pa.array(words, pa.binary()), pa.array(single)]
                names += ["words", "hot"]
            else:
                rows = batch.column(2).to_numpy(zero_copy_only=False)
                base = np.searchsorted(runs.doc, np.arange(runs.block.n))
                arrays += [pa.array(rows[own]), pa.array((first - base[own]).astype(np.int32))]
                names += ["row", "place"]
            yield pa.RecordBatch.from_arrays(arrays, names)

    extra = "words binary, hot boolean" if content else "row long, place int"
    return docs.mapInArrow(run, f"seed long, hash binary, doc_id long, {extra}")


def _as_text(numbers: np.ndarray, distinct: int) -> tuple[str, int]:
    """Word numbers (-1: a gap) as characters, and how many stand for a word: one, or two from different
    alphabets where a plane of characters is not enough."""
    gap = numbers < 0
    if distinct < 1 << 20:
        codes = np.where(gap, 0x20, numbers + 0x10000)
        return codes.astype("<u4").tobytes().decode("utf-32-le"), 1
    codes = np.stack([np.where(gap, 0x20, (numbers >> 16) + 0x10000), np.where(gap, 0x20, (numbers & 0xFFFF) + 0x20000)], axis=1)
    return codes.astype("<u4").tobytes().decode("utf-32-le"), 2


def locate(passages: list[bytes], least: np.ndarray, most: np.ndarray, window: int) -> list[np.ndarray]:
    """For each passage the first document of each of its windows (``NEVER``: it does not recur).

    ``least`` and ``most`` are the smallest and largest document a passage occurs in. The shard's words
    become numbers, its passages one text with a gap behind each; an automaton reads the text once.
    """
    size = np.array([p.count(b" ") + 1 for p in passages], np.int64)
    per = np.maximum(size - window + 1, 0)
    out_of = np.cumsum(size + 1) - (size + 1)  # where each passage starts
    lows = np.full(int((size + 1).sum()), NEVER)
    if per.sum():
        known: dict[bytes, int] = {}
        words = b" ".join(passages).split(b" ")
        numbers = np.full(len(lows), -1, np.int64)
        numbers[np.arange(size.sum()) + np.repeat(np.arange(len(passages)), size)] = np.fromiter(
            (known.setdefault(w, len(known)) for w in words), np.int64, len(words))
        text, width = _as_text(numbers, len(known))
        own = np.repeat(np.arange(len(passages)), per)
        start = out_of[own] + np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        # Equal windows have equal keys; keys of two documents may hold some.
        _, group = np.unique(window_hashes(mix(numbers.astype(np.uint64)), window)[start], return_inverse=True)
        low, high = np.full(group.max() + 1, NEVER), np.full(group.max() + 1, -NEVER - 1)
        np.minimum.at(low, group, least[own])
        np.maximum.at(high, group, most[own])
        left = np.flatnonzero((low < high)[group])
        window_at = np.full(len(lows), -1)
        window_at[start] = np.arange(len(start))
        while len(left):
            machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_STRING)
            first = left[np.unique(group[left], return_index=True)[1]]
            for n, at in enumerate((start[first] * width).tolist()):
                machine.add_word(text[at:at + window * width], n)
            machine.make_automaton()
            hits = np.array(list(machine.iter(text)), np.int64).reshape(-1, 2)
            hit, phrase = window_at[(hits[:, 0] + 1) // width - window], hits[:, 1]
            low, high = np.full(len(first), NEVER), np.full(len(first), -NEVER - 1)
            np.minimum.at(low, phrase, least[own[hit]])
            np.maximum.at(high, phrase, most[own[hit]])
            recurs = (low < high)[phrase]
            lows[start[hit[recurs]]] = low[phrase[recurs]]
            left = np.setdiff1d(left, hit)
    return [lows[a:a + n] for a, n in zip(out_of.tolist(), per.tolist())]


def _located(passages: DataFrame, shards: int, window: int) -> DataFrame:
    """Rows ``seed, hash, low, firsts`` of the passages with a recurring window."""

    def shard(key: tuple[Any, ...], rows: pd.DataFrame) -> pd.DataFrame:
        found = locate(list(rows.words), rows.low.to_numpy(), rows.high.to_numpy(), window)
        low = np.array([f.min() if len(f) else NEVER for f in found])
        keep = low < rows.high.to_numpy()  # some document that holds the passage loses words
        return pd.DataFrame({"seed": rows.seed[keep], "hash": rows.hash[keep], "low": low[keep],
                             "firsts": [f.tobytes() for f, k in zip(found, keep) if k]})

    dealt = passages.withColumn("shard", F.pmod(F.when(F.col("hot"), F.xxhash64("hash")).otherwise(F.xxhash64("seed")), F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(shard, "seed long, hash binary, low long, firsts binary")


def _cover(docs: DataFrame, covers: DataFrame, window: int) -> DataFrame:
    """Every row of ``docs`` with its remaining words, ``n_words`` and ``n_removed``."""
    width = len(docs.columns)
    rest = [StructField("kept", StringType()), StructField("n_words", LongType()), StructField("n_removed", LongType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches_in_blocks(batches, "_text"):
            own = batch.column(batch.schema.get_field_index("doc_id"))
            covered = batch.column(width + 1)
            kept, words_of, removed = [], [], []
            for i, text in enumerate(texts):
                words = text.split()
                words_of.append(len(words))
                if not covered[i].is_valid:
                    kept.append(b" ".join(words).decode("utf-8"))
                    removed.append(0)
                    continue
                gone = np.zeros(len(words) + 1, np.int64)
                for cover in covered[i].as_py():
                    at = cover["place"] + np.flatnonzero(np.frombuffer(cover["firsts"], np.int64) < own[i].as_py())
                    gone[at] += 1  # the places of one passage differ
                    np.subtract.at(gone, at + window, 1)
                lost = np.cumsum(gone)[:len(words)] > 0
                kept.append(b" ".join([w for w, x in zip(words, lost.tolist()) if not x]).decode("utf-8"))
                removed.append(int(lost.sum()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(width)], pa.array(kept, pa.string()), pa.array(words_of, pa.int64()),
                 pa.array(removed, pa.int64())], [*batch.schema.names[:width], "kept", "n_words", "n_removed"])

    fields = docs.schema.fields
    joined = docs.withColumn("_row", F.xxhash64("text")).join(covers.select(F.col("doc_id").alias("_doc"), F.col("row").alias("_at"), "covers"),
                       (F.col("doc_id") == F.col("_doc")) & (F.col("_row") == F.col("_at")), "left")
    return joined.select(*[F.col(f"`{f.name}`") for f in fields], F.col("text").cast("binary").alias("_text"), "covers").mapInArrow(
        run, StructType([*fields, *rest]))


def with_kept(docs: DataFrame, window: int = WINDOW, filter_bits: int = FILTER_BITS) -> DataFrame:
    """All rows and columns of ``docs``, with the remaining words joined by one space (``kept``), the number
    of words (``n_words``) and of those removed (``n_removed``)."""
    found = seeds(docs, window)
    counted = stored(found.groupBy("seed").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("*").alias("n")).where("low < high").select(
            "seed", "n"), "phrase-seeds")
    hot_from = max(HOT_LEAST, clash_free(docs, "doc_id").count() // HOT_SHARE)
    # At most HOT_SHARE times the seeds of an average document.
    hot = np.array(sorted(r.seed for r in counted.where(F.col("n") > hot_from).select("seed").collect()), np.int64)
    texts, passes = _marked(docs, found, counted, filter_bits)
    passages = stored(_passages(texts, passes, hot, window, True).groupBy("seed", "hash").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.first("words").alias("words"), F.max("hot").alias("hot")).where(
            ~F.col("hot") | (F.col("low") < F.col("high"))), "phrase-passages")
    shards = max(1, -(-passages.count() // SHARD_PASSAGES))
    located = stored(_located(passages, shards, window), "phrase-located")
    covers = _passages(texts, passes, hot, window, False).join(located, ["seed", "hash"]).where("low < doc_id").groupBy(
        "doc_id", "row").agg(F.collect_list(F.struct("place", "firsts")).alias("covers"))  # a document's length bounds it
    return _cover(docs, covers, window)


def dedup(docs: DataFrame, window: int = WINDOW, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``doc_id, kept, n_words, n_removed`` of every document."""
    return with_kept(clash_free(docs, "doc_id", "text"), window, filter_bits).drop("text")
