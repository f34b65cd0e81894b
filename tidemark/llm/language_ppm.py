"""Language identification by prediction by partial matching (PPM).

Each language has a context tree over bytes: for every context of up to ``ORDER`` bytes the symbols that
followed it and how often. A byte is coded in the longest context the tree has; a context of T occurrences and
D different symbols gives a symbol seen n times the probability n / (T + D) and leaves D / (T + D) (nothing,
if all 256 were seen) to the *escape* to the context shorter by one byte, where the symbols of the longer one
are excluded: they would have been coded there. Below the empty context all symbols never seen in the language are equally likely. So
each context's probabilities sum to one, and the minus logarithms are the exact length of a text's code. The
statistics are frozen: nothing is learnt from the text that is coded. A document's language is the one with
the shortest code, and the score its share of the probability of the text under all languages.

Counts. They come from every learnable document, whole: tasks count the (ORDER + 1)-grams of bytes of each
language, block by block, and the engine adds them up. With frozen counts what is excluded after an escape
depends on the longer context alone, so each context keeps, besides T and D, what is left of its parent.

Variable order. A context is kept if it was seen at least t times; a shorter one was seen as often at least,
so it is kept too. t is the smallest power of two with which the trees have at most ``MAX_ENTRIES`` entries,
taken from a histogram over all contexts. That bounds what tasks are sent, whatever the corpus's size.

Rows. A null text, or one without a letter, is ``und`` with score 0. Languages are the values of ``lang``;
their number is taken to be small. Null languages, null ids and the held-out fold are not learnt from.
Without any language every document is ``und``. Equal codes go to the first language by name. Text begins
after ``ORDER`` line feeds. Long texts are read in slices. Repeated rows come back as often, repeated ids are
documents of their own; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import clash_free, stored
from tidemark.llm.quality_fm import held_out
from tidemark.llm.textblocks import batches_in_blocks

ORDER = 3
MAX_ENTRIES = 1_500_000
UNDETERMINED = "und"
#: Positions read at a time, and grams a task holds before it hands them on.
SLICE = 1 << 20
HELD_GRAMS = 1 << 21
_PAD = b"\n" * ORDER


def grams(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(document, code)`` of every byte with the ``ORDER`` bytes before it, slice by slice."""
    joined = np.frombuffer(b"".join(part for t in texts for part in (_PAD, t)), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + ORDER)
    for begin in range(0, len(joined) - ORDER, SLICE):
        stop = min(begin + SLICE, len(joined) - ORDER)
        code = np.zeros(stop - begin, np.uint32)
        for k in range(ORDER + 1):
            code = code << np.uint32(8) | joined[begin + k:stop + k]
        place = np.arange(begin + ORDER, stop + ORDER)
        doc = np.searchsorted(ends, place, side="right")
        inside = place - (ends - sizes)[doc] >= 0  # not a line feed before a text
        yield doc[inside], code[inside]


def gram_counts(docs: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all rows ``lang, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers: dict[str, int] = {}
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys = np.concatenate([k for k, _ in held])
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], np.concatenate([n for _, n in held])[order]
            edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            return keys[edge], np.add.reduceat(counts, edge)

        def rows(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            names = pa.array(list(numbers))
            return pa.RecordBatch.from_arrays(
                [names.take(pa.array((keys >> np.uint64(32)).astype(np.int64))),
                 pa.array((keys & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(counts)], ["lang", "gram", "n"])

        for batch, texts in batches_in_blocks(batches, "text"):
            own = np.array([numbers.setdefault(v, len(numbers)) for v in batch.column(0).to_pylist()], np.uint64)
            for doc, code in grams(texts):
                if len(code):
                    held.append(np.unique(own[doc] << np.uint64(32) | code, return_counts=True))
                    size += len(held[-1][0])
            if size > HELD_GRAMS:
                held = [merged()]
                size = len(held[0][0])
                if size > HELD_GRAMS // 2:
                    yield rows(*held[0])
                    held, size = [], 0
        if held:
            yield rows(*merged())

    return docs.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Level:
    """The contexts of one order: sorted keys ``context << 8 | symbol`` with the logarithms of their counts,
    sorted contexts with those of T + D and D, and, once escaped from, of what is left of the parent."""

    keys: np.ndarray
    log_n: np.ndarray
    contexts: np.ndarray
    log_all: np.ndarray
    log_escape: np.ndarray
    log_rest_all: np.ndarray
    log_rest_escape: np.ndarray


def _log(x: np.ndarray) -> np.ndarray:
    """log2, and 0 for 0: where nothing is left of a parent, its escape is certain and costs nothing."""
    return np.log2(np.maximum(x, 1))


def _find(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    place = np.minimum(np.searchsorted(sorted_keys, wanted), max(len(sorted_keys) - 1, 0))
    return place, (sorted_keys[place] == wanted) if len(sorted_keys) else np.zeros(len(wanted), bool)


class Tree:
    """The context tree of a language."""

    def __init__(self, keys: list[np.ndarray], counts: list[np.ndarray]):
        """Per order 0..ORDER: kept keys (uint32, sorted) and their counts."""
        self.levels: list[Level] = []
        above = None
        for k, n in zip(keys, counts):
            context = k >> np.uint32(8)
            edge = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(k) else np.zeros(0, np.int64)
            total, different = np.add.reduceat(n, edge) if len(k) else n, np.diff(np.r_[edge, len(k)])
            escape = np.where(different < 256, different, 0)
            rest_all = rest_escape = np.zeros(len(edge), np.int64)
            if above is not None and len(k):
                order = len(self.levels)
                parent_keys, parent_n, parent_contexts, parent_total, parent_different = above
                mine = parent_n[_find(parent_keys, k & np.uint32((1 << 8 * order) - 1))[0]]
                at = _find(parent_contexts, context[edge] & np.uint32((1 << 8 * (order - 1)) - 1))[0]
                rest_escape = np.where(parent_different[at] < 256, parent_different[at] - different, 0)
                rest_all = parent_total[at] - np.add.reduceat(mine, edge) + rest_escape
            self.levels.append(Level(k, _log(n), context[edge], _log(total + escape), _log(escape), _log(rest_all), _log(rest_escape)))
            above = (k, n, context[edge], total, different)
        self.unseen = float(np.log2(max(256 - len(keys[0]), 1)))

    def bits(self, code: np.ndarray) -> np.ndarray:
        """Code length of the last byte of each code after the bytes before it."""
        out = np.zeros(len(code))
        live = np.arange(len(code))
        entered = np.zeros(len(code), bool)
        den, esc = np.zeros(len(code)), np.zeros(len(code))
        for order in range(len(self.levels) - 1, -1, -1):
            level = self.levels[order]
            key = code[live] & np.uint32((1 << 8 * (order + 1)) - 1)
            at, known = _find(level.contexts, key >> np.uint32(8))
            if not known.any():
                continue
            first = known & ~entered[live]
            den[live[first]], esc[live[first]] = level.log_all[at[first]], level.log_escape[at[first]]
            entered[live[first]] = True
            place, hit = _find(level.keys, key)
            done = live[hit]
            out[done] += den[done] - level.log_n[place[hit]]
            missed = known & ~hit
            escaped = live[missed]
            out[escaped] += den[escaped] - esc[escaped]
            den[escaped], esc[escaped] = level.log_rest_all[at[missed]], level.log_rest_escape[at[missed]]
            live = live[~hit]
        out[live] += self.unseen
        return out


Trees = dict[str, Tree]


def fit(docs: DataFrame, max_entries: int = MAX_ENTRIES) -> Trees:
    """The trees of all languages, by name, from the learnable documents."""
    learnable = clash_free(docs, "doc_id", "text", "lang").where(~held_out() & F.col("text").isNotNull() & F.col("lang").isNotNull())
    longest = stored(gram_counts(learnable.select("lang", F.col("text").cast("binary").alias("text"))), "ppm-grams")
    # All orders: a key of an order is the lower bytes of the longer ones.
    orders = F.explode(F.array(*[F.struct(F.lit(k).alias("order"), F.col("gram").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("key"))
                                 for k in range(ORDER + 1)])).alias("o")
    entries = stored(longest.select("lang", orders, "n").groupBy("lang", "o.order", "o.key").agg(F.sum("n").alias("n")), "ppm-entries")
    contexts = entries.groupBy("lang", "order", F.shiftright("key", 8).alias("context")).agg(
        F.sum("n").alias("total"), F.count("*").alias("different"))
    steps = contexts.where("order > 0").groupBy(F.floor(F.log2("total")).alias("step")).agg(
        F.sum("different").alias("entries")).collect()  # at most 64 rows
    least = 1
    while sum(s.entries for s in steps if s.step >= np.log2(least)) > max_entries:
        least *= 2
    kept = entries.join(contexts.where(f"order = 0 or total >= {least}").select(
        F.col("lang").alias("of"), F.col("order").alias("long"), "context"),
        (F.col("lang") == F.col("of")) & (F.col("order") == F.col("long")) & (F.shiftright("key", 8) == F.col("context")), "left_semi")
    got = kept.select("lang", "order", "key", "n").toArrow()  # bounded by max_entries and 256 for each language
    names, order = got["lang"].to_pylist(), got["order"].to_numpy()
    key, n = got["key"].to_numpy().astype(np.uint32), got["n"].to_numpy()
    lang = np.array(names, object)
    trees = {}
    for name in sorted(set(names)):
        keys, counts = [], []
        for k in range(ORDER + 1):
            at = np.flatnonzero((lang == name) & (order == k))
            at = at[np.argsort(key[at], kind="stable")]
            keys.append(key[at])
            counts.append(n[at])
        trees[name] = Tree(keys, counts)
    return trees


def code_lengths(texts: list[bytes], trees: Trees) -> np.ndarray:
    """Bits of each text under each language: shape (texts, languages)."""
    out = np.zeros((len(texts), len(trees)))
    for doc, code in grams(texts):
        if not len(code):
            continue
        own, place = np.unique(code, return_inverse=True)
        edge = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        for i, tree in enumerate(trees.values()):
            out[doc[edge], i] += np.add.reduceat(tree.bits(own)[place], edge)
    return out


def predict(docs: DataFrame, trees: Trees) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits`` of every document (``bits``: its shortest code)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = pa.array(list(trees) + [UNDETERMINED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches_in_blocks(batches, "text"):
            told = batch.column(2).to_numpy(zero_copy_only=False) & (len(trees) > 0)
            best, score, bits = np.full(len(texts), len(trees)), np.zeros(len(texts)), np.zeros(len(texts))
            at = np.flatnonzero(told)
            if len(at):
                lengths = code_lengths([texts[i] for i in at], trees)
                best[at] = lengths.argmin(1)
                bits[at] = lengths.min(1)
                score[at] = 1 / np.exp2(np.maximum(lengths.min(1)[:, None] - lengths, -1000)).sum(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), names.take(pa.array(best)), pa.array(score), pa.array(bits)], ["doc_id", "lang_pred", "score", "bits"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = clash_free(docs, "doc_id", "text").select("doc_id", F.col("text").cast("binary").alias("text"), letters.alias("told"))
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, bits double").select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "bits")
