"""Byte-pair encoding and decoding with content-defined chunk reuse.

Chunks. A rolling hash over ``WINDOW`` bytes cuts every text where its low bits are zero, so equal
passages are cut alike wherever they stand, whatever precedes them; a chunk has ``2 ** CUT_BITS`` bytes on
average. Documents are first brought together by their smallest chunk hash (copies and near copies share
it with high probability, as in min-hashing) by a rebalancing exchange whose large partitions Spark
splits, and a task then encodes each distinct chunk once and reuses its tokens. A chunk's first encoding
goes word by word through a bounded table that the tokenizers library fills.

Joins. A cut may fall inside a word, a special string or a composed character, where the tokens of the two
chunks are not those of the text. The text around the cut is then encoded again, from some words before
it to some words after it, and the range is widened until the tokens of its first and last words are
exactly those the two chunks have there; what lies between replaces the chunks' own tokens. A chunk
without white space joins both neighbours into one such range. Chunk tables hold whole chunk texts as
keys, so a hash collision cannot give wrong tokens.

Decoding is the library's: the tokens' strings, joined as its decoder says.

Rows. A null text is an empty one: no tokens, decoded text empty. Repeated rows and null ids come back as
they are. Extra columns are ignored; an empty table gives no rows. A very long document is a block of its
own.
"""

from __future__ import annotations

import functools
import os
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import clash_free
from tidemark.llm.textblocks import Block, batches_in_blocks, list_array

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WINDOW = 16
CUT_BITS = 10
#: Bounds of the tables a worker keeps.
MAX_CHUNK_BYTES = 8 << 20
MAX_WORDS = 300_000  # of each of two generations
#: Unknown words go to the library this many at a time, as one text, with a mark between them.
TOGETHER = 2_000
MARK = b"\x00"
_WHITE = b" \t\n\r\x0b\x0c"
#: Signs that close a word and are a piece of their own after letters.
SIGNS = b".,!?;:"


def _is_letters(word: bytes) -> bool:
    """Letters alone, also once composed and lower-cased: one piece to a tokenizer that splits by letters."""
    if word.isalpha():
        return True
    text = word.decode("utf-8")
    return text.isalpha() and unicodedata.is_normalized("NFC", text) and text.lower().isalpha()


def cuts(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all chunks of a block, in order."""
    n = len(block.a)
    edge = np.zeros(n + 1, bool)
    if n > WINDOW:
        first = np.arange(n - WINDOW)
        rolled = block.hashes(first, first + WINDOW)
        after = first + WINDOW  # a cut here has the window before it
        good = (rolled & np.uint64((1 << CUT_BITS) - 1)) == 0
        good &= (block.a[after] & 0xC0) != 0x80  # never inside a character
        after = after[good]
        doc = block.documents_of(after)
        inside = (after - WINDOW >= block.starts[doc]) & (after < block.ends[doc] - 1)
        edge[after[inside]] = True
    full = block.ends - 1 > block.starts
    edge[block.starts[full]] = True
    starts = np.flatnonzero(edge)
    doc = block.documents_of(starts)
    ends = np.minimum(np.append(starts[1:], n), block.ends[doc] - 1)
    return starts, ends


def together(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` with documents of one smallest chunk hash brought together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches_in_blocks(batches, "text"):
            block = Block(texts)
            starts, ends = cuts(block)
            least = np.full(block.n, np.iinfo(np.int64).max)
            np.minimum.at(least, block.documents_of(starts), (block.hashes(starts, ends) >> np.uint64(1)).astype(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(least)], ["doc_id", "text", "least"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return clash_free(docs, "doc_id", "text").withColumn("text", F.col("text").cast("binary")).mapInArrow(
        run, f"doc_id {kind}, text binary, least long").hint("rebalance", F.col("least")).drop("least")


class Piece:
    """An encoded chunk: its words' tokens end to end, and what its edges need."""

    __slots__ = ("text", "ids", "head", "tail", "opens", "closes")

    def __init__(self, text: bytes, ids: list[bytes]):
        self.text = text
        self.ids = b"".join(ids)
        self.opens = text[:1] in _WHITE  # begins at a word's edge
        self.closes = text[-1:] in _WHITE
        self.head = 0 if self.opens or not ids else len(ids[0])
        self.tail = 0 if self.closes or not ids else len(ids[-1])


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        mark = self.tokenizer.encode(MARK.decode(), add_special_tokens=False).ids
        self._mark = mark[0] if len(mark) == 1 else None
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        names = self.tokenizer.get_vocab(with_added_tokens=True)
        self._ends = None  # ids that end a piece of text, if the vocabulary marks them
        if suffix:
            self._ends = np.zeros(max(names.values()) + 1, bool)
            self._ends[[i for name, i in names.items() if name.endswith(suffix)]] = True
        self._words: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}
        self._pieces: dict[bytes, Piece] = {}
        self._held = 0
        self._joins: dict[bytes, bytes] = {}

    def _library(self, texts: list[bytes]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast([t.decode("utf-8") for t in texts], add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in done]

    def _learn(self, words: set[bytes]) -> None:
        """Have all these words in the table. Words not used for a generation leave it."""
        if len(self._words) > MAX_WORDS:
            self._older, self._words = self._words, {}
        known, older = self._words, self._older
        new = []
        for w in words:
            if w not in known:
                ids = older.get(w)
                if ids is None:
                    new.append(w)
                else:
                    known[w] = ids
        # A word of ASCII letters and closing signs is the tokens of its lower-cased letters and of its signs.
        made = {}
        if self._ends is not None:
            rest = []
            for w in new:
                letters = w.rstrip(SIGNS)
                low = letters.lower()
                if letters.isalpha() and low != w:
                    made[w] = low, w[len(letters):]
                else:
                    rest.append(w)
            new = rest + [p for p in {p for pair in made.values() for p in pair if p} if p not in known and p not in older]
            for p in {p for pair in made.values() for p in pair if p in older}:
                known.setdefault(p, older[p])
        letters = [w for w in dict.fromkeys(new) if self._ends is not None and _is_letters(w)]
        for at in range(0, len(letters), TOGETHER):
            some = letters[at:at + TOGETHER]
            raw = self._library([b" ".join(some)])[0]
            ends = (4 * np.flatnonzero(self._ends[np.frombuffer(raw, np.uint32)]) + 4).tolist()
            if len(ends) != len(some):
                raise ValueError("a word of letters is not one piece to the tokenizer")
            known.update(zip(some, map(raw.__getitem__, map(slice, [0, *ends], ends))))
        others = [w for w in dict.fromkeys(new) if w not in known]
        plain = [w for w in others if self._mark is not None and MARK not in w]
        for at in range(0, len(plain), TOGETHER):
            some = plain[at:at + TOGETHER]
            # White space ends every token, so the tokens between two marks are those of one word.
            raw = self._library([(b" " + MARK + b" ").join(some)])[0]
            marks = np.flatnonzero(np.frombuffer(raw, np.uint32) == self._mark)
            begins, ends = [0, *(4 * marks + 4).tolist()], [*(4 * marks).tolist(), len(raw)]
            if len(begins) != len(some):
                raise ValueError("a word's tokens hold the mark between words")
            known.update(zip(some, map(raw.__getitem__, map(slice, begins, ends))))
        alone = [w for w in others if w not in known]
        if alone:
            known.update(zip(alone, self._library(alone)))
        for w, (low, signs) in made.items():
            known[w] = known[low] + known[signs] if signs else known[low]

    def _word(self, word: bytes) -> bytes:
        if word not in self._words:
            self._words[word] = self._library([word])[0]
        return self._words[word]

    def texts(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text as 32-bit words."""
        block = Block(texts)
        starts, ends = cuts(block)
        chunks = [block.bytes[a:b] for a, b in zip(starts.tolist(), ends.tolist())]
        if self._held > MAX_CHUNK_BYTES:
            self._pieces.clear()
            self._held = 0
        if len(self._joins) > MAX_WORDS // 4:
            self._joins.clear()
        split = {c: c.split() for c in dict.fromkeys(chunks) if c not in self._pieces}
        self._learn(set().union(*split.values()) if split else set())
        for chunk, words in split.items():
            self._pieces[chunk] = Piece(chunk, list(map(self._words.__getitem__, words)))
            self._held += 2 * len(chunk) + 300
        per = np.bincount(block.documents_of(starts), minlength=block.n)
        out, at = [], 0
        for n in per.tolist():
            out.append(self._joined([self._pieces[c] for c in chunks[at:at + n]]))
            at += n
        return out

    def _joined(self, pieces: list[Piece]) -> bytes:
        out: list[bytes] = []
        carry = b""  # text of a word begun but not ended
        before = b""  # text before it, which the tokens in ``out`` are of
        for piece in pieces:
            words_in = len(piece.text.split(None, 1)) > 1 or piece.opens or piece.closes
            if not words_in:
                carry += piece.text
                continue
            lead = 0
            if carry and not piece.opens:
                head = piece.text.split(None, 1)[0]
                out.append(self._repair(before, carry + head, piece.text[len(head):]))
                lead = piece.head
            elif carry:
                out.append(self._repair(before, carry, piece.text))
            tail = b"" if piece.closes else piece.text.rsplit(None, 1)[-1]
            out.append(piece.ids[lead:len(piece.ids) - piece.tail if tail else None])
            before = piece.text[:len(piece.text) - len(tail)]
            carry = tail
        if carry:
            out.append(self._repair(before, carry, b""))
        return b"".join(out)

    def _repair(self, before: bytes, middle: bytes, after: bytes) -> bytes:
        """Tokens of ``middle`` in its place between two texts that end and begin at white space."""
        n = 1
        while True:
            left, right = before.rsplit(None, n)[-n:], after.split(None, n)[:n]
            place = b" ".join([*left, middle, *right])
            ids = self._joins.get(place)
            if ids is None:
                ids = self._joins[place] = self._library([place])[0]
            first = self._word(left[0]) if left else b""
            last = self._word(right[-1]) if right else b""
            if ids.startswith(first) and ids.endswith(last):
                a = sum(len(self._word(w)) for w in left)
                b = sum(len(self._word(w)) for w in right)
                return ids[a:len(ids) - b]
            if n > len(left) + len(right):
                raise ValueError("the tokens around a join do not come to agree")
            n *= 2


    def ids(self, texts: list[bytes]) -> pa.ListArray:
        raw = self.texts(texts)
        flat = np.frombuffer(b"".join(raw), np.uint32).astype(np.int32)
        return list_array(pa.array(flat), np.array([len(x) // 4 for x in raw]))

    @functools.cached_property
    def _names(self) -> dict[int, str]:
        return {i: name for name, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}

    def decoded(self, rows: pa.ListArray) -> pa.Array:
        """Each row's ids (null: none) as text; ids the vocabulary lacks give nothing."""
        lengths = np.array(rows.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
        flat = rows.flatten().to_numpy(zero_copy_only=False).tolist()
        ends = np.cumsum(lengths).tolist()
        if self.tokenizer.decoder is not None:
            lists = [flat[a:b] for a, b in zip([0, *ends], ends)]
            return pa.array(self.tokenizer.decode_batch(lists, skip_special_tokens=False), pa.string())
        names = list(map(self._names.get, flat))  # without a decoder the library puts a space between the tokens
        texts = [" ".join(names[a:b]) if all(names[a:b]) else " ".join(filter(None, names[a:b])) for a, b in zip([0, *ends], ends)]
        return pa.array(texts, pa.string())


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _kind(df: DataFrame) -> str:
    return f"doc_id {df.schema['doc_id'].dataType.simpleString()}"


def encode(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids``: the token ids of every text, as the library gives them for the whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch, texts in batches_in_blocks(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column(0), encoder.ids(texts)], ["doc_id", "ids"])

    return together(docs).mapInArrow(run, f"{_kind(docs)}, ids array<int>")


def decode(encoded: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids, decoded``: each row's ids (null: none) turned back into text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), encoder.decoded(part.column(1))], ["doc_id", "ids", "decoded"])

    return clash_free(encoded, "doc_id", "ids").mapInArrow(run, f"{_kind(encoded)}, ids array<int>, decoded string")


def round_trip(docs: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """``decode(encode(docs))`` in one pass of one worker: ``doc_id, ids, decoded``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path)
        for batch, texts in batches_in_blocks(batches, "text"):
            ids = encoder.ids(texts)
            yield pa.RecordBatch.from_arrays([batch.column(0), ids, encoder.decoded(ids)], ["doc_id", "ids", "decoded"])

    return together(docs).mapInArrow(run, f"{_kind(docs)}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str = VOCABULARY, keep_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, and ``ids`` if wanted, of the encoded and decoded rows."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return round_trip(docs, path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), *(["ids"] if keep_ids else []))
