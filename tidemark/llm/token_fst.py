"""Token counts by a finite-state transducer compiled from a BPE vocabulary with word ends.

Compilation. Byte-pair encoding of a prefix is known from its last token alone: the encoding of the rest
is the encoding of the shorter prefix, and a sequence of tokens is an encoding exactly if every two
neighbours are *compatible* (encoding their join gives the two back). So after each byte exactly one token
of the vocabulary ends there that is compatible with the last token where it begins. What later bytes can
ask for is only this: for each place where a longer token may have begun, the node of the vocabulary's
trie reached from there, the last token at that place and how many tokens it is behind. That is a state;
reading a byte leads to the next state and *emits* the change of the number of tokens. The word end is
one more symbol, joined to its byte before any other merge. States and transitions are compiled when
first needed and kept in a bounded table.

Chunks. A document is cut into chunks of ``CHUNK_BYTES``, anywhere. White space resets the transducer, so
the map a chunk makes of its entry states is either *open* (no white space: every state is led on through
its bytes) or *closed*: the bytes up to the first reset continue whatever state came in, a number of
tokens is emitted between the first and the last reset whatever came in, and the bytes after the last
reset lead from the start state. Such maps compose associatively, and a document's are composed pairwise,
level by level, in the manner of a parallel prefix scan.

The text is prepared as the tokenizer's file says: special strings count one each, then NFC, lower case,
and pieces by its pattern, all of which stop at ASCII white space.

Rows. A null text is empty: 0 bytes, 0 tokens. Repeated rows and null ids come back as they are. Extra
columns are ignored; an empty table gives no rows. A very long document is a block of its own.
"""

from __future__ import annotations

import functools
import json
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import clash_free
from tidemark.llm.textblocks import Block, WHITE, batches_in_blocks

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LIMIT = 2048
CHUNK_BYTES = 4096
END = 256
#: Bounds of the tables a worker keeps: compiled transitions, compatible pairs, counted words.
MAX_TRANSITIONS = 300_000
MAX_PAIRS = 500_000
MAX_WORDS = 500_000
MAX_WORD_BYTES = 64


def _byte_of() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for the 256 bytes."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Transducer:
    """Lazily compiled deterministic transducer; ``count(bytes)`` is the number of tokens of one piece."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        suffix = model["end_of_word_suffix"]
        byte = _byte_of()

        def symbols(token: str) -> tuple[int, ...]:
            ends = token.endswith(suffix) and len(token) > len(suffix)
            return tuple(byte[c] for c in (token[:-len(suffix)] if ends else token)) + ((END,) if ends else ())

        ids = model["vocab"]
        self._merge: dict[tuple[int, int], tuple[int, int]] = {}
        self._single = {}
        self._end = -2
        for name, code in byte.items():
            if name in ids:
                self._single[code] = ids[name]
        self._single[END] = self._end
        for name, code in byte.items():
            if name + suffix in ids and code in self._single:
                self._merge[self._single[code], self._end] = (-1, ids[name + suffix])
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self._merge.setdefault((ids[a], ids[b]), (rank, ids[a + b]))
        self._symbols = {i: symbols(t) for t, i in ids.items()}
        self._child: dict[int, int] = {}
        self._token = [-1]
        self._open = [True]
        for i, syms in self._symbols.items():
            if all(s in self._single for s in syms) and self._encode(syms) == [i]:
                self._insert(syms, i)
        inner = {parent >> 9 for parent in self._child}
        self._open = [n in inner for n in range(len(self._token))]
        self._pairs: dict[int, bool] = {}
        self._reset()
        self.special = sorted((t["content"] for t in spec["added_tokens"] if t["special"]), key=len, reverse=True)
        normal = spec["normalizer"]["normalizers"]
        if [n["type"] for n in normal] != ["NFC", "Replace", "Lowercase"]:
            raise ValueError("another normalizer than this transducer is written for")
        self._pieces = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        self._split = regex.compile("|".join(map(regex.escape, self.special)) or r"(?!)").split

    def _insert(self, syms: tuple[int, ...], token: int) -> None:
        node = 0
        for s in syms:
            nxt = self._child.get(node << 9 | s)
            if nxt is None:
                nxt = self._child[node << 9 | s] = len(self._token)
                self._token.append(-1)
            node = nxt
        self._token[node] = token

    def _encode(self, syms: tuple[int, ...]) -> list[int]:
        """Merge by rank, as byte-pair encoding is defined; used to compile, on single tokens and pairs."""
        parts = [self._single[s] for s in syms]
        while len(parts) > 1:
            best = min(((self._merge.get(p, (1 << 60, -1)), i) for i, p in enumerate(zip(parts, parts[1:]))))
            (rank, merged), i = best
            if rank == 1 << 60:
                break
            parts[i:i + 2] = [merged]
        return parts

    def _reset(self) -> None:
        self._states: dict[tuple, int] = {}
        self._content: list[tuple] = []
        self._moves: dict[int, tuple[int, int]] = {}
        self._start = self._state(((0, -1, 0),))

    def _state(self, content: tuple) -> int:
        found = self._states.get(content)
        if found is None:
            found = self._states[content] = len(self._content)
            self._content.append(content)
        return found

    def _compatible(self, left: int, right: int) -> bool:
        if left < 0:
            return True
        key = left << 20 | right
        known = self._pairs.get(key)
        if known is None:
            if len(self._pairs) >= MAX_PAIRS:
                self._pairs.clear()
            known = self._pairs[key] = self._encode(self._symbols[left] + self._symbols[right]) == [left, right]
        return known

    def _compile(self, state: int, symbol: int) -> tuple[int, int]:
        """One transition. A state lists, longest first, the open beginnings: (trie node, last token
        before it, tokens up to it less tokens up to here)."""
        grown, token, behind = [], -1, 0
        for node, last, delta in self._content[state]:
            node = self._child.get(node << 9 | symbol)
            if node is None:
                continue
            t = self._token[node]
            if token < 0 and t >= 0 and self._compatible(last, t):
                token, behind = t, delta + 1
            if self._open[node]:
                grown.append((node, last, delta))
        if token < 0:
            raise ValueError(f"symbol {symbol} has no token")
        content = tuple((n, last, d - behind) for n, last, d in grown) + ((0, token, 0),)
        move = (self._start if symbol == END else self._state(content), behind)
        self._moves[state << 9 | symbol] = move
        return move

    def count(self, piece: bytes) -> int:
        if len(self._moves) > MAX_TRANSITIONS:
            self._reset()
        state, total, moves = self._start, 0, self._moves
        for symbol in piece:
            state, out = moves.get(state << 9 | symbol) or self._compile(state, symbol)
            total += out
        return total + (moves.get(state << 9 | END) or self._compile(state, END))[1]

    def tokens(self, raw: bytes) -> int:
        """Tokens of a run of text without ASCII white space."""
        text = raw.decode("utf-8")
        total = 0
        plain = [text]
        if any(s in text for s in self.special):
            plain = self._split(text)
            total = len(plain) - 1
        for part in plain:
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
                part = "".join(map(str.lower, part)) if "Σ" in part else part.lower()
            else:
                part = part.lower()
            for piece in self._pieces(part):
                total += self.count(piece.encode("utf-8"))
        return total


#: A chunk's map: (bytes to the first reset, tokens between, bytes from the last reset); an open one has
#: its bytes first and None for the rest.
StateMap = tuple[bytes, int | None, bytes | None]


def compose(f: StateMap, g: StateMap, tokens: Callable[[bytes], int]) -> StateMap:
    """The map of two neighbouring chunks; associative."""
    if f[1] is None:
        return (f[0] + g[0], g[1], g[2])
    if g[1] is None:
        return (f[0], f[1], f[2] + g[0])
    return (f[0], f[1] + tokens(f[2] + g[0]) + g[1], g[2])


def scan(maps: list[StateMap], tokens: Callable[[bytes], int]) -> int:
    """Compose a document's maps pairwise, level by level, and read it from reset to reset."""
    while len(maps) > 1:
        paired = [compose(f, g, tokens) for f, g in zip(maps[::2], maps[1::2])]
        maps = paired + maps[len(paired) * 2:]
    head, between, tail = maps[0]
    if between is None:
        return tokens(head)
    return tokens(head) + between + tokens(tail)


class Counter:
    """Counts of whole texts: distinct words of a block run through the transducer once."""

    def __init__(self, path: str):
        self.machine = Transducer(path)
        self._seen: dict[bytes, int] = {}

    def word(self, raw: bytes) -> int:
        return self.machine.tokens(raw) if raw else 0

    def texts(self, texts: list[bytes]) -> np.ndarray:
        block = Block(texts)
        starts, ends = block.segments(WHITE)
        doc = block.documents_of(starts)
        # Words inside one chunk, away from its edges; the others are heads, tails or open chunks.
        offset = starts - block.starts[doc]
        size = (block.ends - block.starts - 1)[doc]
        chunk = offset // CHUNK_BYTES
        low = chunk * CHUNK_BYTES
        high = np.minimum(low + CHUNK_BYTES, size)
        inner = (offset > low) & (ends - block.starts[doc] < high)
        total = np.zeros(block.n, np.int64)
        begin, end = starts[inner], ends[inner]
        _, first, place = np.unique(block.hashes(begin, end), return_index=True, return_inverse=True)
        counts = self._counts(block, begin[first], end[first])[place]
        # Equal hashes stand for equal words only where the bytes agree.
        for i in np.flatnonzero(~block.same(begin, end, begin[first][place], end[first][place])).tolist():
            counts[i] = self.word(block.bytes[begin[i]:end[i]])
        n_chunks = np.maximum(1, -(-(block.ends - block.starts - 1) // CHUNK_BYTES))
        base = np.concatenate(([0], np.cumsum(n_chunks)))
        per_chunk = np.bincount(base[doc[inner]] + chunk[inner], weights=counts, minlength=base[-1])
        for d, text in enumerate(texts):
            maps = [self._map(text[at:at + CHUNK_BYTES], int(per_chunk[base[d] + i]))
                    for i, at in enumerate(range(0, max(len(text), 1), CHUNK_BYTES))]
            total[d] = scan(maps, self.word)
        return total

    def _counts(self, block: Block, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self._seen) > MAX_WORDS:
            self._seen.clear()
        out, seen, data, run = np.zeros(len(starts)), self._seen, block.bytes, self.machine.tokens
        for i, (a, b) in enumerate(zip(starts.tolist(), ends.tolist())):
            raw = data[a:b]
            n = seen.get(raw)
            if n is None:
                n = run(raw)
                if len(raw) <= MAX_WORD_BYTES:
                    seen[raw] = n
            out[i] = n
        return out

    def _map(self, chunk: bytes, between: int) -> StateMap:
        parts = chunk.split(None, 1)
        if len(parts) < 2 and not (chunk[:1].isspace() or chunk[-1:].isspace()):
            return (chunk, None, None)
        head = b"" if chunk[:1].isspace() else parts[0]
        tail = b"" if chunk[-1:].isspace() else chunk.rsplit(None, 1)[-1]
        return (head, between, tail)


@functools.lru_cache(maxsize=2)
def _counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, path: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch, texts in batches_in_blocks(batches, "text"):
            n_bytes = np.fromiter(map(len, texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_bytes), pa.array(counter.texts(texts))], ["doc_id", "n_bytes", "n_tokens"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return clash_free(docs, "doc_id", "text").withColumn("text", F.col("text").cast("binary")).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
