"""Whole texts as numpy blocks inside a task: segment boundaries, segment hashes, per-document sums.

A task sees its Arrow batches as blocks of at most ``BLOCK_BYTES`` of text (one longer document is a
block of its own), so memory follows the block and never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 19
#: ASCII white space: 0x20 and 0x09-0x0D.
WHITE = np.zeros(256, bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every input bit (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        have = np.full(max(n, 2 * BLOCK_BYTES), base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if len(have) <= 4 * BLOCK_BYTES:
            _powers[name] = have
    return have[:n]


def batches_in_blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches with their texts (null: empty), each at most ``BLOCK_BYTES`` or one row."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        begin, held, size = 0, [], 0
        for i in range(len(texts)):
            value = texts[i].as_py() or b""
            if held and size + len(value) > BLOCK_BYTES:
                yield batch.slice(begin, i - begin), held
                begin, held, size = i, [], 0
            held.append(value)
            size += len(value)
        if held:
            yield batch.slice(begin, len(held)), held


class Block:
    """Bytes of several documents, a line feed after each, so no segment spans two of them."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b"\n".join(texts) + b"\n"
        if lower:
            joined = joined.lower()  # A-Z only
        self.n = len(texts)
        self.bytes = joined
        self.a = np.frombuffer(joined, np.uint8)
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self._prefix: np.ndarray | None = None

    def segments(self, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the maximal runs of bytes that are no separators (a table of 256)."""
        inside = np.zeros(len(self.a) + 2, np.int8)
        inside[1:-1] = ~separator[self.a]
        edge = np.diff(inside)
        return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)

    def documents_of(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ends, starts, side="right")

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hash of each byte range: a polynomial taken from one prefix sum, then mixed."""
        n = len(self.a)
        if self._prefix is None:
            self._prefix = np.zeros(n + 1, np.uint64)
            np.cumsum((self.a.astype(np.uint64) + np.uint64(1)) * _power("base", _BASE, n), out=self._prefix[1:])
        return mix((self._prefix[ends] - self._prefix[starts]) * _power("inverse", _INVERSE, n)[starts])

    def same(self, starts: np.ndarray, ends: np.ndarray, like: np.ndarray, like_ends: np.ndarray) -> np.ndarray:
        """Which byte ranges hold the very bytes of the ranges they are like."""
        size = ends - starts
        out = size == like_ends - like
        at = np.flatnonzero(out & (starts != like) & (size > 0))
        if len(at):
            size = size[at]
            first = np.cumsum(size) - size
            step = np.arange(size.sum()) - np.repeat(first, size)
            unlike = self.a[np.repeat(starts[at], size) + step] != self.a[np.repeat(like[at], size) + step]
            out[at] = ~np.logical_or.reduceat(unlike, first)
        return out

    def sums(self, flags: np.ndarray) -> np.ndarray:
        """Per document, how many of its bytes are flagged."""
        if not self.n:
            return np.zeros(0, np.int64)
        return np.add.reduceat(flags.astype(np.int64), self.starts)


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every ``k`` consecutive word hashes (positions cross documents; the caller masks them)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * _BASE + words[j:j + n]
    return mix(out)


def list_array(flat: pa.Array, lengths: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), flat)
