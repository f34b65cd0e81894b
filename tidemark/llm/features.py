"""Sparse text features taken from whole documents, block by block, inside a task."""

from __future__ import annotations

import numpy as np

from tidemark.llm.textblocks import Block, WHITE, mix

#: Everything in ASCII that is neither letter nor digit separates the plain words of a text.
NOT_ALNUM = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_LINE = np.zeros(256, bool)
_LINE[10] = True
_UPPER = np.array([65 <= i <= 90 for i in range(256)])
_LOWER = np.array([97 <= i <= 122 for i in range(256)])
_DIGIT = np.array([48 <= i <= 57 for i in range(256)])
_PUNCT = np.array([33 <= i < 127 and not chr(i).isalnum() for i in range(256)])
_HIGH = np.arange(256) >= 128

STRUCTURE = ("log_words", "word_bytes", "upper", "digit", "punct", "non_ascii", "symbol_words", "distinct_words",
             "top_word", "log_lines", "line_words", "distinct_lines", "pipe", "white", "meta_log_chars",
             "meta_chars_ratio")


def hashed_words(texts: list[bytes], buckets: int, prefixes: tuple[int, ...] = ()
                 ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased plain words, and their first bytes in the given numbers, hashed to buckets:
    ``(document, bucket, count)``, ordered by document."""
    block = Block(texts, lower=True)
    starts, ends = block.segments(NOT_ALNUM)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    doc, hashes = [block.documents_of(starts)], [block.hashes(starts, ends)]
    for k in prefixes:
        long = ends - starts >= k
        doc.append(doc[0][long])
        hashes.append(mix(block.hashes(starts[long], starts[long] + k) ^ np.uint64(k)))
    bucket = (np.concatenate(hashes) % np.uint64(buckets)).astype(np.int64)
    cell, count = np.unique(np.concatenate(doc) * buckets + bucket, return_counts=True)
    return cell // buckets, cell % buckets, count.astype(float)


def structure(texts: list[bytes], n_chars: list[int | None]) -> np.ndarray:
    """Structure statistics of each text and its ``n_chars`` metadata (null: as measured): (n, 16)."""
    block = Block(texts)
    n = block.n
    size = np.maximum(block.ends - block.starts - 1, 1).astype(float)
    starts, ends = block.segments(WHITE)
    doc = block.documents_of(starts)
    words = np.bincount(doc, minlength=n).astype(float)
    some = np.maximum(words, 1)
    # A word is a symbol word if it holds no ASCII letter, digit or byte of a longer character, or ends in two marks.
    alnum = np.concatenate(([0], np.cumsum(_UPPER[block.a] | _LOWER[block.a] | _DIGIT[block.a] | _HIGH[block.a])))
    marks = _PUNCT[block.a]
    symbol = (alnum[ends] == alnum[starts]) | (marks[ends - 1] & marks[np.maximum(ends - 2, 0)])
    cell, count = np.unique(np.stack([doc.astype(np.uint64), block.hashes(starts, ends)]), axis=1, return_counts=True) \
        if len(starts) else (np.zeros((2, 0), np.uint64), np.zeros(0, np.int64))
    of = cell[0].astype(np.int64)
    top = np.zeros(n)
    np.maximum.at(top, of, count)
    line_starts, line_ends = block.segments(_LINE)
    line_doc = block.documents_of(line_starts)
    lines = np.maximum(np.bincount(line_doc, minlength=n), 1).astype(float)
    line_hash = mix(block.hashes(line_starts, line_ends) ^ line_doc.astype(np.uint64)) if len(line_starts) \
        else np.zeros(0, np.uint64)
    distinct_lines = np.bincount(line_doc[np.unique(line_hash, return_index=True)[1]], minlength=n)
    high = block.sums(_HIGH[block.a])
    chars = block.ends - block.starts - 1 - block.sums((block.a & 0xC0) == 0x80)
    given = np.array([m if c is None or c < 0 else c for c, m in zip(n_chars, chars)], float)
    letters = np.maximum(block.sums((_UPPER | _LOWER)[block.a]), 1)
    return np.stack([
        np.log1p(words), size / some, block.sums(_UPPER[block.a]) / letters, block.sums(_DIGIT[block.a]) / size,
        block.sums(marks) / size, high / size, np.bincount(doc, weights=symbol, minlength=n) / some,
        np.bincount(of, minlength=n) / some, top / some, np.log1p(lines), np.log1p(words / lines), distinct_lines / lines,
        block.sums(block.a == 124) / size, block.sums(WHITE[block.a]) / size, np.log1p(given),
        np.clip(given / np.maximum(chars, 1), 0, 4)], axis=1) if n else np.zeros((0, len(STRUCTURE)))
