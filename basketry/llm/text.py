"""Words of a text column as numpy arrays, straight from Arrow buffers.

A word is a maximal run of characters other than space, tab, newline, vertical
tab, form feed and carriage return (``[^\\x20\\x09-\\x0D]+``); A-Z are folded to
a-z and nothing else is changed.  Word and shingle identities are 64-bit hashes
(polynomial over the word's bytes, then a bijective finaliser); two different
words share a hash with probability about 2^-64.

A batch is handled in chunks of about ``CHUNK_BYTES`` of text, so memory in a
task is bounded by a chunk or by the longest single text, whichever is larger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: the words of the contracts, as a regular expression for JVM-side counting
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

CHUNK_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64 (kept and grown on demand)."""
    global _POWERS
    if len(_POWERS) < n:
        p = np.full(max(n, 256), _BASE, dtype=np.uint64)
        p[0] = 1
        _POWERS = np.multiply.accumulate(p)
    return _POWERS


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@dataclass
class Words:
    """Words of rows ``lo..hi-1`` of a batch, in reading order."""

    lo: int
    hi: int
    data: np.ndarray      # lower-cased bytes of the rows, end to end
    offsets: np.ndarray   # byte offset of each row in ``data`` (hi - lo + 1 values)
    starts: np.ndarray    # first byte of each word
    ends: np.ndarray      # one past its last byte
    first: np.ndarray     # index of each row's first word (hi - lo + 1 values)

    def hashes(self) -> np.ndarray:
        """One 64-bit hash per word."""
        n = len(self.starts)
        if not n:
            return np.zeros(0, dtype=np.uint64)
        span = np.diff(np.append(self.starts, len(self.data)))
        at = np.arange(self.starts[0], len(self.data)) - np.repeat(self.starts, span)
        body = self.data[self.starts[0]:]
        val = (body.astype(np.uint64) + np.uint64(1)) * _powers(int(span.max()) + 1)[at]
        size = self.ends - self.starts
        val[at >= np.repeat(size, span)] = 0
        size = size.astype(np.uint64)
        return mix64(np.add.reduceat(val, self.starts - self.starts[0]) + size * _M2)


def text_column(batch: pa.RecordBatch, name: str) -> pa.Array:
    """A text column with nulls read as empty texts."""
    col = batch.column(batch.schema.get_field_index(name))
    if pa.types.is_null(col.type):
        col = pa.array([""] * len(col), pa.string())
    return col.fill_null("") if col.null_count else col


def byte_chunks(col: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(lo, hi, bytes, offsets)`` for runs of rows holding about ``chunk_bytes``."""
    n = len(col)
    if not n:
        return
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    bufs = col.buffers()
    off = np.frombuffer(bufs[1], dtype=np.int64 if wide else np.int32)[col.offset:col.offset + n + 1].astype(np.int64)
    data = np.frombuffer(bufs[2], dtype=np.uint8) if bufs[2] is not None and bufs[2].size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + chunk_bytes, side="right")) - 1)
        yield lo, hi, data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def word_chunks(col: pa.Array, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Words]:
    for lo, hi, raw, off in byte_chunks(col, chunk_bytes):
        yield split_words(lo, hi, _LOWER[raw], off)


def split_words(lo: int, hi: int, data: np.ndarray, off: np.ndarray, gap: np.ndarray = _SPACE) -> Words:
    """Word bounds in lower-cased bytes (``gap``: the bytes between words); a word
    never crosses a row's end."""
    solid = ~gap[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[off] = True
    before = np.empty(len(data), dtype=bool)
    before[:1] = True
    before[1:] = ~solid[:-1]
    starts = np.flatnonzero(solid & (before | cut[:-1]))
    after = np.empty(len(data), dtype=bool)
    after[-1:] = True
    after[:-1] = ~solid[1:]
    ends = np.flatnonzero(solid & (after | cut[1:])) + 1
    return Words(lo, hi, data, off, starts, ends, np.searchsorted(starts, off))


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the k-word shingles of one word sequence, in order; with fewer
    than k words the whole sequence is one shingle; no words, none."""
    n = len(words)
    if not n:
        return words[:0]
    width = min(k, n)
    p = _powers(width)
    acc = np.full(n - width + 1, width * int(_M1) % 2 ** 64, dtype=np.uint64)
    for i in range(width):
        acc += words[i:n - width + 1 + i] * p[width - 1 - i]
    return mix64(acc)
