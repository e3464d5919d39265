"""Periodic runs of words inside a document (operator 13).

A run is a stretch of words with smallest period q (words q apart are the same) of at least
``max(MIN_WORDS, MIN_TIMES * q)`` words that no neighbouring word extends.  Collapsing drops
every word that some run contains after that run's first q words.

Method.  Seed and extend on diagonals; a diagonal is a lag between two places of one
document.

1. Seeds.  On a run's lag q, at least ``max(MIN_WORDS - q, (MIN_TIMES - 1) * q)`` words in a row
   equal the word q further on.  For the lags from 2^j to 2^(j+1) - 1 the least of these, k, is the
   length of the k-grams that are indexed.  k is at least as long as any lag of its band,
   so inside a run (whose q is smallest) a k-gram comes again after q words and not before: the
   pairs of *neighbouring* occurrences with a lag in the band hold every run's
   seeds.  There are at most n of them per band; all pairs of a frequent k-gram are never listed.
2. Index.  Names of 2^i-grams by doubling (a name is the rank of a pair of names, no hashing); a
   k-gram is a pair of overlapping named grams.  Words whose gram is unique in the document leave the index
   for good, so plain text is done after a few lengths.
3. Extension.  Seeds are taken by lag and place.  A table with the furthest place covered on each
   lag skips a seed that an earlier extension has passed; other seeds are extended to both
   sides while the words agree, and the table is moved on.

Scale.  Documents are read once and never shuffled; a task holds the words of one document at
a time, n log(n) work for n words.  A document is the largest thing held.

Defined results: null or empty text has no words and no runs; repeated rows each get their
result; ties are listed by start, then period; other columns pass through, columns named
``words``, ``runs`` or ``collapsed`` are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from basketry.llm.text import byte_chunks, split_words, text_column

MIN_WORDS = 6
MIN_TIMES = 4

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def _rank_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Equal numbers for equal (a, b), from non-negative numbers below 2^31."""
    return np.unique((a.astype(np.int64) << 32) | b.astype(np.int64), return_inverse=True)[1].reshape(-1)


def _repeated(at: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and names without those whose name occurs once."""
    keep = np.bincount(names)[names] > 1
    return at[keep], names[keep]


def _extend(ids: np.ndarray, i: int, lag: int) -> tuple[int, int]:
    """Bounds [s, e) of the places around ``i`` whose word equals the one ``lag`` further on."""
    n, s, e, step = len(ids) - lag, i, i + 1, 16
    while e < n:
        hi = min(n, e + step)
        bad = np.flatnonzero(ids[e:hi] != ids[e + lag:hi + lag])
        if len(bad):
            e += int(bad[0])
            break
        e, step = hi, step * 2
    step = 16
    while s > 0:
        lo = max(0, s - step)
        bad = np.flatnonzero(ids[lo:s] != ids[lo + lag:s + lag])
        if len(bad):
            s = lo + int(bad[-1]) + 1
            break
        s, step = lo, step * 2
    return s, e


def word_runs(ids: np.ndarray, min_words: int = MIN_WORDS, min_times: int = MIN_TIMES) -> np.ndarray:
    """Rows (start, length, period), by start, then period, of a document given as word numbers
    0, 1, .. (equal for equal words).

    ``min_times`` is 3 at least (below that a band's k-grams can be shorter than its lags)."""
    if min_times < 3:
        raise ValueError("min_times must be 3 or more")
    n = len(ids)
    covered: dict[int, int] = {}
    found = []
    grams = {1: _repeated(np.arange(n), ids)}
    low = 1
    while low * min_times <= n:
        k = min(max(min_words - q, (min_times - 1) * q) for q in range(low, 2 * low) if q <= max(low, min_words))
        half = 1 << (k.bit_length() - 1)
        for size in (1 << j for j in range(k.bit_length() - 1)):
            if 2 * size not in grams:
                grams[2 * size] = _joined(*grams[size], size)
        places, names = grams[half] if k == half else _joined(*grams[half], k - half)
        if not len(places) and low > min_words:
            break               # later bands index longer grams
        for lag, seeds in _seeds(places, names, low, 2 * low):
            i = 0
            while i < len(seeds):
                s, e = _extend(ids, int(seeds[i]), lag)
                covered[lag] = e
                if e - s + lag >= max(min_words, min_times * lag):
                    found.append((s, e - s + lag, lag))
                i = int(np.searchsorted(seeds, covered[lag]))
        low *= 2
    runs = np.array(found, dtype=np.int64).reshape(-1, 3)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _seeds(places: np.ndarray, names: np.ndarray, low: int, high: int) -> Iterator[tuple[int, np.ndarray]]:
    """Lags in [low, high) of neighbouring occurrences and the first places of their pairs, ascending."""
    order = np.lexsort((places, names))
    at, same = places[order], names[order]
    lag = np.diff(at)
    hit = (same[1:] == same[:-1]) & (lag >= low) & (lag < high)
    at, lag = at[:-1][hit], lag[hit]
    order = np.lexsort((at, lag))
    at, lag = at[order], lag[order]
    cut = np.flatnonzero(np.diff(lag)) + 1
    for piece, lags in zip(np.split(at, cut), np.split(lag, cut)):
        if len(piece):
            yield int(lags[0]), piece


def _joined(at: np.ndarray, names: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """Repeated longer grams, each a named gram and the one ``shift`` words further on."""
    nxt = np.searchsorted(at, at + shift)
    ok = nxt < len(at)
    ok[ok] = at[nxt[ok]] == at[ok] + shift
    if not ok.any():
        return at[:0], names[:0]
    return _repeated(at[ok], _rank_pairs(names[ok], names[nxt[ok]]))


def dropped_words(n: int, runs: np.ndarray) -> np.ndarray:
    """Mask of the words that a run contains after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(edge)[:n] > 0


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_times: int = MIN_TIMES) -> DataFrame:
    """``docs`` (column ``text``) with ``words`` (their number), ``runs`` (by start, then period) and
    ``collapsed`` (the kept words, joined by one space)."""
    keep = [f for f in docs.schema.fields if f.name not in ("words", "runs", "collapsed")]
    schema = T.StructType([*keep, T.StructField("words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    names = [f.name for f in keep]
    parts = ("start", "length", "period")
    arrow_runs = pa.list_(pa.struct([(n, pa.int64()) for n in parts]))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, raw, off in byte_chunks(text_column(batch, "text")):
                w = split_words(lo, hi, raw, off)
                data = raw.tobytes()
                sizes, runs_of, texts = [], [], []
                for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
                    words = [data[s:e] for s, e in zip(w.starts[a:b].tolist(), w.ends[a:b].tolist())]
                    number: dict[bytes, int] = {}
                    runs = word_runs(np.array([number.setdefault(x, len(number)) for x in words], dtype=np.int64), min_words, min_times)
                    sizes.append(len(words))
                    runs_of.append([dict(zip(parts, x)) for x in runs.tolist()])
                    if len(runs):
                        words = [words[i] for i in np.flatnonzero(~dropped_words(len(words), runs)).tolist()]
                    texts.append(b" ".join(words).decode())
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(lo, hi - lo).columns, pa.array(sizes, pa.int64()), pa.array(runs_of, arrow_runs), pa.array(texts, pa.string())],
                    names=[*names, "words", "runs", "collapsed"])

    return docs.select(*names).mapInArrow(work, schema)
