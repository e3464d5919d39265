"""Benchmark decontamination (operator 10).

Finds passages of documents that are a benchmark item up to a share of word edits.
Words are runs of letters and digits (every byte of a non-ASCII character counts as a
letter); case is folded for ASCII and Latin-1 letters, punctuation and spacing don't
count.  An item of L words is found where some stretch of the document is within
``floor(MAX_EDITS * L)`` word insertions, deletions and substitutions of it.

Method.

1. Windows.  With k edits an item keeps at least one run of g words whenever
   ``g * k + g <= L``; g (at most 3) is chosen per item so that this holds, and every
   occurrence of such a run in a document gives one item-sized window, aligned with the
   run's place in the item.  Nothing within the threshold is lost here.
2. CGK embedding.  A random walk over the window (at each of 3L steps the current word is
   put out and a random bit of (step, word) says whether to move on) maps edit distance
   to Hamming distance.
3. Bit sampling.  Each repetition has its own walk and ``SAMPLED`` output places in the first
   ``REACH`` of the walk, before it has used up the words; a window is a candidate if in any
   repetition it equals the item at all of them, and at none because both are at their end.  The number
   of repetitions is doubled until copies of the items with the most edits allowed are found with
   ``RECALL``, measured on the very walks and places that are used.  Items for which ``MOST_REPETITIONS`` don't
   reach it have no filter: all their windows are verified.
4. Candidates are verified exactly: bit-parallel edit distance of the item against the
   window's surroundings, free ends.

Scale.  Documents are read once, whole, and never shuffled.  Items are held by every
task in blocks of about ``BLOCK_WORDS`` words; a benchmark beyond that is worked through
block by block, one pass each, so its broadcast has a fixed bound.

Defined results: null or empty texts and items match nothing; repeated items each
report; one hit per document and item, the one with fewest edits, then the first; an item
id that is null is reported as null; other columns pass through, a column named
``hits`` is replaced; empty tables give no hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.llm.text import _LOWER, Words, byte_chunks, mix64, shingle_hashes, split_words, text_column

MAX_EDITS = 0.25
RECALL = 0.999
SAMPLED = 3
REACH = 0.6
BLOCK_WORDS = 1_000_000
MOST_REPETITIONS = 2048
#: edited copies that recall is measured on
COPIES = 2000
_PAD = np.uint64(0x5BD1E9955BD1E995)
_FILTER_BITS = 22
_WALKERS = 200_000

_GAP = np.ones(256, dtype=bool)
_GAP[48:58] = _GAP[65:91] = _GAP[97:123] = _GAP[128:] = False

HITS = "array<struct<item_id:long,edits:int,n_words:int,begin:long,end:long>>"


def passage_words(lo: int, hi: int, raw: np.ndarray, off: np.ndarray) -> Words:
    data = _LOWER[raw]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    fold = after[(data[after] >= 0x80) & (data[after] <= 0x9E) & (data[after] != 0x97)]
    data[fold] += 0x20
    return split_words(lo, hi, data, off, _GAP)


def words_of_text(text: str | None) -> np.ndarray:
    raw = np.frombuffer((text or "").encode(), dtype=np.uint8)
    return passage_words(0, 1, raw, np.array([0, len(raw)])).hashes()


def edits_allowed(n: int, share: float = MAX_EDITS) -> int:
    return int(share * n)


def anchor_width(n: int, k: int) -> int:
    """Longest run (3 at most) that must survive k edits of n words."""
    return max([g for g in (1, 2, 3) if g * (k + 1) <= n], default=1)


def _draws(seed: int, repetitions: int) -> tuple[np.ndarray, np.ndarray]:
    """Per repetition: a salt for the walk, and the sampled places as shares of its length, one in each of ``SAMPLED``
    equal parts (places close together would agree wherever a short run is shared).  More repetitions begin with the
    same ones."""
    rng = np.random.default_rng(seed)
    draws = rng.random((repetitions, SAMPLED + 1))
    return (draws[:, 0] * 2.0 ** 63).astype(np.uint64), (draws[:, 1:] + np.arange(SAMPLED)) / SAMPLED * REACH


def matches(got: np.ndarray, want: np.ndarray) -> np.ndarray:
    """Sequences that equal each other at all sampled places of some repetition; the end of a walk equals nothing."""
    return ((got == want) & (want != _PAD)).all(axis=2).any(axis=1)


def cgk_samples(words: np.ndarray, length: np.ndarray, steps: np.ndarray, salts: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Sampled outputs of the random walks: (sequences, repetitions, SAMPLED).

    ``words`` is a padded matrix; sequence i has length[i] words and walks steps[i] steps."""
    n, r = len(words), len(salts)
    out = np.zeros((n, r, SAMPLED), dtype=np.uint64)
    if not n or not r:
        return out
    at = np.zeros((n, r), dtype=np.int64)
    pick = np.floor(places[None] * steps[:, None, None]).astype(np.int64)
    rows, last = np.arange(n)[:, None], words.shape[1] - 1
    for j in range(int(pick.max()) + 1):
        sym = np.where(at < length[:, None], words[rows, np.minimum(at, last)], _PAD)
        for s in range(SAMPLED):
            hit = pick[:, :, s] == j
            out[:, :, s][hit] = sym[hit]
        at += (mix64(sym ^ (salts + np.uint64(j * 0x9E3779B97F4A7C15 % 2 ** 64))[None]) & np.uint64(1)).astype(np.int64)
    return out


def _matrix(seqs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    length = np.array([len(s) for s in seqs], dtype=np.int64)
    out = np.full((len(seqs), max(1, int(length.max(initial=1)))), _PAD, dtype=np.uint64)
    for i, s in enumerate(seqs):
        out[i, :len(s)] = s
    return out, length


def _edited(words: np.ndarray, k: int, rng) -> np.ndarray:
    out = list(words)
    for _ in range(k):
        kind, i = rng.integers(3), int(rng.integers(len(out)))
        if kind == 0 and len(out) > 1:
            del out[i]
        elif kind == 1:
            out.insert(i, np.uint64(rng.integers(1, 2 ** 63)))
        else:
            out[i] = np.uint64(rng.integers(1, 2 ** 63))
    return np.array(out[:len(words)], dtype=np.uint64)


def repetitions_for(items: list[np.ndarray], recall: float = RECALL, seed: int = 7, copies: int = COPIES) -> int:
    """Least power of two of repetitions that finds copies of the items (``copies`` of a sample of at most 50) with the
    most edits allowed; 0 if ``MOST_REPETITIONS`` are too few."""
    rng = np.random.default_rng(seed)
    some = [items[i] for i in rng.permutation(len(items))[:50]]
    left = [(w, _edited(w, edits_allowed(len(w)), rng)) for w in some for _ in range(-(-copies // len(some)))]
    total, r = len(left), 8
    tried = 0
    while r <= MOST_REPETITIONS:
        salts, places = (x[tried:] for x in _draws(seed, r))
        a, b = _matrix([p[0] for p in left]), _matrix([p[1] for p in left])
        found = matches(cgk_samples(*b, 3 * a[1], salts, places), cgk_samples(*a, 3 * a[1], salts, places))
        left = [p for p, f in zip(left, found.tolist()) if not f]
        if 1 - len(left) / total >= recall:
            return r
        tried, r = r, 2 * r
    return 0


@dataclass
class ItemIndex:
    ids: list
    words: list[np.ndarray]
    grams: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]  # width -> hash, item, offset, filter
    salts: np.ndarray
    places: np.ndarray
    samples: np.ndarray


def build_index(items: list[tuple], seed: int = 7) -> ItemIndex:
    """Index of (item_id, text) rows; items without words are left out."""
    pairs = [(i, w) for i, w in ((i, words_of_text(t)) for i, t in items) if len(w)]
    words = [w for _, w in pairs]
    grams: dict[int, list] = {}
    for n, w in enumerate(words):
        g = anchor_width(len(w), edits_allowed(len(w)))
        h = shingle_hashes(w, g)
        grams.setdefault(g, []).append((h, np.full(len(h), n), np.arange(len(h))))
    index = {}
    for g, rows in grams.items():
        h, item, at = (np.concatenate(c) for c in zip(*rows))
        order = np.argsort(h, kind="stable")
        seen = np.zeros(1 << _FILTER_BITS, dtype=bool)
        seen[h >> np.uint64(64 - _FILTER_BITS)] = True
        index[g] = (h[order], item[order], at[order], seen)
    r = repetitions_for(words) if words else 0
    salts, places = _draws(seed, r)
    matrix, length = _matrix(words) if words else (np.zeros((0, 1), np.uint64), np.zeros(0, np.int64))
    return ItemIndex([i for i, _ in pairs], words, index, salts, places, cgk_samples(matrix, length, 3 * length, salts, places))


def _windows(index: ItemIndex, h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(row, start, item) of the windows that an anchor run gives, without repeats;
    start is a word index of the chunk and may lie before the row's first word."""
    found = []
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for g, (keys, item, at, seen) in index.grams.items():
        if len(h) < g:
            continue
        runs = shingle_hashes(h, g)
        ok = np.flatnonzero(seen[runs >> np.uint64(64 - _FILTER_BITS)] & (row[:len(runs)] == row[g - 1:]))
        lo, hi = np.searchsorted(keys, runs[ok], "left"), np.searchsorted(keys, runs[ok], "right")
        n = hi - lo
        pos, src = np.repeat(ok, n), np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found.append(np.stack([row[pos], pos - at[src], item[src]], axis=1))
    every = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return np.unique(every, axis=0) if len(every) else every


def _candidates(index: ItemIndex, h: np.ndarray, first: np.ndarray, win: np.ndarray) -> np.ndarray:
    """Windows that equal their item in all sampled places of some repetition."""
    if not len(index.salts):
        return win
    keep = np.zeros(len(win), dtype=bool)
    size = np.array([len(w) for w in index.words])
    step = max(1, _WALKERS // max(1, len(index.salts)))
    for a in range(0, len(win), step):
        row, start, item = win[a:a + step].T
        begin = np.maximum(start, first[row])
        length = np.maximum(np.minimum(start + size[item], first[row + 1]) - begin, 0)
        at = begin[:, None] + np.arange(int(size[item].max()))[None]
        words = h[np.minimum(at, len(h) - 1)]
        got = cgk_samples(words, length, 3 * size[item], index.salts, index.places)
        keep[a:a + step] = matches(got, index.samples[item])
    return win[keep]


def best_match(item: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of ``item`` to a stretch of ``text`` and one past the
    stretch's last word (the first that is best); bit-parallel, free ends."""
    m = len(item)
    full, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[int, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | 1 << i
    up, down, score, best, end = full, 0, m, m, 0
    for j, w in enumerate(text, 1):
        eq = where.get(w, 0)
        diag = (((eq & up) + up) ^ up) | eq | down
        grow = down | ~(diag | up) & full
        shrink = up & diag
        score += (1 if grow & top else 0) - (1 if shrink & top else 0)
        if score < best:
            best, end = score, j
        grow, shrink = grow << 1 & full, shrink << 1 & full
        up = (shrink | ~(diag | grow)) & full
        down = grow & diag
    return best, end


def _verified(index: ItemIndex, h: np.ndarray, first: np.ndarray, cand: np.ndarray) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(row, item) -> (edits, first word, one past the last word) of the best match."""
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    for row, start, item in cand.tolist():
        words = index.words[item]
        k = edits_allowed(len(words))
        lo, hi = max(start - k, int(first[row])), min(start + len(words) + k, int(first[row + 1]))
        text, want = h[lo:hi].tolist(), words.tolist()
        edits, end = best_match(want, text)
        if edits <= k:
            _, back = best_match(want[::-1], text[:end][::-1])
            hit = (edits, lo + end - back, lo + end)
            if (row, item) not in out or hit < out[row, item]:
                out[row, item] = hit
    return out


def _hits(index: ItemIndex, col: pa.Array) -> list[list[dict]]:
    out: list[list[dict]] = [[] for _ in range(len(col))]
    for lo, hi, raw, off in byte_chunks(col):
        w = passage_words(lo, hi, raw, off)
        h = w.hashes()
        cand = _candidates(index, h, w.first, _windows(index, h, w.first))
        if not len(cand):
            continue
        points = np.cumsum((raw & 0xC0) != 0x80)
        for (row, item), (edits, a, b) in sorted(_verified(index, h, w.first, cand).items()):
            base = points[off[row] - 1] if off[row] else 0
            out[lo + row].append({"item_id": index.ids[item], "edits": edits, "n_words": len(index.words[item]),
                                  "begin": int(points[w.starts[a]] - 1 - base), "end": int(points[w.ends[b - 1] - 1] - base)})
    return out


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple]]:
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    words = rows.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0] or 0
    n = -(-words // block_words)
    for b in range(n):
        part = F.xxhash64("text") % n
        yield [tuple(r) for r in rows.where(F.when(part < 0, part + n).otherwise(part) == b).collect()]


def find_passages(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` (text, ..) with ``hits``: for each item found item_id, edits, n_words and the
    passage's place (begin, end in code points)."""
    out = docs.select(*[c for c in docs.columns if c != "hits"]).withColumn("hits", F.array().cast(HITS))
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("n_words", pa.int32()),
                               ("begin", pa.int64()), ("end", pa.int64())]))
    for items in _blocks(benchmark, block_words):
        index = docs.sparkSession.sparkContext.broadcast(
            tuple(vars(build_index(sorted(items, key=lambda r: (r[0] is None, r[0] or 0, r[1])))).values()))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            items = ItemIndex(*index.value)
            for batch in batches:
                at = batch.schema.get_field_index("hits")
                hits = [a + b for a, b in zip(batch.column(at).to_pylist(), _hits(items, text_column(batch, "text")))]
                cols = [*batch.columns]
                cols[at] = pa.array(hits, kind)
                yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

        out = out.mapInArrow(run, T.StructType(out.schema.fields))
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found."""
    return find_passages(docs.select("doc_id", "text"), benchmark) \
        .select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark passage."""
    return find_passages(docs, benchmark).where(F.size("hits") == 0).select(*docs.columns)
