"""Language-model scores from a probabilistic suffix tree (operator 3).

Text as symbols.  Words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) are spelled out in UTF-8
bytes, each followed by a space; a text ends with the symbol 0 and starts after zeros.

Model.  Contexts of up to ``DEPTH`` symbols are counted over all training texts.  A context is a
node if it was seen at least ``MIN_COUNT`` times and its next-symbol counts diverge from
those of the context one symbol shorter (log-likelihood gain of at least ``GAIN`` nats), so the tree
grows with the corpus and no context that passes is left out; the
suffixes of a node are nodes as well.  A node's distribution is its counts, smoothed with its
suffix's distribution in proportion to the number of different successors (Witten-Bell), down to
the root, which gives every byte some mass.  A symbol is scored in the state of the longest
suffix of its history that is a node.

Size.  The tree is a set of tables keyed by context, never collected or broadcast.  One join per
depth, over the distinct grams (history and symbol) of the corpus, training or not, turns counts into
probabilities from the root upwards.  The ``HOT_GRAMS`` most frequent grams are broadcast with their
probabilities; all other occurrences go, as packed (gram, document) arrays, to the bucket of their
gram's hash, where the rest of the probabilities are, and come back as partial sums.  So the broadcast
has a fixed bound, and no gram is scored by anything but the whole tree.  ``automaton`` is the same
model as one table in memory.

Base score (unigrams).  Words are counted over all training texts.  Words with at least ``HOT``
of all tokens (at most ``1 / HOT`` of them) are broadcast with their counts; all others go, as packed
(word hash, document, count) arrays, to the bucket of their hash, where all occurrences of a word
meet and its count is known; the documents' partial sums go back by the batch they came from.
Nothing is joined on a word, and no vocabulary is collected.

Defined results: null or blank texts have one token, the end; null doc_id is training
data (its remainder isn't 0); repeated rows give repeated rows and count as often in training;
without training rows every c is 0, and the model is uniform; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.tables import shared_table, shuffle_width
from basketry.llm.text import Words, mix64, text_column, word_chunks

DEPTH = 6
MIN_COUNT = 16
GAIN = 3.0
HOT_GRAMS = 1 << 20
HOT = 1 / 2500
SEGMENT = 512
PIECE_BYTES = 1 << 18
FRESH_ROWS = 1 << 19
HELD_ROWS = 1_600_000
SEND_ROWS = 1 << 16
SEND_PARTS = 64
COLD_ROWS = 1 << 19
SHIFT = np.uint64(8)
LOG10 = np.log(10.0)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 10 == 0, F.lit(False))


def symbols(w: Words, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbol stream of the rows (``depth`` zeros, spelled words, end), where each row begins
    and a mask of the symbols that are scored (not the leading zeros)."""
    n = w.hi - w.lo
    size = w.ends - w.starts
    per_row = np.diff(w.first)
    row = np.repeat(np.arange(n), per_row)
    place = np.cumsum(size + 1) - (size + 1) + (row + 1) * (depth + 1) - 1
    total = int((size + 1).sum()) + n * (depth + 1)
    out = np.zeros(total, dtype=np.uint8)
    scored = np.ones(total, dtype=bool)
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    byte = w.data[np.repeat(w.starts, size) + inner]
    out[np.repeat(place, size) + inner] = np.where(byte == 0, 1, byte)
    out[place + size] = 0x20
    spelled = np.concatenate([[0], np.cumsum(size + 1)])[w.first]
    begin = spelled[:-1] + np.arange(n) * (depth + 1)
    for i in range(depth):
        scored[begin + i] = False
    return out, begin, scored


def gram_codes(stream: np.ndarray, scored: np.ndarray, depth: int) -> np.ndarray:
    """Each scored symbol with the ``depth`` symbols before it, packed, oldest first."""
    code = np.zeros(len(stream), dtype=np.uint64)
    wide = stream.astype(np.uint64)
    for back in range(depth + 1):
        code[back:] |= wide[:len(wide) - back] << np.uint64(8 * back)
    return code[scored]


def _between(column: np.ndarray, old: np.ndarray, new: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.empty(len(old), column.dtype)
    out[old], out[at] = column, new
    return out


class _Counter:
    """Counts of codes, ascending.  Fresh codes wait unsorted, ``FRESH_ROWS`` at most or one call's, and are then
    folded into those held, so that beside these only one new copy of a column is needed."""

    def __init__(self):
        self.fresh, self.waiting = {}, 0
        self.code, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, codes: np.ndarray, weight: int = 1):
        self.fresh.setdefault(weight, []).append(codes)
        self.waiting += len(codes)
        if self.waiting > FRESH_ROWS:
            self._fold()
            if len(self.code) > HELD_ROWS:
                return self.drain()
        return None

    def _fold(self):
        while self.fresh:
            weight, parts = self.fresh.popitem()
            code = np.concatenate(parts)
            parts.clear()
            code.sort()
            first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
            n = np.diff(np.append(first, len(code))) * weight
            code = code[first]
            at = np.searchsorted(self.code, code)
            held = np.zeros(len(code), bool)
            inside = at < len(self.code)
            held[inside] = self.code[at[inside]] == code[inside]
            self.n[at[held]] += n[held]
            code, n, at = code[~held], n[~held], at[~held]
            at += np.arange(len(at))  # where new codes stand in the columns to come
            old = np.ones(len(self.code) + len(at), bool)
            old[at] = False
            self.code = _between(self.code, old, code, at)
            self.n = _between(self.n, old, n, at)
        self.waiting = 0

    def drain(self):
        self._fold()
        out = self.code, self.n
        self.code, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return out


def _count_batches(kind: int, got) -> Iterator[pa.RecordBatch]:
    """Counts in batches of ``SEND_ROWS``, so that neither side holds them a second time."""
    if got is None:
        return
    for lo in range(0, len(got[0]), SEND_ROWS):
        code, n = (x[lo:lo + SEND_ROWS] for x in got)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(code), kind, np.int32)), pa.array(code.view(np.int64)),
                                          pa.array(n.astype(np.int64))], names=["kind", "code", "n"])


def _count_pass(depth: int):
    """Rows (kind, code, n) of the rows (text, held_out) of a task."""
    def run(batches):
        grams, words = _Counter(), _Counter()
        for batch in batches:
            train = ~np.array(batch.column(1).to_pylist(), dtype=bool)
            for w in word_chunks(text_column(batch, "text"), PIECE_BYTES):
                stream, begin, scored = symbols(w, depth)
                codes, here = gram_codes(stream, scored, depth), train[w.lo:w.hi]
                known = np.repeat(here, np.diff(np.append(begin, len(stream))) - depth)
                spoken = w.hashes()[np.repeat(here, np.diff(w.first))]
                for kind, counter, some, weight in ((0, grams, codes[known], 1), (0, grams, codes[~known], 0), (1, words, spoken, 1)):
                    yield from _count_batches(kind, counter.add(some, weight))
        for kind, counter in ((0, grams), (1, words)):
            yield from _count_batches(kind, counter.drain())
    return run


def corpus_counts(docs: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(kind, code, n) over all training texts: kind 0, packed symbol grams; kind 1, words (hash).
    A task sends its distinct codes whenever many are held.  Without a column held_out all texts are
    training texts; grams that only held-out texts have get n = 0."""
    held = F.col("held_out") if "held_out" in docs.columns else F.lit(False)
    return docs.select("text", held.alias("held_out")).mapInArrow(_count_pass(depth), "kind int, code long, n long") \
        .groupBy("kind", "code").agg(F.sum("n").alias("n"))


@dataclass
class SuffixAutomaton:
    depth: int
    symbol: np.ndarray   # byte -> column of the tables
    next: np.ndarray     # (states * columns): next state
    logp: np.ndarray     # (states * columns): log10 probability of the symbol


def _level(grams: DataFrame, d: int) -> DataFrame:
    return grams.groupBy(F.col("code").bitwiseAND(F.lit((1 << 8 * (d + 1)) - 1)).alias("code")).agg(F.sum("n").alias("n"))


def gram_levels(grams: DataFrame, depth: int = DEPTH) -> dict[int, DataFrame]:
    """Per depth d (code, n): the distinct grams with d symbols of history."""
    levels, own = {}, grams
    for d in range(depth, -1, -1):
        own = levels[d] = shared_table(_level(own, d), f"grams{d}")
    return levels


def tree_contexts(levels: dict[int, DataFrame], least: float = MIN_COUNT, gain: float = GAIN) -> dict[int, DataFrame]:
    """Per depth from 1 (ctx, total, kinds): the nodes, all contexts that pass and their suffixes."""
    kept: dict[int, DataFrame] = {}
    depth = max(levels)
    seen = {d: x.where("n > 0").select(F.shiftright("code", 8).alias("ctx"), F.col("code").bitwiseAND(F.lit(255)).alias("sym"), "n")
            for d, x in levels.items()}
    for d in range(depth, 0, -1):
        low = (1 << 8 * (d - 1)) - 1
        sums = seen[d].groupBy("ctx").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).where(F.col("total") >= F.lit(least))
        up = seen[d - 1].select(F.col("ctx").alias("uctx"), F.col("sym").alias("usym"), F.col("n").alias("un"))
        usum = seen[d - 1].groupBy(F.col("ctx").alias("tctx")).agg(F.sum("n").alias("utotal"))
        rows = seen[d].join(sums, "ctx").withColumn("suffix", F.col("ctx").bitwiseAND(F.lit(low)))
        rows = rows.join(up, (F.col("suffix") == F.col("uctx")) & (F.col("sym") == F.col("usym"))) \
            .join(usum, F.col("suffix") == F.col("tctx"))
        score = F.sum(F.col("n") * F.log(F.col("n") * F.col("utotal") / (F.col("un") * F.col("total"))))
        mine = rows.groupBy("ctx").agg(score.alias("gain"), F.first("total").alias("total"), F.first("kinds").alias("kinds"))
        good = F.col("gain") >= gain
        if d < depth:
            below = kept[d + 1].select(F.col("ctx").bitwiseAND(F.lit((1 << 8 * d) - 1)).alias("ctx")).distinct().withColumn("below", F.lit(True))
            mine, good = mine.join(below, "ctx", "left"), good | F.col("below").isNotNull()
        kept[d] = shared_table(mine.where(good).select("ctx", "total", "kinds"), f"nodes{d}")
    return kept


def tree_nodes(grams: DataFrame, depth: int = DEPTH, p_min: float = 0.0, gain: float = GAIN, least: float = MIN_COUNT) -> DataFrame:
    """(d, ctx, sym, n): next-symbol counts of the tree's nodes, the root at d = 0; a node has at least
    ``least`` occurrences and ``p_min`` of all symbols."""
    levels = gram_levels(grams, depth)
    total = levels[0].agg(F.sum("n")).first()[0] or 0
    kept = tree_contexts(levels, max(least, p_min * total), gain)
    every = None
    for d in range(depth, -1, -1):
        rows = levels[d].where("n > 0").select(F.lit(d).alias("d"), F.shiftright("code", 8).alias("ctx"), F.col("code").bitwiseAND(F.lit(255)).alias("sym"), "n")
        rows = rows.join(kept[d], "ctx", "left_semi").select("d", "ctx", "sym", "n") if d else rows
        every = rows if every is None else every.unionByName(rows)
    return every


def gram_scores(levels: dict[int, DataFrame], kept: dict[int, DataFrame]) -> DataFrame:
    """(code, n, logp): log10 probability of the last symbol of every gram of the deepest level."""
    root = levels[0].where("n > 0").agg(F.count(F.lit(1)), F.sum("n")).first()
    columns, rest = root[0] + 1, max(1, 256 - root[0])  # unseen bytes share one column
    whole = (root[1] or 0) + 0.5 * columns
    p = levels[0].select("code", "n", (F.when(F.col("n") > 0, F.col("n") + F.lit(0.5)).otherwise(F.lit(0.5 / rest)) / F.lit(whole)).alias("p"))
    for d in range(1, max(levels) + 1):
        up = p.select(F.col("code").alias("ucode"), F.col("p").alias("up"))
        mine = levels[d].withColumn("ucode", F.col("code").bitwiseAND(F.lit((1 << 8 * d) - 1))).withColumn("ctx", F.shiftright("code", 8))
        own = (F.col("n") + F.col("kinds") * F.col("up")) / (F.col("total") + F.col("kinds"))
        p = mine.join(up, "ucode").join(kept[d], "ctx", "left").select("code", "n", F.coalesce(own, F.col("up")).alias("p"))
    return p.select("code", "n", F.log10("p").cast("float").alias("logp"))


def hot_from(scores: DataFrame, most: int = HOT_GRAMS) -> Column:
    """Whether a gram is among the ``most`` most frequent (whole steps of an eighth of a power of two)."""
    step = F.floor(F.log2(F.col("n") + 1) * 8)
    held, least = 0, None
    for value, n in sorted(scores.groupBy(step).count().collect(), reverse=True):
        held += n
        if held > most:
            break
        least = value
    return F.lit(False) if least is None else step >= F.lit(least)


def automaton(nodes: pa.Table, depth: int = DEPTH) -> SuffixAutomaton:
    """Scoring tables from the rows of ``tree_nodes`` (for a tree that fits one process)."""
    d, ctx, sym, n = (nodes.column(c).to_numpy().astype(np.int64) for c in ("d", "ctx", "sym", "n"))
    seen = np.unique(sym[d == 0])
    columns = len(seen) + 1
    symbol = np.full(256, columns - 1, dtype=np.int64)
    symbol[seen] = np.arange(len(seen))
    levels = [np.zeros(1, dtype=np.int64)]
    for k in range(1, depth + 1):
        levels.append(np.unique(ctx[d == k]))
    for k in range(depth, 1, -1):  # prefixes of nodes are states
        levels[k - 1] = np.union1d(levels[k - 1], levels[k] >> 8)
    for k in range(depth, 1, -1):  # and so are suffixes of those
        levels[k - 1] = np.union1d(levels[k - 1], levels[k] & ((1 << 8 * (k - 1)) - 1))
        levels[k - 1] = np.union1d(levels[k - 1], levels[k] >> 8)
    base = np.concatenate([[0], np.cumsum([len(x) for x in levels])])
    nxt = np.zeros((base[-1], columns), dtype=np.int32)
    prob = np.zeros((base[-1], columns), dtype=np.float64)
    counts = np.zeros(columns)
    counts[symbol[sym[d == 0]]] = n[d == 0]
    prob[0] = (counts + 0.5) / (counts.sum() + 0.5 * columns)
    for k in range(depth + 1):
        here = np.arange(base[k], base[k + 1])
        if k:
            up = base[k - 1] + np.searchsorted(levels[k - 1], levels[k] & ((1 << 8 * (k - 1)) - 1))
            nxt[here], prob[here] = nxt[up], prob[up]
            mine = d == k
            if mine.any():
                at = np.searchsorted(levels[k], ctx[mine])
                own = np.zeros((len(here), columns))
                own[at, symbol[sym[mine]]] = n[mine]
                total, kinds = own.sum(axis=1, keepdims=True), (own > 0).sum(axis=1, keepdims=True)
                prob[here] = np.where(total > 0, (own + kinds * prob[here]) / np.maximum(total + kinds, 1), prob[here])
        if k < depth and len(levels[k + 1]):
            child = levels[k + 1]
            parent = base[k] + np.searchsorted(levels[k], child >> 8)
            nxt[parent, symbol[child & 255]] = base[k + 1] + np.arange(len(child))
    prob[:, -1] /= max(1, 256 - len(seen))  # the last column stands for every unseen byte
    return SuffixAutomaton(depth, symbol, nxt.reshape(-1), np.log10(prob).astype(np.float32).reshape(-1))


def stream_scores(a: SuffixAutomaton, stream: np.ndarray, scored: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """log10 probability of each row of a symbol stream.  The stream is cut into segments that
    advance side by side, each warmed up on the ``depth`` symbols before it."""
    columns = len(a.next) and int(a.symbol.max()) + 1
    rows = -(-len(stream) // SEGMENT)
    padded = np.zeros(a.depth + rows * SEGMENT, dtype=np.uint8)
    padded[a.depth:a.depth + len(stream)] = stream
    sym = a.symbol[padded].astype(np.int32)
    grid = np.lib.stride_tricks.as_strided(sym, (a.depth + SEGMENT, rows), (sym.itemsize, SEGMENT * sym.itemsize))
    state = np.zeros(rows, dtype=np.int32)
    out = np.empty((SEGMENT, rows), dtype=np.float32)
    for t in range(a.depth + SEGMENT):
        at = state * np.int32(columns) + grid[t]
        if t >= a.depth:
            out[t - a.depth] = a.logp[at]
        state = a.next[at]
    flat = out.T.reshape(-1)[:len(stream)].astype(np.float64)
    flat[~scored] = 0
    return np.add.reduceat(flat, begin) if len(begin) else np.zeros(0)


# --- scoring pass ----------------------------------------------------------------------

_HEAD, _WORDS, _SUMS, _ANSWERS, _GRAMS, _GRAM_SUMS = range(6)
_ROWS = "place long, batch long, kind int, a binary, b binary, c binary, d binary"


def _packed(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int32()] + [pa.binary()] * 4
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                      names=[x.split()[0] for x in _ROWS.split(", ")])


def _word_counts(h: np.ndarray, row: np.ndarray):
    """Distinct (row, word) with counts, rows ascending."""
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (row[1:] != row[:-1])])) if len(h) else np.zeros(0, np.int64)
    return row[first], h[first], np.diff(np.append(first, len(h)))


def _buckets(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return ((hashes & np.uint64(0xFFFFFFFF)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def _dealt(bucket: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each bucket that has any with the places of its entries, in order."""
    order = np.argsort(bucket, kind="stable")
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in range(buckets):
        if edge[b + 1] > edge[b]:
            yield b, order[edge[b]:edge[b + 1]]


def _answers(buckets: int):
    """Rows (code, logp) packed by the bucket of the gram."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, logp = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            yield _packed([(buckets + b, -1, _ANSWERS, code[pick].tobytes(), logp[pick].tobytes(), b"", b"")
                           for b, pick in _dealt(_buckets(mix64(code), buckets), buckets)])
    return run


def hot_scores(hot, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row (of grams, ``first`` the index of each row's first) the log10 probabilities of its hot
    grams, and the places of all others."""
    keys, logps = hot
    if not len(keys):
        return np.zeros(len(first)), np.arange(len(codes))
    order = np.argsort(codes)
    want = codes[order]
    at = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
    hit = keys[at] == want
    value = np.empty(len(codes))
    value[order] = np.where(hit, logps[at], 0)
    return np.add.reduceat(value, first), np.sort(order[~hit])


def _score_pass(depth: int, hot_grams, hot, buckets: int):
    """Map side: per batch of rows a head (ids, flags, token counts and the sums of hot grams and hot
    words) and, per bucket, the other grams and words of the rows."""
    hot_hash, hot_count = hot

    def grams(here, cold):
        gram, row = (np.concatenate(x) for x in zip(*cold))
        cold.clear()
        return _packed([(buckets + b, here, _GRAMS, gram[pick].tobytes(), row[pick].tobytes(), b"", b"")
                        for b, pick in _dealt(_buckets(mix64(gram), buckets), buckets)])

    def words(here, rare, train):
        row, word, time = (np.concatenate(x) for x in zip(*rare))
        rare.clear()
        return _packed([(b, here, _WORDS, word[pick].tobytes(), row[pick].tobytes(), time[pick].tobytes(), np.packbits(train[row[pick]]).tobytes())
                        for b, pick in _dealt(_buckets(word, buckets), buckets)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, number = TaskContext.get().partitionId(), 0
        keys, counts = hot_hash.value, hot_count.value
        for batch in batches:
            ids = batch.column(0)
            train = ~np.array(batch.column(1).to_pylist(), dtype=bool)
            n = batch.num_rows
            score, tokens, known, base = np.zeros(n), np.ones(n, np.int64), np.zeros(n, np.int64), np.zeros(n)
            cold, held, rare, kept = [], 0, [], 0
            here = (part << 32) + number
            number += 1
            for w in word_chunks(text_column(batch, "text"), PIECE_BYTES):
                stream, begin, scored = symbols(w, depth)
                codes, first = gram_codes(stream, scored, depth), begin - depth * np.arange(w.hi - w.lo)
                score[w.lo:w.hi], rest = hot_scores(hot_grams.value, codes, first)
                cold.append((codes[rest], (w.lo + np.searchsorted(first, rest, side="right") - 1).astype(np.uint32)))
                held += len(rest)
                del stream, scored, codes, rest
                if held >= COLD_ROWS:
                    yield grams(here, cold)
                    held = 0
                tokens[w.lo:w.hi] += np.diff(w.first)
                r, h, c = _word_counts(w.hashes(), np.repeat(np.arange(w.lo, w.hi), np.diff(w.first)))
                at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                is_hot = keys[at] == h if len(keys) else np.zeros(len(h), bool)
                np.add.at(base, r[is_hot], c[is_hot] * np.log10(counts[at[is_hot]] + 0.1))
                np.add.at(known, r[is_hot], c[is_hot])
                rare.append((r[~is_hot].astype(np.uint32), h[~is_hot], np.minimum(c[~is_hot], 2 ** 32 - 1).astype(np.uint32)))
                kept += len(rare[-1][0])
                del w, r, h, c, at, is_hot
                if kept >= COLD_ROWS:
                    yield words(here, rare, train)
                    kept = 0
            if held:
                yield grams(here, cold)
            if kept:
                yield words(here, rare, train)
            yield _packed([(here % buckets, here, _HEAD, pa.array(ids, pa.int64()).fill_null(0).to_numpy(zero_copy_only=False).tobytes(),
                            np.stack([tokens, known, train.astype(np.int64), np.array(ids.is_null())]).astype(np.int64).tobytes(), score.tobytes(), base.tobytes())])
    return run


def _bucket_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket at a time: counts of its words from the training rows, then the partial sums of
    every batch; or probabilities of its grams, then the same; heads pass through."""
    def emit(parts):
        words = [np.frombuffer(p[1], np.uint64) for p in parts]
        keys = np.unique(np.concatenate(words))
        places, count = [], np.zeros(len(keys))
        for p, word in zip(parts, words):
            at = np.searchsorted(keys, word)
            train = np.unpackbits(np.frombuffer(p[4], np.uint8), count=len(word))
            count += np.bincount(at, weights=np.frombuffer(p[3], np.uint32) * train.astype(np.int64), minlength=len(keys))
            places.append(at.astype(np.uint32))
        out = []
        for p, at in zip(parts, places):
            n, times = count[at], np.frombuffer(p[3], np.uint32).astype(np.int64)
            which, inv = np.unique(np.frombuffer(p[2], np.uint32), return_inverse=True)
            out.append((0, p[0], _SUMS, which.tobytes(), np.bincount(inv, weights=times * np.log10(n + 0.1)).tobytes(),
                        np.bincount(inv, weights=times * (n > 0)).astype(np.int64).tobytes(), b""))
            if len(out) == SEND_PARTS:
                yield _packed(out)
                out = []
        if out:
            yield _packed(out)

    def gram_sums(name, known, a, b):
        code, row = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint32)
        at = np.searchsorted(known[0], code)
        which, inv = np.unique(row, return_inverse=True)
        return 0, name, _GRAM_SUMS, which.tobytes(), np.bincount(inv, weights=known[1][at]).tobytes(), b"", b""

    now, parts, answers, known = None, [], [], None
    for batch in batches:
        heads = []
        values = batch.columns[3:]
        for i, (place, name, kind) in enumerate(zip(*[x.to_pylist() for x in batch.columns[:3]])):
            if place != now:
                if parts:
                    yield from emit(parts)
                now, parts, answers, known = place, [], [], None
            if kind == _GRAMS:
                if known is None:
                    known = tuple(np.concatenate(x) for x in zip(*answers))
                    known, answers = tuple(x[np.argsort(known[0])] for x in known), []
                heads.append(gram_sums(name, known, *(x[i].as_buffer() for x in values[:2])))  # read in place
            elif kind == _HEAD:
                heads.append((place, name, kind, *(x[i].as_py() for x in values)))
            elif kind == _ANSWERS:
                answers.append((np.frombuffer(values[0][i].as_py(), np.uint64), np.frombuffer(values[1][i].as_py(), np.float32)))
            else:
                parts.append((name, *(x[i].as_py() for x in values)))
            if len(heads) == SEND_PARTS:
                yield _packed(heads)
                heads = []
        if heads:
            yield _packed(heads)
    if parts:
        yield from emit(parts)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, raw_base double, score double"


def _batch_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All rows of a batch together, the head first: its documents' results."""
    names = [x.split()[0] for x in SCORES.split(", ")]

    def emit(h):
        ids, flags, score, base = h
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64(), mask=flags[3].astype(bool)), pa.array(flags[2] == 0), pa.array(flags[0]), pa.array(flags[1]),
             pa.array(base), pa.array(score)], names=names)

    now, head = None, None
    for batch in batches:
        for _, name, kind, a, b, c, d in zip(*[x.to_pylist() for x in batch.columns]):
            if kind == _HEAD:
                if head is not None:
                    yield emit(head)
                now = name
                ids = np.frombuffer(a, np.int64)
                head = (ids, np.frombuffer(b, np.int64).reshape(4, len(ids)).copy(), np.frombuffer(c, np.float64).copy(), np.frombuffer(d, np.float64).copy())
            else:
                assert name == now
                at = np.frombuffer(a, np.uint32)
                if kind == _GRAM_SUMS:
                    head[2][at] += np.frombuffer(b, np.float64)
                    continue
                head[3][at] += np.frombuffer(b, np.float64)
                head[1][1][at] += np.frombuffer(c, np.int64)
    if head is not None:
        yield emit(head)


def score_documents(docs: DataFrame, depth: int = DEPTH, least: float = MIN_COUNT, gain: float = GAIN, hot_grams: int = HOT_GRAMS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    sc, width = docs.sparkSession.sparkContext, shuffle_width(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    train = rows.where("not held_out")
    counts = shared_table(corpus_counts(rows, depth), "counts")
    words = counts.where("kind = 1").select("code", "n")
    levels = gram_levels(counts.where("kind = 0").select("code", "n"), depth)
    scores = shared_table(gram_scores(levels, tree_contexts(levels, least, gain)), "scores")
    is_hot = hot_from(scores, hot_grams)
    often = scores.where(is_hot).select("code", "logp").toArrow()
    code = often.column("code").to_numpy().view(np.uint64)
    order = np.argsort(code)
    send_grams = sc.broadcast((code[order], often.column("logp").to_numpy()[order]))
    ends = train.count()
    spoken, kinds = words.agg(F.sum("n"), F.count(F.lit(1))).first()
    tokens, vocabulary = (spoken or 0) + ends, kinds + (ends > 0)
    hot = words.where(F.col("n") >= F.lit(max(1.0, HOT * tokens))).toArrow()
    code = hot.column("code").to_numpy().view(np.uint64)
    order = np.argsort(code)
    send = (sc.broadcast(code[order]), sc.broadcast(hot.column("n").to_numpy()[order]))
    packed = rows.mapInArrow(_score_pass(depth, send_grams, send, width), _ROWS) \
        .unionByName(scores.where(~is_hot).select("code", "logp").mapInArrow(_answers(width), _ROWS))
    sums = packed.repartition(width, "place").sortWithinPartitions("place", "batch", "kind").mapInArrow(_bucket_pass, _ROWS)
    done = sums.repartition(width, "batch").sortWithinPartitions("batch", "kind", "place").mapInArrow(_batch_pass, SCORES)
    scale = float(np.log10(tokens + 0.1 * (vocabulary + 1)))
    end = float(np.log10(ends + 0.1))
    return done.select("doc_id", "held_out", "n_tokens",
                       (F.col("n_known") + F.lit(int(ends > 0))).alias("n_known"), F.lit(int(tokens)).cast("long").alias("train_tokens"),
                       (F.col("raw_base") + F.lit(end) - F.col("n_tokens") * F.lit(scale)).alias("base_score"), "score")
