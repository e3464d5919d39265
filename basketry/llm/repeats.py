"""Passages that repeat in an earlier document (operator 12).

A window is ``window`` words in a row of one document.  A word is removed if a window covers it
whose words also stand, as a window, in a document with a smaller doc_id.  Windows are
judged on the input: what another document loses plays no part.  Words are compared
unchanged, as 64-bit hashes (two different windows share one with probability 2^-64).

Method.  Level-wise doubling: lengths double (the last step overlaps by what is too much) from the
first length above ``SHORTEST / 2`` up to ``window``.  Every window that is still a candidate
stands for the smallest hash among the grams of the level's length inside it; the choice depends on
the window's words alone, so equal windows choose equal grams, and neighbouring windows mostly
the same one (about every fourth word is chosen at the first level).  Grams that do not come
again drop the windows that chose them; only the others go on to twice the length.  At the last
length a window is its own gram, and the smallest doc_id decides.  The levels end when no candidate
survives; beyond ``window`` a longer window covers no further word.

Scale.  Texts are packed once into compressed chunks of ``CHUNK_BYTES`` (a longer text is a chunk of its own).
Of a chunk and level every distinct gram goes once to the bucket of its hash, with the chunk's smallest
doc_id at the last level; so a line that every document holds costs one entry per chunk.  The bucket
answers with one bit per entry, and a chunk works out the rest from its words.  Buckets
grow in number with the texts, not in size, and hashes spread over them evenly.  Texts are never
grouped; a chunk meets its own answers in a join.

Defined results: null or empty texts have no words; texts shorter than ``window`` lose nothing; repeated rows and
rows with the same doc_id don't remove each other's words; a null doc_id counts as larger than any
other (ties between null ids remove nothing); only doc_id and text are read, other columns
are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.tables import shared_table, shuffle_width
from basketry.llm.text import byte_chunks, mix64, shingle_hashes, split_words, text_column

WINDOW = 13
SHORTEST = 8
CHUNK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
_NO_ID = np.int64(2 ** 63 - 1)
_TURN = 0x9E3779B97F4A7C15

CHUNKS = "chunk long, ids array<long>, sizes array<long>, packed binary"
ENTRIES = "bucket int, chunk long, hashes binary, firsts binary"
ANSWERS = "chunk long, level int, bucket int, bits binary"
RESULT = "doc_id long, words long, removed long, spans array<struct<begin:long,end:long>>, kept string"


def level_lengths(window: int, shortest: int = SHORTEST) -> list[int]:
    """Lengths of the levels, each at most twice the one before."""
    lengths = [window]
    while lengths[0] > shortest:
        lengths.insert(0, (lengths[0] + 1) // 2)
    return lengths


def pack(docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """Texts as compressed chunks, in the shared folder."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base, made = TaskContext.get().partitionId() << 32, 0
        ids: list = []
        sizes: list[int] = []
        held: list[bytes] = []

        def chunk():
            row = {"chunk": [base + made], "ids": [ids], "sizes": [sizes], "packed": [pa.compress(b"".join(held), "zstd", asbytes=True)]}
            return pa.RecordBatch.from_pydict(row, schema=pa.schema(
                [("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("packed", pa.binary())]))

        total = 0
        for batch in batches:
            given = batch.column(batch.schema.get_field_index("doc_id"))
            for lo, hi, raw, off in byte_chunks(text_column(batch, "text")):
                if ids and total + len(raw) > chunk_bytes:
                    yield chunk()
                    made, total, ids, sizes, held = made + 1, 0, [], [], []
                ids += given.slice(lo, hi - lo).to_pylist()
                sizes += np.diff(off).tolist()
                held.append(raw.tobytes())
                total += len(raw)
        if ids:
            yield chunk()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return shared_table(rows.mapInArrow(work, CHUNKS), "repeat-chunks")


class _Chunk:
    """Words of a chunk, and its candidates level by level."""

    def __init__(self, ids: list, sizes: list[int], packed: bytes, window: int):
        off = np.concatenate(([0], np.cumsum(np.array(sizes, dtype=np.int64))))
        raw = np.frombuffer(pa.decompress(packed, int(off[-1]), "zstd"), dtype=np.uint8)
        self.ids = ids
        self.words = split_words(0, len(ids), raw, off)
        self.hash = self.words.hashes()
        self.window = window
        doc = np.repeat(np.arange(len(ids)), np.diff(self.words.first))
        # starts of all windows that end in their own document
        n = max(0, len(doc) - window + 1)
        self.starts = np.flatnonzero(doc[:n] == doc[window - 1:window - 1 + n])
        self.key = np.array([_NO_ID if i is None else i for i in ids], dtype=np.int64)[doc]

    def choose(self, length: int) -> tuple[np.ndarray, ...]:
        """Distinct hashes that the candidates choose, per candidate their number, and the smallest and largest
        doc_id of each."""
        grams = shingle_hashes(self.hash, length) if len(self.starts) else self.hash[:0]
        grams = mix64(grams ^ np.uint64(_TURN * length % 2 ** 64))
        room = self.window - length
        if room:
            at = np.empty(len(self.starts), dtype=np.int64)
            reach = np.arange(room + 1)
            for lo in range(0, len(at), 1 << 16):
                s = self.starts[lo:lo + (1 << 16)]
                at[lo:lo + len(s)] = s + grams[s[:, None] + reach].argmin(axis=1)
        else:
            at = self.starts
        distinct, number = np.unique(grams[at], return_inverse=True)
        number = number.reshape(-1)
        first = np.full(len(distinct), _NO_ID)
        last = np.full(len(distinct), np.iinfo(np.int64).min)
        np.minimum.at(first, number, self.key[self.starts])
        np.maximum.at(last, number, self.key[self.starts])
        return distinct, number, first, last

    def replay(self, lengths: list[int], answers: list, buckets: int) -> None:
        """Keep the candidates that come again at each of ``lengths`` (all shorter than the window)."""
        for level, length in enumerate(lengths):
            distinct, number, first, last = self.choose(length)
            again = answered(distinct, level, answers, buckets) | (first < last)
            self.starts = self.starts[again[number]]


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket numbers, ascending with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


def answered(distinct: np.ndarray, level: int, answers: list, buckets: int) -> np.ndarray:
    """One flag per hash from the buckets' answers."""
    out = np.zeros(len(distinct), dtype=bool)
    of = bucket_of(distinct, buckets)
    for a in answers:
        if a["level"] == level and a["bucket"] >= 0:
            lo, hi = np.searchsorted(of, [a["bucket"], a["bucket"] + 1])
            out[lo:hi] = np.unpackbits(np.frombuffer(a["bits"], dtype=np.uint8))[:hi - lo]
    return out


def _each_chunk(work: Callable, window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                yield from work(row["chunk"], _Chunk(row["ids"], row["sizes"], row["packed"], window), row["answers"] or [])
    return run


def entries(chunks: DataFrame, lengths: list[int], level: int, buckets: int) -> DataFrame:
    """What the chunks' candidates choose at ``lengths[level]``, by bucket.  A chunk with a gram in two of its own
    documents also puts out a row without hashes, in a bucket below 0."""
    window = lengths[-1]
    final = level == len(lengths) - 1

    def work(chunk: int, c: _Chunk, answers: list) -> Iterator[pa.RecordBatch]:
        c.replay(lengths[:level], answers, buckets)
        distinct, _, first, last = c.choose(lengths[level])
        of = bucket_of(distinct, buckets)
        cut = np.flatnonzero(np.diff(of)) + 1
        lo = np.concatenate(([0], cut)) if len(of) else cut
        hi = np.append(cut, len(of)) if len(of) else cut
        rows = [(int(of[a]), distinct[a:b].tobytes(), first[a:b].tobytes() if final else None) for a, b in zip(lo.tolist(), hi.tolist())]
        if (first < last).any():
            rows.append((-1 - chunk % buckets, b"", None))
        if rows:
            b, h, f = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(b, pa.int32()), pa.array([chunk] * len(b), pa.int64()), pa.array(h, pa.binary()),
                                              pa.array(f, pa.binary())], names=["bucket", "chunk", "hashes", "firsts"])

    return chunks.mapInArrow(_each_chunk(work, window), ENTRIES)


def answer(sent: DataFrame, level: int, width: int) -> DataFrame:
    """One bit per entry: the gram is in another chunk (last level: with a smaller doc_id)."""

    def settle(bucket: int, rows: list) -> pa.RecordBatch | None:
        if bucket < 0:
            out = [(c, b"") for c, _, _ in rows[:1]]
        else:
            h = np.concatenate([np.frombuffer(x, dtype=np.uint64) for _, x, _ in rows])
            order = np.argsort(h, kind="stable")
            head = np.append(True, h[order][1:] != h[order][:-1])
            group = np.cumsum(head) - 1
            flag = np.empty(len(h), dtype=bool)
            if rows[0][2] is None:
                flag[order] = np.bincount(group)[group] > 1
            else:
                first = np.concatenate([np.frombuffer(x, dtype=np.int64) for _, _, x in rows])
                flag[order] = np.minimum.reduceat(first[order], np.flatnonzero(head))[group] < first[order]
            out, at = [], 0
            for c, x, _ in rows:
                own = flag[at:at + len(x) // 8]
                at += len(x) // 8
                if own.any():
                    out.append((c, np.packbits(own).tobytes()))
        if not out:
            return None
        c, bits = zip(*out)
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()), pa.array([level] * len(c), pa.int32()), pa.array([bucket] * len(c), pa.int32()),
                                           pa.array(bits, pa.binary())], names=["chunk", "level", "bucket", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, rows = None, []
        for batch in batches:
            for b, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if b != bucket:
                    if rows and (done := settle(bucket, rows)) is not None:
                        yield done
                    bucket, rows = b, []
                rows.append(row)
        if rows and (done := settle(bucket, rows)) is not None:
            yield done

    dealt = sent.repartition(width, "bucket").sortWithinPartitions("bucket")
    return shared_table(dealt.select("bucket", "chunk", "hashes", "firsts").mapInArrow(run, ANSWERS), "repeat-answers")


def find_repeats(docs: DataFrame, window: int = WINDOW, shortest: int = SHORTEST, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(doc_id, words, removed, spans, kept) of every row; ``spans`` are the removed stretches, in words, ``kept``
    the words that stay, joined by one space."""
    spark = docs.sparkSession
    lengths = level_lengths(window, shortest)
    packed = pack(docs, chunk_bytes)
    size = packed.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    width = shuffle_width(spark)
    buckets = max(width, size // BUCKET_BYTES)
    answers: DataFrame | None = None

    def with_answers() -> DataFrame:
        if answers is None:
            return packed.withColumn("answers", F.lit(None).cast("array<struct<level:int,bucket:int,bits:binary>>"))
        # at most one answer per (chunk, level, bucket)
        got = answers.where("bucket >= 0").groupBy("chunk").agg(F.collect_list(F.struct("level", "bucket", "bits")).alias("answers"))
        return packed.join(got, "chunk", "left").select(*packed.columns, "answers")

    for level in range(len(lengths)):
        new = answer(entries(with_answers(), lengths, level, buckets), level, max(width, buckets // 4))
        answers = new if answers is None else answers.unionByName(new)
        if new.isEmpty():
            break

    def work(chunk: int, c: _Chunk, given: list) -> Iterator[pa.RecordBatch]:
        c.replay(lengths[:-1], given, buckets)
        distinct, number, first, _ = c.choose(window)
        gone = answered(distinct, len(lengths) - 1, given, buckets)[number] | (first[number] < c.key[c.starts])
        edge = np.zeros(len(c.hash) + 1, dtype=np.int64)
        np.add.at(edge, c.starts[gone], 1)
        np.add.at(edge, c.starts[gone] + window, -1)
        cover = np.cumsum(edge)[:-1] > 0
        w, data = c.words, c.words.data.tobytes()
        first_word = w.first.tolist()
        for lo in range(0, len(c.ids), 1000):
            some = range(lo, min(len(c.ids), lo + 1000))
            removed, spans, kept = [], [], []
            for d in some:
                a, b = first_word[d], first_word[d + 1]
                lost = cover[a:b]
                turn = np.flatnonzero(np.diff(np.concatenate(([False], lost, [False])))).tolist()
                stay = np.flatnonzero(~lost) + a
                removed.append(b - a - len(stay))
                spans.append([{"begin": x, "end": y} for x, y in zip(turn[::2], turn[1::2])])
                kept.append(b" ".join([data[s:e] for s, e in zip(w.starts[stay].tolist(), w.ends[stay].tolist())]).decode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([c.ids[d] for d in some], pa.int64()), pa.array([first_word[d + 1] - first_word[d] for d in some], pa.int64()),
                 pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))),
                 pa.array(kept, pa.string())], names=["doc_id", "words", "removed", "spans", "kept"])

    return with_answers().mapInArrow(_each_chunk(work, window), RESULT)
