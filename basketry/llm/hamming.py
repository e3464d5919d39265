"""Exact top-k search in Hamming space (operator 6).

Codes.  Bit i of a vector's code tells whether its component i is above zero; codes are
arrays of 64-bit words.

Method: incremental multi-index hashing.  A code is cut into m segments; the index maps
(segment, value) to codes.  In round a every unfinished query probes each segment with all
values at segment distance exactly a from its own.  After round a, every code within distance
m * (a + 1) - 1 has been met, because its differences can't exceed a in all m segments.  A
query whose k-th distance so far is m * a + j needs only segments 0 to j in round a: that
covers distance m * a + j.  Met codes are verified (full distance) inside the join, which puts
out only those not beyond the query's k-th distance so far; a query is finished when its k-th
best verified distance is covered by that bound, or when it has met every row.  Results are
exact; radii grow only as far as the data ask.

Width of the segments.  Wide segments ask many values, narrow ones meet many rows.  The width
is the one of least expected cost (values asked, index rows, rows met) up to the k-th
distance expected, both taken from the pairs of at most ``SAMPLE`` codes.  That sample decides
the cost only; every row is indexed.  A query so far from the others that a segment's next round
would ask more than ``MASKS`` values goes on in an index of half the width.

Queries are all rows whose id is divisible by ``every``; they are searched in all other rows.

Scale.  Codes are grouped: of rows with one code only the k + 1 smallest ids can be in a
result, so copies of a vector cost at most k + 1 index rows (a top-k filter before the
shuffle).  Probes meet the index in an equi-join; per query k rows are kept between
rounds.  Rounds are written to the shared folder.

Defined results: ties in distance go to the smaller id; a row is never its own
neighbour, nor are rows with its id; rows with equal id and code count once; null or
empty vectors have no code, are not found and find nothing; null components and NaN
are not above zero; vectors are compared with those of their own length only;
fewer than k other rows: all of them; an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations
from math import comb, inf

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.tables import shared_table

K = 10
EVERY = 100
WORD = 64
#: Codes whose pairs tell the expected distances and bucket sizes.
SAMPLE = 512
#: Most values one segment is asked for in a round.
MASKS = 4096
#: An asked value or index row is written, shuffled and sorted; a met row is one comparison in the join.
ROW_COST = 10
WIDTHS = range(4, 25)


def code_words(vector: Column, dims: int) -> Column:
    """Sign bits as an array of longs."""
    def word(lo: int) -> Column:
        part = F.slice(vector, lo + 1, min(WORD, dims - lo))
        bits = F.transform(part, lambda x, i: F.when((x > 0) & ~F.isnan(x.cast("double")), F.call_function("shiftleft", F.lit(1).cast("long"), i))
                           .otherwise(F.lit(0).cast("long")))
        return F.aggregate(bits, F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(x))
    return F.array(*[word(lo) for lo in range(0, dims, WORD)])


def segments(dims: int, want: int) -> list[tuple[int, int, int]]:
    """(word, shift, bits) of each segment of about ``want`` bits; no segment crosses a word."""
    out = []
    for w, lo in enumerate(range(0, dims, WORD)):
        width = min(WORD, dims - lo)
        m = max(1, round(width / want))
        cuts = [width * i // m for i in range(m + 1)]
        out += [(w, a, b - a) for a, b in zip(cuts[:-1], cuts[1:])]
    return out


def choose_width(sample: list[list[int]], dims: int, rows: int, k: int, every: int) -> int:
    """Width of least expected cost per query in an index of ``rows`` codes like those of ``sample``."""
    if len(sample) < 2:
        return WIDTHS[0]
    codes = np.array(sample, dtype=np.int64).view(np.uint64)
    one, two = np.triu_indices(len(codes), 1)
    differ = codes[one] ^ codes[two]
    total = np.sort(np.bitwise_count(differ).sum(axis=1, dtype=np.int64))
    kth = int(total[min(len(total) - 1, len(total) * k // max(rows, 1))])

    def cost(want: int) -> float:
        segs = segments(dims, want)
        full, rest = divmod(kth, len(segs))
        asked = met = 0
        for i, (w, shift, bits) in enumerate(segs):
            radius = full if i <= rest else full - 1
            if max((comb(bits, a) for a in range(radius + 1)), default=0) > MASKS:
                return inf
            asked += sum(comb(bits, a) for a in range(radius + 1))
            part = (differ[:, w] >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
            met += rows * float((np.bitwise_count(part) <= radius).mean()) if radius >= 0 else 0
        return ROW_COST * (asked + len(segs) * every) + met

    return min(WIDTHS, key=cost)


def _keys(words: Column, segs) -> Column:
    """array<(seg, bits, key)>"""
    return F.array(*[F.struct(F.lit(i).alias("seg"), F.lit(bits).alias("bits"),
                              F.shiftrightunsigned(words[w], shift).bitwiseAND(F.lit((1 << bits) - 1)).alias("key"))
                     for i, (w, shift, bits) in enumerate(segs)])


def _masks(bits: int, weight: int) -> list[int]:
    return [sum(1 << i for i in c) for c in combinations(range(bits), weight)]


def _mask_column(segs, weight: int) -> Column:
    out = None
    for bits in sorted({b for _, _, b in segs}):
        masks = F.lit(_masks(bits, weight)).cast("array<long>")
        out = F.when(F.col("bits") == bits, masks) if out is None else out.when(F.col("bits") == bits, masks)
    return out


def _distance(a: str, b: str, words: int) -> Column:
    out = F.bit_count(F.col(a)[0].bitwiseXOR(F.col(b)[0]))
    for w in range(1, words):
        out = out + F.bit_count(F.col(a)[w].bitwiseXOR(F.col(b)[w]))
    return out.cast("int")


def _best(cand: DataFrame, k: int) -> DataFrame:
    at = Window.partitionBy("query_id", "query").orderBy("distance", "vec_id")
    return cand.distinct().withColumn("rank", F.row_number().over(at)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, k: int = K, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, distance) for vectors (vec_id, embedding)."""
    clean = vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0)).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    lengths = [r[0] for r in clean.select(F.size("embedding").alias("n")).distinct().collect()]
    out = None
    for dims in sorted(lengths):
        part = _top_k(clean.where(F.size("embedding") == dims), dims, k, every)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, distance int")
    return out


def _index(listed: DataFrame, segs) -> DataFrame:
    return shared_table(listed.select("vec_id", "code", F.explode(_keys(F.col("code"), segs)).alias("s"))
                        .select("vec_id", "code", "s.seg", "s.key"), "index")


def _top_k(clean: DataFrame, dims: int, k: int, every: int) -> DataFrame:
    words = -(-dims // WORD)
    codes = shared_table(clean.select("vec_id", code_words(F.col("embedding"), dims).alias("code")).distinct(), "codes")
    few = Window.partitionBy("code").orderBy("vec_id")
    listed = shared_table(codes.withColumn("_n", F.row_number().over(few)).where(F.col("_n") <= k + 1).drop("_n"), "listed")
    sample = [r[0] for r in listed.orderBy(F.xxhash64("vec_id", "code"), "vec_id").limit(SAMPLE).select("code").collect()]
    width = choose_width(sample, dims, listed.count(), k, every)
    segs = segments(dims, width)
    index = _index(listed, segs)
    active = codes.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("code").alias("query"),
                                                             F.lit(None).cast("int").alias("kth"))
    active = shared_table(active, "queries")
    best = None
    a = 0
    while True:
        if width > 1 and max(comb(bits, a) for _, _, bits in segs) > MASKS:
            width, a = width // 2, 0
            segs = segments(dims, width)
            index = _index(listed, segs)
        # a k-th distance so far of m * a + j is covered by segments 0..j of this round
        probes = active.select("query_id", "query", "kth", F.explode(_keys(F.col("query"), segs)).alias("s")) \
            .select("query_id", "query", "s.*", "kth")
        needed = F.col("kth").isNull() | (F.col("seg") <= F.col("kth") - F.lit(len(segs) * a))
        probes = probes.where((F.col("bits") >= a) & needed).select("query_id", "query", "kth", "seg", "key", F.explode(_mask_column(segs, a)).alias("mask")) \
            .select("query_id", "query", "kth", "seg", F.col("key").bitwiseXOR(F.col("mask")).alias("key"))
        distance = _distance("query", "code", words)
        met = probes.join(index.hint("merge"), ["seg", "key"]) \
            .where((F.col("vec_id") != F.col("query_id")) & (F.col("kth").isNull() | (distance <= F.col("kth")))) \
            .select("query_id", "query", "vec_id", distance.alias("distance"))
        if best is not None:
            met = met.unionByName(best.select("query_id", "query", "vec_id", "distance"))
        best = shared_table(_best(met, k), "best")
        # distances up to the bound are complete; a query with fewer than k results goes on to the last round
        bound = len(segs) * (a + 1) - 1
        if bound >= dims or a == max(bits for _, _, bits in segs):
            break
        last = best.where(F.col("rank") == k).select("query_id", "query", F.col("distance").alias("now"))
        active = shared_table(active.join(last, ["query_id", "query"], "left")
                              .where(F.col("now").isNull() | ((F.coalesce("kth", F.lit(dims + bound)) > bound) & (F.col("now") > bound)))
                              .select("query_id", "query", F.col("now").alias("kth")), "queries")
        if active.isEmpty():
            break
        a += 1
    return best.select("query_id", "rank", "vec_id", "distance")
