"""Range join of rows with a table of intervals: the best interval that holds each row's time.

Intervals are half open, [start, end), of any length, may overlap and may be many.  The best one is
that with the largest value (ties: smallest label).

1. Bins.  The intervals' ends, drawn by hash, give cut points, about ``ENDS`` ends to a bin, so no bin has many
   pieces of intervals however they lie.
2. Pieces.  An interval keeps its parts in its first and last bin.  The bins that it covers whole are
   named by two overlapping blocks of a power of two (a largest value doesn't mind being
   asked twice), so an interval of any length costs at most four rows.
3. Sweep.  In each bin, the pieces in the order of their starts, with a heap of those not yet over, give
   disjoint segments with the best interval of each: one row per bin.
4. Rows meet their bin in an equijoin and find their segment in the bin's short list.  Every bin is there
   ``SPREAD`` times and its rows are dealt over the copies, so a time that holds a
   third of all rows does not end up in one task.

Nulls: a row without a time, an interval without start, end or value, and an interval that is over before it starts match
nothing.
"""

from __future__ import annotations

import heapq
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import MICROS_PER_DAY, day_number, micros_of_day

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENDS = 32
#: most bins: bounds the cut points; with more intervals the bins' lists grow instead
BINS = 1 << 16
SPREAD = 8

_END = 2 ** 62


def micros(ts: Column) -> Column:
    """Wall-clock microseconds since 1970, whatever the session's time zone."""
    return day_number(ts) * MICROS_PER_DAY + micros_of_day(ts)


def _binned(df: DataFrame, column: str, cuts: list[int], name: str) -> DataFrame:
    """``name``: number of cut points at or below the column."""
    if not cuts:
        return df.withColumn(name, F.lit(0))
    splits = [-float("inf"), *map(float, cuts), float("inf")]
    # micros are whole numbers below 2^53: exact as doubles
    placed = Bucketizer(splits=splits, inputCol=f"_{name}", outputCol=f"__{name}", handleInvalid="keep") \
        .transform(df.withColumn(f"_{name}", F.col(column).cast("double")))
    return placed.withColumn(name, F.col(f"__{name}").cast("int")).drop(f"_{name}", f"__{name}")


def _whole_bins(blocks: list, bins: int) -> dict[int, tuple]:
    """Best (value, label) of the blocks [start, start + 2^k) over each bin, handed down from large to small blocks."""
    better = lambda a, b: b if a is None or (-b[0], b[1]) < (-a[0], a[1]) else a
    levels: dict[int, dict[int, tuple]] = {}
    for k, start, best in blocks:
        level = levels.setdefault(k, {})
        level[start] = better(level.get(start), best)
    for k in range(max(levels, default=0), 0, -1):
        below = levels.setdefault(k - 1, {})
        for start, best in levels.get(k, {}).items():
            for s in (start, start + (1 << (k - 1))):
                below[s] = better(below.get(s), best)
    return {s: b for s, b in levels.get(0, {}).items() if s < bins}


def sweep(pieces: pd.DataFrame) -> list[tuple]:
    """Pieces (a, b, value, label) of one bin -> disjoint segments (start, value, label), ascending; value is None
    between the pieces."""
    rows = sorted(zip(pieces["a"].tolist(), pieces["b"].tolist(), pieces["value"].tolist(), pieces["label"].tolist()))
    times = sorted({t for a, b, _, _ in rows for t in (a, b)})
    out, heap, i = [], [], 0
    for t in times:
        while i < len(rows) and rows[i][0] <= t:
            a, b, value, label = rows[i]
            heapq.heappush(heap, (-value, label, b))
            i += 1
        while heap and heap[0][2] <= t:
            heapq.heappop(heap)
        best = (-heap[0][0], heap[0][1]) if heap else (None, None)
        if not out or out[-1][1:] != best:
            out.append((t, *best))
    return out


def _segments(intervals: DataFrame) -> tuple[DataFrame, list[int]]:
    """One row per bin (bin, segments), and the cut points."""
    spark = intervals.sparkSession
    iv = intervals.where("a < b AND value IS NOT NULL").groupBy("a", "b").agg(
        F.min(F.struct((-F.col("value")).alias("v"), "label")).alias("_m")).select("a", "b", (-F.col("_m.v")).alias("value"), F.col("_m.label").alias("label"))
    n = iv.count()
    bins = min(BINS, max(1, 2 * n // ENDS))
    cuts: list[int] = []
    if bins > 1:
        ends = iv.select(F.explode(F.array("a", "b")).alias("t")).distinct()
        some = ends.where(F.pmod(F.xxhash64("t"), F.lit(max(1, 2 * n // (4 * bins)))) == 0).toArrow().column("t").to_numpy()
        cuts = np.unique(np.quantile(some, np.arange(1, bins) / bins, method="lower")).tolist() if len(some) else []
    edges = [-_END, *cuts, _END]
    # the bins' edges, one row per bin
    edge = spark.createDataFrame([(i, lo, hi) for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:]))], "bin int, lower long, upper long")
    placed = _binned(_binned(iv.withColumn("_t", F.col("b") - 1), "a", cuts, "f"), "_t", cuts, "l").drop("_t")
    first = placed.withColumnRenamed("f", "bin").join(edge, "bin").select("bin", "a", F.least("b", "upper").alias("b"), "value", "label")
    last = placed.where("l > f").withColumnRenamed("l", "bin").join(edge, "bin").select("bin", F.col("lower").alias("a"), "b", "value", "label")
    inner = placed.where("l > f + 1").withColumn("k", F.floor(F.log2((F.col("l") - F.col("f") - 1).cast("double")) + 1e-9).cast("int"))
    size = F.expr("shiftleft(1, k)")
    blocks = inner.select("k", F.explode(F.array_distinct(F.array(F.col("f") + 1, F.col("l") - size))).alias("start"), "value", "label") \
        .groupBy("k", "start").agg(F.min(F.struct((-F.col("value")).alias("v"), "label")).alias("m")).collect()
    whole = _whole_bins([(r.k, r.start, (-r.m.v, r.m.label)) for r in blocks], len(edges) - 1)
    rows = [(b, edges[b], edges[b + 1], float(v), lab) for b, (v, lab) in whole.items()]
    pieces = first.unionByName(last)
    if rows:
        pieces = pieces.unionByName(spark.createDataFrame(rows, "bin int, a long, b long, value double, label string"))

    def one_bin(key, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bin": [key[0]], "segments": [[{"start": t, "value": v, "label": lab} for t, v, lab in sweep(pdf)]]})

    swept = pieces.groupBy("bin").applyInPandas(one_bin, "bin int, segments array<struct<start:long,value:double,label:string>>")
    return swept, cuts


def best_interval(rows: DataFrame, at: str, intervals: DataFrame, value: str, label: str, spread: int = SPREAD) -> DataFrame:
    """``rows`` with ``value`` and ``label`` of the best of the ``intervals`` (start, end, value, label) that hold
    the time in column ``at``; nulls where none does.  Columns of those names are replaced."""
    iv = intervals.select(micros(F.col("start")).alias("a"), micros(F.col("end")).alias("b"), F.col(value).cast("double").alias("value"),
                          F.col(label).cast("string").alias("label"))
    swept, cuts = _segments(iv)
    copies = swept.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))).withColumnsRenamed({"bin": "_bin", "segments": "_segments"})
    kept = [c for c in rows.columns if c not in (value, label)]
    timed = _binned(rows.select(*kept, micros(F.col(at)).alias("_t")), "_t", cuts, "_bin") \
        .withColumn("_copy", (F.monotonically_increasing_id() % spread).cast("int"))
    met = timed.join(copies, ["_bin", "_copy"], "left")
    found = F.try_element_at(F.filter("_segments", lambda s: s["start"] <= F.col("_t")), F.lit(-1))
    return met.withColumn("_s", found).select(*kept, F.col("_s.value").alias(value), F.col("_s.label").alias(label))
