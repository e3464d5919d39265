"""Exact quantiles with linear interpolation (numpy/pandas default rule).

``percentile``/``median`` keep a map of every distinct value of a group in one
aggregation buffer.  This operator keeps the work spread out:

1. collapse to distinct ``(group, value, count)``: a hash aggregate with a
   map-side partial step, so a value repeated a billion times costs one row;
2. narrow domains (ages, days; the default): running counts over the distinct
   values of a group give every value its rank interval;
3. wide domains (``wide=True``, chosen by the caller): split points are computed
   once, as values, and every value gets a bucket number from them; the counts per
   (group, bucket) tell which buckets hold the target ranks, and only
   those buckets are sorted.  The buckets are part of the data, so the
   result doesn't depend on how Spark runs the plan; the split points
   (approximate percentiles) affect balance only;
4. keep only the rows covering ranks ``floor(p(n-1))`` and ``ceil(p(n-1))``
   and interpolate.

Result: one row per group (one row overall when ``by`` is empty, with nulls
when there are no values), columns ``by + names``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.scalar import attach

#: buckets of a wide domain: bounds the split points and the bucket table per group
BUCKETS = 512


def _value_counts(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    return (df.where(F.col(value).isNotNull())
              .groupBy(*by, F.col(value).cast("double").alias("_v"))
              .agg(F.count(F.lit(1)).alias("_c")))


def _targets(probs: Sequence[float]) -> list:
    """(floor rank, ceil rank, fraction) per probability, over ``_n`` values."""
    pos = [F.lit(p) * (F.col("_n") - 1) for p in probs]
    return [(F.floor(x), F.ceil(x), x - F.floor(x)) for x in pos]


def _any(conditions: list):
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _all(conditions: list):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _ranked_narrow(vc: DataFrame, by: list[str]) -> DataFrame:
    group = by or [F.lit(0)]
    upto = Window.partitionBy(*group).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return vc.withColumns({"_end": F.sum("_c").over(upto), "_n": F.sum("_c").over(Window.partitionBy(*group))})


def _ranked_wide(vc: DataFrame, by: list[str], probs: Sequence[float]) -> DataFrame:
    """Rank intervals of the values in the buckets that hold a target rank."""
    at = [i / BUCKETS for i in range(1, BUCKETS)]
    points = vc.agg(F.percentile_approx("_v", at, BUCKETS * 4)).first()[0] or []
    inner = sorted({p for p in points if p == p and abs(p) != float("inf")}) or [0.0]
    splits = [-float("inf"), *inner, float("inf")]
    b = Bucketizer(splits=splits, inputCol="_v", outputCol="_b", handleInvalid="keep").transform(vc)
    group = by or [F.lit(0)]
    before = Window.partitionBy(*group).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = b.groupBy(*by, "_b").agg(F.sum("_c").alias("_bc")).withColumns({
        "_off": F.coalesce(F.sum("_bc").over(before), F.lit(0)),
        "_n": F.sum("_bc").over(Window.partitionBy(*group))})
    inside = lambda r: (r >= F.col("_off")) & (r < F.col("_off") + F.col("_bc"))
    per = per.where(_any([inside(r) for lo, hi, _ in _targets(probs) for r in (lo, hi)]))
    # null-safe on the group keys: a null group is a group, as in groupBy
    keys = [*by, "_b"]
    per = per.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_off", "_n")
    r = b.join(per, _all([F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])) \
        .select(*keys, "_v", "_c", "_off", "_n")
    upto = Window.partitionBy(*by, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return r.withColumn("_end", F.col("_off") + F.sum("_c").over(upto))


def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    names: Sequence[str], by: Sequence[str] = (),
                    wide: bool = False) -> DataFrame:
    by = list(by)
    probs = [float(p) for p in probs]
    if len(probs) != len(names):
        raise ValueError("one name per probability")
    vc = _value_counts(df, value, by)
    r = _ranked_wide(vc, by, probs) if wide else _ranked_narrow(vc, by)
    holds = lambda rank: (F.col("_end") - F.col("_c") <= rank) & (rank < F.col("_end"))
    covers, picks, outs = [], [], []
    for i, (lo, hi, frac) in enumerate(_targets(probs)):
        covers += [holds(lo), holds(hi)]
        picks += [F.max(F.when(holds(lo), F.col("_v"))).alias(f"_lo{i}"),
                  F.max(F.when(holds(hi), F.col("_v"))).alias(f"_hi{i}"),
                  F.max(frac).alias(f"_fr{i}")]
        v_lo, v_hi, f = F.col(f"_lo{i}"), F.col(f"_hi{i}"), F.col(f"_fr{i}")
        outs.append(F.when(f == 0, v_lo).otherwise(v_lo + (v_hi - v_lo) * f).alias(names[i]))
    return r.where(_any(covers)).groupBy(*by).agg(*picks).select(*by, *outs)


def exact_median(df: DataFrame, value: str, name: str = "median",
                 by: Sequence[str] = (), wide: bool = False) -> DataFrame:
    return exact_quantiles(df, value, [0.5], [name], by, wide)


def fill_with_median(df: DataFrame, column: str, basis: DataFrame | None = None, wide: bool = False) -> DataFrame:
    """``fillna(col.median())``: the median of ``basis`` (default ``df``)
    replaces nulls in ``column``; the column keeps its type."""
    basis = df if basis is None else basis
    med = exact_median(basis, column, "_median", wide=wide)
    dtype = dict(df.dtypes)[column]
    filled = attach(df, med).withColumn(
        column, F.coalesce(F.col(column), F.col("_median").cast(dtype)))
    return filled.drop("_median")
