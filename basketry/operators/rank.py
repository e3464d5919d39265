"""Ranking-style operators: argmax/argmin rows, average rank, shares of a
total, min-max scaling.

Whole-table windows (``Window.partitionBy()``) put every row in one task, so
they are only used on tables whose row count is bounded by construction (k
clusters, a handful of segments).  Shares of a total on unbounded tables use a
1-row global aggregate instead.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.operators.scalar import attach


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def argmax(df: DataFrame, value: str, key: str | Sequence[str], largest: bool = True) -> DataFrame:
    """The first row (in ``key`` order) holding the largest (smallest) non-null
    ``value``: ``idxmax``/``idxmin``.  A top-1 sort (TakeOrderedAndProject),
    i.e. a per-partition top-1 and a merge of one row per partition."""
    keys = [key] if isinstance(key, str) else list(key)
    order = F.desc(value) if largest else F.asc(value)
    return df.where(F.col(value).isNotNull()).orderBy(order, *keys).limit(1)


def argmin(df: DataFrame, value: str, key: str | Sequence[str]) -> DataFrame:
    return argmax(df, value, key, largest=False)


def extreme_rows(df: DataFrame, specs: Sequence[tuple]) -> DataFrame:
    """(fact, key, value) of several argmax/argmin picks over one table, in one aggregate.

    A spec is (fact, value column, order columns, key column, largest): the row with the
    largest (smallest) non-null value, the first in the order columns on ties; the key as text,
    the value as double.  A fact without any value has no row."""
    picks = []
    for i, (_, value, order, key, largest) in enumerate(specs):
        v = F.col(value)
        row = F.struct((-v if largest else v).alias("_first"), *[F.col(c).alias(f"_o{j}") for j, c in enumerate(order)],
                       _c(key).cast("string").alias("key"), v.cast("double").alias("value"))
        picks.append(F.min(F.when(v.isNotNull(), row)).alias(f"_p{i}"))
    rows = F.array(*[F.struct(F.lit(spec[0]).alias("fact"), F.col(f"_p{i}.key").alias("key"), F.col(f"_p{i}.value").alias("value"))
                     for i, spec in enumerate(specs)])
    return df.groupBy().agg(*picks).select(F.explode(rows).alias("r")).select("r.*").where(F.col("value").isNotNull())


def average_rank(value: str, ascending: bool = True) -> Column:
    """pandas ``rank()``: ties share the mean of their positions.  For bounded
    tables only (whole-table window)."""
    order = F.asc(value) if ascending else F.desc(value)
    w = Window.orderBy(order)
    peers = Window.partitionBy(value)
    return F.rank().over(w) + (F.count(F.lit(1)).over(peers) - 1) / 2.0


def share_of_total(df: DataFrame, value: Column, name: str, scale: float = 100.0) -> DataFrame:
    """``x / sum(x) * scale`` using a broadcast 1-row total (no global window)."""
    total = df.groupBy().agg(F.sum(value).alias("_total"))
    return (attach(df, total)
              .withColumn(name, F.try_divide(value, F.col("_total")) * F.lit(scale)).drop("_total"))


def minmax_scale(df: DataFrame, columns: Sequence[str], eps: float = 1e-9) -> DataFrame:
    """``(x - min) / (max - min + eps)`` per column over the whole table, via a
    broadcast 1-row min/max aggregate."""
    mm = df.groupBy().agg(*[F.min(c).alias(f"_min_{c}") for c in columns],
                          *[F.max(c).alias(f"_max_{c}") for c in columns])
    out = attach(df, mm)
    for c in columns:
        out = out.withColumn(c, (F.col(c) - F.col(f"_min_{c}")) /
                             (F.col(f"_max_{c}") - F.col(f"_min_{c}") + F.lit(eps)))
    return out.drop(*[f"_min_{c}" for c in columns], *[f"_max_{c}" for c in columns])
