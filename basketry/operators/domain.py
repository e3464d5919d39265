"""Reindex an aggregate to a fixed, ordered domain (``Series.reindex``).

The domain is a literal list (e.g. 7 weekday names).  Values of the aggregate
outside the domain are dropped, domain values without a row get nulls, and the
output keeps the domain order via an explicit position column.  No join hint:
both sides are aggregates, and AQE turns the join into a broadcast at run time
from the measured sizes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def domain_frame(spark, key: str, values: Sequence) -> DataFrame:
    rows = [(i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"_pos int, {key} string")


def reindex(agg: DataFrame, key: str, values: Sequence, keep_position: bool = False) -> DataFrame:
    dom = domain_frame(agg.sparkSession, key, values)
    out = dom.join(agg, key, "left").orderBy("_pos")
    return out if keep_position else out.drop("_pos")
