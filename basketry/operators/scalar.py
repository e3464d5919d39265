"""Global scalars (snapshot date, medians, totals) next to rows, without a
driver round trip.

The only cartesian products in the package go through these two helpers,
and every frame passed as ``one_row`` / to ``combine`` is a global aggregate
(``groupBy().agg``) or a top-1 pick, so it has exactly one row by
construction: the broadcast is bounded and no row count multiplies.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Append the columns of a 1-row frame to every row of ``df``."""
    return df.crossJoin(F.broadcast(one_row))


def combine(*one_row_frames: DataFrame) -> DataFrame:
    """Side by side: several 1-row frames as one 1-row frame."""
    return reduce(lambda a, b: a.crossJoin(b), one_row_frames)


def global_agg(df: DataFrame, *aggs) -> DataFrame:
    """A global aggregate always yields exactly one row (nulls on empty input)."""
    return df.groupBy().agg(*aggs)
