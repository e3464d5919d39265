"""Null-aware predicates with pandas semantics.

``series.eq("Cancelled")`` is False for a missing status, whereas SQL ``=``
yields NULL (and ``NOT (s = 'Cancelled')`` would then drop the row).
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_value(col: str, value) -> Column:
    """True/False, never NULL."""
    return F.col(col).eqNullSafe(F.lit(value))


def not_value(col: str, value) -> Column:
    return ~F.col(col).eqNullSafe(F.lit(value))


def positive_share(col: str) -> Column:
    """Mean of ``x > 0`` where a missing x counts as False (in the denominator)."""
    return F.avg(F.when(F.col(col) > 0, 1.0).otherwise(0.0))


def bool_mean(col: str) -> Column:
    return F.avg(F.col(col).cast("double"))


def stable_mean(col: str) -> Column:
    """Mean of a double column that doesn't depend on the order of the rows.

    A double sum depends on the order rows are added in (partitioning, retries).
    Each value is split, without loss, into a multiple of 2^-20 and a rest
    below 2^-20: sums of the multiples are exact up to 2^33, and the rests are too
    small for their order to show.  Nothing is rounded away; sums beyond
    2^33 are ordinary double sums."""
    x = F.col(col).cast("double")
    grid = F.when(F.abs(x) < float(2 ** 42), F.floor(x * float(2 ** 20)).cast("double") / float(2 ** 20)).otherwise(x)
    return (F.sum(grid) + F.sum(x - grid)) / F.count(x)


def np_round(col, digits: int) -> Column:
    """The reference's ``.round(digits)``: ``rint(x * 10^d) / 10^d`` on the
    double (ties to even on the binary product), not Spark's half-up
    ``round`` on the decimal text."""
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)
