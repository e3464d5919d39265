"""Keep the first row per key.

``drop_duplicates`` keeps the first row *in file order*; ``dropDuplicates``
keeps an arbitrary one.  So the caller names a total order and the operator
returns, per key, the row that is smallest in that order.

Plan: one aggregate ``min(struct(order..., rest...))`` per key, which Spark runs as
a sort aggregate (the buffer is a struct) on both sides of the shuffle.  Unlike a
plain ``row_number`` window, it has a map-side partial step, so a key repeated
millions of times is reduced to one row per map task before the shuffle and
never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.scalar import combine


def _q(name: str):
    """Column by exact name (dots or spaces in a name are not nesting)."""
    return F.col("`" + name.replace("`", "``") + "`")


def keep_first(df: DataFrame, keys: str | Sequence[str], order: Sequence[str], copies: str | None = None) -> DataFrame:
    """The first row per key; ``copies`` names a further column with the number of rows it stands for."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not order:
        raise ValueError("keep_first needs an ordering: the first row is only defined by one")
    order = [c for c in order if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = F.struct(*[_q(c) for c in order + rest])
    counted = [F.count(F.lit(1)).alias(copies)] if copies else []
    first = df.groupBy(*[_q(k) for k in keys]).agg(F.min(packed).alias("_first"), *counted)
    fields = [F.col("_first").getField(c).alias(c) for c in order + rest]
    extra = [_q(copies)] if copies else []
    return first.select(*[_q(k) for k in keys], *fields, *extra).select(*[_q(c) for c in df.columns], *extra)


def duplicates_removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """1-row audit: rows before, rows after, removed."""
    b = before.agg(F.count(F.lit(1)).alias("rows_before"))
    a = after.agg(F.count(F.lit(1)).alias("rows_after"))
    return combine(b, a).withColumn("removed", F.col("rows_before") - F.col("rows_after"))
