"""Exact distinct counts that roll up: bitmaps of ids per group.

A distinct count of a month can't be added up to a quarter's; a bitmap of the month's ids can be
joined with the others'.  Ids are cut into buckets of 32,768; a group holds one bitmap of 4 kB per bucket
that it has ids of.  Coarser groups are the union of finer ones, so the ids are looked at once, at
the finest grain.

Bitmaps pay when ids are dense.  Ids that are text, or numbers with large gaps, go
through a table of dense numbers first (``dense_ids``); ``id_numbers`` decides from the data, and
either way gives the same counts.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: ids per bitmap
BUCKET_IDS = 32768
#: bits of a bitmap per id that are still counted as dense
SPARE = 256

Stage = Callable[[str, DataFrame], DataFrame]


def dense_ids(ids: DataFrame, column: str, stage: Stage) -> DataFrame:
    """(column, number) of every distinct id that isn't null: 1, 2, .. in the order of the ids.  Sorted by range; a
    partition's numbers start after the counts of the partitions before it."""
    distinct = ids.select(column).where(F.col(column).isNotNull()).distinct()
    dealt = stage(f"{column}_order", distinct.repartitionByRange(column).sortWithinPartitions(column)
                  .withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()))
    # one row per partition: the window runs over those
    parts = dealt.groupBy("_part").agg(F.min("_at").alias("_low"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low") + 1).alias("_shift"))
    return dealt.join(parts, "_part").select(column, (F.col("_at") + F.col("_shift")).alias("number"))


def is_dense(ids: DataFrame, column: str) -> bool:
    """Whole numbers that fill their buckets well enough."""
    if not isinstance(ids.schema[column].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return False
    n, buckets = ids.agg(F.approx_count_distinct(column), F.approx_count_distinct(F.bitmap_bucket_number(F.col(column).cast("long")))).first()
    return buckets * BUCKET_IDS <= SPARE * n


def id_numbers(pairs: DataFrame, column: str, stage: Stage) -> DataFrame:
    """``pairs`` with ``_number``, a whole number per id (null for a null id)."""
    if is_dense(pairs, column):
        return pairs.withColumn("_number", F.col(column).cast("long"))
    numbers = stage(f"{column}_numbers", dense_ids(pairs, column, stage)).withColumnRenamed("number", "_number")
    return pairs.join(numbers, column, "left")


def distinct_bitmaps(numbered: DataFrame, by: Sequence[str]) -> DataFrame:
    """(by, bucket, bitmap) from rows with ``_number``; rows without one count nowhere."""
    n = F.col("_number")
    return numbered.where(n.isNotNull()).groupBy(*by, F.bitmap_bucket_number(n).alias("bucket")) \
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(n)).alias("bitmap"))


def roll_up(bitmaps: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """(by, bucket, bitmap) of coarser groups."""
    return bitmaps.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def distinct_counts(bitmaps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """(by, name): distinct ids per group."""
    return bitmaps.groupBy(*by).agg(F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0)).cast("long").alias(name))


def first_seen(bitmaps: DataFrame, by: str, name: str) -> DataFrame:
    """(by, name): ids per group that no smaller group has.  Running unions per bucket; a bucket has one row per group."""
    upto = Window.partitionBy("bucket").orderBy(by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = bitmaps.withColumn("_seen", F.bitmap_count(F.bitmap_or_agg("bitmap").over(upto)))
    gain = F.col("_seen") - F.coalesce(F.lag("_seen").over(Window.partitionBy("bucket").orderBy(by)), F.lit(0))
    return seen.withColumn("_gain", gain).groupBy(by).agg(F.sum("_gain").alias(name)).where(F.col(name) > 0)
