"""Calendar windows (J11) and the demand index (F16).

A date falls in a window when its (month, day) lies between the window's
inclusive start and end (same year; no window wraps the new year).  With
several matching windows the largest boost wins; no match gives 1.0.

The window list is a handful of literals, so the "range join" is written as
one conditional expression per window (``greatest`` over the matches): no
join, no shuffle, the whole thing stays inside whole-stage codegen.  For a
window *table* of unknown size, ``tag_with_windows`` joins the rows with
intervals of any length (``operators/intervals``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import whole_days
from basketry.operators.intervals import best_interval
from basketry.operators.scalar import attach

# Seasonal windows ((start month, day), (end month, day), boost, name).
SEASONAL_WINDOWS = [
    ((1, 1), (1, 15), 1.3, "early January"),
    ((3, 1), (3, 20), 1.2, "early March"),
    ((8, 1), (8, 31), 1.4, "August"),
    ((10, 1), (10, 31), 1.8, "October"),
    ((11, 20), (11, 30), 1.6, "late November"),
    ((12, 15), (12, 31), 1.5, "late December"),
]
GROWTH_SPAN = 0.35


def month_day(ts) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.month(c) * 100 + F.dayofmonth(c)


def _in_window(md: Column, w) -> Column:
    (m1, d1), (m2, d2) = w[0], w[1]
    return md.between(m1 * 100 + d1, m2 * 100 + d2)


def seasonal_multiplier(ts, windows=SEASONAL_WINDOWS) -> Column:
    md = month_day(ts)
    return F.greatest(F.lit(1.0), *[F.when(_in_window(md, w), F.lit(w[2])) for w in windows])


def seasonal_name(ts, windows=SEASONAL_WINDOWS) -> Column:
    """Name of the matching window with the largest boost (null outside)."""
    md = month_day(ts)
    best = None
    for w in sorted(windows, key=lambda w: -w[2]):
        best = F.when(_in_window(md, w), F.lit(w[3])) if best is None else \
            best.when(_in_window(md, w), F.lit(w[3]))
    return best


def seasonal_tags(orders_clean: DataFrame) -> DataFrame:
    """Per order date: orders, revenue, window name and multiplier."""
    daily = orders_clean.groupBy(F.to_date("order_date").cast("timestamp_ntz").alias("order_date")).agg(
        F.count(F.lit(1)).alias("orders"),
        F.coalesce(F.sum("total_amount"), F.lit(0)).cast("double").alias("revenue"))
    return daily.select("order_date", "orders", "revenue",
                        seasonal_name("order_date").alias("season"),
                        seasonal_multiplier("order_date").alias("multiplier"))


def demand_index(orders_clean: DataFrame) -> DataFrame:
    """Per order date: growth = 1 + days since the first order date / span *
    0.35, index = seasonal multiplier * growth, and revenue per index point."""
    tags = seasonal_tags(orders_clean)
    span = tags.groupBy().agg(F.min("order_date").alias("_d0"), F.max("order_date").alias("_d1"))
    t = attach(tags, span)
    days = whole_days(F.col("order_date").cast("timestamp_ntz"), F.col("_d0").cast("timestamp_ntz"))
    width = whole_days(F.col("_d1").cast("timestamp_ntz"), F.col("_d0").cast("timestamp_ntz"))
    growth = F.lit(1.0) + F.when(width > 0, days / width).otherwise(F.lit(0.0)) * F.lit(GROWTH_SPAN)
    out = t.withColumn("growth", growth) \
           .withColumn("demand_index", F.col("multiplier") * F.col("growth"))
    return out.select("order_date", "orders", "revenue", "multiplier", "growth", "demand_index",
                      (F.col("revenue") / F.col("demand_index")).alias("revenue_per_index"))


def window_intervals(windows: DataFrame, years: DataFrame) -> DataFrame:
    """Month-day windows as intervals [start, end) of every year from _y0 to _y1 (one row): (start, end, boost, name)."""
    day = lambda md: F.make_date(F.col("year"), F.floor(F.col(md) / 100).cast("int"), (F.col(md) % 100).cast("int"))
    return attach(windows, years).withColumn("year", F.explode(F.sequence("_y0", "_y1"))) \
        .select(day("start_md").cast("timestamp_ntz").alias("start"), F.date_add(day("end_md"), 1).cast("timestamp_ntz").alias("end"), "boost", "name")


def tag_with_windows(df: DataFrame, date_col: str, windows: DataFrame) -> DataFrame:
    """Range join of all rows against a window table (start_md, end_md, boost, name): ``df`` plus the largest
    matching boost (1.0 when none) as ``multiplier``.

    The windows become one interval per year of the data (as many as windows x years), and the rows
    are joined with those by ``operators/intervals``."""
    years = df.groupBy().agg(F.min(F.year(date_col)).alias("_y0"), F.max(F.year(date_col)).alias("_y1"))
    tagged = best_interval(df, date_col, window_intervals(windows, years), "boost", "name")
    return tagged.select(*df.columns, F.coalesce("boost", F.lit(1.0)).alias("multiplier"))


def windows_frame(spark, windows=SEASONAL_WINDOWS) -> DataFrame:
    rows = [(m1 * 100 + d1, m2 * 100 + d2, float(b), n) for (m1, d1), (m2, d2), b, n in windows]
    return spark.createDataFrame(rows, "start_md int, end_md int, boost double, name string")
