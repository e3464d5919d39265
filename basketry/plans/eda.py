"""Exploratory summary (C6: A16-A20) and the dashboard KPI row (A26)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import date_text
from basketry.functions.flags import bool_mean, stable_mean, np_round
from basketry.operators.quantile import exact_quantiles
from basketry.plans.trends import money_mean, money_sum
from basketry.operators.scalar import combine


def kpis(orders_clean: DataFrame) -> DataFrame:
    """1 row: revenue, orders, customers, mean order value, return rate, date range."""
    return orders_clean.groupBy().agg(
        money_sum().alias("total_revenue"),
        # unique after keep-first dedup: count == distinct count (one distinct agg left)
        F.count("order_id").alias("total_orders"),
        F.count_distinct("customer_id").alias("total_customers"),
        money_mean().alias("avg_order_value"),
        bool_mean("is_returned").alias("return_rate_overall"),
        date_text(F.min("order_date")).alias("date_min"),
        date_text(F.max("order_date")).alias("date_max"),
    )


def kpis_raw(orders_valid: DataFrame) -> DataFrame:
    """Dashboard KPI row over raw rows: sums and means count duplicated rows,
    distinct counts do not.  Two single-distinct aggregates joined as 1-row
    frames instead of one double-distinct aggregate (which would Expand every
    input row three-fold before the shuffle)."""
    a = orders_valid.groupBy().agg(
        money_sum().alias("total_revenue"),
        F.count_distinct("customer_id").alias("active_customers"),
        money_mean().alias("avg_order_value"),
        bool_mean("is_returned").alias("return_rate"))
    b = orders_valid.groupBy().agg(F.count_distinct("order_id").alias("total_orders"))
    return combine(a, b).select("total_revenue", "total_orders", "active_customers",
                                 "avg_order_value", "return_rate")


def revenue_by_category(orders_clean: DataFrame) -> DataFrame:
    """Exact decimal sum per category, rounded to cents as the reference
    rounds floats (``np_round``), largest first.
    A missing category is not a group (pandas drops null keys)."""
    return (orders_clean.where(F.col("category").isNotNull())
            .groupBy("category")
            .agg(np_round(F.sum("total_amount").cast("double"), 2).alias("revenue"))
            .orderBy(F.desc("revenue"), "category"))


def value_counts(df: DataFrame, col: str, name: str = "orders") -> DataFrame:
    """``value_counts``: nulls dropped, most frequent first, ties by key."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias(name))
              .orderBy(F.desc(name), col))


def rfm_stats(rfm: DataFrame) -> DataFrame:
    """1 row: exact mean and median of recency, frequency, monetary.  ``rfm``
    is the RFM table or the feature table (same customers, same columns).
    The three medians come from one quantile pass over the unpivoted
    (metric, value) rows, grouped by metric."""
    means = rfm.groupBy().agg(
        F.avg("recency_days").alias("recency_days_mean"),
        F.avg("frequency").alias("frequency_mean"),
        stable_mean("monetary").alias("monetary_mean"))
    metrics = ["recency_days", "frequency", "monetary"]
    long = rfm.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ])).alias("_m")).select("_m.*")
    med = exact_quantiles(long, "value", [0.5], ["median"], by=["metric"], wide=True)
    wide = med.groupBy().agg(*[F.max(F.when(F.col("metric") == m, F.col("median"))).alias(f"{m}_median")
                               for m in metrics])
    return combine(means, wide).select(
        "recency_days_mean", "recency_days_median", "frequency_mean",
        "frequency_median", "monetary_mean", "monetary_median")
