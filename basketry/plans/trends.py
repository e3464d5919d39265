"""Calendar trends over the clean orders (C9: A21-A25, plus the dashboard
variants A27/A28 on uncleaned rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import WEEKDAYS, weekday_name, year_month
from basketry.operators.domain import reindex


def money_sum(col: str = "total_amount") -> F.Column:
    """Decimal sum (exact, order independent), reported as double; the sum of
    an all-null group is 0 like pandas."""
    return F.coalesce(F.sum(F.col(col)), F.lit(0)).cast("double")


def money_mean(col: str = "total_amount") -> F.Column:
    """Mean of a decimal column computed from the exact decimal sum."""
    return (F.sum(F.col(col)).cast("double") / F.count(F.col(col)))


def monthly_trend(orders_clean: DataFrame) -> DataFrame:
    # order ids are unique after keep-first dedup: count == distinct count,
    # which leaves a single distinct aggregate (no Expand of the input)
    return (orders_clean.groupBy("year_month").agg(
                money_sum().alias("revenue"),
                F.count("order_id").alias("orders"),
                F.count_distinct("customer_id").alias("customers"),
                money_mean().alias("avg_order_value"))
            .orderBy("year_month"))


def weekday_trend(orders_clean: DataFrame) -> DataFrame:
    """Monday-first, every weekday present (null measures when absent)."""
    agg = orders_clean.groupBy("weekday").agg(
        money_sum().alias("revenue"),
        F.count("order_id").alias("orders"))
    return reindex(agg, "weekday", WEEKDAYS).select("weekday", "revenue", "orders")


def category_monthly_trend(orders_clean: DataFrame, value_name: str = "total_amount") -> DataFrame:
    """Sparse month x category revenue: absent pairs have no row."""
    return (orders_clean.where(F.col("category").isNotNull())
            .groupBy("year_month", "category")
            .agg(money_sum().alias(value_name))
            .orderBy("year_month", "category"))


def new_customers_trend(orders_clean: DataFrame) -> DataFrame:
    """Customers by the month of their first purchase; months with none are
    absent (two-level aggregate: per customer, then per month)."""
    first = orders_clean.groupBy("customer_id").agg(F.min("order_date").alias("_first"))
    return (first.groupBy(year_month("_first").alias("year_month"))
            .agg(F.count(F.lit(1)).alias("new_customers"))
            .orderBy("year_month"))


def quarterly_trend(orders_clean: DataFrame) -> DataFrame:
    return (orders_clean.groupBy("year", "quarter").agg(
                money_sum().alias("revenue"),
                F.count("order_id").alias("orders"))
            .withColumn("label", F.concat(F.lit("Q"), F.col("quarter").cast("string"),
                                          F.lit(" "), F.col("year").cast("string")))
            .orderBy("year", "quarter"))


# -- dashboard variants (raw order rows: cancelled removed, never deduplicated) --

def dashboard_monthly_trend(orders_valid: DataFrame) -> DataFrame:
    return (orders_valid.groupBy(year_month("order_date").alias("year_month")).agg(
                money_sum().alias("revenue"),
                F.count_distinct("order_id").alias("orders"),
                F.count_distinct("customer_id").alias("customers"))
            .orderBy("year_month"))


def dashboard_weekday_revenue(orders_valid: DataFrame, keep_position: bool = False) -> DataFrame:
    agg = orders_valid.groupBy(weekday_name("order_date").alias("weekday")) \
                      .agg(money_sum().alias("revenue"))
    cols = ["_pos", "weekday", "revenue"] if keep_position else ["weekday", "revenue"]
    return reindex(agg, "weekday", WEEKDAYS, keep_position=True).select(*cols)


def dashboard_category_trend(orders_valid: DataFrame) -> DataFrame:
    """Month x category revenue over the dashboard's raw rows."""
    return (orders_valid.where(F.col("category").isNotNull())
            .groupBy(year_month("order_date").alias("year_month"), "category")
            .agg(money_sum().alias("revenue")))


def category_totals(orders_valid: DataFrame) -> DataFrame:
    """Roll-up of ``dashboard_category_trend`` to category (A29), summed from
    the exact amounts."""
    return (orders_valid.where(F.col("category").isNotNull())
            .groupBy("category").agg(money_sum().alias("revenue")))
