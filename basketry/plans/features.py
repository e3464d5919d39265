"""Customer features: RFM (C3), behaviour (C4), purchase interval (A14), web
engagement (A15) and the joined feature table (C5).

Plan shape of the feature table: the clean orders are scanned once, into sums per (customer, day,
category) with a map-side partial step.  What is left of a customer is bounded by the
calendar and the categories, so even a customer holding a third of all orders never puts
its raw rows into a single task, and only these sums are dealt out by customer, once:
the behaviour sums, the category counts and the gaps between days all work on that
partitioning.  The one row per customer that results is staged; snapshot date, the median of the
intervals and the joins read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.dates import day_number, plus_days, second_of_day, whole_days
from basketry.functions.flags import bool_mean, stable_mean, positive_share
from basketry.operators.quantile import fill_with_median
from basketry.operators.scalar import attach, global_agg

WEB_COLUMNS = ["total_sessions", "avg_pages_viewed", "avg_session_duration", "conversion_rate"]
CUSTOMER_ATTRS = ["customer_name", "gender", "age", "city", "state", "signup_date"]

FEATURE_COLUMNS = [
    "customer_id", "recency_days", "frequency", "monetary",
    "avg_order_value", "total_quantity", "avg_basket_size", "discount_usage_rate",
    "avg_discount_pct", "favorite_category", "category_diversity", "return_rate",
    "first_purchase", "last_purchase", "avg_purchase_interval_days",
    *WEB_COLUMNS, *CUSTOMER_ATTRS, "tenure_days",
]


def snapshot(orders_clean: DataFrame) -> DataFrame:
    """1 row: latest order date plus one day."""
    return global_agg(orders_clean, plus_days(F.max("order_date"), 1).alias("snapshot_date"))


def customer_aggregates(orders_clean: DataFrame) -> DataFrame:
    """Fused RFM + behaviour aggregate, one row per customer (without recency)."""
    amt = F.col("total_amount")
    return orders_clean.groupBy("customer_id").agg(
        # order ids are unique after keep-first dedup, so a plain count equals
        # the distinct count and avoids a second distinct aggregate (Expand)
        F.count("order_id").alias("frequency"),
        F.coalesce(F.sum(amt), F.lit(0)).cast("double").alias("monetary"),
        (F.sum(amt).cast("double") / F.count(amt)).alias("avg_order_value"),
        F.coalesce(F.sum("quantity"), F.lit(0)).cast("bigint").alias("total_quantity"),
        F.avg("quantity").alias("avg_basket_size"),
        positive_share("discount_pct").alias("discount_usage_rate"),
        F.avg("discount_pct").alias("avg_discount_pct"),
        F.coalesce(F.mode("category", True), F.lit("Unknown")).alias("favorite_category"),
        F.count_distinct("category").alias("category_diversity"),
        bool_mean("is_returned").alias("return_rate"),
        F.min("order_date").alias("first_purchase"),
        F.max("order_date").alias("last_purchase"),
    )


def rfm(orders_clean: DataFrame) -> DataFrame:
    """customer_id, recency_days, frequency, monetary."""
    agg = orders_clean.groupBy("customer_id").agg(
        F.max("order_date").alias("_last"),
        F.count("order_id").alias("frequency"),
        F.coalesce(F.sum("total_amount"), F.lit(0)).cast("double").alias("monetary"))
    return (attach(agg, snapshot(orders_clean))
            .select("customer_id",
                    whole_days("snapshot_date", "_last").alias("recency_days"),
                    "frequency", "monetary"))


def behavior(orders_clean: DataFrame) -> DataFrame:
    return customer_aggregates(orders_clean).drop("frequency", "monetary")


def purchase_intervals(orders_clean: DataFrame) -> DataFrame:
    """Mean whole-day gap between consecutive orders (sorted by time).

    With t = day*86400 + s, floor(gap/1 day) = (day' - day) - [s' < s], so the
    sum of gaps telescopes to (last day - first day) minus the number of
    "descents" in seconds-of-day.  Inside one day the sorted seconds never
    descend; across days only (last of day d, first of next day) can.  So a
    (customer, day) aggregate with min/max second-of-day and a lag over days
    gives the exact mean; customers with one order get null.
    """
    daily = orders_clean.where(F.col("order_date").isNotNull()).groupBy(
        "customer_id", day_number("order_date").alias("_day")).agg(
        F.min(second_of_day("order_date")).alias("_smin"),
        F.max(second_of_day("order_date")).alias("_smax"),
        F.count(F.lit(1)).alias("_n"))
    by_day = Window.partitionBy("customer_id").orderBy("_day")
    daily = daily.withColumn(
        "_descent", F.when(F.col("_smin") < F.lag("_smax").over(by_day), 1).otherwise(0))
    per = daily.groupBy("customer_id").agg(
        F.sum("_n").alias("_n"), F.min("_day").alias("_d0"), F.max("_day").alias("_d1"),
        F.sum("_descent").alias("_desc"))
    return per.select("customer_id", _mean_gap().alias("avg_purchase_interval_days"))


def web_features(sessions: DataFrame, rows: str | None = None) -> DataFrame:
    """Per customer: distinct sessions, mean pages, mean duration, conversion.  ``rows`` names a further column with
    the number of sessions read; the ones of no customer then have a row as well."""
    known = sessions if rows else sessions.where(F.col("customer_id").isNotNull())
    return known.groupBy("customer_id").agg(
        *([F.count(F.lit(1)).alias(rows)] if rows else []),
        F.count_distinct("session_id").alias("total_sessions"),
        F.avg("pages_viewed").alias("avg_pages_viewed"),
        stable_mean("session_duration_min").alias("avg_session_duration"),
        F.avg("converted").alias("conversion_rate"))


def daily_sums(orders_clean: DataFrame) -> DataFrame:
    """Sums per (customer, day, category), dealt out by customer: at most days x categories rows each."""
    amount, qty, pct = F.col("total_amount"), F.col("quantity"), F.col("discount_pct")
    day = day_number("order_date").alias("_day")
    sums = orders_clean.groupBy("customer_id", day, "category").agg(
        F.count(F.lit(1)).alias("_rows"), F.count("order_id").alias("_orders"), F.sum(amount).alias("_amount"), F.count(amount).alias("_amounts"),
        F.sum(qty).alias("_qty"), F.count(qty).alias("_qtys"), F.sum(F.when(pct > 0, 1).otherwise(0)).alias("_cut"),
        F.sum(pct).alias("_pct"), F.count(pct).alias("_pcts"), F.sum(F.col("is_returned").cast("int")).alias("_ret"),
        F.count("is_returned").alias("_rets"), F.min("order_date").alias("_first"), F.max("order_date").alias("_last"))
    return sums.repartition("customer_id")


def customer_orders(orders_clean: DataFrame) -> DataFrame:
    """One row per customer: the columns of ``customer_aggregates`` and the purchase interval.

    One chain over the daily sums: the windows (a customer's categories, days and their order) and the
    last aggregate all keep to the partitioning by customer, so nothing is scanned or dealt out twice."""
    kind, day = Window.partitionBy("customer_id", "category"), Window.partitionBy("customer_id", "_day")
    x = daily_sums(orders_clean).withColumns({
        "_kind_rows": F.sum("_rows").over(kind), "_kind_at": F.row_number().over(kind.orderBy("_day")),
        # the rows of a window are of one day: its earliest and latest time of day
        "_day_min": second_of_day(F.min("_first").over(day)), "_day_max": second_of_day(F.max("_last").over(day)), "_day_at": F.row_number().over(day.orderBy("category"))})
    # the row before a day's first row is the last one of the day before, and knows that day's end
    ended = F.lag("_day_max").over(Window.partitionBy("customer_id").orderBy("_day", "category"))
    x = x.withColumn("_descent", F.when((F.col("_day_at") == 1) & (F.col("_day_min") < ended), 1).otherwise(0))
    ratio = lambda a, b: F.try_divide(F.sum(a).cast("double"), F.sum(b))
    named = F.col("category").isNotNull()
    out = x.groupBy("customer_id").agg(
        F.sum("_orders").alias("frequency"),
        F.coalesce(F.sum("_amount"), F.lit(0)).cast("double").alias("monetary"),
        ratio("_amount", "_amounts").alias("avg_order_value"),
        F.coalesce(F.sum("_qty"), F.lit(0)).cast("bigint").alias("total_quantity"),
        ratio("_qty", "_qtys").alias("avg_basket_size"),
        ratio("_cut", "_rows").alias("discount_usage_rate"),
        ratio("_pct", "_pcts").alias("avg_discount_pct"),
        F.min(F.when(named, F.struct((-F.col("_kind_rows")).alias("n"), "category")))["category"].alias("_favorite"),
        F.sum(F.when(named & (F.col("_kind_at") == 1), 1).otherwise(0)).alias("category_diversity"),
        ratio("_ret", "_rets").alias("return_rate"),
        F.min("_first").alias("first_purchase"), F.max("_last").alias("last_purchase"),
        F.sum(F.when(F.col("_day").isNotNull(), F.col("_rows"))).alias("_n"), F.min("_day").alias("_d0"), F.max("_day").alias("_d1"),
        F.sum("_descent").alias("_desc"))
    return out.withColumn("favorite_category", F.coalesce("_favorite", F.lit("Unknown"))) \
        .withColumn("avg_purchase_interval_days", _mean_gap()).drop("_favorite", "_n", "_d0", "_d1", "_desc")


def _mean_gap() -> Column:
    """Mean gap in whole days from _n orders between the days _d0 and _d1 with _desc descents."""
    gap_sum = F.col("_d1") - F.col("_d0") - F.col("_desc")
    return F.when(F.col("_n") >= 2, gap_sum.cast("double") / (F.col("_n") - 1))


def customer_features(orders: DataFrame, web: DataFrame, customers_clean: DataFrame) -> DataFrame:
    """26-column feature table, one row per customer with a non-cancelled order.

    ``orders`` is ``customer_orders``, best staged: the median and the snapshot date are taken from it as well;
    ``web`` is ``web_features``.
    Joins are left joins keyed on customer_id; AQE picks broadcast or
    sort-merge from the measured sizes (the customer master grows with the
    data, so it is not hinted)."""
    snap = global_agg(orders, plus_days(F.max("last_purchase"), 1).alias("snapshot_date"))
    base = (orders.join(web, "customer_id", "left")
               .join(customers_clean.select("customer_id", *CUSTOMER_ATTRS), "customer_id", "left"))
    base = fill_with_median(base, "avg_purchase_interval_days", basis=orders, wide=True)
    base = attach(base, snap).withColumns({
        "recency_days": whole_days("snapshot_date", "last_purchase"),
        "tenure_days": whole_days("snapshot_date", "signup_date"),
    })
    base = base.na.fill(0, subset=WEB_COLUMNS)
    return base.select(*FEATURE_COLUMNS)
