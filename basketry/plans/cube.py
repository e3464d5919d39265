"""All calendar trends from one scan of the orders (C9, A16, A21-A27).

The clean orders are aggregated once over grouping sets (one Expand, one
shuffle, partial sums in every task): by month, weekday, quarter, month and category, and month and customer.  The
result is staged with one folder per set.  The small sets are the trend tables' sums; the
(month, customer) pairs become bitmaps per month (``operators/bitmaps``), which give distinct
customers by month, quarter, year and in total, and new customers by month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import WEEKDAYS, year_month
from basketry.operators import bitmaps as bm
from basketry.operators.domain import reindex

#: name of the set -> its columns
SETS = {
    "month": ["year_month"],
    "weekday": ["weekday"],
    "quarter": ["year", "quarter"],
    "month_category": ["year_month", "category"],
    "month_customer": ["year_month", "customer_id"],
}
#: the dashboard's view of the raw orders: a line may be there twice, so its ids are counted as well
RAW_SETS = {
    "month": ["year_month"],
    "month_category": ["year_month", "category"],
    "month_customer": ["year_month", "customer_id"],
    "month_order": ["year_month", "order_id"],
}


def grouped(orders: DataFrame, sets: dict[str, list[str]]) -> DataFrame:
    """One row per group of each set: ``grain`` (its name), the set's columns, amount, orders, amounts."""
    cols = list(dict.fromkeys(c for s in sets.values() for c in s))
    src = orders.select(*cols, F.col("total_amount").alias("_amount"), F.col("order_id").alias("_order"))
    cube = src.groupingSets([[F.col(c) for c in s] for s in sets.values()], *[F.col(c) for c in cols]).agg(
        F.sum("_amount").alias("amount"), F.count("_order").alias("orders"), F.count("_amount").alias("amounts"),
        F.grouping_id(*cols).alias("_gid"))
    gid = {n: sum(1 << (len(cols) - 1 - i) for i, c in enumerate(cols) if c not in s) for n, s in sets.items()}
    grain = F.coalesce(*[F.when(F.col("_gid") == g, F.lit(n)) for n, g in gid.items()])
    return cube.withColumn("grain", grain).drop("_gid")


def part(cube: DataFrame, name: str, sets: dict[str, list[str]] = SETS) -> DataFrame:
    return cube.where(F.col("grain") == name).select(*sets[name], "amount", "orders", "amounts")


def _money() -> F.Column:
    return F.coalesce(F.col("amount"), F.lit(0)).cast("double")


def monthly_trend(cube: DataFrame, customers: DataFrame) -> DataFrame:
    counts = bm.distinct_counts(customers, ["year_month"], "customers")
    return part(cube, "month").join(counts, "year_month", "left").select(
        "year_month", _money().alias("revenue"), "orders", F.coalesce("customers", F.lit(0)).alias("customers"),
        (F.col("amount").cast("double") / F.when(F.col("amounts") > 0, F.col("amounts"))).alias("avg_order_value")).orderBy("year_month")


def weekday_trend(cube: DataFrame) -> DataFrame:
    return reindex(part(cube, "weekday").select("weekday", _money().alias("revenue"), "orders"), "weekday", WEEKDAYS) \
        .select("weekday", "revenue", "orders")


def category_monthly_trend(cube: DataFrame) -> DataFrame:
    return part(cube, "month_category").where(F.col("category").isNotNull()) \
        .select("year_month", "category", _money().alias("total_amount")).orderBy("year_month", "category")


def quarterly_trend(cube: DataFrame) -> DataFrame:
    label = F.concat(F.lit("Q"), F.col("quarter").cast("string"), F.lit(" "), F.col("year").cast("string"))
    return part(cube, "quarter").select("year", "quarter", _money().alias("revenue"), "orders", label.alias("label")).orderBy("year", "quarter")


def new_customers_trend(customers: DataFrame) -> DataFrame:
    return bm.first_seen(customers, "year_month", "new_customers").orderBy("year_month")


def month_bitmaps(cube: DataFrame, set_name: str, sets: dict[str, list[str]], stage: bm.Stage) -> DataFrame:
    """(year_month, bucket, bitmap) of a set's ids."""
    column = sets[set_name][-1]
    pairs = part(cube, set_name, sets).select("year_month", column)
    return bm.distinct_bitmaps(bm.id_numbers(pairs, column, stage), ["year_month"])


def periods(months: DataFrame, name: str) -> DataFrame:
    """(grain, period, name): distinct ids by month, quarter, year and in total, from the months' bitmaps."""
    year = F.substring("year_month", 1, 4)
    quarter = F.concat(year, F.lit("-Q"), F.ceil(F.substring("year_month", 6, 2).cast("int") / 3).cast("string"))
    steps = {"month": F.col("year_month"), "quarter": quarter, "year": year, "total": F.lit("all")}
    out = None
    for grain, period in steps.items():
        counts = bm.distinct_counts(bm.roll_up(months, [period.alias("period")]), ["period"], name).select(F.lit(grain).alias("grain"), "period", name)
        out = counts if out is None else out.unionByName(counts)
    return out


def raw_view(orders_valid: DataFrame) -> DataFrame:
    return orders_valid.withColumn("year_month", year_month("order_date"))


def trend_rows(cube: DataFrame, customers: DataFrame) -> DataFrame:
    """The five trend tables as rows (trend, period, category, revenue, orders, customers, avg_order_value, new_customers)."""
    null = lambda t, n: F.lit(None).cast(t).alias(n)
    m = monthly_trend(cube, customers).select(F.lit("month").alias("trend"), F.col("year_month").alias("period"), null("string", "category"),
                                              "revenue", "orders", "customers", "avg_order_value", null("long", "new_customers"))
    w = weekday_trend(cube).select(F.lit("weekday"), "weekday", null("string", "category"), "revenue", "orders", null("long", "customers"),
                                   null("double", "avg_order_value"), null("long", "new_customers"))
    c = category_monthly_trend(cube).select(F.lit("month_category"), "year_month", "category", "total_amount", null("long", "orders"),
                                            null("long", "customers"), null("double", "avg_order_value"), null("long", "new_customers"))
    n = new_customers_trend(customers).select(F.lit("new_customers"), "year_month", null("string", "category"), null("double", "revenue"),
                                              null("long", "orders"), null("long", "customers"), null("double", "avg_order_value"), "new_customers")
    q = quarterly_trend(cube).select(F.lit("quarter"), "label", null("string", "category"), "revenue", "orders", null("long", "customers"),
                                     null("double", "avg_order_value"), null("long", "new_customers"))
    return m.unionAll(w).unionAll(c).unionAll(n).unionAll(q)
