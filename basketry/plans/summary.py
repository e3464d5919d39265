"""Summary payload (C11): one row of nested values, written as JSON.

All parts are bounded aggregates (categories, payment methods, weekdays, k
values, segment names, seven sentences), so folding them into arrays/maps
with ``collect_list`` keeps each fold small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.scalar import combine


def _as_map(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy().agg(F.map_from_entries(F.collect_list(
        F.struct(F.col(key).cast("string"), F.col(value)))).alias(name))


def summary_payload(kpis: DataFrame, revenue_by_category: DataFrame, by_payment: DataFrame,
                    by_weekday: DataFrame, rfm_stats: DataFrame, elbow: DataFrame,
                    mapping: DataFrame, insights: DataFrame) -> DataFrame:
    rbc = _as_map(revenue_by_category, "category", "revenue", "revenue_by_category")
    pay = _as_map(by_payment, "payment_method", "orders", "orders_by_payment_method")
    wd = _as_map(by_weekday, "weekday", "orders", "orders_by_weekday")
    rfm = rfm_stats.select(F.struct(
        F.struct(F.col("recency_days_mean").alias("mean"), F.col("recency_days_median").alias("median")).alias("recency_days"),
        F.struct(F.col("frequency_mean").alias("mean"), F.col("frequency_median").alias("median")).alias("frequency"),
        F.struct(F.col("monetary_mean").alias("mean"), F.col("monetary_median").alias("median")).alias("monetary"),
    ).alias("rfm_stats"))
    eda = (combine(kpis, rbc, pay, wd, rfm)
           .select(F.struct(
               "total_revenue", "total_orders", "total_customers", "avg_order_value",
               "return_rate_overall", F.array("date_min", "date_max").alias("date_range"),
               "revenue_by_category", "orders_by_payment_method", "orders_by_weekday",
               "rfm_stats").alias("eda_summary")))
    # {"k": [...], "inertia": [...], "silhouette": [...]}, ordered by k
    elbow_s = elbow.groupBy().agg(F.sort_array(F.collect_list(
        F.struct("k", "inertia", F.col("euclidean_silhouette").alias("silhouette")))).alias("_e")).select(
        F.struct(F.col("_e.k").alias("k"), F.col("_e.inertia").alias("inertia"),
                 F.col("_e.silhouette").alias("silhouette")).alias("elbow_data"))
    cmap = _as_map(mapping, "cluster", "segment", "cluster_mapping")
    ins = insights.groupBy().agg(F.sort_array(F.collect_list(F.struct("n", "text"))).alias("_i")) \
                  .select(F.col("_i.text").alias("insights"))
    return combine(eda, elbow_s, cmap, ins)


def payload_rows(payload: DataFrame) -> DataFrame:
    """The payload's values one by one: (path, text, number), paths as in the JSON (``a/b/0``)."""
    eda = F.col("eda_summary")
    no_text, no_number = F.lit(None).cast("string"), F.lit(None).cast("double")

    def cell(path, text=no_text, number=no_number):
        return F.struct((F.lit(path) if isinstance(path, str) else path).alias("path"), text.cast("string").alias("text"),
                        number.cast("double").alias("number"))

    def of_map(name):
        return F.transform(F.map_entries(eda[name]), lambda e: cell(F.concat(F.lit(f"eda_summary/{name}/"), e["key"]), number=e["value"]))

    def of_list(path, values, text=False):
        place = lambda i: F.concat(F.lit(f"{path}/"), i.cast("string"))
        return F.transform(values, lambda v, i: cell(place(i), text=v) if text else cell(place(i), number=v))

    numbers = ["total_revenue", "total_orders", "total_customers", "avg_order_value", "return_rate_overall"]
    single = F.array(*[cell(f"eda_summary/{n}", number=eda[n]) for n in numbers],
                     *[cell(f"eda_summary/rfm_stats/{m}/{s}", number=eda["rfm_stats"][m][s])
                       for m in ("recency_days", "frequency", "monetary") for s in ("mean", "median")])
    parts = [single, of_list("eda_summary/date_range", eda["date_range"], text=True),
             *[of_map(n) for n in ("revenue_by_category", "orders_by_payment_method", "orders_by_weekday")],
             *[of_list(f"elbow_data/{n}", F.col("elbow_data")[n]) for n in ("k", "inertia", "silhouette")],
             F.transform(F.map_entries("cluster_mapping"), lambda e: cell(F.concat(F.lit("cluster_mapping/"), e["key"]), text=e["value"])),
             of_list("insights", F.col("insights"), text=True)]
    return payload.select(F.explode(F.concat(*parts)).alias("_c")).select("_c.*")
