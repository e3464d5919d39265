"""Cluster profiles, business labels and per-segment results
(M9/M10, A30-A40, W2/W3/W5, C8, C13-C18).

Everything downstream of the k-row cluster profile works on DataFrames whose
size is bounded by k (clusters) or the number of segment names, so broadcasts
of those frames are bounded by construction.  The per-customer inputs (the
feature table) are aggregated or joined against those small frames; the one
customer-grain join (the weekday pattern's semi-join with the segmented ids)
runs on (customer, weekday) counts, not on order rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketry.functions.dates import WEEKDAYS, weekday_name
from basketry.functions.flags import stable_mean, np_round
from basketry.operators.domain import reindex
from basketry.operators.quantile import exact_quantiles
from basketry.operators.rank import argmax, average_rank, extreme_rows, minmax_scale
from basketry.operators.scalar import attach

# Business segment names.
HIGH_VALUE = "High Value Customers"
OCCASIONAL = "Occasional Buyers"
NEW = "New Customers"
PRICE_SENSITIVE = "Price Sensitive Customers"
AT_RISK = "At Risk / Inactive Customers"
# Pool order used for clusters that win no rule.
LABEL_POOL = [HIGH_VALUE, OCCASIONAL, NEW, PRICE_SENSITIVE, AT_RISK]
FALLBACK = OCCASIONAL

SUMMARY_MEANS = [
    ("avg_recency_days", "recency_days"), ("avg_frequency", "frequency"),
    ("avg_monetary", "monetary"), ("avg_order_value", "avg_order_value"),
    ("avg_basket_size", "avg_basket_size"), ("discount_usage_rate", "discount_usage_rate"),
    ("return_rate", "return_rate"), ("category_diversity", "category_diversity"),
    ("conversion_rate", "conversion_rate"),
]
DOUBLE_FEATURES = {"monetary", "avg_order_value", "avg_basket_size", "discount_usage_rate",
                   "return_rate", "conversion_rate"}


def mean_of(col: str) -> F.Column:
    """Order-independent mean: exact decimal sum for double features."""
    return stable_mean(col) if col in DOUBLE_FEATURES else F.avg(col)


def fixed_clusters(features: DataFrame, k: int = 5) -> DataFrame:
    """Test fixture: cluster = customer_id % k (deterministic, SQL-checkable)."""
    return features.withColumn("cluster", (F.col("customer_id") % k).cast("int"))


def cluster_profile(clustered: DataFrame) -> DataFrame:
    """k rows: cluster means used by the labelling rule, their average ranks
    and the diagnostic score ``-rank(recency) + rank(frequency) + rank(monetary)``."""
    prof = clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("customers"),
        mean_of("recency_days").alias("recency_days"),
        mean_of("frequency").alias("frequency"),
        mean_of("monetary").alias("monetary"),
        F.avg("tenure_days").alias("tenure_days"),
        mean_of("discount_usage_rate").alias("discount_usage_rate"))
    return prof.withColumn(
        "score", -average_rank("recency_days") + average_rank("frequency") + average_rank("monetary"))


# Naming rules in order of priority (name, profile column, largest wins).
RULES = [(HIGH_VALUE, "monetary", True), (NEW, "tenure_days", False), (AT_RISK, "recency_days", True),
         (PRICE_SENSITIVE, "discount_usage_rate", True)]


def _runner_up_winners(prof: DataFrame) -> DataFrame:
    """(cluster, segment): deferred acceptance.  A rule that finds its cluster taken by an earlier one goes on
    to its next best; as every cluster prefers the earlier rule, taking the rules in order settles it
    in one step per rule, each over the k-row profile."""
    places = prof.select("cluster", *[F.row_number().over(Window.orderBy(
        F.desc_nulls_last(value) if largest else F.asc_nulls_last(value), "cluster")).alias(f"_r{i}") for i, (_, value, largest) in enumerate(RULES)],
        *[F.col(value).isNotNull().alias(f"_v{i}") for i, (_, value, _) in enumerate(RULES)])
    taken = None
    for i, (name, _, _) in enumerate(RULES):
        free = places.where(f"_v{i}")
        if taken is not None:
            free = free.join(taken, "cluster", "left_anti")
        won = free.groupBy().agg(F.min_by("cluster", f"_r{i}").alias("cluster")).where(F.col("cluster").isNotNull()) \
            .select("cluster", F.lit(name).alias("segment"))
        taken = won if taken is None else taken.unionByName(won)
    return taken


def label_clusters(prof: DataFrame, resolve: str = "position") -> DataFrame:
    """(cluster, segment) for every cluster of the k-row profile.

    1. winners: High Value = max monetary, New = min tenure, At Risk = max
       recency, Price Sensitive = max discount usage (first cluster id on ties);
    2. applied in that order; a cluster keeps the first name it wins and a
       lost name is not passed on;
    3. unnamed clusters (ascending id) take unused pool names in pool order;
    4. anything left is "Occasional Buyers".

    ``resolve="runner_up"`` replaces step 2: a name whose cluster is taken goes to the next best
    cluster of its rule (a rule without any value names none).
    """
    if resolve not in ("position", "runner_up"):
        raise ValueError(f"unknown resolve {resolve}")
    spark = prof.sparkSession
    if resolve == "runner_up":
        assigned = _runner_up_winners(prof)
    else:
        rules = extreme_rows(prof, [(name, value, ["cluster"], "cluster", largest) for name, value, largest in RULES])
        rules = rules.select(F.col("key").cast(prof.schema["cluster"].dataType).alias("cluster"), F.col("fact").alias("segment"),
                             F.array_position(F.array(*[F.lit(w[0]) for w in RULES]), F.col("fact")).alias("rule"))
        assigned = rules.groupBy("cluster").agg(F.min_by("segment", "rule").alias("segment"))
    pool = spark.createDataFrame(list(enumerate(LABEL_POOL)), "pos int, segment string")
    free_names = pool.join(assigned, "segment", "left_anti") \
                     .withColumn("_rn", F.row_number().over(Window.orderBy("pos")))
    free_clusters = prof.select("cluster").join(assigned, "cluster", "left_anti") \
                        .withColumn("_rn", F.row_number().over(Window.orderBy("cluster")))
    paired = free_clusters.join(free_names, "_rn", "inner").select("cluster", "segment")
    named = assigned.unionByName(paired)
    return (prof.select("cluster").join(named, "cluster", "left")
                .select("cluster", F.coalesce("segment", F.lit(FALLBACK)).alias("segment")))


def assign_segments(clustered: DataFrame, mapping: DataFrame) -> DataFrame:
    """Map cluster -> segment; the mapping has k rows, so it is broadcast."""
    return clustered.join(F.broadcast(mapping), "cluster", "left")


def cluster_sizes(segmented: DataFrame) -> DataFrame:
    """(cluster, segment, customers)."""
    return segmented.groupBy("cluster", "segment").agg(F.count(F.lit(1)).alias("customers"))


def segment_means(segmented: DataFrame) -> DataFrame:
    """Unrounded per-segment means (the basis of the summary)."""
    return segmented.groupBy("segment").agg(
        F.count("customer_id").alias("customers"),
        *[mean_of(src).alias(name) for name, src in SUMMARY_MEANS],
        F.mode("favorite_category", True).alias("top_category"))


def segment_summary(segmented: DataFrame) -> DataFrame:
    """14 columns: means rounded to 2, shares of customers and of revenue
    rounded to 1; the revenue share uses the rounded mean spend (as the
    reference does).  One row per segment, so totals are a tiny aggregate."""
    m = segment_means(segmented)
    rounded = m.select("segment", "customers",
                       *[np_round(name, 2).alias(name) for name, _ in SUMMARY_MEANS],
                       "top_category")
    rounded = rounded.withColumn("_rev", F.col("avg_monetary") * F.col("customers"))
    tot = rounded.groupBy().agg(F.sum("customers").alias("_nc"), F.sum("_rev").alias("_nr"))
    out = attach(rounded, tot).withColumns({
        # try_divide: an all-zero total gives null (pandas: NaN), not an error
        "pct_of_customers": np_round(F.try_divide(F.col("customers"), F.col("_nc")) * 100, 1),
        "pct_of_revenue": np_round(F.try_divide(F.col("_rev"), F.col("_nr")) * 100, 1),
    })
    return out.select("segment", "customers", *[n for n, _ in SUMMARY_MEANS],
                      "pct_of_customers", "pct_of_revenue", "top_category")


def segment_sizes(segmented: DataFrame) -> DataFrame:
    """Segment counts (largest first) with a flag on the largest segment."""
    counts = segmented.where(F.col("segment").isNotNull()).groupBy("segment") \
                      .agg(F.count(F.lit(1)).alias("customers"))
    top = argmax(counts, "customers", "segment").select(
        "segment", F.lit(True).alias("is_largest"))
    return (counts.join(top, "segment", "left")
                  .withColumn("is_largest", F.coalesce("is_largest", F.lit(False)))
                  .orderBy(F.desc("customers"), "segment"))


def segment_leaders(segmented: DataFrame, summary: DataFrame) -> DataFrame:
    """(metric, segment, value): the segment leading each dashboard metric.
    Feature means come from the customers, the rest from the rounded summary
    table; ties go to the first segment name."""
    means = segmented.groupBy("segment").agg(
        mean_of("recency_days").alias("recency_days"),
        mean_of("frequency").alias("frequency"),
        mean_of("monetary").alias("monetary"))
    spec = lambda metric, col, largest=True: (metric, col, ["segment"], "segment", largest)
    from_means = extreme_rows(means, [spec("most_recent", "recency_days", False), spec("most_frequent", "frequency"),
                                      spec("highest_spend", "monetary")])
    from_summary = extreme_rows(summary, [spec("highest_order_value", "avg_order_value"),
                                          spec("highest_discount_usage", "discount_usage_rate"),
                                          spec("highest_return_rate", "return_rate"),
                                          spec("most_diverse", "category_diversity"), spec("largest_segment", "customers")])
    return from_means.unionByName(from_summary) \
        .select(F.col("fact").alias("metric"), F.col("key").alias("segment"), "value")


BOX_METRICS = ["recency_days", "frequency", "monetary"]


def segment_box_stats(segmented: DataFrame) -> DataFrame:
    """Per segment and metric: min, q1, median, q3, max (exact, linear) and the
    whisker ends: the most extreme values within 1.5 IQR of the quartiles.
    The three metrics are unpivoted to (segment, metric, x) rows so one
    quantile pass and one aggregate serve them all."""
    long = segmented.select("segment", F.explode(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("_x")) for m in BOX_METRICS
    ])).alias("_m")).select("segment", "_m.*")
    q = exact_quantiles(long, "_x", [0.25, 0.5, 0.75], ["q1", "median", "q3"], by=["segment", "metric"], wide=True)
    q = q.withColumn("_iqr", F.col("q3") - F.col("q1"))
    # (segment, metric) rows: bounded by segments x 3
    pts = long.join(F.broadcast(q), ["segment", "metric"], "inner")
    lo_fence = F.col("q1") - 1.5 * F.col("_iqr")
    hi_fence = F.col("q3") + 1.5 * F.col("_iqr")
    agg = pts.groupBy("segment", "metric").agg(
        F.min("_x").alias("min"), F.max("_x").alias("max"),
        F.min(F.when(F.col("_x") >= lo_fence, F.col("_x"))).alias("lower_whisker"),
        F.max(F.when(F.col("_x") <= hi_fence, F.col("_x"))).alias("upper_whisker"))
    return q.join(agg, ["segment", "metric"]).select(
        "segment", "metric", "min", "q1", "median", "q3", "max",
        "lower_whisker", "upper_whisker")


def segment_pref_category(segmented: DataFrame) -> DataFrame:
    return segmented.groupBy("segment", "favorite_category").agg(
        F.count(F.lit(1)).alias("customers"))


# Display names of the segment profile table.
PROFILE_RENAMES = {
    "pct_of_customers": "% of Customers", "pct_of_revenue": "% of Revenue",
    "avg_recency_days": "Avg Recency (days)", "avg_frequency": "Avg Orders",
    "avg_monetary": "Avg Lifetime Spend (₹)", "avg_order_value": "Avg Order Value (₹)",
    "top_category": "Top Category",
}
PROFILE_COLUMNS = ["segment", "customers", "pct_of_customers", "pct_of_revenue",
                   "avg_recency_days", "avg_frequency", "avg_monetary", "avg_order_value",
                   "top_category"]


def chosen(summary: DataFrame, segments: list[str] | None) -> DataFrame:
    """Membership filter: the rows of the given segments (all if None, none if the list is empty)."""
    return summary if segments is None else summary.where(F.col("segment").isin(segments))


def segment_profile(summary: DataFrame, segments: list[str] | None = None) -> DataFrame:
    """Display table: 9 columns, business names, largest mean spend first."""
    return (chosen(summary, segments).select(*PROFILE_COLUMNS).orderBy(F.desc("avg_monetary"), "segment")
             .withColumnsRenamed(PROFILE_RENAMES))


RADAR_METRICS = ["avg_recency_days", "avg_frequency", "avg_monetary", "avg_order_value",
                 "category_diversity"]


BAR_METRICS = ["avg_order_value", "discount_usage_rate", "return_rate", "category_diversity"]


def segment_bars(summary: DataFrame, segments: list[str] | None = None) -> DataFrame:
    """The four bar charts' values, long format (segment, metric, value)."""
    stack = ", ".join(f"'{m}', {m}" for m in BAR_METRICS)
    return chosen(summary, segments).selectExpr("segment", f"stack({len(BAR_METRICS)}, {stack}) AS (metric, value)")


def segment_radar(summary: DataFrame, segments: list[str] | None = None) -> DataFrame:
    """Min-max scaled summary metrics of the chosen segments, long format (segment, metric, norm)."""
    scaled = minmax_scale(chosen(summary, segments).select("segment", *RADAR_METRICS), RADAR_METRICS)
    stack = ", ".join(f"'{m}', {m}" for m in RADAR_METRICS)
    return scaled.selectExpr("segment", f"stack({len(RADAR_METRICS)}, {stack}) AS (metric, norm)")


def share_vs_customers(summary: DataFrame, segments: list[str] | None = None) -> DataFrame:
    return chosen(summary, segments).select("segment", "pct_of_customers", "pct_of_revenue", "avg_monetary",
                          (F.col("pct_of_revenue") > F.col("pct_of_customers")).alias("above_diagonal"))


def recency_spend_points(segmented: DataFrame) -> DataFrame:
    return segmented.select("customer_id", "customer_name", "segment", "recency_days",
                            "monetary", "frequency", "avg_order_value")


EXPLORER_COLUMNS = ["customer_id", "customer_name", "segment", "recency_days", "frequency",
                    "monetary", "avg_order_value", "favorite_category", "city"]


def customer_explorer(segmented: DataFrame, n: int = 200) -> DataFrame:
    """Top-n customers by spend (the limit is the feature); ties by id."""
    return segmented.select(*EXPLORER_COLUMNS).orderBy(F.desc("monetary"), "customer_id").limit(n)


def weekday_pattern(orders_valid: DataFrame, segmented: DataFrame,
                    keep_position: bool = False) -> DataFrame:
    """Order rows per weekday for the customers in the segmented table
    (left-semi join on customer id), Monday first, absent days kept as null.

    Rows are first counted per (customer, weekday), with a map-side partial
    step, so the semi-join shuffles at most 7 rows per customer and a customer
    with a huge share of the orders never lands whole in one task."""
    ids = segmented.select("customer_id").where(F.col("customer_id").isNotNull())
    per = orders_valid.groupBy("customer_id", weekday_name("order_date").alias("weekday")) \
                      .agg(F.count(F.lit(1)).alias("_n"))
    counts = per.join(ids, "customer_id", "left_semi").groupBy("weekday") \
                .agg(F.sum("_n").alias("orders"))
    cols = ["_pos", "weekday", "orders"] if keep_position else ["weekday", "orders"]
    return reindex(counts, "weekday", WEEKDAYS, keep_position=True).select(*cols)


def domain_values(orders_valid: DataFrame, segmented: DataFrame) -> DataFrame:
    """Sorted distinct categories and segments (the dashboard's selections)."""
    cats = orders_valid.where(F.col("category").isNotNull()).select(
        F.lit("category").alias("kind"), F.col("category").alias("value")).distinct()
    segs = segmented.where(F.col("segment").isNotNull()).select(
        F.lit("segment").alias("kind"), F.col("segment").alias("value")).distinct()
    return cats.unionByName(segs).orderBy("kind", "value")
