"""Query definitions (Spark side) registered by name.

Each function receives the shared ``AnalyticsRun`` of its (session, data folder),
so cleaned orders and the feature table are built once per session.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from basketry.plans import calendar, checks, clean, cube, eda, features, insights, kmeans, segments, summary, trends
from basketry.plans.stages import AnalyticsRun
from basketry.registry import query


def decimals_as_double(df):
    """Result view for exchange: decimal money columns as doubles (exact
    decimal values, correctly rounded), so every consumer reads plain floats.
    The staged tables keep decimals for exact sums."""
    return df.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c)
                       for c, t in df.dtypes])


@query("clean_orders")
def q_clean_orders(p: AnalyticsRun):
    return decimals_as_double(p.orders_clean)


@query("clean_customers")
def q_clean_customers(p: AnalyticsRun):
    return p.customers_clean


@query("monthly_trend")
def q_monthly_trend(p: AnalyticsRun):
    return trends.monthly_trend(p.orders_clean)


@query("rfm")
def q_rfm(p: AnalyticsRun):
    return features.rfm(p.orders_clean)


@query("behavior")
def q_behavior(p: AnalyticsRun):
    return features.behavior(p.orders_clean)


@query("purchase_intervals")
def q_purchase_intervals(p: AnalyticsRun):
    return features.purchase_intervals(p.orders_clean)


@query("web_features")
def q_web_features(p: AnalyticsRun):
    return features.web_features(p.t.sessions)


@query("customer_features")
def q_customer_features(p: AnalyticsRun):
    return p.features


@query("weekday_trend")
def q_weekday_trend(p: AnalyticsRun):
    return trends.weekday_trend(p.orders_clean)


@query("category_monthly_trend")
def q_category_monthly_trend(p: AnalyticsRun):
    return trends.category_monthly_trend(p.orders_clean)


@query("new_customers_trend")
def q_new_customers_trend(p: AnalyticsRun):
    return trends.new_customers_trend(p.orders_clean)


@query("quarterly_trend")
def q_quarterly_trend(p: AnalyticsRun):
    return trends.quarterly_trend(p.orders_clean)


@query("calendar_cube")
def q_calendar_cube(p: AnalyticsRun):
    """The five trend tables from one scan of the clean orders."""
    return cube.trend_rows(p.cube, p.customer_bitmaps)


@query("distinct_rollup")
def q_distinct_rollup(p: AnalyticsRun):
    """Distinct customers by month, quarter, year and in total, rolled up from the months' bitmaps."""
    return cube.periods(p.customer_bitmaps, "customers")


@query("distinct_rollup_raw")
def q_distinct_rollup_raw(p: AnalyticsRun):
    """The same over the dashboard's raw rows, for customers and for order ids (which have gaps)."""
    return cube.periods(p.raw_bitmaps["customer"], "customers") \
        .join(cube.periods(p.raw_bitmaps["order"], "orders"), ["grain", "period"], "full_outer") \
        .select("grain", "period", "customers", "orders")


@query("dashboard_monthly_trend")
def q_dashboard_monthly_trend(p: AnalyticsRun):
    return trends.dashboard_monthly_trend(p.orders_valid)


@query("dashboard_weekday_revenue")
def q_dashboard_weekday_revenue(p: AnalyticsRun):
    return trends.dashboard_weekday_revenue(p.orders_valid)


@query("time_features")
def q_time_features(p: AnalyticsRun):
    return p.orders_clean.select("order_id", "order_date", "year", "month", "month_name",
                                 "year_month", "week", "weekday", "quarter")


@query("eda_kpis")
def q_eda_kpis(p: AnalyticsRun):
    return eda.kpis(p.orders_clean)


@query("eda_kpis_raw")
def q_eda_kpis_raw(p: AnalyticsRun):
    return eda.kpis_raw(p.orders_valid)


@query("revenue_by_category")
def q_revenue_by_category(p: AnalyticsRun):
    return eda.revenue_by_category(p.orders_clean)


@query("orders_by_payment")
def q_orders_by_payment(p: AnalyticsRun):
    return eda.value_counts(p.orders_clean, "payment_method")


@query("orders_by_weekday")
def q_orders_by_weekday(p: AnalyticsRun):
    return eda.value_counts(p.orders_clean, "weekday")


@query("rfm_stats")
def q_rfm_stats(p: AnalyticsRun):
    return eda.rfm_stats(p.features)


@query("cleaning_audit")
def q_cleaning_audit(p: AnalyticsRun):
    return p.cleaning_audit()


@query("load_report")
def q_load_report(p: AnalyticsRun):
    return p.load_report()


@query("null_status_filter")
def q_null_status_filter(p: AnalyticsRun):
    """Status made missing for every 7th order id: such rows are neither
    cancelled nor returned and stay in the revenue-facing table."""
    o = p.orders_dedup.withColumn(
        "order_status", F.when(F.col("order_id") % 7 != 0, F.col("order_status")))
    kept = clean.flag_orders(o).where(~F.col("is_cancelled"))
    return kept.select("order_id", "order_status", "is_cancelled", "is_returned")


# -- segments on the fixed cluster column (SQL-checkable) --------------------

@query("cluster_profile")
def q_cluster_profile(p: AnalyticsRun):
    return p.fixed.profile


@query("label_clusters")
def q_label_clusters(p: AnalyticsRun):
    return segments.cluster_sizes(p.fixed.segmented)


@query("segmented_features")
def q_segmented_features(p: AnalyticsRun):
    return p.fixed.segmented


@query("segment_summary")
def q_segment_summary(p: AnalyticsRun):
    return p.fixed.summary


@query("segment_sizes")
def q_segment_sizes(p: AnalyticsRun):
    return segments.segment_sizes(p.fixed.segmented)


@query("segment_leaders")
def q_segment_leaders(p: AnalyticsRun):
    return segments.segment_leaders(p.fixed.segmented, p.fixed.summary)


@query("segment_box_stats")
def q_segment_box_stats(p: AnalyticsRun):
    return segments.segment_box_stats(p.fixed.segmented)


@query("segment_pref_category")
def q_segment_pref_category(p: AnalyticsRun):
    return segments.segment_pref_category(p.fixed.segmented)


@query("segment_profile")
def q_segment_profile(p: AnalyticsRun):
    return segments.segment_profile(p.fixed.summary)


@query("segment_radar")
def q_segment_radar(p: AnalyticsRun):
    return segments.segment_radar(p.fixed.summary)


@query("share_vs_customers")
def q_share_vs_customers(p: AnalyticsRun):
    return segments.share_vs_customers(p.fixed.summary)


@query("segment_selection")
def q_segment_selection(p: AnalyticsRun):
    """What the dashboard shows of two chosen segments and a name that no cluster has: profile, four bar
    charts, radar, shares, as rows (result, segment, metric, value)."""
    pick = [segments.HIGH_VALUE, segments.AT_RISK, "No Such Segment"]
    s = p.fixed.summary
    rows = lambda df, name, cols: df.selectExpr(
        f"'{name}' AS result", "segment", "stack({}, {}) AS (metric, value)".format(len(cols), ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in cols)))
    profile = segments.segment_profile(s, pick)
    return (rows(profile, "profile", [c for c, t in profile.dtypes if t != "string"])
            .unionByName(segments.segment_bars(s, pick).select(F.lit("bars").alias("result"), "segment", "metric", "value"))
            .unionByName(segments.segment_radar(s, pick).select(F.lit("radar").alias("result"), "segment", "metric", F.col("norm").alias("value")))
            .unionByName(rows(segments.share_vs_customers(s, pick), "shares", ["pct_of_customers", "pct_of_revenue", "avg_monetary", "above_diagonal"])))


@query("recency_spend_points")
def q_recency_spend_points(p: AnalyticsRun):
    return segments.recency_spend_points(p.fixed.segmented)


@query("weekday_pattern")
def q_weekday_pattern(p: AnalyticsRun):
    return segments.weekday_pattern(p.orders_valid, p.fixed.segmented)


@query("customer_explorer")
def q_customer_explorer(p: AnalyticsRun):
    return segments.customer_explorer(p.fixed.segmented)


@query("domain_values")
def q_domain_values(p: AnalyticsRun):
    return segments.domain_values(p.orders_valid, p.fixed.segmented)


# -- facts, growth, insights ------------------------------------------------

@query("peak_facts")
def q_peak_facts(p: AnalyticsRun):
    seg = p.fixed.segmented
    return insights.peak_facts(
        p.monthly, p.revenue_by_category, trends.quarterly_trend(p.orders_clean),
        trends.dashboard_weekday_revenue(p.orders_valid, keep_position=True),
        trends.category_totals(p.orders_valid),
        segments.segment_sizes(seg), segments.segment_pref_category(seg),
        segments.weekday_pattern(p.orders_valid, seg, keep_position=True))


def _growth_rows(p: AnalyticsRun):
    dm = p.dashboard_series
    nc = trends.new_customers_trend(p.orders_clean)
    return (insights.growth(dm, "Revenue", "year_month", "revenue")
            .unionByName(insights.growth(dm, "Order volume", "year_month", "orders"))
            .unionByName(insights.growth(nc, "New customer acquisition", "year_month", "new_customers")))


@query("growth")
def q_growth(p: AnalyticsRun):
    return _growth_rows(p)


@query("growth_statements")
def q_growth_statements(p: AnalyticsRun):
    return insights.growth_statements(_growth_rows(p))


@query("insights")
def q_insights(p: AnalyticsRun):
    return insights.insights(p.fixed.summary, p.revenue_by_category, p.monthly, p.kpis)


# -- KMeans segmentation ------------------------------------------------------

@query("feature_scaling")
def q_feature_scaling(p: AnalyticsRun):
    """The standardised features that the clustering uses, to 6 decimals (``log1p``
    differs in its last bits between math libraries)."""
    scaled = kmeans.with_scaled(p.features)
    return scaled.select("customer_id", *[F.round(f"z_{c}", 6).alias(c) for c in kmeans.CLUSTER_FEATURES])


@query("kmeans_fixed_labels")
def q_kmeans_fixed_labels(p: AnalyticsRun):
    """Nearest of five documented centres, through the production assignment."""
    return kmeans.assign(kmeans.with_scaled(p.features), kmeans.fixed_centers(5)).select("customer_id", "cluster")


@query("kmeans_fixed_metrics")
def q_kmeans_fixed_metrics(p: AnalyticsRun):
    """Inertia and squared-distance silhouette of documented centres per k, with the
    digits of the elbow table."""
    scaled = kmeans.with_scaled(p.features)
    rows = [kmeans.elbow_row(k, kmeans.inertia(scaled, c), kmeans.squared_silhouette(scaled, c))
            for k, c in ((k, kmeans.fixed_centers(k)) for k in (2, 3, 5))]
    return p.spark.createDataFrame(rows, "k int, inertia double, squared_silhouette double")


@query("kmeans_lloyd_step")
def q_kmeans_lloyd_step(p: AnalyticsRun):
    """Centres after one Lloyd step from documented centres, through the production
    step, to 6 decimals."""
    return _step_from(p, [kmeans.fixed_centers(k) for k in (2, 5)])


def _step_from(p: AnalyticsRun, starts: list):
    from basketry.operators import multikmeans as mk
    dims = len(kmeans.CLUSTER_FEATURES)
    points = mk.prepare(kmeans.with_scaled(p.features), "customer_id", kmeans.Z_FEATURES)
    runs = [mk.Run(k=len(c), seed=0, centers=c) for c in starts]
    mk.lloyd_step(points, runs, list(range(len(runs))))
    rows = [(r.k, j, *c) for r in runs for j, c in enumerate(r.centers)]
    names = [f"x{d}" for d in range(dims)]
    df = p.spark.createDataFrame(rows, "k int, cluster int, " + ", ".join(f"{x} double" for x in names))
    return df.select("k", "cluster", *[F.round(x, 6).alias(x) for x in names])


@query("kmeans_relocation_step")
def q_kmeans_relocation_step(p: AnalyticsRun):
    """Centres after one Lloyd step in which one (k = 3) and two (k = 5) of the documented centres,
    put out of reach, lose all points and are moved to the farthest customers, to 6 decimals."""
    away = [[100.0 + j] * len(kmeans.CLUSTER_FEATURES) for j in range(2)]
    return _step_from(p, [kmeans.fixed_centers(2) + away[:1], away[:1] + kmeans.fixed_centers(3) + away[1:]])


@query("kmeans_fixed_silhouette")
def q_kmeans_fixed_silhouette(p: AnalyticsRun):
    """Euclidean silhouette of the documented centres' clusters per k, with the digits of the elbow
    table, from all pairs (``tolerance=0``)."""
    scores = kmeans.silhouettes(kmeans.with_scaled(p.features), {k: kmeans.fixed_centers(k) for k in (2, 3, 5)}, tolerance=0.0)
    return p.spark.createDataFrame([(k, s.points, round(s.silhouette, 4)) for k, s in scores.items()],
                                   "k int, customers long, euclidean_silhouette double")


@query("kmeans_documented_fit")
def q_kmeans_documented_fit(p: AnalyticsRun):
    """Customers with cluster and segment after four Lloyd steps from five documented centres: the
    production fit, numbering and naming, from a start that SQL can follow."""
    return p.documented.segmented.select("customer_id", "cluster", "segment")


@query("kmeans_documented_summary")
def q_kmeans_documented_summary(p: AnalyticsRun):
    """Segment summary of ``kmeans_documented_fit``."""
    return p.documented.summary


@query("label_clusters_runner_up")
def q_label_clusters_runner_up(p: AnalyticsRun):
    """Cluster names where a name whose cluster is taken goes to the runner-up."""
    mapping = segments.label_clusters(p.fixed.profile, resolve="runner_up")
    return segments.cluster_sizes(segments.assign_segments(p.fixed.clustered, mapping))


@query("kmeans_sweep")
def q_kmeans_sweep(p: AnalyticsRun):
    return p.segmentation.sweep()


@query("kmeans_segments")
def q_kmeans_segments(p: AnalyticsRun):
    return segments.cluster_sizes(p.kmeans.segmented)


@query("kmeans_segment_summary")
def q_kmeans_segment_summary(p: AnalyticsRun):
    return p.kmeans.summary


@query("summary_payload")
def q_summary_payload(p: AnalyticsRun):
    ins = insights.insights(p.kmeans.summary, p.revenue_by_category, p.monthly, p.kpis)
    return summary.summary_payload(
        p.kpis, p.revenue_by_category,
        eda.value_counts(p.orders_clean, "payment_method"),
        eda.value_counts(p.orders_clean, "weekday"),
        eda.rfm_stats(p.features),
        p.segmentation.sweep(), p.kmeans.mapping, ins)


@query("summary_payload_values")
def q_summary_payload_values(p: AnalyticsRun):
    """The payload, value by value, with the clusters ``customer_id % 5`` and the elbow table of the documented centres."""
    scaled = kmeans.with_scaled(p.features)
    centers = {k: kmeans.fixed_centers(k) for k in (2, 3, 5)}
    scores = kmeans.silhouettes(scaled, centers, tolerance=0.0)
    elbow = p.spark.createDataFrame([kmeans.elbow_row(k, kmeans.inertia(scaled, c), scores[k].silhouette) for k, c in centers.items()],
                                    "k int, inertia double, euclidean_silhouette double")
    ins = insights.insights(p.fixed.summary, p.revenue_by_category, p.monthly, p.kpis)
    return summary.payload_rows(summary.summary_payload(
        p.kpis, p.revenue_by_category, eda.value_counts(p.orders_clean, "payment_method"),
        eda.value_counts(p.orders_clean, "weekday"), eda.rfm_stats(p.features), elbow, p.fixed.mapping, ins))


# -- calendar windows, reconciliation, append + dedup -------------------------

@query("seasonal_tags")
def q_seasonal_tags(p: AnalyticsRun):
    return calendar.seasonal_tags(p.orders_clean)


@query("demand_index")
def q_demand_index(p: AnalyticsRun):
    return calendar.demand_index(p.orders_clean)


@query("seasonal_range_join")
def q_seasonal_range_join(p: AnalyticsRun):
    """Every clean order row with the boost of its window, by range join."""
    rows = p.orders_clean.select("order_id", "order_date")
    return calendar.tag_with_windows(rows, "order_date", calendar.windows_frame(p.spark))


@query("amount_reconciliation")
def q_amount_reconciliation(p: AnalyticsRun):
    return checks.amount_reconciliation(p.orders_dedup)


@query("append_dedup")
def q_append_dedup(p: AnalyticsRun):
    from basketry.sources.schemas import ORDER_COLUMNS
    o = p.t.orders
    return decimals_as_double(checks.append_dedup(
        o, o.where(F.col("order_id") % 3 == 0), p.t.order_tiebreak).select(*ORDER_COLUMNS))
