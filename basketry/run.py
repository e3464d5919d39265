"""Run the whole analytics job and write its results.

    python -m basketry.run --csv DATA_DIR --out OUT_DIR          # canonical CSV exports
    python -m basketry.run --parquet SF_DIR --out OUT_DIR        # driver test tables

    python -m basketry.run --from OUT_DIR --dashboard            # serve the newest complete run

Publishes a version (``sources/published``): customer_features, customer_features_segmented,
segment_summary, monthly_trend, weekday_trend, category_monthly_trend,
new_customers_trend, quarterly_trend (CSV with header, or parquet), plus
business_insights and summary payloads as JSON, and with ``--dashboard`` the
dashboard's derived tables.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from basketry.plans import cube, eda, insights, segments, summary, trends
from basketry.plans.stages import AnalyticsRun
from basketry.sources import published
from basketry.sources.tables import driver_tables, read_csv_tables


def results(p: AnalyticsRun) -> dict[str, DataFrame]:
    seg = p.kmeans
    oc = p.orders_clean
    ins = insights.insights(seg.summary, p.revenue_by_category, p.monthly, p.kpis)
    payload = summary.summary_payload(
        p.kpis, p.revenue_by_category, eda.value_counts(oc, "payment_method"),
        eda.value_counts(oc, "weekday"), eda.rfm_stats(p.features),
        p.segmentation.sweep(), seg.mapping, ins)
    return {
        "customer_features": p.features,
        "customer_features_segmented": seg.segmented,
        "segment_summary": seg.summary,
        # one scan of the clean orders for the five trend tables
        "monthly_trend": cube.monthly_trend(p.cube, p.customer_bitmaps),
        "weekday_trend": cube.weekday_trend(p.cube),
        "category_monthly_trend": cube.category_monthly_trend(p.cube),
        "new_customers_trend": cube.new_customers_trend(p.customer_bitmaps),
        "quarterly_trend": cube.quarterly_trend(p.cube),
        "business_insights": ins,
        "summary": payload,
    }


def segment_tables(segmented: DataFrame, summary: DataFrame, chosen: list[str] | None = None) -> dict[str, DataFrame]:
    """The dashboard's tables that need the segments alone; ``chosen`` names the segments shown where the
    dashboard lets the user choose."""
    return {
        "segment_sizes": segments.segment_sizes(segmented),
        "segment_profile": segments.segment_profile(summary, chosen),
        "segment_bars": segments.segment_bars(summary, chosen),
        "segment_box_stats": segments.segment_box_stats(segmented),
        "segment_leaders": segments.segment_leaders(segmented, summary),
        "segment_pref_category": segments.segment_pref_category(segmented),
        "segment_radar": segments.segment_radar(summary, chosen),
        "share_vs_customers": segments.share_vs_customers(summary, chosen),
        "customer_explorer": segments.customer_explorer(segmented),
        "recency_spend_points": segments.recency_spend_points(segmented),
    }


def dashboard(p: AnalyticsRun) -> dict[str, DataFrame]:
    seg = p.kmeans
    ov = p.orders_valid
    dm = trends.dashboard_monthly_trend(ov)
    nc = trends.new_customers_trend(p.orders_clean)
    growth = (insights.growth(dm, "Revenue", "year_month", "revenue")
              .unionByName(insights.growth(dm, "Order volume", "year_month", "orders"))
              .unionByName(insights.growth(nc, "New customer acquisition", "year_month", "new_customers")))
    return {
        "kpis": eda.kpis_raw(ov),
        "monthly": dm,
        "weekday_revenue": trends.dashboard_weekday_revenue(ov),
        "category_trend": trends.dashboard_category_trend(ov),
        "growth": growth,
        "growth_statements": insights.growth_statements(growth),
        "weekday_pattern": segments.weekday_pattern(ov, seg.segmented),
        **segment_tables(seg.segmented, seg.summary),
    }


def served(spark: SparkSession, out_dir: str, chosen: list[str] | None = None) -> dict[str, DataFrame]:
    """Dashboard tables of the newest complete run in ``out_dir``, read back instead of computed.  The tables made from
    segments alone are derived from the published segments, so a choice of segments needs no new run; the others are
    there if the run was made with ``--dashboard``."""
    run = published.latest(spark, out_dir)
    out = {n.removeprefix("dashboard_"): run.table(n) for n in run.tables if n.startswith("dashboard_")}
    # results that the dashboard shows as they are
    out |= {n: run.table(n) for n in ("monthly_trend", "weekday_trend", "category_monthly_trend", "new_customers_trend", "quarterly_trend",
                                      "business_insights", "summary")}
    return out | segment_tables(run.table("customer_features_segmented"), run.table("segment_summary"), chosen)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--csv", help="folder with customers.csv, products.csv, orders.csv, website_sessions.csv")
    src.add_argument("--parquet", help="driver test-data folder (sf*)")
    src.add_argument("--from", dest="published", metavar="OUT_DIR", help="serve the newest complete run in OUT_DIR, compute nothing anew")
    ap.add_argument("--out", help="folder for the new version (with --from: for the dashboard tables; without it they are shown)")
    ap.add_argument("--format", choices=["csv", "parquet"], default="csv")
    ap.add_argument("--n-init", type=int, default=10)
    ap.add_argument("--kmeans-engine", choices=["batched", "ml"], default="batched",
                    help="batched: all (k, seed) runs share each pass; ml: pyspark.ml KMeans per run")
    ap.add_argument("--dashboard", action="store_true")
    ap.add_argument("--segments", nargs="+", help="with --from: segments to show")
    a = ap.parse_args(argv)
    if not a.published and not a.out:
        ap.error("--out is needed")
    spark = SparkSession.builder.getOrCreate()
    from basketry.session import REQUIRED_CONF
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    json_names = ("business_insights", "summary")
    if a.published:
        out = served(spark, a.published, a.segments)
        if a.out:
            print(published.publish(spark, out, a.out, a.format, json_names))
        else:
            for name, df in out.items():
                print(name)
                df.show(20, truncate=False)
        return
    tables = read_csv_tables(spark, a.csv) if a.csv else driver_tables(spark, a.parquet)
    p = AnalyticsRun(spark, tables)
    p.n_init = a.n_init
    p.kmeans_engine = a.kmeans_engine
    out = results(p)
    if a.dashboard:
        out.update({f"dashboard_{k}": v for k, v in dashboard(p).items()})
    print(published.publish(spark, out, a.out, a.format, json_names))
    p.close()


if __name__ == "__main__":
    main()
