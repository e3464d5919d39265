"""Write docs/PLANS.md: physical plans of key results in "scale mode".

Scale mode disables size-based auto-broadcast, so joins between tables that
grow with the data show the shape they take at 100 TB (sort-merge), while
explicit, bounded broadcasts (1-row scalars, k-row maps) stay.  AQE is off so
the static plan is printed.

    python tools/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from basketry.plans import clean, cube, features, segments, trends
    from basketry.plans.stages import AnalyticsRun
    from basketry.session import get_session
    from basketry.sources.tables import driver_tables
    spark = get_session("local[8]", 8)
    p = AnalyticsRun(spark, driver_tables(spark, sf))
    oc, cc, seg = p.orders_clean, p.customers_clean, p.fixed.segmented
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    items = [
        ("Keep-first dedup of orders (test-data adapter joins included)", clean.dedup_orders(p.t)),
        ("Monthly trend over the staged clean orders", trends.monthly_trend(oc)),
        ("Customer orders: one scan, sums dealt out by customer once", features.customer_orders(oc)),
        ("Customer feature table over the staged customer orders", features.customer_features(p.customer_orders, features.web_features(p.t.sessions), cc)),
        ("Calendar cube: one scan for the five trend tables", cube.grouped(oc, cube.SETS)),
        ("Purchase interval", features.purchase_intervals(oc)),
        ("Segment box statistics (exact quantiles per segment)", segments.segment_box_stats(seg)),
    ]
    out = ["# Physical plans in scale mode", "",
           "Generated by `tools/plan_report.py` (auto-broadcast off, AQE off). Staged",
           "intermediates appear as parquet scans of the checkpoint folder.", ""]
    for title, df in items:
        plan = df._jdf.queryExecution().executedPlan().treeString()
        lines = [ln.split(", [plan_id")[0][:160] for ln in plan.splitlines()]
        out += [f"## {title}", "", "```", *lines, "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)


if __name__ == "__main__":
    main()
