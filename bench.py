"""Benchmark: the headline results on $BENCH_SF_DIR (default sf0.1) with
local[$BENCH_CPUS] ($BENCH_SHUFFLE_PARTITIONS, default 2 x cpus).  Prints one JSON line.

The queries run in one session, the way the library is used.  The stages that
results share (raw, deduplicated and clean orders, clean customers, the
feature table) are built first and listed as entries of their own (``stage:..``), as is
the start of the session, so that a query's figure doesn't depend on which
query came before it.  ``headline_total`` is the sum: end-to-end wall time.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_orders", "monthly_trend", "weekday_trend", "category_monthly_trend",
    "new_customers_trend", "quarterly_trend", "eda_kpis", "eda_kpis_raw", "rfm_stats",
    "customer_features", "segment_summary", "segment_box_stats", "peak_facts", "growth",
    "demand_index", "amount_reconciliation", "kmeans_sweep", "kmeans_segment_summary",
]
STAGES = ["tables", "orders_dedup", "orders_clean", "customers_clean", "customer_orders", "features"]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    times = {}

    def timed(name, work):
        t0 = time.time()
        out = work()
        times[name] = round(time.time() - t0, 3)
        return out

    def start():
        from basketry.session import get_session
        spark = get_session(f"local[{cpus}]", int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", int(cpus) * 2 if cpus.isdigit() else 16)))
        spark.range(1000).groupBy().count().collect()
        return spark

    t_all = time.time()
    spark = timed("session", start)
    from basketry.plans.stages import run_for
    from basketry.registry import all_queries
    qs = all_queries()
    run = run_for(spark, sf_dir)
    if set(names) & set(HEADLINE):
        for s in STAGES:
            timed(f"stage:{s}", lambda s=s: getattr(run, s))
    for n in names:
        timed(n, lambda n=n: qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save())
    total = round(time.time() - t_all, 3)
    run.close()
    sf = os.path.basename(sf_dir).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec",
                      "queries": times, "sf": sf}))


if __name__ == "__main__":
    main()
