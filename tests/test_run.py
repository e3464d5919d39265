"""The command-line job writes every result; a replayed stream epoch does
not double count."""

import os
import tempfile

from pyspark.sql import functions as F

from basketry import run as job
from basketry.sources import published
from basketry.sources.tables import driver_tables
from basketry.streaming.trends import MonthlyTrendStream

SF = "/root/testdata/sf0.001"


def test_job_publishes_all_results(spark):
    out = tempfile.mkdtemp(prefix="basketry-job-")
    job.main(["--parquet", SF, "--out", out, "--n-init", "2", "--format", "csv"])
    run = published.latest(spark, out)
    assert {"customer_features", "customer_features_segmented", "segment_summary", "monthly_trend",
            "weekday_trend", "category_monthly_trend", "new_customers_trend", "quarterly_trend",
            "business_insights", "summary"} <= set(run.tables)
    assert published.MANIFEST in os.listdir(run.root.removeprefix("file:"))
    payload = spark.read.json(f"{run.root}/summary").first()
    assert set(payload.asDict()) == {"eda_summary", "elbow_data", "cluster_mapping", "insights"}
    assert payload.elbow_data.k == [2, 3, 4, 5, 6, 7, 8] and len(payload.insights) == 7
    assert len(payload.cluster_mapping.asDict()) == 5
    ins = spark.read.json(f"{run.root}/business_insights").orderBy("n").collect()
    assert [r.n for r in ins] == list(range(1, 8))
    seg = spark.read.option("header", True).csv(f"{run.root}/customer_features_segmented")
    assert seg.count() == spark.read.option("header", True).csv(f"{run.root}/customer_features").count()


def test_stream_epoch_replay_is_idempotent(spark):
    t = driver_tables(spark, SF)
    state = tempfile.mkdtemp(prefix="basketry-replay-")
    s = MonthlyTrendStream(spark, state, order=t.order_tiebreak)
    first = t.orders.where(F.col("ship_date") < "1996-01-01")
    rest = t.orders.where(F.col("ship_date") >= "1996-01-01")
    s.process(first, 0)
    s.process(rest, 1)
    once = sorted(s.monthly_trend().collect())
    s.process(rest, 1)        # replay after a failure
    assert sorted(s.monthly_trend().collect()) == once
