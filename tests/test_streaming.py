"""The streamed monthly trend equals the batch one on the same rows."""

import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from basketry.plans import trends
from basketry.plans.stages import AnalyticsRun
from basketry.sources.tables import driver_tables
from basketry.streaming.trends import MonthlyTrendStream

SF = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark):
    t = driver_tables(spark, SF)
    d = tempfile.mkdtemp(prefix="basketry-stream-src-")
    state = tempfile.mkdtemp(prefix="basketry-stream-state-")
    # files arrive in dedup order (ship date first), three batches
    o = t.orders.withColumn("_b", F.ntile(3).over(Window.orderBy(*t.order_tiebreak)))
    for b in (1, 2, 3):
        o.where(F.col("_b") == b).drop("_b").coalesce(1).write.mode("append").parquet(d)
    schema = t.orders.schema
    s = MonthlyTrendStream(spark, state, order=t.order_tiebreak)
    q = s.start(d, schema, files_per_batch=1)
    q.awaitTermination(300)
    got = sorted(s.monthly_trend().collect())
    want = sorted(trends.monthly_trend(AnalyticsRun(spark, t, materialize=False).orders_clean).collect())
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a.year_month == b.year_month and a.orders == b.orders and a.customers == b.customers
        assert abs(a.revenue - b.revenue) < 1e-6 and abs(a.avg_order_value - b.avg_order_value) < 1e-6
