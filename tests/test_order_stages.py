"""What the stages of the orders write, and gaps from the daily sums."""

import datetime as dt
import random
import time
from collections import Counter
from decimal import Decimal

from pyspark.sql import functions as F

from basketry import queries
from basketry.plans import clean, features, stages
from basketry.plans.stages import AnalyticsRun
from basketry.sources.tables import driver_tables

SF = "/root/testdata/sf0.001"
DDL = ("order_id long, customer_id long, order_date timestamp_ntz, category string, total_amount decimal(18,4), "
       "quantity int, discount_pct int, is_returned boolean")


def orders(spark):
    rng = random.Random(3)
    return spark.createDataFrame(
        [(i, rng.randint(1, 20), dt.datetime(2023, 1, 1) + dt.timedelta(days=rng.randint(0, 40), seconds=rng.randint(0, 86399)),
          rng.choice(["a", "b", None]), Decimal(rng.randint(1, 999)), rng.randint(1, 4), rng.choice([0, 5]), False) for i in range(600)], DDL)


def test_joined_orders_are_not_written(spark):
    p = AnalyticsRun(spark, driver_tables(spark, SF))
    written = []
    stage = p.stage
    p.stage = lambda name, *a, **kw: written.append(name) or stage(name, *a, **kw)
    try:
        _ = p.features, p.cube
        assert [n for n in written if n.startswith("orders")] == ["orders_dedup", "orders_clean"]
    finally:
        p.close()


def test_text_orders_are_parsed_once(spark):
    t = driver_tables(spark, SF)
    t.columnar = False
    p = AnalyticsRun(spark, t)
    written = []
    stage = p.stage
    p.stage = lambda name, *a, **kw: written.append(name) or stage(name, *a, **kw)
    try:
        _ = p.orders_clean, p.orders_valid
        assert [n for n in written if n.startswith("orders")] == ["orders_raw", "orders_dedup", "orders_clean"]
    finally:
        p.close()


def test_growth_does_not_write_joined_orders(spark):
    p = AnalyticsRun(spark, driver_tables(spark, SF))
    written = []
    stage = p.stage
    p.stage = lambda name, *a, **kw: written.append(name) or stage(name, *a, **kw)
    try:
        got = queries.q_growth(p).collect()
        assert sorted(written) == ["dashboard_series", "orders_clean", "orders_dedup"]
        _ = p.orders_valid
        del p.__dict__["dashboard_series"]
        assert sorted(queries.q_growth(p).collect()) == sorted(got)
    finally:
        p.close()


def test_dedup_in_passes_gives_the_rows_and_figures_of_one_job(spark, monkeypatch):
    t = driver_tables(spark, SF)
    # rows without an id, equal in all that orders them
    lost = t.orders.limit(3).withColumn("order_id", F.lit(None).cast("long"))
    t.orders = t.orders.unionByName(lost).unionByName(lost)
    want = Counter(map(tuple, clean.dedup_orders(t).collect()))
    one, many = AnalyticsRun(spark, t), AnalyticsRun(spark, t)
    try:
        _ = one.orders_dedup
        monkeypatch.setattr(stages, "PASS_BYTES", 1000)
        assert len(stages.passes(t.orders, "order_id")) == stages.PASSES > 1
        assert Counter(map(tuple, many.orders_dedup.collect())) == want
        assert many.metrics["orders_dedup"] == one.metrics["orders_dedup"]
        assert many.metrics["orders_dedup"]["rows_loaded"] == t.orders.count()
    finally:
        one.close()
        many.close()


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_stage_leaves_no_shuffle_files(spark):
    p = AnalyticsRun(spark, driver_tables(spark, SF))
    try:
        df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
        before = shuffle_files(spark)
        staged = p.stage("counts", df)
        until = time.time() + 20
        while (left := shuffle_files(spark) - before) and time.time() < until:
            time.sleep(0.2)
        assert not left and spark.conf.get(stages._CLEANUP) == "false"
        # the frame itself and what reads the stage still work
        assert Counter(staged.collect()) == Counter(df.collect())
    finally:
        p.close()


def test_gaps_of_times_of_day(spark):
    df = orders(spark)
    want = {r.customer_id: r.avg_purchase_interval_days for r in features.purchase_intervals(df).collect()}
    assert want == {r.customer_id: r.avg_purchase_interval_days for r in features.customer_orders(df).collect()}
