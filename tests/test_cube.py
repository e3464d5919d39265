"""Distinct counts from bitmaps, and the one-chain customer sums, against plain aggregates."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from basketry.operators import bitmaps as bm
from basketry.plans import features


@pytest.fixture
def stage(tmp_path, spark):
    def write(name, df):
        path = f"{tmp_path}/{name}-{len(list(tmp_path.iterdir()))}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    return write


@pytest.mark.parametrize("ids", [
    [1, 2, 3, 2, 1, 40_000, 32768, 32769, 65536], [-5, 0, 7, -40_000, 0, -5, 3, 3, 2], ["b", "a", "c", "a", "ü", "", "b", "zz", "a"],
    [10 ** 15, 5, 10 ** 12, 5, 7 * 10 ** 9, 10 ** 15, 1, 2, 3]])
def test_rolled_up_counts_are_distinct_counts(spark, stage, ids):
    rng = random.Random(1)
    rows = [(f"2020-{m:02d}", rng.choice(ids + [None])) for m in rng.choices(range(1, 13), k=300)] + [("2021-01", None)]
    df = spark.createDataFrame(rows, f"m string, id {'string' if isinstance(ids[0], str) else 'long'}").repartition(4)
    months = stage("months", bm.distinct_bitmaps(bm.id_numbers(df, "id", stage), ["m"]))
    want = {m: len({i for k, i in rows if k == m and i is not None}) for m in {k for k, _ in rows}}
    got = {r.m: r.n for r in bm.distinct_counts(months, ["m"], "n").collect()}
    assert got == {m: n for m, n in want.items() if n}
    total = bm.distinct_counts(bm.roll_up(months, [F.lit(0).alias("all")]), ["all"], "n").first().n
    assert total == len({i for _, i in rows if i is not None})
    first = {}
    for m, i in sorted(rows, key=lambda r: r[0]):
        if i is not None:
            first.setdefault(i, m)
    want = {m: sum(x == m for x in first.values()) for m in first.values()}
    assert {r.m: r.n for r in bm.first_seen(months, "m", "n").collect()} == want


def test_dense_numbers(spark, stage):
    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 1_000_003 % 4001).cast("string").alias("k")).unionAll(
        spark.createDataFrame([(None,)], "k string"))
    out = bm.dense_ids(df, "k", stage).collect()
    assert sorted(r.number for r in out) == list(range(1, 4002))
    assert [r.k for r in sorted(out, key=lambda r: r.number)] == sorted(r.k for r in out)


def test_no_rows(spark, stage):
    df = spark.createDataFrame([], "m string, id long")
    months = bm.distinct_bitmaps(bm.id_numbers(df, "id", stage), ["m"])
    assert months.count() == 0 and bm.first_seen(months, "m", "n").count() == 0


def test_customer_orders_are_the_separate_aggregates(spark):
    rng = random.Random(5)
    start = dt.datetime(2020, 1, 1)
    rows = []
    for i in range(600):
        when = None if rng.random() < 0.03 else start + dt.timedelta(days=rng.randint(0, 25), seconds=rng.choice([0, 0, 3600, 86399]))
        rows.append((i, rng.randint(1, 40) if i % 3 else 7, when, rng.choice(["a", "b", "ü", None]), rng.choice([None, 1, 2, 5]),
                     rng.choice([None, 0, 10, 30]), None if rng.random() < 0.1 else rng.randint(1, 9999) / 100, rng.random() < 0.3))
    o = spark.createDataFrame(rows, "order_id long, customer_id long, order_date timestamp_ntz, category string, quantity int, "
                                    "discount_pct int, _t double, is_returned boolean") \
        .withColumn("total_amount", F.col("_t").cast("decimal(18,4)")).repartition(5)
    got = {r.customer_id: r.asDict() for r in features.customer_orders(o).collect()}
    want = features.customer_aggregates(o).join(features.purchase_intervals(o), "customer_id", "left").collect()
    assert len(got) == len(want)
    for w in want:
        for c, v in w.asDict().items():
            assert got[w.customer_id][c] == v, (w.customer_id, c)
