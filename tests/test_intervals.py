"""Interval join against all pairs."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketry.operators import intervals as iv

T0 = dt.datetime(2020, 1, 1)


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def brute(rows, intervals):
    out = []
    for i, t in rows:
        fit = [(-v, n) for a, b, v, n in intervals if None not in (t, a, b, v) and a <= t < b]
        best = min(fit) if fit else None
        out.append((i, -best[0] if best else None, best[1] if best else None))
    return sorted(out, key=repr)


def joined(spark, rows, intervals):
    r = spark.createDataFrame(rows, "id long, t timestamp_ntz").withColumn("boost", F.lit("clash")).repartition(4)
    w = spark.createDataFrame(intervals, "start timestamp_ntz, end timestamp_ntz, boost double, name string")
    out = iv.best_interval(r, "t", w, "boost", "name")
    assert out.columns == ["id", "t", "boost", "name"]
    return sorted([(x.id, x.boost, x.name) for x in out.collect()], key=repr)


@pytest.mark.parametrize("n,longest", [(0, 1), (1, 5), (40, 30), (400, 20), (400, 3000), (900, 200)])
def test_against_all_pairs(spark, n, longest):
    rng = random.Random(n + longest)
    intervals = []
    for k in range(n):
        a = rng.randint(0, 3000)
        intervals.append((at(a), at(a + rng.randint(0, longest)), rng.choice([1.0, 1.5, 2.0, rng.random() * 3]), f"w{k % 50}"))
    intervals += [(at(9), at(3), 9.0, "backwards"), (None, at(3), 9.0, "x"), (at(0), None, 9.0, "y"), (at(0), at(9), None, "z")]
    rows = [(i, rng.choice([None, at(rng.randint(-50, 6100)), at(rng.random() * 3000)])) for i in range(400)]
    # one time that holds a third of the rows
    rows += [(1000 + i, at(1234)) for i in range(200)] + [(5, at(77)), (5, at(77))]
    assert joined(spark, rows, intervals) == brute(rows, intervals)


def test_no_rows(spark):
    assert joined(spark, [], [(at(0), at(1), 1.0, "a")]) == []


def test_a_long_interval_costs_few_rows():
    blocks = iv._whole_bins([(3, 1, (2.0, "a")), (3, 5, (2.0, "a")), (0, 4, (3.0, "b")), (1, 7, (2.0, "A"))], 100)
    assert blocks == {**{b: (2.0, "a") for b in range(1, 13)}, 4: (3.0, "b"), 7: (2.0, "A"), 8: (2.0, "A")}


def test_sweep_gives_disjoint_segments():
    p = pd.DataFrame([(0, 10, 1.0, "a"), (2, 4, 3.0, "b"), (3, 12, 2.0, "c"), (20, 21, 1.0, "d")], columns=["a", "b", "value", "label"])
    assert iv.sweep(p) == [(0, 1.0, "a"), (2, 3.0, "b"), (4, 2.0, "c"), (12, None, None), (20, 1.0, "d"), (21, None, None)]


def test_rows_of_a_hot_time_are_dealt_over_copies(spark):
    rows = spark.range(9000).select(F.lit(at(5)).cast("timestamp_ntz").alias("t"))
    w = spark.createDataFrame([(at(0), at(9), 1.0, "a")], "start timestamp_ntz, end timestamp_ntz, boost double, name string")
    text = iv.best_interval(rows, "t", w, "boost", "name")._jdf.queryExecution().optimizedPlan().toString()
    assert "_copy" in text
