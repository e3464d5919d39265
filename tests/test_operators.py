"""Custom operators against brute force (numpy / plain Python)."""

import datetime as dt
import random

import numpy as np
import pytest

from basketry.operators.quantile import exact_quantiles, fill_with_median
from basketry.plans import calendar


@pytest.mark.parametrize("wide", [False, True])
def test_exact_quantiles_match_numpy_with_hot_group(spark, wide):
    random.seed(3)
    rows = []
    for g, n in [("hot", 3000), ("a", 7), ("b", 1), ("c", 2)]:
        for _ in range(n):
            rows.append((g, float(random.choice([1, 2, 2, 3, 5, 8, 8, 8]) if g == "hot" else random.random())))
    rows += [("a", None), ("d", None), (None, 4.0), (None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    probs = [0.25, 0.5, 0.75, 0.1]
    got = {r.g: r for r in exact_quantiles(df, "v", probs, ["q1", "q2", "q3", "q4"], by=["g"],
                                           wide=wide).collect()}
    for g in ["hot", "a", "b", "c"]:
        xs = np.array([v for k, v in rows if k == g and v is not None])
        for name, p in zip(["q1", "q2", "q3", "q4"], probs):
            assert getattr(got[g], name) == pytest.approx(float(np.quantile(xs, p)), rel=1e-12), (g, p)
    assert "d" not in got   # no values -> no row
    assert got[None].q2 == 2.5   # a null group is a group


def test_global_median_and_fill(spark):
    df = spark.createDataFrame([(1.0,), (None,), (4.0,), (2.0,), (None,)], "x double")
    out = [r.x for r in fill_with_median(df, "x").collect()]
    assert sorted(out) == [1.0, 2.0, 2.0, 2.0, 4.0]
    empty = spark.createDataFrame([(None,)], "x double")
    assert fill_with_median(empty, "x").first().x is None


def test_seasonal_multiplier_matches_python_rule(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(366)]
    df = spark.createDataFrame([(d,) for d in days], "d date")

    def rule(d):
        m = 1.0
        for (m1, d1), (m2, d2), b, _ in calendar.SEASONAL_WINDOWS:
            if dt.date(d.year, m1, d1) <= d <= dt.date(d.year, m2, d2):
                m = max(m, b)
        return m

    got = {r.d: r.m for r in df.select("d", calendar.seasonal_multiplier("d").alias("m")).collect()}
    assert all(got[d] == rule(d) for d in days)
    joined = {r.d: r.multiplier for r in
              calendar.tag_with_windows(df, "d", calendar.windows_frame(spark)).collect()}
    assert joined == got
