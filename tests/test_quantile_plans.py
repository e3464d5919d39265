"""Quantiles don't depend on how the plan is run."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from basketry.operators.quantile import exact_quantiles

N = 2_000_000


@pytest.fixture(scope="module")
def wide_values(spark):
    df = spark.range(N, numPartitions=8).select(((F.xxhash64("id") % 100_000_007) / 1000.0).alias("x"), (F.col("id") % 3).alias("g"))
    return df, df.select("g", "x").toPandas()


@pytest.mark.parametrize("reuse", ["true", "false"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_wide_domain_equals_numpy(spark, wide_values, reuse, adaptive):
    df, pdf = wide_values
    old = {k: spark.conf.get(k) for k in ("spark.sql.exchange.reuse", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
        row = exact_quantiles(df, "x", [0.1, 0.5, 0.75], ["a", "b", "c"], wide=True).first()
        assert [row.a, row.b, row.c] == pytest.approx(list(np.quantile(pdf.x, [0.1, 0.5, 0.75])), rel=1e-12)
        per = {r.g: r.m for r in exact_quantiles(df, "x", [0.5], ["m"], by=["g"], wide=True).collect()}
        assert per == pytest.approx(pdf.groupby("g").x.median().to_dict(), rel=1e-12)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("wide", [False, True])
def test_small_and_empty(spark, wide):
    df = spark.createDataFrame([(None, 1.0), (None, 4.0), ("a", 2.0), ("a", None), ("b", None)], "g string, x double")
    got = {r.g: r.m for r in exact_quantiles(df, "x", [0.5], ["m"], by=["g"], wide=wide).collect()}
    assert got == {None: 2.5, "a": 2.0}
    assert exact_quantiles(df.where("false"), "x", [0.5], ["m"], wide=wide).collect()[0].m is None
    assert exact_quantiles(df, "x", [0.0, 1.0], ["lo", "hi"], wide=wide).first() == (1.0, 4.0)


def test_narrow_domain_has_no_range_shuffle(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 47).alias("age"))
    exact_quantiles(df, "age", [0.5], ["m"]).explain()
    plan = capsys.readouterr().out
    assert "rangepartitioning" not in plan
