"""Derivation checks between results (the consistency the reference's shipped
outputs satisfy), run on our own outputs."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def q(spark):
    qs = entry.queries()
    return lambda name: qs[name](spark, SF)


def total(df, col):
    return df.agg(F.sum(col)).first()[0]


def test_trends_sum_to_totals(q):
    k = q("eda_kpis").first()
    for name in ["monthly_trend", "weekday_trend", "quarterly_trend"]:
        t = q(name)
        assert total(t, "revenue") == pytest.approx(k.total_revenue, rel=1e-12)
        assert total(t, "orders") == k.total_orders


def test_category_by_month_rolls_up_to_category_revenue(q):
    cm = q("category_monthly_trend").groupBy("category").agg(F.sum("total_amount").alias("s"))
    rbc = {r.category: r.revenue for r in q("revenue_by_category").collect()}
    for r in cm.collect():
        assert r.s == pytest.approx(rbc[r.category], abs=0.01)


def test_new_customers_and_segments_sum_to_customers(q):
    n = q("eda_kpis").first().total_customers
    assert total(q("new_customers_trend"), "new_customers") == n
    assert q("customer_features").count() == n
    assert total(q("segment_sizes"), "customers") == n
    assert total(q("label_clusters"), "customers") == n
    assert total(q("kmeans_segments"), "customers") == n


def test_shares_sum_to_about_100(q):
    s = q("segment_summary")
    assert total(s, "pct_of_customers") == pytest.approx(100, abs=0.5)
    assert total(s, "pct_of_revenue") == pytest.approx(100, abs=0.5)


def test_peak_month_is_the_monthly_max(q):
    facts = {r.fact: r for r in q("peak_facts").collect()}
    m = q("monthly_trend").orderBy(F.desc("revenue"), "year_month").first()
    assert facts["peak_month"].key == m.year_month


def test_elbow_inertia_falls_with_k(q):
    rows = q("kmeans_sweep").orderBy("k").collect()
    assert [r.k for r in rows] == list(range(2, 9))
    assert all(b.inertia <= a.inertia * 1.01 for a, b in zip(rows, rows[1:]))
    assert sum(r.suggested for r in rows) == 1
