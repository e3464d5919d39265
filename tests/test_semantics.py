"""Small hand-made tables, one per semantic trap (FIXTURES.md section 3)."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from basketry.functions.dates import whole_days
from basketry.functions.flags import is_value, positive_share
from basketry.operators.dedup import keep_first
from basketry.operators.domain import reindex
from basketry.plans import clean, eda, features, insights, segments, trends
from basketry.sources.tables import Tables

D = dt.datetime
ORDER_DDL = ("order_id string, customer_id string, order_date timestamp_ntz, product_id string, "
             "category string, sub_category string, unit_price decimal(12,2), quantity int, "
             "discount_pct int, gross_amount decimal(12,2), discount_amount decimal(12,2), "
             "total_amount decimal(12,2), payment_method string, delivery_days double, "
             "order_status string, seq int")


def order(oid, cust, date, status="Delivered", total="10.00", cat="A", disc=0, qty=1, delivery=3.0, seq=0):
    t = Decimal(total) if total is not None else None
    return (oid, cust, date, "P1", cat, "S", Decimal("10.00"), qty, disc, t, Decimal("0.00"), t,
            "UPI", delivery, status, seq)


def tables(spark, orders, customers=None, sessions=None):
    o = spark.createDataFrame(orders, ORDER_DDL)
    c = spark.createDataFrame(customers or [], "customer_id string, customer_name string, gender string, "
                              "age double, city string, signup_date timestamp_ntz, state string, seq int")
    s = spark.createDataFrame(sessions or [], "session_id string, customer_id string, visit_date timestamp_ntz, "
                              "device string, pages_viewed int, session_duration_min double, converted int")
    p = spark.createDataFrame([], "product_id string, category string, sub_category string, "
                              "product_name string, unit_price decimal(12,2)")
    return Tables(customers=c, products=p, orders=o, sessions=s,
                  order_tiebreak=["seq"], customer_tiebreak=["seq"])


def test_null_status_is_kept_and_not_returned(spark):
    t = tables(spark, [order("1", "c", D(2024, 1, 1), None), order("2", "c", D(2024, 1, 2), "Cancelled"),
                       order("3", "c", D(2024, 1, 3), "Delivered"), order("4", "c", D(2024, 1, 4), "Returned")])
    rows = {r.order_id: r for r in clean.clean_orders(t).collect()}
    assert set(rows) == {"1", "3", "4"}
    assert rows["1"].is_returned is False and rows["1"].is_cancelled is False
    assert rows["4"].is_returned is True


def test_null_group_key_dropped_and_null_customer_row_dropped(spark):
    t = tables(spark, [order("1", "c", D(2024, 1, 1), cat=None), order("2", "c", D(2024, 1, 2), cat="B"),
                       order("3", None, D(2024, 1, 3), cat="B")])
    oc = clean.clean_orders(t)
    assert oc.count() == 2
    cats = [r.category for r in eda.revenue_by_category(oc).collect()]
    assert cats == ["B"]


def test_mode_ties_take_smallest_and_all_null_is_unknown(spark):
    rows = [order(str(i), "x", D(2024, 1, i + 1), cat=c) for i, c in enumerate("aabbc")]
    rows += [order("n1", "y", D(2024, 2, 1), cat=None), order("n2", "y", D(2024, 2, 2), cat=None)]
    oc = clean.clean_orders(tables(spark, rows))
    fav = {r.customer_id: r.favorite_category for r in features.behavior(oc).collect()}
    assert fav == {"x": "a", "y": "Unknown"}


def test_purchase_interval_single_pair_and_same_day(spark):
    rows = [order("1", "one", D(2024, 1, 1)),
            order("2", "two", D(2024, 1, 1)), order("3", "two", D(2024, 1, 11)),
            order("4", "same", D(2024, 1, 5)), order("5", "same", D(2024, 1, 5)), order("6", "same", D(2024, 1, 8))]
    oc = clean.clean_orders(tables(spark, rows))
    iv = {r.customer_id: r.avg_purchase_interval_days for r in features.purchase_intervals(oc).collect()}
    assert iv["one"] is None
    assert iv["two"] == 10.0
    assert iv["same"] == 1.5   # gaps 0 and 3


def test_purchase_interval_with_time_of_day_matches_brute_force(spark):
    import random
    random.seed(7)
    rows, expect = [], {}
    for c in range(30):
        n = random.randint(1, 12)
        ts = sorted(D(2024, 1, 1) + dt.timedelta(seconds=random.randint(0, 40 * 86400)) for _ in range(n))
        for i, x in enumerate(ts):
            rows.append(order(f"{c}-{i}", f"c{c}", x))
        gaps = [(ts[i + 1] - ts[i]).days for i in range(n - 1)]
        expect[f"c{c}"] = (sum(gaps) / len(gaps)) if gaps else None
    oc = clean.clean_orders(tables(spark, rows))
    got = {r.customer_id: r.avg_purchase_interval_days for r in features.purchase_intervals(oc).collect()}
    for k, v in expect.items():
        assert (got[k] is None and v is None) or got[k] == pytest.approx(v, abs=1e-12), k


def test_recency_floors_time_of_day(spark):
    rows = [order("1", "late", D(2024, 1, 10, 18)), order("2", "early", D(2024, 1, 9, 6)),
            order("3", "early", D(2024, 1, 9, 20))]
    oc = clean.clean_orders(tables(spark, rows))
    rec = {r.customer_id: r.recency_days for r in features.rfm(oc).collect()}
    # snapshot 2024-01-11 18:00; 20:00 on the 9th is 1 day 22 h before -> 1
    assert rec == {"late": 1, "early": 1}


def test_negative_tenure_floors(spark):
    df = spark.createDataFrame([(D(2024, 1, 1, 12), D(2024, 1, 2))], "a timestamp_ntz, b timestamp_ntz")
    assert df.select(whole_days("a", "b").alias("d")).first().d == -1


def test_keep_first_uses_the_given_order(spark):
    rows = [order("1", "c", D(2024, 1, 3), total="3.00", seq=2), order("1", "c", D(2024, 1, 1), total="1.00", seq=1),
            order("1", "c", D(2024, 1, 2), total="2.00", seq=3), order("2", "d", D(2024, 1, 1), seq=0)]
    t = tables(spark, rows)
    out = {r.order_id: r for r in keep_first(t.orders, "order_id", ["seq"]).collect()}
    assert out["1"].total_amount == Decimal("1.00") and out["1"].seq == 1
    assert len(out) == 2


def test_missing_weekday_kept_with_nulls_monday_first(spark):
    # 2024-01-01 is a Monday; no Sunday (2024-01-07) orders
    rows = [order(str(i), "c", D(2024, 1, 1 + i)) for i in range(6)]
    oc = clean.clean_orders(tables(spark, rows))
    out = trends.weekday_trend(oc).collect()
    assert [r.weekday for r in out] == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                                        "Saturday", "Sunday"]
    assert out[-1].revenue is None and out[0].revenue == 10.0


def test_all_null_amount_sums_to_zero(spark):
    rows = [order("1", "c", D(2024, 1, 1), total="5.00")]
    oc = clean.clean_orders(tables(spark, rows)).withColumn("total_amount", F.lit(None).cast("decimal(12,2)"))
    r = trends.monthly_trend(oc).first()
    assert r.revenue == 0.0


def test_discount_usage_counts_missing_as_no(spark):
    df = spark.createDataFrame([(0,), (10,), (None,), (5,)], "d int")
    assert df.agg(positive_share("d").alias("x")).first().x == 0.5


def test_null_safe_flag(spark):
    df = spark.createDataFrame([(None,), ("Cancelled",), ("x",)], "s string")
    assert [r.f for r in df.select(is_value("s", "Cancelled").alias("f")).collect()] == [False, True, False]


def test_average_rank_ties_share_mean(spark):
    prof = spark.createDataFrame([(0, 1.0), (1, 2.0), (2, 2.0), (3, 5.0)], "cluster int, v double")
    from basketry.operators.rank import average_rank
    got = {r.cluster: r.r for r in prof.select("cluster", average_rank("v").alias("r")).collect()}
    assert got == {0: 1.0, 1: 2.5, 2: 2.5, 3: 4.0}


def _profile(spark, rows):
    rows = [(r[0], *[float(x) for x in r[1:]]) for r in rows]
    return spark.createDataFrame(rows, "cluster int, recency_days double, frequency double, monetary double, "
                                       "tenure_days double, discount_usage_rate double")


def test_label_collision_positional_fill(spark):
    # cluster 2: lowest tenure, highest recency and highest discount usage;
    # cluster 0: highest spend.  At Risk and Price Sensitive collide with New.
    prof = _profile(spark, [(0, 10, 20, 900, 500, 0.1), (1, 50, 5, 100, 400, 0.2), (2, 300, 2, 50, 10, 0.9),
                            (3, 60, 8, 300, 450, 0.3), (4, 40, 9, 200, 420, 0.25)])
    got = {r.cluster: r.segment for r in segments.label_clusters(prof).collect()}
    assert got == {0: segments.HIGH_VALUE, 2: segments.NEW, 1: segments.OCCASIONAL,
                   3: segments.PRICE_SENSITIVE, 4: segments.AT_RISK}


def test_label_ties_go_to_first_cluster_and_fallback(spark):
    prof = _profile(spark, [(c, 1, 1, 1, 1, 1) for c in range(7)])
    got = {r.cluster: r.segment for r in segments.label_clusters(prof).collect()}
    # every rule picks cluster 0 -> High Value; the others take the pool in order, then the fallback
    assert got[0] == segments.HIGH_VALUE
    assert [got[c] for c in range(1, 5)] == [segments.OCCASIONAL, segments.NEW,
                                             segments.PRICE_SENSITIVE, segments.AT_RISK]
    assert got[5] == got[6] == segments.FALLBACK


@pytest.mark.parametrize("values,direction,change", [
    ([], "stable", None), ([5.0], "stable", None), ([0.0, 4.0], "increased", 0.0),
    ([10.0, 15.0], "increased", 50.0), ([10.0, 5.0], "fell", 50.0), ([3.0, 9.0, 3.0], "flat", 0.0)])
def test_growth_branches(spark, values, direction, change):
    df = spark.createDataFrame([(f"2024-{i + 1:02d}", v) for i, v in enumerate(values)], "p string, v double")
    r = insights.growth(df, "X", "p", "v").first()
    assert r.direction == direction
    assert (r.change_pct is None and change is None) or r.change_pct == pytest.approx(change)
    text = insights.growth_statements(insights.growth(df, "X", "p", "v")).first().text
    assert text.startswith("X ")


def test_growth_text_format(spark):
    df = spark.createDataFrame([("2024-01", 1000.0), ("2024-02", 1500.0)], "p string, v double")
    text = insights.growth_statements(insights.growth(df, "Revenue", "p", "v")).first().text
    assert text.startswith("Revenue increased by 50.0% from 1,000 to 1,500.")


def test_reindex_drops_values_outside_domain(spark):
    agg = spark.createDataFrame([("Monday", 1), ("Funday", 2)], "weekday string, n int")
    out = reindex(agg, "weekday", ["Monday", "Tuesday"]).collect()
    assert [(r.weekday, r.n) for r in out] == [("Monday", 1), ("Tuesday", None)]


def test_means_of_tiny_values_are_kept(spark):
    from basketry.functions.flags import stable_mean
    df = spark.createDataFrame([(1e-7,), (2e-7,), (None,)], "x double")
    assert abs(df.agg(stable_mean("x").alias("m")).first().m - 1.5e-7) < 1e-20
    big = spark.createDataFrame([(1e300,), (1e300,)], "x double")
    assert big.agg(stable_mean("x").alias("m")).first().m == 1e300


def test_sessions_without_customer_are_no_group(spark):
    from basketry.plans.features import web_features
    s = spark.createDataFrame([("s1", None, 1, 1.0, 0), ("s2", 5, 2, 2.0, 1)],
                              "session_id string, customer_id int, pages_viewed int, session_duration_min double, converted int")
    assert [r.customer_id for r in web_features(s).collect()] == [5]
