"""A customer holding a third of all orders: results stay exact and the only
window over customer runs on (customer, day) aggregates, not on raw rows."""

import datetime as dt
import random
from decimal import Decimal

import pandas as pd
import pytest

from basketry.plans import features, segments

D = dt.datetime
DDL = ("order_id long, customer_id long, order_date timestamp_ntz, category string, "
       "total_amount decimal(12,2), quantity int, discount_pct int, is_returned boolean, "
       "order_status string")


@pytest.fixture(scope="module")
def hot(spark):
    random.seed(5)
    rows = []
    for i in range(6000):
        cust = 0 if i % 3 == 0 else random.randint(1, 400)
        ts = D(2023, 1, 1) + dt.timedelta(days=random.randint(0, 700), seconds=random.choice([0, 3600 * 15]))
        rows.append((i, cust, ts, random.choice("abcd"), Decimal(random.randint(1, 9999)) / 100,
                     random.randint(1, 4), random.choice([0, 5, 10]), random.random() < 0.1, "Delivered"))
    return rows, spark.createDataFrame(rows, DDL)


def test_hot_customer_aggregates_exact(spark, hot):
    rows, df = hot
    got = {r.customer_id: r for r in features.customer_aggregates(df).collect()}
    iv = {r.customer_id: r.avg_purchase_interval_days for r in features.purchase_intervals(df).collect()}
    pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in DDL.split(", ")])
    g = pdf[pdf.customer_id == 0]
    assert got[0].frequency == len(g)
    assert got[0].category_diversity == g.category.nunique()
    ts = sorted(g.order_date)
    gaps = [(b - a).days for a, b in zip(ts, ts[1:])]
    assert iv[0] == pytest.approx(sum(gaps) / len(gaps), abs=1e-12)


def test_window_only_on_day_level_rows(spark, hot):
    _, df = hot
    text = features.purchase_intervals(df)._jdf.queryExecution().executedPlan().toString()
    lines = text.splitlines()
    win = [i for i, line in enumerate(lines) if "Window [" in line]
    assert win, text
    below = "\n".join(lines[win[0]:])
    # the window's input is an aggregate on (customer, day)
    assert "HashAggregate(keys=[customer_id" in below and "_day" in below


def test_weekday_pattern_pre_aggregates_before_semi_join(spark, hot):
    _, df = hot
    ids = df.select("customer_id").distinct()
    text = segments.weekday_pattern(df, ids)._jdf.queryExecution().optimizedPlan().toString()
    join = text.index("LeftSemi")
    assert "Aggregate [customer_id" in text[join:]
