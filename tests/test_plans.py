"""Physical-plan shape: pushdown, pruning, partial aggregation, no Expand,
no cartesian products of growing tables."""

from basketry.plans import cube, clean, features, trends
from basketry.plans.stages import run_for
from basketry.sources.tables import driver_tables

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_monthly_trend_reads_only_needed_columns_and_has_no_expand(spark):
    p = run_for(spark, SF)
    text = plan(trends.monthly_trend(p.orders_clean))
    assert "Expand" not in text
    read = [line for line in text.splitlines() if "ReadSchema" in line or "FileScan" in line]
    joined = " ".join(read)
    assert "year_month" in joined and "delivery_days" not in joined and "gross_amount" not in joined


def test_dedup_aggregates_map_side_before_the_shuffle(spark):
    t = driver_tables(spark, SF)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = clean.dedup_orders(t)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = text.splitlines()
    ex = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(order_id" in line)
    # the partial aggregate sits below (after, in tree text) the exchange
    assert any("SortAggregate" in line for line in lines[ex + 1:])
    assert "Window" not in text


def test_feature_table_has_no_cartesian_product_of_growing_tables(spark):
    p = run_for(spark, SF)
    df = features.customer_features(p.customer_orders, features.web_features(p.t.sessions), p.customers_clean)
    text = df._jdf.queryExecution().optimizedPlan().toString()
    # cross joins only attach 1-row aggregates (snapshot, median)
    assert "CartesianProduct" not in plan(df)
    assert text.count("Join Cross") <= 2


def test_filters_reach_the_scan(spark):
    t = driver_tables(spark, SF)
    text = plan(t.orders.where("order_date >= timestamp_ntz'1998-01-01'"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in text


def test_feature_table_broadcasts_only_global_aggregates_at_scale(spark):
    """With size-based broadcast off (the 100 TB shape), what is still
    broadcast must be 1-row: a global aggregate (keys=[])."""
    p = run_for(spark, SF)
    orders, cc = p.customer_orders, p.customers_clean
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = features.customer_features(orders, features.web_features(p.t.sessions), cc)
        lines = df._jdf.queryExecution().executedPlan().treeString().splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    found = 0
    for i, line in enumerate(lines):
        if "BroadcastExchange" not in line:
            continue
        found += 1
        below = next(x for x in lines[i + 1:] if "Aggregate(" in x or "Exchange" in x or "Scan" in x)
        assert "Aggregate(keys=[]" in below, below
    assert found >= 1
    assert not any("SortMergeJoin" in x and "Cross" in x for x in lines)


def scale_plan(spark, make):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return make()._jdf.queryExecution().executedPlan().treeString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_customer_orders_scan_once_and_are_dealt_out_by_customer_once(spark):
    oc = run_for(spark, SF).orders_clean
    text = scale_plan(spark, lambda: features.customer_orders(oc))
    assert text.count("FileScan") == 1 and text.count("Join") == 0
    assert text.count("Exchange hashpartitioning") == 2 and text.count("REPARTITION_BY_COL") == 1
    # the first exchange takes partial sums
    lines = text.splitlines()
    last = max(i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x)
    assert "HashAggregate" in lines[last + 1]


def test_calendar_cube_scans_once(spark):
    oc = run_for(spark, SF).orders_clean
    text = scale_plan(spark, lambda: cube.grouped(oc, cube.SETS))
    assert text.count("FileScan") == 1 and text.count("Expand") == 1 and text.count("Exchange") == 1 and "SortAggregate" not in text
