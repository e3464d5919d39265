"""CSV sources in the canonical layout and result sinks, round trip."""

import os
import tempfile

from pyspark.sql import functions as F

from basketry.plans import clean, trends
from basketry.sources import files
from basketry.sources.tables import driver_tables, read_csv_tables

SF = "/root/testdata/sf0.001"


def _export_csv(spark, d):
    """Write the driver tables as canonical CSV files (as a user's export would be)."""
    t = driver_tables(spark, SF)
    o = t.orders.orderBy("ship_date", "product_id", "supplier_id", "line_price") \
        .drop("ship_date", "supplier_id", "line_price")
    o = o.withColumn("unit_price", F.col("unit_price").cast("decimal(12,2)")) \
         .withColumn("total_amount", F.col("total_amount").cast("decimal(12,2)")) \
         .withColumn("discount_amount", F.col("discount_amount").cast("decimal(12,2)"))
    c = t.customers.orderBy("customer_id").select("customer_id", "customer_name", "gender", "age", "city",
                                                  F.date_format("signup_date", "yyyy-MM-dd").alias("signup_date"),
                                                  "state")
    for name, df in [("orders.csv", o), ("customers.csv", c), ("products.csv", t.products),
                     ("website_sessions.csv", t.sessions)]:
        df.toPandas().to_csv(os.path.join(d, name), index=False)
    return t


def test_csv_tables_load_and_clean(spark):
    d = tempfile.mkdtemp(prefix="basketry-csv-")
    _export_csv(spark, d)
    t = read_csv_tables(spark, d)
    assert dict(t.orders.dtypes)["order_date"] == "timestamp_ntz"
    assert dict(t.customers.dtypes)["signup_date"] == "timestamp_ntz"
    oc = clean.clean_orders(t)
    # same cleaned row count as the parquet path (file order = dedup order here)
    from basketry.plans.stages import AnalyticsRun
    ref = AnalyticsRun(spark, driver_tables(spark, SF), materialize=False).orders_clean
    assert oc.count() == ref.count()
    cc = clean.clean_customers(t)
    assert cc.count() == cc.select("customer_id").distinct().count()
    assert cc.where(F.col("age").isNull()).count() == 0
    # sessions carry times of day with microseconds
    from basketry.plans import features
    web_csv = {str(r.customer_id): (r.total_sessions, r.avg_pages_viewed)
               for r in features.web_features(t.sessions).collect()}
    web_pq = {str(r.customer_id): (r.total_sessions, r.avg_pages_viewed)
              for r in features.web_features(driver_tables(spark, SF).sessions).collect()}
    assert web_csv == web_pq
    assert t.sessions.agg(F.max("visit_date")).first()[0] == \
        driver_tables(spark, SF).sessions.agg(F.max("visit_date")).first()[0]


def test_sinks_round_trip(spark):
    d = tempfile.mkdtemp(prefix="basketry-out-")
    t = driver_tables(spark, SF)
    from basketry.plans.stages import AnalyticsRun
    p = AnalyticsRun(spark, t, materialize=False)
    m = trends.monthly_trend(p.orders_clean)
    paths = files.write_results({"monthly_trend": m}, d, fmt="csv")
    back = files.read_table(spark, paths["monthly_trend"], "csv", schema=m.schema)
    assert sorted(back.collect()) == sorted(m.collect())
    files.write_results({"monthly_trend": m}, d, fmt="parquet")   # overwrite
    assert files.read_table(spark, paths["monthly_trend"]).count() == m.count()
    payload = m.groupBy().agg(F.collect_list(F.struct("year_month", "revenue")).alias("months"))
    files.write_json(payload, f"{d}/payload")
    j = files.read_json(spark, f"{d}/payload")
    assert len(j.first().months) == m.count()


def _products(tmp_path, text):
    (tmp_path / "products.csv").write_text(text)
    return str(tmp_path / "products.csv")


def test_csv_is_read_by_name_with_doubled_quotes(spark, tmp_path):
    from basketry.sources import schemas
    from basketry.sources.tables import read_csv
    path = _products(tmp_path, 'product_id,sub_category,category,extra,product_name,unit_price\n'
                               'P1,Bakeware,Kitchen,x,"12"" tray, steel",9.50\n')
    row = read_csv(spark, path, schemas.PRODUCTS).first()
    assert row.asDict() == {"product_id": "P1", "category": "Kitchen", "sub_category": "Bakeware",
                            "product_name": '12" tray, steel', "unit_price": __import__("decimal").Decimal("9.50")}


def test_csv_missing_column_is_an_error(spark, tmp_path):
    import pytest
    from basketry.sources import schemas
    from basketry.sources.tables import read_csv
    path = _products(tmp_path, "product_id,category,product_name,unit_price\nP1,Kitchen,Tray,9.50\n")
    with pytest.raises(ValueError, match="sub_category"):
        read_csv(spark, path, schemas.PRODUCTS)
