"""Cleaning: customers (C1) and orders (C2) plus the cleaning audit (P17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.functions.dates import time_features
from basketry.functions.flags import is_value, not_value
from basketry.operators.dedup import keep_first
from basketry.operators.quantile import fill_with_median
from basketry.sources.schemas import CUSTOMER_COLUMNS, ORDER_COLUMNS
from basketry.sources.tables import Tables
from basketry.operators.scalar import combine

REQUIRED_ORDER_FIELDS = ["order_date", "customer_id", "total_amount"]


def clean_customers(t: Tables) -> DataFrame:
    """Keep first row per customer_id, fill missing age with the median age of
    the deduplicated table, signup date as timestamp."""
    return clean_from_dedup(keep_first(t.customers, "customer_id", t.customer_tiebreak))


def clean_from_dedup(cust: DataFrame) -> DataFrame:
    cust = fill_with_median(cust, "age")
    cust = cust.withColumn("signup_date", F.col("signup_date").cast("timestamp_ntz"))
    return cust.select(*CUSTOMER_COLUMNS)


def dedup_orders(t: Tables, copies: str | None = None) -> DataFrame:
    extra = [copies] if copies else []
    return keep_first(t.orders, "order_id", t.order_tiebreak, copies).select(*ORDER_COLUMNS, *extra)


def flag_orders(dedup: DataFrame) -> DataFrame:
    """Delivery days imputed (median over all deduplicated rows, cancelled
    included, before the null drop), rows missing a required field dropped,
    cancelled / returned flags (a missing status is neither)."""
    o = fill_with_median(dedup, "delivery_days")
    o = o.na.drop(how="any", subset=REQUIRED_ORDER_FIELDS)
    return (o.withColumn("is_cancelled", is_value("order_status", "Cancelled"))
             .withColumn("is_returned", is_value("order_status", "Returned")))


def clean_from_flagged(flagged: DataFrame) -> DataFrame:
    """Revenue-facing orders: cancellations excluded, calendar features added."""
    o = flagged.where(~F.col("is_cancelled"))
    return o.withColumns(time_features("order_date"))


def flagged_orders(t: Tables) -> DataFrame:
    return flag_orders(dedup_orders(t))


def clean_orders(t: Tables) -> DataFrame:
    return clean_from_flagged(flagged_orders(t))


def valid_raw_orders(t: Tables) -> DataFrame:
    """The dashboard's ``orders_valid``: raw order rows (duplicates kept, no
    imputation, no null drop), cancellations removed, returned flag."""
    o = t.orders.select(*ORDER_COLUMNS).where(not_value("order_status", "Cancelled"))
    return o.withColumn("is_returned", is_value("order_status", "Returned"))


def cleaning_audit(t: Tables, orders_dedup: DataFrame | None = None,
                   customers_dedup: DataFrame | None = None) -> DataFrame:
    """(table, metric, value) rows: loaded rows, duplicates removed, rows
    dropped for a missing required field, cancellations excluded, rows kept.
    Each figure is one aggregate; the orders "duplicates" figure of the
    reference mixes duplicates and null drops, here they are separate."""
    cust_raw = t.customers.agg(F.count(F.lit(1)).alias("n"))
    cust_dedup = t.customers.agg(F.count_distinct("customer_id").alias("d"),
                                 F.max(F.col("customer_id").isNull().cast("int")).alias("has_null"))
    ord_raw = t.orders.agg(F.count(F.lit(1)).alias("n"))
    dedup = dedup_orders(t) if orders_dedup is None else orders_dedup
    dd = dedup.agg(
        F.count(F.lit(1)).alias("d"),
        F.sum(F.when(F.col("order_date").isNull() | F.col("customer_id").isNull()
                     | F.col("total_amount").isNull(), 1).otherwise(0)).alias("nulls"),
        F.sum(F.when(F.col("order_date").isNotNull() & F.col("customer_id").isNotNull()
                     & F.col("total_amount").isNotNull()
                     & is_value("order_status", "Cancelled"), 1).otherwise(0)).alias("cancelled"),
        F.sum(F.when(F.col("delivery_days").isNull(), 1).otherwise(0)).alias("imputed_delivery"),
    )
    cdedup = keep_first(t.customers, "customer_id", t.customer_tiebreak) \
        if customers_dedup is None else customers_dedup
    cust_age = cdedup.agg(F.sum(F.when(F.col("age").isNull(), 1).otherwise(0)).alias("imputed_age"))

    c = combine(cust_raw, cust_dedup, cust_age)
    o = combine(ord_raw, dd)
    d_cust = F.col("d") + F.coalesce(F.col("has_null"), F.lit(0))
    rows = [
        c.select(F.lit("customers").alias("table_name"), F.lit("rows_loaded").alias("metric"), F.col("n").cast("bigint").alias("value")),
        c.select(F.lit("customers"), F.lit("duplicates_removed"), (F.col("n") - d_cust).cast("bigint")),
        c.select(F.lit("customers"), F.lit("ages_imputed"), F.col("imputed_age").cast("bigint")),
        c.select(F.lit("customers"), F.lit("rows_kept"), d_cust.cast("bigint")),
        o.select(F.lit("orders"), F.lit("rows_loaded"), F.col("n").cast("bigint")),
        o.select(F.lit("orders"), F.lit("duplicates_removed"), (F.col("n") - F.col("d")).cast("bigint")),
        o.select(F.lit("orders"), F.lit("delivery_days_imputed"), F.col("imputed_delivery").cast("bigint")),
        o.select(F.lit("orders"), F.lit("null_rows_dropped"), F.col("nulls").cast("bigint")),
        o.select(F.lit("orders"), F.lit("cancellations_excluded"), F.col("cancelled").cast("bigint")),
        o.select(F.lit("orders"), F.lit("rows_kept"),
                 (F.col("d") - F.col("nulls") - F.col("cancelled")).cast("bigint")),
    ]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionAll(r)
    return out


# -- the same figures from the jobs that clean ----------------------------------
#
# Observed at the top of a stage's plan, i.e. in the tasks that write it: their figures
# count once per written partition, also when tasks or whole map stages run again.

def _missing(*fields: str) -> F.Column:
    out = F.lit(False)
    for f in fields:
        out = out | F.col(f).isNull()
    return out


def _how_many(cond: F.Column) -> F.Column:
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")


def order_metrics(copies: str) -> dict[str, F.Column]:
    """Observed on the deduplicated orders; ``copies`` counts the rows each stands for."""
    lost = _missing(*REQUIRED_ORDER_FIELDS)
    return {"rows_loaded": F.coalesce(F.sum(copies), F.lit(0)), "distinct": F.count(F.lit(1)),
            "delivery_days_imputed": _how_many(F.col("delivery_days").isNull()), "null_rows_dropped": _how_many(lost),
            "cancellations_excluded": _how_many(~lost & is_value("order_status", "Cancelled"))}


def customer_metrics(copies: str) -> dict[str, F.Column]:
    return {"rows_loaded": F.coalesce(F.sum(copies), F.lit(0)), "distinct": F.count(F.lit(1)),
            "ages_imputed": _how_many(F.col("age").isNull())}


def audit_rows(spark, customers: dict, orders: dict) -> DataFrame:
    """``cleaning_audit`` from observed figures: no job of its own."""
    rows = [("customers", "rows_loaded", customers["rows_loaded"]), ("customers", "duplicates_removed", customers["rows_loaded"] - customers["distinct"]),
            ("customers", "ages_imputed", customers["ages_imputed"]), ("customers", "rows_kept", customers["distinct"]),
            ("orders", "rows_loaded", orders["rows_loaded"]), ("orders", "duplicates_removed", orders["rows_loaded"] - orders["distinct"]),
            *[("orders", m, orders[m]) for m in ("delivery_days_imputed", "null_rows_dropped", "cancellations_excluded")],
            ("orders", "rows_kept", orders["distinct"] - orders["null_rows_dropped"] - orders["cancellations_excluded"])]
    return spark.createDataFrame(rows, "table_name string, metric string, value long")


def load_report(t: Tables) -> DataFrame:
    """S3: (table_name, rows) for every source."""
    out = None
    for name, df in t.as_dict().items():
        r = df.agg(F.count(F.lit(1)).cast("bigint").alias("rows")) \
              .select(F.lit(name).alias("table_name"), "rows")
        out = r if out is None else out.unionAll(r)
    return out
