"""Canonical input schemas (explicit; no inference anywhere)."""

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.StringType()),
    T.StructField("customer_name", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("age", T.DoubleType()),
    T.StructField("city", T.StringType()),
    T.StructField("signup_date", T.TimestampNTZType()),
    T.StructField("state", T.StringType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("sub_category", T.StringType()),
    T.StructField("product_name", T.StringType()),
    T.StructField("unit_price", MONEY),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("product_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("sub_category", T.StringType()),
    T.StructField("unit_price", MONEY),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("discount_pct", T.IntegerType()),
    T.StructField("gross_amount", MONEY),
    T.StructField("discount_amount", MONEY),
    T.StructField("total_amount", MONEY),
    T.StructField("payment_method", T.StringType()),
    T.StructField("delivery_days", T.DoubleType()),
    T.StructField("order_status", T.StringType()),
])

SESSIONS = T.StructType([
    T.StructField("session_id", T.StringType()),
    T.StructField("customer_id", T.StringType()),
    T.StructField("visit_date", T.TimestampNTZType()),
    T.StructField("device", T.StringType()),
    T.StructField("pages_viewed", T.IntegerType()),
    T.StructField("session_duration_min", T.DoubleType()),
    T.StructField("converted", T.IntegerType()),
])

SCHEMAS = {"customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS, "sessions": SESSIONS}

# Column lists the plans rely on (types may differ per source: ids are strings in
# CSV exports and BIGINT in the driver tables).
ORDER_COLUMNS = [f.name for f in ORDERS.fields]
CUSTOMER_COLUMNS = [f.name for f in CUSTOMERS.fields]
SESSION_COLUMNS = [f.name for f in SESSIONS.fields]
