"""The four canonical tables (customers, products, orders, sessions).

Two ways in:

* ``read_csv_tables(dir)`` for CSV exports in the canonical layout, and
* ``driver_tables(spark, sf_dir)`` which derives the canonical tables from the
  TPC-H-style parquet test data (mapping fixed in FIXTURES.md).  Every derived
  column is a built-in expression, so Catalyst prunes the parquet scan to the
  columns a plan actually touches and pushes filters below the joins.

``Tables.order_tiebreak`` is the "file order" used for keep-first
deduplication; exports in the canonical layout carry no such column, so the
CSV path uses the row's own position within its file.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.sources import schemas


@dataclass
class Tables:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    sessions: DataFrame
    # keep-first order for duplicated keys (total order expected)
    order_tiebreak: list = field(default_factory=list)
    customer_tiebreak: list = field(default_factory=list)
    # columnar sources (parquet) are cheap to re-read with column pruning;
    # text sources (CSV) are parsed once and staged before repeated use
    columnar: bool = True

    def as_dict(self) -> dict[str, DataFrame]:
        return {"customers": self.customers, "products": self.products,
                "orders": self.orders, "sessions": self.sessions}


def read_parquet(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# --------------------------------------------------------------------------
# driver test data -> canonical tables
# --------------------------------------------------------------------------

def _days(a: Column, b: Column) -> Column:
    return F.datediff(F.to_date(a), F.to_date(b))


def driver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line grain on purpose: ``order_id = l_orderkey*10 + l_linenumber`` repeats,
    so keep-first deduplication has real work."""
    li = read_parquet(spark, sf_dir, "lineitem")
    o = read_parquet(spark, sf_dir, "orders")
    p = read_parquet(spark, sf_dir, "part")
    gross = F.col("l_extendedprice").cast("decimal(12,2)")
    total = (gross * (F.lit(1) - F.col("l_discount").cast("decimal(4,2)"))).cast("decimal(18,4)")
    delivery = _days(F.col("l_shipdate"), F.col("o_orderdate"))
    status = (F.when(F.col("o_orderstatus") == "P", F.lit("Cancelled"))
              .when(F.col("l_returnflag") == "R", F.lit("Returned"))
              .otherwise(F.lit("Delivered")))
    joined = (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
                .join(p, li.l_partkey == p.p_partkey, "inner"))
    return joined.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("order_date"),
        F.col("l_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.round(F.col("l_discount") * 100, 0).cast("int").alias("discount_pct"),
        gross.alias("gross_amount"),
        (gross - total).cast("decimal(18,4)").alias("discount_amount"),
        total.alias("total_amount"),
        F.col("o_orderpriority").alias("payment_method"),
        F.when(delivery >= 0, delivery.cast("double")).alias("delivery_days"),
        status.alias("order_status"),
        # file-order stand-in for keep-first dedup
        F.col("l_shipdate").alias("ship_date"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_extendedprice").alias("line_price"),
    )


ORDER_TIEBREAK = ["ship_date", "product_id", "supplier_id", "line_price"]
ORDER_EXTRA = ["ship_date", "supplier_id", "line_price"]


def driver_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` x ``nation`` x ``region`` with every 200th customer appended
    a second time (exact duplicates, as in the reference's generator)."""
    c = read_parquet(spark, sf_dir, "customer")
    n = read_parquet(spark, sf_dir, "nation")
    r = read_parquet(spark, sf_dir, "region")
    k = F.col("c_custkey")
    base = (c.join(n, c.c_nationkey == n.n_nationkey, "inner")
             .join(r, n.n_regionkey == r.r_regionkey, "inner")
             .select(
                 k.alias("customer_id"),
                 F.col("c_name").alias("customer_name"),
                 F.when(k % 100 < 48, "Male").when(k % 100 < 97, "Female")
                  .otherwise("Other").alias("gender"),
                 F.when(k % 50 == 0, F.lit(None).cast("double"))
                  .otherwise((F.lit(18) + k % 47).cast("double")).alias("age"),
                 F.col("n_name").alias("city"),
                 F.date_add(F.lit("1994-01-01").cast("date"), (k * 37 % 1800).cast("int"))
                  .cast("timestamp_ntz").alias("signup_date"),
                 F.col("r_name").alias("state"),
             ))
    return base.unionByName(base.where(F.col("customer_id") % 200 == 0))


def driver_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_parquet(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("session_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("visit_date"),
        F.col("event_type").alias("device"),
        (F.lit(1) + F.regexp_extract("props", "([0-9]+)", 1).cast("int")).alias("pages_viewed"),
        F.col("value").alias("session_duration_min"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("converted"),
    )


def driver_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_parquet(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.col("p_name").alias("product_name"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("unit_price"),
    )


def driver_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(
        customers=driver_customers(spark, sf_dir),
        products=driver_products(spark, sf_dir),
        orders=driver_orders(spark, sf_dir),
        sessions=driver_sessions(spark, sf_dir),
        order_tiebreak=list(ORDER_TIEBREAK),
        customer_tiebreak=["signup_date", "customer_name"],
    )


# --------------------------------------------------------------------------
# CSV exports in the canonical layout
# --------------------------------------------------------------------------

def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Header CSV read by column name; empty fields are nulls, quotes inside
    quoted fields are doubled.  Columns may come in any order, others are ignored;
    a missing column is an error.  All files of a folder have the same header.  Dates
    written as ``YYYY-MM-DD``, ``YYYY-MM-DD HH:MM:SS`` or with a fraction of a
    second parse into TIMESTAMP_NTZ."""
    def reader():
        return spark.read.option("header", True).option("quote", '"').option("escape", '"')

    header = reader().csv(path).columns
    known = {f.name: f for f in schema.fields}
    missing = [c for c in known if c not in header]
    if missing:
        raise ValueError(f"{path}: missing column(s) {', '.join(missing)}")
    in_file_order = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
    return (reader().schema(in_file_order)
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", "yyyy-MM-dd[ HH:mm:ss[.SSSSSS]]")
            .csv(path)
            .select(*known))


def with_file_position(df: DataFrame) -> DataFrame:
    """File order for keep-first dedup: (file name, byte offset of the split,
    row position).  ``monotonically_increasing_id`` is increasing within a
    partition and partitions follow file/split order, which is the order a
    sequential reader sees."""
    return (df.withColumn("_file", F.input_file_name())
              .withColumn("_pos", F.monotonically_increasing_id()))


def read_csv_tables(spark: SparkSession, data_dir: str) -> Tables:
    d = data_dir.rstrip("/")
    customers = with_file_position(read_csv(spark, f"{d}/customers.csv", schemas.CUSTOMERS))
    orders = with_file_position(read_csv(spark, f"{d}/orders.csv", schemas.ORDERS))
    return Tables(
        customers=customers,
        products=read_csv(spark, f"{d}/products.csv", schemas.PRODUCTS),
        orders=orders,
        sessions=read_csv(spark, f"{d}/website_sessions.csv", schemas.SESSIONS),
        order_tiebreak=["_file", "_pos"],
        customer_tiebreak=["_file", "_pos"],
        columnar=False,
    )
