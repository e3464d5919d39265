"""Order amount reconciliation (F15) and append-then-dedup (U1 + P2).

The generator's amount rule: gross = round(unit price * quantity, 2),
discount = round(gross * pct / 100, 2), total = gross - discount.  Here it is
re-aimed as a check of the stored amounts, all in exact decimal arithmetic,
aggregated to one row of mismatch counts (a global aggregate, partial per
task)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.operators.dedup import keep_first


def amount_checks(orders: DataFrame) -> DataFrame:
    price = F.col("unit_price").cast("decimal(20,6)")
    exp_gross = F.round(price * F.col("quantity"), 2)
    exp_disc = F.round(F.col("gross_amount") * F.col("discount_pct") * F.lit(0.01).cast("decimal(3,2)"), 2)
    exp_total = F.col("gross_amount") - exp_disc
    return orders.select(
        "order_id",
        exp_gross.alias("expected_gross"),
        exp_disc.alias("expected_discount"),
        exp_total.alias("expected_total"),
        (exp_gross != F.col("gross_amount")).alias("gross_mismatch"),
        (exp_disc != F.col("discount_amount")).alias("discount_mismatch"),
        (exp_total != F.col("total_amount")).alias("total_mismatch"),
        F.abs(exp_total - F.col("total_amount")).alias("total_diff"))


def amount_reconciliation(orders: DataFrame) -> DataFrame:
    c = amount_checks(orders)

    def n(col):
        return F.sum(F.when(F.col(col), 1).otherwise(0)).cast("bigint")

    return c.groupBy().agg(
        F.count(F.lit(1)).alias("rows_checked"),
        n("gross_mismatch").alias("gross_mismatches"),
        n("discount_mismatch").alias("discount_mismatches"),
        n("total_mismatch").alias("total_mismatches"),
        F.max("total_diff").cast("double").alias("max_total_diff"))


def append_dedup(orders: DataFrame, extra: DataFrame, order: list[str]) -> DataFrame:
    """Append rows (``unionByName``) and deduplicate keep-first on order_id."""
    return keep_first(orders.unionByName(extra), "order_id", order)
