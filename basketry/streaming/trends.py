"""Monthly trend kept current while order files keep arriving.

The reference reads its inputs whole; this is the same monthly trend (A21)
over a folder that grows.  Structured Streaming reads new files; each
micro-batch goes through ``foreachBatch``:

1. keep-first dedup inside the batch (the caller's order), then a left-anti
   join against the ids of earlier epochs, so an order id counts once in
   total (the first arrival wins, the streaming form of "first in file order");
2. the usual cleaning (required fields present, cancellations out);
3. per-month partial sums and the new (month, customer) pairs of the batch
   are written as an ``epoch=N`` partition.

Every write of epoch N overwrites only partition ``epoch=N`` and reads only
partitions ``< N``, so a replayed epoch (after a failure) gives the same
state.  ``monthly_trend()`` folds the partials exactly (decimal sums, counts,
distinct pairs) into the batch result's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from basketry.functions.dates import year_month
from basketry.functions.flags import not_value
from basketry.operators.dedup import keep_first
from basketry.plans.clean import REQUIRED_ORDER_FIELDS
from basketry.session import checkpoint_dir


class MonthlyTrendStream:
    def __init__(self, spark: SparkSession, state_dir: str | None = None,
                 order: list[str] | None = None):
        self.spark = spark
        self.root = (state_dir or f"{checkpoint_dir(spark).rstrip('/')}/basketry-stream").rstrip("/")
        self.order = order or ["order_date"]

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _earlier(self, name: str, epoch: int, schema: str) -> DataFrame:
        try:
            df = self.spark.read.parquet(self._path(name))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)  # nothing written yet
        return df.where(F.col("epoch") < epoch).drop("epoch")

    def _write(self, df: DataFrame, name: str, epoch: int) -> None:
        (df.withColumn("epoch", F.lit(epoch))
           .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("epoch").parquet(self._path(name)))

    def process(self, batch: DataFrame, epoch: int) -> None:
        ids_schema = f"order_id {dict(batch.dtypes)['order_id']}"
        first = keep_first(batch, "order_id", self.order)
        fresh = first.join(self._earlier("seen_ids", epoch, ids_schema), "order_id", "left_anti")
        fresh = fresh.persist()
        self._write(fresh.select("order_id"), "seen_ids", epoch)
        valid = (fresh.na.drop(how="any", subset=REQUIRED_ORDER_FIELDS)
                      .where(not_value("order_status", "Cancelled"))
                      .withColumn("year_month", year_month("order_date")))
        parts = valid.groupBy("year_month").agg(
            F.sum("total_amount").alias("revenue"), F.count("order_id").alias("orders"),
            F.count("total_amount").alias("amounts"))
        self._write(parts, "month_parts", epoch)
        cust_type = dict(batch.dtypes)["customer_id"]
        pairs = valid.select("year_month", "customer_id").distinct().join(
            self._earlier("month_customers", epoch, f"year_month string, customer_id {cust_type}"),
            ["year_month", "customer_id"], "left_anti")
        self._write(pairs, "month_customers", epoch)
        fresh.unpersist()

    def start(self, source_dir: str, schema, fmt: str = "parquet", trigger_once: bool = True,
              files_per_batch: int | None = None):
        reader = self.spark.readStream.schema(schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        if fmt == "csv":
            reader = reader.option("header", True)
        stream = reader.format(fmt).load(source_dir)
        w = (stream.writeStream.foreachBatch(self.process)
                   .option("checkpointLocation", self._path("_checkpoint")))
        w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
        return w.start()

    def monthly_trend(self) -> DataFrame:
        parts = self.spark.read.parquet(self._path("month_parts")).groupBy("year_month").agg(
            F.coalesce(F.sum("revenue"), F.lit(0)).cast("double").alias("revenue"),
            F.sum("orders").alias("orders"),
            (F.sum("revenue").cast("double") / F.sum("amounts")).alias("avg_order_value"))
        cust = self.spark.read.parquet(self._path("month_customers")).groupBy("year_month") \
                   .agg(F.count(F.lit(1)).alias("customers"))
        return (parts.join(cust, "year_month", "left")
                     .select("year_month", "revenue", "orders",
                             F.coalesce("customers", F.lit(0)).alias("customers"), "avg_order_value")
                     .orderBy("year_month"))
