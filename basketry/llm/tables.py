"""Input tables, shared-folder tables and small DataFrame helpers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from basketry.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read back: cuts lineage,
    survives lost executors, and is computed once."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
