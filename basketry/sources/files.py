"""Sinks and re-reads (S4-S8).

* ``write_table``  result table -> folder of CSV (header, no index) or parquet,
  replacing earlier output (every run overwrites, as the reference does)
* ``write_json``   1-row nested payload -> JSON (one small file)
* ``read_table`` / ``read_json``  read results back with the schema they were
  written with (parquet keeps it; CSV needs the caller's schema)
* ``write_results`` all named results of a run, one folder each
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    w = df.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(f"unknown format {fmt}")


def write_json(df: DataFrame, path: str) -> None:
    """Nested 1-row payloads: a single output file is bounded by construction."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    if fmt == "csv":
        r = spark.read.option("header", True)
        r = r.schema(schema) if schema is not None else r.option("inferSchema", True)
        return r.csv(path)
    return spark.read.parquet(path)


def read_json(spark: SparkSession, path: str, schema=None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.json(path)


def write_results(results: dict[str, DataFrame], out_dir: str, fmt: str = "parquet",
                  json_names: tuple = ()) -> dict[str, str]:
    """One folder per result: CSV/parquet, or JSON for nested results and
    for the names in ``json_names``."""
    paths = {}
    for name, df in results.items():
        p = f"{out_dir.rstrip('/')}/{name}"
        nested = any(t.startswith(("struct", "array", "map")) for _, t in df.dtypes)
        if name in json_names or (fmt == "csv" and nested):
            write_json(df, p)
        else:
            write_table(df, p, fmt)
        paths[name] = p
    return paths

