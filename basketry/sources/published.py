"""Results of a run, published all at once and read back (S4-S8).

Every run writes into a folder of its own, ``OUT/versions/VERSION/TABLE``; versions sort by time.  The
manifest (tables, formats, schemas, row counts) is written last, under another name, and renamed: a version counts from then
on.  Readers take the newest version that has a manifest, so a run that ends half way, or is still writing, is
never seen, and a running reader keeps the version it opened.  Row counts are taken from the
writing jobs themselves.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "manifest.json"


def _fs(spark: SparkSession, path: str):
    """(Hadoop file system, path): whatever store the folder is in."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _put(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    fs, target = _fs(spark, path)
    _, draft = _fs(spark, f"{path}.{uuid.uuid4().hex[:8]}")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(draft, target):
        raise OSError(f"cannot publish {path}")


def new_version() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%fZ") + "-" + uuid.uuid4().hex[:6]


def publish(spark: SparkSession, results: dict[str, DataFrame], out_dir: str, fmt: str = "parquet", json_names: tuple = (),
            written: Callable[[str], None] | None = None) -> str:
    """Write all results as a new version; its folder.  CSV can't hold nested results: those, and ``json_names``, are JSON."""
    version = new_version()
    root = f"{out_dir.rstrip('/')}/versions/{version}"
    tables = {}
    for name, df in results.items():
        nested = any(t.startswith(("struct", "array", "map")) for _, t in df.dtypes)
        kind = "json" if name in json_names or (fmt == "csv" and nested) else fmt
        seen = Observation()
        w = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        w = w.coalesce(1).write if kind == "json" else w.write
        (w.option("header", True) if kind == "csv" else w).format(kind).save(f"{root}/{name}")
        tables[name] = {"format": kind, "schema": json.loads(df.schema.json()), "rows": seen.get["rows"]}
        if written:
            written(name)
    _put(spark, f"{root}/{MANIFEST}", json.dumps({"version": version, "tables": tables}, sort_keys=True))
    return root


class Published:
    """One complete version."""

    def __init__(self, spark: SparkSession, root: str, manifest: dict):
        self.spark, self.root = spark, root
        self.version, self.tables = manifest["version"], manifest["tables"]

    def table(self, name: str) -> DataFrame:
        """The table with the schema it was written with."""
        t = self.tables[name]
        r = self.spark.read.schema(T.StructType.fromJson(t["schema"]))
        return (r.option("header", True) if t["format"] == "csv" else r).format(t["format"]).load(f"{self.root}/{name}")


def versions(spark: SparkSession, out_dir: str) -> list[str]:
    """Complete versions, oldest first."""
    fs, top = _fs(spark, f"{out_dir.rstrip('/')}/versions")
    if not fs.exists(top):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(top) if s.isDirectory())
    return [n for n in names if fs.exists(_fs(spark, f"{out_dir.rstrip('/')}/versions/{n}/{MANIFEST}")[1])]


def latest(spark: SparkSession, out_dir: str) -> Published:
    """The newest complete version."""
    found = versions(spark, out_dir)
    if not found:
        raise FileNotFoundError(f"no complete version in {out_dir}")
    root = f"{out_dir.rstrip('/')}/versions/{found[-1]}"
    text = "\n".join(r.value for r in spark.read.option("wholetext", True).text(f"{root}/{MANIFEST}").collect())
    return Published(spark, root, json.loads(text))
