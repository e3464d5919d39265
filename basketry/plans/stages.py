"""One analytics run: the shared intermediate tables, each built once.

Cleaned orders feed ~20 results and the customer feature table ~15 more, so
they are materialised once as parquet in the cluster's shared checkpoint
folder (``spark.checkpoint.dir``) and read back.  That cuts the lineage (a
lost executor re-reads files instead of re-running dedup and joins), and the
re-read gets parquet column pruning and filter pushdown for every downstream
query.  ``materialize=False`` keeps everything lazy (one plan per result).
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from basketry.operators.dedup import keep_first
from basketry.plans import clean, cube, eda, features, kmeans, segments, trends
from basketry.session import checkpoint_dir
from basketry.sources.schemas import CUSTOMER_COLUMNS
from basketry.sources.tables import Tables, driver_tables


#: a stage whose shuffles would hold all its rows is written in passes over this many bytes of its source files, in
#: at most so many passes (each reads the files again): the shuffle files of one pass are on disk at a time
PASS_BYTES = 16 << 20
PASSES = 8
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the jobs inside go as soon as each job ends; Spark keeps them until the driver collects garbage."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def source_bytes(df: DataFrame) -> int:
    """Bytes of the files a frame reads (0 for rows in memory)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    files = [leaves.apply(i) for i in range(leaves.size())]
    return sum(int(str(x.stats().sizeInBytes())) for x in files if x.getClass().getSimpleName() == "LogicalRelation")


def passes(df: DataFrame, key: str) -> list[Column]:
    """Conditions that deal the rows of ``df`` out to passes by their key; every row, also one without a key, meets one."""
    n = min(PASSES, max(1, source_bytes(df) // PASS_BYTES))
    # not the hash of Spark's shuffles, which are to use all partitions in every pass
    return [F.pmod(F.xxhash64(key), F.lit(n)) == i for i in range(n)] if n > 1 else [F.lit(True)]


class once(cached_property):
    """A property computed once per run, also when several threads ask for it."""

    def __get__(self, instance, owner=None):
        if instance is None:
            return self
        with instance.lock:
            return super().__get__(instance, owner)


class Segmented:
    """Segment results for one cluster assignment of the feature table."""

    def __init__(self, run: "AnalyticsRun", clustered: DataFrame, name: str):
        self.run = run
        self.clustered = clustered
        self.name = name
        self.lock = run.lock

    @once
    def profile(self) -> DataFrame:
        return segments.cluster_profile(self.clustered)

    @once
    def mapping(self) -> DataFrame:
        # k rows from an aggregate of the (staged) feature table: cheap to
        # recompute, evaluated once inside the staging of ``segmented``
        return segments.label_clusters(self.profile)

    @once
    def segmented(self) -> DataFrame:
        return self.run.stage(f"{self.name}_segmented",
                              segments.assign_segments(self.clustered, self.mapping))

    @once
    def summary(self) -> DataFrame:
        # one row per segment, aggregated from the staged segmented table
        return segments.segment_summary(self.segmented)


class AnalyticsRun:
    n_init = 10
    kmeans_engine = "batched"

    def __init__(self, spark: SparkSession, tables: Tables, materialize: bool = True,
                 run_id: str | None = None):
        self.spark = spark
        self.t = tables
        self.materialize = materialize
        self.run_id = run_id or uuid.uuid4().hex[:12]
        self._root = None
        #: re-entrant: a stage asks for the stages it is built from
        self.lock = threading.RLock()
        #: figures of the stages' own writing jobs, by stage
        self.metrics: dict[str, dict] = {}

    # -- storage ---------------------------------------------------------
    def _stage_path(self, name: str) -> str:
        if self._root is None:
            self._root = f"{checkpoint_dir(self.spark).rstrip('/')}/basketry-stages/{self.run_id}"
        return f"{self._root}/{name}"

    def stage(self, name: str, df: DataFrame, by: str | None = None, metrics: dict | None = None, helpers: tuple = (),
              parts: list[Column] | None = None) -> DataFrame:
        """``df`` without its ``helpers`` columns, written and read back (one folder per value of ``by``).  ``metrics`` are
        aggregates taken by the writing job itself, kept in ``self.metrics[name]``.  ``parts`` are conditions of which every row
        meets one: one writing job for each, whose metrics are added up."""
        if not self.materialize:
            return df.drop(*helpers)
        # unique per write: concurrent callers never share an output folder
        path = self._stage_path(f"{name}-{uuid.uuid4().hex[:8]}")
        found: dict[str, int] = {}
        out = df.drop(*helpers)
        for i, part in enumerate(parts or [F.lit(True)]):
            rows = df.where(part)
            seen = Observation() if metrics else None
            if seen is not None:
                rows = rows.observe(seen, *[c.alias(n) for n, c in metrics.items()])
            with shuffles_dropped(self.spark):
                rows.drop(*helpers).write.mode("append" if i else "overwrite").option("compression", "zstd") \
                    .partitionBy(*([by] if by else [])).parquet(path)
            if seen is not None:
                found = {n: v + found.get(n, 0) for n, v in seen.get.items()}
        if metrics:
            self.metrics[name] = found
        return self.spark.read.schema(out.schema).parquet(path).select(*out.columns)

    def close(self) -> None:
        """Release the KMeans cache and delete this run's stage folder (only
        ``basketry-stages/<run_id>``).
        Call once every result of the run has been written: staged frames
        read lazily from it."""
        seg = self.__dict__.get("segmentation")
        if seg is not None:
            seg.scaled.unpersist()
        if self._root is None:
            return
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self._root)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.delete(path, True)
        self._root = None
        # forget frames that read from the deleted folder; a later call builds anew
        for name, attr in vars(type(self)).items():
            if isinstance(attr, cached_property):
                self.__dict__.pop(name, None)
        with _RUNS_LOCK:
            for key in [k for k, v in _RUNS.items() if v is self]:
                del _RUNS[key]

    # -- cleaned tables ---------------------------------------------------
    @once
    def tables(self) -> Tables:
        """Source tables with the raw orders staged once as parquet: every raw dashboard query reads them,
        whether they are parsed text or a join of tables."""
        if not self.materialize:
            return self.t
        return replace(self.t, orders=self.stage("orders_raw", self.t.orders))

    @property
    def read_once(self) -> Tables:
        """Source tables for a job that reads the raw orders once: those of a columnar source are not written for it."""
        return self.t if self.t.columnar and "tables" not in self.__dict__ else self.tables

    @once
    def orders_dedup(self) -> DataFrame:
        source = self.read_once
        return self.stage("orders_dedup", clean.dedup_orders(source, "_copies"), metrics=clean.order_metrics("_copies"),
                          helpers=("_copies",), parts=passes(source.orders, "order_id"))

    @once
    def orders_flagged(self) -> DataFrame:
        return clean.flag_orders(self.orders_dedup)

    @once
    def orders_clean(self) -> DataFrame:
        return self.stage("orders_clean", clean.clean_from_flagged(self.orders_flagged))

    @once
    def customers_dedup(self) -> DataFrame:
        return self.stage("customers_dedup", keep_first(
            self.t.customers, "customer_id", self.t.customer_tiebreak, "_copies").select(*CUSTOMER_COLUMNS, "_copies"),
            metrics=clean.customer_metrics("_copies"), helpers=("_copies",))

    @once
    def customers_clean(self) -> DataFrame:
        return self.stage("customers_clean", clean.clean_from_dedup(self.customers_dedup))

    @once
    def web_features(self) -> DataFrame:
        """Session features per customer (a null customer's sessions are only counted)."""
        return self.stage("web_features", features.web_features(self.t.sessions, "_rows"),
                          metrics={"rows_loaded": F.coalesce(F.sum("_rows"), F.lit(0))}, helpers=("_rows",)).where(F.col("customer_id").isNotNull())

    def cleaning_audit(self) -> DataFrame:
        """Audit rows from the figures of the cleaning stages."""
        if not self.materialize:
            return clean.cleaning_audit(self.t, self.orders_dedup, self.customers_dedup)
        _ = self.orders_dedup, self.customers_dedup
        return clean.audit_rows(self.spark, self.metrics["customers_dedup"], self.metrics["orders_dedup"])

    def load_report(self) -> DataFrame:
        """(table_name, rows) from the figures of the stages that read a source; the products, which no stage reads, are counted."""
        if not self.materialize:
            return clean.load_report(self.t)
        _ = self.orders_dedup, self.customers_dedup, self.web_features
        seen = {"customers": "customers_dedup", "orders": "orders_dedup", "sessions": "web_features"}
        rows = [(t, self.metrics[s]["rows_loaded"]) for t, s in seen.items()] + [("products", self.t.products.count())]
        return self.spark.createDataFrame(rows, "table_name string, rows long")

    @once
    def orders_valid(self) -> DataFrame:
        """Dashboard view: raw rows (no dedup), cancellations removed."""
        return clean.valid_raw_orders(self.tables)

    @once
    def dashboard_series(self) -> DataFrame:
        """Revenue and orders of ``trends.dashboard_monthly_trend``, for both series of the growth figures."""
        trend = trends.dashboard_monthly_trend(clean.valid_raw_orders(self.read_once))
        return self.stage("dashboard_series", trend.select("year_month", "revenue", "orders"))

    # -- features and summaries ---------------------------------------------
    @once
    def customer_orders(self) -> DataFrame:
        """One row per customer, from one scan of the clean orders."""
        return self.stage("customer_orders", features.customer_orders(self.orders_clean))

    @once
    def features(self) -> DataFrame:
        return self.stage("customer_features", features.customer_features(
            self.customer_orders, self.web_features, self.customers_clean))

    @once
    def monthly(self) -> DataFrame:
        return trends.monthly_trend(self.orders_clean)

    @once
    def cube(self) -> DataFrame:
        """Sums of all calendar grains from one scan of the clean orders."""
        return self.stage("calendar_cube", cube.grouped(self.orders_clean, cube.SETS), by="grain")

    @once
    def customer_bitmaps(self) -> DataFrame:
        return self.stage("customer_bitmaps", cube.month_bitmaps(self.cube, "month_customer", cube.SETS, self.stage))

    @once
    def raw_cube(self) -> DataFrame:
        return self.stage("raw_cube", cube.grouped(cube.raw_view(self.orders_valid), cube.RAW_SETS), by="grain")

    @once
    def raw_bitmaps(self) -> dict[str, DataFrame]:
        return {n: self.stage(f"raw_{n}_bitmaps", cube.month_bitmaps(self.raw_cube, f"month_{n}", cube.RAW_SETS, self.stage))
                for n in ("customer", "order")}

    @once
    def kpis(self) -> DataFrame:
        return eda.kpis(self.orders_clean)

    @once
    def revenue_by_category(self) -> DataFrame:
        return eda.revenue_by_category(self.orders_clean)

    # -- segments -------------------------------------------------------------
    @once
    def fixed(self) -> Segmented:
        """Segments from the deterministic fixture cluster column (customer_id % 5)."""
        return Segmented(self, segments.fixed_clusters(self.features, 5), "fixed")

    @once
    def documented(self) -> Segmented:
        """Segments from four Lloyd steps from the documented centres (``kmeans.fixed_centers``)."""
        scaled = kmeans.with_scaled(self.features)
        return Segmented(self, kmeans.renumbered(scaled, kmeans.fit_from(scaled, kmeans.fixed_centers(5), 4)), "documented")

    @once
    def segmentation(self) -> kmeans.Segmentation:
        return kmeans.Segmentation(self.spark, self.features, n_init=self.n_init,
                                   stage=self.stage if self.materialize else None,
                                   engine=self.kmeans_engine)

    @once
    def kmeans(self) -> Segmented:
        """Segments from the final KMeans model (canonical cluster numbering)."""
        return Segmented(self, self.segmentation.clustered(), "kmeans")


_RUNS: dict[tuple, AnalyticsRun] = {}
_RUNS_LOCK = threading.Lock()


def _state(spark: SparkSession, folder: str) -> tuple:
    """Names, sizes and times of the folder's entries, whatever store it is in."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((e.getPath().getName(), e.getLen(), e.getModificationTime()) for e in fs.listStatus(path)))


def run_for(spark: SparkSession, sf_dir: str, materialize: bool = True) -> AnalyticsRun:
    """One run per (application, data folder, state of its tables): queries registered by name
    share its intermediates within a session, until a table is written again."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _state(spark, sf_dir), materialize)
    with _RUNS_LOCK:
        run = _RUNS.get(key)
        if run is None:
            run = AnalyticsRun(spark, driver_tables(spark, sf_dir), materialize=materialize)
            _RUNS[key] = run
    return run
