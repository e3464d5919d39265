"""Named queries: ``name -> callable(spark, sf_dir) -> DataFrame``.

Every query reads the driver test tables of ``sf_dir`` (through the shared
``AnalyticsRun`` of that folder); the matching DuckDB statement lives in
``basketry.oracle``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            from basketry.plans.stages import run_for
            return fn(run_for(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn
    return deco


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import basketry.queries  # noqa: F401  (registers everything)
    return dict(QUERIES)
