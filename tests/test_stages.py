"""Shared stages: one write also from several threads, and a new run when a table is written again."""

import shutil
from concurrent.futures import ThreadPoolExecutor

from basketry.plans.stages import AnalyticsRun, run_for
from basketry.sources.tables import driver_tables

SF = "/root/testdata/sf0.001"


def test_threads_share_one_stage(spark):
    p = AnalyticsRun(spark, driver_tables(spark, SF))
    written = []
    stage = p.stage
    p.stage = lambda name, *a, **kw: written.append(name) or stage(name, *a, **kw)
    try:
        with ThreadPoolExecutor(4) as pool:
            frames = list(pool.map(lambda _: p.customers_clean, range(4)))
        assert len({id(f) for f in frames}) == 1 and sorted(written) == ["customers_clean", "customers_dedup"]
    finally:
        p.close()


def test_a_rewritten_table_gives_a_new_run(spark, tmp_path):
    folder = f"{tmp_path}/sf"
    shutil.copytree(SF, folder)
    first = run_for(spark, folder)
    assert run_for(spark, folder + "/") is first
    events = spark.read.parquet(f"{SF}/events.parquet").limit(10)
    events.coalesce(1).write.parquet(f"{tmp_path}/fewer")
    before = first.t.sessions.count()
    shutil.copy(next(tmp_path.glob("fewer/part-*.parquet")), f"{folder}/events.parquet")
    second = run_for(spark, folder)
    assert second is not first
    assert second.t.sessions.count() == 10 < before
