"""Published runs: versions, half-way runs, serving, and the choice of segments."""

import pytest

from basketry import run as job
from basketry.plans import segments as seg
from basketry.plans.stages import AnalyticsRun
from basketry.sources import published
from basketry.sources.tables import driver_tables
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def tables(spark, tag):
    plain = spark.createDataFrame([(1, "ü, \"q\"", None), (2, tag, 1.5)], "a int, b string, c double")
    nested = plain.groupBy().agg(F.collect_list("b").alias("bs"), F.map_from_arrays(F.lit(["k"]).cast("array<string>"), F.array(F.lit(1))).alias("m"))
    return {"plain": plain, "nested": nested}


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_tables_come_back_with_schema_and_counts(spark, tmp_path, fmt):
    published.publish(spark, tables(spark, "one"), str(tmp_path), fmt, ("nested",))
    run = published.latest(spark, str(tmp_path))
    assert {n: t["rows"] for n, t in run.tables.items()} == {"plain": 2, "nested": 1}
    want = tables(spark, "one")
    for name, df in want.items():
        assert run.table(name).schema.simpleString() == df.schema.simpleString()
    assert sorted(run.table("plain").collect()) == sorted(want["plain"].collect())
    assert run.table("nested").first().bs == want["nested"].first().bs


def test_a_run_that_ends_half_way_is_never_seen(spark, tmp_path):
    out = str(tmp_path)
    with pytest.raises(FileNotFoundError):
        published.latest(spark, out)
    published.publish(spark, tables(spark, "old"), out)
    before = published.latest(spark, out)

    def killed(name):
        raise KeyboardInterrupt(name)

    with pytest.raises(KeyboardInterrupt):
        published.publish(spark, tables(spark, "new"), out, written=killed)
    assert published.versions(spark, out) == [before.version] and len(list((tmp_path / "versions").iterdir())) == 2
    assert {r.b for r in published.latest(spark, out).table("plain").collect()} == {"ü, \"q\"", "old"}
    published.publish(spark, tables(spark, "newer"), out)
    assert {r.b for r in published.latest(spark, out).table("plain").collect()} == {"ü, \"q\"", "newer"}
    # who opened the older version still reads it
    assert {r.b for r in before.table("plain").collect()} == {"ü, \"q\"", "old"}


def test_a_finished_run_is_served(spark, tmp_path):
    out, shown = str(tmp_path / "run"), str(tmp_path / "shown")
    job.main(["--parquet", SF, "--out", out, "--n-init", "1", "--format", "parquet", "--dashboard"])
    job.main(["--from", out, "--dashboard", "--out", shown, "--format", "parquet", "--segments", seg.HIGH_VALUE, seg.NEW])
    first, second = published.latest(spark, out), published.latest(spark, shown)
    assert {"kpis", "growth_statements", "weekday_pattern", "segment_radar", "monthly_trend", "summary"} <= set(second.tables)
    for name in ("kpis", "weekday_pattern", "segment_sizes", "segment_box_stats", "customer_explorer"):
        assert sorted(map(repr, second.table(name).collect())) == sorted(map(repr, first.table(f"dashboard_{name}").collect()))
    for name in ("segment_radar", "segment_bars", "share_vs_customers", "segment_profile"):
        assert {r.segment for r in second.table(name).collect()} == {seg.HIGH_VALUE, seg.NEW}
        assert len({r.segment for r in first.table(f"dashboard_{name}").collect()}) == 5
    payload = second.table("summary").first()
    assert set(payload.asDict()) == {"eda_summary", "elbow_data", "cluster_mapping", "insights"}
    assert payload.elbow_data.k == [2, 3, 4, 5, 6, 7, 8] and len(payload.insights) == 7 and len(payload.cluster_mapping) == 5
    ins = first.table("business_insights").orderBy("n").collect()
    assert [r.n for r in ins] == list(range(1, 8))
    assert first.table("customer_features_segmented").count() == first.tables["customer_features"]["rows"]


def test_an_empty_choice_shows_nothing(spark):
    s = spark.createDataFrame([("a", 1.0, 2.0, 3.0, 4.0)], "segment string, " + ", ".join(f"{m} double" for m in seg.BAR_METRICS))
    assert seg.segment_bars(s, []).count() == 0 and seg.segment_bars(s).count() == 4


def test_audit_figures_come_from_the_writing_jobs(spark):
    from basketry.plans import clean
    p = AnalyticsRun(spark, driver_tables(spark, SF))
    key = lambda rows: sorted(map(tuple, rows))
    try:
        audit, loaded = p.cleaning_audit(), p.load_report()
        assert key(audit.collect()) == key(clean.cleaning_audit(p.t).collect())
        assert key(loaded.collect()) == key(clean.load_report(p.t).collect())
        assert "Scan parquet" not in audit._jdf.queryExecution().executedPlan().toString()
    finally:
        p.close()


RETRY = """
import os, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession, functions as F
from basketry.plans import clean
from basketry.plans.stages import AnalyticsRun
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.checkpoint.dir", sys.argv[2]) \\
    .config("spark.sql.shuffle.partitions", "4").config("spark.sql.adaptive.enabled", "false").getOrCreate()
marks = sys.argv[2]

def flaky(batches):
    from pyspark import TaskContext
    at = TaskContext.get()
    yield from batches
    if at.attemptNumber() == 0 and at.partitionId() % 2 == 0:
        open(os.path.join(marks, f"mark-{at.stageId()}-{at.partitionId()}"), "w").close()
        raise RuntimeError("first attempt fails after its rows")

class Run(AnalyticsRun):
    def __init__(self, spark):
        super().__init__(spark, None)

rows = spark.range(0, 1000, numPartitions=4).selectExpr("id % 700 AS k", "id AS v")
p = Run(spark)
from basketry.operators.dedup import keep_first
df = keep_first(rows, "k", ["v"], "_copies")
out = p.stage("t", df.mapInArrow(flaky, df.schema), metrics={"loaded": F.sum("_copies"), "kept": F.count(F.lit(1))}, helpers=("_copies",))
print("RESULT", p.metrics["t"], out.count(), len([f for f in os.listdir(marks) if f.startswith("mark-")]))
"""


def test_observed_figures_count_once_when_tasks_run_again(tmp_path):
    """A session of its own, whose master runs failed tasks again: every second task of the writing stage fails once."""
    import os
    import subprocess
    import sys
    script = tmp_path / "retry.py"
    script.write_text(RETRY)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    work = tmp_path / "shared"
    work.mkdir()
    done = subprocess.run([sys.executable, str(script), repo, str(work)], capture_output=True, text=True, timeout=300)
    line = next((x for x in done.stdout.splitlines() if x.startswith("RESULT")), done.stderr[-2000:])
    assert line == "RESULT {'loaded': 1000, 'kept': 700} 700 2", line
