"""Fixed-point text against Python's own formatting."""

import random

from pyspark.sql import functions as F

from basketry.plans.insights import fixed


def test_as_python_formats(spark):
    rng = random.Random(6)
    xs = [0.35, 0.25, 0.45, 0.05, 0.15, 2.5, 3.5, 0.5, 1.5, 1e-9, 0.0, -0.0, -0.35, -0.25, 99.95, 1234567.25, 0.95, 9.949999999999999, 9.95]
    xs += [round(rng.random() * 100, 2) for _ in range(2000)] + [rng.random() * 10 ** rng.randint(-3, 9) for _ in range(2000)]
    xs += [n / 20 for n in range(0, 4000)] + [None]
    rows = spark.createDataFrame([(x,) for x in xs], "x double").select("x", fixed("x", 0).alias("a"), fixed("x", 1).alias("b")).collect()
    for r in rows:
        assert (r.a, r.b) == ((None, None) if r.x is None else (f"{r.x:.0f}", f"{r.x:.1f}")), r
