"""KMeans path: planted blobs are recovered; inertia falls with k."""

import random

from pyspark.sql import functions as F

from basketry.plans import kmeans, segments


def _blobs(spark, k=5, n=60, seed=11):
    random.seed(seed)
    centers = [(i * 10.0, (i % 2) * 10.0) for i in range(k)]
    rows = []
    for c, (x, y) in enumerate(centers):
        for j in range(n):
            rows.append((f"{c}-{j}", c, x + random.gauss(0, 0.5), y + random.gauss(0, 0.5)))
    return spark.createDataFrame(rows, "customer_id string, truth int, a double, b double")


def test_blobs_recovered_and_inertia_monotone(spark):
    df = _blobs(spark)
    from pyspark.ml.feature import VectorAssembler
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).cache()
    models = kmeans.fit_best_many(data, [2, 3, 4, 5, 6], n_init=3)
    pred = models[5].transform(data)
    pairs = pred.groupBy("truth").agg(F.countDistinct("cluster").alias("n")).collect()
    assert all(r.n == 1 for r in pairs)
    assert pred.select("cluster").distinct().count() == 5
    costs = [models[k].summary.trainingCost for k in [2, 3, 4, 5, 6]]
    assert all(b <= a * 1.0001 for a, b in zip(costs, costs[1:]))


def test_standardize_uses_population_std(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0)], "customer_id string, recency_days double")
    for c in kmeans.CLUSTER_FEATURES[1:]:
        df = df.withColumn(c, F.lit(2.0))
    out = {r.customer_id: r for r in kmeans.standardize(df).collect()}
    assert out["a"].recency_days == -1.0 and out["b"].recency_days == 1.0
    assert out["a"].frequency == 0.0   # constant column -> 0


def test_canonical_renumbering_orders_by_spend(spark):
    from basketry.plans.stages import AnalyticsRun
    from basketry.sources.tables import driver_tables
    p = AnalyticsRun(spark, driver_tables(spark, "/root/testdata/sf0.001"))
    p.n_init = 2
    seg = p.segmentation
    clustered = seg.clustered()
    means = clustered.groupBy("cluster").agg(F.avg("monetary").alias("m")).orderBy("cluster").collect()
    assert [r.cluster for r in means] == list(range(5))
    assert all(a.m >= b.m for a, b in zip(means, means[1:]))
    mapping = segments.label_clusters(segments.cluster_profile(clustered)).collect()
    assert len(mapping) == 5


def test_batched_runs_recover_blobs_and_match_single_runs(spark):
    from basketry.operators import multikmeans as mk
    df = _blobs(spark)
    pts = mk.prepare(df, "customer_id", ["a", "b"]).cache()
    runs = mk.fit_runs(pts, mk.make_runs([3, 5], n_init=3, seed=7))
    best = mk.best_per_k(runs)
    pred = df.withColumn("cluster", kmeans.predict_expr(best[5].centers, ["a", "b"]))
    pairs = pred.groupBy("truth").agg(F.countDistinct("cluster").alias("n")).collect()
    assert all(r.n == 1 for r in pairs)
    assert pred.select("cluster").distinct().count() == 5
    # inertia is the sum of squared distances to the final centres
    c = best[5].centers
    rows = df.collect()
    brute = sum(min((r.a - x) ** 2 + (r.b - y) ** 2 for x, y in c) for r in rows)
    assert abs(best[5].inertia - brute) < 1e-6 * brute
    assert best[3].inertia > best[5].inertia


def test_batched_and_ml_engines_agree_on_blobs(spark):
    from pyspark.ml.feature import VectorAssembler

    from basketry.operators import multikmeans as mk
    df = _blobs(spark, k=4, n=50, seed=3)
    pts = mk.prepare(df, "customer_id", ["a", "b"]).cache()
    batched = mk.best_per_k(mk.fit_runs(pts, mk.make_runs([4], n_init=3, seed=1)))[4].inertia
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df).cache()
    ml = kmeans.fit_best_many(data, [4], n_init=3, seed=1)[4].summary.trainingCost
    assert abs(batched - ml) <= 1e-6 * ml
