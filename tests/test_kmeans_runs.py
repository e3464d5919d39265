"""Batched KMeans: bounds, relocation of empty clusters, init, against plain numpy."""

import numpy as np
import pytest

from basketry.operators import multikmeans as mk


def points(spark, X, parts=3):
    rows = [(i, *map(float, x)) for i, x in enumerate(X)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"c{d} double" for d in range(X.shape[1]))).repartition(parts)
    return mk.prepare(df, "id", [f"c{d}" for d in range(X.shape[1])])


def numpy_lloyd(X, C, steps):
    for _ in range(steps):
        d = ((X[:, None] - C[None]) ** 2).sum(axis=2)
        lab, low = d.argmin(axis=1), d.min(axis=1)
        total = np.array([X[lab == j].sum(axis=0) for j in range(len(C))])
        n = np.bincount(lab, minlength=len(C))
        empty = np.flatnonzero(n == 0)
        if len(empty) and low.max() > 0:
            for j, i in zip(empty, np.argsort(-low, kind="stable")):
                total[lab[i]] -= X[i]
                n[lab[i]] -= 1
                total[j], n[j] = X[i], 1
        C = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], C)
    return C


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(4)
    return np.concatenate([rng.normal(m, 1.0, (700, 4)) for m in (0, 3, 6)])


def test_bounds_skip_most_points_and_change_nothing(spark, cloud):
    pts = points(spark, cloud)
    report, plain = mk.FitReport(), mk.FitReport()
    a = mk.fit_runs(pts, mk.make_runs([2, 3, 5, 7], 3, 1), report=report)
    b = mk.fit_runs(pts, mk.make_runs([2, 3, 5, 7], 3, 1), report=plain, keep_skipping=2.0)
    for x, y in zip(a, b):
        assert np.allclose(x.centers, y.centers, atol=1e-9) and x.n_iter == y.n_iter and abs(x.inertia - y.inertia) < 1e-6 * y.inertia
    assert plain.bound_passes == 0 and plain.measured == plain.pairs == report.pairs
    assert report.bound_passes > report.full_passes and report.measured < 0.6 * report.pairs


def test_steps_are_those_of_plain_lloyd(spark, cloud):
    start = cloud[[0, 5, 900, 1500]]
    run = mk.fit_runs(points(spark, cloud), [mk.Run(k=4, seed=0, centers=start.tolist())], max_iter=9, tol=-1.0)[0]
    assert run.n_iter == 9 and np.allclose(run.centers, numpy_lloyd(cloud, start, 9), atol=1e-9)


def test_emptied_clusters_move_to_the_farthest_points(spark):
    rng = np.random.default_rng(9)
    X = np.concatenate([rng.normal(0, 0.1, (200, 2)), np.tile([5.0, 5.0], (100, 1)), rng.normal((0, 9), 0.1, (50, 2))])
    # repeated start centres: all but the first of them get no points
    start = np.array([[5.0, 5.0], [5.0, 5.0], [5.0, 5.0], [0.0, 0.0]])
    run = mk.Run(k=4, seed=0, centers=start.tolist())
    mk.lloyd_step(points(spark, X), [run], [0])
    assert np.allclose(run.centers, numpy_lloyd(X, start, 1), atol=1e-9)
    fit = mk.fit_runs(points(spark, X), [mk.Run(k=4, seed=0, centers=start.tolist())])[0]
    lab = ((X[:, None] - np.array(fit.centers)[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert len(set(lab.tolist())) == 4


def test_fewer_distinct_points_than_clusters(spark):
    X = np.array([[1.0, 1.0]] * 30 + [[2.0, 2.0]] * 30)
    runs = mk.fit_runs(points(spark, X), mk.make_runs([2, 4], 2, 3))
    assert all(r.inertia == 0.0 and len(r.centers) == r.k for r in runs)


def test_no_points(spark):
    assert [r.centers for r in mk.fit_runs(points(spark, np.zeros((1, 2))).limit(0), mk.make_runs([2], 1, 0))] == [[]]


def test_points_of_one_file_are_dealt_out(spark):
    n = 3 * mk.BLOCK
    df = spark.range(0, n, 1, 1).selectExpr("id", "cast(id AS double) AS c0")
    blocks = mk.pack(mk.prepare(df, "id", ["c0"]))
    sizes = blocks.mapPartitions(lambda it: [sum(len(h) for h, _ in it)]).collect()
    blocks.unpersist()
    assert sum(sizes) == n and sum(s > 0 for s in sizes) > 1
