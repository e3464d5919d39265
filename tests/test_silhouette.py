"""Euclidean silhouette by cell trees against all pairs."""

import numpy as np
import pytest

from basketry.operators import silhouette as S


def brute(X, y, squared=False):
    n = np.bincount(y)
    d = ((X[:, None] - X[None]) ** 2).sum(axis=2)
    d = d if squared else np.sqrt(d)
    sums = np.stack([d[:, y == j].sum(axis=1) for j in range(len(n))], axis=1)
    at = np.arange(len(X))
    a = sums[at, y] / np.maximum(n[y] - 1, 1)
    others = np.where(n > 0, sums / np.maximum(n, 1), np.inf)
    others[at, y] = np.inf
    b = others.min(axis=1)
    return float(np.where((n[y] > 1) & (np.maximum(a, b) > 0), (b - a) / np.where(np.maximum(a, b) > 0, np.maximum(a, b), 1), 0).mean())


def frame(spark, X, *labels):
    d = X.shape[1]
    rows = [(*map(float, x), *map(int, y)) for x, y in zip(X, zip(*labels))]
    return spark.createDataFrame(rows, ", ".join([*[f"x{i} double" for i in range(d)], *[f"k{i} int" for i in range(len(labels))]])).repartition(4)


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(2)
    X = np.concatenate([rng.normal(m, s, (500, 5)) for m, s in ((0, 1), (2, 0.5), (5, 2), (1, 1))])
    return X, rng.integers(0, 3, 2000), (X[:, 0] > 1).astype(int), np.minimum((np.abs(X).sum(axis=1) / 4).astype(int), 6)


def test_two_thousand_points_within_the_stated_error(spark, cloud):
    X, *labels = cloud
    df = frame(spark, X, *labels)
    want = [brute(X, y) for y in labels]
    args = (df, [f"x{i}" for i in range(5)], ["k0", "k1", "k2"])
    for s, w, y in zip(S.euclidean_silhouettes(*args, tolerance=0.0), want, labels):
        assert s.error < 1e-9 and abs(s.silhouette - w) < 1e-9
        assert abs(s.squared - brute(X, y, squared=True)) < 1e-9
    errors = []
    for cells, tolerance in ((4096, 0.002), (256, 0.002), (64, 0.05)):
        got = S.euclidean_silhouettes(*args, cells=cells, tolerance=tolerance)
        for s, w in zip(got, want):
            assert abs(s.silhouette - w) <= s.error + 1e-12
        errors.append(max(s.error for s in got))
    assert errors[0] < errors[1] < errors[2] < 0.5


def test_far_cells_are_taken_whole(cloud):
    X = np.concatenate([cloud[0][:500] * 0.01, cloud[0][:500] * 0.01 + 50.0])
    n = len(X)
    code = S.morton(X, X.min(axis=0), X.max(axis=0))
    X = X[np.argsort(code)]
    tree = S.build_tree(np.zeros(n, int), np.zeros(n, int), np.arange(n), np.ones(n), X, (X * X).sum(axis=1))
    nodes = S.visit(tree, X[:64], 0.002)
    assert len(nodes) < n / 2 and abs(tree.n[nodes].sum() - n) < 1e-9
    assert len(S.visit(tree, X[:64], 0.0)) == n


def test_single_members_single_clusters_copies_and_empty_tables(spark):
    X = np.array([[0.0, 0.0], [0.0, 0.0], [1.0, 0.0], [5.0, 5.0], [5.0, 6.0], [9.0, 9.0]])
    y, one, gap = [0, 0, 0, 1, 1, 2], [0] * 6, [0, 0, 0, 4, 4, 4]
    got = S.euclidean_silhouettes(frame(spark, X, y, one, gap), ["x0", "x1"], ["k0", "k1", "k2"], tolerance=0.0)
    assert abs(got[0].silhouette - brute(X, np.array(y))) < 1e-9
    assert got[1].silhouette is None
    assert abs(got[2].silhouette - brute(X, np.array(gap))) < 1e-9
    assert S.euclidean_silhouettes(frame(spark, X, y).limit(0), ["x0", "x1"], ["k0"]) == [S.Score(None, None, 0)]
    same = S.euclidean_silhouettes(frame(spark, np.zeros((4, 2)), [0, 0, 1, 1]), ["x0", "x1"], ["k0"])[0]
    assert same.silhouette == 0.0 and same.error == 0.0


def test_all_pairs_are_measured_at_any_number_of_points(spark, cloud):
    # more points than cells, in several blocks, and copies that are one point
    X, *labels = cloud
    df = frame(spark, X, *labels)
    for s, y in zip(S.euclidean_silhouettes(df, [f"x{i}" for i in range(5)], ["k0", "k1", "k2"], cells=64, tolerance=0.0), labels):
        assert s.points == len(X) and s.error == 0.0 and abs(s.silhouette - brute(X, y)) < 1e-9
    rng = np.random.default_rng(3)
    X = np.concatenate([rng.normal(m, 1, (1500, 2)) for m in (0, 3, 4)] + [np.full((700, 2), 2.5)])
    y = np.minimum((np.abs(X).sum(axis=1)).astype(int), 4)
    got = S.euclidean_silhouettes(frame(spark, X, y), ["x0", "x1"], ["k0"], tolerance=0.0)[0]
    assert len(X) > S.CELLS and abs(got.silhouette - brute(X, y)) < 1e-9 and abs(got.squared - brute(X, y, squared=True)) < 1e-9


def test_cells_hold_one_point_while_the_points_not_the_rows_are_few(spark):
    # all points of a clump are in one place of the curve
    rng = np.random.default_rng(4)
    X = np.concatenate([rng.normal(0, 1e-5, (100, 5)), 1.0 + rng.normal(0, 1e-5, (100, 5))])
    y = rng.integers(0, 2, 200)
    for copies in (1, 2):
        X2, y2 = np.repeat(X, copies, axis=0), np.repeat(y, copies)
        got = S.euclidean_silhouettes(frame(spark, X2, y2), [f"x{i}" for i in range(5)], ["k0"], cells=256, tolerance=1e-12)[0]
        assert got.error < 1e-9 and abs(got.silhouette - brute(X2, y2)) < 1e-9


def test_near_points_far_from_the_origin_keep_their_distance():
    rng = np.random.default_rng(5)
    X = 1e3 + np.concatenate([rng.normal(0, 1e-4, (50, 3)), rng.normal(0, 10, (50, 3))])
    want = np.sqrt(((X[:, None] - X[None]) ** 2).sum(axis=2))
    assert np.abs(S.distances(X, X) - want).max() < 1e-9 and (np.diag(S.distances(X, X)) == 0).all()
