"""Top-k search against all distances: several words, groups, far queries, choice of width."""

import random
from math import comb

import pytest

from basketry.llm import hamming


def _brute(rows, k, every):
    codes = {(i, tuple(x > 0 for x in v)) for i, v in rows}
    out = set()
    for q, c in codes:
        if q % every:
            continue
        best = sorted((sum(a != b for a, b in zip(c, d)), i) for i, d in codes if i != q and len(c) == len(d))[:k]
        out |= {(q, r, i, d) for r, (d, i) in enumerate(best, 1)}
    return out


def _rows(dims, n, seed):
    """A third of the rows are one code, some lie near a centre, one query is far from all others."""
    rng = random.Random(seed)
    centre = [rng.choice([-1.0, 1.0]) for _ in range(dims)]
    rows = []
    for i in range(n):
        if i % 3 == 1:
            v = list(centre)
        elif i % 3 == 2:
            v = [-x if rng.random() < 0.1 else x for x in centre]
        else:
            v = [rng.choice([-1.0, 1.0]) for _ in range(dims)]
        rows.append((i, v))
    rows[0] = (0, [-x for x in centre])
    return rows


def _got(spark, rows, k, every):
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return {(r.query_id, r.rank, r.vec_id, r.distance) for r in hamming.top_k(t, k, every).collect()}


@pytest.mark.parametrize("dims", [64, 128, 130])
def test_all_distances(spark, dims):
    rows = _rows(dims, 600, dims)
    assert _got(spark, rows, 5, 50) == _brute(rows, 5, 50)


def test_far_queries_go_on_in_narrower_segments(spark, monkeypatch):
    monkeypatch.setattr(hamming, "MASKS", 30)
    monkeypatch.setattr(hamming, "choose_width", lambda *a: 16)
    assert comb(16, 2) > hamming.MASKS
    rows = _rows(64, 300, 7)
    assert _got(spark, rows, 5, 50) == _brute(rows, 5, 50)


def test_fewer_rows_than_k(spark):
    rows = _rows(70, 6, 3)
    assert _got(spark, rows, 10, 2) == _brute(rows, 10, 2)


def test_width_grows_slowly_and_never_asks_too_much():
    rng = random.Random(1)
    sample = [[rng.getrandbits(64) - 2 ** 63] for _ in range(hamming.SAMPLE)]
    widths = [hamming.choose_width(sample, 64, n, 10, 100) for n in (10 ** 3, 10 ** 4, 10 ** 5, 10 ** 6, 10 ** 7)]
    assert widths == sorted(widths) and widths[0] < widths[-1]
    assert hamming.choose_width([], 64, 0, 10, 100) == hamming.choose_width([[1]], 64, 1, 10, 100) == hamming.WIDTHS[0]
