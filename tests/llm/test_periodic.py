"""Periodic runs against every lag of every document."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from basketry.llm import periodic
from basketry.llm.queries import QUERIES
from tests.llm.test_repeats import words_of


def brute(x, min_words=6, min_times=4):
    """Maximal stretches per lag, those with a smaller period left out."""
    ids = np.unique(np.array(x), return_inverse=True)[1].reshape(-1) if len(x) else np.zeros(0, int)
    out = []
    for q in range(1, len(x) // min_times + 1):
        same = np.concatenate(([False], ids[:-q] == ids[q:], [False]))
        turn = np.flatnonzero(np.diff(same.astype(int)))
        for s, e in zip(turn[::2].tolist(), turn[1::2].tolist()):
            y = ids[s:e + q]
            if len(y) >= max(min_words, min_times * q) and not any((y[:-d] == y[d:]).all() for d in range(1, q)):
                out.append((s, len(y), q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def ids_of(x):
    number = {}
    return np.array([number.setdefault(v, len(number)) for v in x], dtype=np.int64)


@pytest.mark.parametrize("min_words,min_times", [(6, 4), (3, 3), (20, 4), (1, 3), (9, 5)])
def test_against_every_lag(min_words, min_times):
    rng = random.Random(min_words)
    for _ in range(1500):
        letters = rng.choice([1, 2, 3, 5])
        x = [rng.randrange(letters) for _ in range(rng.randint(0, 60))]
        k, b = rng.randint(0, len(x)), [rng.randrange(letters) for _ in range(rng.randint(1, 12))]
        x[k:k] = (b * 8)[:rng.randint(0, 70)]
        assert [tuple(r) for r in periodic.word_runs(ids_of(x), min_words, min_times).tolist()] == brute(x, min_words, min_times)


def test_long_periods_and_long_runs():
    rng = random.Random(8)
    part = [rng.randrange(40) for _ in range(900)]
    x = [rng.randrange(40) for _ in range(500)] + part * 4 + part[:77] + [3] * 1000 + [rng.randrange(40) for _ in range(50)]
    assert [tuple(r) for r in periodic.word_runs(ids_of(x)).tolist()] == brute(x)
    assert periodic.word_runs(np.zeros(100_000, dtype=np.int64)).tolist() == [[0, 100_000, 1]]
    assert periodic.word_runs(np.arange(100_000) % 20_000).tolist() == [[0, 100_000, 20_000]]


def test_too_few_repeats_are_refused():
    with pytest.raises(ValueError):
        periodic.word_runs(np.zeros(3, dtype=np.int64), min_times=2)


def test_texts_nulls_and_clashing_columns(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "a " * 6), (4, "a " * 6), (None, "x a b a b a b a b y"), (5, "é ü\n" * 20_000), (6, "one two three")]
    df = spark.createDataFrame([(i, t, "c", 0) for i, t in rows], "doc_id long, text string, runs string, words int")
    out = periodic.find_runs(df)
    assert out.columns == ["doc_id", "text", "words", "runs", "collapsed"]
    got = sorted(((r.doc_id, r.text, r.words, [tuple(x) for x in r.runs], r.collapsed) for r in out.collect()), key=repr)
    want = [(1, None, 0, [], ""), (2, "", 0, [], ""), (3, " \t", 0, [], ""), (4, "a " * 6, 6, [(0, 6, 1)], "a"), (4, "a " * 6, 6, [(0, 6, 1)], "a"),
            (None, "x a b a b a b a b y", 10, [(1, 8, 2)], "x a b y"), (5, "é ü\n" * 20_000, 40_000, [(0, 40_000, 2)], "é ü"),
            (6, "one two three", 3, [], "one two three")]
    assert got == sorted(want, key=repr)
    assert periodic.find_runs(df.limit(0)).count() == 0


def test_query_on_the_tables(spark):
    sf = "/root/testdata/sf0.001"
    want = []
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        w, h = words_of(r.text), zlib.crc32(str(r.doc_id).encode())
        n, g = len(w), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        runs = brute(w)
        drop = {i for s, k, q in runs for i in range(s + q, s + k)}
        best = min(runs, key=lambda x: (-x[1], x[0], x[2])) if runs else (None, None, None)
        want.append((r.doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     hashlib.sha256("".join(f"{s},{k},{q}\n" for s, k, q in runs).encode()).hexdigest(),
                     hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest()))
    got = [tuple(r) for r in QUERIES["op13_periodic_runs"](spark, sf).collect()]
    assert sorted(got) == sorted(want)
    assert sum(x[1] > 0 for x in want) > 10
