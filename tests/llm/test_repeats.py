"""Substring dedup against all windows, over several window lengths and chunk sizes."""

import hashlib
import random

import numpy as np
import pytest

from basketry.llm import repeats
from basketry.llm.queries import QUERIES

SPACES = " \t\n\x0b\x0c\r"


def words_of(text):
    out = (text or "")
    for c in SPACES:
        out = out.replace(c, " ")
    return [w for w in out.split(" ") if w]


def brute(rows, window):
    """(id, text) -> per row the removed flags."""
    first = {}
    for i, t in rows:
        w = words_of(t)
        for s in range(len(w) - window + 1):
            if i is not None:
                k = tuple(w[s:s + window])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, t in rows:
        w = words_of(t)
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            f = first.get(tuple(w[s:s + window]))
            if f is not None and (i is None or f < i):
                gone[s:s + window] = [True] * window
        out.append((i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return sorted(out, key=repr)


def found(df):
    rows = df.collect()
    for r in rows:
        assert sum(s.end - s.begin for s in r.spans) == r.removed
    return sorted([(r.doc_id, r.words, r.removed, r.kept) for r in rows], key=repr)


def made_up(rng, n, vocab, longest):
    rows = []
    for i in range(n):
        w = [rng.choice(vocab) for _ in range(rng.randint(0, longest))]
        for _ in range(rng.randint(0, 3)):
            if rows:
                other = words_of(rng.choice(rows)[1])
                a = rng.randint(0, len(other))
                at = rng.randint(0, len(w))
                w[at:at] = other[a:a + rng.randint(0, 60)]
        rows.append((rng.choice([i, i, i, rng.randint(0, n), None]), rng.choice([" ", "\n", " \t "]).join(w)))
    return rows


@pytest.mark.parametrize("window,chunk_bytes,shortest", [(13, 4 << 20, 8), (13, 500, 8), (13, 2000, 2), (5, 300, 8), (1, 400, 8), (30, 700, 4)])
def test_against_all_windows(spark, window, chunk_bytes, shortest):
    rng = random.Random(window * 7 + chunk_bytes)
    rows = made_up(rng, 120, ["a", "b", "A", "é", "漢字", "lorem", "ipsum"] + [f"w{i}" for i in range(300)], 80)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(repeats.find_repeats(df, window, shortest, chunk_bytes)) == brute(rows, window)


def test_few_words_that_come_again_all_the_time(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 120)))) for i in range(60)] + [(70, "a " * 5000), (71, "a " * 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(repeats.find_repeats(df, chunk_bytes=1000)) == brute(rows, 13)


def test_nulls_long_texts_ties_empty_tables_and_clashing_columns(spark):
    long = " ".join(f"word{i % 997}x{i % 13}" for i in range(30_000))
    p = " ".join(f"p{i}" for i in range(13))
    rows = [(1, None), (2, ""), (3, " \n"), (None, p), (None, p), (4, p), (4, p), (5, "x " + p + " y"), (6, long), (7, long), (8, " ".join(p.split()[:12]))]
    df = spark.createDataFrame([(i, t, 0, "c") for i, t in rows], "doc_id long, text string, words long, kept string").repartition(3)
    got = found(repeats.find_repeats(df, chunk_bytes=10_000))
    assert got == brute(rows, 13)
    assert dict((g[0], g[3]) for g in got if g[0] == 5) == {5: "x y"}
    assert repeats.find_repeats(df.limit(0)).count() == 0


def test_lengths_double():
    assert repeats.level_lengths(13) == [7, 13]
    assert repeats.level_lengths(50) == [7, 13, 25, 50]
    assert all(b <= 2 * a for a, b in zip(repeats.level_lengths(97, 2), repeats.level_lengths(97, 2)[1:]))


def test_buckets_are_ranges_of_hashes():
    h = np.sort(np.random.default_rng(1).integers(0, 2 ** 64, 10_000, dtype=np.uint64))
    b = repeats.bucket_of(h, 211)
    assert (np.diff(b) >= 0).all() and b.min() == 0 and b.max() == 210


def test_query_on_the_tables(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = sorted((i, n, k, hashlib.sha256(t.encode()).hexdigest()) for i, n, k, t in brute(rows, 13))
    assert sorted(tuple(r) for r in QUERIES["op12_substring_dedup"](spark, sf).collect()) == want
    assert sum(k for _, _, k, _ in want) > 0
