"""Merkle manifest against trees built by hand, in every arity and shape."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from basketry.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in merkle.FIELDS])


def tree(nodes, arity):
    """Root and, per leaf, its siblings level by level."""
    where, paths, levels = list(range(len(nodes))), [[] for _ in nodes], nodes
    while len(levels) > 1:
        runs = [levels[k:k + arity] for k in range(0, len(levels), arity)]
        for i, w in enumerate(where):
            run = runs[w // arity]
            paths[i].append((w % arity, run))
        where = [w // arity for w in where]
        levels = [h(*r) for r in runs]
    return levels[0], paths


def expected(rows, arity):
    by = {}
    for r in rows:
        by.setdefault(r["source"], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    sub = {s: tree([leaf(r) for r in sorted(by[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))], arity) for s in sources}
    root, above = tree([sub[s][0] for s in sources], arity)
    out = []
    for k, s in enumerate(sources):
        ordered = sorted(by[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        for r, path in zip(ordered, sub[s][1]):
            proof = h(*[d for slot, run in path + above[k] for j, d in enumerate(run) if j != slot])
            out.append((r["doc_id"], s, leaf(r), sub[s][0], root, proof))
    return sorted(out, key=repr)


def listed(df):
    cols = df.select("doc_id", "source", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof"))
    return sorted([tuple(r) for r in cols.collect()], key=repr)


@pytest.mark.parametrize("arity,sizes", [(16, [1, 16, 17, 300]), (2, [1, 2, 3, 7]), (3, [28]), (4, [1]), (2, [1] * 5)])
def test_against_trees_by_hand(spark, arity, sizes):
    rng = random.Random(arity)
    names = [None, "", "é", "zz", "a b"]
    rows = [{"doc_id": rng.randrange(-50, 10_000), "text": f"text {i}", "lang": "en", "source": names[k], "n_chars": i}
            for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], DOCS)
    assert listed(merkle.manifest(df, arity=arity)) == expected(rows, arity)


def test_nulls_ties_repeated_rows_and_clashing_columns(spark):
    rows = [(None, None, None, None, None), (None, "x", None, None, 1), (1, "", "en", None, 0), (1, "a", "en", "", 1), (1, "a", "en", "", 1),
            (1, "b", "en", "", 1), (2, "ünï" * 50_000, "de", "s", 9)]
    df = spark.createDataFrame([(*r, i, "clash", 7) for i, r in enumerate(rows)], DOCS + ", root long, path string, index long")
    want = expected([dict(zip(("doc_id", "text", "lang", "source", "n_chars"), r)) for r in rows], 16)
    got = merkle.manifest(df)
    assert listed(got) == want
    assert got.columns == ["doc_id", "source", "leaf", "position", "subroot", "root", "path"]
    assert merkle.manifest(df.limit(0)).count() == 0


def test_tampering_shows_in_its_own_row_only(spark):
    df = spark.createDataFrame([(i, f"Text {i}", "en", f"s{i % 3}", i) for i in range(100)], DOCS)
    seen = F.when(F.col("doc_id") == 42, merkle.leaf_digest(text=F.lower("text"))).otherwise(merkle.leaf_digest())
    out = merkle.verify(merkle.manifest(df, carried={"seen": seen}), "seen").collect()
    assert [r.doc_id for r in out if not r.verified] == [42]
    assert len({r.root for r in out}) == 1 and all((r.folded_root == r.root) == r.verified for r in out)


def test_numbers_span_partitions(spark):
    df = spark.range(0, 20_000, numPartitions=7).select(F.lit("hot").alias("g"), (F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    out = merkle.numbered(df, ["g"], ["k", "v"], "at").collect()
    assert {r.n for r in out} == {20_000}
    assert [r.v for r in sorted(out, key=lambda r: r["at"])] == sorted(range(20_000), key=lambda v: (v % 50, v))
