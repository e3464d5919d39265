"""Euclidean silhouette, exact from all pairs or without them and with a bound on its error.

The silhouette of a point needs its mean distance to every cluster.  Which way it is summed is the caller's choice, never
the input's size.  With ``tolerance=0`` all pairs of distinct points are measured, block against block: a task keeps the sums
of its block and reads all blocks one after the other, so it holds two of them, nothing is shuffled, and the work is
quadratic in the points.  With a tolerance the far points of a cluster are summed as groups:

1. cells: points are ordered along a Morton curve over the coordinates (points in one place of the curve by the coordinates)
   and cut into at most ``cells`` ranges of distinct points.  Per (cell, cluster): count, centroid, mean squared distance to the centroid (s2);
2. tree: neighbouring cells of a cluster are joined two by two up to one node per cluster;
3. dual-tree pass: a block of neighbouring points goes down the tree of every cluster and takes a
   node whole as soon as that can't matter, and a cell always.  For a node of m points at
   distance d from a point, the distances to its points add up to

       between m * d  and  m * sqrt(d^2 + s2)

   (the centroid's distance is at most the mean distance; the root of a mean is at least the mean of
   roots).  A node is taken if these differ by at most ``tolerance * m`` for every point of the block.

The result states, per clustering, the silhouette and an ``error`` that it is proven to keep.  Several clusterings
of the same points share the cells' order and the pass.

Scale.  Work with a tolerance is points x visited nodes, linear in the points; the tree has at most
2 * cells * clusters nodes per clustering whatever the number of points, and is broadcast.  Nulls are not
allowed in the coordinates; a clustering with fewer than two clusters has silhouette null; the only
point of a cluster counts 0.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS = 4096
TOLERANCE = 0.02
#: points that go down the trees together
POINTS = 128
#: points of a block of the pass over all pairs, and rows of it that are measured together
BLOCK = 1024
ROWS = 256
#: squared distances below this share of the squared norms have lost their digits as a difference and are summed directly
NEAR = 1e-6


@dataclass
class Score:
    """Silhouette of one clustering (null with fewer than two clusters), how far off it is at most (0 from all
    pairs), and the silhouette over squared distances, which needs no cells and is exact."""

    silhouette: float | None
    error: float | None
    points: int
    squared: float | None = None


@dataclass
class Tree:
    """Nodes of all (clustering, cluster) trees; children of a node are ``first .. last - 1``, none for a cell."""

    root: np.ndarray
    clustering: np.ndarray
    cluster: np.ndarray
    n: np.ndarray
    centroid: np.ndarray
    s2: np.ndarray
    first: np.ndarray
    last: np.ndarray


def morton(X: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place of each row along the curve: the coordinates' leading bits, interleaved."""
    dims = X.shape[1]
    bits = max(1, 62 // dims)
    width = np.where(high > low, high - low, 1.0)
    q = np.clip((X - low) / width * (1 << bits), 0, (1 << bits) - 1).astype(np.int64)
    code = np.zeros(len(X), dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            code = (code << 1) | ((q[:, d] >> b) & 1)
    return code


def build_tree(clustering: np.ndarray, cluster: np.ndarray, cell: np.ndarray, n: np.ndarray, total: np.ndarray, squares: np.ndarray) -> Tree:
    """Trees from one row per (clustering, cluster, cell): count, coordinate sums, sum of squared norms."""
    order = np.lexsort((cell, cluster, clustering))
    level = [x[order] for x in (clustering, cluster, cell, n.astype(np.float64), total, squares)]
    none = np.zeros(len(order), dtype=np.int64)
    parts, at = [(*level, none, none)], 0
    while True:
        q, c, cell, n, total, squares = parts[-1][:6]
        key = np.stack([q, c, cell >> 1])
        head = np.append(True, (key[:, 1:] != key[:, :-1]).any(axis=0)) if len(q) else np.zeros(0, dtype=bool)
        if cell.max(initial=0) == 0:
            break
        i = np.flatnonzero(head)
        ends = np.append(i[1:], len(q))
        parts.append((q[i], c[i], cell[i] >> 1, np.add.reduceat(n, i), np.add.reduceat(total, i), np.add.reduceat(squares, i), at + i, at + ends))
        at += len(q)
    q, c, _, n, total, squares, first, last = (np.concatenate(x) for x in zip(*parts))
    centroid = total / n[:, None]
    s2 = squares / n - (centroid ** 2).sum(axis=1)
    # below the rounding of the difference, the points are one point
    s2[s2 < 1e-12 * (1.0 + squares / n)] = 0.0
    return Tree(np.arange(at, len(q)), q, c, n, centroid, s2, first, last)


def visit(tree: Tree, X: np.ndarray, tolerance: float) -> np.ndarray:
    """Nodes that stand for all clusters' points as seen from the block ``X``."""
    middle = X.mean(axis=0)
    reach = np.sqrt(((X - middle) ** 2).sum(axis=1).max())
    taken, look = [], tree.root
    while len(look):
        d = np.maximum(np.sqrt(((tree.centroid[look] - middle) ** 2).sum(axis=1)) - reach, 0.0)
        whole = (np.sqrt(d * d + tree.s2[look]) - d <= tolerance) | (tree.last[look] == 0)
        taken.append(look[whole])
        up = look[~whole]
        size = tree.last[up] - tree.first[up]
        look = np.repeat(tree.first[up] - np.concatenate(([0], np.cumsum(size)[:-1])), size) + np.arange(size.sum()) if len(up) else up
    return np.concatenate(taken) if taken else tree.root


def point_scores(X: np.ndarray, own: np.ndarray, n: np.ndarray, centroid: np.ndarray, s2: np.ndarray, cluster: np.ndarray,
                 sizes: np.ndarray) -> np.ndarray:
    """(estimate, least, most) of every point's silhouette from the taken nodes of one clustering."""
    d2 = np.maximum((X * X).sum(axis=1)[:, None] + (centroid * centroid).sum(axis=1) - 2.0 * (X @ centroid.T), 0.0)
    near = np.sqrt(d2)
    member = np.zeros((len(n), len(sizes)))
    member[np.arange(len(n)), cluster] = n
    low = near @ member
    wide = np.flatnonzero(s2 > 0)
    high = low + (np.sqrt(d2[:, wide] + s2[wide]) - near[:, wide]) @ member[wide]
    # residuals across the line of sight lengthen a distance, those along it cancel
    middle = low + (high - low) * ((X.shape[1] - 1) / X.shape[1])
    return np.stack([from_sums(own, *sums, sizes) for sums in ((middle, middle), (high, low), (low, high))], axis=1)


def from_sums(own: np.ndarray, inner: np.ndarray, outer: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Silhouettes from sums of distances to the clusters: ``inner`` for the own one, ``outer`` for the others."""
    at = np.arange(len(own))
    a = inner[at, own] / np.maximum(sizes[own] - 1, 1)
    others = outer / np.maximum(sizes, 1)
    others[:, sizes == 0] = np.inf
    others[at, own] = np.inf
    b = others.min(axis=1)
    top = np.maximum(a, b)
    return np.where((sizes[own] > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1.0), 0.0)


def squared_scores(X: np.ndarray, own: np.ndarray, centroid: np.ndarray, s2: np.ndarray, cluster: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Silhouettes over squared distances: a cluster's mean squared distance is that to its centroid plus s2."""
    mean = np.full((len(X), len(sizes)), np.inf)
    for j, c in enumerate(cluster.tolist()):
        mean[:, c] = ((X - centroid[j]) ** 2).sum(axis=1) + s2[j]
    at = np.arange(len(X))
    a = mean[at, own] * (sizes[own] / np.maximum(sizes[own] - 1, 1))
    mean[at, own] = np.inf
    b = mean.min(axis=1)
    top = np.maximum(a, b)
    return np.where((sizes[own] > 1) & (top > 0), (b - a) / np.where(top > 0, top, 1.0), 0.0)


def _matrix(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names])


def euclidean_silhouettes(points: DataFrame, cols: Sequence[str], labels: Sequence[str], cells: int = CELLS,
                          tolerance: float = TOLERANCE) -> list[Score]:
    """One ``Score`` per clustering; ``labels`` are columns with cluster numbers 0, 1, .. of the same points.
    ``tolerance=0`` measures all pairs."""
    cols, labels = list(cols), list(labels)
    dims = len(cols)
    xs, ys = [f"x{i}" for i in range(dims)], [f"y{i}" for i in range(len(labels))]
    pts = points.select(*[F.col(c).cast("double").alias(x) for c, x in zip(cols, xs)],
                        *[F.col(c).cast("long").alias(y) for c, y in zip(labels, ys)])
    box = pts.agg(F.count(F.lit(1)), *[F.min(x) for x in xs], *[F.max(x) for x in xs], *[F.max(y) for y in ys]).first()
    count = box[0]
    if not count:
        return [Score(None, None, 0) for _ in labels]
    low, high = np.array(box[1:1 + dims]), np.array(box[1 + dims:1 + 2 * dims])
    widths = [int(k) + 1 for k in box[1 + 2 * dims:]]

    if tolerance == 0:
        return _all_pairs(pts, xs, ys, widths, count)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(morton(_matrix(b, xs), low, high)), *b.columns], names=["code", *xs, *ys])

    schema = ", ".join(["code long", *[f"{x} double" for x in xs], *[f"{y} long" for y in ys]])
    width = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = pts.mapInArrow(place, schema).repartitionByRange(width, "code").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        tree = _cells_and_tree(placed, xs, ys, count, cells)
        sizes = []
        for q, k in enumerate(widths):
            at = tree.root[tree.clustering[tree.root] == q]
            sizes.append(np.bincount(tree.cluster[at], weights=tree.n[at], minlength=k))
        shared = placed.sparkSession.sparkContext.broadcast((tree, sizes))

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tree, sizes = shared.value
            total = np.zeros((len(ys), 4))
            tops = [tree.root[tree.clustering[tree.root] == q] for q in range(len(ys))]
            for b in batches:
                order = np.argsort(b.column(0).to_numpy(), kind="stable")
                X, Y = _matrix(b, xs)[order], _matrix(b, ys)[order]
                for lo in range(0, len(X), POINTS):
                    x, y = X[lo:lo + POINTS], Y[lo:lo + POINTS]
                    nodes = visit(tree, x, tolerance)
                    for q in range(len(ys)):
                        at = nodes[tree.clustering[nodes] == q]
                        total[q, :3] += point_scores(x, y[:, q], tree.n[at], tree.centroid[at], tree.s2[at], tree.cluster[at], sizes[q]).sum(axis=0)
                        at = tops[q]
                        total[q, 3] += squared_scores(x, y[:, q], tree.centroid[at], tree.s2[at], tree.cluster[at], sizes[q]).sum()
            yield pa.RecordBatch.from_arrays([pa.array(range(len(ys)), pa.int32()), *[pa.array(total[:, j]) for j in range(4)]],
                                             names=["q", "s", "low", "high", "squared"])

        sums = placed.mapInArrow(score, "q int, s double, low double, high double, squared double").groupBy("q") \
            .agg(*[F.sum(c).alias(c) for c in ("s", "low", "high", "squared")]).collect()
        shared.unpersist()
    finally:
        placed.unpersist()
    out = [Score(None, None, count) for _ in labels]
    for r in sums:
        if (sizes[r.q] > 0).sum() > 1:
            out[r.q] = Score(r.s / count, max(r.high - r.s, r.s - r.low, 0.0) / count, count, r.squared / count)
    return out


def distances(X: np.ndarray, Y: np.ndarray) -> np.ndarray:
    """Distance of every row of ``X`` to every row of ``Y``."""
    middle = X.mean(axis=0)
    x, y = X - middle, Y - middle
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    d2 = np.column_stack([x, xx, np.ones(len(x))]) @ np.column_stack([-2.0 * y, np.ones(len(y)), yy]).T
    i, j = np.divmod(np.flatnonzero(d2 < NEAR * (xx.max() + yy.max())), len(Y))
    d2[i, j] = ((X[i] - Y[j]) ** 2).sum(axis=1)
    return np.sqrt(d2, out=d2)


def _blocks(points: DataFrame, xs: list[str], ys: list[str]) -> RDD:
    """Distinct points as blocks (place, coordinates, labels, copies), about one a partition, persisted."""
    distinct = points.groupBy(*xs, *ys).agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    parts = max(1, -(-distinct.count() // BLOCK))
    names = [*xs, *ys, "n"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            M = _matrix(b, names).astype(np.float64)
            cut = range(0, len(M), BLOCK)
            yield pa.RecordBatch.from_arrays([pa.array([M[i:i + BLOCK].tobytes() for i in cut], pa.binary())], names=["m"])

    def arrays(part: int, rows) -> Iterator[tuple]:
        for i, row in enumerate(rows):
            M = np.frombuffer(row.m, dtype=np.float64).reshape(-1, len(names))
            yield (part, i), M[:, :len(xs)].copy(), M[:, len(xs):-1].astype(np.int64), M[:, -1].copy()

    blocks = distinct.repartition(parts, *xs).mapInArrow(pack, "m binary").rdd.mapPartitionsWithIndex(arrays).persist(StorageLevel.MEMORY_AND_DISK)
    blocks.count()
    distinct.unpersist()
    return blocks


def _all_pairs(points: DataFrame, xs: list[str], ys: list[str], widths: list[int], count: int) -> list[Score]:
    """Scores from the distances of all pairs: every block against all blocks, which a task reads one by one."""
    dims, first = len(xs), np.concatenate(([0], np.cumsum(widths)))
    blocks = _blocks(points, xs, ys)

    def totals(rows) -> Iterator[np.ndarray]:
        """Copies, coordinate sums and sum of squared norms of all clusters."""
        out = np.zeros((first[-1], dims + 2))
        for _, X, Y, n in rows:
            cols = np.column_stack([np.ones(len(X)), X, (X * X).sum(axis=1)]) * n[:, None]
            for q in range(len(ys)):
                np.add.at(out, first[q] + Y[:, q], cols)
        yield out

    try:
        total = blocks.mapPartitions(totals).treeReduce(np.add)
        sizes = [total[first[q]:first[q + 1], 0] for q in range(len(ys))]
        shared = blocks.context.broadcast((total, sizes))

        def score(pairs) -> Iterator[np.ndarray]:
            total, sizes = shared.value
            seen: dict[tuple, tuple] = {}
            for (place, X, Y, n), (_, other, labels, copies) in pairs:
                sums = seen.setdefault(place, (X, Y, n, np.zeros((len(X), first[-1]))))[-1]
                member = np.zeros((len(other), first[-1]))
                for q in range(len(ys)):
                    member[np.arange(len(other)), first[q] + labels[:, q]] = copies
                for lo in range(0, len(X), ROWS):
                    sums[lo:lo + ROWS] += distances(X[lo:lo + ROWS], other) @ member
            out = np.zeros((len(ys), 2))
            for X, Y, n, sums in seen.values():
                for q in range(len(ys)):
                    own, part = Y[:, q], slice(first[q], first[q + 1])
                    out[q, 0] += n @ from_sums(own, sums[:, part], sums[:, part], sizes[q])
                    there = np.flatnonzero(sizes[q] > 0)
                    m = total[part][there]
                    centroid = m[:, 1:-1] / m[:, :1]
                    s2 = np.maximum(m[:, -1] / m[:, 0] - (centroid ** 2).sum(axis=1), 0.0)
                    out[q, 1] += n @ squared_scores(X, own, centroid, s2, there, sizes[q])
            yield out

        sums = blocks.cartesian(blocks.coalesce(1)).mapPartitions(score).treeReduce(np.add)
        shared.unpersist()
    finally:
        blocks.unpersist()
    return [Score(float(s) / count, 0.0, count, float(squared) / count) if (n > 0).sum() > 1 else Score(None, None, count)
            for n, (s, squared) in zip(sizes, sums)]


def _keys(code: np.ndarray, X: np.ndarray) -> np.ndarray:
    """Bytes that sort like (code, coordinates)."""
    bits = (X + 0.0).view(np.uint64)
    bits = np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))
    wide = np.column_stack([code.astype(np.uint64), bits]).astype(">u8")
    return np.ascontiguousarray(wide).view(f"S{8 * wide.shape[1]}").reshape(-1)


def _cells_and_tree(placed: DataFrame, xs: list[str], ys: list[str], count: int, cells: int) -> Tree:
    """Cells of all clusterings, at most ``cells`` each per cluster: ranges of distinct points, of one point each while those are fewer."""
    dims = len(xs)
    # about four places per cell, drawn by hash, so that a rerun cuts alike; they only set where a cell ends
    some = placed.where(F.pmod(F.xxhash64(*xs), F.lit(max(1, count // (4 * cells)))) == 0).select("code", *xs).distinct().toArrow()
    drawn = np.sort(_keys(some.column("code").to_numpy(), np.column_stack([some.column(x).to_numpy() for x in xs])))
    at = np.unique(np.arange(1, cells) * len(drawn) // cells)
    cuts = drawn[at[at > 0]]
    names = ["q", "cluster", "cell", "n", *xs, "squares"]

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc: dict[int, dict] = {q: {} for q in range(len(ys))}
        for b in batches:
            X, Y = _matrix(b, xs), _matrix(b, ys)
            cell = np.searchsorted(cuts, _keys(b.column(0).to_numpy(), X), side="right")
            cols = np.column_stack([np.ones(len(X)), X, (X * X).sum(axis=1)])
            for q in range(len(ys)):
                key, at = np.unique(Y[:, q] * (len(cuts) + 1) + cell, return_inverse=True)
                part = np.zeros((len(key), cols.shape[1]))
                np.add.at(part, at.reshape(-1), cols)
                for k, p in zip(key.tolist(), part):
                    acc[q][k] = acc[q][k] + p if k in acc[q] else p
        for q, found in acc.items():
            if found:
                key, m = np.array(list(found)), np.stack(list(found.values()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(key), q)), pa.array(key // (len(cuts) + 1)), pa.array(key % (len(cuts) + 1)),
                     *[pa.array(m[:, j]) for j in range(dims + 2)]], names=names)

    schema = "q long, cluster long, cell long, " + ", ".join(f"{c} double" for c in names[3:])
    rows = placed.mapInArrow(fold, schema).groupBy("q", "cluster", "cell").agg(*[F.sum(c).alias(c) for c in names[3:]]).toArrow()
    got = {c: rows.column(c).to_numpy() for c in names}
    return build_tree(got["q"], got["cluster"], got["cell"], got["n"], np.column_stack([got[x] for x in xs]), got["squares"])
