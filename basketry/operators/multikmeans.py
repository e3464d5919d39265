"""Many KMeans runs in one pass over the data per iteration.

A k sweep with several seeds per k is dozens of independent Lloyd runs over
the same points.  Fitted one by one (``pyspark.ml``), every run scans the
cached points once per iteration.  Here all runs advance together, over points packed into
blocks of ``BLOCK`` rows: a pass folds each task's blocks (numpy, one matrix product for the
centres of all runs) to sum(k) rows, and a tree of tasks adds those up, so the
driver sees sum(k) rows at any size.  Centres ship in the task closure (sum(k) x dims
doubles, bounded by the sweep, not by the data).  The passes are RDD jobs over the packed
blocks: a fit is about a hundred short passes, and planning each as a
DataFrame query cost more than the pass itself (README has the figures).

* init: greedy k-means++ (D^2 weighting, 2 + floor(ln k) candidates per
  step, the one leaving the smallest potential wins).  One pass per step: for every
  candidate it sums the potential *and* draws the next step's candidates as if
  that candidate had won, so that the winner's draws are at hand.  A draw is the
  point with the smallest exponential key ``-ln(u) / D^2`` (u from a seeded hash of the
  point id, so a rerun on a different partitioning draws the same points);
* bounds: a full pass leaves, per point and run, the nearest centre and its margin (distance to
  the second nearest less distance to the nearest) as state, together with the sums.  While the
  centres have moved little since then, the triangle inequality tells which points cannot
  have changed sides: margin > own centre's move + largest move of the others.  Only the
  other points are measured again, and only those that change sides alter the sums.  The state
  depends on the points and the centres of its pass alone, so a lost block is
  rebuilt from the packed points; it is renewed when less than ``KEEP_SKIPPING`` of the
  points were skipped;
* a cluster that loses all its points is moved: the points farthest from their centres, farthest
  first (ties by id hash), become the centres of the empty clusters in ascending order and
  leave their old cluster's mean, as in the reference's library; nothing moves when every
  point sits on its centre;
* convergence: a run stops when the summed squared centre shift is at most
  ``tol * mean feature variance`` (the reference's rule);
* inertia: sum of squared distances to the final centres (one extra pass).
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_M64 = (1 << 64) - 1
#: points per packed block
BLOCK = 4096
#: share of (point, run) pairs that the bounds must settle for the state to be kept
KEEP_SKIPPING = 0.5
#: the state is renewed when only one of so many of its runs still goes on
KEEP_RUNS = 4
#: slack of the bounds test, above the rounding of a distance
_SLACK = 1e-6

# The per-batch functions below run in Python workers; ship them (and the
# helpers they call) by value so workers need not import this package.
try:
    from pyspark import cloudpickle as _cp
    _cp.register_pickle_by_value(sys.modules[__name__])
except Exception:  # pragma: no cover - older cloudpickle: rely on --py-files
    pass


@dataclass
class Run:
    k: int
    seed: int
    centers: list = field(default_factory=list)
    n_iter: int = 0
    converged: bool = False
    inertia: float = float("nan")


def _uniform(h: np.ndarray, seed: int, step: int) -> np.ndarray:
    """Uniform (0, 1) per point from its 64-bit id hash (splitmix64 finaliser)."""
    x = (h.astype(np.uint64) ^ np.uint64((seed * 0x9E3779B97F4A7C15 + step * 0xBF58476D1CE4E5B9) & _M64))
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x = x ^ (x >> np.uint64(31))
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def _sqdist(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """k x n squared distances, coordinate by coordinate (exact zeros for equal points)."""
    out = np.zeros((len(C), len(X)))
    for d, x in enumerate(np.ascontiguousarray(X.T)):
        out += (x - C[:, d, None]) ** 2
    return out


def prepare(features: DataFrame, id_col: str, cols: Sequence[str]) -> DataFrame:
    """Points as (h, x0..x{d-1}): ``h`` a 64-bit hash of the id for seeded draws."""
    return features.select(F.xxhash64(F.col(id_col)).alias("h"),
                           *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])


def local_trials(k: int) -> int:
    """Candidates per greedy k-means++ step: 2 + floor(ln k)."""
    return 2 + int(np.log(k))


def pack(points: DataFrame) -> RDD:
    """Points of ``prepare`` as blocks (id hashes, coordinates), persisted.  Partitions of less than a block are put
    together: a pass over them would cost more in tasks than in work.  Points in fewer partitions than there are cores (a few
    files) or in uneven ones (parts of files without a row group) are dealt out evenly, since every pass waits for the longest task."""
    dims = len([c for c in points.columns if c.startswith("x")])
    sizes = [r["count"] for r in points.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    total = sum(sizes)
    parts = min(max(1, -(-total // BLOCK)), 2 * points.sparkSession.sparkContext.defaultParallelism)
    if 2 * len(sizes) < parts or max(sizes, default=0) * parts > 4 * max(total, parts * BLOCK):
        points = points.repartition(parts, "h")
    else:
        points = points.coalesce(max(1, -(-total // BLOCK)))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h = b.column(b.schema.get_field_index("h")).to_numpy()
            X = np.column_stack([b.column(b.schema.get_field_index(f"x{d}")).to_numpy(zero_copy_only=False) for d in range(dims)])
            cut = range(0, len(h), BLOCK)
            if len(h):
                yield pa.RecordBatch.from_arrays([pa.array([h[i:i + BLOCK].tobytes() for i in cut], pa.binary()),
                                                  pa.array([X[i:i + BLOCK].tobytes() for i in cut], pa.binary())], names=["h", "x"])

    def arrays(row) -> tuple:
        return np.frombuffer(row.h, dtype=np.int64), np.frombuffer(row.x, dtype=np.float64).reshape(-1, dims)

    return points.mapInArrow(blocks, "h binary, x binary").rdd.map(arrays).persist(StorageLevel.MEMORY_AND_DISK)


def _fold(rdd: RDD, work, merge):
    """Every task's blocks folded by ``work(blocks) -> value or None``, then added up by a tree of tasks; None
    without any points."""
    def both(a, b):
        return b if a is None else a if b is None else merge(a, b)
    if not rdd.getNumPartitions():
        return None
    return rdd.mapPartitions(lambda blocks: [work(blocks)]).treeReduce(both, depth=2)


# -- init ---------------------------------------------------------------------

def _least(a: dict, b: dict) -> dict:
    """Smallest (key, point) per draw."""
    for name, x in b.items():
        if name not in a or x[0] < a[name][0]:
            a[name] = x
    return a


def _first_draws(blocks: RDD, runs: list[Run]) -> dict:
    """A uniform draw per run."""
    seeds = [r.seed for r in runs]

    def work(it):
        best: dict = {}
        for h, X in it:
            draw = {}
            for seed in set(seeds):
                key = -np.log(_uniform(h, seed, 0))
                j = int(np.argmin(key))
                draw[seed] = float(key[j]), X[j].tolist()
            _least(best, {i: draw[seed] for i, seed in enumerate(seeds)})
        return best or None

    return {i: c for i, (_, c) in (_fold(blocks, work, _least) or {}).items()}


def _try_candidates(blocks: RDD, runs: list[Run], cands: dict[int, list], step: int, trials: dict[int, int]) -> tuple[dict, dict]:
    """One pass: (potentials, draws).  Potential of (run, candidate): the summed squared distance to the
    nearest of the run's centres and the candidate.  Draw of (run, candidate, trial): D^2-weighted with
    that candidate as a centre, for position ``step``; runs without ``trials`` draw nothing."""
    cents = {i: np.array(runs[i].centers) for i in cands if runs[i].centers}
    arr = {i: np.array(c) for i, c in cands.items()}
    seeds = {i: runs[i].seed for i in cands}

    def work(it):
        pots: dict = {}
        draws: dict = {}
        for h, X in it:
            keys: dict = {}   # runs of one seed draw by the same numbers
            for i, C in arr.items():
                d2 = _sqdist(X, C)
                if i in cents:
                    d2 = np.minimum(d2, _sqdist(X, cents[i]).min(axis=0))
                p = d2.sum(axis=1)
                pots[i] = p if i not in pots else pots[i] + p
                for t in range(trials.get(i, 0)):
                    if (seeds[i], t) not in keys:
                        keys[seeds[i], t] = -np.log(_uniform(h, seeds[i], step * 64 + t))
                    with np.errstate(divide="ignore"):
                        key = np.where(d2 > 0, keys[seeds[i], t] / d2, np.inf)
                    at = key.argmin(axis=1)
                    for c, j in enumerate(at.tolist()):
                        if np.isfinite(key[c, j]):
                            _least(draws, {(i, c, t): (float(key[c, j]), X[j].tolist())})
        return (pots, draws) if pots else None

    def merge(a, b):
        return {i: a[0][i] + b[0][i] for i in a[0]}, _least(a[1], b[1])

    return _fold(blocks, work, merge) or ({}, {})


def kmeans_pp_init(blocks: RDD, runs: list[Run], greedy: bool = True) -> None:
    """Greedy k-means++ (the reference's default init): the first centre is a
    uniform draw; each next one is the best, by resulting potential, of
    ``2 + floor(ln k)`` D^2-weighted draws.  ``greedy=False``: one draw per step."""
    first = _first_draws(blocks, runs)
    for r in runs:
        r.centers = []
    cands = {i: [c] for i, c in first.items()}
    for step in range(1, max(r.k for r in runs) + 1):
        todo = {i: c for i, c in cands.items() if c}
        trials = {i: local_trials(runs[i].k) if greedy else 1 for i in todo if runs[i].k > step}
        pots, draws = _try_candidates(blocks, runs, todo, step, trials) if todo else ({}, {})
        cands = {}
        for i, r in enumerate(runs):
            if i not in first or len(r.centers) >= r.k:
                continue
            if i not in todo:   # fewer distinct points than k: repeat the last centre
                r.centers.append(list(r.centers[-1]))
                continue
            best = min(range(len(todo[i])), key=lambda c: (pots[i][c], c))
            r.centers.append(todo[i][best])
            cands[i] = [draws[(i, best, t)][1] for t in range(trials.get(i, 0)) if (i, best, t) in draws]


# -- Lloyd ----------------------------------------------------------------------

def _columns(X: np.ndarray) -> np.ndarray:
    """What a cluster sums: 1, coordinates, squared norm."""
    return np.column_stack([np.ones(len(X)), X, (X * X).sum(axis=1)])


def _spans(cents: list[np.ndarray]) -> list[tuple[int, int]]:
    ends = np.cumsum([len(c) for c in cents]).tolist()
    return list(zip([0, *ends[:-1]], ends))


def _near(XT: np.ndarray, C: np.ndarray) -> np.ndarray:
    """k x n squared distances less each point's squared norm (a matrix product; ranks as distances do), from the
    points' coordinates as rows.  The points of a block lie side by side, so that each step below is over a row."""
    return (C * C).sum(axis=1)[:, None] - 2.0 * (C @ XT)


def _two_nearest(D: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per column: the row of the least value (the first one on ties), that value and the next."""
    at, low, second = np.zeros(D.shape[1], dtype=np.uint16), D[0].copy(), np.full(D.shape[1], np.inf)
    for j in range(1, len(D)):
        at[D[j] < low] = j
        np.minimum(second, np.maximum(low, D[j]), out=second)
        np.minimum(low, D[j], out=low)
    return at, low, second


def _members(at: np.ndarray, k: int) -> np.ndarray:
    """k x n: 1 where a point is in a cluster."""
    return (at == np.arange(k, dtype=at.dtype)[:, None]).astype(np.float64)


def _full(blocks: RDD, cents: list[np.ndarray]) -> tuple[RDD, np.ndarray]:
    """All points against the centres of every run: the state (block, nearest, margin) and the sums,
    one row per centre: n, coordinate sums, sum of squared norms."""
    spans = _spans(cents)

    def measure(block):
        _, X = block
        XT, cols = np.ascontiguousarray(X.T), _columns(X)
        size = cols[:, -1]
        near = np.empty((len(spans), len(X)), dtype=np.uint16)
        margin = np.empty((len(spans), len(X)), dtype=np.float32)
        sums = np.empty((spans[-1][1], cols.shape[1]))
        for r, ((a, b), C) in enumerate(zip(spans, cents)):
            near[r], low, second = _two_nearest(_near(XT, C))
            margin[r] = np.sqrt(np.maximum(second + size, 0.0)) - np.sqrt(np.maximum(low + size, 0.0))
            sums[a:b] = _members(near[r], b - a) @ cols
        return block, near, margin, sums

    state = blocks.map(measure).persist(StorageLevel.MEMORY_AND_DISK)
    return state, _fold(state, lambda it: _added(s[3] for s in it), lambda a, b: a + b)


def _added(parts):
    total = None
    for p in parts:
        total = p if total is None else total + p
    return total


def _moved(state: RDD, rows: list[int], at_state: list[np.ndarray], now: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """Change of the sums since the state's pass, for the runs ``rows`` of the state, and how many (point, run)
    pairs had to be measured again."""
    spans = _spans(now)
    limits = []
    for c0, c1 in zip(at_state, now):
        move = np.sqrt(((c1 - c0) ** 2).sum(axis=1))
        others = [np.delete(move, j).max() if len(move) > 1 else 0.0 for j in range(len(move))]
        limits.append(move + np.array(others))
    width = at_state[0].shape[1] + 2

    def work(it):
        total, open_pairs = np.zeros((spans[-1][1], width)), 0
        for (_, X), near, margin, _ in it:
            XT = np.ascontiguousarray(X.T)
            for r, (a, b), limit, C in zip(rows, spans, limits, now):
                was = near[r]
                loose = np.flatnonzero(margin[r] * (1.0 - _SLACK) - _SLACK <= limit[was])
                open_pairs += len(loose)
                if not len(loose):
                    continue
                new, old = _two_nearest(_near(XT[:, loose], C))[0], was[loose]
                turn = np.flatnonzero(new != old)
                if len(turn):
                    total[a:b] += (_members(new[turn], b - a) - _members(old[turn], b - a)) @ _columns(X[loose[turn]])
        return total, open_pairs

    return _fold(state, work, lambda p, q: (p[0] + q[0], p[1] + q[1]))


def _farthest(blocks: RDD, C: np.ndarray, m: int) -> list[tuple]:
    """The m points farthest from their nearest centre: (squared distance, id hash, cluster, point), farthest first."""
    def top(xs):
        return sorted(xs, key=lambda x: (-x[0], x[1]))[:m]

    def work(it):
        best: list = []
        for h, X in it:
            d2 = _sqdist(X, C)
            near = d2.argmin(axis=0)
            low = d2[near, np.arange(len(X))]
            some = np.lexsort((h, -low))[:m]
            best = top(best + [(float(low[j]), int(h[j]), int(near[j]), X[j].tolist()) for j in some])
        return best or None

    return _fold(blocks, work, lambda a, b: top(a + b)) or []


def _means(blocks: RDD, old: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """New centres of one run from its sums (n, coordinates, ..); empty clusters are moved to the farthest points."""
    n, total = np.rint(sums[:, 0]), sums[:, 1:1 + old.shape[1]].copy()
    empty = np.flatnonzero(n == 0)
    if len(empty):
        far = _farthest(blocks, old, len(empty))
        if far and far[0][0] > 0:
            for j, (_, _, left, x) in zip(empty.tolist(), far):
                total[left] -= x
                n[left] -= 1
                total[j], n[j] = x, 1
    return np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], old)


def _advance(blocks: RDD, run: Run, sums: np.ndarray) -> float:
    """Move a run's centres; the summed squared shift."""
    old = np.array(run.centers)
    new = _means(blocks, old, sums)
    run.centers = new.tolist()
    return float(((new - old) ** 2).sum())


def lloyd_step(points: DataFrame, runs: list[Run], ids: list[int]) -> dict[int, float]:
    """Move the centres of the given runs to the means of their points, in place;
    the summed squared shift of each run."""
    blocks = pack(points)
    cents = [np.array(runs[i].centers) for i in ids]
    state, sums = _full(blocks, cents)
    # no points: no centre moves
    shifts = {i: _advance(blocks, runs[i], sums[a:b]) for i, (a, b) in zip(ids, _spans(cents))} if sums is not None else dict.fromkeys(ids, 0.0)
    state.unpersist()
    blocks.unpersist()
    return shifts


@dataclass
class FitReport:
    """Passes of a fit, and the (point, run) pairs it looked at and measured."""

    full_passes: int = 0
    bound_passes: int = 0
    pairs: int = 0
    measured: int = 0


def fit_runs(points: DataFrame, runs: list[Run], max_iter: int = 300, tol: float = 1e-4, report: FitReport | None = None,
             keep_skipping: float = KEEP_SKIPPING) -> list[Run]:
    """``points`` from ``prepare``; fits every run (in place) and returns them.  Runs that come with
    centres start from those.  ``keep_skipping`` above 1: every pass measures all points."""
    report = report if report is not None else FitReport()
    blocks = pack(points)
    stats = _fold(blocks, lambda it: _added(np.stack([_columns(X).sum(axis=0)]) for _, X in it), lambda a, b: a + b)
    if stats is None:
        blocks.unpersist()
        return runs
    dims = stats.shape[1] - 2
    n = int(stats[0, 0])
    mean = stats[0, 1:1 + dims] / n
    threshold = tol * max(0.0, float(stats[0, -1] / n - (mean * mean).sum())) / dims
    blank = [r for r in runs if not r.centers]
    if blank:
        kmeans_pp_init(blocks, blank)
    active = list(range(len(runs)))
    state, held = None, []
    while active:
        now = [np.array(runs[i].centers) for i in active]
        spans = _spans(now)
        if state is None:
            state, sums = _full(blocks, now)
            held, base, at_state = list(active), dict(zip(active, (sums[a:b] for a, b in spans))), dict(zip(active, now))
            report.full_passes += 1
            measured, keep = n * len(active), keep_skipping <= 1
        else:
            change, measured = _moved(state, [held.index(i) for i in active], [at_state[i] for i in active], now)
            sums = np.concatenate([base[i] for i in active]) + change
            report.bound_passes += 1
            keep = measured <= (1 - keep_skipping) * n * len(active)
        report.pairs += n * len(active)
        report.measured += measured
        for i, (a, b) in zip(active, spans):
            shift = _advance(blocks, runs[i], sums[a:b])
            runs[i].n_iter += 1
            runs[i].converged = shift <= threshold
        active = [i for i in active if not runs[i].converged and runs[i].n_iter < max_iter]
        # the state of runs that have ended is read by every pass: renew it for the few that are left
        if not keep or len(active) <= len(held) // KEEP_RUNS:
            state.unpersist()
            state = None
    if state is not None:
        state.unpersist()
    for r, cost in zip(runs, _costs(blocks, [np.array(r.centers) for r in runs])):
        r.inertia = cost
    blocks.unpersist()
    return runs


def _costs(blocks: RDD, cents: list[np.ndarray]) -> list[float]:
    """Sum of squared distances to the nearest centre, per run."""
    def work(it):
        return _added(np.array([_sqdist(X, C).min(axis=0).sum() for C in cents]) for _, X in it)

    return _fold(blocks, work, lambda a, b: a + b).tolist()


def best_per_k(runs: list[Run]) -> dict[int, Run]:
    """Lowest inertia per k; runs are in seed order, so the first seed wins ties."""
    best: dict[int, Run] = {}
    for r in runs:
        if r.k not in best or r.inertia < best[r.k].inertia:
            best[r.k] = r
    return best


def make_runs(ks: Sequence[int], n_init: int, seed: int) -> list[Run]:
    return [Run(k=k, seed=seed + i) for k in ks for i in range(n_init)]
