"""Lloyd steps of several K-Means restarts at once, over blocks of points.

The points are packed once into blocks (row-major doubles) that stay persisted. A step is one
job: each task finds the nearest centroids of its blocks for all restarts by one matrix product
and adds up counts and coordinate sums; the driver sums one small array a task. A product
rounds differently than the squared differences; a row whose two nearest centroids lie within
that rounding gets the squared differences, so labels are those of exact distances (ties → the
smallest cluster id).

Most rows can't change their cluster for many steps: a row whose second-nearest centroid is
farther than its nearest by a margin keeps its label while the two largest displacements of its
restart's centroids, taken from where the margin was measured, add up to less. After a pass
over all rows, the rows below a margin (chosen by the margins' histogram and the last step) are
set apart, and the steps go over those only, the others' sums being constant, until the
displacements reach the margin. Every step's centroids are those of a pass over all rows.

A category of V values takes part without columns: a row carries its value's number, a
centroid V more coordinates sqrt(w) * share, w being 1 / variance of the value's indicator.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_ROWS = 1_024
#: Points a partition of the blocks has at least, where there are that many.
PARTITION_ROWS = 4_096
#: Rows times restarts a core from which on rows are set apart: below, a pass over all rows costs as little as any job.
APART_WORK = 300_000
#: Task results summed on the driver; of more, by a tree of tasks.
DRIVER_SUMS = 200
# bins of margins: half octaves from 2 ** _LOW
_LOW, _BINS = -20, 80
_EPS = float(np.finfo(float).eps)


@dataclass
class Restart:
    """``ids`` and ``at`` (one row an id): the centroids; ``before``: where the last step found them."""

    ids: list
    at: np.ndarray
    before: tuple = ()
    steps: int = 0
    done: bool = False
    cost: float = float("nan")
    moved: float = float("inf")


def point_blocks(df: DataFrame, cols: list[str]) -> RDD:
    """The columns (as doubles; null is NaN) packed into blocks, dealt evenly; persisted, the caller unpersists."""
    sc = df.sparkSession.sparkContext
    width = len(cols)

    def pack(batches):
        for batch in batches:
            x = np.empty((batch.num_rows, width))
            for j in range(width):
                x[:, j] = batch.column(j).to_numpy(zero_copy_only=False)
            for lo in range(0, len(x), BLOCK_ROWS):
                yield pa.RecordBatch.from_arrays([pa.array([x[lo:lo + BLOCK_ROWS].tobytes()], pa.binary())], names=["x"])

    packed = df.select(*[F.col(c).cast("double") for c in cols]).mapInArrow(pack, "x binary")
    parts = min(-(-df.count() // PARTITION_ROWS), max(2 * sc.defaultParallelism, df.rdd.getNumPartitions()))
    return packed.repartition(max(parts, 1)).rdd.map(lambda r: bytes(r[0])).persist(StorageLevel.MEMORY_AND_DISK)


def _stacked(restarts: list[np.ndarray], d: int, w: np.ndarray | None):
    """Centroids (restart, cluster, d), what a row's distance gets besides (by restart, cluster and value, the last for
    no value), and which places are none (restarts may have fewer clusters)."""
    k = max(len(c) for c in restarts)
    values = 0 if w is None else len(w)
    c, rest, none = np.zeros((len(restarts), k, d)), np.zeros((len(restarts), k, values + 1)), np.ones((len(restarts), k), bool)
    for r, at in enumerate(restarts):
        c[r, :len(at)], none[r, :len(at)] = at[:, :d], False
        share = at[:, d:]
        rest[r, :len(at)] = (share ** 2).sum(axis=1)[:, None]
        if values:
            rest[r, :len(at), :values] += w - 2.0 * share * np.sqrt(w)
    return c, rest, none


def _nearest(x: np.ndarray, code: np.ndarray, c: np.ndarray, rest: np.ndarray, none: np.ndarray):
    """Per restart and row: nearest cluster, squared distance to it, by how much the second is farther off; and the
    largest rounding of a squared distance."""
    n_restarts, k, d = c.shape
    x2, c2 = (x ** 2).sum(axis=1), (c ** 2).sum(axis=2)

    def exact(r, rows):
        dist = ((x[rows][:, None, :] - c[r][None]) ** 2).sum(axis=2) + rest[r].T[code[rows]]
        dist[:, none[r]] = np.inf
        return dist

    if not (np.isfinite(x2).all() and np.isfinite(c2).all() and np.isfinite(rest).all()):
        every = np.arange(len(x))
        dist = np.stack([exact(r, every) for r in range(n_restarts)])
        lab = dist.argmin(axis=2)           # the first NaN, if there is one
        return lab, np.take_along_axis(dist, lab[:, :, None], 2)[:, :, 0], np.full(lab.shape, -1.0), 0.0
    dist = (c.reshape(-1, d) @ x.T).reshape(n_restarts, k, len(x))
    dist *= -2.0
    dist += c2[:, :, None]
    dist += rest[:, :, code] if rest.shape[2] > 1 else rest
    dist[none] = np.inf
    best, second = dist[:, 0].copy(), np.full((n_restarts, len(x)), np.inf)
    lab = np.zeros((n_restarts, len(x)), np.int64)
    for j in range(1, k):
        less = dist[:, j] < best
        np.minimum(second, np.maximum(best, dist[:, j]), out=second)
        np.minimum(best, dist[:, j], out=best)
        lab[less] = j
    err = 16 * (d + 8) * _EPS * ((np.sqrt(x2) + np.sqrt(c2.max())) ** 2 + np.abs(rest).max())
    for r, near in enumerate(second - best <= err):
        if near.any():
            rows = np.flatnonzero(near)
            for lo in range(0, len(rows), BLOCK_ROWS):
                lab[r, rows[lo:lo + BLOCK_ROWS]] = exact(r, rows[lo:lo + BLOCK_ROWS]).argmin(axis=1)
    best = np.maximum(best + x2, 0.0)
    return lab, best, np.sqrt(np.maximum(second + x2, 0.0)) - np.sqrt(best), float(err.max())


def _sums(x: np.ndarray, code: np.ndarray, lab: np.ndarray, k: int, w: np.ndarray | None) -> np.ndarray:
    """Rows, coordinate sums and weighted value counts by restart and cluster."""
    member = lab[:, None, :] == np.arange(k)[None, :, None]
    n = member.sum(axis=2)
    if np.isfinite(x).all():
        total = member.reshape(-1, len(x)).astype(float) @ x
    else:
        total = np.stack([x[m].sum(axis=0) for m in member.reshape(-1, len(x))])
    parts = [n[:, :, None], total.reshape(len(lab), k, -1)]
    if w is not None:
        v = len(w) + 1
        parts.append(np.stack([np.bincount(row * v + code, minlength=k * v).reshape(k, v)[:, :-1] for row in lab]) * np.sqrt(w))
    return np.concatenate(parts, axis=2)


def _rows(block: bytes, d: int, w: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    x = np.frombuffer(block).reshape(-1, d + (w is not None))
    if w is None:
        return x, np.zeros(len(x), np.int64)
    return np.ascontiguousarray(x[:, :d]), x[:, d].astype(np.int64)


def _added(parts: RDD):
    """Sums of arrays and the maximum of the last member, over all tasks."""
    def add(a, b):
        return tuple(x + y for x, y in zip(a[:-1], b[:-1])) + (max(a[-1], b[-1]),)
    if parts.getNumPartitions() > DRIVER_SUMS:
        return parts.treeReduce(add)
    every = parts.collect()
    out = every[0]
    for x in every[1:]:
        out = add(out, x)
    return out


def full_pass(blocks: RDD, restarts: list[np.ndarray], d: int, w: np.ndarray | None):
    """Of all rows: sums by restart and cluster, cost and histogram of margins by restart, largest rounding."""
    c, rest, none = _stacked(restarts, d, w)

    def run(part):
        sums, cost = np.zeros((*c.shape[:2], 1 + d + (0 if w is None else len(w)))), np.zeros(len(c))
        hist, worst = np.zeros((len(c), _BINS)), 0.0
        for block in part:
            x, code = _rows(block, d, w)
            lab, best, margin, err = _nearest(x, code, c, rest, none)
            sums += _sums(x, code, lab, c.shape[1], w)
            cost += best.sum(axis=1)
            at = np.ceil(2.0 * (np.log2(np.clip(margin, 2.0 ** _LOW, 1e30)) - _LOW)).clip(0, _BINS - 1).astype(np.int64)
            hist += np.stack([np.bincount(row, minlength=_BINS) for row in at])
            worst = max(worst, err)
        yield sums, cost, hist, worst

    return _added(blocks.mapPartitions(run))


def _set_apart(blocks: RDD, restarts: list[np.ndarray], margins: np.ndarray, d: int, w: np.ndarray | None) -> RDD:
    """(restart, rows) of the rows whose margin is at most their restart's."""
    c, rest, none = _stacked(restarts, d, w)

    def run(part):
        held: list = [[] for _ in restarts]
        for block in part:
            x, code = _rows(block, d, w)
            margin = _nearest(x, code, c, rest, none)[2]
            every = np.frombuffer(block).reshape(len(x), -1)
            for r in range(len(c)):
                held[r].append(every[~(margin[r] > margins[r])])
                if sum(map(len, held[r])) >= BLOCK_ROWS:
                    yield r, np.concatenate(held[r]).tobytes()
                    held[r] = []
        for r, some in enumerate(held):
            if sum(map(len, some)):
                yield r, np.concatenate(some).tobytes()

    return blocks.mapPartitions(run).persist(StorageLevel.MEMORY_AND_DISK)


def _partial_pass(apart: RDD, restarts: dict[int, np.ndarray], d: int, w: np.ndarray | None) -> dict:
    """Sums by cluster of the rows set apart for the given restarts."""
    stacked = {r: _stacked([at], d, w) for r, at in restarts.items()}
    order = list(restarts)
    width = 1 + d + (0 if w is None else len(w))

    def run(part):
        sums = [np.zeros((stacked[r][0].shape[1], width)) for r in order]
        place = {r: i for i, r in enumerate(order)}
        for r, block in part:
            if r in place:
                x, code = _rows(block, d, w)
                lab = _nearest(x, code, *stacked[r])[0]
                sums[place[r]] += _sums(x, code, lab, stacked[r][0].shape[1], w)[0]
        yield *sums, 0.0

    return dict(zip(order, _added(apart.mapPartitions(run))[:-1]))


def _move(s: Restart, sums: np.ndarray, tol: float, drop_empty: bool) -> np.ndarray:
    """Centroids after a step; returns which clusters are left."""
    n = sums[:, 0]
    kept = n > 0 if drop_empty else np.ones(len(n), bool)
    new = np.where(n[:, None] > 0, sums[:, 1:] / np.maximum(n, 1)[:, None], s.at)
    far = np.linalg.norm(new - s.at, axis=1)
    far[(np.isnan(new) == np.isnan(s.at)).all(axis=1) & np.isnan(new).any(axis=1)] = 0.0     # a NaN stays one
    s.before, s.steps = (s.ids, s.at), s.steps + 1
    s.done, s.moved = bool(kept.all() and (far <= tol).all()), float(np.sort(far)[-2:].sum())
    s.ids, s.at = [i for i, k in zip(s.ids, kept) if k], new[kept]
    return kept


def _best_margin(hist: np.ndarray, moved: float, slack: float) -> float | None:
    """The margin below which rows are set apart so that a step costs least, in passes over all rows; None if that saves little."""
    if not moved < float("inf"):
        return None
    share = np.cumsum(hist) / max(hist.sum(), 1.0)
    margin = 2.0 ** (_LOW + np.arange(_BINS) / 2.0)
    steps = np.minimum((margin - slack) / max(moved, 1e-12), 100.0)
    cost = np.where(steps >= 2.0, share + 2.0 / np.maximum(steps, 2.0), np.inf)
    at = int(np.argmin(cost[:-1]))
    return float(margin[at]) if cost[at] < 0.6 else None


def iterate(blocks: RDD, starts: list[tuple[list, np.ndarray]], d: int, max_iter: int, tol: float, w: np.ndarray | None = None,
            drop_empty: bool = True) -> list[Restart]:
    """Lloyd steps from each start (ids, centroids) until its centroids stop moving, ``max_iter`` at most.

    A cluster without rows drops out, or keeps its centroid (``drop_empty=False``). ``cost``
    of a result is the sum of squared distances to ``before``.
    """
    states = [Restart(list(ids), np.asarray(at, float)) for ids, at in starts]
    while True:
        going = [s for s in states if not s.done and s.steps < max_iter]
        if not going:
            break
        found = [s.at for s in going]
        sums, cost, hist, err = full_pass(blocks, found, d, w)
        slack = 4.0 * err ** 0.5
        few = hist.sum() < APART_WORK * blocks.context.defaultParallelism
        apart, margins, others = [], [], {}
        for i, s in enumerate(going):
            mine = sums[i, :len(s.at)]
            s.cost = float(cost[i])
            kept = _move(s, mine, tol, drop_empty)
            margin = None if few or s.done or s.steps >= max_iter else _best_margin(hist[i], s.moved, slack)
            if margin is not None:
                apart.append((s, found[i], kept, mine))
                margins.append(margin)
        if not apart:
            continue
        rows = _set_apart(blocks, [at for _, at, _, _ in apart], np.array(margins), d, w)
        try:
            first = _partial_pass(rows, {r: at for r, (_, at, _, _) in enumerate(apart)}, d, w)
            origin = {}
            for r, (_s, at, kept, mine) in enumerate(apart):
                others[r], origin[r] = (mine - first[r])[kept], at[kept]
            while True:
                on = {}
                for r, (s, *_rest) in enumerate(apart):
                    if not s.done and s.steps < max_iter and r in others:
                        far = np.sort(np.linalg.norm(s.at - origin[r], axis=1))[-2:].sum()
                        if far < margins[r] - slack:
                            on[r] = s.at
                        else:
                            del others[r]
                waiting = sum(not s.done and s.steps < max_iter for s in states) - len(on)
                if len(on) < max(waiting, 1):       # the rest go on with those that wait for a pass over all rows
                    break
                for r, some in _partial_pass(rows, on, d, w).items():
                    s = apart[r][0]
                    kept = _move(s, others[r] + some, tol, drop_empty)
                    others[r], origin[r] = others[r][kept], origin[r][kept]
        finally:
            rows.unpersist()
    if states:      # the cost of what the last step found
        _, cost, _, _ = full_pass(blocks, [s.before[1] if s.before else s.at for s in states], d, w)
        for s, x in zip(states, cost):
            s.cost = float(x)
    return states
