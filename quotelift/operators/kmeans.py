"""Shared-scan k-means: many fits moved together, one scan of the points per step.

A sweep over K, scalings and restarts is hundreds of fits of the same points. Fitted one by one,
each costs jobs of its own; here one scan assigns every point in every fit that still moves
and adds up counts and sums per centre, so jobs grow with the steps and not with the fits.

Starts come from one oversample per space (k-means||): in a few scans points far from the chosen ones are
drawn by a hash of their values, so a run can be repeated. The drawn points, weighted by the points
nearest to them, are few whatever the table's size, and are reduced to K starts on the driver.

The distances of all points to all centres are matrix products over Arrow batches; only sums per
centre leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A fit ends when its centres move by less than this share of the mean variance of a coordinate.
MAX_STEPS, TOLERANCE = 100, 1e-4
DRAWS = 3  # scans that draw start candidates
ROWS = 2048  # points whose distances to all centres are held at once


@dataclass
class Fit:
    """One k-means fit; ``space`` names the columns it looks at."""

    space: str
    k: int
    restart: int
    centers: np.ndarray
    inertia: float = np.inf
    silhouette: float = 0.0
    steps: int = 0


def _blocks(batches: Iterator[pa.RecordBatch], columns: Sequence[str]) -> Iterator[np.ndarray]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            block = np.column_stack([part.column(c).to_numpy(zero_copy_only=False) for c in columns])
            if np.isnan(block).any():
                raise ValueError("points with missing values cannot be clustered")
            yield block


def _distances(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    far = (points**2).sum(axis=1)[:, None] - 2 * points @ centers.T + (centers**2).sum(axis=1)
    return np.maximum(far, 0)


class _Scan:
    """Scans of the points for groups of centres, each group in one space.

    ``points`` has double columns without NULLs; all spaces have as many columns.
    """

    def __init__(self, points: DataFrame, spaces: Mapping[str, Sequence[str]]):
        self.points, self.spaces = points, {s: list(c) for s, c in spaces.items()}
        self.width = len(next(iter(self.spaces.values())))
        if any(len(c) != self.width for c in self.spaces.values()):
            raise ValueError("spaces differ in their number of columns")

    def _places(self, groups: Sequence[tuple[str, np.ndarray]]):
        """Columns read, and for each space its columns, groups, stacked centres and their edges."""
        read = sorted({c for s, _ in groups for c in self.spaces[s]})
        plan = []
        for space in dict.fromkeys(s for s, _ in groups):
            mine = [i for i, (s, _) in enumerate(groups) if s == space]
            edges = np.cumsum([0, *(len(groups[i][1]) for i in mine)])
            own = [read.index(c) for c in self.spaces[space]]
            plan.append((own, mine, np.vstack([groups[i][1] for i in mine]), edges))
        return read, plan

    def sums(self, groups: Sequence[tuple[str, np.ndarray]]) -> list[np.ndarray]:
        """For each group an array (centre, [n, squared distance, squared norm, *coordinates])."""
        read, plan = self._places(groups)
        width, first = self.width, np.cumsum([0, *(len(c) for _, c in groups)])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((first[-1], 3 + width))
            for block in _blocks(batches, read):
                for own, mine, centers, edges in plan:
                    x = block[:, own]
                    far, norm = _distances(x, centers), (x**2).sum(axis=1)
                    for i, lo, hi in zip(mine, edges, edges[1:], strict=False):
                        part = far[:, lo:hi]
                        label = part.argmin(axis=1)
                        values = [None, part[np.arange(len(x)), label], norm, *x.T]
                        for j, v in enumerate(values):
                            total[first[i] : first[i + 1], j] += np.bincount(label, v, hi - lo)
            used = np.flatnonzero(total[:, 0])
            columns = [pa.array(used.astype(np.int32))] + [pa.array(total[used, j]) for j in range(3 + width)]
            yield pa.RecordBatch.from_arrays(columns, names=["slot", *(f"v{j}" for j in range(3 + width))])

        names = [f"v{j}" for j in range(3 + width)]
        schema = "slot int, " + ", ".join(f"{n} double" for n in names)
        found = self.points.select(read).mapInArrow(run, schema).groupBy("slot").agg(*[F.sum(n).alias(n) for n in names])
        out = np.zeros((first[-1], 3 + width))
        for row in found.collect():  # one row per centre
            out[row["slot"]] = [row[n] for n in names]
        return [out[a:b] for a, b in zip(first, first[1:], strict=False)]

    def draw(self, groups: Sequence[tuple[str, np.ndarray]], costs: Sequence[float], take: float, seed: int) -> list[np.ndarray]:
        """For each group points drawn with probability take * squared distance / cost."""
        read, plan = self._places(groups)
        width = self.width
        hashed = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *read), 11) / F.lit(float(1 << 53))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches, [*read, "_u"]):
                for own, mine, centers, edges in plan:
                    x = block[:, own]
                    far = _distances(x, centers)
                    for i, lo, hi in zip(mine, edges, edges[1:], strict=False):
                        hit = x[block[:, -1] * costs[i] < take * far[:, lo:hi].min(axis=1)]
                        columns = [pa.array(np.full(len(hit), i, np.int32))] + [pa.array(hit[:, j]) for j in range(width)]
                        yield pa.RecordBatch.from_arrays(columns, names=["g", *(f"x{j}" for j in range(width))])

        names = [f"x{j}" for j in range(width)]
        schema = "g int, " + ", ".join(f"{n} double" for n in names)
        rows = self.points.select(*read, hashed.alias("_u")).mapInArrow(run, schema).distinct()
        out: list[list] = [[] for _ in groups]
        for row in rows.collect():  # about ``take`` points for each group
            out[row["g"]].append([row[n] for n in names])
        return [np.array(sorted(x)).reshape(-1, width) for x in out]

    def silhouettes(self, groups: Sequence[tuple[str, np.ndarray]], sums: Sequence[np.ndarray]) -> list[float]:
        """Mean silhouette of each group, by squared distances, from the sums of its centres."""
        read, plan = self._places(groups)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(groups), 2))
            for block in _blocks(batches, read):
                for own, mine, centers, edges in plan:
                    x = block[:, own]
                    far, norm, row = _distances(x, centers), (x**2).sum(axis=1), np.arange(len(x))
                    for i, lo, hi in zip(mine, edges, edges[1:], strict=False):
                        label, n = far[:, lo:hi].argmin(axis=1), sums[i][:, 0]
                        held = np.maximum(n, 1)
                        apart = norm[:, None] + sums[i][:, 2] / held - 2 * x @ (sums[i][:, 3:] / held[:, None]).T
                        apart[:, n == 0] = np.inf
                        inside = np.maximum(apart[row, label], 0) * n[label] / np.maximum(n[label] - 1, 1)
                        apart[row, label] = np.inf
                        outside = apart.min(axis=1)
                        most = np.maximum(inside, outside)
                        ok = (n[label] > 1) & np.isfinite(outside) & (most > 0)
                        total[i] += ((outside - inside)[ok] / most[ok]).sum(), len(x)
            columns = [pa.array(np.arange(len(groups), dtype=np.int32)), pa.array(total[:, 0]), pa.array(total[:, 1])]
            yield pa.RecordBatch.from_arrays(columns, names=["g", "s", "n"])

        found = self.points.select(read).mapInArrow(run, "g int, s double, n double").groupBy("g").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
        by_group = {r["g"]: r["s"] / r["n"] for r in found.collect() if r["n"]}  # one row per fit
        return [by_group.get(i, 0.0) for i in range(len(groups))]


def _starts(points: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k-means++ over weighted points, then a few steps among them."""
    chosen = [points[rng.choice(len(points), p=weights / weights.sum())]]
    while len(chosen) < k:
        mass = _distances(points, np.array(chosen)).min(axis=1) * weights
        if mass.sum() <= 0:  # fewer different points than centres
            break
        chosen.append(points[rng.choice(len(points), p=mass / mass.sum())])
    centers = np.array(chosen)
    for _ in range(10):
        label = _distances(points, centers).argmin(axis=1)
        n = np.bincount(label, weights, len(centers))
        moved = np.stack([np.bincount(label, weights * x, len(centers)) for x in points.T], axis=1)
        centers = np.where(n[:, None] > 0, moved / np.maximum(n, 1e-300)[:, None], centers)
    return centers


def fit_all(
    points: DataFrame,
    spaces: Mapping[str, Sequence[str]],
    ks: Sequence[int],
    restarts: int,
    seed: int,
    max_steps: int = MAX_STEPS,
) -> list[Fit]:
    """The best of ``restarts`` fits for each space and K, with inertia and silhouette.

    ``points`` is scanned about ``2 * DRAWS + steps + 4`` times; write it first. A fit has fewer
    than K centres where the points have fewer different values; a centre that loses all its
    points stays where it is. A table without rows is an error.
    """
    scan, take = _Scan(points, spaces), 2.0 * max(ks)
    columns = sorted({c for cols in spaces.values() for c in cols})
    one = points.select(columns).orderBy(F.xxhash64(F.lit(seed), *columns), *columns).limit(1).collect()
    if not one:
        raise ValueError("no points to cluster")
    drawn = {s: np.array([[one[0][c] for c in cols]], float) for s, cols in spaces.items()}
    names = list(spaces)
    spread = {}
    for turn in range(DRAWS):
        groups = [(s, drawn[s]) for s in names]
        totals = scan.sums(groups)
        costs = [float(t[:, 1].sum()) for t in totals]
        for s, t in zip(names, totals, strict=True):
            mean = t[:, 3:].sum(axis=0) / t[:, 0].sum()
            spread[s] = max(0.0, float(t[:, 2].sum() / t[:, 0].sum() - (mean**2).sum())) / scan.width
        for s, more in zip(names, scan.draw(groups, costs, take, seed + 1 + turn), strict=True):
            drawn[s] = np.unique(np.vstack([drawn[s], more]), axis=0)
    weights = dict(zip(names, scan.sums([(s, drawn[s]) for s in names]), strict=True))
    fits = [
        Fit(s, k, r, _starts(drawn[s], weights[s][:, 0] + 1e-9, k, np.random.default_rng([seed, names.index(s), k, r])))
        for s in names
        for k in ks
        for r in range(restarts)
    ]
    moving = fits
    for step in range(1, max_steps + 1):
        still = []
        for fit, total in zip(moving, scan.sums([(f.space, f.centers) for f in moving]), strict=True):
            n = total[:, :1]
            moved = np.where(n > 0, total[:, 3:] / np.maximum(n, 1), fit.centers)
            far = ((moved - fit.centers) ** 2).sum()
            fit.centers, fit.steps = moved, step
            if far > TOLERANCE * spread[fit.space]:
                still.append(fit)
        moving = still
        if not moving:
            break
    ended = scan.sums([(f.space, f.centers) for f in fits])
    for fit, total in zip(fits, ended, strict=True):
        fit.inertia = float(total[:, 1].sum())
    kept = [
        min((f for f in fits if (f.space, f.k) == (s, k)), key=lambda f: (f.inertia, f.restart)) for s in names for k in ks
    ]
    groups = [(f.space, f.centers) for f in kept]
    for fit, value in zip(kept, scan.silhouettes(groups, scan.sums(groups)), strict=True):
        fit.silhouette = value
    return kept
