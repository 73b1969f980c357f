"""Boosted trees over binned rows: the method of Spark's classifier with a few bytes a row.

Spark keeps each row of a fit as objects and adds every slot of it to the sums of its node, zeros
too. Here a row is the bins of its slots that are not in the bin of zero, packed in blocks, and the
sums of a level are numpy counts over a block; what zeros add is the rest of the node. Trees, sample,
loss and bins follow Spark's classifier, and the result is its model: scoring and saving stay Spark's.
"""

from __future__ import annotations

import json
import pickle
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyspark.ml.classification as ml
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.classification import GBTClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelift.session import FEW_ROWS, MANY_ROWS, delete_folder, scratch_path

BLOCK_ROWS = 32_768
#: Bytes of the sums of a task; nodes of a level beyond that take another pass.
SUMS_BYTES = 64 << 20
#: Results of more tasks than this are added up before they reach the driver.
MANY_TASKS = 64
#: Rows from which the limits of bins are found: at least so many, as in Spark.
BIN_ROWS = 10_000
#: Rows below which Spark's own fit is the shorter one: its steps cost less to start.
LEAST_ROWS = 1_000_000
#: Trees that every pass adds to the scores, before these are written again.
LATEST = 4
NO_SPLIT = (-1, [], -1)


@dataclass(frozen=True)
class Bins:
    """The bins of all slots side by side; a value on a limit belongs to the bin before it."""

    limits: list[np.ndarray]
    column: np.ndarray  # of each slot; slots that are seldom filled together share one
    start: np.ndarray = field(init=False)
    size: np.ndarray = field(init=False)
    zero: np.ndarray = field(init=False)
    total: int = field(init=False)

    def __post_init__(self) -> None:
        size = np.array([len(x) + 1 for x in self.limits], np.int64)
        object.__setattr__(self, "size", size)
        object.__setattr__(self, "start", np.cumsum(size) - size)
        object.__setattr__(self, "zero", np.array([np.searchsorted(x, 0.0) for x in self.limits], np.int64))
        object.__setattr__(self, "total", int(size.sum()))

    def encode(self, vectors: pa.StructArray) -> np.ndarray:
        """The bins of each row that are not those of zero, filled up with ``total``.

        Each is in the column of its slot; where that is taken already, in one of more columns.
        """
        n, rows, slots, values = entries(vectors)
        first = np.array([x[0] if len(x) else np.inf for x in self.limits])
        bins = (values > first[slots]).astype(np.int64)
        for s in np.flatnonzero(self.size > 2):
            mine = np.flatnonzero(slots == s)
            bins[mine] = np.searchsorted(self.limits[s], values[mine])
        kept = bins != self.zero[slots]
        rows, slots, bins = rows[kept], slots[kept], bins[kept]
        codes = self.start[slots] + bins
        kind = np.uint16 if self.total < 1 << 16 else np.int32
        out = np.full((self.columns, n), self.total, kind)
        place = self.column[slots] * n + rows
        out.ravel()[place] = codes
        if len(place) == np.count_nonzero(out < self.total):
            return out
        lost = np.ones(len(place), bool)
        lost[np.unique(place, return_index=True)[1]] = False
        out.ravel()[place[~lost]] = codes[~lost]
        rows, codes = rows[lost], codes[lost]
        counts = np.bincount(rows, minlength=n)
        more = np.full((int(counts.max()), n), self.total, kind)
        more[np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts), rows] = codes
        return np.concatenate([out, more])

    @property
    def columns(self) -> int:
        return int(self.column.max(initial=-1)) + 1


def share_columns(slots: int, row: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """A column for each slot: the first in which no row of the sample has another slot."""
    order = np.argsort(slot, kind="stable")
    ends = np.searchsorted(slot[order], np.arange(slots + 1))
    taken: list[np.ndarray] = []
    column = np.zeros(slots, np.int64)
    for s in range(slots):
        mine = row[order[ends[s] : ends[s + 1]]]
        at = next((i for i, rows in enumerate(taken) if not rows[mine].any()), len(taken))
        if at == len(taken):
            taken.append(np.zeros(int(row.max(initial=-1)) + 1, bool))
        taken[at][mine] = True
        column[s] = at
    return column


def entries(vectors: pa.StructArray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """(rows, then row, slot and value of each entry) of dense and sparse vectors."""
    kinds, _, indices, values = vectors.flatten()
    counts = values.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    n = len(counts)
    rows = np.repeat(np.arange(n), counts)
    slots = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    sparse = np.repeat(kinds.to_numpy(zero_copy_only=False) == 0, counts)
    slots[sparse] = indices.drop_null().flatten().to_numpy(zero_copy_only=False)
    return n, rows, slots, values.flatten().to_numpy(zero_copy_only=False)


def limits_of(values: np.ndarray, weights: np.ndarray, most: int) -> np.ndarray:
    """At most ``most`` limits between the distinct values, close to even weights, as Spark sets them."""
    distinct, place = np.unique(values, return_inverse=True)
    if len(distinct) <= 1:
        return np.empty(0)
    middle = (distinct[:-1] + distinct[1:]) / 2
    if len(middle) <= most:
        return middle
    below = np.cumsum(np.bincount(place, weights=weights))
    stride = below[-1] / (most + 1)
    out, target = [], stride
    for i in range(1, len(distinct)):
        if abs(below[i - 1] - target) < abs(below[i] - target):
            out.append(middle[i - 1])
            target += stride
    return np.array(out)


def learn_bins(rows: DataFrame, n: int, slots: int, binary: set[int], most: int, seed: int) -> Bins:
    """Limits from a sample as large as Spark's; a slot known to be 0 or 1 needs none."""
    want = max(most * most, BIN_ROWS)
    sample = rows if n <= want else rows.sample(want / n, seed)
    table = sample.select("v", "w").toArrow()
    vectors = table["v"].combine_chunks() if table.num_rows else None
    limits = [np.array([0.5]) if s in binary else np.empty(0) for s in range(slots)]
    if vectors is None:
        return Bins(limits, np.arange(slots))
    weight = table["w"].to_numpy()
    count, at, slot, value = entries(vectors)
    order = np.argsort(slot, kind="stable")
    ends = np.searchsorted(slot[order], np.arange(slots + 1))
    for s in range(slots):
        if s in binary:
            continue
        mine = order[ends[s] : ends[s + 1]]
        values, weights = np.zeros(count), weight
        values[at[mine]] = value[mine]
        limits[s] = limits_of(values, weights, min(most, n) - 1)
    filled = value != 0
    return Bins(limits, share_columns(slots, at[filled], slot[filled]))


@dataclass
class Node:
    """A node of a tree; sums are weight, weighted target, its square, and rows."""

    value: float = 0.0
    sums: np.ndarray | None = None
    gain: float = -1.0
    slot: int = -1
    limit: float = 0.0
    left: Node | None = None
    right: Node | None = None

    @property
    def impurity(self) -> float:
        w, x, xx, _ = self.sums
        return float((xx - x * x / w) / w) if w > 0 else 0.0


#: A single bit times this has its number in the six highest bits.
BITS = np.uint64(0x03F79D71B4CB0A89)
PLACE = np.zeros(64, np.int64)
PLACE[(BITS << np.arange(64, dtype=np.uint64)) >> np.uint64(58)] = np.arange(64)


@dataclass
class Path:
    """The way down some levels of a tree.

    Of each level: the column that a node looks at, where each bin leads to, whether that is not
    where zero leads to, and the children. Up to 64 nodes: what can be reached from each bin of a column.
    """

    width: int
    columns: int
    steps: list[tuple] = field(default_factory=list)
    masks: np.ndarray | None = None

    def reach(self, root: Node, nodes: list[Node], bins: Bins) -> None:
        if len(nodes) > 64 or not bins.columns:
            self.masks = None
            return
        place = {id(node): i for i, node in enumerate(nodes)}
        full = (1 << 64) - 1
        masks = np.full((self.columns, self.width), full, np.uint64)

        def visit(node: Node) -> int:
            if id(node) in place:
                return 1 << place[id(node)]
            left, right = visit(node.left), visit(node.right)
            start, size, zero = (int(x[node.slot]) for x in (bins.start, bins.size, bins.zero))
            cut = int(np.searchsorted(bins.limits[node.slot], node.limit))
            side = np.full(self.width, zero > cut)
            side[start : start + size] = np.arange(size) > cut
            mask = masks[bins.column[node.slot]]
            mask &= np.where(side, np.uint64(full ^ left), np.uint64(full ^ right))
            return left | right

        seen = visit(root)
        masks &= np.uint64(seen)
        self.masks = masks


@dataclass
class Block:
    """Rows of a task: bins, label as -1 or 1, weight (None: all 1) and the sum of trees, but the latest."""

    number: tuple[int, int]
    codes: np.ndarray
    label: np.ndarray
    weight: np.ndarray | None
    score: np.ndarray

    def target(self, tree: int, score: np.ndarray) -> np.ndarray:
        """What a tree is fitted to: the label first, then the negative gradient of the logistic loss."""
        if not tree:
            return self.label.astype(np.float64)
        with np.errstate(over="ignore"):
            return 4.0 * self.label / (1.0 + np.exp(2.0 * self.label * score))

    def sample(self, tree: int, rate: float, seed: int) -> np.ndarray:
        """1 for the rows that a tree sees, else 0; the same in every pass."""
        if rate >= 1.0:
            return np.ones(len(self.label))
        drawn = np.random.default_rng([seed & 0xFFFFFFFFFFFFFFFF, tree, *self.number])
        return (drawn.random(len(self.label), np.float32) < rate).astype(np.float64)

    def seen(self, tree: int, score: np.ndarray, rate: float, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(1 or 0, weight, target) of each row in the fit of a tree."""
        seen = self.sample(tree, rate, seed)
        return seen, seen if self.weight is None else seen * self.weight, self.target(tree, score)

    def walk(self, path: Path, codes: list[np.ndarray]) -> np.ndarray:
        """The node of each row after some levels."""
        n, columns = len(self.label), path.columns
        if not path.steps:
            return np.zeros(n, np.int64)
        if path.masks is not None and len(codes) == columns:
            # each bin leaves the nodes that can be reached from it, and all bins of a row leave one
            left = path.masks[0].take(codes[0])
            for mask, column in zip(path.masks[1:], codes[1:], strict=True):
                left &= mask.take(column)
            left *= BITS
            left >>= np.uint64(58)
            return PLACE.take(left.view(np.int64))
        node, row = np.zeros(n, np.int64), np.arange(n)
        flat = self.codes.ravel()
        for column, sides, flips, child in path.steps:
            base = node * path.width
            # a node looks at one slot, and that is in one column
            side = sides.take(base + flat.take((column * n).take(node) + row))
            for more in codes[columns:]:
                side = side ^ flips.take(base + more)
            node = child.take(2 * node + side)
        return node


def sums_of(node: np.ndarray, seen: np.ndarray, weight: np.ndarray, target: np.ndarray, n: int) -> np.ndarray:
    wt = weight * target
    return np.stack([np.bincount(node, x, n)[:n] for x in (weight, wt, wt * target, seen)], axis=1)


def level_sums(path: Path, low: int, high: int, latest: list[Grown], tree: int, rate: float, seed: int) -> Callable:
    """Of the nodes ``low`` to ``high``: sums per bin and in all; at the root, of the last tree's leaves too."""

    def run(blocks: Iterator[Block]) -> Iterator[tuple]:
        n, width = high - low, path.width
        bins, whole, leaves = np.zeros((3, n * width)), np.zeros((n, 4)), None
        some = False
        for block in blocks:
            some = True
            codes = list(block.codes.astype(np.int64))
            node = block.walk(path, codes)
            node = np.minimum(node, n) if not low else np.where((node >= low) & (node < high), node - low, n)
            score = block.score
            for grown in latest:
                before, at_leaf = score, block.walk(grown.path, codes)
                score = score + grown.values.take(at_leaf)
            if latest and not path.steps and not low:
                last = len(latest[-1].values)
                found = sums_of(at_leaf, *block.seen(tree - 1, before, rate, seed), last)
                leaves = found if leaves is None else leaves + found
            seen, weight, target = block.seen(tree, score, rate, seed)
            wt = weight * target
            if codes:
                whole[:, 2] += np.bincount(node, wt * target, n)[:n]
            else:
                whole += sums_of(node, seen, weight, target, n)
            # where all weights are 1 the rows are the weight
            added = (weight, wt) if block.weight is None else (weight, wt, seen)
            node = node * width
            for k, column in enumerate(codes):
                column += node
                for i, x in enumerate(added):
                    found = np.bincount(column, x, n * width)[: n * width]
                    bins[i] += found
                    if block.weight is None and not i:
                        bins[2] += found
                    if not k:  # each row is in each column once
                        at_node = found.reshape(n, width).sum(axis=1)
                        whole[:, (0, 1, 3)[i]] += at_node
                        if block.weight is None and not i:
                            whole[:, 3] += at_node
        if some:
            yield bins, whole, leaves

    return run


def add(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1], None if a[2] is None else a[2] + b[2]


@dataclass
class Grown:
    """A tree that the scores of the blocks do not hold yet: the way down, and what its leaves add."""

    path: Path
    values: np.ndarray


def add_trees(latest: list[Grown]) -> Callable:
    def run(block: Block) -> Block:
        codes, score = list(block.codes), block.score
        for grown in latest:
            score = score + grown.values.take(block.walk(grown.path, codes))
        return Block(block.number, block.codes, block.label, block.weight, score)

    return run


def best_splits(bins: Bins, found: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, ...]:
    """(gain, position of the best bin, weight and target on the left) of each node, by variance."""
    n = len(whole)
    sums = found.reshape(3, n, bins.total + 1)[:, :, :-1].copy()
    of_node = whole.T[[0, 1, 3]]
    at_zero = bins.start + bins.zero
    sums[:, :, at_zero] += of_node[:, :, None] - np.add.reduceat(sums, bins.start, axis=2)
    left = np.cumsum(sums, axis=2)
    before = np.concatenate([np.zeros((3, n, 1)), left[:, :, bins.start[1:] - 1]], axis=2)
    left -= np.repeat(before, bins.size, axis=2)
    (w, x, rows), (all_w, all_x, all_rows) = left, of_node[:, :, None]
    last = np.zeros(bins.total, bool)
    last[bins.start + bins.size - 1] = True
    # sums of rows are whole numbers, but for what is rounded off in differences
    valid = (rows > 0.5) & (all_rows - rows > 0.5) & ~last
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (x * x / w + (all_x - x) ** 2 / (all_w - w) - all_x * all_x / all_w) / all_w
    gain = np.where(valid & np.isfinite(gain), gain, -1.0)
    best = gain.argmax(axis=1)
    mine = np.arange(n)
    return gain[mine, best], best, w[mine, best], x[mine, best]


class Boost:
    """One fit: the blocks of its rows and the trees so far.

    The scores of the rows are written again after some trees only; until then every pass adds these.
    """

    def __init__(self, rows: RDD, bins: Bins, depth: int, rate: float, seed: int) -> None:
        self.rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        self.bins, self.depth, self.rate, self.seed = bins, depth, rate, seed
        self.before: RDD | None = None
        self.latest: list[Grown] = []
        self.leaves: list[Node] = []
        self.rounds = 0
        self.saved: str | None = None

    def _pass(self, path: Path, low: int, high: int, tree: int) -> tuple[np.ndarray, np.ndarray]:
        run = level_sums(path, low, high, self.latest, tree, self.rate, self.seed)
        parts = self.rows.mapPartitions(run)
        found = parts.treeReduce(add) if parts.getNumPartitions() > MANY_TASKS else reduce(add, parts.collect())
        if self.before is not None:  # this pass has made the rows that follow them
            self.before.unpersist()
            self.before = None
        if found[2] is not None:
            for node, sums in zip(self.leaves, found[2], strict=True):
                node.sums = sums
        return found[0], found[1]

    def _levels(self, tree: int, save_every: int) -> tuple[Node, list[Node], Path]:
        bins, width = self.bins, self.bins.total + 1
        root = Node()
        active, done, path = [root], [], Path(width, bins.columns)
        group = max(1, SUMS_BYTES // (24 * width))
        for level in range(self.depth):
            # rows of leaves stay where they are
            count = len(active) + len(done)
            flips, right, column = np.zeros((count, width), np.uint8), np.zeros(count, np.uint8), np.zeros(count, np.int64)
            nodes = []
            for low in range(0, len(active), group):
                mine = active[low : low + group]
                found, whole = self._pass(path, low, low + len(mine), tree)
                for j, (node, gain, best, w, x) in enumerate(zip(mine, *best_splits(bins, found, whole), strict=True)):
                    node.sums = whole[j]
                    node.value = float(whole[j, 1] / whole[j, 0]) if whole[j, 0] > 0 else 0.0
                    if gain <= 0 or abs(node.impurity) < np.finfo(float).eps:
                        nodes.append((node, None))
                        continue
                    slot = int(np.searchsorted(bins.start, best, "right")) - 1
                    cut = int(best - bins.start[slot])
                    node.gain, node.slot, node.limit = float(gain), slot, float(bins.limits[slot][cut])
                    node.left = Node(float(x / w))
                    node.right = Node(float((whole[j, 1] - x) / (whole[j, 0] - w)))
                    to_right = np.arange(bins.size[slot]) > cut
                    right[low + j], column[low + j] = bins.zero[slot] > cut, bins.column[slot]
                    flips[low + j, bins.start[slot] : bins.start[slot] + bins.size[slot]] = to_right ^ bool(right[low + j])
                    nodes.append((node, (node.left, node.right)))
            if not level and len(self.latest) >= LATEST:
                self._add_latest(save_every)
            grown = [c for _, children in nodes if children for c in children]
            ended = [node for node, children in nodes if not children] + done
            after = ended if level + 1 < self.depth else grown + ended
            place = {id(c): i for i, c in enumerate([*grown, *ended])}
            child = [place[id(c)] for node, children in nodes for c in (children or (node, node))]
            child += [place[id(c)] for c in done for _ in range(2)]
            path.steps.append((column, (flips ^ right[:, None]).ravel(), flips.ravel(), np.array(child, np.int64)))
            active, done = (grown, after) if level + 1 < self.depth else ([], after)
            path.reach(root, [*active, *done], bins)
            if not active:
                break
        return root, done, path

    def grow(self, tree: int, part: float, save_every: int) -> Node:
        """The next tree."""
        root, self.leaves, path = self._levels(tree, save_every)
        self.latest.append(Grown(path, part * np.array([c.value for c in self.leaves])))
        return root

    def _add_latest(self, save_every: int) -> None:
        """Write the scores with the latest trees, and now and then to the shared folder too.

        Else what makes the rows would grow longer with every tree.
        """
        self.before, self.rows = self.rows, self.rows.map(add_trees(self.latest)).persist(StorageLevel.MEMORY_AND_DISK)
        self.latest = []
        self.rounds += 1
        if save_every > 0 and self.rounds % save_every == 0:
            spark = SparkSession.active()
            if not self.rows.context.getCheckpointDir():
                self.rows.context.setCheckpointDir(scratch_path(spark, "fits"))
            self.rows.checkpoint()
            self.rows.count()
            old, self.saved = self.saved, self.rows.getCheckpointFile()
            if old:
                delete_folder(spark, old)

    def finish(self, trees: int) -> None:
        """The sums of the last leaves."""
        self._pass(Path(self.bins.total + 1, self.bins.columns), 0, 1, trees)

    def close(self) -> None:
        for rows in (self.rows, self.before):
            if rows is not None:
                rows.unpersist()
        if self.saved:
            delete_folder(SparkSession.active(), self.saved)


def pruned(node: Node) -> Node:
    """Leaves of one parent with equal values are one leaf, as in Spark."""
    if node.left is None:
        return node
    node.left, node.right = pruned(node.left), pruned(node.right)
    if node.left.left is None and node.right.left is None and node.left.value == node.right.value:
        return Node(node.left.value, node.sums)
    return node


def node_rows(root: Node) -> list[tuple]:
    """The nodes of a tree as Spark stores them, a parent before its left and its right side."""
    rows: list = []

    def visit(node: Node) -> int:
        here = len(rows)
        rows.append(None)
        w, x, xx, n = map(float, node.sums)
        left, right, split = -1, -1, NO_SPLIT
        if node.left is not None:
            left, right = visit(node.left), visit(node.right)
            split = (node.slot, [node.limit], -1)
        gain = node.gain if node.left is not None else -1.0
        rows[here] = (here, node.value, node.impurity, [w, x, xx], round(n), gain, left, right, split)
        return here

    visit(root)
    return rows


class GBTClassifier(ml.GBTClassifier):
    """Spark's classifier, fitted over binned blocks where rows are many and its settings the plain ones."""

    def _plain(self, df: DataFrame) -> bool:
        """Whether the fit is one that is done here; all others are left to Spark."""
        groups = df.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("attrs", {})
        same = {"featureSubsetStrategy": "all", "lossType": "logistic", "impurity": "variance"}
        same |= {"minInstancesPerNode": 1, "minInfoGain": 0.0, "minWeightFractionPerNode": 0.0}
        return (
            all(self.getOrDefault(name) == value for name, value in same.items())
            and not self.isDefined("validationIndicatorCol")
            and not self.isDefined("thresholds")
            and bool(df.schema[self.getFeaturesCol()].metadata.get("ml_attr", {}).get("num_attrs"))
            and "nominal" not in groups
            and self.getMaxDepth() > 0
        )

    def _fit(self, df: DataFrame) -> GBTClassificationModel:
        if not self._plain(df):
            return super()._fit(df)
        spark, seed = df.sparkSession, self.getSeed()
        about = df.schema[self.getFeaturesCol()].metadata["ml_attr"]
        slots, binary = int(about["num_attrs"]), {a["idx"] for a in about.get("attrs", {}).get("binary", [])}
        weighted = self.isDefined("weightCol") and self.getWeightCol()
        rows = df.select(
            F.unwrap_udt(F.col(self.getFeaturesCol())).alias("v"),
            F.col(self.getLabelCol()).cast("double").alias("y"),
            (F.col(self.getWeightCol()).cast("double") if weighted else F.lit(1.0)).alias("w"),
        )
        bad = F.col("y").isNull() | ~F.col("y").isin(0.0, 1.0) | F.col("w").isNull() | (F.col("w") < 0)
        n, wrong = rows.select(F.count(F.lit(1)), F.count_if(bad)).first()
        if wrong or n < max(1, LEAST_ROWS):
            return super()._fit(df)  # which says what is wrong
        bins = learn_bins(rows, n, slots, binary, self.getMaxBins(), seed)
        parts = max(1, min(spark.sparkContext.defaultParallelism, -(-n // FEW_ROWS)), -(-n // MANY_ROWS))
        most = max(1, min(BLOCK_ROWS, -(-n // parts)))

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # what is drawn for a block follows its place in the input, not the order of a shuffle
            part, count = TaskContext.get().partitionId(), 0
            for batch in batches:
                for low in range(0, batch.num_rows, most):
                    piece = batch.slice(low, most)
                    label, weight = piece["y"].to_numpy(), piece["w"].to_numpy()
                    block = (
                        (part, count),
                        bins.encode(pa.concat_arrays([piece["v"]])),
                        (2 * label - 1).astype(np.int8),
                        None if (weight == 1).all() else weight,
                    )
                    count += 1
                    yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(block, 5)], pa.binary())], names=["block"])

        def open_block(row) -> Block:
            number, codes, label, weight = pickle.loads(row[0])
            return Block(number, codes, label, weight, np.zeros(len(label)))

        packed = rows.mapInArrow(pack, "block binary").repartition(parts).rdd
        fit = Boost(packed.map(open_block), bins, self.getMaxDepth(), self.getSubsamplingRate(), seed)
        try:
            weights = [1.0] + [self.getStepSize()] * (self.getMaxIter() - 1)
            trees = [fit.grow(i, part, self.getCheckpointInterval()) for i, part in enumerate(weights)]
            fit.finish(len(trees))
        finally:
            fit.close()
        return self._copyValues(self._model(df, [pruned(t) for t in trees], weights, slots))

    def _model(self, df: DataFrame, trees: list[Node], weights: list[float], slots: int) -> GBTClassificationModel:
        """The trees as Spark's model, by way of the files in which Spark keeps one."""
        spark = df.sparkSession
        path = scratch_path(spark, "model")

        def about(kind: str, uid: str, **more) -> str:
            known = {
                "class": f"org.apache.spark.ml.{kind}",
                "timestamp": int(time.time() * 1000),
                "sparkVersion": spark.version,
                "uid": uid,
                "paramMap": {},
                "defaultParamMap": {},
            }
            return json.dumps(known | more)

        params = {p.name: v for p, v in self._paramMap.items()}
        defaults = {p.name: v for p, v in self._defaultParamMap.items()}
        note = about(
            "classification.GBTClassificationModel", self.uid, paramMap=params, defaultParamMap=defaults,
            numFeatures=slots, numTrees=len(trees),
        )
        spark.createDataFrame([(note,)], "value string").coalesce(1).write.text(f"{path}/metadata")
        of_tree = {"defaultParamMap": {"impurity": "variance"}}
        notes = [
            (i, about("regression.DecisionTreeRegressionModel", f"dtr_{self.uid}_{i}", numFeatures=slots, **of_tree), w)
            for i, w in enumerate(weights)
        ]
        spark.createDataFrame(notes, "treeID int, metadata string, weights double").coalesce(1).write.parquet(f"{path}/treesMetadata")
        data = [(i, row) for i, tree in enumerate(trees) for row in node_rows(tree)]
        split = "struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>"
        node = f"""struct<id int, prediction double, impurity double, impurityStats array<double>, rawCount bigint,
            gain double, leftChild int, rightChild int, split {split}>"""
        spark.createDataFrame(data, f"treeID int, nodeData {node}").coalesce(1).write.parquet(f"{path}/data")
        return GBTClassificationModel.load(path)
