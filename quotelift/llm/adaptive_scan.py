"""Nearest neighbours by an adaptive dimension scan over probed lists.

Largest inner product is turned into smallest distance by one further coordinate that brings
all rows to one norm. Vectors are rotated at random, so that the first columns of a difference
say how long it is: after each block of columns the distance so far, scaled up to all columns,
is tested against the query's current bound, and candidates that would be too far with high
confidence are given up; after the last block the test is exact. Candidates lie in lists around
centroids; a query looks into the lists nearest to it.

Centroids, bounds to start from and the number of lists to look into come from a bounded
sample (``SAMPLE``); every row is in a list. Lists are cut into blocks of rows and their
queries into blocks as well, so a list that holds a third of all rows becomes many tasks. The
nearest lists of a query are scanned first, and its k-th best there is the bound for the others. Each
block gives back at most ``k`` rows per query, with scores from the original vectors. Queries
that end with fewer than ``k`` rows are scanned once more, without giving anything up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotelift.llm.common import materialize
from quotelift.llm.vectors import bounded_sample, matrix, usable

K = 20
SAMPLE = 10_000
#: Rows that are compared with all queries to start with a bound.
BOUND_ROWS = 2048
#: Below so many rows there is one list, which is scanned whole.
ONE_LIST = 4096
MAX_LISTS = 4096
BLOCK_ROWS, BLOCK_QUERIES = 2048, 256
COLUMNS = 16
#: Share of a query's lists that are scanned first, and pairs that are measured at once.
FIRST_LISTS, PAIRS = 0.2, 1 << 16
#: Share of the pairs of a block above which the next columns are added up for all of them.
DENSE = 1 / 16
#: Standard deviations of the test that gives a candidate up.
CONFIDENCE = 3.0
#: Rounding of a squared distance, as a share of the squared norms it is made from.
ROUNDING = 1e-9
RECALL = 0.97


@dataclass(frozen=True)
class Index:
    """``rotation`` of the lifted space, ``centroids`` in it, ``probes`` per query."""

    rotation: np.ndarray
    centroids: np.ndarray
    top: float
    probes: int
    bound: np.ndarray
    sizes: np.ndarray | None = None

    def lift(self, x: np.ndarray) -> np.ndarray:
        """Rows with the coordinate that brings all of them to one norm, rotated."""
        rest = np.sqrt(np.maximum(0.0, self.top - (x * x).sum(axis=1)))
        return np.column_stack([x, rest]) @ self.rotation

    def lift_queries(self, q: np.ndarray) -> np.ndarray:
        return np.column_stack([q, np.zeros(len(q))]) @ self.rotation


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum(0.0, (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * x @ y.T)


def fit(sample: np.ndarray, top: float, rows: int, k: int = K, seed: int = 5) -> Index:
    rng = np.random.default_rng(seed)
    dims = sample.shape[1] + 1
    rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    lists = 1 if rows <= ONE_LIST else int(min(MAX_LISTS, rows**0.5, len(sample) / 16))
    index = Index(rotation, np.zeros((1, dims)), top, 1, sample[:BOUND_ROWS])
    if lists <= 1:
        return index
    lifted = index.lift(sample)
    centroids = lifted[rng.choice(len(lifted), lists, replace=False)]
    for _ in range(8):
        nearest = _distances(lifted, centroids).argmin(axis=1)
        count = np.bincount(nearest, minlength=lists)
        total = np.zeros_like(centroids)
        np.add.at(total, nearest, lifted)
        centroids = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centroids)
    # lists to look into, from queries and their true neighbours in the sample
    nearest = _distances(lifted, centroids).argmin(axis=1)
    queries = rng.choice(len(sample), min(500, len(sample)), replace=False)
    products = sample[queries] @ sample.T
    products[np.arange(len(queries)), queries] = -np.inf
    best = np.argsort(-products, axis=1)[:, :k]
    order = np.argsort(_distances(index.lift_queries(sample[queries]), centroids), axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(lists)[None, :], axis=1)
    found = np.take_along_axis(place, nearest[best], axis=1)
    share = np.array([(found <= p).mean() for p in range(lists)])
    probes = int(np.searchsorted(share, RECALL)) + 1
    return Index(rotation, centroids, top, min(probes, lists), sample[:BOUND_ROWS])


def _tile(index: Index, k: int):
    """The scan of one block of rows by one block of queries."""

    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        dims = len(index.rotation) - 1
        x, q = matrix(rows["embedding"], dims), matrix(queries["embedding"], dims)
        ids, qids = rows["vec_id"].to_numpy(), queries["query_id"].to_numpy()
        bounds = queries["bound"].to_numpy(np.float64)
        lifted, asked = index.lift(x), index.lift_queries(q)
        width = lifted.shape[1]
        norms = (q * q).sum(axis=1)
        # the product bound as a squared distance; for copies of the longest vector it is 0
        far = np.where(np.isfinite(bounds), np.maximum(0.0, norms + index.top - 2 * bounds), np.inf)
        margin = ROUNDING * (norms + index.top)

        def limit(stop: int) -> np.ndarray:
            """What the first ``stop`` columns of a pair may add up to, by query; all of them: the bound."""
            spare = (1 + CONFIDENCE / stop**0.5) ** 2 if stop < width else 1.0
            return (far * spare + margin) * (stop / width) + margin

        # blocks of columns of all pairs at once while many are left, then of the pairs that are left
        stop = min(width, COLUMNS)
        sums = _distances(asked[:, :stop], lifted[:, :stop])
        left = (sums <= limit(stop)[:, None]) & (qids[:, None] != ids)
        while stop < width and np.count_nonzero(left) > DENSE * left.size:
            start, stop = stop, min(width, stop + COLUMNS)
            sums += _distances(asked[:, start:stop], lifted[:, start:stop])
            left &= sums <= limit(stop)[:, None]
        if stop == width and len(ids) > k:
            # no pair behind a query's k-th nearest of the block, but for rounding
            nearest = np.partition(np.where(left, sums, np.inf), k - 1, axis=1)[:, k - 1]
            left &= sums <= (nearest + 2 * margin)[:, None]
        at, row = np.nonzero(left)
        sums = sums[at, row]
        for start in range(stop, width, COLUMNS):
            if not len(at):
                break
            stop = min(width, start + COLUMNS)
            step = lifted[row, start:stop] - asked[at, start:stop]
            sums = sums + (step * step).sum(axis=1)
            keep = sums <= limit(stop)[at]
            at, row, sums = at[keep], row[keep], sums[keep]
        # what is left is measured with the original vectors, each pair by itself, so that the score
        # of a pair does not depend on the block it is in
        score = np.concatenate(
            [(x[row[i : i + PAIRS]] * q[at[i : i + PAIRS]]).sum(axis=1) for i in range(0, len(at), PAIRS)] or [np.empty(0)]
        )
        # ties at the cut go to the smaller id
        order = np.lexsort((ids[row], -score, at))
        first = np.searchsorted(at[order], at[order])
        order = order[np.arange(len(order)) - first < k]
        return pd.DataFrame({"query_id": qids[at[order]], "vec_id": ids[row[order]], "score": score[order]})

    return run


def search(df: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` nearest rows found, nearest first.

    ``queries`` has the columns of ``df`` that are read, vec_id and embedding; a row is no
    candidate for a query with its own id. Equal scores go to the smaller id. Vectors that are
    NULL, zero or hold NULL or non-finite components, and rows with a NULL id, take no part.
    Vectors of one length are a table of their own, since those of different lengths have no
    product. Repeated rows count once; an id with several vectors counts with its best. With
    at most ``ONE_LIST`` rows all are looked at; an empty table gives an empty result.
    """
    use = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    # one row for each length that occurs
    lengths = [r["d"] for r in df.filter(use).select(F.size("embedding").alias("d")).distinct().collect()]
    if not lengths:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    found = [_near_of_length(df, queries, dims, k) for dims in sorted(lengths)]
    near = reduce(DataFrame.unionByName, found).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _near_of_length(df: DataFrame, queries: DataFrame, dims: int, k: int) -> DataFrame:
    """(query_id, vec_id, score): what the scan finds among vectors of one length."""
    spark = df.sparkSession

    def clean(rows: DataFrame) -> DataFrame:
        use = usable(F.col("embedding")) & (F.size("embedding") == dims) & F.col("vec_id").isNotNull()
        return rows.filter(use).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").distinct()

    base = materialize(clean(df), "vectors")
    asked = clean(queries)
    norm = F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
    stats = base.agg(F.count("*"), F.max(norm), F.count_distinct("vec_id")).first()
    index = fit(bounded_sample(base, SAMPLE, dims), float(stats[1]), stats[0], k)
    shared = spark.sparkContext.broadcast(index)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lifted = shared.value.lift(matrix(pdf["embedding"], dims))
            place = _distances(lifted, shared.value.centroids).argmin(axis=1)
            yield pdf.assign(list=place.astype(np.int32))

    listed = materialize(base.mapInPandas(assign, "vec_id long, embedding array<float>, list int"), "lists")
    sizes = listed.groupBy("list").agg(F.count("*").alias("n")).collect()  # one row per list
    counts = np.zeros(len(index.centroids), np.int64)
    for r in sizes:
        counts[r["list"]] = r["n"]
    whole = spark.sparkContext.broadcast(counts)

    def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ix, n = shared.value, whole.value
        for pdf in batches:
            for start in range(0, len(pdf), 500):
                part = pdf.iloc[start : start + 500]
                q = matrix(part["embedding"], dims)
                products = q @ ix.bound.T
                # a row of the sample may be the query itself, so one more is passed over
                enough = ix.bound.shape[0] > k
                bound = np.partition(products, -(k + 1), axis=1)[:, -(k + 1)] if enough else np.full(len(q), -np.inf)
                order = np.argsort(_distances(ix.lift_queries(q), ix.centroids), axis=1, kind="stable")
                held = np.cumsum(n[order], axis=1)
                # further lists until enough rows are looked at
                take = np.maximum(ix.probes, (held < 8 * k).sum(axis=1) + 1).clip(max=len(n))
                yield pd.DataFrame(
                    {
                        "query_id": part["vec_id"].to_numpy(),
                        "embedding": part["embedding"].to_numpy(),
                        "bound": bound,
                        "lists": [o[:t].astype(np.int32) for o, t in zip(order, take, strict=True)],
                    }
                )

    looks = asked.mapInPandas(probe, "query_id long, embedding array<float>, bound double, lists array<int>")
    looks = materialize(looks, "probes")

    def scan(seekers: DataFrame) -> DataFrame:
        asks = seekers.select("query_id", F.explode("lists").alias("list")).groupBy("list").agg(F.count("*").alias("m"))
        asks = {r["list"]: r["m"] for r in asks.collect()}
        blocks = spark.createDataFrame(
            [
                (i, int(-(-counts[i] // BLOCK_ROWS)), int(-(-m // BLOCK_QUERIES)))
                for i, m in asks.items()
                if counts[i]
            ],
            "list int, row_blocks int, query_blocks int",
        )
        blocks = F.broadcast(blocks)  # one row per list, at most MAX_LISTS
        spread = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        rows = (
            listed.join(blocks, "list")
            .withColumn("row_block", F.pmod(F.xxhash64("vec_id"), F.col("row_blocks")).cast("int"))
            .withColumn("query_block", spread("query_blocks"))
            .select("list", "row_block", "query_block", "vec_id", "embedding")
        )
        seeks = (
            seekers.select("query_id", "embedding", "bound", F.explode("lists").alias("list"))
            .join(blocks, "list")
            .withColumn("query_block", F.pmod(F.xxhash64("query_id", F.lit(1)), F.col("query_blocks")).cast("int"))
            .withColumn("row_block", spread("row_blocks"))
            .select("list", "row_block", "query_block", "query_id", "embedding", "bound")
        )
        key = ["list", "row_block", "query_block"]
        tile = lambda left, right: _tile(shared.value, k)(left, right)
        return rows.groupBy(*key).cogroup(seeks.groupBy(*key)).applyInPandas(tile, "query_id long, vec_id long, score double")

    # the nearest lists first; their k-th best is the bound for the others
    early = F.greatest(F.lit(1), F.ceil(F.size("lists") * F.lit(FIRST_LISTS))).cast("int")
    begun = materialize(scan(looks.withColumn("lists", F.slice("lists", 1, early))), "near-first")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    # the bound must be reached by k ids, not by fewer with several vectors
    ids = begun if stats[2] == stats[0] else begun.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    reached = ids.withColumn("r", place).filter(F.col("r") == k).select("query_id", F.col("score").alias("reached"))
    rest = F.slice("lists", early + 1, F.greatest(F.size("lists") - early, F.lit(0)))
    later = looks.join(reached, "query_id", "left").select(
        "query_id", "embedding", F.greatest("bound", F.coalesce("reached", "bound")).alias("bound"), rest.alias("lists")
    )
    later = materialize(later.filter(F.size("lists") > 0), "probes-later")
    near = begun.unionByName(materialize(scan(later), "near-later"))
    full = near.groupBy("query_id").agg(F.countDistinct("vec_id").alias("n")).filter(F.col("n") >= k)
    # a query with an open bound has seen all candidates of its lists
    short = looks.filter(F.col("bound") > float("-inf")).join(full, "query_id", "left_anti")
    short = materialize(short.withColumn("bound", F.lit(float("-inf"))), "short-probes")
    if not short.isEmpty():
        near = near.unionByName(scan(short))
    return near
