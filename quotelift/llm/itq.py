"""Embedding near-dedup: iterative quantisation and multi-index Hamming tables.

Iterative quantisation turns centred, PCA-projected vectors by a learned rotation so that they
lie close to the corners of a cube; the corner is the binary code. Each code is cut into
substrings of about log2(n) bits, one hash table each; a vector looks into its own bucket of
every table and into those that differ in one bit. Several rotations are learned when one does
not give enough tables for the wanted recall. Pairs that meet are compared by their whole codes
first, and those that are close by the cosine of the original vectors.

Rotations are fitted on a bounded sample; every row gets codes and tables. Equal vectors are
one entry with a count. A pair leaves the join only from the first table in which it meets,
and once the codes agree, so what leaves is little more than the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import acos, ceil, comb, log2, pi

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelift.llm.common import by_rows, materialize
from quotelift.llm.components import components
from quotelift.llm.vectors import bounded_sample, dimension, matrix, usable

THRESHOLD = 0.9
#: The rotations are learned on at most so many vectors.
SAMPLE = 10_000
ITERATIONS = 30
BITS = 64
#: Wanted recall of pairs exactly at the threshold; closer pairs are found more surely.
RECALL = 0.95


def learn(sample: np.ndarray, bits: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection) whose signs are the code: PCA followed by the learned rotation."""
    mean = sample.mean(axis=0)
    centred = sample - mean
    values, axes = np.linalg.eigh(centred.T @ centred)
    axes = axes[:, np.argsort(-values)[:bits]]
    projected = centred @ axes
    turn = np.linalg.qr(np.random.default_rng(seed).normal(size=(axes.shape[1], axes.shape[1])))[0]
    for _ in range(ITERATIONS):
        corner = np.where(projected @ turn >= 0, 1.0, -1.0)
        u, _, vt = np.linalg.svd(projected.T @ corner)
        turn = u @ vt
    return mean, axes @ turn


def plan(rows: int, bits: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int, int]:
    """(rotations, tables of each, bits of a table), for a bit that differs with angle / pi."""
    p = acos(threshold) / pi
    length = max(4, min(bits, 24, ceil(log2(max(2, rows)))))
    tables = max(1, bits // length)
    length = bits // tables
    hit = sum(comb(length, i) * p**i * (1 - p) ** (length - i) for i in (0, 1))
    need = ceil(np.log(1 - recall) / np.log(1 - hit)) if hit < 1 else 1
    return ceil(need / tables), tables, length


def links(df: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(entries, links): entries have node, vec_id; links have a, b, n_a, n_b with a < b.

    A node stands for all ids with the same vector (the smallest of them); n counts them.
    """
    dims = dimension(df)
    own = df.filter(usable(F.col("embedding")) & (F.size("embedding") == dims) & F.col("vec_id").isNotNull())
    own = own.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").distinct()
    same = own.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.count("*").alias("n"))
    nodes = materialize(same, "vectors")
    row_bytes = 64 + 8 * dims
    one = by_rows(nodes.select("embedding", "node"), nodes.count(), row_bytes)
    entries = own.join(one, "embedding").select("vec_id", "node")
    # an id with several vectors keeps all of them under its own number only once
    nodes = nodes.dropDuplicates(["node"])
    rows = nodes.count()
    spark = df.sparkSession
    if not rows:
        empty = spark.createDataFrame([], "a long, b long, n_a long, n_b long")
        return entries, empty
    sample = bounded_sample(nodes.withColumnRenamed("node", "vec_id"), SAMPLE, dims)
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    bits = min(BITS, dims)
    rotations, tables, length = plan(rows, bits, threshold)
    fitted = spark.sparkContext.broadcast([learn(sample, bits, seed) for seed in range(rotations)])

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = np.uint64(1) << np.arange(bits, dtype=np.uint64)
        for pdf in batches:
            x = matrix(pdf["embedding"], dims)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            codes = [(((x - m) @ p >= 0) * place).sum(axis=1, dtype=np.uint64).view(np.int64) for m, p in fitted.value]
            yield pd.DataFrame({"node": pdf["node"], "codes": list(np.stack(codes, axis=1)) if len(x) else []})

    codes = materialize(nodes.select("node", "embedding").mapInPandas(encode, "node long, codes array<long>"), "codes")
    mask = (1 << length) - 1
    part = lambda c, t: F.shiftrightunsigned(c[t // tables], length * (t % tables)).bitwiseAND(F.lit(mask))
    total = rotations * tables
    subs = [F.struct(F.lit(t).alias("t"), part(F.col("codes"), t).alias("key")) for t in range(total)]
    index = codes.select("node", "codes", F.explode(F.array(*subs)).alias("s")).select("node", "codes", "s.t", "s.key")
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << i).cast("long") for i in range(length)])
    near = index.select("node", "codes", "t", F.explode(F.transform(flips, lambda f: F.col("key").bitwiseXOR(f))).alias("key"))

    a, b = index.select(F.col("node").alias("a"), F.col("codes").alias("x"), "t", "key"), near.select(
        F.col("node").alias("b"), F.col("codes").alias("y"), "t", "key"
    )
    differ = [F.bit_count(F.col("x")[r].bitwiseXOR(F.col("y")[r])) for r in range(rotations)]
    angle = acos(threshold) / pi
    most = bits * rotations * angle + 5 * (bits * angle * (1 - angle)) ** 0.5 * rotations
    first = [
        (F.col("t") <= t) | (F.bit_count(part(F.col("x"), t).bitwiseXOR(part(F.col("y"), t))) > 1)
        for t in range(total - 1)
    ]
    close = (F.col("a") < F.col("b")) & (reduce(lambda p, q: p + q, differ) <= most)
    # both sides are the codes many times over
    b = by_rows(b, rows * total * (length + 1), 48 + 8 * rotations)
    met = a.join(b, ["t", "key"]).filter(reduce(lambda p, q: p & q, first, close)).select("a", "b")
    pairs = materialize(met, "code-pairs")

    def cosine(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x, y = matrix(pdf["x"], dims), matrix(pdf["y"], dims)
            cos = (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))
            yield pdf.loc[cos >= threshold, ["a", "b", "n_a", "n_b"]]

    side = by_rows(nodes.select("node", "n", "embedding"), rows, row_bytes)
    full = by_rows(pairs, pairs.count()).join(side.toDF("a", "n_a", "x"), "a").join(side.toDF("b", "n_b", "y"), "b")
    return entries, materialize(full.mapInPandas(cosine, "a long, b long, n_a long, n_b long"), "vector-links")


def near_copies(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors that are NULL, zero, hold NULL or non-finite components, or have another length
    than most, link with nothing. Rows that repeat an id and its vector are one vector; labels
    and other columns are not read. A NULL id has a NULL component and is kept. An empty table
    gives an empty result.
    """
    entries, found = links(df, threshold)
    counts = (
        found.select(F.col("a").alias("node"), F.col("n_b").alias("n"))
        .unionByName(found.select(F.col("b").alias("node"), F.col("n_a").alias("n")))
        .groupBy("node")
        .agg(F.sum("n").alias("linked"))
    )
    same = entries.groupBy("node").agg(F.count("*").alias("n"))
    linked = 2 * found.count()
    counts, comp = by_rows(counts, linked), by_rows(components(found), linked)
    nodes = same.join(counts, "node", "left").join(comp, "node", "left")
    nodes = nodes.select(
        "node",
        (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        F.coalesce("component_id", "node").alias("component_id"),
    )
    per_id = entries.join(nodes, "node").groupBy("vec_id").agg(
        F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id")
    )
    return (
        df.select(F.col("vec_id").cast("long").alias("vec_id"))
        .join(per_id, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
            F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(True)).alias("kept"),
        )
    )
