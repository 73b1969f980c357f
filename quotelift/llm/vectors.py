"""Reading embeddings: usable rows, arrays from Arrow batches, bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not NULL, without NULL or non-finite components, and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def dimension(df: DataFrame, vector: str = "embedding") -> int:
    """The commonest length of usable vectors (the larger of equals), 0 without any."""
    sizes = df.filter(usable(F.col(vector))).groupBy(F.size(vector).alias("d")).agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), F.desc("d")).first()
    return top["d"] if top else 0


def matrix(column, dims: int) -> np.ndarray:
    """A list of vectors as a matrix of doubles."""
    return np.array(list(column), np.float64).reshape(-1, dims)


def bounded_sample(df: DataFrame, size: int, dims: int, vector: str = "embedding") -> np.ndarray:
    """At most ``size`` vectors, those with the smallest hash of their id, on the driver."""
    rows = df.select(vector, F.xxhash64("vec_id").alias("h"), "vec_id").orderBy("h", "vec_id").limit(size)
    pdf = rows.select(vector).toPandas()
    return matrix(pdf[vector], dims)
