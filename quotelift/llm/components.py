"""Connected components of a link table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelift.llm.common import materialize


def _stars(edges: DataFrame) -> bool:
    """Whether each node points to one other that points nowhere itself."""
    out = edges.groupBy("u").agg(F.count("*").alias("n"))
    into = edges.select(F.col("v").alias("u")).distinct()
    several = out.filter("n > 1").select("u")
    return several.unionByName(out.select("u").join(into, "u", "left_semi")).isEmpty()


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component_id) for every node with a link; the id is the smallest node reached.

    In turn, every node hands its larger neighbours (large star) or its smaller ones (small
    star) to the smallest of them, until each component is one star. Every step is joins and
    aggregations over written tables; nothing is collected. Both
    sides of the joins are read from tables, so a node with very many links can be split.
    """
    pair = links.filter(F.col(left) != F.col(right))
    edges = pair.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v")).distinct()
    edges = materialize(edges, "links")
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        least = materialize(least, "least")
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.distinct(), "large-star")
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = materialize(edges, "small-star")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component_id")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component_id")).unionByName(roots)
