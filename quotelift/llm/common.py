"""Helpers shared by the operators: written intermediates, row packing, words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than space and the five ASCII white spaces after it.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share; nothing exists there yet.

    ``spark.checkpoint.dir`` where the cluster names it, else the warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The written table survives lost executors, and its size is known to the planner.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_rows(df: DataFrame, rows: int, row_bytes: int = 64) -> DataFrame:
    """``df`` as a side of a join that is broadcast only if its ``rows`` are small in memory.

    Spark sizes a table by its files, where repeated ids take next to nothing, and an exploded one
    by the table before it; such a side may be many times what the driver can hold.
    """
    most = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return df.hint("merge") if rows * row_bytes > most else df


def packed(df: DataFrame, name: str = "whole_row") -> Column:
    """The whole input row as one struct, so that no input column can clash with ours."""
    return F.struct(*[df[f"`{c}`"] for c in df.columns]).alias(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a NULL id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus
