"""Table sinks: versioned, fixed-name and dimension tables, and the new-row view.

Tables are plain Parquet tables of the session catalog. New rows are marked by the load
they came with, so no stored row is ever updated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelift.functions import is_blank
from quotelift.sources.files import scan_csv


def ensure_schema(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{name}`")


def write_new(df: DataFrame, table: str, partition_by: str | None = None) -> None:
    """Write a versioned table; fails if the name is taken.

    Scored and model tables are best partitioned by segment, so that a run on one
    segment reads only its files.
    """
    if df.sparkSession.catalog.tableExists(table):
        raise ValueError(f"output table exists already: {table}")
    writer = df.write.format("parquet").mode("errorifexists")
    (writer.partitionBy(partition_by) if partition_by else writer).saveAsTable(table)


def _fitted(name: str, kind: str) -> Column:
    value = F.col(name).try_cast(kind)
    refuse = F.raise_error(
        F.concat(F.lit(f"{name} does not fit {kind}: "), F.col(name).cast("string"))
    )
    return F.when(value.isNotNull() | is_blank(name), value).otherwise(refuse)


def append_fixed(df: DataFrame, table: str) -> None:
    """First load creates the table, later loads append under its pinned schema.

    Columns are matched by name and cast to the stored types; a batch cannot change
    the schema. A missing column fails the load, and so does a filled value that does not
    fit its type, within the write itself: nothing is stored of such a batch.
    ``columns.count_rejects`` tells which columns are to blame.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.format("parquet").saveAsTable(table)
        return
    pinned = spark.table(table)
    missing = [c for c in pinned.columns if c not in df.columns]
    extra = [c for c in df.columns if c not in pinned.columns]
    if missing or extra:
        raise ValueError(f"batch does not fit {table}: missing {missing}, unexpected {extra}")
    fitted = df.select(*[_fitted(c, t).alias(c) for c, t in pinned.dtypes])
    fitted.write.format("parquet").mode("append").saveAsTable(table)


def refresh_dimension(df: DataFrame, table: str) -> None:
    """Full reload of a dimension table."""
    df.write.format("parquet").mode("overwrite").saveAsTable(table)


def ingest_dimension(spark: SparkSession, paths: str | list[str], table: str) -> None:
    """Reload a dimension from its delimited file, stamped with the load time."""
    rows = scan_csv(spark, paths, tag=False)
    refresh_dimension(rows.withColumn("TS_ATUALIZACAO", F.current_timestamp()), table)


def copy_table(spark: SparkSession, source: str, target: str, refresh: bool = False) -> bool:
    """Copy a table if the target is absent or a refresh is asked for."""
    if spark.catalog.tableExists(target) and not refresh:
        return False
    refresh_dimension(spark.table(source), target)
    return True


def tag_batch(df: DataFrame, batch_id: int) -> DataFrame:
    return df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))


def next_batch_id(spark: SparkSession, table: str) -> int:
    if not spark.catalog.tableExists(table):
        return 0
    last = spark.table(table).agg(F.max("batch_id").alias("b")).first()["b"]
    return 0 if last is None else last + 1


def new_row_flag(table: DataFrame, batch: str = "batch_id", out: str = "FL_NOVO") -> DataFrame:
    """True for the rows of the newest load; older loads read as False."""
    newest = table.agg(F.max(batch).alias("b")).scalar()
    return table.withColumn(out, F.col(batch) == newest)


def rows_after(table: DataFrame, done: int | None, batch: str = "batch_id") -> DataFrame | None:
    """Rows of loads after ``done``, the last load a step has consumed; None if none.

    Each step remembers its own position, so a run that finds no file loses nothing.
    """
    fresh = table if done is None else table.filter(F.col(batch) > done)
    return None if fresh.isEmpty() else fresh
