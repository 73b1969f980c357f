"""Incremental ingestion of delimited files named by date.

A delivered file is either one file ``NAME_yyyymmdd.csv`` or a folder of that name with
part files inside; both carry the date and the identity of the delivery in the path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# How the delivered files are written.
CSV_OPTIONS = {
    "header": "true",
    "sep": "|",
    "quote": "\u0000",
    "escape": "\u0000",
    "encoding": "ISO-8859-1",
}
FILE_PATTERN = r"COTACAO_GENERICO_(?:\d+_)?\d{8}\.csv"
DATE_IN_NAME = r"(?:^|_)((?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01]))\.csv$"
DELIVERY_IN_PATH = r"([^/=]+\.csv)(?:/part-[^/]*)?$"


def delivery_name(path: Column | str) -> Column:
    """Name of the delivered file, also if it is a folder of part files."""
    return F.regexp_extract(path, DELIVERY_IN_PATH, 1)


def matches(name: Column | str, pattern: str) -> Column:
    return (F.col(name) if isinstance(name, str) else name).rlike(f"^(?:{pattern})$")


def date_of(name: Column | str) -> Column:
    """Date in the file name; NULL if there is none or it is not a real date."""
    text = F.regexp_extract(name, DATE_IN_NAME, 1)
    return F.try_to_timestamp(text, F.lit("yyyyMMdd")).cast("date")


def list_files(spark: SparkSession, folder: str, pattern: str = FILE_PATTERN) -> DataFrame:
    """Deliveries in a folder whose name matches: ``source_file, file_date, path``.

    Only the listing is read. Names without a valid date are left out.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", delivery_name("path").alias("source_file"))
    )
    return (
        listing.filter(matches("source_file", pattern))
        .withColumn("file_date", date_of("source_file"))
        .filter(F.col("file_date").isNotNull())
    )


def high_water_mark(table: DataFrame, ts: str = "TS_ARQ") -> DataFrame:
    """One row with the newest file date of a table; NULL for an empty one."""
    return table.agg(F.max(F.col(ts).cast("date")).alias("last_date"))


def loaded_files(table: DataFrame, name: str = "SOURCE_FILE") -> DataFrame:
    return table.select(F.col(name).alias("source_file")).distinct()


def incremental_candidates(
    listing: DataFrame,
    loaded: DataFrame | None = None,
    cutoff: Column | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Files still to load, oldest first.

    Not loaded yet, and not older than the cutoff (a file of the cutoff date counts).
    Without ``loaded`` and ``cutoff`` every file is taken again. ``limit`` keeps the
    oldest files of a backfill.
    """
    todo = listing
    if loaded is not None:
        todo = todo.join(loaded, "source_file", "left_anti")
    if cutoff is not None:
        todo = todo.filter(F.coalesce(F.col("file_date") >= cutoff, cutoff.isNull()))
    ordered = todo.orderBy("file_date", "source_file")
    return ordered if limit is None else ordered.limit(limit)


def strip_quotes(df: DataFrame) -> DataFrame:
    """Drop both quote signs from column names and double quotes from text values."""
    return df.select(
        *[
            (F.regexp_replace(F.col(f"`{c}`"), '"', "") if t == "string" else F.col(f"`{c}`")).alias(
                c.replace('"', "").replace("'", "")
            )
            for c, t in df.dtypes
        ]
    )


def tag_source(df: DataFrame, path: Column | str = "_metadata.file_path") -> DataFrame:
    """File date, load time and file name for each row."""
    name = delivery_name(path)
    return df.withColumns(
        {
            "TS_ARQ": date_of(name).cast("timestamp"),
            "TS_ATUALIZACAO": F.current_timestamp(),
            "SOURCE_FILE": name,
        }
    )


def scan_csv(spark: SparkSession, paths: Sequence[str] | str, tag: bool = True) -> DataFrame:
    """All files in one scan, quotes removed, rows tagged with their file.

    Files are split by Spark whatever their number. A file whose header differs from the
    first one raises instead of shifting columns.
    """
    raw = (
        spark.read.options(**CSV_OPTIONS)
        .option("enforceSchema", "false")
        .option("recursiveFileLookup", "true")
        .csv(paths)
    )
    if not tag:
        return strip_quotes(raw)
    with_path = raw.select("*", F.col("_metadata.file_path").alias("_path"))
    return tag_source(strip_quotes(with_path), "_path").drop("_path")


def ingest_files(spark: SparkSession, candidates: DataFrame) -> DataFrame | None:
    """Rows of the candidate files, or None if there are none.

    Only the file names come to the driver, as in any scan.
    """
    paths = [r["path"] for r in candidates.select("path").collect()]
    return scan_csv(spark, paths) if paths else None


def write_delivery(df: DataFrame, folder: str, name: Column) -> None:
    """Write rows as deliveries, one folder of part files per name, in the file format."""
    (
        df.withColumn("delivery", name)
        .write.partitionBy("delivery")
        .options(**CSV_OPTIONS)
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .mode("errorifexists")
        .csv(folder)
    )
