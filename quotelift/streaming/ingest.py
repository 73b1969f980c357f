"""Structured Streaming form of the incremental file load.

The file source remembers which files it has read in its checkpoint, so each file is
loaded once. ``availableNow`` reads what is there and stops.
"""

from __future__ import annotations

import json
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quotelift.session import nothing_there
from quotelift.sources.files import CSV_OPTIONS, FILE_PATTERN, matches, strip_quotes, tag_source


def read_deliveries(
    spark: SparkSession,
    folder: str,
    schema: str,
    pattern: str = FILE_PATTERN,
    max_files: int | None = None,
) -> DataFrame:
    """Stream of tagged rows. ``max_files`` bounds each micro-batch of a backfill.

    A file whose header differs from the schema fails the stream; its columns would shift.
    """
    reader = (
        spark.readStream.options(**CSV_OPTIONS)
        .option("enforceSchema", "false")
        .option("recursiveFileLookup", "true")
        .schema(schema)
    )
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    raw = reader.csv(folder).select("*", F.col("_metadata.file_path").alias("_path"))
    tagged = tag_source(strip_quotes(raw), "_path").drop("_path")
    return tagged.filter(matches("SOURCE_FILE", pattern) & F.col("TS_ARQ").isNotNull())


def drop_late_files(df: DataFrame, cutoff: date | None) -> DataFrame:
    """Files dated before the cutoff are ignored; a file of the cutoff date is kept."""
    return df if cutoff is None else df.filter(F.col("TS_ARQ").cast("date") >= F.lit(cutoff))


def _next_run(spark: SparkSession, target: str) -> int:
    try:
        last = spark.read.parquet(target).agg(F.max("run_id")).first()[0]
    except AnalysisException as error:
        if not nothing_there(error):
            raise
        return 0
    return 0 if last is None else last + 1


def start_ingest(
    stream: DataFrame, target: str, checkpoint: str, cutoff: date | None = None
) -> StreamingQuery:
    """Append every micro-batch to a Parquet folder, below ``stream_id=…/batch_id=…``.

    Batches are numbered within a checkpoint. The id that Spark keeps in the checkpoint is
    part of the folder, so a repeated micro-batch replaces its own rows and a stream with a
    new checkpoint never replaces those of another. All rows of a run carry its ``run_id``;
    ``new_row_flag(table, "run_id")`` marks them, however many micro-batches it had.
    """
    run = _next_run(stream.sparkSession, target)

    def write(batch: DataFrame, batch_id: int) -> None:
        meta = batch.sparkSession.read.text(f"{checkpoint}/metadata").first()["value"]
        rows = drop_late_files(batch.withColumn("run_id", F.lit(run).cast("bigint")), cutoff)
        rows.write.mode("overwrite").parquet(f"{target}/stream_id={json.loads(meta)['id']}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
