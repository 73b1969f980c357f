"""Session helper and the shared scratch area for tables that cut lineage."""

from __future__ import annotations

import json
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "quotelift", master: str | None = None, **conf: str) -> SparkSession:
    """Build a session with the settings the library expects.

    ``master`` is only for local runs; on a cluster leave it to spark-submit.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, else the warehouse: folders that all executors share.

    A warehouse on the driver's own disk is taken only by a local session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    root = spark.conf.get("spark.sql.warehouse.dir")
    if root.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder; nothing exists there yet."""
    root = _scratch_root(spark).rstrip("/")
    return f"{root}/quotelift/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch area and read it back.

    Used where several branches must see the very same rows (positions that depend
    on how rows were partitioned) or where a stage is too costly to run twice. The
    result survives executor loss, is column-pruned on re-read, and its size is known
    to the planner, so small tables are broadcast and large ones are not.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def nothing_there(error: AnalysisException) -> bool:
    """Whether reading failed because nothing has been written yet, and for no other reason."""
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder of the library's own, through the file system that Spark uses for it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(system.exists(target) and system.delete(target, True))


def save_note(spark: SparkSession, value: dict, path: str) -> None:
    """A small dictionary as one JSON text; numbers come back exactly."""
    frame = spark.createDataFrame([(json.dumps(value),)], "value string")
    frame.coalesce(1).write.mode("overwrite").text(path)


def load_note(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


#: Rows of a partition below which an iterative fit gains nothing from more partitions, and at most.
FEW_ROWS, MANY_ROWS = 20_000, 1_000_000


def spread(df: DataFrame) -> DataFrame:
    """``df`` written once in even partitions, for fits that read it many times.

    The number of partitions follows from the rows: small tables have few, so that a step of a fit
    is not spent on starting tasks, and large ones have no partition above ``MANY_ROWS``.
    """
    spark = df.sparkSession
    rows = materialize(df, "rows")
    n = rows.count()  # from the files' footers
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(1, min(most, -(-n // FEW_ROWS)), -(-n // MANY_ROWS))
    return materialize(rows.repartition(partitions), "spread")
