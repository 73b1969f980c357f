"""Published tables in generations: new bucket folders first, then one commit that points to them.

A table is rows in hash buckets. A publish writes the buckets it changes below a folder of its own
and then commits a manifest: which generation holds each bucket, and up to which load the table
has consumed its source. The manifest is one file that appears by one rename, so a reader sees
the table before or after a publish and never half of it, and a run that dies at any point leaves
the table as it was, with the loads it has not consumed still ahead of it.

There is one writer at a time, as with any scheduled run; a second one is noticed and refused.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from quotelift.session import delete_folder, nothing_there


@dataclass(frozen=True)
class Generation:
    """A committed state: the generation that holds each bucket, the last load consumed."""

    number: int
    consumed: int | None
    holders: Mapping[int, int] = field(default_factory=dict)
    schema: str = ""


class PublishedTable:
    """A table in ``buckets`` folders by hash of ``key``, below ``path``."""

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = 64):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _commits(self) -> DataFrame | None:
        try:
            return self.spark.read.schema("value string, n bigint").text(f"{self.path}/commits")
        except AnalysisException as error:
            if not nothing_there(error):
                raise
            return None

    def current(self) -> Generation | None:
        """The newest commit; None before the first."""
        commits = self._commits()
        last = None if commits is None else commits.orderBy(F.col("n").desc()).first()
        if last is None:
            return None
        kept = json.loads(last["value"])
        holders = {int(b): g for b, g in kept["holders"].items()}
        return Generation(kept["number"], kept["consumed"], holders, kept["schema"])

    def _folder(self, generation: int) -> str:
        return f"{self.path}/data/generation={generation}"

    def read(self, buckets: list[int] | None = None) -> DataFrame | None:
        """The rows of the newest commit, all or of some buckets; None before the first commit."""
        now = self.current()
        if now is None:
            return None
        schema = StructType.fromJson(json.loads(now.schema))
        wanted = now.holders if buckets is None else {b: g for b, g in now.holders.items() if b in set(buckets)}
        paths = [f"{self._folder(g)}/bucket={b}" for b, g in sorted(wanted.items())]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def write(self, rows: DataFrame, generation: int) -> None:
        """The bucket folders of a generation that is not committed yet; leftovers of a dead run go."""
        placed = rows.withColumn("bucket", self.bucket())
        placed.write.mode("overwrite").partitionBy("bucket").parquet(self._folder(generation))

    def commit(self, rows: DataFrame, generation: int, touched: list[int], consumed: int | None) -> Generation:
        """Make a written generation the newest. ``touched`` are the buckets it replaces."""
        before = self.current()
        if (before.number if before else 0) != generation - 1:
            raise RuntimeError(f"another run has published generation {before.number} of {self.path}")
        written = self.spark.read.schema(StructType([*rows.schema.fields, StructField("bucket", IntegerType())])).parquet(self._folder(generation))
        there = {r["bucket"] for r in written.select("bucket").distinct().collect()}  # at most one per bucket
        holders = {b: g for b, g in (before.holders if before else {}).items() if b not in set(touched)}
        holders |= {b: generation for b in touched if b in there}
        schema = json.dumps(json.loads(rows.schema.json()))
        run = uuid.uuid4().hex
        value = {"number": generation, "consumed": consumed, "holders": holders, "schema": schema, "run": run}
        text = self.spark.createDataFrame([(json.dumps(value),)], "value string")
        # a folder that a dead run left without its file does not count as a commit
        text.coalesce(1).write.mode("overwrite").text(f"{self.path}/commits/n={generation}")
        if json.loads(self._commits().filter(F.col("n") == generation).first()["value"])["run"] != run:
            raise RuntimeError(f"another run has published generation {generation} of {self.path}")
        return Generation(generation, consumed, holders, schema)

    def publish(self, rows: DataFrame, touched: list[int], consumed: int | None) -> Generation:
        """Replace the touched buckets by ``rows``; other buckets stay where they are."""
        before = self.current()
        generation = (before.number if before else 0) + 1
        self.write(rows, generation)
        return self.commit(rows, generation, touched, consumed)

    def expire(self, keep: int = 2) -> list[int]:
        """Delete generations that none of the newest ``keep`` commits points to; their numbers.

        Readers that began on an older commit than that lose their files.
        """
        if keep < 1:
            raise ValueError("the newest commit stays")
        commits = self._commits()
        if commits is None:
            return []
        rows = commits.orderBy(F.col("n").desc()).collect()  # one row per commit kept
        needed = {g for r in rows[:keep] for g in json.loads(r["value"])["holders"].values()}
        newest, gone = rows[0]["n"], []
        for number in sorted({r["n"] for r in rows[keep:]}):
            delete_folder(self.spark, f"{self.path}/commits/n={number}")
        for number in range(1, newest + 1):
            if number not in needed and delete_folder(self.spark, self._folder(number)):
                gone.append(number)
        return gone
