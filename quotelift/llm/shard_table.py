"""Sharding by a lookup table that the shards fill in turns.

Every shard has its own permutation of the slots of a prime-sized table. The shards take
turns; each claims the first slot in its order that is still free, until the table is full.
A key goes to the shard of slot ``hash(key) mod size``. All shards own the same number of
slots (give or take one), and when a shard is added or leaves, few other slots change hands.

The table is small, fixed by parameters and checked (``MAX_SLOTS``), so it is broadcast and
every row is placed by one lookup. Placement is per row: no shuffle, no hot key.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_SLOTS = 1 << 17
SHARDS, SLOTS = 32, 3251


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def fill_table(shards: int = SHARDS, slots: int = SLOTS) -> list[int]:
    """The shard of each slot."""
    if not 0 < shards <= slots <= MAX_SLOTS:
        raise ValueError(f"need 0 < shards <= slots <= {MAX_SLOTS}")
    if slots < 2 or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("the number of slots must be prime, or a shard's order misses some")
    place = [_number(f"{s}:offset") % slots for s in range(shards)]
    skip = [_number(f"{s}:skip") % (slots - 1) + 1 for s in range(shards)]
    owner = [-1] * slots
    for turn in range(slots):
        s = turn % shards
        while owner[place[s]] >= 0:
            place[s] = (place[s] + skip[s]) % slots
        owner[place[s]] = s
    return owner


def lookup_table(spark: SparkSession, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """One row per slot: slot, shard."""
    literal = ",".join(map(str, fill_table(shards, slots)))
    owners = F.split(F.lit(literal), ",").cast("array<int>")
    return spark.range(1).select(F.posexplode(owners).alias("slot", "shard"))


def slot_of(key: Column, slots: int) -> Column:
    """The slot of a key, the same in any engine that has md5; a NULL key counts as ''."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int")


def assign(df: DataFrame, key: str = "doc_id", shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """(key, slot, shard) for every row, repeated rows included.

    Only the key is read, so other columns (also ones called slot or shard) do not matter.
    A NULL key goes where '' goes; an empty table gives an empty result.
    """
    keys = df.select(F.col(key).alias(key), slot_of(F.col(key), slots).alias("slot"))
    return keys.join(F.broadcast(lookup_table(df.sparkSession, shards, slots)), "slot").select(
        key, "slot", "shard"
    )


def write_shards(
    df: DataFrame, path: str, key: str = "doc_id", shards: int = SHARDS, slots: int = SLOTS
) -> None:
    """Write whole rows, one folder ``shard_id=N`` per shard.

    Rows are dealt by slot, so a shard is written by as many tasks as it has slots at most
    and no task holds a whole shard.
    """
    row = F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("row")
    placed = df.select(row, slot_of(df[key], slots).alias("slot")).join(
        F.broadcast(lookup_table(df.sparkSession, shards, slots)), "slot"
    )
    placed.repartition("slot").select("row.*", F.col("shard").alias("shard_id")).write.partitionBy(
        "shard_id"
    ).parquet(path)
