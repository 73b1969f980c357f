"""Mixing sources to target weights by weighted fair queueing.

Each source's documents stand in a shuffled order, twice over (a document may be repeated
once). A copy starts when the words before it in its source, divided by the source's target,
have been served and finishes when its own words have been served too: its virtual finish
time. Copies leave in the order of their finish times, and the total budget is used up at
virtual time 1, when every source has just had its target. The copy in service at that time
counts with the words served until then.

Running totals are taken per (source, leading hex digits of the shuffle key), so that a hot
source is spread over many tasks; only the totals of these pieces are accumulated per source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotelift.llm.common import materialize, packed, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_COPIES = 2
#: Rows that a piece of a source holds on average; sets how many hex digits split a source.
PIECE_ROWS = 4096


def _source_key(source: Column) -> Column:
    """Sorts by code point with NULL last; never NULL itself."""
    text = source.cast("string")
    return F.when(text.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), text))


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = MAX_COPIES) -> DataFrame:
    """One row per source: source_key, source_size, target.

    What sources capped at ``cap`` times their size cannot take is shared again by weight;
    the level only rises, so a source is capped exactly if its weight at the final level is.
    """
    sources = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    # one row per source is ranked here, not one per document
    rank = F.row_number().over(Window.orderBy("source_key")) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    sources = materialize(sources.withColumn("weight", weight), "mix-sources")
    limit = F.col("source_size") * cap
    total = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    budget = min(share, cap) * (total[0] or 0)
    level = budget / total[1] if total[1] else 0.0
    while budget:
        above = F.col("weight") * level > limit
        full, rest = sources.agg(
            F.sum(F.when(above, limit).otherwise(0)), F.sum(F.when(above, 0).otherwise(F.col("weight")))
        ).first()
        raised = (budget - full) / rest if rest else level
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("weight") * F.lit(float(level)), limit.cast("double"))
    return sources.select("source_key", "source_size", target.alias("target"))


def queue(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, seed: str = "mix", keep_row: bool = False) -> DataFrame:
    """Every document with its place: doc_id, size, source_size, target, start, taken, finish.

    ``start`` counts the words before the document in its source, ``finish`` is the virtual
    finish time of its first copy and ``taken`` the words the mix takes of both copies. With
    ``keep_row`` the whole input row is carried as ``whole_row``.

    NULL text has size 0, a NULL source is a source of its own (last), rows are ordered by
    (md5 of seed and id, id, size), so reruns agree and repeated rows are interchangeable.
    Documents of size 0 take nothing; an empty table gives an empty result.
    """
    row = [packed(docs)] if keep_row else []
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    sizes = materialize(
        docs.select(
            "doc_id",
            _source_key(F.col("source")).alias("source_key"),
            digest.alias("shuffle_key"),
            word_count(F.col("text")).alias("size"),
            *row,
        ),
        "mix-sizes",
    )
    goal = targets(sizes, weights, share)
    digits, rows = 0, sizes.count() / PIECE_ROWS
    while 16**digits < rows:
        digits += 1
    piece = F.substring("shuffle_key", 1, digits) if digits else F.lit("")
    sizes = sizes.withColumn("piece", piece)
    pieces = sizes.groupBy("source_key", "piece").agg(F.sum("size").alias("piece_size"))
    upto = Window.partitionBy("source_key").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        "source_key", "piece", F.coalesce(F.sum("piece_size").over(upto), F.lit(0)).alias("offset")
    ).join(goal, "source_key")
    within = Window.partitionBy("source_key", "piece").orderBy("shuffle_key", "doc_id", "size")
    before = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    placed = (
        sizes.withColumn("before", before)
        .join(offsets, ["source_key", "piece"])
        .withColumn("start", F.col("before") + F.col("offset"))
    )
    words = F.round("target").cast("long")
    taken = F.lit(0).cast("long")
    for copy in range(MAX_COPIES):
        begins = F.col("start") + F.col("source_size") * copy
        taken = taken + F.greatest(F.lit(0), F.least(F.col("size"), words - begins))
    finish = F.when(F.col("target") > 0, (F.col("start") + F.col("size")) / F.col("target")).otherwise(F.lit(0.0))
    return placed.select(
        "doc_id", "size", "source_size", "target", "start", taken.alias("taken"), finish.alias("finish"),
        *(["whole_row"] if keep_row else []),
    )


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, seed: str = "mix") -> DataFrame:
    """The mixed documents: whole input rows, repeated where the mix repeats them.

    Rows leave in the order of their virtual finish times (a range sort over all copies). A
    document in service when the budget runs out is written whole if at least half of it was
    served. Documents without words are not part of a mix of words and do not come out.
    """
    placed = queue(docs, weights, share, seed, keep_row=True)
    copies = F.round(F.col("taken") / F.col("size")).cast("int")
    again = F.explode(F.sequence(F.lit(0), copies - 1)).alias("copy")
    served = placed.filter(F.col("size") > 0).filter(copies > 0).select("*", again)
    time = F.col("finish") + F.col("copy") * F.col("source_size") / F.col("target")
    return served.orderBy(time, "doc_id", "copy").select("whole_row.*")
