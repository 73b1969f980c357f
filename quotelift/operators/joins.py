"""Dimension joins with a retention rule, and dimension dedupe."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelift.functions import is_blank, normalize_key


def dedupe_most_filled(
    df: DataFrame,
    key: Column | str,
    tie: str,
    ts: str | None = None,
    scored: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: most filled fields, then newest, then the larger tie column.

    ``key`` may be an expression, so that a table joined on a normalised key is also
    deduplicated on it. Aggregation instead of a window keeps hot keys spread.
    """
    if scored is None:
        scored = [c for c in df.columns if c != key]
    score = sum((F.when(is_blank(c), 0).otherwise(1) for c in scored), F.lit(0))
    order = [score, *([F.col(ts)] if ts else []), F.col(tie)]
    key_col = F.col(key) if isinstance(key, str) else key
    best = F.max_by(F.struct(*df.columns), F.struct(*order))
    return df.groupBy(key_col.alias("_key")).agg(best.alias("_row")).select("_row.*")


def join_retention(
    left: DataFrame,
    right: DataFrame,
    left_keys: Sequence[str],
    right_keys: Sequence[str],
    suffix: str,
    right_order: Sequence[Column],
) -> DataFrame:
    """Left join that keeps a row if its first key is NULL or a match exists.

    Keys are compared in normalised form. The right side is reduced to one row per key
    (first in ``right_order``), rows with a NULL key part dropped; its other columns get
    the suffix. A row whose first key is set but another part is NULL cannot match and
    is dropped.

    Left rows with a NULL key never match but would all hash to one task, so for the
    shuffle they carry a spread value in place of the key. Whether the right side is
    broadcast is left to Spark, which knows its size.
    """
    payload = [c for c in right.columns if c not in right_keys]
    names = [f"_k{i}" for i in range(len(left_keys))]
    held = F.struct(*payload, F.lit(1).alias("_hit"))
    right_side = (
        right.withColumns({n: normalize_key(k) for n, k in zip(names, right_keys)})
        .groupBy(*[F.col(n).alias(f"_r{n}") for n in names])
        .agg(F.min_by(held, F.struct(*right_order)).alias("_p"))
    )
    keyed = left.withColumns({n: normalize_key(k) for n, k in zip(names, left_keys)})
    complete = F.lit(True)
    for n in names:
        complete = complete & F.col(n).isNotNull()
    spread = F.xxhash64(*left.columns).cast("string")
    keyed = keyed.withColumns(
        {
            "_complete": complete,
            "_first": F.when(complete, F.col(names[0])).otherwise(F.concat(F.lit("null "), spread)),
        }
    )
    condition = F.col("_complete") & (F.col("_first") == F.col("_r_k0"))
    for n in names[1:]:
        condition = condition & (F.col(n) == F.col(f"_r{n}"))
    return (
        keyed.join(right_side, condition, "left")
        .filter(F.col(names[0]).isNull() | F.col("_p").isNotNull())
        .select(*left.columns, *[F.col("_p")[c].alias(f"{c}{suffix}") for c in payload])
    )
