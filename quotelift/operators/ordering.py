"""Global order, running totals and exact quantiles without a single-task window.

A window without partition columns, or one over a hot group, sorts all its rows in
one task. Here rows are range-partitioned on the full order (group columns, sort
columns, tie-break), so a hot group or a hot tied value spreads over many tasks. The
sorted rows are written once; positions and totals then only need one small offset
per (group, chunk), and the number of offsets is at most chunks + groups.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quotelift.session import materialize

#: Size of a quantile sketch, and twice the share of a group by which its ranks may be off.
SKETCH_SIZE, SKETCH_ERROR = 2048, 0.005
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Equi-join on same-named columns where NULL matches NULL; keeps the left columns."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = F.lit(True)
    for c in on:
        condition = condition & left[c].eqNullSafe(renamed[f"_r_{c}"])
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


def ordered_chunks(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sort globally and write once; adds ``_chunk`` (in order) and ``_row`` (in chunk).

    The positions are stored, not recomputed, so every branch that reads the result
    sees the same ones, also after a retry. The number of chunks follows the data:
    adaptive execution merges small neighbouring ranges, which keeps their order.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_position", F.monotonically_increasing_id())
    )
    return (
        materialize(placed, "ordered")
        .withColumn("_chunk", F.shiftright("_position", _ROW_BITS))
        .withColumn("_row", F.col("_position").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
        .drop("_position")
    )


def _offsets(chunks: DataFrame, by: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """Per (group, chunk): first row, and for each sum the total before it and overall."""
    per_chunk = chunks.groupBy(*by, "_chunk").agg(
        F.min("_row").alias("_first"), *[F.sum(c).alias(c) for c in sums]
    )
    group = W.partitionBy(*by) if by else W.partitionBy(F.lit(1))
    before = group.orderBy("_chunk").rowsBetween(W.unboundedPreceding, -1)
    return materialize(
        per_chunk.select(
            *by,
            "_chunk",
            "_first",
            *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before_{c}") for c in sums],
            *[F.sum(c).over(group).alias(f"{c}_total") for c in sums],
        ),
        "offsets",
    )


def _order_in_groups(by: Sequence[str], order: Sequence[Column]) -> list[Column]:
    return [F.col(c).asc() for c in by] + list(order)


def add_position(
    df: DataFrame,
    order: Sequence[Column],
    out: str,
    by: Sequence[str] = (),
    total: str | None = None,
) -> DataFrame:
    """1-based position of each row in its group, like ``row_number`` over ``order``.

    ``order`` must end in a unique column. ``total`` names an optional group-size column.
    """
    chunks = ordered_chunks(df, _order_in_groups(by, order)).withColumn("_rows", F.lit(1))
    offsets = _offsets(chunks, by, ["_rows"])
    joined = join_null_safe(chunks.drop("_rows"), offsets, [*by, "_chunk"], "inner")
    position = F.col("_row") - F.col("_first") + F.col("_before__rows") + 1
    extra = [F.col("_rows_total").alias(total)] if total else []
    return joined.select(*df.columns, position.alias(out), *extra)


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    sums: Mapping[str, str],
    by: Sequence[str] = (),
) -> DataFrame:
    """Running sums in each group, current row included.

    ``sums`` maps an output name to a numeric column; ``<output>_total`` is added too.
    ``order`` must be unique in a group; group first where values repeat.
    """
    named = df.withColumns({f"_v_{out}": F.col(c) for out, c in sums.items()})
    chunks = ordered_chunks(named, _order_in_groups(by, order))
    values = [f"_v_{out}" for out in sums]
    offsets = _offsets(chunks, by, values)
    in_chunk = (
        W.partitionBy(*by, "_chunk").orderBy("_row").rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    local = chunks.withColumns({f"_sum{v}": F.sum(v).over(in_chunk) for v in values})
    joined = join_null_safe(local, offsets, [*by, "_chunk"], "inner")
    out_cols = []
    for out in sums:
        v = f"_v_{out}"
        out_cols.append((F.col(f"_sum{v}") + F.col(f"_before_{v}")).alias(out))
        out_cols.append(F.col(f"{v}_total").alias(f"{out}_total"))
    return joined.select(*df.columns, *out_cols)


def sorted_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """As :func:`exact_quantiles`, from a sort of all different values. NaN counts as largest."""
    counted = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*by, F.col(value).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_count"))
    )
    walked = running_totals(counted, [F.col("_value").asc()], {"_cum": "_count"}, by)
    last = F.col("_cum_total") - 1
    at = {name: last * F.lit(float(p)) for name, p in probs.items()}

    def value_at(index: Column) -> Column:
        held = (index < F.col("_cum")) & (index >= F.col("_cum") - F.col("_count"))
        return F.max(F.when(held, F.col("_value")))

    pieces = walked.groupBy(*by).agg(
        *[value_at(F.floor(pos)).alias(f"_lo_{name}") for name, pos in at.items()],
        *[value_at(F.ceil(pos)).alias(f"_hi_{name}") for name, pos in at.items()],
        *[F.max(pos - F.floor(pos)).alias(f"_w_{name}") for name, pos in at.items()],
    )
    return pieces.select(
        *by,
        *[
            (
                F.col(f"_lo_{n}") + F.col(f"_w_{n}") * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))
            ).alias(n)
            for n in probs
        ],
    )


def exact_quantiles(
    df: DataFrame, value: str, probs: Mapping[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles with linear interpolation, one row per group, without a global sort.

    A first scan sketches each group (KLL, merged from all tasks) and so brackets every
    quantile between two values; a second counts what lies below the bracket and the values
    inside, about one row in a hundred, where the quantile is selected exactly. Whether the
    bracket held is checked: groups where it did not, and those with NaN, are sorted.

    ``probs`` maps output names to probabilities. NULLs are ignored. ``df`` is scanned twice.
    """
    keys = list(by) or ["_all"]
    rows = df.withColumn("_all", F.lit(0)) if not by else df
    rows = rows.select(*keys, F.col(value).cast("double").alias("_value")).filter(F.col("_value").isNotNull())
    sketched = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("_value").alias("_least"),
        F.max("_value").alias("_most"),
        F.kll_sketch_agg_double("_value", F.lit(SKETCH_SIZE)).alias("_sketch"),
    )

    def edge(rank: float) -> Column:
        if rank <= 0:
            return F.col("_least")
        return F.col("_most") if rank >= 1 else F.kll_sketch_get_quantile_double("_sketch", F.lit(rank))

    marks = [
        F.struct(F.lit(i).alias("p"), edge(p - SKETCH_ERROR).alias("lo"), edge(p + SKETCH_ERROR).alias("hi"))
        for i, p in enumerate(probs.values())
    ]
    groups = materialize(sketched.select(*keys, "_n", F.isnan("_most").alias("_nan"), F.array(*marks).alias("_marks")), "brackets")
    placed = join_null_safe(rows, groups.filter(~F.col("_nan")), keys, "inner")
    v = F.col("_value")
    # below a bracket only the number matters; what lies above it does not count
    seen = F.transform(
        "_marks", lambda m: F.when(v <= m["hi"], F.struct(m["p"].alias("p"), F.when(v >= m["lo"], v).alias("v")))
    )
    seen = placed.select(*keys, "_n", F.explode(F.filter(seen, lambda x: x.isNotNull())).alias("_x"))
    counted = seen.groupBy(*keys, "_n", F.col("_x.p").alias("_p"), F.col("_x.v").alias("_v")).agg(F.count(F.lit(1)).alias("_count"))
    upward = W.partitionBy(*keys, "_p").orderBy(F.col("_v").asc_nulls_first()).rowsBetween(W.unboundedPreceding, W.currentRow)
    walked = counted.withColumn("_cum", F.sum("_count").over(upward))
    last = F.col("_n") - 1
    at = {name: last * F.lit(float(p)) for name, p in probs.items()}

    def held(i: int, index: Column) -> Column:
        mine = (F.col("_p") == i) & (index < F.col("_cum")) & (index >= F.col("_cum") - F.col("_count"))
        return F.max(F.when(mine, F.col("_v")))

    pieces = walked.groupBy(*keys).agg(
        *[held(i, F.floor(pos)).alias(f"_lo_{n}") for i, (n, pos) in enumerate(at.items())],
        *[held(i, F.ceil(pos)).alias(f"_hi_{n}") for i, (n, pos) in enumerate(at.items())],
        *[F.max(pos - F.floor(pos)).alias(f"_w_{n}") for n, pos in at.items()],
    )
    found = pieces.select(
        *keys, *[(F.col(f"_lo_{n}") + F.col(f"_w_{n}") * (F.col(f"_hi_{n}") - F.col(f"_lo_{n}"))).alias(n) for n in probs]
    )
    found = materialize(join_null_safe(groups.select(*keys), found, keys, "left"), "quantiles")
    missed = reduce(lambda x, y: x | y, [F.col(n).isNull() for n in probs])
    open_ = found.filter(missed).select(*keys)
    if not open_.isEmpty():
        again = sorted_quantiles(join_null_safe(rows, open_, keys, "left_semi"), "_value", probs, keys)
        found = found.filter(~missed).unionByName(again)
    return found.select(*by, *probs)


def global_rank(df: DataFrame, score: str, tie: str, out: str = "rank") -> DataFrame:
    """Rank 1..N by descending score, ties broken by ``tie``; NULL scores come last."""
    return add_position(df, [F.col(score).desc_nulls_last(), F.col(tie).asc()], out)


def local_rank(
    df: DataFrame, score: str, tie: str, by: Sequence[str], out: str = "rank"
) -> DataFrame:
    """As :func:`global_rank`, counted inside each group."""
    return add_position(df, [F.col(score).desc_nulls_last(), F.col(tie).asc()], out, by)


def top_ranked(df: DataFrame, rank: str, n: int) -> DataFrame:
    """The ``n`` best-ranked rows in order (a top-k, not a full sort)."""
    return df.orderBy(F.col(rank).asc()).limit(n)
