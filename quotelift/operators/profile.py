"""Profiles and distributions: one aggregate each, results as small tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quotelift.functions import status_key
from quotelift.operators.columns import filled
from quotelift.operators.ordering import exact_quantiles


def load_profile(df: DataFrame, ts: str) -> DataFrame:
    """First and last file date, rows and columns of a loaded table."""
    return df.agg(
        F.min(F.col(ts).cast("date")).alias("first_date"),
        F.max(F.col(ts).cast("date")).alias("last_date"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(df.columns)).alias("n_columns"),
    )


def rows_by_day(df: DataFrame, ts: str, out: str = "day") -> DataFrame:
    """Row count per calendar day; rows without a date form their own group."""
    return df.groupBy(F.col(ts).cast("date").alias(out)).agg(F.count(F.lit(1)).alias("n_rows"))


def rows_by_quote_date(df: DataFrame, date: str) -> DataFrame:
    """Row count per quote date, rows without a date left out."""
    return rows_by_day(df.filter(F.col(date).isNotNull()), date, "quote_date")


def profile_nulls(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Per column: rows, NULL-or-blank rows and, for key columns, distinct values.

    Values of the keys are counted from (column, value) pairs, which are combined on the
    map side; several distinct counts in one aggregate would copy every row per key.
    """
    keys = [c for c in keys if c in df.columns]
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(df.columns):
        aggs.append(F.count_if(~filled(df, c)).alias(f"e{i}"))
        if c in keys:
            aggs.append(F.coalesce(F.max(F.col(c).isNull()), F.lit(False)).alias(f"h{i}"))
    entries = []
    for i, c in enumerate(df.columns):
        entries.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col("n").alias("n_rows"),
                F.col(f"e{i}").alias("n_empty"),
                # a NULL key counts as one more distinct value
                (F.col(f"h{i}") if c in keys else F.lit(None)).cast("bigint").alias("_more"),
            )
        )
    out = df.agg(*aggs).select(F.inline(F.array(*entries)))
    if not keys:
        return out.withColumnRenamed("_more", "n_distinct")
    counted = cardinality(df, keys).withColumnRenamed("n_distinct", "_distinct")
    distinct = F.col("_more") + F.coalesce(F.col("_distinct"), F.lit(0))
    return out.join(counted, "column_name", "left").select(
        "column_name", "n_rows", "n_empty", distinct.alias("n_distinct")
    )


def segment_counts(df: DataFrame, segment: str) -> DataFrame:
    return df.groupBy(segment).agg(F.count(F.lit(1)).alias("n_rows")).orderBy(F.desc("n_rows"), segment)


def status_share(df: DataFrame, segment: str, status: str) -> DataFrame:
    """Count per (segment, status) and its share of the segment; NULL segments included."""
    counts = df.groupBy(segment, status).agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.sum("n_rows").over(W.partitionBy(segment))
    return counts.withColumn("segment_total", total).withColumn(
        "share", F.col("n_rows") / F.col("segment_total")
    )


def label_rate(df: DataFrame, segment: str, label: str) -> DataFrame:
    return df.groupBy(segment).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(F.col(label).cast("double")).alias("label_rate")
    )


def status_month_pivot(
    df: DataFrame, date: str, status: str, values: Sequence[str] | None = None
) -> DataFrame:
    """Month by status counts, 0 where a status does not occur.

    Give ``values`` where the statuses are known: the pivot then needs no extra job.
    """
    dated = df.filter(F.col(date).isNotNull()).select(
        F.date_format(F.col(date).cast("date"), "yyyy-MM").alias("month"),
        status_key(status).alias("status"),
    )
    return dated.groupBy("month").pivot("status", values).count().na.fill(0)


def score_profile(df: DataFrame, score: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(score).isNull()).alias("n_null"),
        F.min(score).alias("min_score"),
        F.avg(score).alias("mean_score"),
        F.max(score).alias("max_score"),
    )


def null_share(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """NULL count and share per column, in long form."""
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(F.col(c).isNull()).alias(f"c{i}") for i, c in enumerate(cols)],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"c{i}").alias("n_null"),
            F.try_divide(F.col(f"c{i}"), F.col("n")).alias("null_share"),
        )
        for i, c in enumerate(cols)
    ]
    return one.select(F.inline(F.array(*entries)))


def cardinality(df: DataFrame, cols: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-NULL values per column.

    The exact count groups (column, value) pairs first, so that each value is reduced
    on the map side and no row is expanded per column afterwards.
    """
    if approximate:
        one = df.agg(*[F.approx_count_distinct(c).alias(c) for c in cols])
        return one.unpivot([], list(cols), "column_name", "n_distinct")
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                    for c in cols
                ]
            )
        )
    )
    return (
        pairs.groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column_name")
        .agg(F.count("value").alias("n_distinct"))
    )


def entity_profile(
    df: DataFrame, entity: str, rate: str, volume: str, product: str
) -> DataFrame:
    """Per entity: mean rate, mean volume, number of distinct products."""
    return df.groupBy(entity).agg(
        F.avg(rate).alias("rate_mean"),
        F.avg(volume).alias("volume_mean"),
        F.count_distinct(F.col(product)).alias("n_products"),
    )


def distinct_topk(df: DataFrame, group: str, counted: str, n: int) -> DataFrame:
    """The ``n`` groups with the most distinct values of another column."""
    return (
        df.groupBy(group)
        .agg(F.count_distinct(F.col(counted)).alias("n_distinct"))
        .orderBy(F.desc("n_distinct"), group)
        .limit(n)
    )


def features_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per (row, feature) with the value as double."""
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols
    ]
    return df.select(F.inline(F.array(*entries)))


def feature_percentiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact percentiles per feature; columns are named ``p10``, ``p25`` and so on."""
    named = {f"p{round(p * 100)}": p for p in probs}
    return exact_quantiles(features_long(df, cols), "value", named, ["feature"])


def edge_bin(value, low, width, bins: int):
    """Index of the bin ``[low + i*width, low + (i+1)*width)`` that holds the value.

    The first guess comes from a division; it is then checked against the edges, so
    rounding never puts a value on the wrong side. The last bin includes its upper end.
    """
    guess = F.floor((value - low) / width)
    exact = (
        F.when(value < low + guess * width, guess - 1)
        .when(value >= low + (guess + 1) * width, guess + 1)
        .otherwise(guess)
    )
    return F.least(exact, F.lit(bins - 1)).cast("int")


def feature_histogram(df: DataFrame, cols: Sequence[str], bins: int = 50) -> DataFrame:
    """Equal-width histogram per feature over its range, with mean and median."""
    values = features_long(df, cols).filter(F.col("value").isNotNull())
    spans = values.groupBy("feature").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.avg("value").alias("mean")
    )
    medians = exact_quantiles(values, "value", {"median": 0.5}, ["feature"])
    # one row per feature: bounded by the number of columns asked for
    facts = F.broadcast(spans.join(medians, "feature"))
    width = (F.col("high") - F.col("low")) / bins
    binned = (
        values.join(facts, "feature")
        .withColumn("width", width)
        .withColumn(
            "bin",
            F.when(F.col("width") > 0, edge_bin(F.col("value"), F.col("low"), F.col("width"), bins))
            .otherwise(0),
        )
    )
    return binned.groupBy("feature", "bin").agg(
        F.min(F.col("low") + F.col("bin") * F.col("width")).alias("bin_start"),
        F.count(F.lit(1)).alias("n_rows"),
        F.min("mean").alias("mean"),
        F.min("median").alias("median"),
    )
