"""Column-level operators: dropping, renaming, casting, type inference."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotelift.functions import blank_to_null, is_blank, looks_numeric, parse_number_us

INTEGER_TEXT = r"^-?\d+$"


def string_columns(df: DataFrame) -> list[str]:
    return [c for c, t in df.dtypes if t == "string"]


def replace_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """One projection that swaps the given columns in place and keeps the order."""
    return df.select(*[new[c].alias(c) if c in new else F.col(c) for c in df.columns])


def blanks_to_null(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Blank text becomes NULL in the given columns that exist, or in all text columns."""
    present = string_columns(df) if cols is None else [c for c in cols if c in df.columns]
    return replace_columns(df, {c: blank_to_null(c) for c in present})


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def upper_values(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return replace_columns(df, {c: F.upper(F.col(c).cast("string")) for c in present})


def cast_double(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return replace_columns(df, {c: F.col(c).try_cast("double") for c in present})


def cast_money(df: DataFrame, cols: Iterable[str], scale: int) -> DataFrame:
    """US-style number text to ``decimal(17, scale)`` in the given columns that exist."""
    present = [c for c in cols if c in df.columns]
    return replace_columns(df, {c: parse_number_us(c, scale) for c in present})


def infer_numeric_types(df: DataFrame, protect: Sequence[str] = ()) -> dict[str, str]:
    """Which text columns hold only numbers: ``{column: 'bigint' | 'double'}``.

    One aggregate over the table. A column without any text is ``bigint``; integers
    that do not fit ``bigint`` make the column ``double``. ``protect`` keeps codes with
    leading zeros as text.
    """
    cols = [c for c in string_columns(df) if c not in protect]
    if not cols:
        return {}
    aggs = []
    for c in cols:
        filled = ~is_blank(c)
        # as bigint: digits only, with no spaces around, and in range
        whole = F.col(c).rlike(INTEGER_TEXT) & F.col(c).try_cast("bigint").isNotNull()
        aggs.append(F.count_if(filled & ~whole).alias(f"{c}__int"))
        real = looks_numeric(c) & F.col(c).try_cast("double").isNotNull()
        aggs.append(F.count_if(filled & ~real).alias(f"{c}__dbl"))
    bad = df.agg(*aggs).first()
    types = {c: "bigint" for c in cols if bad[f"{c}__int"] == 0}
    types.update({c: "double" for c in cols if c not in types and bad[f"{c}__dbl"] == 0})
    return types


def apply_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast to a pinned schema; values that do not fit become NULL.

    Later batches are cast to the types inferred on the first load, so that one batch
    cannot change the schema of the table.
    """
    present = {c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns}
    return replace_columns(df, present)


def count_rejects(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Per column, how many filled values do not fit the pinned type."""
    present = {c: t for c, t in types.items() if c in df.columns}
    one = df.agg(
        *[
            F.count_if(~is_blank(c) & F.col(c).try_cast(t).isNull()).alias(c)
            for c, t in present.items()
        ]
    )
    return one.unpivot([], list(present), "column", "rejected")


def infer_numeric(df: DataFrame, protect: Sequence[str] = ()) -> DataFrame:
    """Text columns that hold only numbers become ``bigint`` or ``double``."""
    return apply_types(df, infer_numeric_types(df, protect))


def filled(df: DataFrame, c: str) -> Column:
    """True where the column is not NULL and, for text, not blank."""
    return ~is_blank(c) if dict(df.dtypes)[c] == "string" else F.col(c).isNotNull()


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single filled value (one aggregate)."""
    used = df.agg(*[F.max(filled(df, c)).alias(c) for c in df.columns]).first()
    return df.select(*[c for c in df.columns if used[c]])


def unpivot_scores(
    df: DataFrame, keep: Sequence[str], score_prefix: str, rank_prefix: str
) -> DataFrame:
    """Wide score columns to one row per (row, model): ``model_id, score, score_rank``.

    Models are found by the score prefix, in alphabetical order.
    """
    models = sorted(c[len(score_prefix) :] for c in df.columns if c.startswith(score_prefix))
    if not models:
        raise ValueError(f"no column starts with {score_prefix!r}")
    entries = []
    for m in models:
        rank = f"{rank_prefix}{m}"
        entries.append(
            F.struct(
                F.lit(m).alias("model_id"),
                F.col(f"{score_prefix}{m}").cast("double").alias("score"),
                (F.col(rank) if rank in df.columns else F.lit(None)).cast("bigint").alias("score_rank"),
            )
        )
    return df.select(*keep, F.inline(F.array(*entries)))
