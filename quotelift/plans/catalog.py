"""Rule catalogues of the tables, the joins and the training data.

``house`` is the suffix some identifier columns carry in the source files, for example
``"_X"`` for ``CD_NUMERO_COTACAO_X``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotelift.functions import as_date, is_blank, make_date, normalize_key, status_key
from quotelift.operators.columns import cast_money, drop_empty_columns, replace_columns, upper_names
from quotelift.operators.features import hash_split
from quotelift.operators.joins import dedupe_most_filled, join_retention
from quotelift.operators.temporal import (
    days_between,
    days_since_update,
    days_to_reference,
    latest_with_entries,
    reference_date,
    stale_to_lost,
)
from quotelift.plans import fixed_values as fv
from quotelift.plans.rules import Rule


# --- quote rules ----------------------------------------------------------------------


def quote_date(df: DataFrame) -> DataFrame:
    return df.withColumn("DATA_COTACAO", make_date("ANO_COTACAO", "MES_COTACAO", "DIA_COTACAO"))


def channel(df: DataFrame, flag: str, quote: str, out: str = "CANAL") -> DataFrame:
    """MANUAL if the flag says so or the id has the manual prefix, else DIGITAL."""
    by_flag = F.lower(F.trim(F.col(flag).cast("string"))).isin(fv.MANUAL_FLAGS)
    by_id = status_key(quote).startswith(fv.MANUAL_ID_PREFIX)
    return df.withColumn(out, F.when(by_flag | by_id, fv.MANUAL).otherwise(fv.DIGITAL))


def sentinel_date(df: DataFrame, date: str) -> DataFrame:
    """Placeholder dates (too far ahead, or the empty date) become NULL."""
    d = as_date(df, date)
    bad = (F.year(d) > fv.LAST_VALID_YEAR) | (d == F.lit(fv.EMPTY_DATE).cast("date"))
    return replace_columns(df, {date: F.when(~F.coalesce(bad, F.lit(False)), d)})


def default_value(
    df: DataFrame, col: str, default: str, synonyms: Sequence[str] = ()
) -> DataFrame:
    """NULL, blank and listed (lower-case) synonyms take the default value."""
    replace = is_blank(col)
    if synonyms:
        replace = replace | F.lower(F.trim(F.col(col))).isin(list(synonyms))
    return replace_columns(df, {col: F.when(replace, default).otherwise(F.col(col))})


def refused_filter(df: DataFrame, quote: str, status: str, saved: str) -> DataFrame:
    """Without refused quotes; manual ids all stay, the others only when saved.

    One predicate, one scan. Rows with a NULL id match neither branch.
    """
    refused = F.coalesce(status_key(status), F.lit("")).isin(fv.REFUSED_STATUSES)
    manual = status_key(quote).startswith(fv.MANUAL_ID_PREFIX)
    is_saved = F.coalesce(status_key(saved), F.lit("")) == fv.SAVED_FLAG
    return df.filter(~refused & (manual | (~manual & is_saved)))


def temporal_rule(
    df: DataFrame,
    quote: str,
    status: str = "DS_GRUPO_STATUS",
    ts: str = "TS_ARQ",
    tie: str | None = None,
    stale_days: int = fv.STALE_DAYS,
    leave_out: Sequence[str] = (),
) -> DataFrame:
    """Latest snapshot per quote, stale quotes closed, day counts to the closing date.

    ``leave_out`` names columns that need not travel through the shuffle.
    """
    carried = [c for c in df.columns if c not in leave_out or c in (quote, status, ts)]
    entries = {"TS_FECHAMENTO_EMITIDA": fv.ISSUED, "TS_FECHAMENTO_PERDIDA_NAT": fv.LOST}
    latest = latest_with_entries(df, quote, ts, tie or status, status, entries, carried)
    aged = days_since_update(latest, df, ts, "DIAS_ULTIMA_ATUALIZACAO")
    closed = stale_to_lost(
        aged,
        status,
        "DIAS_ULTIMA_ATUALIZACAO",
        fv.OPEN_STATUSES,
        stale_days,
        fv.LOST,
        "DS_GRUPO_STATUS_OLD",
        "FL_PERDIDA_90D",
    ).withColumn(
        "REF_DATE",
        reference_date(
            status,
            "FL_PERDIDA_90D",
            ts,
            "TS_FECHAMENTO_EMITIDA",
            "TS_FECHAMENTO_PERDIDA_NAT",
            fv.ISSUED,
            fv.LOST,
        ),
    )
    out = days_to_reference(closed, fv.DAYS_TO_REFERENCE, "REF_DATE")
    if "DATA_COTACAO" in out.columns:
        out = replace_columns(out, {"DATA_COTACAO": as_date(out, "DATA_COTACAO")})
        out = days_between(out, "DATA_COTACAO", "REF_DATE", "DIAS_COTACAO")
        if "DT_INICIO_VIGENCIA" in out.columns:
            out = replace_columns(
                out, {"DT_INICIO_VIGENCIA": as_date(out, "DT_INICIO_VIGENCIA")}
            )
            out = days_between(out, "DT_INICIO_VIGENCIA", "DATA_COTACAO", "DIAS_INICIO_VIGENCIA")
    return out


def canonical_status(df: DataFrame, status: str = "DS_GRUPO_STATUS") -> DataFrame:
    """Final statuses in their canonical spelling, all others untouched."""
    out = F.col(status)
    for value in fv.FINAL_STATUSES:
        out = F.when(status_key(status) == value.upper(), value).otherwise(out)
    return replace_columns(df, {status: out})


def final_status(df: DataFrame, status: str = "DS_GRUPO_STATUS") -> DataFrame:
    return df.filter(F.col(status).isin(fv.FINAL_STATUSES))


def label(
    df: DataFrame, status: str = "DS_GRUPO_STATUS", out: str = "label", kind: str = "int"
) -> DataFrame:
    """1 for issued, 0 for lost, NULL for every other status."""
    y = F.when(F.col(status) == fv.ISSUED, 1).when(F.col(status) == fv.LOST, 0)
    return df.withColumn(out, y.cast(kind))


def month(df: DataFrame, date: str = "DATA_COTACAO", out: str = "MES") -> DataFrame:
    """Month as ``yyyy-MM``; rows without a date are dropped."""
    d = as_date(df, date)
    return df.filter(d.isNotNull()).withColumn(out, F.date_format(d, "yyyy-MM"))


def exclude_months(
    df: DataFrame, date: str = "DATA_COTACAO", months: Sequence[str] = tuple(fv.EXCLUDED_MONTHS)
) -> DataFrame:
    """Without the listed months; rows without a date drop too."""
    return df.filter(~F.date_format(as_date(df, date), "yyyy-MM").isin(list(months)))


def quote_drops(house: str = "") -> list[str]:
    return fv.QUOTE_DROPS + [f"{c}{house}" for c in fv.QUOTE_DROPS_WITH_HOUSE]


def quote_rules(
    house: str = "",
    purpose: str = "train",
    tie: str | None = None,
    leave_out: Sequence[str] = (),
) -> list[Rule]:
    """Cleaning rules of the quote table.

    ``purpose='score'`` keeps open quotes and sets no label: their outcome is unknown.
    ``leave_out`` names columns that GEN_R07 need not carry through its shuffle because
    GEN_R08 drops them anyway.
    """
    quote = f"CD_NUMERO_COTACAO{house}"
    train = purpose == "train"
    return [
        Rule("GEN_R00", "upper-case column names", upper_names, enabled=not train),
        Rule(
            "GEN_R01",
            "quote date from year, month and day",
            quote_date,
            requires=("ANO_COTACAO", "MES_COTACAO", "DIA_COTACAO"),
        ),
        Rule(
            "GEN_R02",
            "sales channel",
            lambda d: channel(d, "FL_ANALISE_SUBSCRICAO", quote),
            requires=("FL_ANALISE_SUBSCRICAO", quote),
        ),
        Rule(
            "GEN_R03",
            "placeholder start dates to NULL",
            lambda d: sentinel_date(d, "DT_INICIO_VIGENCIA"),
            requires=("DT_INICIO_VIGENCIA",),
        ),
        Rule("GEN_R04", "money columns", lambda d: cast_money(d, fv.QUOTE_MONEY, 2)),
        Rule(
            "GEN_R05",
            "quote type default",
            lambda d: default_value(d, "DS_TIPO_COTACAO", fv.NEW_QUOTE, [fv.SIMILAR_RENEWAL]),
            requires=("DS_TIPO_COTACAO",),
        ),
        Rule(
            "GEN_R06",
            "no refused quotes, unsaved only with a manual id",
            lambda d: refused_filter(d, quote, "DS_STATUS", "FL_SALVO"),
            requires=(quote, "DS_STATUS", "FL_SALVO"),
        ),
        Rule(
            "GEN_R07",
            "latest snapshot, stale quotes, day counts",
            lambda d: temporal_rule(d, quote, tie=tie, leave_out=leave_out),
            requires=(quote, "TS_ARQ", "DS_GRUPO_STATUS"),
        ),
        Rule("GEN_R08", "drop columns out of scope", lambda d: d.drop(*quote_drops(house))),
        Rule("GEN_R09", "canonical status", canonical_status, requires=("DS_GRUPO_STATUS",)),
        Rule("GEN_R10", "final statuses", final_status, train, ("DS_GRUPO_STATUS",)),
        Rule("GEN_R11", "label", label, train, ("DS_GRUPO_STATUS",)),
        Rule("GEN_R12", "quote month", month, requires=("DATA_COTACAO",)),
    ]


# --- broker rules ---------------------------------------------------------------------


def commercial_channel(df: DataFrame, col: str = "DS_CANAL_COMERCIAL") -> DataFrame:
    digital = F.coalesce(status_key(col) == fv.DIGITAL, F.lit(False))
    return replace_columns(df, {col: F.when(digital, fv.DIGITAL).otherwise(fv.MANUAL)})


def summary_rules(purpose: str = "train", tie: str | None = None) -> list[Rule]:
    """Cleaning rules of the broker summary.

    Dropping empty columns is off for incremental runs, where one batch must not change
    the stored schema. Dedupe works on the normalised key the join uses.
    """

    def dedupe(df: DataFrame) -> DataFrame:
        scored = [c for c in df.columns if c != "CD_CORRETOR"]
        ts = "TS_ARQ" if "TS_ARQ" in df.columns else None
        return dedupe_most_filled(df, normalize_key("CD_CORRETOR"), tie or "CD_CORRETOR", ts, scored)

    return [
        Rule("RES_R01", "one row per broker, most filled wins", dedupe, requires=("CD_CORRETOR",)),
        Rule("RES_R02", "money column", lambda d: cast_money(d, fv.SUMMARY_MONEY, 2)),
        Rule(
            "RES_R03", "commercial channel", commercial_channel, requires=("DS_CANAL_COMERCIAL",)
        ),
        Rule("RES_R04", "drop technical columns", lambda d: d.drop(*fv.SUMMARY_TECHNICAL_DROPS)),
        Rule("RES_R05", "drop empty columns", drop_empty_columns, purpose == "train"),
        Rule("RES_R06", "drop extra columns", lambda d: d.drop(*fv.SUMMARY_EXTRA_DROPS)),
        Rule("RES_R07", "drop flags", lambda d: d.drop(*fv.SUMMARY_FLAG_DROPS)),
        Rule("RES_R08", "upper-case column names", upper_names),
    ]


def detail_rules(purpose: str = "train") -> list[Rule]:
    return [
        Rule(
            "DET_R01",
            "request type default",
            lambda d: default_value(d, "DS_TIPO_SOLICITACAO", fv.NEW_QUOTE),
            requires=("DS_TIPO_SOLICITACAO",),
        ),
        Rule("DET_R02", "drop technical columns", lambda d: d.drop(*fv.DETAIL_DROPS)),
        Rule("DET_R03", "rate columns", lambda d: cast_money(d, fv.DETAIL_RATES, 6)),
        Rule("DET_R04", "upper-case column names", upper_names, purpose == "score"),
    ]


# --- join and segment -----------------------------------------------------------------


def segment(
    df: DataFrame,
    channel_col: str = "CANAL",
    type_col: str = "DS_TIPO_COTACAO",
    out: str = "SEG",
    renewal_words: Sequence[str] = tuple(fv.SEGMENT_RENEWAL_WORDS),
) -> DataFrame:
    """``TYPE_CHANNEL``, NULL if either part is not known.

    ``renewal_words`` are the lower-case spellings that mean a renewal in the source.
    """

    def code(col: str, words: dict[str, str]):
        text = F.lower(F.trim(F.col(col).cast("string")))
        out = F.lit(None).cast("string")
        for word, value in words.items():
            out = F.when(text == word, value).otherwise(out)
        return out

    types = fv.SEGMENT_NEW_TYPE | {w: fv.SEGMENT_RENEWAL for w in renewal_words}
    # concat is NULL as soon as one part is
    return df.withColumn(
        out, F.concat(code(type_col, types), F.lit("_"), code(channel_col, fv.SEGMENT_CHANNELS))
    )


def join_rules(summary: DataFrame, detail: DataFrame) -> list[Rule]:
    detail_keys = ["CD_DOC_CORRETOR", "DS_PRODUTO_NOME", "DS_TIPO_SOLICITACAO"]
    quote_keys = ["CD_DOC_CORRETOR", "DS_PRODUTO_NOME", "DS_TIPO_COTACAO"]

    def all_of(df: DataFrame):
        return [F.col(c) for c in df.columns]

    return [
        Rule(
            "JOIN_R01",
            "broker summary",
            lambda d: join_retention(
                d, summary, ["CD_DOC_CORRETOR"], ["CD_CORRETOR"], "_resumo", all_of(summary)
            ),
            requires=("CD_DOC_CORRETOR",),
        ),
        Rule(
            "JOIN_R02",
            "broker detail",
            lambda d: join_retention(d, detail, quote_keys, detail_keys, "_detalhe", all_of(detail)),
            requires=tuple(quote_keys),
        ),
    ]


def renewal_spellings(house: str = "") -> list[str]:
    """Lower-case spellings of a renewal in the source, with and without the house suffix."""
    tail = house.strip("_ ").lower()
    return [*fv.SEGMENT_RENEWAL_WORDS, *([f"{w} {tail}" for w in fv.SEGMENT_RENEWAL_WORDS] if tail else [])]


def segment_rules(renewal_words: Sequence[str] = tuple(fv.SEGMENT_RENEWAL_WORDS)) -> list[Rule]:
    inputs = ["CANAL", "DS_TIPO_COTACAO"]
    return [
        Rule(
            "SEG_R01",
            "segment",
            lambda d: segment(d, renewal_words=renewal_words),
            requires=tuple(inputs),
        ),
        Rule("SEG_R02", "drop segment inputs", lambda d: d.drop(*inputs)),
    ]


# --- training data --------------------------------------------------------------------


def training_rules(months: Sequence[str] = tuple(fv.EXCLUDED_MONTHS)) -> list[Rule]:
    status = ("DS_GRUPO_STATUS",)
    return [
        Rule("PP_R01", "canonical status", canonical_status, requires=status),
        Rule("PP_R02", "final statuses", final_status, requires=status),
        Rule("PP_R03", "label", lambda d: label(d, kind="double"), requires=status),
        Rule(
            "PP_R07",
            "leave out months",
            lambda d: exclude_months(d, months=months),
            requires=("DATA_COTACAO",),
        ),
    ]


def split_rules(house: str = "", fn: str = "xxhash64") -> list[Rule]:
    keys = [f"CD_NUMERO_COTACAO{house}", "SEG", "MES"]
    return [
        Rule("BUILD_R01", "quote month", month, requires=("DATA_COTACAO",)),
        Rule("BUILD_R02", "split flag", lambda d: hash_split(d, keys, fn=fn), requires=tuple(keys)),
    ]


def part_rules(valid: bool) -> list[Rule]:
    rule_id = "VALID_R03" if valid else "MODEL_R03"
    keep = F.col("is_valid") if valid else ~F.col("is_valid")
    return [
        Rule(rule_id, "keep its part of the split", lambda d: d.filter(keep), requires=("is_valid",)),
        Rule("BUILD_R04", "drop the split flag", lambda d: d.drop("is_valid")),
    ]
