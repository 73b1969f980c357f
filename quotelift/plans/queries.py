"""Registered queries: every operator on the given tables, whole tables always."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quotelift.functions import (
    blank_to_null,
    normalize_key,
    parse_date,
    parse_number_ptbr,
    parse_number_us,
)
from quotelift.operators import cluster, columns, evaluation, features, joins, ordering, profile
from quotelift.operators import selection, temporal, training
from quotelift.plans import catalog, flows
from quotelift.plans import fixed_values as fv
from quotelift.plans.rules import Rule, apply_rules, consume, counted, log_frame
from quotelift.session import materialize, scratch_path
from quotelift.sources import files, tables
from quotelift.sources.standins import base_table, view
from quotelift.streaming.ingest import drop_late_files, read_deliveries, start_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Thirty days of history: the stale limit of the rule is a parameter, scaled to it.
STALE_DAYS = 7
ENTRIES = {"issued_at": "EMITIDA", "lost_at": "PERDIDA"}
MODELS = ("a", "b")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Sums of doubles depend on the order of addition; compare them at six places."""
    return columns.replace_columns(df, {c: r6(c) for c in cols})


# --- sources and sinks ----------------------------------------------------------------


def delivered(spark: SparkSession, sf: str) -> str:
    """Write all quotes as dated deliveries, one per month; gives their folder."""
    folder = scratch_path(spark, "deliveries")
    quotes = view(spark, sf, "v_quotes")
    name = F.concat(
        F.lit("COTACAO_GENERICO_"), F.date_format(F.last_day("quote_date"), "yyyyMMdd"), F.lit(".csv")
    )
    text = quotes.select(
        "quote_id",
        F.concat(F.lit('"'), F.col("status"), F.lit('"')).alias("status"),
        F.col("channel").alias("'channel'"),
        F.col("quote_date"),
    )
    files.write_delivery(text, folder, name)
    return folder


@query
def scan_csv(spark, sf):
    rows = files.scan_csv(spark, delivered(spark, sf), tag=False)
    return rows.select(
        F.col("quote_id").cast("bigint").alias("quote_id"), "status", "channel", "quote_date"
    )


@query
def tag_source(spark, sf):
    rows = files.scan_csv(spark, delivered(spark, sf))
    return rows.groupBy("SOURCE_FILE", F.col("TS_ARQ").cast("date").alias("file_date")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("TS_ATUALIZACAO").isNotNull()).alias("n_stamped"),
    )


def file_log(spark: SparkSession, sf: str) -> DataFrame:
    """Snapshots as a loaded table: every day of history is one file."""
    return view(spark, sf, "v_snapshots").withColumn(
        "SOURCE_FILE",
        F.concat(F.lit("COTACAO_GENERICO_"), F.date_format("day", "yyyyMMdd"), F.lit(".csv")),
    )


@query
def high_water_mark(spark, sf):
    return files.high_water_mark(file_log(spark, sf), "ts_arq")


@query
def loaded_files(spark, sf):
    return files.loaded_files(file_log(spark, sf))


def listing_and_loaded(spark, sf):
    """All file names of the history; the files of odd days up to the 15th are loaded."""
    log = file_log(spark, sf)
    listing = (
        log.select(F.col("SOURCE_FILE").alias("source_file"))
        .distinct()
        .withColumn("file_date", files.date_of("source_file"))
    )
    done = log.filter((F.day("day") <= 15) & (F.day("day") % 2 == 1))
    return listing, done


@query
def incremental_candidates(spark, sf):
    listing, done = listing_and_loaded(spark, sf)
    cutoff = files.high_water_mark(done, "ts_arq").scalar()
    return files.incremental_candidates(listing, files.loaded_files(done), cutoff)


@query
def incremental_limit(spark, sf):
    listing, done = listing_and_loaded(spark, sf)
    return files.incremental_candidates(listing, files.loaded_files(done), limit=5)


@query
def new_row_flag(spark, sf):
    loads = view(spark, sf, "v_snapshots").withColumn("batch_id", F.day("day").cast("bigint"))
    flagged = tables.new_row_flag(loads)
    return flagged.groupBy("FL_NOVO").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("batch_id").alias("first_batch")
    )


@query
def replay_files(spark, sf):
    """Replay takes every file of the listing, loaded or not."""
    return files.incremental_candidates(listing_and_loaded(spark, sf)[0])


@query
def late_files(spark, sf):
    """A stream with a cutoff: rows of files dated before it are left out."""
    log = file_log(spark, sf).withColumn("TS_ARQ", F.col("day").cast("timestamp"))
    middle = log.agg(F.date_from_unix_date(F.avg(F.unix_date("day")).cast("int")).alias("d")).first()["d"]
    kept = drop_late_files(log, middle)
    return kept.groupBy(F.col("TS_ARQ").cast("date").alias("file_date")).agg(F.count(F.lit(1)).alias("n_rows"))


@query
def rows_after_position(spark, sf):
    """What a step reads that has consumed the loads up to the tenth."""
    loads = view(spark, sf, "v_snapshots").withColumn("batch_id", F.day("day").cast("bigint"))
    return tables.rows_after(loads, 10).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def table_sinks(spark, sf):
    """A versioned table is not overwritten; a dimension is copied once, and again if asked for."""
    made, copy = f"made_{uuid.uuid4().hex}", f"copy_{uuid.uuid4().hex}"
    suppliers = base_table(spark, sf, "supplier")
    tables.write_new(suppliers, made, partition_by="s_nationkey")
    try:
        tables.write_new(suppliers.limit(1), made)
        refused = False
    except ValueError:
        refused = True
    done = [tables.copy_table(spark, made, copy, refresh) for refresh in (False, False, True)]
    out = materialize(
        spark.table(copy).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("s_nationkey").alias("n_nations"),
            *[F.lit(v).alias(n) for n, v in zip(("refused", "copied", "copied_again", "refreshed"), [refused, *done])],
        ),
        "sinks",
    )
    for name in (made, copy):
        spark.sql(f"DROP TABLE {name}")
    return out


@query
def stream_ingest(spark, sf):
    folder = delivered(spark, sf)
    target, state = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    schema = "quote_id bigint, status string, channel string, quote_date date"
    for _ in range(2):  # the second run finds nothing new
        start_ingest(read_deliveries(spark, folder, schema, max_files=50), target, state).awaitTermination()
    rows = spark.read.parquet(target)
    return rows.groupBy("SOURCE_FILE", F.col("TS_ARQ").cast("date").alias("file_date")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(F.col("quote_id")).alias("n_quotes")
    )


# --- cleaning expressions ---------------------------------------------------------------


@query
def blank_to_null_values(spark, sf):
    df = view(spark, sf, "v_text")
    return df.select("quote_id", blank_to_null("us_text").alias("us_text"))


@query
def blanks_to_null(spark, sf):
    df = view(spark, sf, "v_text").select("quote_id", "key_text", "us_text", "empty_text")
    return columns.blanks_to_null(df)


@query
def parse_number_us_values(spark, sf):
    df = view(spark, sf, "v_text")
    return df.select(
        "quote_id", parse_number_us("us_text", 2).cast("double").alias("amount")
    )


@query
def parse_number_ptbr_values(spark, sf):
    df = view(spark, sf, "v_text")
    return df.select("quote_id", parse_number_ptbr("ptbr_text").cast("double").alias("amount"))


@query
def parse_date_multi(spark, sf):
    df = view(spark, sf, "v_text")
    return df.select("quote_id", parse_date("date_text").alias("parsed"))


@query
def normalize_key_values(spark, sf):
    df = view(spark, sf, "v_text")
    return df.select("quote_id", normalize_key("key_text").alias("join_key"))


@query
def infer_numeric(spark, sf):
    df = view(spark, sf, "v_text").select("quote_id", "whole_text", "real_text", "key_text")
    return columns.infer_numeric(df)


@query
def cast_double_values(spark, sf):
    df = view(spark, sf, "v_text").select("quote_id", "real_text", "us_text")
    return columns.cast_double(df, ["real_text", "us_text"])


@query
def upper_values(spark, sf):
    df = columns.upper_names(view(spark, sf, "v_quotes").select("quote_id", "status"))
    return columns.upper_values(df, ["STATUS"])


@query
def drop_empty_cols(spark, sf):
    df = view(spark, sf, "v_text").select("quote_id", "whole_text", "empty_text", "empty_number")
    return columns.drop_empty_columns(df)


@query
def pinned_schema_rejects(spark, sf):
    df = view(spark, sf, "v_text").select("key_text", "us_text", "whole_text")
    types = {"key_text": "bigint", "us_text": "double", "whole_text": "bigint"}
    return columns.count_rejects(df, types)


# --- business rules ---------------------------------------------------------------------


@query
def rule_make_date(spark, sf):
    return catalog.quote_date(view(spark, sf, "v_bronze")).select("SEQ", "DATA_COTACAO")


@query
def rule_channel(spark, sf):
    df = view(spark, sf, "v_bronze")
    return catalog.channel(df, "FL_ANALISE_SUBSCRICAO", "CD_NUMERO_COTACAO").select("SEQ", "CANAL")


@query
def rule_sentinel_date(spark, sf):
    df = view(spark, sf, "v_bronze")
    return catalog.sentinel_date(df, "DT_INICIO_VIGENCIA").select("SEQ", "DT_INICIO_VIGENCIA")


@query
def rule_money(spark, sf):
    df = columns.cast_money(view(spark, sf, "v_bronze"), fv.QUOTE_MONEY, 2)
    return df.select("SEQ", F.col("VL_PREMIO_ALVO").cast("double").alias("VL_PREMIO_ALVO"))


@query
def rule_default_value(spark, sf):
    df = view(spark, sf, "v_bronze")
    return catalog.default_value(df, "DS_TIPO_COTACAO", fv.NEW_QUOTE, [fv.SIMILAR_RENEWAL]).select(
        "SEQ", "DS_TIPO_COTACAO"
    )


@query
def rule_refused_filter(spark, sf):
    df = view(spark, sf, "v_bronze")
    return catalog.refused_filter(df, "CD_NUMERO_COTACAO", "DS_STATUS", "FL_SALVO").select("SEQ")


@query
def rule_canonical_status(spark, sf):
    return catalog.canonical_status(view(spark, sf, "v_bronze")).select("SEQ", "DS_GRUPO_STATUS")


@query
def rule_final_status(spark, sf):
    df = catalog.final_status(catalog.canonical_status(view(spark, sf, "v_bronze")))
    return df.select("SEQ", "DS_GRUPO_STATUS")


@query
def rule_label(spark, sf):
    df = catalog.label(catalog.canonical_status(view(spark, sf, "v_bronze")))
    return df.select("SEQ", "label")


@query
def rule_month(spark, sf):
    return catalog.month(catalog.quote_date(view(spark, sf, "v_bronze"))).select("SEQ", "MES")


@query
def rule_exclude_months(spark, sf):
    df = catalog.quote_date(view(spark, sf, "v_bronze"))
    return catalog.exclude_months(df, months=["2023-11", "2023-12"]).select("SEQ", "DATA_COTACAO")


@query
def rule_commercial_channel(spark, sf):
    df = view(spark, sf, "v_quotes").withColumnRenamed("channel", "DS_CANAL_COMERCIAL")
    return catalog.commercial_channel(df).select("quote_id", "DS_CANAL_COMERCIAL")


@query
def rule_segment(spark, sf):
    df = view(spark, sf, "v_quotes")
    return catalog.segment(df, "channel", "quote_type", "segment").select("quote_id", "segment")


@query
def eval_label(spark, sf):
    df = view(spark, sf, "v_quotes")
    return df.select("quote_id", evaluation.eval_label("status").alias("label_real"))


@query
def dedupe_most_filled(spark, sf):
    df = view(spark, sf, "v_broker")
    return joins.dedupe_most_filled(df, "dup_key", "row_id", scored=["market", "name", "gwp"])


# --- temporal rule ------------------------------------------------------------------------


@query
def latest_snapshot(spark, sf):
    return temporal.latest_snapshot(
        view(spark, sf, "v_snapshots"),
        "quote_id",
        "ts_arq",
        "event_id",
        ["quote_id", "event_id", "premium", "status"],
    )


def aged_snapshots(spark, sf) -> DataFrame:
    history = view(spark, sf, "v_snapshots")
    latest = temporal.latest_with_entries(
        history,
        "quote_id",
        "ts_arq",
        "event_id",
        "status",
        ENTRIES,
        ["quote_id", "ts_arq", "status", "day"],
    )
    return temporal.days_since_update(latest, history, "ts_arq", "days_idle")


@query
def days_since_update(spark, sf):
    return aged_snapshots(spark, sf).select("quote_id", "days_idle")


def closed_snapshots(df: DataFrame) -> DataFrame:
    return temporal.stale_to_lost(
        df, "status", "days_idle", fv.OPEN_STATUSES, STALE_DAYS, fv.LOST, "status_old", "was_stale"
    )


@query
def stale_to_lost(spark, sf):
    return closed_snapshots(aged_snapshots(spark, sf)).select(
        "quote_id", "status", "status_old", "was_stale"
    )


@query
def first_status_entry(spark, sf):
    df = temporal.first_status_entry(
        view(spark, sf, "v_snapshots"), "quote_id", "ts_arq", "status", ENTRIES
    )
    return df.select(
        "quote_id", *[F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c) for c in ENTRIES]
    )


def referenced_snapshots(df: DataFrame) -> DataFrame:
    date = temporal.reference_date(
        "status", "was_stale", "ts_arq", "issued_at", "lost_at", fv.ISSUED, fv.LOST
    )
    return closed_snapshots(df).withColumn("ref_date", date)


@query
def reference_date(spark, sf):
    return referenced_snapshots(aged_snapshots(spark, sf)).select("quote_id", "ref_date")


@query
def days_to_reference(spark, sf):
    df = referenced_snapshots(aged_snapshots(spark, sf))
    df = temporal.days_to_reference(
        df.withColumn("snapshot_day", F.col("day")), {"day": "days_snapshot"}, "ref_date"
    )
    return temporal.days_between(df, "snapshot_day", "ref_date", "days_age").select(
        "quote_id", "days_snapshot", "days_age"
    )


@query
def temporal_incremental(spark, sf):
    """The last day arrives as a new load; its quotes are recomputed over their history."""
    history = view(spark, sf, "v_snapshots")
    last_day = history.agg(F.max("day").alias("d")).scalar()
    batch = history.filter(F.col("day") == last_day)
    before = history.filter(F.col("day") < last_day)

    def newest(df: DataFrame) -> DataFrame:
        carried = ["quote_id", "event_id", "status"]
        return temporal.latest_with_entries(
            df, "quote_id", "ts_arq", "event_id", "status", ENTRIES, carried
        )

    published = newest(before)
    again = newest(temporal.touched_history(history, batch, "quote_id"))
    out = temporal.publish_latest(published, again, batch, "quote_id")
    return out.select(
        "quote_id", "event_id", "status", *[F.col(c).cast("date").alias(c) for c in ENTRIES]
    )


def daily_runs(spark, sf, dies: bool) -> DataFrame:
    """Snapshots arrive as daily deliveries for two runs.

    If the second ``dies`` when it has loaded and not yet published, a third run, without any new
    delivery, must give what the second would have given.
    """
    folder, path = scratch_path(spark, "daily"), scratch_path(spark, "published")
    bronze = f"daily_{uuid.uuid4().hex}"
    name = F.concat(F.lit("COTACAO_GENERICO_"), F.date_format("day", "yyyyMMdd"), F.lit(".csv"))
    history = view(spark, sf, "v_snapshots").select("quote_id", "event_id", "status", "ts_arq", "day")
    text = history.withColumn("ts_arq", F.date_format("ts_arq", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    middle = history.agg(F.date_from_unix_date(F.avg(F.unix_date("day")).cast("int")).alias("d")).scalar()

    def typed(df: DataFrame) -> DataFrame:
        # TS_ARQ of the load is the day of the delivery; the snapshot has its own time
        return df.select(
            F.col("quote_id").cast("bigint").alias("quote_id"),
            F.col("event_id").cast("bigint").alias("event_id"),
            F.coalesce("status", F.lit("")).alias("status"),  # an empty field is read as NULL
            F.to_timestamp("seen_at").alias("ts_arq"),
        )

    def run() -> DataFrame:
        return flows.incremental_clean(
            spark, folder, bronze, path, typed, "quote_id", "ts_arq", "event_id", "status",
            ["quote_id", "event_id", "status", "ts_arq"], STALE_DAYS,
        )

    out = None
    for number, part in enumerate((F.col("day") <= middle, F.col("day") > middle)):
        rows = text.filter(part).select("quote_id", "event_id", "status", F.col("ts_arq").alias("seen_at"), "day")
        files.write_delivery(rows, f"{folder}/{uuid.uuid4().hex}", name)
        if number and dies:
            flows.load_deliveries(spark, folder, bronze)
        out = run()
    spark.sql(f"DROP TABLE {bronze}")
    return out.select("quote_id", "event_id", "status", "was_stale", "days_idle", "ref_date")


@query
def incremental_clean(spark, sf):
    """Snapshots arrive as daily deliveries in two runs; the second recomputes what it touches."""
    return daily_runs(spark, sf, dies=False)


@query
def incremental_restart(spark, sf):
    """As ``incremental_clean``, but the second run dies between load and publish."""
    return daily_runs(spark, sf, dies=True)


@query
def clean_quotes(spark, sf):
    """All cleaning rules of the quote table on raw snapshots."""
    out, _ = flows.clean_quotes(view(spark, sf, "v_bronze"), tie="SEQ")
    return out.select(
        "CD_NUMERO_COTACAO",
        "SEQ",
        "CANAL",
        "DS_TIPO_COTACAO",
        "DS_GRUPO_STATUS",
        "label",
        "MES",
        "DIAS_ULTIMA_ATUALIZACAO",
        "DIAS_VALIDADE",
        "DIAS_COTACAO",
        "DIAS_INICIO_VIGENCIA",
        F.col("VL_PREMIO_ALVO").cast("double").alias("VL_PREMIO_ALVO"),
    )


@query
def clean_summary(spark, sf):
    """All rules of the broker summary: money as decimal, technical and extra columns gone."""
    out, _ = flows.clean_summary(view(spark, sf, "v_summary"))
    return out.select(*[F.col(c).cast("double").alias(c) if c == "VL_GWP_CORRETOR" else c for c in out.columns])


@query
def clean_detail(spark, sf):
    """All rules of the broker detail: request type default, rates as decimal."""
    typed = view(spark, sf, "v_detail").withColumn("SOURCE_FILE", F.lit("x"))
    out, _ = flows.clean_detail(typed.withColumn("HR_2025", F.col("HR_2025").cast("string")))
    return out.select(*[F.col(c).cast("double").alias(c) if c == "HR_2025" else c for c in out.columns])


@query
def segment_rows(spark, sf):
    """The rows of one segment."""
    rows = view(spark, sf, "v_quotes").select("quote_id", F.col("quote_type").alias("SEG"))
    return flows.in_segment(rows, "Renovacao").select("quote_id")


# --- joins ------------------------------------------------------------------------------


@query
def join_retention_1key(spark, sf):
    quotes = view(spark, sf, "v_quotes").select("quote_id", "broker_id", "premium")
    brokers = view(spark, sf, "v_broker").select("broker_id", "gwp", "market")
    return joins.join_retention(
        quotes, brokers, ["broker_id"], ["broker_id"], "_resumo", [F.col("gwp")]
    )


def detailed_quotes(spark, sf) -> DataFrame:
    """Quotes with a three-part key, taken from their own line items where present."""
    quotes = view(spark, sf, "v_quotes")
    product = F.element_at(F.array(F.lit("A"), F.lit("N"), F.lit("R")), (F.col("quote_id") % 3 + 1).cast("int"))
    kind = F.when(F.col("quote_id") % 7 == 0, None).when(F.col("quote_id") % 2 == 0, "O").otherwise("F")
    return quotes.select(
        "quote_id", "broker_id", product.alias("product"), kind.alias("kind"), "status"
    )


@query
def join_retention_3key(spark, sf):
    detail = view(spark, sf, "v_broker_detail")
    out = joins.join_retention(
        detailed_quotes(spark, sf),
        detail,
        ["broker_id", "product", "kind"],
        ["broker_id", "product", "req_type"],
        "_detalhe",
        [F.col("n_quotes")],
    )
    return rounded(out.drop("status"), "hit_rate_detalhe")


@query
def join_audit(spark, sf):
    """Rows before the join, after it, and with a segment; counted in one pass."""
    brokers = view(spark, sf, "v_broker").select("broker_id", "gwp")
    quotes, n_quotes = counted(view(spark, sf, "v_quotes"))
    joined, n_joined = counted(
        joins.join_retention(
            quotes, brokers, ["broker_id"], ["broker_id"], "_resumo", [F.col("gwp")]
        )
    )
    segmented = catalog.segment(joined, "channel", "quote_type", "segment")
    known, n_known = counted(segmented.filter(F.col("segment").isNotNull()))
    consume(known)
    rows = [
        ("quotes", n_quotes.get["rows"]),
        ("joined", n_joined.get["rows"]),
        ("with_segment", n_known.get["rows"]),
    ]
    return spark.createDataFrame(rows, "step string, n_rows bigint")


@query
def segment_status_share(spark, sf):
    """Flagship: raw snapshots, cleaning rules, both joins, segments, status share."""
    quotes, _ = flows.clean_quotes(view(spark, sf, "v_bronze"), purpose="score", tie="SEQ")
    summary, _ = flows.clean_summary(view(spark, sf, "v_summary"), purpose="score")
    detail, _ = flows.clean_detail(view(spark, sf, "v_detail"), purpose="score")
    segmented, _ = flows.join_and_segment(quotes, summary, detail)
    return profile.status_share(segmented, "SEG", "DS_GRUPO_STATUS")


# --- profiles -----------------------------------------------------------------------------


@query
def status_share(spark, sf):
    df = catalog.segment(view(spark, sf, "v_quotes"), "channel", "quote_type", "segment")
    return profile.status_share(df, "segment", "status")


@query
def load_profile(spark, sf):
    return profile.load_profile(view(spark, sf, "v_snapshots"), "ts_arq")


@query
def rows_by_day(spark, sf):
    return profile.rows_by_day(view(spark, sf, "v_snapshots"), "ts_arq")


@query
def rows_by_day_new(spark, sf):
    loads = view(spark, sf, "v_snapshots").withColumn("batch_id", F.day("day").cast("bigint"))
    return profile.rows_by_day(tables.new_row_flag(loads).filter("FL_NOVO"), "ts_arq")


@query
def rows_by_quote_date(spark, sf):
    return profile.rows_by_quote_date(view(spark, sf, "v_quotes"), "quote_date")


@query
def profile_nulls(spark, sf):
    return profile.profile_nulls(view(spark, sf, "v_quotes"), ["quote_id", "broker_id"])


@query
def segment_counts(spark, sf):
    df = catalog.segment(view(spark, sf, "v_quotes"), "channel", "quote_type", "segment")
    return profile.segment_counts(df, "segment")


@query
def label_rate(spark, sf):
    df = view(spark, sf, "v_scored")
    return rounded(profile.label_rate(df, "cluster", "label"), "label_rate")


@query
def status_month_pivot(spark, sf):
    values = ["EMITIDA", "PERDIDA", "EM ANALISE"]
    return profile.status_month_pivot(view(spark, sf, "v_quotes"), "quote_date", "status", values)


@query
def score_profile(spark, sf):
    return rounded(profile.score_profile(view(spark, sf, "v_scored"), "score_b"), "mean_score")


@query
def null_share(spark, sf):
    return profile.null_share(view(spark, sf, "v_features"), ["priority", "rare", "days"])


@query
def cardinality(spark, sf):
    df = view(spark, sf, "v_quotes")
    return profile.cardinality(df, ["broker_id", "status", "channel", "quote_type"])


@query
def entity_profile(spark, sf):
    detail = view(spark, sf, "v_broker_detail")
    out = profile.entity_profile(detail, "broker_id", "hit_rate", "n_quotes", "product")
    return rounded(out, "rate_mean", "volume_mean")


@query
def distinct_topk(spark, sf):
    return profile.distinct_topk(view(spark, sf, "v_broker_detail"), "product", "broker_id", 20)


@query
def feature_percentiles(spark, sf):
    df = view(spark, sf, "v_features")
    out = profile.feature_percentiles(df, ["premium", "age", "days"], [0.1, 0.25, 0.5, 0.75, 0.9])
    return rounded(out, "p10", "p25", "p50", "p75", "p90")


@query
def feature_histogram(spark, sf):
    df = view(spark, sf, "v_features")
    out = profile.feature_histogram(df, ["age", "days"])
    return rounded(out, "bin_start", "mean", "median")


# --- rule framework -------------------------------------------------------------------------


def quote_checks() -> list[Rule]:
    return [
        Rule("R01", "segment", lambda d: catalog.segment(d, "channel", "quote_type", "segment")),
        Rule("R02", "canonical status", lambda d: catalog.canonical_status(d, "status"), requires=("status",)),
        Rule("R03", "final statuses", lambda d: catalog.final_status(d, "status"), requires=("status",)),
        Rule("R04", "label", lambda d: catalog.label(d, "status"), requires=("status",)),
        Rule("R05", "switched off", lambda d: d.limit(0), enabled=False),
        Rule("R06", "needs another table", lambda d: d, requires=("no_such_column",)),
        Rule("R07", "switched off for this run", lambda d: d.drop("label")),
        Rule("R08", "known segments", lambda d: d.filter(F.col("segment").isNotNull())),
        Rule("R09", "drop inputs", lambda d: d.drop("channel", "quote_type")),
    ]


OFF = {"quotes": {"R07": False}}


@query
def rules_apply(spark, sf):
    out, _ = apply_rules(view(spark, sf, "v_quotes"), quote_checks(), "quotes", OFF)
    return out


@query
def rules_log(spark, sf):
    df, log = apply_rules(
        view(spark, sf, "v_quotes"), quote_checks(), "quotes", OFF, count_rows=True
    )
    consume(df)
    return log_frame(spark, log)


@query
def rule_row_counts(spark, sf):
    df, log = flows.clean_quotes(view(spark, sf, "v_bronze"), tie="SEQ", count_rows=True)
    consume(df)
    return log_frame(spark, log).filter("status = 'APPLIED'").select("rule_id", "rows_after")


@query
def step_profile(spark, sf):
    bronze, n_in = counted(view(spark, sf, "v_bronze"))
    silver, _ = flows.clean_quotes(bronze, tie="SEQ")
    silver, n_out = counted(silver)
    consume(silver)
    rows = [
        ("clean", "in", n_in.get["rows"], len(bronze.columns)),
        ("clean", "out", n_out.get["rows"], len(silver.columns)),
    ]
    return spark.createDataFrame(rows, "step string, side string, n_rows bigint, n_columns int")


# --- features -------------------------------------------------------------------------------


@query
def hash_split(spark, sf):
    df = view(spark, sf, "v_quotes")
    return features.hash_split(df, ["quote_id", "status"], fn="md5").select("quote_id", "is_valid")


@query
def hash_split_xx(spark, sf):
    """The fast hash has no SQL twin: every row is on one side, and a fifth is for validation."""
    df = features.hash_split(view(spark, sf, "v_quotes"), ["quote_id", "status"])
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("is_valid").alias("n_placed"),
        (F.abs(F.avg(F.col("is_valid").cast("int")) - 0.2) < 0.05).alias("near_share"),
    )


@query
def kfold(spark, sf):
    df = view(spark, sf, "v_quotes")
    return features.kfold(df, "quote_id", 5, 42, fn="md5").select("quote_id", "fold")


@query
def stratified_sample(spark, sf):
    """Sample and rest are disjoint and complete in each stratum, and the share is met."""
    df = view(spark, sf, "v_scored")
    sample = materialize(features.stratified_sample(df, "label", {0: 0.7, 1: 0.7}, 42), "sample")
    rest = features.sample_complement(df, sample, "quote_id")
    both = sample.select("quote_id", "label", F.lit(1).alias("part")).unionByName(
        rest.select("quote_id", "label", F.lit(0).alias("part"))
    )
    return both.groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.col("quote_id")).alias("n_quotes"),
        (F.abs(F.avg("part") - 0.7) < 0.1).alias("near_share"),
    )


@query
def sample_complement(spark, sf):
    df = view(spark, sf, "v_scored")
    split = features.hash_split(df, ["quote_id"], fn="md5")
    return features.sample_complement(df, split.filter("is_valid"), "quote_id").select("quote_id", "label")


@query
def top_values(spark, sf):
    return features.top_values(view(spark, sf, "v_quotes"), "broker_id", 10)


@query
def truncate_cardinality(spark, sf):
    df = view(spark, sf, "v_quotes").select("quote_id", "broker_id")
    return features.truncate_high_cardinality(df, "broker_id", 10)


def split_features(spark, sf) -> tuple[DataFrame, DataFrame]:
    df = features.hash_split(view(spark, sf, "v_features"), ["quote_id"], fn="md5")
    return df.filter(~F.col("is_valid")).drop("is_valid"), df.filter("is_valid").drop("is_valid")


@query
def truncate_fit_apply(spark, sf):
    model, valid = split_features(spark, sf)
    lists = features.truncate_fit(model, ["office", "priority"])
    return features.truncate_apply(valid, lists).select("quote_id", "office", "priority")


@query
def drop_null_features(spark, sf):
    model, valid = split_features(spark, sf)
    heavy = features.null_heavy(model, ["priority", "rare", "premium", "days"])
    return valid.drop(*heavy).select("quote_id", *[c for c in ("rare", "days") if c not in heavy])


@query
def drop_constant_features(spark, sf):
    model, valid = split_features(spark, sf)
    constant = features.constant_columns(model, ["priority", "office", "currency"])
    names = ("priority", "currency")
    return valid.select("quote_id", *[c for c in names if c not in constant])


@query
def fit_features(spark, sf):
    """Drops and lists learned on model rows, applied to validation rows."""
    model, valid = split_features(spark, sf)
    names = ["priority", "office", "currency", "rare", "premium", "age", "days"]
    plan = features.fit_features(model, dict.fromkeys(names, True))
    return plan.apply(valid)


@query
def class_weights(spark, sf):
    df = view(spark, sf, "v_quotes").select(
        "quote_id", evaluation.eval_label("status").alias("label")
    )
    return rounded(features.class_weights(df, "label", mode=True), "weight")


CATEGORICAL = ["priority", "office"]
NUMERIC = ["premium", "age", "days"]


@query
def feature_vectors(spark, sf):
    """Sums over the vectors: slots per row, set one-hot slots, and the imputed numbers."""
    df = view(spark, sf, "v_features")
    fitted = features.preprocess_stages(CATEGORICAL, NUMERIC).fit(df)
    from pyspark.ml.functions import vector_to_array

    slots = fitted.transform(df).select(vector_to_array("features_vec").alias("v"))
    hot = F.aggregate(F.slice("v", 1, F.size("v") - len(NUMERIC)), F.lit(0.0), lambda s, x: s + x)
    number = [F.element_at("v", i - len(NUMERIC)) for i in range(len(NUMERIC))]
    out = slots.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(F.size("v")).alias("n_widths"),
        F.sum(hot).cast("bigint").alias("n_hot"),
        *[F.avg(n).alias(f"{c}_mean") for c, n in zip(NUMERIC, number)],
    )
    return rounded(out, *[f"{c}_mean" for c in NUMERIC])


# --- clustering -----------------------------------------------------------------------------

ENTITY_COLS = ["rate_mean", "volume_mean", "n_products"]


@query
def cluster_nulls(spark, sf):
    df = view(spark, sf, "v_features").select("quote_id", "days", "age")
    return rounded(cluster.cluster_nulls(df, ["days"], "impute_median"), "days")


@query
def cluster_nulls_drop(spark, sf):
    df = view(spark, sf, "v_features").select("quote_id", "days", "age")
    return cluster.cluster_nulls(df, ["days"], "drop")


def entities(spark, sf) -> DataFrame:
    """Broker profile, computed once: fitting and applying both read it."""
    return materialize(view(spark, sf, "v_entities"), "entities")


def scaled(spark, sf, strategy: str) -> DataFrame:
    df = entities(spark, sf)
    return rounded(cluster.scale(df, ENTITY_COLS, strategy), *ENTITY_COLS)


@query
def scale_standard(spark, sf):
    return scaled(spark, sf, "standard")


@query
def scale_log1p(spark, sf):
    return scaled(spark, sf, "log1p_standard")


@query
def scale_robust(spark, sf):
    return scaled(spark, sf, "robust")


@query
def kmeans_sweep(spark, sf):
    """All fits of the sweep on brokers in three groups: the exact inertia where K is 3."""
    out = cluster.kmeans_sweep(view(spark, sf, "v_grouped_entities"), ENTITY_COLS)
    best = W.partitionBy("scaling").orderBy(F.col("silhouette").desc())
    # a restart may end in a local optimum, so that neighbours need not fall; the groups are far apart
    at_three = F.max(F.when(F.col("k") == 3, F.col("inertia"))).over(W.partitionBy("scaling"))
    split = F.when(F.col("k") < 3, F.col("inertia") > at_three).when(F.col("k") > 3, F.col("inertia") < at_three)
    out = out.select(
        "scaling",
        "k",
        F.when(F.col("k") == 3, F.col("inertia")).alias("inertia"),
        (F.row_number().over(best) == 1).alias("is_best"),
        F.coalesce(split, F.lit(True)).alias("splits"),
    )
    return rounded(out, "inertia")


@query
def kmeans_fit(spark, sf):
    """The groups that the fit finds, each named by its smallest broker, and the inertia."""
    df = view(spark, sf, "v_grouped_entities")
    fit = cluster.kmeans_fit(df, ENTITY_COLS, 3, "log1p_standard")
    first = F.min("broker_id").over(W.partitionBy("cluster")).alias("first_broker")
    return rounded(fit.assigned.select("broker_id", first, F.lit(fit.inertia).alias("inertia")), "inertia")


def fixed_clusters(spark, sf) -> DataFrame:
    return entities(spark, sf).withColumn(
        "cluster", (F.col("broker_id") % 3).cast("string")
    )


def cluster_facts(spark, sf) -> DataFrame:
    df = fixed_clusters(spark, sf)
    scaler = cluster.fit_scaler(df, ENTITY_COLS, "log1p_standard")
    return cluster.cluster_summary(df, ENTITY_COLS, "cluster", scaler)


@query
def cluster_summary(spark, sf):
    out = cluster_facts(spark, sf)
    return rounded(out, *[c for c in out.columns if c.endswith(("_centroid", "_median"))])


@query
def cluster_coverage(spark, sf):
    quotes = view(spark, sf, "v_quotes").select(
        "quote_id", normalize_key("broker_id").cast("bigint").alias("broker_id")
    )
    out = cluster.attach_cluster(quotes, fixed_clusters(spark, sf), "broker_id", "clf")
    return cluster.cluster_coverage(out, "clf")


@query
def cluster_profile(spark, sf):
    out = evaluation.cluster_profile(
        view(spark, sf, "v_scored"),
        "label",
        "cluster",
        cluster_facts(spark, sf).select("cluster", "n_entities", "rate_mean_centroid"),
    )
    return rounded(out, "base_rate", "rate_mean_centroid")


# --- feature selection ------------------------------------------------------------------------


@query
def empty_features(spark, sf):
    """Numeric features without any value in the rows of a fit."""
    df = view(spark, sf, "v_features").filter(F.col("rare").isNull())
    empty = features.all_null_columns(df, ["rare", *NUMERIC])
    return spark.createDataFrame([(c,) for c in empty], "feature string")


@query
def label_audit(spark, sf):
    df = catalog.label(catalog.canonical_status(view(spark, sf, "v_quotes"), "status"), "status")
    return selection.label_audit(df, "label")


#: By so much the area under the precision-recall curve of a model must exceed the base rate.
LEARNED_MARGIN = 0.3


def base_rate_of(df: DataFrame) -> float:
    return df.agg(F.avg("label").alias("r")).first()["r"]


@query
def fs_methods(spark, sf):
    """All fits of the selection; the feature that the label follows must come out first."""
    df = view(spark, sf, "v_learnable")
    importances, quality = selection.fs_methods(df, "quote_id", "label", CATEGORICAL, NUMERIC)
    scores = selection.rank_score(importances, CATEGORICAL + NUMERIC, ["method", "seed"])
    ranked = selection.ensemble_rank(scores, quality)
    least = base_rate_of(df) + LEARNED_MARGIN
    good = quality.agg(F.count_if((F.col("auc_pr") > least) & (F.col("ap") > least))).scalar()
    # coefficients depend on the unit of a feature, the importances of trees do not
    firsts = scores.filter("method <> 'lr_l1' and feature = 'age' and score = 1").agg(F.count(F.lit(1))).scalar()
    return ranked.agg(
        F.count(F.lit(1)).alias("n_features"),
        F.count_distinct(F.col("rank_final")).alias("n_ranks"),
        F.max("rank_final").cast("bigint").alias("last_rank"),
        F.count_if(F.col("score_final").between(0, 1)).alias("n_scored"),
        F.min_by("feature", "rank_final").alias("first_feature"),
        good.alias("n_good_fits"),
        firsts.alias("n_firsts"),
    )


def fixed_importances(spark, sf) -> DataFrame:
    """Importances measured on the parts table, several slots per feature."""
    part = base_table(spark, sf, "part")
    return part.select(
        F.when(F.col("p_partkey") % 2 == 0, "m1").otherwise("m2").alias("method"),
        (F.col("p_partkey") % 3).cast("int").alias("seed"),
        F.col("p_brand").alias("feature"),
        F.col("p_size").cast("double").alias("importance"),
    )


def brands(spark, sf) -> list[str]:
    rows = base_table(spark, sf, "part").select("p_brand").distinct().collect()
    return sorted(r["p_brand"] for r in rows) + ["unused"]


@query
def rank_score(spark, sf):
    out = selection.rank_score(fixed_importances(spark, sf), brands(spark, sf), ["method", "seed"])
    return rounded(out, "importance", "score")


@query
def ensemble_rank(spark, sf):
    found = fixed_importances(spark, sf)
    scores = selection.rank_score(found, brands(spark, sf), ["method", "seed"])
    quality = found.groupBy("method", "seed").agg((F.avg("importance") / 100).alias("auc_pr"))
    return rounded(selection.ensemble_rank(scores, quality), "score_final")


@query
def mutual_information(spark, sf):
    df = view(spark, sf, "v_features")
    out = selection.mutual_information(df, "label", ["priority", "office"], ["premium", "days"])
    return rounded(out, "mi")


@query
def pearson_long(spark, sf):
    df = view(spark, sf, "v_features")
    return rounded(selection.pearson_long(df, ["premium", "age", "days"]), "correlation")


# --- training and scoring -----------------------------------------------------------------------


def weighted(spark, sf) -> DataFrame:
    return features.class_weights(view(spark, sf, "v_learnable"), "label")


@query
def cv_grid(spark, sf):
    df = weighted(spark, sf)
    out = training.cv_grid(df, "quote_id", "label", CATEGORICAL, NUMERIC)
    learned = F.col("auc_pr_mean").between(base_rate_of(df) + LEARNED_MARGIN, 1)
    return out.select(
        "model_id", "max_depth", "step_size", learned.alias("learned"), (F.col("auc_pr_std") < 0.05).alias("steady")
    )


_fitted: dict[tuple[str, str], tuple[training.ScoringSet, DataFrame]] = {}


def trained(spark, sf) -> tuple[training.ScoringSet, DataFrame]:
    """Fitted once per application and folder; three queries look at the same models."""
    place = (spark.sparkContext.applicationId, sf)
    if place not in _fitted:
        _fitted[place] = training.train_final(weighted(spark, sf), "label", CATEGORICAL, NUMERIC)
    return _fitted[place]


@query
def train_final(spark, sf):
    least = base_rate_of(weighted(spark, sf)) + LEARNED_MARGIN
    learned = F.col("ap").between(least, 1) & F.col("auc_pr").between(least, 1)
    return trained(spark, sf)[1].select("model_id", "n_scored", "n_pos", learned.alias("learned"))


@query
def model_roundtrip(spark, sf):
    """Saved and reloaded models give the same scores."""
    fitted, _ = trained(spark, sf)
    path = scratch_path(spark, "models")
    training.save_models(fitted, path)
    loaded = training.load_models(path)
    df = view(spark, sf, "v_learnable")
    before = training.score_models(df, fitted, "quote_id")
    after = training.score_models(df, loaded, "quote_id")
    named = after.withColumnsRenamed({c: f"{c}_loaded" for c in after.columns if c != "quote_id"})
    scores = [c for c in before.columns if c != "quote_id"]
    furthest = F.greatest(*[F.abs(F.col(c) - F.col(f"{c}_loaded")) for c in scores])
    return before.join(named, "quote_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max(furthest).alias("max_difference")
    )


@query
def score_wide(spark, sf):
    """Wide scores of all models; each must rank issued quotes well above the base rate."""
    fitted, _ = trained(spark, sf)
    df = view(spark, sf, "v_learnable")
    wide = training.score_wide(df, fitted, "quote_id", {"mode_code": "D", "inf_versao": "1"})
    long = materialize(long_scores(wide, "quote_id", "label"), "wide-scores")
    areas = evaluation.average_precision(long, "label", "score", ["model_id"])
    learned = F.col("ap").between(base_rate_of(df) + LEARNED_MARGIN, 1)
    by_rank = long.groupBy("model_id").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("score").between(0, 1)).alias("n_scored"),
        F.count_distinct(F.col("score_rank")).alias("n_ranks"),
        F.max("score_rank").cast("bigint").alias("last_rank"),
    )
    return by_rank.join(areas.select("model_id", learned.alias("learned")), "model_id")


def wide_scores(spark, sf) -> DataFrame:
    """Fixed scores of two models in the wide column layout."""
    return view(spark, sf, "v_scored").withColumnsRenamed(
        {f"score_{m}": f"{fv.SCORE_PREFIX}{m}" for m in MODELS}
    )


def ranked_scores(spark, sf) -> DataFrame:
    wide = wide_scores(spark, sf)
    scores = wide.select("quote_id", *[f"{fv.SCORE_PREFIX}{m}" for m in MODELS])
    ranks = training.rank_models(scores, "quote_id")
    return wide.drop(*[c for c in scores.columns if c != "quote_id"]).join(ranks, "quote_id")


@query
def scores_wide(spark, sf):
    wide = view(spark, sf, "v_scored").select("quote_id", "label", "cluster")
    scores = wide_scores(spark, sf).select("quote_id", *[f"{fv.SCORE_PREFIX}{m}" for m in MODELS])
    ranks = training.rank_models(scores, "quote_id")
    return training.attach_scores(wide, ranks, "quote_id", {"mode_code": "D", "inf_versao": "1"})


def long_scores(df: DataFrame, *keep: str) -> DataFrame:
    return columns.unpivot_scores(df, keep, fv.SCORE_PREFIX, fv.RANK_PREFIX)


@query
def scores_long(spark, sf):
    return long_scores(ranked_scores(spark, sf), "quote_id", "label")


# --- ranks and evaluation -----------------------------------------------------------------------


@query
def global_rank(spark, sf):
    df = view(spark, sf, "v_scored").select("quote_id", "score_a")
    return ordering.global_rank(df, "score_a", "quote_id", "score_rank")


@query
def local_rank(spark, sf):
    df = view(spark, sf, "v_scored").select("quote_id", "cluster", "score_a")
    return ordering.local_rank(df, "score_a", "quote_id", ["cluster"], "score_rank")


@query
def top_ranked(spark, sf):
    df = view(spark, sf, "v_scored").select("quote_id", "score_a")
    return ordering.top_ranked(ordering.global_rank(df, "score_a", "quote_id", "score_rank"), "score_rank", 10)


def scored_long(spark, sf) -> DataFrame:
    return long_scores(wide_scores(spark, sf), "quote_id", "label", "cluster").drop("score_rank")


@query
def base_rate(spark, sf):
    return rounded(evaluation.base_rate(view(spark, sf, "v_scored"), "label"), "base_rate")


@query
def threshold_sweep(spark, sf):
    return evaluation.threshold_sweep(scored_long(spark, sf), "label", "score", ["model_id"])


@query
def select_threshold(spark, sf):
    curve = evaluation.threshold_sweep(scored_long(spark, sf), "label", "score", ["model_id"])
    return evaluation.select_threshold(curve, "max_f2", by=["model_id"])


@query
def select_threshold_precision(spark, sf):
    curve = evaluation.threshold_sweep(scored_long(spark, sf), "label", "score", ["model_id"])
    return evaluation.select_threshold(curve, "precision_ge_target", 0.4, by=["model_id"])


@query
def eval_summary(spark, sf):
    return evaluation.eval_summary(scored_long(spark, sf), "label", "score", ["model_id"])


@query
def average_precision(spark, sf):
    out = evaluation.average_precision(scored_long(spark, sf), "label", "score", ["model_id"])
    return rounded(out.select("model_id", "ap"), "ap")


@query
def auc_pr(spark, sf):
    out = evaluation.average_precision(scored_long(spark, sf), "label", "score", ["model_id"])
    return rounded(out.select("model_id", "auc_pr"), "auc_pr")


@query
def average_precision_rows(spark, sf):
    out = evaluation.average_precision_rows(
        scored_long(spark, sf), "label", "score", "quote_id", ["model_id"]
    )
    return rounded(out, "ap")


@query
def pr_curve(spark, sf):
    return evaluation.pr_curve(scored_long(spark, sf), "label", "score", ["model_id"])


@query
def pr_curve_at_threshold(spark, sf):
    curve = evaluation.pr_curve(view(spark, sf, "v_scored"), "label", "score_b")
    return evaluation.point_at_threshold(curve, 0.42)


def population(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1)).alias("n")).scalar()


@query
def topk_curves(spark, sf):
    scored = view(spark, sf, "v_scored")
    long = long_scores(ranked_scores(spark, sf), "quote_id", "label")
    return evaluation.topk_curves(long, "label", "score_rank", total=population(scored))


@query
def topk_by_cluster(spark, sf):
    return evaluation.topk_by_group(
        scored_long(spark, sf), "label", "score", "quote_id", ["cluster", "model_id"]
    )


@query
def overlap_at_k(spark, sf):
    ranks = [f"{fv.RANK_PREFIX}{m}" for m in MODELS]
    total = population(view(spark, sf, "v_scored"))
    return evaluation.overlap_at_k(ranked_scores(spark, sf), ranks, total)


@query
def rank_correlation(spark, sf):
    ranks = [f"{fv.RANK_PREFIX}{m}" for m in MODELS]
    return rounded(evaluation.rank_correlation(ranked_scores(spark, sf), ranks), "rho")


@query
def score_histogram(spark, sf):
    return evaluation.score_histogram(scored_long(spark, sf), "score", ["model_id", "label"])


@query
def score_stats(spark, sf):
    out = evaluation.score_stats(scored_long(spark, sf), "score", ["model_id", "label"])
    return rounded(out, "mean", "std")


@query
def score_stats_by_cluster(spark, sf):
    out = evaluation.score_stats_by_cluster(scored_long(spark, sf), "score", ["model_id", "cluster"])
    return rounded(out, "mean", "std", "p25", "p50", "p75", "p90")


@query
def cluster_metrics(spark, sf):
    out = evaluation.cluster_metrics(scored_long(spark, sf), "label", "score", "cluster")
    return rounded(out, "base_rate", "ap", "auc_pr")


@query
def pr_curve_by_cluster(spark, sf):
    return evaluation.pr_curve_by_cluster(scored_long(spark, sf), "label", "score", "cluster")


def split_quality(spark, sf) -> tuple[DataFrame, DataFrame]:
    """AP and AUC-PR per model on the model rows and on the validation rows, one pass."""
    split = features.hash_split(scored_long(spark, sf), ["quote_id"], fn="md5")
    both = materialize(
        evaluation.average_precision(split, "label", "score", ["is_valid", "model_id"]), "quality"
    )
    return both.filter(~F.col("is_valid")), both.filter("is_valid")


@query
def overfit_gap(spark, sf):
    out = evaluation.overfit_gap(*split_quality(spark, sf))
    return rounded(out, *[c for c in out.columns if c != "model_id"])


@query
def model_selection(spark, sf):
    long = materialize(long_scores(ranked_scores(spark, sf), "quote_id", "label"), "scored")
    quality = evaluation.average_precision(long, "label", "score", ["model_id"])
    total = population(view(spark, sf, "v_scored"))
    topk = evaluation.topk_curves(long, "label", "score_rank", total=total)
    return rounded(evaluation.model_selection(quality, topk), "ap", "auc_pr")
