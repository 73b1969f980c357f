"""End-to-end flows: load, clean, join and segment, prepare, cluster, train, score, compare."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelift.operators import cluster as clustering
from quotelift.operators import evaluation, selection, temporal, training
from quotelift.operators.columns import (
    apply_types,
    blanks_to_null,
    cast_double,
    infer_numeric_types,
    unpivot_scores,
)
from quotelift.operators.features import FeaturePlan, class_weights, fit_features
from quotelift.operators.profile import entity_profile
from quotelift.plans import catalog
from quotelift.plans import fixed_values as fv
from quotelift.plans.rules import LogEntry, apply_rules
from quotelift.session import materialize
from quotelift.sources import files, tables
from quotelift.sources.generations import PublishedTable

Toggles = Mapping[str, Mapping[str, bool]]


def load_deliveries(spark: SparkSession, folder: str, bronze: str, limit: int | None = None) -> DataFrame | None:
    """Append the deliveries not loaded yet to the bronze table; their rows, None if none is new.

    A delivery is new if its name is not in the table and it is not older than the newest
    one there. Values stay text; a load carries one ``batch_id``.
    """
    loaded = cutoff = None
    if spark.catalog.tableExists(bronze):
        known = spark.table(bronze)
        loaded, cutoff = files.loaded_files(known), files.high_water_mark(known).scalar()
    todo = files.incremental_candidates(files.list_files(spark, folder), loaded, cutoff, limit)
    rows = files.ingest_files(spark, todo)
    if rows is None:
        return None
    batch = tables.next_batch_id(spark, bronze)
    tables.append_fixed(tables.tag_batch(rows, batch), bronze)
    return spark.table(bronze).filter(F.col("batch_id") == batch)


def refresh_latest(
    history: DataFrame,
    batch: DataFrame,
    table: PublishedTable,
    consumed: int | None,
    ts: str,
    tie: str,
    status: str,
    entries: Mapping[str, str],
    columns: Sequence[str],
) -> DataFrame:
    """Bring the table of latest snapshots and entry times up to date with the loads of ``batch``.

    Only keys of the loads are recomputed, over their whole history, and only buckets with such
    a key are written again; size the buckets so that one is read and written quickly. The
    table turns to the new state in one commit, which also records that the loads up to
    ``consumed`` are in it.
    """
    key = table.key
    again = temporal.latest_with_entries(
        temporal.touched_history(history, batch, key), key, ts, tie, status, entries, columns
    )
    # at most one number per bucket
    touched = [r["bucket"] for r in batch.select(table.bucket().alias("bucket")).distinct().collect()]
    kept = table.read(touched)
    if kept is not None:
        again = temporal.publish_latest(kept.select(*again.columns), again, batch, key)
    table.publish(again, touched, consumed)
    return table.read()


def catch_up(
    bronze: DataFrame,
    table: PublishedTable,
    typed: Callable[[DataFrame], DataFrame],
    ts: str,
    tie: str,
    status: str,
    columns: Sequence[str],
) -> DataFrame | None:
    """The published table with all loads of bronze in it; None if there has been no load.

    The table knows the last load it has consumed. Loads after it are taken in, also those of a
    run that died before it published; loads that arrive meanwhile wait for the next run.
    """
    entries = {"issued_at": fv.ISSUED, "lost_at": fv.LOST}
    now = table.current()
    last = bronze.agg(F.max("batch_id").alias("b")).first()["b"]
    settled = bronze.filter(F.col("batch_id") <= last) if last is not None else bronze
    fresh = tables.rows_after(settled, now.consumed if now else None)
    if fresh is None:
        return table.read()
    return refresh_latest(typed(settled), typed(fresh), table, last, ts, tie, status, entries, columns)


def age_latest(
    latest: DataFrame, ts: str, status: str, stale_days: int = fv.STALE_DAYS
) -> DataFrame:
    """Close stale open rows and add the reference date, as of the newest time of the table.

    The table holds one row per key, so its newest time is that of the whole history, and
    open rows that no load has touched grow stale with it.
    """
    idle = temporal.days_since_update(latest, latest, ts, "days_idle")
    closed = temporal.stale_to_lost(
        idle, status, "days_idle", fv.OPEN_STATUSES, stale_days, fv.LOST, "status_old", "was_stale"
    )
    date = temporal.reference_date(status, "was_stale", ts, "issued_at", "lost_at", fv.ISSUED, fv.LOST)
    return closed.withColumn("ref_date", date)


def incremental_clean(
    spark: SparkSession,
    folder: str,
    bronze: str,
    path: str,
    typed: Callable[[DataFrame], DataFrame],
    key: str,
    ts: str,
    tie: str,
    status: str,
    columns: Sequence[str],
    stale_days: int = fv.STALE_DAYS,
    buckets: int = 64,
) -> DataFrame:
    """One scheduled run: load new deliveries, refresh the touched keys, age all rows.

    ``typed`` turns bronze text rows into the history that the temporal rule reads. Without
    a new delivery the table is only aged again. A run may die at any point: the next one
    takes in what that one had loaded and not published.
    """
    table = PublishedTable(spark, path, key, buckets)
    load_deliveries(spark, folder, bronze)
    latest = catch_up(spark.table(bronze), table, typed, ts, tie, status, columns)
    if latest is None:
        raise ValueError(f"no delivery has been loaded into {bronze}")
    return age_latest(latest, ts, status, stale_days)


def typed_bronze(bronze: DataFrame, codes: Sequence[str] = (), types: Mapping[str, str] | None = None) -> DataFrame:
    """Bronze text with numeric columns as numbers, before any rule.

    ``types`` are those the table was pinned to on its first load; without them they are inferred
    from these rows (``infer_numeric_types``). Columns in ``codes`` stay text. Rules take numbers
    and text alike; a blank in a numeric column becomes NULL.
    """
    kinds = infer_numeric_types(bronze, codes) if types is None else types
    return apply_types(bronze, {c: t for c, t in kinds.items() if c not in set(codes)})


def clean_quotes(
    bronze: DataFrame,
    house: str = "",
    purpose: str = "train",
    tie: str | None = None,
    toggles: Toggles | None = None,
    count_rows: bool = False,
    infer: bool = False,
    codes: Sequence[str] = (),
) -> tuple[DataFrame, list[LogEntry]]:
    """All quote rules as one plan; with ``infer`` text is typed first (see ``typed_bronze``)."""
    bronze = typed_bronze(bronze, codes) if infer else bronze
    table = "cotacao_generico"
    # columns dropped right after the temporal rule do not go through its shuffle
    drops_on = (toggles or {}).get(table, {}).get("GEN_R08", True)
    leave_out = catalog.quote_drops(house) if drops_on else []
    rules = catalog.quote_rules(house, purpose, tie, leave_out)
    return apply_rules(bronze, rules, table, toggles, count_rows=count_rows)


def clean_summary(
    bronze: DataFrame, purpose: str = "train", tie: str | None = None, toggles: Toggles | None = None
) -> tuple[DataFrame, list[LogEntry]]:
    return apply_rules(bronze, catalog.summary_rules(purpose, tie), "corretor_resumo", toggles)


def clean_detail(
    bronze: DataFrame, purpose: str = "train", toggles: Toggles | None = None
) -> tuple[DataFrame, list[LogEntry]]:
    return apply_rules(bronze, catalog.detail_rules(purpose), "corretor_detalhe", toggles)


def join_and_segment(
    quotes: DataFrame,
    summary: DataFrame,
    detail: DataFrame,
    toggles: Toggles | None = None,
    count_rows: bool = False,
    house: str = "",
    **segment_options,
) -> tuple[DataFrame, list[LogEntry]]:
    """Both retention joins, then the segment column; one lazy plan.

    ``house`` gives the renewal spellings of the source unless they are named.
    """
    segment_options.setdefault("renewal_words", catalog.renewal_spellings(house))
    joined, log = apply_rules(
        quotes, catalog.join_rules(summary, detail), "post_join", toggles, count_rows=count_rows
    )
    out, more = apply_rules(
        joined,
        catalog.segment_rules(**segment_options),
        "post_seg",
        toggles,
        count_rows=count_rows,
    )
    return out, log + more


@dataclass
class TrainingData:
    model: DataFrame
    valid: DataFrame
    features: FeaturePlan
    log: list[LogEntry]


def training_data(
    segmented: DataFrame,
    candidates: Mapping[str, bool],
    house: str = "",
    months: tuple[str, ...] | None = None,
    fn: str = "xxhash64",
    toggles: Toggles | None = None,
    codes: Sequence[str] = (),
) -> TrainingData:
    """Model and validation rows with features learned on the model rows only.

    Text candidates that hold only numbers are numeric features, but for those in ``codes``.
    """
    rules = catalog.training_rules() if months is None else catalog.training_rules(months)
    df, log = apply_rules(segmented, rules, "rules_on_df_seg", toggles)
    base, more = apply_rules(df, catalog.split_rules(house, fn), "rules_build_base", toggles)
    log += more
    model, more = apply_rules(base, catalog.part_rules(False), "rules_build_df_model", toggles)
    log += more
    valid, more = apply_rules(base, catalog.part_rules(True), "rules_build_df_validacao", toggles)
    log += more
    prep = (toggles or {}).get("rules_feature_prep")
    wanted = [c for c, use in candidates.items() if use and c in model.columns]
    types = infer_numeric_types(blanks_to_null(model.select(*wanted)), codes) if wanted else {}
    features = fit_features(model, candidates, prep, list(types))
    return TrainingData(features.apply(model), features.apply(valid), features, log)


# Broker profile features used for clustering.
PROFILE_FEATURES = ["rate_mean", "volume_mean", "n_products"]


def in_segment(df: DataFrame, segment: str | None, column: str = "SEG") -> DataFrame:
    """Rows of one segment; on a table partitioned by segment only its files are read."""
    return df if segment is None else df.filter(F.col(column) == segment)


def broker_profile(segmented: DataFrame, segment: str | None = None) -> DataFrame:
    return entity_profile(
        in_segment(segmented, segment),
        "CD_DOC_CORRETOR",
        "HR_2025_detalhe",
        "QTD_COTACAO_2025_detalhe",
        "DS_PRODUTO_NOME",
    )


def cluster_brokers(
    segmented: DataFrame,
    k: int,
    scaling: str = "log1p_standard",
    nulls: str = "drop",
    segment: str | None = None,
    restarts: int = fv.CLUSTER_RESTARTS,
) -> clustering.ClusterFit:
    """Profile, NULL strategy, scaling and final fit; the profile is computed once."""
    profile = materialize(broker_profile(segmented, segment), "brokers")
    ready = clustering.cluster_nulls(profile, PROFILE_FEATURES, nulls)
    return clustering.kmeans_fit(ready, PROFILE_FEATURES, k, scaling, restarts)


def with_cluster(
    data: TrainingData, fit: clustering.ClusterFit, column: str = "CLF_CORRETOR"
) -> TrainingData:
    """Attach the broker cluster to model and validation rows as one more category."""

    def attach(df: DataFrame) -> DataFrame:
        return clustering.attach_cluster(df, fit.assigned, "CD_DOC_CORRETOR", column)

    features = replace(data.features, categorical=[*data.features.categorical, column])
    return TrainingData(attach(data.model), attach(data.valid), features, data.log)


@dataclass
class Selected:
    """Features for a training run, best first, and how they were ranked."""

    categorical: list[str]
    numeric: list[str]
    ranked: DataFrame  # feature, score_final, rank_final
    quality: DataFrame  # method, seed, ap, auc_pr


def select_features(
    data: TrainingData,
    key: str,
    segment: str | None = None,
    top: int | None = None,
    pinned: Sequence[str] = (),
    explicit: Sequence[str] | None = None,
    methods: Mapping[str, Mapping] | None = None,
    seeds: Sequence[int] = tuple(fv.SELECTION_SEEDS),
) -> Selected:
    """The features of a run: an explicit list, or the best ``top`` and the pinned ones.

    Ranks come from the weighted ensemble of all methods and seeds on the model rows. Pinned
    features keep their place in the ranking and come in even beyond ``top``; a name that the
    training data does not have is an error.
    """
    cats, nums = list(data.features.categorical), list(data.features.numeric)
    known = [*cats, *nums]
    strange = [c for c in [*pinned, *(explicit or [])] if c not in known]
    if strange:
        raise ValueError(f"no such features: {strange}")
    if explicit is not None and not explicit:
        raise ValueError("the list of features is empty")
    rows = cast_double(blanks_to_null(in_segment(data.model, segment)), nums)
    rows = materialize(rows.select(key, "label", *known), "candidates")
    importances, quality = selection.fs_methods(rows, key, "label", cats, nums, methods, seeds)
    scores = selection.rank_score(importances, known, ["method", "seed"])
    ranked = materialize(selection.ensemble_rank(scores, quality), "ranked-features")
    order = selection.feature_sets(ranked, [len(known)])[f"top_{len(known)}"]
    wanted = explicit if explicit is not None else [*order[: len(known) if top is None else top], *pinned]
    chosen = [c for c in order if c in set(wanted)]
    return Selected([c for c in chosen if c in cats], [c for c in chosen if c in nums], ranked, quality)


@dataclass
class Trained:
    models: training.ScoringSet
    train_quality: DataFrame
    cv: DataFrame
    evaluation: DataFrame
    selected: Selected | None = None


def train(
    data: TrainingData,
    key: str,
    segment: str | None = None,
    categorical: Sequence[str] | None = None,
    numeric: Sequence[str] | None = None,
    combos: Sequence[training.Combo] | None = None,
    cv_iterations: int = fv.GRID_ITERATIONS,
    final_iterations: int = fv.FINAL_ITERATIONS,
    weights: str | bool = "auto",
    criterion: str = "max_f1",
    precision_target: float = 0.4,
    select: Mapping[str, object] | None = None,
) -> Trained:
    """Cross validation, final fits of every grid point, thresholds on validation rows.

    ``select`` holds options of :func:`select_features`, which then choose the features on the
    model rows; without it the lists given, or else all features, are used.
    """
    selected = None
    if select is not None:
        if categorical is not None or numeric is not None:
            raise ValueError("features are either selected or given")
        selected = select_features(data, key, segment, **select)
        categorical, numeric = selected.categorical, selected.numeric
    cats = list(data.features.categorical if categorical is None else categorical)
    nums = list(data.features.numeric if numeric is None else numeric)
    rows = cast_double(blanks_to_null(in_segment(data.model, segment)), nums)
    rows = materialize(
        class_weights(rows, "label", weights).select(key, "label", "weight", *cats, *nums), "model"
    )
    cv = training.cv_grid(rows, key, "label", cats, nums, combos, cv_iterations)
    models, quality = training.train_final(
        rows, "label", cats, nums, data.features.lists, combos, final_iterations
    )
    valid = in_segment(data.valid, segment)
    scores = materialize(training.score_models(valid, models, key), "valid-scores")
    labelled = scores.join(valid.select(key, "label"), key)
    long = unpivot_scores(labelled, [key, "label"], fv.SCORE_PREFIX, fv.RANK_PREFIX)
    summary = evaluation.eval_summary(
        long, "label", "score", ["model_id"], criterion, precision_target
    )
    return Trained(models, quality, cv, summary, selected)


def score(
    df: DataFrame,
    models: training.ScoringSet,
    key: str,
    segment: str | None = None,
    metadata: Mapping[str, str] | None = None,
) -> DataFrame:
    """Wide scores of one segment; an empty segment is an error."""
    rows = in_segment(df, segment)
    if rows.isEmpty():
        raise ValueError(f"no rows to score in segment {segment!r}")
    return training.score_wide(rows, models, key, metadata)


def compare(
    scored: DataFrame,
    key: str,
    status: str = "DS_GRUPO_STATUS",
    segment: str | None = None,
    cluster: str | None = None,
    train_quality: DataFrame | None = None,
    cluster_facts: DataFrame | None = None,
    step: int = 1,
    reference_k: int = fv.REFERENCE_K,
) -> dict[str, DataFrame]:
    """All comparison tables of a wide score table, by name.

    Scores are turned to long form and written once; every table reads only the columns
    it needs from there. Cluster tables appear if a cluster column is given.
    """
    wide = in_segment(scored, segment).withColumn("label", evaluation.eval_label(status))
    keep = [key, status, "label", *([cluster] if cluster else [])]
    long = materialize(unpivot_scores(wide, keep, fv.SCORE_PREFIX, fv.RANK_PREFIX), "scored")
    models = evaluation.base_rate(long, "label", ["model_id"])
    total = models.agg(F.max("n_rows").alias("n")).scalar()
    ranks = sorted(c for c in scored.columns if c.startswith(fv.RANK_PREFIX))
    by_model = ["model_id"]
    quality = materialize(evaluation.average_precision(long, "label", "score", by_model), "quality")
    topk = evaluation.topk_curves(long, "label", "score_rank", by_model, total, step)
    final = catalog.final_status(catalog.canonical_status(long, status), status)
    out = {
        "base_rate": models,
        "topk": topk,
        "quality": quality,
        "pr_curve": evaluation.pr_curve(long, "label", "score", by_model),
        "score_histogram": evaluation.score_histogram(final, "score", ["model_id", status]),
        "score_stats": evaluation.score_stats(long, "score", ["model_id", "label"]),
        "selection": evaluation.model_selection(quality, topk, reference_k, step),
    }
    if len(ranks) > 1:
        out["rank_correlation"] = evaluation.rank_correlation(wide, ranks)
        out["overlap"] = evaluation.overlap_at_k(wide, ranks, total, step)
    if train_quality is not None:
        out["overfit"] = evaluation.overfit_gap(train_quality, quality)
    if cluster:
        by = [cluster, "model_id"]
        one_model = long.filter(F.col("model_id") == models.agg(F.min("model_id")).scalar())
        clustered = long.filter(F.col(cluster).isNotNull())
        out["cluster_profile"] = evaluation.cluster_profile(
            one_model, "label", cluster, cluster_facts
        )
        out["cluster_metrics"] = evaluation.cluster_metrics(long, "label", "score", cluster)
        out["cluster_pr_curve"] = evaluation.pr_curve_by_cluster(long, "label", "score", cluster)
        out["cluster_topk"] = evaluation.topk_by_group(clustered, "label", "score", key, by, step)
        out["cluster_stats"] = evaluation.score_stats_by_cluster(clustered, "score", by)
    return out
