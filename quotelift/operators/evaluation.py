"""Ranking and classification metrics, computed on all rows in Spark.

Scored rows come in long form (``model_id, label, score, score_rank`` and optional group
columns), so all models and groups share one pass. Rows are first reduced to counts per
threshold, per K bucket or per distinct score; curves are running sums over those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quotelift.functions import status_key
from quotelift.operators.ordering import add_position, exact_quantiles, running_totals
from quotelift.operators.profile import edge_bin
from quotelift.plans import fixed_values as fv

EPSILON = 1e-10


def eval_label(status: str, issued: str = fv.ISSUED) -> Column:
    """1 for issued rows, 0 for every other status and for NULL."""
    return F.when(status_key(status) == issued.upper(), 1).otherwise(0)


def base_rate(df: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col(label) == 1).alias("n_pos"),
        F.avg(F.col(label).cast("double")).alias("base_rate"),
    )


# --- thresholds ---------------------------------------------------------------------


def _threshold_step(score: Column, steps: int) -> Column:
    """Largest ``i`` in ``0..steps`` with ``score >= i/steps``; 0 for NULL scores."""
    guess = F.floor(score * steps)
    exact = (
        F.when(score >= (guess + 1) / F.lit(float(steps)), guess + 1)
        .when(score < guess / F.lit(float(steps)), guess - 1)
        .otherwise(guess)
    )
    return F.coalesce(F.least(F.greatest(exact, F.lit(0)), F.lit(steps)), F.lit(0)).cast("int")


def _ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num, den)


def threshold_sweep(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), steps: int = 100
) -> DataFrame:
    """Confusion counts and precision, recall, F1, F2 at ``1/steps .. (steps-1)/steps``.

    Rows are reduced to counts per threshold step; the curve is summed from those.
    Undefined ratios are NULL; F1 and F2 are also NULL where precision or recall is 0.
    """
    per_step = (
        df.groupBy(*by, _threshold_step(F.col(score), steps).alias("step"))
        .agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("q"))
        .groupBy(*by)
        .agg(
            F.collect_list(F.struct("step", "p", "q")).alias("cells"),  # at most steps + 1
            F.sum("p").alias("n_pos"),
            F.sum("q").alias("n_neg"),
        )
    )
    at = per_step.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(steps - 1))).alias("i")
    ).withColumn("hit", F.filter("cells", lambda c: c["step"] >= F.col("i")))
    curve = at.select(
        *by,
        (F.col("i") / F.lit(float(steps))).alias("threshold"),
        F.aggregate("hit", F.lit(0).cast("bigint"), lambda s, c: s + c["p"]).alias("tp"),
        F.aggregate("hit", F.lit(0).cast("bigint"), lambda s, c: s + c["q"]).alias("fp"),
        "n_pos",
        "n_neg",
    )
    tp, fp = F.col("tp"), F.col("fp")
    curve = curve.select(
        *by,
        "threshold",
        "tp",
        "fp",
        (F.col("n_pos") - tp).alias("fn"),
        (F.col("n_neg") - fp).alias("tn"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, F.col("n_pos")).alias("recall"),
    )
    p, r = F.col("precision"), F.col("recall")
    both = (p > 0) & (r > 0)
    return curve.withColumn("f1", F.when(both, 2 * p * r / (p + r))).withColumn(
        "f2", F.when(both, 5 * p * r / (4 * p + r))
    )


def select_threshold(
    curve: DataFrame,
    criterion: str = "max_f1",
    precision_target: float = 0.25,
    by: Sequence[str] = (),
) -> DataFrame:
    """The chosen curve row per group: best F1, best F2, or best recall at a precision.

    The lowest threshold wins ties. A group in which no row qualifies is absent; use
    :func:`require_threshold` to fail on an empty choice.
    """
    metrics = {"max_f1": "f1", "max_f2": "f2", "precision_ge_target": "recall"}
    if criterion not in metrics:
        raise ValueError(f"unknown criterion {criterion!r}")
    metric = metrics[criterion]
    usable = curve.filter(F.col(metric).isNotNull() & F.col("precision").isNotNull())
    if criterion == "precision_ge_target":
        usable = usable.filter(F.col("precision") >= precision_target)
    best = F.max_by(F.struct(*curve.columns), F.struct(F.col(metric), -F.col("threshold")))
    if not by:
        # a global aggregate always gives a row; drop it when nothing qualified
        usable = usable.withColumn("_all", F.lit(1))
        return usable.groupBy("_all").agg(best.alias("_row")).select("_row.*")
    return usable.groupBy(*by).agg(best.alias("_row")).select("_row.*")


def require_threshold(choice: DataFrame, criterion: str) -> DataFrame:
    if choice.isEmpty():
        raise ValueError(f"no threshold satisfies {criterion}")
    return choice


def eval_summary(
    df: DataFrame,
    label: str,
    score: str,
    by: Sequence[str],
    criterion: str = "max_f1",
    precision_target: float = 0.4,
) -> DataFrame:
    """Chosen threshold row per group with the base rate and row count of the group."""
    choice = select_threshold(
        threshold_sweep(df, label, score, by), criterion, precision_target, by
    )
    n = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return choice.withColumn("n_eval", n).withColumn(
        "baseline", (F.col("tp") + F.col("fn")) / F.col("n_eval")
    )


# --- precision-recall curves --------------------------------------------------------


def _score_walk(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """Counts per distinct score, walked from the highest score down."""
    per_score = (
        df.filter(F.col(score).isNotNull())
        .groupBy(*by, F.col(score).cast("double").alias("threshold"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.count_if(F.col(label) == 1).alias("_pos"),
        )
    )
    return running_totals(
        per_score, [F.col("threshold").desc()], {"_seen": "_n", "_hits": "_pos"}, by
    )


def average_precision(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Average precision and trapezoid area per group; tied scores count as one step.

    Each step needs only its own counts: the previous point of the curve is the running
    total without the current score.
    """
    walked = _score_walk(df, label, score, by)
    pos, hits, seen = F.col("_pos"), F.col("_hits"), F.col("_seen")
    gain = _ratio(pos, F.col("_hits_total"))
    here = hits / seen
    before = F.coalesce(F.try_divide(hits - pos, seen - F.col("_n")), F.lit(1.0))
    return walked.groupBy(*by).agg(
        F.max("_seen_total").alias("n_scored"),
        F.max("_hits_total").alias("n_pos"),
        F.coalesce(F.sum(gain * here), F.lit(0.0)).alias("ap"),
        F.coalesce(F.sum(gain * (here + before) / 2), F.lit(0.0)).alias("auc_pr"),
    )


def pr_curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, F1 and F2 at every distinct score."""
    walked = _score_walk(df, label, score, by)
    p = F.col("_hits") / F.col("_seen")
    r = _ratio(F.col("_hits"), F.col("_hits_total"))
    return walked.select(
        *by,
        "threshold",
        p.alias("precision"),
        r.alias("recall"),
        (2 * p * r / (p + r + EPSILON)).alias("f1"),
        (5 * p * r / (4 * p + r + EPSILON)).alias("f2"),
    )


def point_at_threshold(curve: DataFrame, tau: float) -> DataFrame:
    """The curve row whose threshold is nearest to ``tau``; the lower one wins a tie."""
    return curve.orderBy(F.abs(F.col("threshold") - tau), "threshold").limit(1)


def average_precision_rows(
    df: DataFrame, label: str, score: str, tie: str, by: Sequence[str] = ()
) -> DataFrame:
    """Average precision by row: mean precision at each positive, ties ordered by ``tie``."""
    rows = df.select(*by, F.col(score), F.col(tie), F.col(label).cast("int").alias("_y"))
    walked = running_totals(
        rows.withColumn("_one", F.lit(1)),
        [F.col(score).desc_nulls_last(), F.col(tie).asc()],
        {"_hits": "_y", "_place": "_one"},
        by,
    )
    precision = F.when(F.col("_y") == 1, F.col("_hits") / F.col("_place"))
    return walked.groupBy(*by).agg(F.coalesce(F.avg(precision), F.lit(0.0)).alias("ap"))


# --- top-K curves -------------------------------------------------------------------


def top_n(k: Column, total: Column) -> Column:
    """Rows in the top ``k`` percent, rounded half-even and kept in ``1..total``."""
    rounded = F.bround(k / F.lit(100.0) * total, 0).cast("bigint")
    return F.greatest(F.lit(1), F.least(rounded, total))


def first_percent(rank: Column, total: Column) -> Column:
    """Smallest whole percent whose top-n includes the rank; NULL ranks stay NULL.

    A division gives the percent up to one; three checks against ``top_n`` settle it.
    """
    guess = F.ceil((rank - 0.5) * 100 / total)

    def reached(k: Column) -> Column:
        return (k >= 1) & (rank <= top_n(k, total))

    return (
        F.when(rank <= 1, 1)  # every top-n holds at least one row
        .when(reached(guess - 1), guess - 1)
        .when(reached(guess), guess)
        .when(rank.isNotNull(), guess + 1)
        .cast("int")
    )


def _percent_cells(
    df: DataFrame, by: Sequence[str], label: Column, rank: Column, total: Column
) -> DataFrame:
    """Per group: totals and at most 101 (percent, rows, positives) cells."""
    slim = df.select(*by, label.alias("_label"), rank.alias("_rank"), total.alias("_total"))
    pct = first_percent(F.col("_rank"), F.col("_total"))
    per_percent = slim.groupBy(*by, pct.alias("pct")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_label") == 1).alias("p"),
        F.max("_total").alias("t"),
    )
    return per_percent.groupBy(*by).agg(
        F.collect_list(F.struct("pct", "n", "p")).alias("cells"),
        F.max("t").alias("total"),
        F.sum("p").alias("n_pos"),
    )


def _at_each_k(cells: DataFrame, by: Sequence[str], step: int) -> DataFrame:
    at = cells.select("*", F.explode(F.sequence(F.lit(1), F.lit(100), F.lit(step))).alias("k_pct"))
    inside = F.filter("cells", lambda c: c["pct"] <= F.col("k_pct"))

    def total_of(name: str) -> Column:
        return F.aggregate(inside, F.lit(0).cast("bigint"), lambda s, c: s + c[name])

    return at.select(
        *by,
        "k_pct",
        top_n(F.col("k_pct"), F.col("total")).alias("top_n"),
        total_of("n").alias("inside"),
        total_of("p").alias("tp"),
        "n_pos",
        "total",
    )


def topk_curves(
    df: DataFrame,
    label: str,
    rank: str,
    by: Sequence[str] = ("model_id",),
    total: Column | None = None,
    step: int = 1,
) -> DataFrame:
    """Confusion counts, precision, recall and lift in the top K percent by rank.

    ``total`` is the population size; by default the column ``total`` holds it. Ratios
    without a denominator are 0.
    """
    population = F.col("total") if total is None else total
    cells = _percent_cells(df, by, F.col(label), F.col(rank), population)
    k = _at_each_k(cells, by, step)
    tp, n_pos, n = F.col("tp"), F.col("n_pos"), F.col("total")
    p_at = tp / F.col("top_n")
    return k.select(
        *by,
        "k_pct",
        "top_n",
        "tp",
        (F.col("inside") - tp).alias("fp"),
        (n_pos - tp).alias("fn"),
        (n - n_pos - (F.col("inside") - tp)).alias("tn"),
        p_at.alias("p_at_k"),
        F.coalesce(_ratio(tp, n_pos), F.lit(0.0)).alias("r_at_k"),
        F.coalesce(F.try_divide(p_at, n_pos / n), F.lit(0.0)).alias("lift_at_k"),
    )


def topk_by_group(
    df: DataFrame, label: str, score: str, tie: str, by: Sequence[str], step: int = 1
) -> DataFrame:
    """Top-K curve per group on the rank inside the group; groups without positives drop."""
    order = [F.col(score).desc_nulls_last(), F.col(tie).asc()]
    slim = df.select(*by, label, score, tie)
    ranked = add_position(slim, order, "local_rank", by, total="total")
    curves = topk_curves(ranked, label, "local_rank", by, step=step)
    kept = curves.filter(F.col("tp") + F.col("fn") > 0)
    return kept.drop("fp", "fn", "tn")


def overlap_at_k(df: DataFrame, ranks: Sequence[str], total: Column, step: int = 1) -> DataFrame:
    """Rows that every model puts into its top K percent.

    A row is in all top sets once its worst rank is, so no set is built. Rows that a
    model did not rank belong to no overlap.
    """
    complete = F.lit(True)
    for r in ranks:
        complete = complete & F.col(r).isNotNull()
    worst = F.greatest(*ranks) if len(ranks) > 1 else F.col(ranks[0])
    slim = df.select(F.when(complete, worst).alias("worst"))
    cells = _percent_cells(slim, [], F.lit(1), F.col("worst"), total)
    k = _at_each_k(cells, [], step)
    return k.select(
        "k_pct",
        "top_n",
        F.col("inside").alias("n_overlap"),
        (F.col("inside") / F.col("top_n")).alias("overlap_share"),
    )


def rank_correlation(df: DataFrame, ranks: Sequence[str], prefix: str = fv.RANK_PREFIX) -> DataFrame:
    """Spearman correlation of every pair of models, as Pearson on their unique ranks."""
    names = [r[len(prefix) :] if r.startswith(prefix) else r for r in ranks]
    pairs = [(i, j) for i in range(len(ranks)) for j in range(len(ranks)) if i < j]
    one = df.agg(*[F.corr(ranks[i], ranks[j]).alias(f"c{i}_{j}") for i, j in pairs])
    entries = []
    for i in range(len(ranks)):
        for j in range(len(ranks)):
            rho = F.lit(1.0) if i == j else F.col(f"c{min(i, j)}_{max(i, j)}")
            entries.append(
                F.struct(
                    F.lit(names[i]).alias("model_a"), F.lit(names[j]).alias("model_b"), rho.alias("rho")
                )
            )
    return one.select(F.inline(F.array(*entries)))


# --- score distributions ------------------------------------------------------------


def score_histogram(
    df: DataFrame, score: str, by: Sequence[str], bins: int = 50
) -> DataFrame:
    """Histogram on [0, 1] with densities per group; scores outside [0, 1] are left out."""
    width = 1.0 / bins
    inside = df.filter(F.col(score).between(0.0, 1.0))
    counts = inside.groupBy(
        *by, edge_bin(F.col(score), F.lit(0.0), F.lit(width), bins).alias("bin")
    ).agg(F.count(F.lit(1)).alias("n_rows"))
    total = F.sum("n_rows").over(W.partitionBy(*by))
    return counts.withColumn("density", F.col("n_rows") / (total * F.lit(width)))


def score_stats(df: DataFrame, score: str, by: Sequence[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum of filled scores."""
    return (
        df.filter(F.col(score).isNotNull())
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.avg(score).alias("mean"),
            F.stddev_samp(score).alias("std"),
            F.min(score).alias("min"),
            F.max(score).alias("max"),
        )
    )


def score_stats_by_cluster(df: DataFrame, score: str, by: Sequence[str]) -> DataFrame:
    """Count, mean, population standard deviation and exact percentiles per group."""
    scored = df.filter(F.col(score).isNotNull())
    moments = scored.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg(score).alias("mean"), F.stddev_pop(score).alias("std")
    )
    quantiles = exact_quantiles(
        scored, score, {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}, by
    )
    return moments.join(quantiles, list(by))


# --- summaries of several metrics ---------------------------------------------------


def overfit_gap(train: DataFrame, valid: DataFrame) -> DataFrame:
    """Train minus validation AUC-PR and AP per model (frames of ``model_id, ap, auc_pr``)."""
    t = train.select("model_id", F.col("ap").alias("ap_train"), F.col("auc_pr").alias("auc_pr_train"))
    v = valid.select("model_id", F.col("ap").alias("ap_valid"), F.col("auc_pr").alias("auc_pr_valid"))
    return (
        v.join(t, "model_id", "left")
        .withColumn("gap_ap", F.col("ap_train") - F.col("ap_valid"))
        .withColumn("gap_auc_pr", F.col("auc_pr_train") - F.col("auc_pr_valid"))
    )


def model_selection(
    quality: DataFrame, topk: DataFrame, reference_k: int = fv.REFERENCE_K, step: int = 1
) -> DataFrame:
    """AP, AUC-PR and the top-K metrics at the available K nearest to the reference."""
    k_ref = min(range(1, 101, step), key=lambda k: abs(k - reference_k))
    at = topk.filter(F.col("k_pct") == k_ref).select(
        "model_id", "k_pct", "p_at_k", "r_at_k", "lift_at_k"
    )
    return quality.select("model_id", "ap", "auc_pr").join(at, "model_id", "left")


def cluster_metrics(
    df: DataFrame, label: str, score: str, cluster: str, model: str = "model_id"
) -> DataFrame:
    """AP and AUC-PR per cluster and model; NULL unless two scored rows and both classes."""
    by = [cluster, model]
    rows = df.filter(F.col(cluster).isNotNull())
    rates = base_rate(rows, label, by)
    quality = average_precision(rows, label, score, by).withColumnRenamed("n_pos", "_scored_pos")
    usable = (
        (F.col("n_scored") >= 2)
        & (F.col("_scored_pos") > 0)
        & (F.col("_scored_pos") < F.col("n_scored"))
    )
    return rates.join(quality, by, "left").select(
        *by,
        "n_rows",
        "n_pos",
        "base_rate",
        F.when(usable, F.col("ap")).alias("ap"),
        F.when(usable, F.col("auc_pr")).alias("auc_pr"),
    )


def pr_curve_by_cluster(
    df: DataFrame, label: str, score: str, cluster: str, model: str = "model_id"
) -> DataFrame:
    """Curve per cluster and model; groups with one class or under two rows are skipped."""
    by = [cluster, model]
    walked = _score_walk(df.filter(F.col(cluster).isNotNull()), label, score, by)
    both = (F.col("_hits_total") > 0) & (F.col("_hits_total") < F.col("_seen_total"))
    return walked.filter(both).select(
        *by,
        "threshold",
        (F.col("_hits") / F.col("_seen")).alias("precision"),
        (F.col("_hits") / F.col("_hits_total")).alias("recall"),
    )


def cluster_profile(
    df: DataFrame, label: str, cluster: str, summary: DataFrame | None = None
) -> DataFrame:
    """Rows, positives and base rate per cluster, with its centroid columns if given."""
    rates = base_rate(df.filter(F.col(cluster).isNotNull()), label, [cluster])
    return rates if summary is None else rates.join(summary, cluster, "left")
