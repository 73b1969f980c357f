"""Feature selection: importances by several models, rank scores, weighted ensemble."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quotelift.operators.boosting import GBTClassifier
from quotelift.operators.evaluation import average_precision, average_precision_rows
from quotelift.operators.features import (
    all_null_columns,
    preprocess_stages,
    sample_complement,
    stratified_sample,
)
from quotelift.operators.ordering import exact_quantiles
from quotelift.operators.profile import features_long
from quotelift.operators.together import IN_FLIGHT, fits_in_memory, run_together
from quotelift.plans import fixed_values as fv
from quotelift.session import materialize, scratch_path, spread

CONSTANT = 1e-12  # relative variation under which values count as constant

# Settings of the three importance methods.
METHODS = {
    "lr_l1": {"maxIter": 100, "regParam": 0.01, "elasticNetParam": 1.0},
    "rf": {"numTrees": 200, "maxDepth": 8},
    "gbt": {"maxIter": 80, "maxDepth": 5, "stepSize": 0.1},
}


def label_audit(df: DataFrame, label: str) -> DataFrame:
    """Rows, and rows whose label is neither 0 nor 1."""
    y = F.col(label).try_cast("int")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(y.isNull() | ~y.isin(0, 1)).alias("n_invalid"),
    )


def slot_features(vectors: DataFrame, column: str = "features_vec") -> list[str]:
    """Source column of every vector slot, read from the ML attribute metadata."""
    groups = vectors.schema[column].metadata["ml_attr"]["attrs"].values()
    slots = sorted((a for group in groups for a in group), key=lambda a: a["idx"])
    return [_source(a["name"]) for a in slots]


def _source(slot: str) -> str:
    for mark in ("__ohe", "__imp", "="):
        slot = slot.split(mark, 1)[0]
    return slot


def _classifier(method: str, settings: Mapping, seed: int):
    common = {"featuresCol": "features_vec", "labelCol": "label"}
    if method == "lr_l1":
        return LogisticRegression(**common, standardization=True, **settings)
    if method == "rf":
        return RandomForestClassifier(**common, seed=seed, **settings)
    if method == "gbt":
        return GBTClassifier(**common, seed=seed, **settings)
    raise ValueError(f"unknown method {method!r}")


def _without_summary(model):
    """The model read back from storage.

    A fresh classifier keeps its training summary and with it the session, which cannot
    be shipped to executors once the session has observed metrics.
    """
    if not getattr(model, "hasSummary", False):
        return model
    path = scratch_path(SparkSession.active(), "model")
    model.write().save(path)
    return type(model).load(path)


def _importances(model) -> list[float]:
    values = model.coefficients if hasattr(model, "coefficients") else model.featureImportances
    return [abs(float(v)) for v in values.toArray()]


def fs_methods(
    df: DataFrame,
    key: str,
    label: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    methods: Mapping[str, Mapping] | None = None,
    seeds: Sequence[int] = tuple(fv.SELECTION_SEEDS),
    train_fraction: float = fv.SELECTION_TRAIN_FRACTION,
    in_flight: int = IN_FLIGHT,
) -> tuple[DataFrame, DataFrame]:
    """Importances and validation quality per method and seed.

    Returns ``(importances: method, seed, feature, importance)`` and ``(quality: method,
    seed, ap, auc_pr)``. Both have one row per slot or fit, never per data row.
    """
    spark: SparkSession = df.sparkSession
    base = spread(df.select(key, F.col(label).cast("int").alias("label"), *categorical, *numeric))

    def prepare(seed: int) -> tuple[DataFrame, DataFrame, list[str]]:
        train = materialize(
            stratified_sample(base, "label", {0: train_fraction, 1: train_fraction}, seed), "train"
        )
        valid = sample_complement(base, train, key)
        empty = all_null_columns(train, numeric)
        usable = [c for c in numeric if c not in empty]
        prepared = preprocess_stages(categorical, usable).fit(train)
        vectors = prepared.transform(train).select("label", "features_vec")
        slots = slot_features(vectors)
        held = prepared.transform(valid).select(key, "label", "features_vec")
        return materialize(vectors, "train-vectors"), materialize(held, "valid-vectors"), slots

    parts = dict(zip(seeds, run_together(spark, [partial(prepare, s) for s in seeds], in_flight), strict=True))

    def fit(method: str, settings: Mapping, seed: int) -> tuple[list[float], float, float]:
        train, valid, _ = parts[seed]
        model = _without_summary(_classifier(method, settings, seed).fit(train))
        scored = model.transform(valid).select(key, "label", vector_to_array("probability")[1].alias("score"))
        scored = materialize(scored, "selection-scores")
        ap = average_precision_rows(scored, "label", "score", key).first()["ap"]
        area = average_precision(scored, "label", "score").first()["auc_pr"]
        return _importances(model), float(ap), float(area)

    tasks = [(m, settings, seed) for seed in seeds for m, settings in (methods or METHODS).items()]
    # a forest keeps a count for each of its trees with each row
    trees = max((settings.get("numTrees", 0) for _, settings, _ in tasks), default=0)
    rows, slots = max(train.count() for train, _, _ in parts.values()), max(len(s) for _, _, s in parts.values())
    in_flight = fits_in_memory(spark, rows, slots + trees, in_flight)
    importances, quality = [], []
    for (m, _, seed), (values, ap, area) in zip(tasks, run_together(spark, [partial(fit, *t) for t in tasks], in_flight), strict=True):
        quality.append((m, seed, ap, area))
        importances += [(m, seed, feature, value) for feature, value in zip(parts[seed][2], values)]
    return (
        spark.createDataFrame(importances, "method string, seed int, feature string, importance double"),
        spark.createDataFrame(quality, "method string, seed int, ap double, auc_pr double"),
    )


def rank_score(
    importances: DataFrame, features: Sequence[str], by: Sequence[str], feature: str = "feature"
) -> DataFrame:
    """Importance per source feature and its rank score ``1 - (rank-1)/(n-1)``.

    ``importances`` may hold several rows per feature (one-hot slots), which are summed.
    Every name in ``features`` appears; without any importance it gets 0. Equal
    importances rank by name.
    """
    summed = importances.groupBy(*by, feature).agg(F.sum("importance").alias("importance"))
    group = W.partitionBy(*by)  # one row per feature: small groups
    # sums of doubles differ in their last bits with the order of the rows
    place = F.row_number().over(group.orderBy(F.round("importance", 12).desc(), feature))
    n = F.count(F.lit(1)).over(group)
    scored = summed.withColumns({"_place": place, "_n": n}).withColumn(
        "score", F.when(F.col("_n") <= 1, 1.0).otherwise(1 - (F.col("_place") - 1) / (F.col("_n") - 1))
    )
    names = F.array(*[F.lit(name) for name in features])
    every = importances.select(*by).distinct().select(*by, F.explode(names).alias(feature))
    return every.join(scored.drop("_place", "_n"), [*by, feature], "left").na.fill(
        {"importance": 0.0, "score": 0.0}
    )


def ensemble_rank(scores: DataFrame, quality: DataFrame) -> DataFrame:
    """Final score and rank per feature: method scores weighted by their AUC-PR share.

    ``scores`` holds ``method, seed, feature, score``; ``quality`` holds ``method, seed,
    auc_pr``. Both are averaged over seeds first. If all weights are 0 the scores are 0.
    """
    mean_scores = scores.groupBy("method", "feature").agg(F.avg("score").alias("score"))
    mean_quality = quality.groupBy("method").agg(F.avg("auc_pr").alias("auc_pr"))
    total = F.sum("auc_pr").over(W.partitionBy(F.lit(1)))  # one row per method
    weights = mean_quality.select(
        "method", (F.col("auc_pr") / F.when(total == 0, 1.0).otherwise(total)).alias("weight")
    )
    final = (
        mean_scores.join(weights, "method")
        .groupBy("feature")
        .agg(F.sum(F.col("score") * F.col("weight")).alias("score_final"))
    )
    order = W.orderBy(F.round("score_final", 12).desc(), "feature")  # one row per feature
    return final.withColumn("rank_final", F.row_number().over(order))


def feature_sets(ranked: DataFrame, sizes: Sequence[int] = (5,)) -> dict[str, list[str]]:
    """The best features for each requested size, best first."""
    names = [r["feature"] for r in ranked.orderBy("rank_final").select("feature").collect()]
    return {f"top_{k}": names[:k] for k in sizes}


def mutual_information(
    df: DataFrame,
    label: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    bins: int = 10,
) -> DataFrame:
    """Mutual information with the label, in nats, from counts over all rows.

    Numbers are cut at exact quantiles, missing ones count as the median. Missing
    categories are a level of their own.
    """
    edges: dict[str, list[float]] = {}
    medians: dict[str, float] = {}
    if numeric:
        probs = {f"q{i}": i / bins for i in range(1, bins)} | {"median": 0.5}
        rows = exact_quantiles(features_long(df, numeric), "value", probs, ["feature"]).collect()
        for r in rows:  # one row per feature
            edges[r["feature"]] = sorted({r[f"q{i}"] for i in range(1, bins)})
            medians[r["feature"]] = r["median"]

    def level(c: str):
        if c in categorical:
            return F.coalesce(F.col(c).cast("string"), F.lit("<null>"))
        x = F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c)), F.lit(0.0))
        passed = F.lit(0)
        for e in edges.get(c, []):
            passed = passed + F.when(x > e, 1).otherwise(0)
        return passed.cast("string")

    entries = [
        F.struct(F.lit(c).alias("feature"), level(c).alias("level"))
        for c in [*categorical, *numeric]
    ]
    cells = (
        df.filter(F.col(label).isNotNull())
        .select(F.col(label).cast("int").alias("y"), F.inline(F.array(*entries)))
        .groupBy("feature", "level", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # levels are reduced to sums of c*ln(c), so no window over all levels of a feature:
    # MI = ln N + (sum n_xy ln n_xy - sum n_x ln n_x - sum n_y ln n_y) / N
    per_level = cells.groupBy("feature", "level").agg(
        F.sum("n").alias("nx"),
        F.sum(F.col("n") * F.log(F.col("n").cast("double"))).alias("xy"),
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("y1"),
    )
    per_feature = per_level.groupBy("feature").agg(
        F.sum("nx").cast("double").alias("n"),
        F.sum("xy").alias("xy"),
        F.sum(F.col("nx") * F.log(F.col("nx").cast("double"))).alias("x"),
        F.sum("y1").cast("double").alias("y1"),
    )

    def c_ln_c(c):
        return F.when(c > 0, c * F.log(c)).otherwise(0.0)

    n, y1 = F.col("n"), F.col("y1")
    mi = F.log(n) + (F.col("xy") - F.col("x") - c_ln_c(y1) - c_ln_c(n - y1)) / n
    return per_feature.select("feature", F.greatest(mi, F.lit(0.0)).alias("mi"))


def _pair_sums(cols: Sequence[str], mean: np.ndarray, width: np.ndarray):
    """Sums over all pairs of columns in a task, each over rows where both are filled.

    Values are centred and scaled first, so that no digits are lost in the sums. The sums of a task
    are a few matrices of (columns x columns), whatever its rows.
    """
    d = len(cols)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((5, d, d))
        for batch in batches:
            filled = np.column_stack([~np.asarray(c.is_null()) for c in batch.columns]).astype(float)
            x = np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            odd = np.isnan(x) & (filled > 0)
            x = np.where((filled > 0) & ~odd, (x - mean) / width, 0.0)
            total += filled.T @ filled, x.T @ filled, (x * x).T @ filled, x.T @ x, odd.T.astype(float) @ filled
        i, j = np.triu_indices(d)
        n, x, xx, xy, odd = total
        values = [n[i, j], x[i, j], x[j, i], xx[i, j], xx[j, i], xy[i, j], odd[i, j] + odd[j, i]]
        names = ["i", "j", "n", "x", "y", "xx", "yy", "xy", "odd"]
        ends = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32))]
        yield pa.RecordBatch.from_arrays([*ends, *map(pa.array, values)], names=names)

    return run


def pearson_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every ordered pair, each over rows where both are filled.

    One aggregate centres the columns, one scan adds up the matrix of all pairs, so hundreds of
    columns are as few jobs as three. Pairs without variation have no row; NaN in a column gives NaN.
    """
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    plain = [F.when(~F.isnan(c), F.col(c)) for c in cols]
    one = rows.agg(
        *[F.avg(x).alias(f"m{i}") for i, x in enumerate(plain)],
        *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(plain)],
    ).first()
    # a column without values, or with a single one, has no correlation
    kept = [i for i in range(len(cols)) if one[f"s{i}"] is not None and one[f"s{i}"] > CONSTANT * abs(one[f"m{i}"])]
    spark = df.sparkSession
    if not kept:
        return spark.createDataFrame([], "feature_a string, feature_b string, correlation double")
    names = [cols[i] for i in kept]
    mean, width = (np.array([one[f"{v}{i}"] for i in kept]) for v in "ms")
    sums = ["n", "x", "y", "xx", "yy", "xy", "odd"]
    schema = "i int, j int, " + ", ".join(f"{c} double" for c in sums)
    found = rows.select(names).mapInArrow(_pair_sums(names, mean, width), schema)
    found = found.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in sums])
    n, x, y = F.col("n"), F.col("x"), F.col("y")
    vary_x, vary_y = F.col("xx") - x * x / n, F.col("yy") - y * y / n
    value = (F.col("xy") - x * y / n) / F.sqrt(vary_x * vary_y)
    # within the rows of a pair a column may be constant, but for rounding
    varies = (n > 1) & (F.least(vary_x, vary_y) > CONSTANT * n)
    value = F.when(F.col("odd") > 0, F.lit(float("nan"))).when(varies, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), value)))
    half = found.filter(n > 0).select("i", "j", value.alias("correlation")).filter(F.col("correlation").isNotNull())
    named = F.array(*[F.lit(c) for c in names])
    both = half.unionByName(half.filter("i <> j").select(F.col("j").alias("i"), F.col("i").alias("j"), "correlation"))
    return both.select(
        F.get(named, F.col("i")).alias("feature_a"), F.get(named, F.col("j")).alias("feature_b"), "correlation"
    )

