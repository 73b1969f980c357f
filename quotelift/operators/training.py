"""Cross validation, final fits and multi-model batch scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from itertools import product
from statistics import fmean, pstdev

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelift.operators import boosting
from quotelift.operators.boosting import GBTClassifier
from quotelift.operators.columns import blanks_to_null, cast_double, unpivot_scores
from quotelift.operators.evaluation import average_precision
from quotelift.operators.features import all_null_columns, kfold, preprocess_stages, slot_count, truncate_apply
from quotelift.operators.ordering import local_rank
from quotelift.operators.together import BLOCK_ROW_BYTES, IN_FLIGHT, fits_in_memory, run_together
from quotelift.plans import fixed_values as fv
from quotelift.session import load_note, materialize, save_note, spread


@dataclass(frozen=True)
class Combo:
    """One grid point; the id is used in score and rank column names."""

    depth: int
    step: float

    @property
    def model_id(self) -> str:
        return f"d{self.depth}_s{str(self.step).replace('.', '')}"


def grid(
    depths: Sequence[int] = tuple(fv.GRID_DEPTHS), steps: Sequence[float] = tuple(fv.GRID_STEPS)
) -> list[Combo]:
    return [Combo(d, s) for d, s in product(depths, steps)]


def _gbt(combo: Combo, iterations: int, label: str, seed: int) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features_vec",
        labelCol=label,
        weightCol="weight",
        maxDepth=combo.depth,
        stepSize=combo.step,
        maxIter=iterations,
        subsamplingRate=fv.SUBSAMPLING,
        seed=seed,
    )


def _at_once(spark: SparkSession, rows: Sequence[int], slots: int, columns: int, in_flight: int) -> int:
    """How many fits memory holds: those of few rows are Spark's own, with a value for each slot."""
    if min(rows) < boosting.LEAST_ROWS:
        return fits_in_memory(spark, max(rows), slots, in_flight)
    return fits_in_memory(spark, max(rows), columns, in_flight, BLOCK_ROW_BYTES)


def cv_grid(
    df: DataFrame,
    key: str,
    label: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    combos: Sequence[Combo] | None = None,
    iterations: int = fv.GRID_ITERATIONS,
    folds: int = fv.CV_FOLDS,
    seed: int = fv.CV_SEED,
    in_flight: int = IN_FLIGHT,
) -> DataFrame:
    """AUC-PR per grid point: mean and population deviation over hash folds.

    The folds are prepared once each and written; then all fits of all folds run side by side, at
    most ``in_flight`` of them and no more than memory holds.

    Preprocessing is fitted on the training part of each fold; a numeric column without any
    value there is left out. The area is exact, from counts per distinct score. ``df`` needs
    ``weight``.
    """
    spark = df.sparkSession
    combos = list(combos or grid())
    with_fold = spread(kfold(df, key, folds, seed).select("fold", label, "weight", *categorical, *numeric))

    def prepare(i: int) -> tuple[DataFrame, DataFrame, int]:
        train, valid = with_fold.filter(F.col("fold") != i), with_fold.filter(F.col("fold") == i)
        empty = all_null_columns(train, numeric)
        prepared = preprocess_stages(categorical, [c for c in numeric if c not in empty]).fit(train)
        # written once: a lost executor costs a read, not the preprocessing
        vectors = prepared.transform(train).select(label, "weight", "features_vec")
        held = prepared.transform(valid).select(label, "features_vec")
        return materialize(vectors, "fold-train"), materialize(held, "fold-valid"), slot_count(vectors)

    parts = run_together(spark, [partial(prepare, i) for i in range(folds)], in_flight)
    rows, slots = [train.count() for train, _, _ in parts], max(n for _, _, n in parts)  # from the files' footers
    in_flight = _at_once(spark, rows, slots, len(categorical) + len(numeric), in_flight)

    def fit(i: int, combo: Combo) -> DataFrame:
        train, valid, _ = parts[i]
        model = _gbt(combo, iterations, label, seed).fit(train)
        scored = model.transform(valid).select(
            F.lit(i).alias("fold"),
            F.lit(combo.model_id).alias("model_id"),
            label,
            vector_to_array("probability")[1].alias("score"),
        )
        return materialize(scored, "fold-scores")

    tasks = [partial(fit, i, combo) for i in range(folds) for combo in combos]
    scored = reduce(DataFrame.unionByName, run_together(spark, tasks, in_flight))
    areas: dict[str, list[float]] = {c.model_id: [] for c in combos}
    # one row per fold and grid point
    for r in average_precision(scored, label, "score", ["model_id", "fold"]).orderBy("fold").collect():
        areas[r["model_id"]].append(float(r["auc_pr"]))
    rows = [
        (c.model_id, c.depth, c.step, fmean(areas[c.model_id]), pstdev(areas[c.model_id]))
        for c in combos
    ]
    schema = "model_id string, max_depth int, step_size double, auc_pr_mean double, auc_pr_std double"
    return spark.createDataFrame(rows, schema)


@dataclass
class ScoringSet:
    """Everything scoring needs: fitted models by id and what was learned in training."""

    categorical: list[str]
    numeric: list[str]
    lists: dict[str, list[str]]
    models: dict[str, PipelineModel]


def train_final(
    df: DataFrame,
    label: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    lists: Mapping[str, Sequence[str]] | None = None,
    combos: Sequence[Combo] | None = None,
    iterations: int = fv.FINAL_ITERATIONS,
    seed: int = fv.CV_SEED,
    in_flight: int = IN_FLIGHT,
) -> tuple[ScoringSet, DataFrame]:
    """Fit every grid point on all model rows; no winner is chosen.

    Preprocessing does not depend on the grid point and is fitted once. Also returns the
    training quality ``model_id, ap, auc_pr`` for the overfit gap.
    """
    spark = df.sparkSession
    rows = spread(df.select(label, "weight", *categorical, *numeric))
    # a column without any value cannot be filled in and teaches nothing
    empty = all_null_columns(rows, numeric)
    numeric = [c for c in numeric if c not in empty]
    prepared = preprocess_stages(categorical, numeric).fit(rows)
    assembled = prepared.transform(rows).select(label, "weight", "features_vec")
    vectors = materialize(assembled, "train-vectors")
    columns = len(categorical) + len(numeric)
    in_flight = _at_once(spark, [vectors.count()], slot_count(assembled), columns, in_flight)
    combos = list(combos or grid())

    def fit(combo: Combo) -> tuple[GBTClassificationModel, DataFrame]:
        model = _gbt(combo, iterations, label, seed).fit(vectors)
        scored = model.transform(vectors).select(
            F.lit(combo.model_id).alias("model_id"),
            label,
            vector_to_array("probability")[1].alias("score"),
        )
        return model, materialize(scored, "train-scores")

    fitted = run_together(spark, [partial(fit, c) for c in combos], in_flight)
    models = {c.model_id: PipelineModel(stages=[*prepared.stages, m]) for c, (m, _) in zip(combos, fitted, strict=True)}
    scored = reduce(DataFrame.unionByName, [s for _, s in fitted])
    quality = materialize(average_precision(scored, label, "score", ["model_id"]), "train-quality")
    learned = {c: list(v) for c, v in (lists or {}).items()}
    return ScoringSet(list(categorical), list(numeric), learned, models), quality


def save_models(models: ScoringSet, path: str) -> None:
    """All that scoring needs: one folder per model, and features, lists and ids beside them."""
    for model_id, model in models.models.items():
        model.write().overwrite().save(f"{path}/{model_id}")
    kept = {
        "categorical": list(models.categorical),
        "numeric": list(models.numeric),
        "lists": {c: list(v) for c, v in models.lists.items()},
        "model_ids": list(models.models),
    }
    save_note(SparkSession.active(), kept, f"{path}/scoring_set")


def load_models(path: str) -> ScoringSet:
    """The scoring set of a folder; nothing of the session that trained it is needed."""
    kept = load_note(SparkSession.active(), f"{path}/scoring_set")
    models = {m: PipelineModel.load(f"{path}/{m}") for m in kept["model_ids"]}
    return ScoringSet(kept["categorical"], kept["numeric"], kept["lists"], models)


def prepare_scoring(df: DataFrame, models: ScoringSet) -> DataFrame:
    """Clean scoring rows as in training: blanks, casts, learned lists."""
    clean = cast_double(blanks_to_null(df, models.categorical), models.numeric)
    return truncate_apply(clean, models.lists, numeric=models.numeric)


def score_models(df: DataFrame, models: ScoringSet, key: str) -> DataFrame:
    """Key and one score column per model, chained on one frame (no join per model)."""
    missing = [c for c in [*models.categorical, *models.numeric] if c not in df.columns]
    if missing:
        raise ValueError(f"features missing from the input: {missing}")
    out = prepare_scoring(df, models).select(key, *models.categorical, *models.numeric)
    kept = out.columns
    scores: list[str] = []
    for model_id, model in models.models.items():
        name = f"{fv.SCORE_PREFIX}{model_id}"
        scored = model.transform(out)
        out = scored.select(*kept, *scores, vector_to_array("probability")[1].alias(name))
        scores.append(name)
    return out.select(key, *scores)


def rank_models(scores: DataFrame, key: str) -> DataFrame:
    """Add one rank column per score column.

    All models are ranked in one range-partitioned sort over ``(model, score)``, then
    folded back to one row per key. A key that stands on several rows is an error: their
    scores would be merged. Rows without a key are ranked but do not come out.
    """
    long = unpivot_scores(scores, [key], fv.SCORE_PREFIX, fv.RANK_PREFIX).drop("score_rank")
    ranked = local_rank(long, "score", key, ["model_id"], "score_rank")
    names = [c[len(fv.SCORE_PREFIX) :] for c in scores.columns if c.startswith(fv.SCORE_PREFIX)]

    def of(model: str, col: str):
        mine = F.when(F.col("model_id") == model, F.col(col))
        return F.when(F.count_if(F.col("model_id") == model) <= 1, F.max(mine)).otherwise(
            F.raise_error(F.concat(F.lit(f"several rows to rank under one {key}: "), F.col(key).cast("string")))
        )

    return ranked.filter(F.col(key).isNotNull()).groupBy(key).agg(
        *[of(m, "score").alias(f"{fv.SCORE_PREFIX}{m}") for m in names],
        *[of(m, "score_rank").cast("int").alias(f"{fv.RANK_PREFIX}{m}") for m in names],
    )


def attach_scores(
    df: DataFrame, ranked: DataFrame, key: str, metadata: Mapping[str, str] | None = None
) -> DataFrame:
    """Wide table: input columns, scores and ranks per model, run metadata literals."""
    # rows without a key match nothing; a spread value keeps them from meeting in one task
    spare = F.when(F.col(key).isNull(), F.xxhash64(*df.columns)).otherwise(F.lit(0))
    right = ranked.filter(F.col(key).isNotNull()).withColumn("_spare", F.lit(0).cast("long"))
    wide = df.withColumn("_spare", spare).join(right, [key, "_spare"], "left").drop("_spare")
    return wide.withColumns({name: F.lit(value) for name, value in (metadata or {}).items()})


def score_wide(
    df: DataFrame, models: ScoringSet, key: str, metadata: Mapping[str, str] | None = None
) -> DataFrame:
    """Score all models and attach scores and ranks, one row per input row."""
    # scoring is the costly part: keep its narrow result, the rank sort reads it twice
    scores = materialize(score_models(df, models, key), "scores")
    return attach_scores(df, rank_models(scores, key), key, metadata)
