"""Entity clustering: NULL strategy, scaling, K sweep, final fit, summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quotelift.operators import kmeans
from quotelift.operators.columns import replace_columns
from quotelift.operators.ordering import exact_quantiles
from quotelift.operators.profile import features_long
from quotelift.plans import fixed_values as fv
from quotelift.session import load_note, materialize, save_note

CONSTANT = 1e-12  # relative deviation under which a feature counts as constant
SCALINGS = ("standard", "log1p_standard", "robust")


def cluster_nulls(df: DataFrame, cols: Sequence[str], strategy: str = "drop") -> DataFrame:
    """Drop entities with a missing feature, or fill them with the exact median."""
    if strategy == "drop":
        return df.dropna(subset=list(cols))
    if strategy != "impute_median":
        raise ValueError(f"unknown NULL strategy {strategy!r}")
    medians = {
        r["feature"]: r["median"]
        for r in exact_quantiles(
            features_long(df, cols), "value", {"median": 0.5}, ["feature"]
        ).collect()  # one row per feature
    }
    return replace_columns(
        df, {c: F.coalesce(F.col(c).cast("double"), F.lit(medians.get(c))) for c in cols}
    )


@dataclass(frozen=True)
class Scaler:
    """Center and width per feature, learned on the whole table."""

    strategy: str
    params: Mapping[str, tuple[float, float]]

    def scaled(self, c: str) -> Column:
        center, width = self.params[c]
        x = F.col(c).cast("double")
        x = F.log1p(x) if self.strategy == "log1p_standard" else x
        return (x - F.lit(center)) / F.lit(width)

    def original(self, c: str, value: float | Column) -> Column:
        """Back from scaled to original units."""
        center, width = self.params[c]
        x = (value if isinstance(value, Column) else F.lit(float(value))) * width + center
        return F.expm1(x) if self.strategy == "log1p_standard" else x

    def apply(self, df: DataFrame) -> DataFrame:
        return replace_columns(df, {c: self.scaled(c) for c in self.params})


def fit_scaler(df: DataFrame, cols: Sequence[str], strategy: str) -> Scaler:
    """Mean and population deviation, the same after ``log1p``, or median and IQR.

    A constant feature keeps width 1. Only two numbers per feature reach the driver.
    """
    if strategy not in SCALINGS:
        raise ValueError(f"unknown scaling {strategy!r}")
    if strategy == "robust":
        q = exact_quantiles(
            features_long(df, cols),
            "value",
            {"lo": 0.25, "mid": 0.5, "hi": 0.75},
            ["feature"],
        )
        found = {r["feature"]: (r["mid"], r["hi"] - r["lo"]) for r in q.collect()}
    else:
        x = {c: F.col(c).cast("double") for c in cols}
        if strategy == "log1p_standard":
            x = {c: F.log1p(v) for c, v in x.items()}
        row = df.agg(
            *[F.avg(v).alias(f"{c}__m") for c, v in x.items()],
            *[F.stddev_pop(v).alias(f"{c}__s") for c, v in x.items()],
        ).first()
        found = {c: (row[f"{c}__m"], row[f"{c}__s"]) for c in cols}

    empty = [c for c in cols if found.get(c, (None,))[0] is None]
    if empty:
        raise ValueError(f"no values to scale in {empty}")

    def width_of(center: float, width: float) -> float:
        # rounding leaves a constant feature with a tiny deviation instead of none
        return 1.0 if width <= CONSTANT * abs(center) else width

    return Scaler(strategy, {c: (found[c][0], width_of(*found[c])) for c in cols})


def scale(df: DataFrame, cols: Sequence[str], strategy: str) -> DataFrame:
    return fit_scaler(df, cols, strategy).apply(df)


def _spaces(df: DataFrame, scalers: Sequence[Scaler]) -> tuple[DataFrame, dict[str, list[str]]]:
    """The scaled features of all scalings as double columns, written once, and their names."""
    named = {x.strategy: {c: f"_{i}_{j}" for j, c in enumerate(x.params)} for i, x in enumerate(scalers)}
    columns = [x.scaled(c).alias(named[x.strategy][c]) for x in scalers for c in x.params]
    return materialize(df.select(columns), "points"), {s: list(cols.values()) for s, cols in named.items()}


def kmeans_sweep(
    df: DataFrame,
    cols: Sequence[str],
    ks: Sequence[int] = tuple(fv.CLUSTER_COUNTS),
    strategies: Sequence[str] = SCALINGS,
    restarts: int = fv.CLUSTER_RESTARTS,
    seed: int = fv.CLUSTER_SEED,
) -> DataFrame:
    """Inertia and silhouette for each scaling and K, all fits moved by one scan per step."""
    base = materialize(df.select(*cols), "entities")
    points, spaces = _spaces(base, [fit_scaler(base, cols, s) for s in strategies])
    fits = kmeans.fit_all(points, spaces, ks, restarts, seed)
    rows = [(f.space, f.k, f.inertia, f.silhouette) for f in fits]
    schema = "scaling string, k int, inertia double, silhouette double"
    return df.sparkSession.createDataFrame(rows, schema)


@dataclass(frozen=True)
class Centers:
    """Cluster centres in scaled units, one list of coordinates each."""

    values: tuple[tuple[float, ...], ...]

    def nearest(self, x: Sequence[Column]) -> Column:
        """Number of the nearest centre; of equally near ones the first."""
        far = [sum(((a - F.lit(v)) * (a - F.lit(v)) for a, v in zip(x, c, strict=True)), F.lit(0.0)) for c in self.values]
        return F.array_min(F.array(*[F.struct(d.alias("far"), F.lit(i).alias("number")) for i, d in enumerate(far)]))["number"]


@dataclass
class ClusterFit:
    scaler: Scaler
    model: Centers
    assigned: DataFrame  # entity, features, cluster
    inertia: float
    silhouette: float


def kmeans_fit(
    df: DataFrame,
    cols: Sequence[str],
    k: int,
    strategy: str,
    restarts: int = fv.CLUSTER_RESTARTS,
    seed: int = fv.CLUSTER_SEED,
) -> ClusterFit:
    """Final clustering; ``assigned`` carries the cluster as text next to the features."""
    scaler = fit_scaler(df, cols, strategy)
    points, spaces = _spaces(df, [scaler])
    fit = kmeans.fit_all(points, spaces, [k], restarts, seed)[0]
    model = Centers(tuple(tuple(map(float, c)) for c in fit.centers))
    assigned = materialize(label_entities(df, scaler, model), "clusters")
    return ClusterFit(scaler, model, assigned, fit.inertia, fit.silhouette)


def save_clusters(fit: ClusterFit, path: str) -> None:
    """Scaler and centres, enough to label entities in another session."""
    kept = {"strategy": fit.scaler.strategy, "params": dict(fit.scaler.params), "centers": fit.model.values}
    save_note(SparkSession.active(), kept, f"{path}/clusters")


def load_clusters(path: str) -> tuple[Scaler, Centers]:
    kept = load_note(SparkSession.active(), f"{path}/clusters")
    params = {c: (center, width) for c, (center, width) in kept["params"].items()}
    return Scaler(kept["strategy"], params), Centers(tuple(map(tuple, kept["centers"])))


def label_entities(df: DataFrame, scaler: Scaler, model: Centers) -> DataFrame:
    """Add the cluster as text; features must be filled as they were for the fit."""
    found = model.nearest([scaler.scaled(c) for c in scaler.params])
    return df.withColumn("cluster", found.cast("string")).select(*df.columns, "cluster")


def attach_cluster(df: DataFrame, assigned: DataFrame, entity: str, out: str) -> DataFrame:
    """Left join of the cluster label; entities without a cluster keep NULL."""
    labels = assigned.filter(F.col(entity).isNotNull()).select(
        entity, F.lit(0).cast("long").alias("_spare"), F.col("cluster").alias(out)
    )
    # rows without an entity would all hash to one task; they match nothing anyway
    spare = F.when(F.col(entity).isNull(), F.xxhash64(*df.columns)).otherwise(F.lit(0))
    return df.withColumn("_spare", spare).join(labels, [entity, "_spare"], "left").drop("_spare")


def cluster_coverage(df: DataFrame, cluster: str) -> DataFrame:
    """Rows with a cluster and their share; ``low`` marks a share under 0.80."""
    share = F.round(F.try_divide(F.count(cluster), F.count(F.lit(1))), 4)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(cluster).alias("n_clustered"),
        F.coalesce(share, F.lit(0.0)).alias("coverage"),
    ).withColumn("low", F.col("coverage") < fv.MIN_CLUSTER_COVERAGE)


def cluster_summary(
    assigned: DataFrame, cols: Sequence[str], cluster: str, scaler: Scaler
) -> DataFrame:
    """Size, centroid in original units and exact median of each feature per cluster.

    The centroid is the mean of the scaled values, turned back; for the log scaling that
    is not the plain mean of the feature.
    """
    centroids = assigned.groupBy(cluster).agg(
        F.count(F.lit(1)).alias("n_entities"), *[F.avg(scaler.scaled(c)).alias(c) for c in cols]
    )
    entries = [
        F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in cols
    ]
    long = assigned.select(cluster, F.inline(F.array(*entries)))
    medians = exact_quantiles(long, "value", {"median": 0.5}, [cluster, "feature"])
    wide = medians.groupBy(cluster).agg(
        *[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"{c}_median") for c in cols]
    )
    return centroids.select(
        cluster,
        "n_entities",
        *[scaler.original(c, F.col(c)).alias(f"{c}_centroid") for c in cols],
    ).join(wide, cluster)
