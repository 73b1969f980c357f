import random

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quotelift.functions import fold_of, hash_fraction
from quotelift.operators import cluster, features, profile, selection
from quotelift.session import scratch_path


def test_split_is_stable_and_complete(spark):
    df = spark.range(20000).withColumn("seg", F.lit("S"))
    for fn in ("xxhash64", "md5"):
        once = features.hash_split(df, ["id", "seg"], fn=fn)
        again = features.hash_split(df.repartition(5), ["id", "seg"], fn=fn)
        assert once.exceptAll(again).count() == 0
        assert abs(once.filter("is_valid").count() / 20000 - 0.2) < 0.02
        other = features.hash_split(df, ["id", "seg"], salt="other", fn=fn)
        assert once.exceptAll(other).count() > 0
    with pytest.raises(ValueError):
        hash_fraction(["id"], "s", "crc")


def test_folds_partition_the_ids(spark):
    df = features.kfold(spark.range(1000), "id", 4, 42)
    assert {r["fold"] for r in df.select("fold").distinct().collect()} == {0, 1, 2, 3}
    assert df.select(F.count_if(F.col("fold") != fold_of("id", 4, 42))).first()[0] == 0


def test_sample_and_complement_are_disjoint(spark):
    df = spark.range(2000).withColumn("label", (F.col("id") % 2).cast("int"))
    sample = features.stratified_sample(df, "label", {0: 0.7, 1: 0.7}, 42).cache()
    rest = features.sample_complement(df, sample, "id")
    assert sample.count() + rest.count() == 2000
    assert sample.join(rest, "id").count() == 0


def test_top_values_and_truncation(spark):
    rows = [("a",)] * 5 + [("b",)] * 3 + [("c",)] * 3 + [("d",)] + [(None,)] * 9 + [(" ",)] * 9
    df = spark.createDataFrame(rows, "v string")
    assert [r["value"] for r in features.top_values(df, "v", 2).collect()] == ["a", "b"]
    out = features.truncate_high_cardinality(df, "v", 2)
    assert {r["v"]: r["count"] for r in out.groupBy("v").count().collect()} == {"a": 5, "b": 3, "OUTROS": 22}


def test_truncate_fit_many_columns(spark):
    rows = [(str(i % 20), str(i % 3), None if i % 2 else " ") for i in range(400)]
    df = spark.createDataFrame(rows, "big string, small string, empty string")
    lists = features.truncate_fit(df, ["big", "small", "empty"], threshold=15, n=10)
    assert list(lists) == ["big"]
    assert lists["big"] == sorted(str(i) for i in range(20))[:10]
    out = features.truncate_apply(df, lists | {"small": ["0"]}, numeric=["small"])
    assert out.filter("small = '1'").count() > 0
    assert features.truncate_fit(df, []) == {}


def test_feature_plan(spark):
    rows = [(i, "k", str(i % 20), None if i < 95 else 1.0, float(i)) for i in range(100)]
    model = spark.createDataFrame(rows, "id int, same string, big string, rare double, x double")
    wanted = {"same": True, "big": True, "rare": True, "x": True, "id": False, "gone": True}
    plan = features.fit_features(model, wanted)
    assert plan.dropped_null == ["rare"] and plan.dropped_constant == ["same"]
    assert plan.categorical == ["big"] and plan.numeric == ["x"]
    unseen = spark.createDataFrame([(1, "z", "new", 2.0, 3.0)], model.schema)
    assert plan.apply(unseen).collect() == [(1, "OUTROS", 3.0)]
    off = features.fit_features(model, wanted, {"PP_R04": False, "PP_R05": False, "PP_R06": False})
    assert off.categorical == ["same", "big"] and off.numeric == ["rare", "x"] and off.lists == {}


def test_class_weights(spark):
    df = spark.createDataFrame([(1.0,)] + [(0.0,)] * 4, "label double")
    auto = features.class_weights(df, "label")
    assert sorted(r["weight"] for r in auto.collect()) == [1.0] * 4 + [pytest.approx(4.0)]
    even = spark.createDataFrame([(1.0,), (0.0,)], "label double")
    assert {r["weight"] for r in features.class_weights(even, "label").collect()} == {1.0}
    assert {r["weight"] for r in features.class_weights(df, "label", False).collect()} == {1.0}
    none = spark.createDataFrame([(0.0,)], "label double")
    assert features.class_weights(none, "label", True).first()["weight"] == 1.0


def test_vectors_keep_unknown_categories(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), ("a", 3.0)], "c string, x double")
    fitted = features.preprocess_stages(["c"], ["x"]).fit(df)
    unseen = spark.createDataFrame([("zz", None)], df.schema)
    out = fitted.transform(unseen).select(vector_to_array("features_vec").alias("v")).first()["v"]
    assert out == [0.0, 0.0, 1.0, 2.0]
    assert selection.slot_features(fitted.transform(df)) == ["c", "c", "c", "x"]
    assert features.all_null_columns(df.withColumn("n", F.lit(None).cast("double")), ["x", "n"]) == ["n"]


def test_profiles(spark):
    df = spark.createDataFrame([("a", 1), (" ", None), (None, 1), ("a", 2)], "t string, n int")
    rows = {r["column_name"]: r for r in profile.profile_nulls(df, ["t"]).collect()}
    assert (rows["t"]["n_empty"], rows["t"]["n_distinct"]) == (2, 3)
    assert (rows["n"]["n_empty"], rows["n"]["n_distinct"]) == (1, None)
    card = {r["column_name"]: r["n_distinct"] for r in profile.cardinality(df, ["t", "n"]).collect()}
    assert card == {"t": 2, "n": 2}
    approx = {r["column_name"]: r["n_distinct"] for r in profile.cardinality(df, ["t", "n"], True).collect()}
    assert approx == card
    share = {(r["t"], r["n"]): r["share"] for r in profile.status_share(df, "t", "n").collect()}
    assert share[("a", 1)] == 0.5 and share[(None, 1)] == 1.0


def test_feature_histogram_matches_numpy(spark):
    rnd = random.Random(5)
    values = [rnd.choice([0.3, 0.6, 0.9, rnd.random() * 3]) for _ in range(500)]
    df = spark.createDataFrame([(v, 7.0) for v in values] + [(None, 7.0)], "x double, flat double")
    rows = profile.feature_histogram(df, ["x", "flat"]).collect()
    want, edges = np.histogram(values, bins=50)
    got = {r["bin"]: r for r in rows if r["feature"] == "x"}
    assert [got[i]["n_rows"] if i in got else 0 for i in range(50)] == list(want)
    assert got[49]["mean"] == pytest.approx(np.mean(values))
    assert got[49]["median"] == pytest.approx(np.median(values))
    assert got[49]["bin_start"] == pytest.approx(edges[49])
    assert [(r["bin"], r["n_rows"]) for r in rows if r["feature"] == "flat"] == [(0, 501)]


def test_status_month_pivot_finds_statuses(spark):
    df = spark.createDataFrame([("2024-01-05", "a"), ("2024-01-06", " A"), ("2024-02-01", "b"), (None, "a")], "d string, s string")
    out = profile.status_month_pivot(df.withColumn("d", F.to_date("d")), "d", "s").orderBy("month")
    assert out.collect() == [("2024-01", 2, 0), ("2024-02", 0, 1)]


@pytest.fixture(scope="module")
def blobs(spark):
    rnd = random.Random(11)
    rows = [(i, 10.0 * (i % 3) + rnd.random(), 5.0 * (i % 3) + rnd.random(), 1.0) for i in range(150)]
    return spark.createDataFrame(rows, "id int, a double, b double, flat double").cache()


def test_scalers(blobs):
    a = np.array([r["a"] for r in blobs.orderBy("id").collect()])
    want = {
        "standard": (a - a.mean()) / a.std(),
        "log1p_standard": (np.log1p(a) - np.log1p(a).mean()) / np.log1p(a).std(),
        "robust": (a - np.median(a)) / (np.quantile(a, 0.75) - np.quantile(a, 0.25)),
    }
    for strategy, values in want.items():
        scaler = cluster.fit_scaler(blobs, ["a", "flat"], strategy)
        out = scaler.apply(blobs).orderBy("id").collect()
        assert np.allclose([r["a"] for r in out], values)
        assert np.allclose([r["flat"] for r in out], 0.0)
        back = blobs.select(scaler.original("a", scaler.scaled("a")).alias("o"), "a").collect()
        assert np.allclose([r["o"] for r in back], [r["a"] for r in back])
    with pytest.raises(ValueError):
        cluster.fit_scaler(blobs, ["a"], "minmax")
    for strategy in want:
        with pytest.raises(ValueError, match="no values"):
            cluster.fit_scaler(blobs.withColumn("e", F.lit(None).cast("double")), ["e"], strategy)


def test_cluster_nulls(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, None)], "id int, x double")
    assert cluster.cluster_nulls(df, ["x"]).count() == 2
    filled = cluster.cluster_nulls(df, ["x"], "impute_median")
    assert filled.filter("id = 3").first()["x"] == 2.0
    with pytest.raises(ValueError):
        cluster.cluster_nulls(df, ["x"], "zero")


def test_kmeans(spark, blobs):
    fit = cluster.kmeans_fit(blobs, ["a", "b"], 3, "standard", restarts=3)
    rows = fit.assigned.collect()
    found = {frozenset(r["id"] for r in rows if r["cluster"] == c) for c in "012"}
    assert found == {frozenset(range(k, 150, 3)) for k in range(3)}
    assert fit.silhouette > 0.9
    summary = cluster.cluster_summary(fit.assigned, ["a", "b"], "cluster", fit.scaler).collect()
    for r in summary:
        a = [x["a"] for x in rows if x["cluster"] == r["cluster"]]
        assert r["n_entities"] == 50
        assert r["a_centroid"] == pytest.approx(np.mean(a)) and r["a_median"] == pytest.approx(np.median(a))
    quotes = spark.createDataFrame([(1, 1), (2, 2), (3, 999)], "quote int, id int")
    cover = cluster.cluster_coverage(cluster.attach_cluster(quotes, fit.assigned, "id", "clf"), "clf").first()
    assert (cover["n_clustered"], cover["coverage"], cover["low"]) == (2, 0.6667, True)
    sweep = cluster.kmeans_sweep(blobs, ["a", "b"], [2, 3], ["standard"], 2).collect()
    assert sweep[1]["inertia"] < sweep[0]["inertia"] and sweep[1]["silhouette"] > sweep[0]["silhouette"]


def test_reloaded_clusters_give_the_same_labels(spark, blobs):
    fit = cluster.kmeans_fit(blobs, ["a", "b"], 3, "log1p_standard", restarts=1)
    path = scratch_path(spark, "clusters")
    cluster.save_clusters(fit, path)
    again = cluster.label_entities(blobs, *cluster.load_clusters(path))
    assert again.exceptAll(fit.assigned.select(*again.columns)).count() == 0


def test_rank_score_and_ensemble(spark):
    rows = [("m1", 1, "a", 3.0), ("m1", 1, "b", 1.0), ("m1", 1, "b", 4.0), ("m1", 1, "c", 0.0), ("m2", 1, "a", 1.0)]
    found = spark.createDataFrame(rows, "method string, seed int, feature string, importance double")
    scores = selection.rank_score(found, ["a", "b", "c", "d"], ["method", "seed"]).cache()
    got = {(r["method"], r["feature"]): r["score"] for r in scores.collect()}
    assert got[("m1", "b")] == 1.0 and got[("m1", "a")] == 0.5 and got[("m1", "c")] == 0.0
    assert got[("m1", "d")] == 0.0 and got[("m2", "a")] == 1.0 and len(got) == 8
    quality = spark.createDataFrame([("m1", 1, 0.6), ("m2", 1, 0.2)], "method string, seed int, auc_pr double")
    ranked = selection.ensemble_rank(scores, quality).orderBy("rank_final").collect()
    assert [r["feature"] for r in ranked] == ["b", "a", "c", "d"]
    assert ranked[0]["score_final"] == pytest.approx(0.75)
    sets = selection.feature_sets(selection.ensemble_rank(scores, quality), [2])
    assert sets == {"top_2": ["b", "a"]}
    flat = quality.withColumn("auc_pr", F.lit(0.0))
    assert {r["score_final"] for r in selection.ensemble_rank(scores, flat).collect()} == {0.0}


def test_mutual_information(spark):
    rows = [(i % 2, "ab"[i % 2], "k", float(i % 2), float(i % 7)) for i in range(140)]
    df = spark.createDataFrame(rows, "label int, same string, flat string, x double, noise double")
    out = selection.mutual_information(df, "label", ["same", "flat"], ["x", "noise"])
    mi = {r["feature"]: r["mi"] for r in out.collect()}
    assert mi["same"] == pytest.approx(np.log(2)) and mi["x"] == pytest.approx(np.log(2))
    assert mi["flat"] == pytest.approx(0.0, abs=1e-12) and mi["noise"] == pytest.approx(0.0, abs=1e-12)


def test_pearson_is_pairwise(spark):
    rows = [(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.0, 0.0), (4.0, None, 5.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in selection.pearson_long(df, ["a", "b", "c"]).collect()}
    assert got[("a", "b")] == pytest.approx(1.0)
    assert got[("c", "a")] == pytest.approx(np.corrcoef([2, 3, 4], [1, 0, 5])[0, 1])


def test_pearson_of_many_columns_with_gaps(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(1e6, 1.0, (400, 60)) @ np.diag(rng.uniform(0.1, 50, 60))
    x[:, 1] = 3 * x[:, 0] + rng.normal(0, 1, 400)
    x[rng.random(x.shape) < 0.2] = np.nan
    names = [f"c{i}" for i in range(60)]
    rows = [[None if np.isnan(v) else float(v) for v in r] + [7.0, None] for r in x]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in [*names, "same", "none"])).repartition(3)
    got = {(r[0], r[1]): r[2] for r in selection.pearson_long(df, [*names, "same", "none"]).collect()}
    assert len(got) == 3600 and not any({"same", "none"} & set(k) for k in got)
    for i, j in [(0, 1), (5, 9), (59, 3), (7, 7)]:
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        assert got[f"c{i}", f"c{j}"] == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)


def test_label_audit(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (2.0,), (None,)], "label double")
    assert tuple(selection.label_audit(df, "label").first()) == (4, 2)


@pytest.mark.parametrize("partitions", ["1", "4", "17"])
def test_ensemble_rank_does_not_depend_on_partitions(spark, small, partitions):
    from quotelift.plans.queries import QUERIES

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = QUERIES["ensemble_rank"](spark, small).orderBy("rank_final").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    keys = [(-round(r["score_final"], 6), r["feature"]) for r in got]
    assert keys == sorted(keys)


def test_numbers_kept_as_text_are_not_truncated(spark):
    rows = spark.createDataFrame([(str(i), f"p{i % 3}") for i in range(40)], "qty string, product string")
    plan = features.fit_features(rows, {"qty": True, "product": True}, counted=["qty"])
    assert plan.numeric == ["qty"] and plan.categorical == ["product"] and "qty" not in plan.lists
    assert plan.apply(rows).select("qty").distinct().count() == 40
