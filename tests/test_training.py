import random
import threading

import pytest
from pyspark.sql import functions as F

from quotelift.operators import features, selection, together, training
from quotelift.session import scratch_path


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(2)
    out = []
    for i in range(600):
        x = rnd.random()
        out.append((i, float(x + 0.2 * rnd.random() > 0.8), rnd.choice(["a", "b", " "]), x if i % 9 else None, str(i % 30)))
    df = spark.createDataFrame(out, "id int, label double, kind string, x double, office string")
    return features.class_weights(df, "label").cache()


COMBOS = training.grid([2], [0.1, 0.05])


@pytest.fixture(scope="module")
def fitted(rows):
    clean = rows.withColumn("kind", F.nullif(F.trim("kind"), F.lit("")))
    lists = features.truncate_fit(clean, ["office"])
    ready = features.truncate_apply(clean, lists)
    return training.train_final(ready, "label", ["kind", "office"], ["x"], lists, COMBOS, iterations=3)


def test_model_ids():
    assert [c.model_id for c in training.grid()] == ["d4_s01", "d4_s005", "d6_s01", "d6_s005"]


def test_cv_grid(rows):
    out = training.cv_grid(rows, "id", "label", ["kind"], ["x"], COMBOS, iterations=2).collect()
    assert [r["model_id"] for r in out] == ["d2_s01", "d2_s005"]
    assert all(0 < r["auc_pr_mean"] <= 1 and r["auc_pr_std"] >= 0 for r in out)


def test_train_quality(fitted):
    quality = {r["model_id"]: r for r in fitted[1].collect()}
    assert set(quality) == {"d2_s01", "d2_s005"}
    assert all(r["ap"] > 0.7 and r["n_scored"] == 600 for r in quality.values())


def test_score_wide(rows, fitted):
    out = training.score_wide(rows, fitted[0], "id", {"mode_code": "D"}).cache()
    assert out.count() == 600
    for m in fitted[0].models:
        got = out.select(f"p_emitida_{m}", f"rank_global_{m}", "id").collect()
        assert all(0 <= r[0] <= 1 for r in got)
        assert sorted(r[1] for r in got) == list(range(1, 601))
        by_rank = sorted(got, key=lambda r: r[1])
        assert by_rank == sorted(got, key=lambda r: (-r[0], r[2]))
    assert {r["mode_code"] for r in out.collect()} == {"D"}


def test_scoring_truncates_like_training(spark, fitted):
    df = spark.createDataFrame([(1, " ", "0.5", "never seen")], "id int, kind string, x string, office string")
    ready = training.prepare_scoring(df, fitted[0]).first()
    assert ready["kind"] is None and ready["x"] == 0.5 and ready["office"] == "OUTROS"
    with pytest.raises(ValueError):
        training.score_models(df.drop("x"), fitted[0], "id")


def test_reload_gives_equal_scores(spark, rows, fitted):
    path = scratch_path(spark, "models")
    training.save_models(fitted[0], path)
    again = training.load_models(path)
    assert (again.categorical, again.numeric, again.lists) == (
        fitted[0].categorical, fitted[0].numeric, fitted[0].lists
    )
    a = training.score_models(rows, fitted[0], "id")
    b = training.score_models(rows, again, "id")
    assert a.exceptAll(b).count() == 0


def test_selection_methods(rows):
    methods = {
        "lr_l1": {"maxIter": 10, "regParam": 0.01, "elasticNetParam": 1.0},
        "rf": {"numTrees": 5, "maxDepth": 3},
        "gbt": {"maxIter": 2, "maxDepth": 2, "stepSize": 0.1},
    }
    with_empty = rows.withColumn("empty", F.lit(None).cast("double"))
    found, quality = selection.fs_methods(with_empty, "id", "label", ["kind"], ["x", "empty"], methods, [42, 7])
    assert quality.count() == 6
    assert quality.filter("ap between 0 and 1 and auc_pr between 0 and 1").count() == 6
    scores = selection.rank_score(found, ["kind", "x", "empty"], ["method", "seed"])
    best = selection.ensemble_rank(scores, quality).orderBy("rank_final").first()
    assert best["feature"] == "x"
    with pytest.raises(ValueError):
        selection.fs_methods(rows, "id", "label", [], ["x"], {"svm": {}}, [1])


def test_rank_refuses_a_repeated_key(spark):
    rows = spark.createDataFrame([(1, 0.9), (1, 0.2), (2, 0.5)], "k int, p_emitida_m double")
    with pytest.raises(Exception, match="several rows"):
        training.rank_models(rows, "k").collect()


def test_column_without_values_does_not_stop_the_fits(spark):
    rows = spark.createDataFrame(
        [(i, float(i % 2), 1.0, "a" if i % 3 else "b", float(i), None) for i in range(60)],
        "id long, label double, weight double, c string, x double, empty double",
    )
    one = [training.Combo(2, 0.1)]
    cv = training.cv_grid(rows, "id", "label", ["c"], ["x", "empty"], one, iterations=2)
    assert cv.count() == 1
    models, _ = training.train_final(rows, "label", ["c"], ["x", "empty"], None, one, iterations=2)
    assert models.numeric == ["x"] and training.score_models(rows, models, "id").count() == 60


def test_fits_that_memory_does_not_hold_run_one_by_one(spark, rows, monkeypatch):
    """Each fit caches its rows: how many run side by side follows from rows and memory."""
    room = together.cache_room(spark)
    assert room > 100 << 20
    assert together.fits_in_memory(spark, 100_000, 35) > 1
    assert together.fits_in_memory(spark, 10, 35, 3) == 3
    assert together.fits_in_memory(spark, room // 400, 35) == 1 == together.fits_in_memory(spark, 10**10, 35)
    lock, running, most = threading.Lock(), [], []
    fit = training.GBTClassifier.fit

    def counted(self, df):
        with lock:
            running.append(1)
            most.append(len(running))
        try:
            return fit(self, df)
        finally:
            with lock:
                running.pop()

    monkeypatch.setattr(training.GBTClassifier, "fit", counted)
    monkeypatch.setattr(together, "cache_room", lambda spark: 1)
    found = training.cv_grid(rows, "id", "label", ["kind"], ["x"], COMBOS, iterations=1)
    training.train_final(rows, "label", ["kind"], ["x"], None, COMBOS, iterations=1)
    methods = {"gbt": {"maxIter": 1, "maxDepth": 2}, "rf": {"numTrees": 3, "maxDepth": 2}}
    selection.fs_methods(rows, "id", "label", ["kind"], ["x"], methods, [1, 2])
    assert found.count() == 2 and len(most) == 4 + 2 + 2 and set(most) == {1}
