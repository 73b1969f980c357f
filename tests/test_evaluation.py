import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quotelift.operators import evaluation as ev
from quotelift.operators import ordering


@pytest.fixture(scope="module")
def scored(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(357):
        s = None if i % 40 == 7 else rnd.choice([0.07, 0.29, 0.5, 0.58, 1.0, 0.0, round(rnd.random(), 4)])
        y = int(rnd.random() < (0.2 + 0.6 * (s or 0)))
        rows.append((i, y, s))
    return spark.createDataFrame(rows, "id int, label int, score double").cache()


def arrays(df):
    rows = df.orderBy("id").collect()
    y = np.array([r["label"] for r in rows])
    s = np.array([np.nan if r["score"] is None else r["score"] for r in rows])
    return y, s


def test_threshold_sweep(scored):
    y, s = arrays(scored)
    got = {round(r["threshold"], 2): r for r in ev.threshold_sweep(scored, "label", "score").collect()}
    assert sorted(got) == [round(v / 100, 2) for v in range(1, 100)]
    for t, r in got.items():
        hat = s >= t
        tp, fp = int((hat & (y == 1)).sum()), int((hat & (y == 0)).sum())
        assert (r["tp"], r["fp"]) == (tp, fp)
        assert (r["fn"], r["tn"]) == (int((y == 1).sum()) - tp, int((y == 0).sum()) - fp)


def test_threshold_nulls(spark):
    df = spark.createDataFrame([(0, 0.3), (0, 0.2)], "label int, score double")
    curve = ev.threshold_sweep(df, "label", "score")
    row = curve.filter("threshold = 0.25").first()
    assert row["precision"] == 0.0 and row["recall"] is None and row["f1"] is None
    assert curve.filter("threshold = 0.9").first()["precision"] is None
    choice = ev.select_threshold(curve, "max_f1")
    assert choice.count() == 0
    with pytest.raises(ValueError):
        ev.require_threshold(choice, "max_f1")
    with pytest.raises(ValueError):
        ev.select_threshold(curve, "best")


def test_select_threshold_ties(spark):
    rows = [(0.1, 0.5, 0.9, 0.6, 0.7), (0.2, 0.6, 0.8, 0.6, 0.7), (0.3, 0.9, 0.8, 0.5, None)]
    curve = spark.createDataFrame(rows, "threshold double, precision double, recall double, f1 double, f2 double")
    assert ev.select_threshold(curve, "max_f1").first()["threshold"] == 0.1
    assert ev.select_threshold(curve, "max_f2").first()["threshold"] == 0.1
    assert ev.select_threshold(curve, "precision_ge_target", 0.55).first()["threshold"] == 0.2


def curve_points(y, s):
    keep = ~np.isnan(s)
    y, s = y[keep], s[keep]
    points = []
    for t in sorted(set(s), reverse=True):
        hat = s >= t
        points.append((t, (y[hat] == 1).mean(), (hat & (y == 1)).sum() / max((y == 1).sum(), 1)))
    return points


def test_average_precision_and_area(scored):
    y, s = arrays(scored)
    pts = curve_points(y, s)
    ap, area, p0, r0 = 0.0, 0.0, 1.0, 0.0
    for _, p, r in pts:
        ap += (r - r0) * p
        area += (r - r0) * (p + p0) / 2
        p0, r0 = p, r
    row = ev.average_precision(scored, "label", "score").first()
    assert row["ap"] == pytest.approx(ap) and row["auc_pr"] == pytest.approx(area)
    curve = ev.pr_curve(scored, "label", "score").orderBy(F.desc("threshold")).collect()
    assert np.allclose([(r["threshold"], r["precision"], r["recall"]) for r in curve], pts)


def test_average_precision_extremes(spark):
    one_class = spark.createDataFrame([(1, 0.2), (1, 0.7)], "label int, score double")
    assert ev.average_precision(one_class, "label", "score").first()["ap"] == 1.0
    none = spark.createDataFrame([(0, 0.2), (0, 0.7)], "label int, score double")
    assert ev.average_precision(none, "label", "score").first()["ap"] == 0.0
    equal = spark.createDataFrame([(0, 0.5), (1, 0.5)], "label int, score double")
    assert ev.average_precision(equal, "label", "score").first()["ap"] == 0.5


def test_average_precision_by_row_differs_on_ties(spark):
    df = spark.createDataFrame([(1, 1, 0.5), (2, 0, 0.5), (3, 1, 0.1)], "id int, label int, score double")
    by_row = ev.average_precision_rows(df, "label", "score", "id").first()["ap"]
    assert by_row == pytest.approx((1 / 1 + 2 / 3) / 2)
    by_score = ev.average_precision(df, "label", "score").first()["ap"]
    assert by_score == pytest.approx(0.5 * 0.5 + 0.5 * 2 / 3)


@pytest.mark.parametrize("n", [1, 3, 50, 57, 250])
def test_topk_curves(spark, n):
    rnd = random.Random(n)
    rows = [("m", i + 1, rnd.randint(0, 1), n) for i in range(n)]
    df = spark.createDataFrame(rows, "model_id string, score_rank int, label int, total int")
    y = np.array([r[2] for r in rows])
    got = {r["k_pct"]: r for r in ev.topk_curves(df, "label", "score_rank").collect()}
    assert sorted(got) == list(range(1, 101))
    for k, r in got.items():
        top = max(1, min(round(k / 100.0 * n), n))
        tp = int(y[:top].sum())
        assert (r["top_n"], r["tp"], r["fp"]) == (top, tp, top - tp), (n, k)
        assert (r["fn"], r["tn"]) == (int(y.sum()) - tp, n - int(y.sum()) - (top - tp))


def test_topk_step_and_unranked(spark):
    df = spark.createDataFrame([("m", 1, 1, 4), ("m", None, 1, 4), ("m", 2, 0, 4), ("m", 3, 0, 4)], "model_id string, score_rank int, label int, total int")
    got = {r["k_pct"]: (r["top_n"], r["tp"], r["fn"]) for r in ev.topk_curves(df, "label", "score_rank", step=25).collect()}
    assert got == {1: (1, 1, 1), 26: (1, 1, 1), 51: (2, 1, 1), 76: (3, 1, 1)}


def test_topk_by_group_skips_groups_without_positives(spark):
    rows = [("a", 1, 1, 0.9), ("a", 2, 0, 0.1), ("b", 3, 0, 0.9)]
    df = spark.createDataFrame(rows, "g string, id int, label int, score double")
    out = ev.topk_by_group(df, "label", "score", "id", ["g"])
    assert {r["g"] for r in out.collect()} == {"a"}


def test_overlap(spark):
    rnd = random.Random(1)
    n = 77
    a, b = list(range(1, n + 1)), list(range(1, n + 1))
    rnd.shuffle(a)
    rnd.shuffle(b)
    df = spark.createDataFrame(list(zip(a, b)), "ra int, rb int")
    for r in ev.overlap_at_k(df, ["ra", "rb"], F.lit(n)).collect():
        top = max(1, min(round(r["k_pct"] / 100.0 * n), n))
        assert r["n_overlap"] == sum(x <= top and y <= top for x, y in zip(a, b))


def test_rank_correlation(spark):
    rows = [(1, 4), (2, 3), (3, 2), (4, 1)]
    out = ev.rank_correlation(spark.createDataFrame(rows, "rank_global_x int, rank_global_y int"), ["rank_global_x", "rank_global_y"])
    assert {(r["model_a"], r["model_b"]): round(r["rho"], 9) for r in out.collect()} == {
        ("x", "x"): 1.0,
        ("x", "y"): -1.0,
        ("y", "x"): -1.0,
        ("y", "y"): 1.0,
    }


def test_score_histogram(scored):
    _, s = arrays(scored)
    want, _ = np.histogram(s[~np.isnan(s)], bins=np.linspace(0, 1, 51), density=True)
    got = {r["bin"]: r["density"] for r in ev.score_histogram(scored.withColumn("g", F.lit(1)), "score", ["g"]).collect()}
    for i, d in enumerate(want):
        assert got.get(i, 0.0) == pytest.approx(d), i


def test_cluster_metrics_need_both_classes(spark):
    rows = [("a", "m", 1, 0.9), ("a", "m", 0, 0.1), ("b", "m", 1, 0.9), ("b", "m", 1, 0.2), ("c", "m", 1, None), (None, "m", 1, 0.1)]
    df = spark.createDataFrame(rows, "cluster string, model_id string, label int, score double")
    out = {r["cluster"]: r for r in ev.cluster_metrics(df, "label", "score", "cluster").collect()}
    assert sorted(out) == ["a", "b", "c"]
    assert out["a"]["ap"] == 1.0 and out["b"]["ap"] is None and out["c"]["ap"] is None
    curve = ev.pr_curve_by_cluster(df, "label", "score", "cluster")
    assert {r["cluster"] for r in curve.collect()} == {"a"}


def test_stats_use_sample_and_population_deviation(spark):
    df = spark.createDataFrame([("a", 0.0), ("a", 1.0), ("a", None)], "g string, score double")
    assert ev.score_stats(df, "score", ["g"]).first()["std"] == pytest.approx(np.std([0, 1], ddof=1))
    row = ev.score_stats_by_cluster(df, "score", ["g"]).first()
    assert row["std"] == pytest.approx(0.5) and row["p25"] == pytest.approx(0.25)


def test_point_at_threshold_and_selection(spark):
    curve = spark.createDataFrame([(0.2, 1.0), (0.4, 2.0)], "threshold double, x double")
    assert ev.point_at_threshold(curve, 0.3).first()["threshold"] == 0.2
    quality = spark.createDataFrame([("m", 0.5, 0.6)], "model_id string, ap double, auc_pr double")
    topk = spark.createDataFrame([("m", k, 0.1 * k, 0.2, 0.3) for k in (1, 11, 21)], "model_id string, k_pct int, p_at_k double, r_at_k double, lift_at_k double")
    assert ev.model_selection(quality, topk, reference_k=15, step=10).first()["k_pct"] == 11
    gap = ev.overfit_gap(quality, quality).first()
    assert gap["gap_ap"] == 0.0


def test_wide_ranks_match_window(spark):
    rows = [(i, (i * 37 % 11) / 10.0) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, s double")
    ranked = ordering.top_ranked(ordering.global_rank(df, "s", "id"), "rank", 3).collect()
    want = sorted(rows, key=lambda r: (-r[1], r[0]))[:3]
    assert [r["id"] for r in ranked] == [r[0] for r in want]
