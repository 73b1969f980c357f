"""Shared-scan k-means against plain Lloyd steps and definitions; fits that run together."""

import threading

import numpy as np
import pytest

from quotelift.operators import cluster, kmeans
from quotelift.operators.together import run_together

COLS = ["x", "y"]


def points(spark, values):
    return spark.createDataFrame([tuple(map(float, v)) for v in values], "x double, y double")


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(1)
    middle = rng.uniform(-5, 5, (6, 2))
    return middle[rng.integers(0, 6, 600)] + rng.normal(0, 0.6, (600, 2))


def lloyd(x, centers):
    for _ in range(200):
        label = ((x[:, None] - centers) ** 2).sum(axis=2).argmin(axis=1)
        centers = np.array([x[label == i].mean(axis=0) if (label == i).any() else c for i, c in enumerate(centers)])
    return ((x[:, None] - centers) ** 2).sum(axis=2).min(axis=1).sum(), label


def silhouette(x, label):
    far = ((x[:, None] - x) ** 2).sum(axis=2)
    out = []
    for i, own in enumerate(label):
        same = label == own
        if same.sum() == 1:
            out.append(0.0)
            continue
        a = far[i, same].sum() / (same.sum() - 1)
        b = min(far[i, label == c].mean() for c in set(label) if c != own)
        out.append((b - a) / max(a, b))
    return float(np.mean(out))


def test_inertia_and_silhouette_by_definition(spark, cloud):
    frame = points(spark, cloud).repartition(3)
    fits = kmeans.fit_all(frame, {"a": COLS, "b": ["y", "x"]}, [2, 6], 4, 7)
    assert [(f.space, f.k) for f in fits] == [("a", 2), ("a", 6), ("b", 2), ("b", 6)]
    for f in fits:
        x = cloud if f.space == "a" else cloud[:, ::-1]
        far = ((x[:, None] - f.centers) ** 2).sum(axis=2)
        assert f.inertia == pytest.approx(far.min(axis=1).sum())
        assert f.silhouette == pytest.approx(silhouette(x, far.argmin(axis=1)))
        rng = np.random.default_rng(3)
        single = min(lloyd(x, x[rng.choice(len(x), f.k, replace=False)])[0] for _ in range(10))
        assert f.inertia <= 1.01 * single


def test_a_run_can_be_repeated_whatever_the_partitions(spark, cloud):
    one, two = (kmeans.fit_all(points(spark, cloud).repartition(n), {"a": COLS}, [3], 3, 11)[0] for n in (1, 5))
    assert np.allclose(np.sort(one.centers, axis=0), np.sort(two.centers, axis=0))


def test_scans_grow_with_steps_and_not_with_fits(spark, cloud, monkeypatch):
    scans = []
    plain = kmeans._Scan.sums
    monkeypatch.setattr(kmeans._Scan, "sums", lambda self, groups: scans.append(len(groups)) or plain(self, groups))
    fits = kmeans.fit_all(points(spark, cloud), {"a": COLS}, [2, 3, 4, 5], 5, 7)
    assert max(scans) == 20 and len(scans) <= max(f.steps for f in fits) + kmeans.DRAWS + 33


def test_few_values_repeated_points_and_no_points(spark):
    few = points(spark, [(1, 1)] * 30 + [(5, 5)] * 3)
    fit = kmeans.fit_all(few, {"a": COLS}, [4], 2, 1)[0]
    assert len(fit.centers) == 2 and fit.inertia == pytest.approx(0) and fit.silhouette == pytest.approx(1)
    same = kmeans.fit_all(points(spark, [(2, 3)] * 9), {"a": COLS}, [2], 2, 1)[0]
    assert same.centers.tolist() == [[2, 3]] and same.silhouette == 0
    with pytest.raises(ValueError, match="no points"):
        kmeans.fit_all(points(spark, []), {"a": COLS}, [2], 1, 1)
    missing = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "x double, y double")
    with pytest.raises(Exception, match="missing values"):
        kmeans.fit_all(missing, {"a": COLS}, [2], 1, 1)
    with pytest.raises(ValueError, match="differ"):
        kmeans.fit_all(few, {"a": COLS, "b": ["x"]}, [2], 1, 1)


def test_nearest_takes_the_first_of_equal_centres(spark):
    df = spark.createDataFrame([(0.0, 0.0), (9.0, 0.0)], "x double, y double")
    scaler = cluster.Scaler("standard", {"x": (0.0, 1.0), "y": (0.0, 1.0)})
    model = cluster.Centers(((1.0, 0.0), (-1.0, 0.0), (9.0, 1.0)))
    assert [r["cluster"] for r in cluster.label_entities(df, scaler, model).collect()] == ["0", "2"]


def test_jobs_run_together_in_order_and_bounded(spark):
    running, most, lock = [0], [0], threading.Lock()

    def job(i):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        n = spark.range(100 + i).repartition(2).count()
        with lock:
            running[0] -= 1
        return n

    got = run_together(spark, [lambda i=i: job(i) for i in range(7)], in_flight=3)
    assert got == [100 + i for i in range(7)] and 1 < most[0] <= 3
    assert run_together(spark, []) == []

    def fail():
        raise RuntimeError("no fit")

    with pytest.raises(RuntimeError, match="no fit"):
        run_together(spark, [fail, lambda: 1], in_flight=1)
