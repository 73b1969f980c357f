import numpy as np
import pyarrow as pa
import pyspark.ml.classification as ml
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quotelift.operators import boosting, features, selection, training

PLAIN = {"featuresCol": "features_vec", "labelCol": "label", "weightCol": "weight", "seed": 5}


@pytest.fixture(scope="module")
def vectors(spark):
    rnd = np.random.default_rng(4)
    x, kind = rnd.integers(-6, 12, 700), rnd.integers(0, 4, 700)
    y = rnd.random(700) < 1 / (1 + np.exp(-(x - 3) * np.where(kind == 2, -0.5, 0.4)))
    rows = [
        (float(b), float(w), "abcd"[k], float(v) if v < 11 else None, float(z))
        for b, w, k, v, z in zip(y, rnd.uniform(0.5, 2, 700), kind, x, rnd.integers(0, 9, 700))
    ]
    df = spark.createDataFrame(rows, "label double, weight double, kind string, x double, z double").repartition(3)
    fitted = features.preprocess_stages(["kind"], ["x", "z"]).fit(df)
    return fitted.transform(df).select("label", "weight", "features_vec").cache()


@pytest.mark.parametrize("weighted", [True, False])
def test_trees_are_those_of_spark(vectors, weighted, monkeypatch):
    """Without a sample nothing is drawn: both methods give the same trees."""
    monkeypatch.setattr(boosting, "LEAST_ROWS", 0)
    settings = PLAIN | {"maxDepth": 4, "maxIter": 7, "stepSize": 0.2, "subsamplingRate": 1.0}
    if not weighted:
        del settings["weightCol"]
    own, spark_model = boosting.GBTClassifier(**settings).fit(vectors), ml.GBTClassifier(**settings).fit(vectors)
    assert own.totalNumNodes == spark_model.totalNumNodes and own.treeWeights == spark_model.treeWeights
    p = vector_to_array("probability")[1]
    scored = own.transform(vectors).select("*", p.alias("p")).drop("rawPrediction", "probability", "prediction")
    far = spark_model.transform(scored).agg(F.max(F.abs(p - F.col("p")))).first()[0]
    assert far < 1e-9
    assert own.featureImportances.toArray() == pytest.approx(spark_model.featureImportances.toArray(), abs=1e-9)


def test_fit_keeps_a_few_bytes_a_row(spark, vectors, monkeypatch):
    """Spark's fit caches a row as objects, of some 240 bytes and 4 for each slot."""
    many = vectors.select("label", "weight", "features_vec", F.explode(F.sequence(F.lit(1), F.lit(60))).alias("i"))
    many = many.repartition(4, "i").drop("i")
    info = lambda: {r.id(): r.memSize() + r.diskSize() for r in spark.sparkContext._jsc.sc().getRDDStorageInfo()}
    before, held, run = set(info()), [], boosting.Boost._pass

    def noted(self, *args):
        out = run(self, *args)
        held.append(sum(b for i, b in info().items() if i not in before))
        return out

    monkeypatch.setattr(boosting.Boost, "_pass", noted)
    monkeypatch.setattr(boosting, "LEAST_ROWS", 0)
    training._gbt(training.Combo(3, 0.1), 7, "label", 1).fit(many)
    assert held and 0 < max(held) < 2 * 40 * 700 * 60
    assert not set(info()) - before
    assert selection.GBTClassifier is training.GBTClassifier is boosting.GBTClassifier


class Rows:
    """Blocks of one process."""

    def __init__(self, blocks):
        self.blocks = list(blocks)

    def persist(self, level):
        return self

    def unpersist(self):
        pass

    def mapPartitions(self, run):
        return Rows(run(iter(self.blocks)))

    def map(self, run):
        return Rows(run(b) for b in self.blocks)

    def getNumPartitions(self):
        return 1

    def collect(self):
        return self.blocks


def test_ways_down_agree(monkeypatch):
    """Masks, levels and slots that meet in one column lead each row to the same leaf."""
    rnd = np.random.default_rng(1)
    values = np.where(rnd.random((900, 6)) < 0.5, 0.0, rnd.integers(-3, 4, (900, 6))).astype(float)
    label = np.where(values[:, 0] * values[:, 3] + values[:, 1] + rnd.normal(size=900) > 0, 1, -1).astype(np.int8)
    dense = pa.StructArray.from_arrays(
        [
            pa.array([1] * 900, pa.int8()),
            pa.array([None] * 900, pa.int32()),
            pa.array([None] * 900, pa.list_(pa.int32())),
            pa.array(list(values), pa.list_(pa.float64())),
        ],
        names=["type", "size", "indices", "values"],
    )
    limits = [boosting.limits_of(values[:, s], np.ones(900), 31) for s in range(6)]

    def trees(column, depth, many):
        bins = boosting.Bins(limits, np.array(column))
        codes = bins.encode(dense)
        pieces = [slice(0, 400), slice(400, 900)]
        blocks = [boosting.Block((0, i), codes[:, p], label[p], None, np.zeros(len(label[p]))) for i, p in enumerate(pieces)]
        fit = boosting.Boost(Rows(blocks), bins, depth, 0.8, 3)
        monkeypatch.setattr(boosting, "SUMS_BYTES", many)
        grown = [fit.grow(i, 0.3, 0) for i in range(6)]
        fit.finish(6)
        return [[(r[0], round(r[1], 9), r[4], *r[6:]) for r in boosting.node_rows(t)] for t in grown]

    for depth in (3, 7):
        want = trees(range(6), depth, 1 << 26)
        assert len(want[0]) > 2 * depth
        # leaves hold all sampled rows of their tree
        assert all(sum(r[2] for r in t if r[3] < 0) == t[0][2] for t in want)
        # in nodes of a few rows splits are equal but for rounding, after the first tree
        some = slice(None) if depth == 3 else slice(1)
        assert trees([0] * 6, depth, 1 << 26)[some] == want[some] == trees([0, 0, 1, 1, 0, 2], depth, 1)[some]


def test_limits_are_those_of_spark():
    assert list(boosting.limits_of(np.array([1.0, 1.0, 3.0, 2.0]), np.ones(4), 31)) == [1.5, 2.5]
    assert not len(boosting.limits_of(np.zeros(3), np.ones(3), 31))
    even = boosting.limits_of(np.arange(320.0), np.ones(320), 31)
    assert len(even) == 31 and list(even[:2]) == [9.5, 19.5]
