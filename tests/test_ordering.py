import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from quotelift.operators import ordering


@pytest.fixture(scope="module", autouse=True)
def many_chunks(spark):
    """Small data would be merged into one chunk; keep all of them apart here."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share one score and half are in one group; some NULLs."""
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        score = 0.5 if i % 3 == 0 else (None if i % 50 == 1 else round(rnd.random(), 3))
        group = "hot" if i % 2 == 0 else rnd.choice(["x", "y", None])
        rows.append((i, group, score, rnd.randint(0, 1)))
    return spark.createDataFrame(rows, "id int, g string, s double, y int").cache()


def naive(df, by, out):
    w = W.partitionBy(*by) if by else W.partitionBy(F.lit(1))
    return df.withColumn(out, F.row_number().over(w.orderBy(F.desc_nulls_last("s"), "id")))


def test_global_rank(hot):
    got = {r["id"]: r["rank"] for r in ordering.global_rank(hot, "s", "id").collect()}
    want = {r["id"]: r["rank"] for r in naive(hot, [], "rank").collect()}
    assert got == want and sorted(got.values()) == list(range(1, 3001))


def test_local_rank_with_null_group(hot):
    got = {r["id"]: r["rank"] for r in ordering.local_rank(hot, "s", "id", ["g"]).collect()}
    want = {r["id"]: r["rank"] for r in naive(hot, ["g"], "rank").collect()}
    assert got == want


def test_chunks_share_a_hot_value(hot):
    sizes = ordering.ordered_chunks(hot, [F.desc_nulls_last("s"), F.col("id")]).groupBy("_chunk").count()
    assert sizes.agg(F.max("count")).first()[0] < 1000  # the hot score alone has 1000 rows


def test_merged_chunks_keep_the_order(spark, hot):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "12kb")
    try:
        chunks = ordering.ordered_chunks(hot, [F.desc_nulls_last("s"), F.col("id")])
        got = {r["id"]: r["rank"] for r in ordering.global_rank(hot, "s", "id").collect()}
        assert 1 < chunks.select("_chunk").distinct().count() < 8
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    assert got == {r["id"]: r["rank"] for r in naive(hot, [], "rank").collect()}


def test_running_totals(hot):
    got = ordering.running_totals(
        hot.withColumn("one", F.lit(1)), [F.desc_nulls_last("s"), F.col("id")], {"hits": "y", "seen": "one"}, ["g"]
    ).collect()
    w = W.partitionBy("g").orderBy(F.desc_nulls_last("s"), "id").rowsBetween(W.unboundedPreceding, 0)
    want = {r["id"]: (r["h"], r["n"]) for r in hot.select("id", F.sum("y").over(w).alias("h"), F.count("id").over(w).alias("n")).collect()}
    assert {r["id"]: (r["hits"], r["seen"]) for r in got} == want
    totals = {(r["g"], r["seen_total"]) for r in got}
    assert totals == {(r["g"], r["count"]) for r in hot.groupBy("g").count().collect()}


def test_exact_quantiles(hot):
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.77, "e": 1.0}
    for r in ordering.exact_quantiles(hot, "s", probs, ["g"]).collect():
        same = F.col("g").eqNullSafe(F.lit(r["g"]))
        values = [x["s"] for x in hot.filter(same & F.col("s").isNotNull()).collect()]
        assert np.allclose([r[n] for n in probs], np.quantile(values, list(probs.values())))


def test_one_row_and_no_rows(spark):
    one = spark.createDataFrame([(1, 0.5)], "id int, s double")
    assert ordering.global_rank(one, "s", "id").first()["rank"] == 1
    assert ordering.exact_quantiles(one, "s", {"m": 0.5}).first()["m"] == 0.5
    assert ordering.global_rank(one.limit(0), "s", "id").count() == 0


def test_clashing_column_names(spark):
    df = spark.createDataFrame([(1, 0.5, 3)], "id int, s double, _n int")
    assert ordering.global_rank(df, "s", "id").columns == ["id", "s", "_n", "rank"]


def test_bracketed_quantiles_equal_sorted_ones(spark, monkeypatch):
    """Skewed groups, ties, NULL groups, NaN, and brackets that do not hold."""
    rng = np.random.default_rng(8)
    rows = [("big", float(x)) for x in rng.lognormal(0, 2, 4000)] + [("ties", float(x)) for x in rng.integers(0, 3, 500)]
    rows += [(None, float(x)) for x in range(7)] + [("one", 4.5), ("none", None), ("nan", float("nan")), ("nan", 1.0)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(3)
    probs = {"lo": 0.0, "q1": 0.25, "mid": 0.5, "q99": 0.99, "hi": 1.0}
    as_rows = lambda d: sorted(tuple(map(repr, r)) for r in d.select("g", *probs).collect())
    want = as_rows(ordering.sorted_quantiles(df, "x", probs, ["g"]))
    assert as_rows(ordering.exact_quantiles(df, "x", probs, ["g"])) == want
    big = np.array([x for g, x in rows if g == "big"])
    got = {r["g"]: r for r in ordering.exact_quantiles(df, "x", probs, ["g"]).collect()}
    assert [got["big"][n] for n in probs] == pytest.approx(np.quantile(big, list(probs.values())))
    monkeypatch.setattr(ordering, "SKETCH_ERROR", 0.0)
    monkeypatch.setattr(ordering, "SKETCH_SIZE", 8)
    assert as_rows(ordering.exact_quantiles(df, "x", probs, ["g"])) == want


def test_quantiles_have_no_global_sort_and_no_shuffle_of_all_values(spark, monkeypatch):
    plans = []
    plain = ordering.materialize
    monkeypatch.setattr(ordering, "materialize", lambda d, n: plans.append(d._jdf.queryExecution().executedPlan().toString()) or plain(d, n))
    df = spark.range(20_000).select((F.col("id") % 4999).cast("double").alias("x"))
    assert ordering.exact_quantiles(df, "x", {"mid": 0.5}).first()["mid"] == np.median(np.arange(20_000) % 4999)
    assert len(plans) == 2 and not any("rangepartitioning" in p for p in plans)
