from datetime import date, datetime

from pyspark.sql import functions as F

from quotelift.operators import joins, temporal
from quotelift.plans import catalog

HISTORY = [
    # quote, seq, day, status
    ("a", 1, 1, "EM ANALISE"),
    ("a", 2, 5, "Emitida"),
    ("a", 3, 8, "EM ANALISE"),
    ("a", 4, 9, "emitida "),
    ("b", 5, 2, "Em Negociação"),  # idle for more than the limit
    ("c", 6, 10, None),
    ("d", 7, 3, "Perdida"),
    ("d", 8, 3, "Emitida"),  # equal time, larger tie wins
    ("e", 9, 1, "Em analise"),
]


def history(spark):
    rows = [(q, s, datetime(2024, 1, d), st) for q, s, d, st in HISTORY]
    return spark.createDataFrame(rows, "q string, seq int, ts timestamp, st string")


def test_latest_and_entries(spark):
    df = history(spark)
    latest = {r["q"]: r["seq"] for r in temporal.latest_snapshot(df, "q", "ts", "seq").collect()}
    assert latest == {"a": 4, "b": 5, "c": 6, "d": 8, "e": 9}
    entries = temporal.first_status_entry(df, "q", "ts", "st", {"i": "EMITIDA", "l": "PERDIDA"})
    got = {r["q"]: (r["i"], r["l"]) for r in entries.collect()}
    assert got["a"] == (datetime(2024, 1, 5), None)
    assert got["d"] == (datetime(2024, 1, 3), datetime(2024, 1, 3))
    assert got["c"] == (None, None)


def test_null_time_loses(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 0, datetime(2024, 1, 1))], "q string, seq int, ts timestamp")
    assert temporal.latest_snapshot(df, "q", "ts", "seq").first()["seq"] == 0


def test_temporal_rule(spark):
    df = history(spark).withColumnsRenamed({"st": "DS_GRUPO_STATUS", "ts": "TS_ARQ"})
    df = df.withColumn("DT_VALIDADE", F.lit("20/01/2024")).withColumn("DATA_COTACAO", F.lit("2024-01-01"))
    # limit 8: b is idle for 8 days (kept), e for 9 (closed)
    out = {r["q"]: r for r in catalog.temporal_rule(df, "q", tie="seq", stale_days=8).collect()}
    assert out["b"]["DS_GRUPO_STATUS"] == "Em Negociação" and out["b"]["FL_PERDIDA_90D"] is False
    assert out["e"]["DS_GRUPO_STATUS"] == "Perdida" and out["e"]["FL_PERDIDA_90D"] is True
    assert out["e"]["DS_GRUPO_STATUS_OLD"] == "Em analise"
    assert out["e"]["REF_DATE"] == date(2024, 1, 1)  # closed late: its snapshot date
    assert out["a"]["REF_DATE"] == date(2024, 1, 5)  # first entry, not the latest
    assert out["a"]["DIAS_VALIDADE"] == 15 and out["a"]["DIAS_COTACAO"] == -4
    assert out["c"]["DIAS_ULTIMA_ATUALIZACAO"] == 0
    assert "DT_VALIDADE" not in out["a"].asDict()


def test_incremental_equals_full(spark):
    df = history(spark)
    values = {"i": "EMITIDA", "l": "PERDIDA"}
    cut = F.lit(datetime(2024, 1, 5))
    old, new = df.filter(F.col("ts") < cut), df.filter(F.col("ts") >= cut)
    published = temporal.latest_with_entries(old, "q", "ts", "seq", "st", values)
    again = temporal.latest_with_entries(temporal.touched_history(df, new, "q"), "q", "ts", "seq", "st", values)
    got = temporal.publish_latest(published, again, new, "q")
    full = temporal.latest_with_entries(df, "q", "ts", "seq", "st", values)
    assert sorted(got.select(*full.columns).collect()) == sorted(full.collect())


def test_dedupe(spark):
    rows = [
        (1, "7", "x", None, datetime(2024, 1, 1)),
        (2, "007", "x", "y", None),
        (3, "8", " ", "y", datetime(2024, 1, 1)),
        (4, "8", "x", "", datetime(2024, 1, 2)),
        (5, "9", "x", "y", None),
        (6, "9", "x", "y", None),
    ]
    df = spark.createDataFrame(rows, "id int, k string, a string, b string, ts timestamp")
    from quotelift.functions import normalize_key

    out = joins.dedupe_most_filled(df, normalize_key("k"), "id", "ts", ["a", "b"])
    assert sorted(r["id"] for r in out.collect()) == [2, 4, 6]


def test_retention_one_key(spark):
    left = spark.createDataFrame(
        [(1, "7"), (2, "07"), (3, None), (4, " "), (5, "404")], "id int, k string"
    )
    right = spark.createDataFrame([("7", 2.0), ("7.0", 1.0), (None, 9.0), ("null 5", 3.0)], "k string, v double")
    out = joins.join_retention(left, right, ["k"], ["k"], "_r", [F.col("v")])
    assert {r["id"]: r["v_r"] for r in out.collect()} == {1: 1.0, 2: 1.0, 3: None, 4: None}
    assert out.columns == ["id", "k", "v_r"]


def test_null_keys_do_not_match_a_spread_value(spark):
    left = spark.range(2000).select("id", F.lit(None).cast("string").alias("k"))
    right = spark.range(1024).select(F.concat(F.lit("null "), "id").alias("k"), F.lit(1).alias("v"))
    out = joins.join_retention(left, right, ["k"], ["k"], "_r", [F.col("v")])
    assert out.count() == 2000 and out.filter("v_r is not null").count() == 0


def test_retention_three_keys(spark):
    left = spark.createDataFrame(
        [(1, "1", "p", "t"), (2, "1", None, "t"), (3, None, "p", "t"), (4, "1", "p", "u"), (5, "01", "p", "t ")],
        "id int, a string, b string, c string",
    )
    right = spark.createDataFrame([(1, "p", "t", 5), (1, "p", "t", 3), (1, None, "t", 1)], "a int, b string, d string, n int")
    out = joins.join_retention(left, right, ["a", "b", "c"], ["a", "b", "d"], "_det", [F.col("n")])
    assert {r["id"]: r["n_det"] for r in out.collect()} == {1: 3, 3: None, 5: 3}
