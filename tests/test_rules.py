from datetime import date

import pytest
from pyspark.sql import functions as F

from quotelift.plans import catalog
from quotelift.plans.rules import Rule, RuleError, apply_rules, consume, counted, log_frame


def test_statuses_toggles_and_counts(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, v string")
    rules = [
        Rule("A", "filter", lambda d: d.filter("id > 1")),
        Rule("B", "off", lambda d: d.limit(0), enabled=False),
        Rule("C", "off by toggle", lambda d: d.limit(0)),
        Rule("D", "needs x", lambda d: d, requires=("x",)),
        Rule("E", "adds x", lambda d: d.withColumn("x", F.lit(1)).drop("v")),
        Rule("F", "now x is there", lambda d: d.filter("x = 1"), requires=("x",)),
    ]
    out, log = apply_rules(df, rules, "t", {"t": {"C": False, "B": True}}, count_rows=True)
    consume(out)
    rows = log_frame(spark, log).collect()
    assert [r["status"] for r in rows] == [
        "APPLIED",
        "SKIPPED_DISABLED",
        "SKIPPED_DISABLED",
        "SKIPPED_MISSING_COLS",
        "APPLIED",
        "APPLIED",
    ]
    assert [r["rows_after"] for r in rows] == [2, None, None, None, 2, 2]
    assert (rows[4]["columns_added"], rows[4]["columns_dropped"]) == ("x", "v")


def test_global_switch_and_failure(spark):
    df = spark.range(3)
    out, log = apply_rules(df, [Rule("A", "x", lambda d: d.limit(0))], enable=False)
    assert out.count() == 3 and log[0].status == "SKIPPED_DISABLED"
    with pytest.raises(RuleError):
        apply_rules(df, [Rule("A", "bad column", lambda d: d.select("nope"))])


def test_counted(spark):
    df, seen = counted(spark.range(7))
    consume(df)
    assert seen.get["rows"] == 7


def test_channel(spark):
    rows = [(f, q) for f in ("true", "Sim", "1", None, "nao") for q in ("C1", "c1", "1", None)]
    df = spark.createDataFrame(rows, "f string, q string")
    for r in catalog.channel(df, "f", "q").collect():
        manual = r["f"] in ("true", "Sim", "1") or (r["q"] or "").upper().startswith("C")
        assert r["CANAL"] == ("MANUAL" if manual else "DIGITAL")


def test_refused_filter(spark):
    rows = [
        ("C1", "Recusada pelo corretor", "SIM", False),
        ("C2", None, "NAO", True),
        (" c3", "ok", None, True),
        ("4", "ok", " sim ", True),
        ("5", "ok", "NAO", False),
        ("6", None, None, False),
        (None, "ok", "SIM", False),
    ]
    df = spark.createDataFrame(rows, "q string, s string, saved string, keep boolean")
    kept = catalog.refused_filter(df, "q", "s", "saved").collect()
    assert {r["q"] for r in kept} == {r[0] for r in rows if r[3]}


def test_sentinel_default_segment(spark):
    df = spark.createDataFrame([("1900-01-01",), ("2031-01-01",), ("05/02/2024",), (None,)], "d string")
    assert [r["d"] for r in catalog.sentinel_date(df, "d").collect()] == [None, None, date(2024, 2, 5), None]
    df = spark.createDataFrame([(" ",), (None,), ("Renovação Congênere",), ("Outro",)], "t string")
    got = [r["t"] for r in catalog.default_value(df, "t", "Seguro Novo", ["renovação congênere"]).collect()]
    assert got == ["Seguro Novo"] * 3 + ["Outro"]
    rows = [("Digital", "SEGURO NOVO"), ("manual ", "renovacao"), ("x", "renovacao"), (None, "seguro novo")]
    df = spark.createDataFrame(rows, "CANAL string, DS_TIPO_COTACAO string")
    got = [r["SEG"] for r in catalog.segment(df).collect()]
    assert got == ["SEGURO_NOVO_DIGITAL", "RENOVACAO_MANUAL", None, None]
    custom = catalog.segment(df, renewal_words=["x renova"]).collect()
    assert custom[1]["SEG"] is None


def test_status_label_month(spark):
    rows = [(" emitida", "2025-11-05"), ("PERDIDA", "2025-01-01"), ("Aberta", None)]
    df = spark.createDataFrame(rows, "DS_GRUPO_STATUS string, DATA_COTACAO string")
    canonical = catalog.canonical_status(df)
    assert [r[0] for r in canonical.collect()] == ["Emitida", "Perdida", "Aberta"]
    assert [r["label"] for r in catalog.label(canonical).collect()] == [1, 0, None]
    assert catalog.final_status(canonical).count() == 2
    assert [r["MES"] for r in catalog.month(df).collect()] == ["2025-11", "2025-01"]
    assert catalog.exclude_months(df).count() == 1


def test_purposes_differ():
    train = {r.rule_id: r.enabled for r in catalog.quote_rules()}
    score = {r.rule_id: r.enabled for r in catalog.quote_rules(purpose="score")}
    assert {k for k in train if train[k] != score[k]} == {"GEN_R00", "GEN_R10", "GEN_R11"}
    assert not {r.rule_id: r.enabled for r in catalog.summary_rules("score")}["RES_R05"]


def test_house_suffix(spark):
    rules = catalog.quote_rules(house="_X")
    assert rules[2].requires[1] == "CD_NUMERO_COTACAO_X"
    df = spark.createDataFrame([("1", "2", "3")], "CD_FILIAL_X string, DS_FAROL string, K string")
    assert rules[8].fn(df).columns == ["K"]


def test_renewal_spellings_follow_the_house():
    assert catalog.renewal_spellings() == ["renovação", "renovacao"]
    assert catalog.renewal_spellings("_X")[2:] == ["renovação x", "renovacao x"]
