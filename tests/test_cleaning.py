from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quotelift.functions import (
    blank_to_null,
    make_date,
    normalize_key,
    parse_date,
    parse_number_ptbr,
    parse_number_us,
)
from quotelift.operators import columns


def mapped(spark, fn, values, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}").select("i", fn("v").alias("o"))
    return [r["o"] for r in df.orderBy("i").collect()]


def test_normalize_key_text(spark):
    cases = {
        "007": "7",
        "7": "7",
        " 7 ": "7",
        "7.0": "7",
        "12.7": "12",
        "-3": "-3",
        "9.2890001E9": "9289000100",
        "abc": "abc",
        "5D": "5D",
        "1E5": "1E5",
        "": None,
        " ": None,
        None: None,
        "12345678901234567": "12345678901234567",
        "12345678901234567890": "12345678901234567890",
    }
    assert mapped(spark, normalize_key, list(cases)) == list(cases.values())


def test_normalize_key_numbers(spark):
    assert mapped(spark, normalize_key, [9.2890001e9, 7.0, None], "double") == ["9289000100", "7", None]


def test_parse_date(spark):
    cases = {
        "2024-12-31T10:00:00.000Z": date(2024, 12, 31),
        "2024-12-31T10:00:00-03:00": date(2024, 12, 31),
        "2024-12-31 10:00:00.123": date(2024, 12, 31),
        "2024-12-31": date(2024, 12, 31),
        "31/12/2024": date(2024, 12, 31),
        "31/12/2024 10:00:00": date(2024, 12, 31),
        "2024-02-30": None,
        "31/02/2024": None,
        "soon": None,
        "": None,
        None: None,
    }
    assert mapped(spark, parse_date, list(cases)) == list(cases.values())


def test_parse_number_us(spark):
    cases = {
        "1,234.565": Decimal("1234.57"),
        ".02": Decimal("0.02"),
        "-.02": Decimal("-0.02"),
        " 5 ": Decimal("5.00"),
        "": None,
        "x": None,
        None: None,
        "9" * 18: None,
    }
    assert mapped(spark, lambda c: parse_number_us(c, 2), list(cases)) == list(cases.values())


def test_parse_number_ptbr(spark):
    cases = {"1.234,56": Decimal("1234.56"), ' "7,5" ': Decimal("7.50"), "-1.000": Decimal("-1000.00"), "a": None}
    assert mapped(spark, parse_number_ptbr, list(cases)) == list(cases.values())


def test_make_date(spark):
    rows = [("2024", "2", "29"), ("2023", "2", "29"), ("2024.0", "12", "01"), ("x", "1", "1"), (None, "1", "1")]
    df = spark.createDataFrame(rows, "y string, m string, d string")
    got = [r[0] for r in df.select(make_date("y", "m", "d")).collect()]
    assert got == [date(2024, 2, 29), None, date(2024, 12, 1), None, None]


def test_blank_to_null(spark):
    assert mapped(spark, blank_to_null, ["a", " ", "", None]) == ["a", None, None, None]


@pytest.mark.parametrize(
    "values, expected",
    [
        ([None, None], "bigint"),
        ([" ", ""], "bigint"),
        (["00123", "-5"], "bigint"),
        (["1.5", "2"], "double"),
        (["1e5", "3"], "double"),
        (["5D", "1"], "double"),
        (["NaN", "1"], "double"),
        (["a1", "1"], "string"),
        (["12345678901234567890", "1"], "double"),
    ],
)
def test_infer_numeric(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    assert dict(columns.infer_numeric(df).dtypes)["v"] == expected


def test_infer_numeric_protects_codes(spark):
    df = spark.createDataFrame([("007", "1")], "code string, n string")
    assert dict(columns.infer_numeric(df, ["code"]).dtypes) == {"code": "string", "n": "bigint"}


def test_pinned_types_and_rejects(spark):
    df = spark.createDataFrame([("1",), ("x",), (" ",), (None,)], "v string")
    assert [r["v"] for r in columns.apply_types(df, {"v": "bigint"}).collect()] == [1, None, None, None]
    assert columns.count_rejects(df, {"v": "bigint"}).collect() == [("v", 1)]


def test_drop_empty_columns_and_names(spark):
    df = spark.createDataFrame([("a", " ", None), ("b", None, None)], "k string, e string, n double")
    assert columns.drop_empty_columns(df).columns == ["k"]
    assert columns.upper_names(df).columns == ["K", "E", "N"]
    up = columns.upper_values(df, ["k", "absent"]).orderBy("k").collect()
    assert [r["k"] for r in up] == ["A", "B"]


def test_unpivot_needs_scores(spark):
    with pytest.raises(ValueError):
        columns.unpivot_scores(spark.range(1), ["id"], "p_", "r_")
    wide = spark.createDataFrame([(1, 0.5, 2)], "id long, p_b double, r_b int").withColumn("p_a", F.lit(0.1))
    rows = columns.unpivot_scores(wide, ["id"], "p_", "r_").collect()
    assert [tuple(r) for r in rows] == [(1, "a", 0.1, None), (1, "b", 0.5, 2)]
