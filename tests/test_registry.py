"""Every registered query against its SQL, and invariants for those without one."""

import decimal

import duckdb
import pytest

import __spark_entry__ as contract

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
QUERIES, SQL = contract.queries(), contract.oracle_sql()
#: Full fits take minutes; what they use is tested with small settings in test_training.py.
SLOW = {"fs_methods", "cv_grid", "train_final", "model_roundtrip", "score_wide"}


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, (float, decimal.Decimal)):
        return repr(float(value) + 0.0)
    return str(value)


@pytest.mark.parametrize("name", sorted(set(SQL) - SLOW))
def test_query_matches_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    want = sorted(tuple(plain(row[names.index(c)]) for c in sorted(names)) for row in result.fetchall())
    got = sorted(tuple(plain(row[c]) for c in sorted(names)) for row in df.collect())
    assert got == want


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
    # the operators for training text are tested in their own folder
    assert set(QUERIES) - set(SQL) <= {n for n in QUERIES if n.startswith("op") or n == "pipeline"}


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["SEG", "DS_GRUPO_STATUS", "n_rows", "segment_total", "share"]
    assert df.count() > 0
