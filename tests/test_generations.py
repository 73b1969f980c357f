"""Publishing in generations: runs that die after any step, readers meanwhile, expiry."""

import datetime as dt
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quotelift.operators import temporal
from quotelift.plans import fixed_values as fv
from quotelift.plans import flows
from quotelift.session import nothing_there, scratch_path
from quotelift.sources.generations import PublishedTable

COLUMNS = ["quote", "event", "status", "ts"]
ENTRIES = {"issued_at": fv.ISSUED, "lost_at": fv.LOST}


@pytest.fixture(scope="module")
def bronze(spark):
    rng = random.Random(2)
    start = dt.datetime(2024, 1, 1)
    rows = [
        (rng.randint(1, 12 + 4 * batch), 100 * batch + i, rng.choice([fv.ISSUED, fv.LOST, "x", ""]),
         start + dt.timedelta(days=rng.randint(0, 20)), batch)
        for batch in range(3)
        for i in range(30)
    ]
    return spark.createDataFrame(rows, "quote long, event long, status string, ts timestamp, batch_id long").cache()


def typed(df):
    return df.select(COLUMNS)


def run(bronze, upto, table):
    return flows.catch_up(bronze.filter(F.col("batch_id") <= upto), table, typed, "ts", "event", "status", COLUMNS)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS, *ENTRIES).collect()), key=repr)


def whole(bronze, upto):
    history = typed(bronze.filter(F.col("batch_id") <= upto))
    return rows_of(temporal.latest_with_entries(history, "quote", "ts", "event", "status", ENTRIES, COLUMNS))


class Dies(Exception):
    pass


def die(*_args, **_kwargs):
    raise Dies


@pytest.mark.parametrize("step", ["read", "write", "written", "commit", "committed"])
def test_a_run_that_dies_and_one_after_it_equal_the_full_recompute(spark, bronze, monkeypatch, step):
    table = PublishedTable(spark, scratch_path(spark, "generations"), "quote", 5)
    assert rows_of(run(bronze, 0, table)) == whole(bronze, 0)
    if step in ("read", "write"):
        monkeypatch.setattr(table, step, die)
    elif step == "written":  # all folders are there, the commit is not
        plain = table.write
        monkeypatch.setattr(table, "write", lambda *a: plain(*a) or die())
    elif step == "commit":
        monkeypatch.setattr(table, "commit", die)
    else:
        plain_commit = table.commit
        monkeypatch.setattr(table, "commit", lambda *a: plain_commit(*a) and die())
    with pytest.raises(Dies):
        run(bronze, 1, table)
    monkeypatch.undo()
    # readers see a whole state: the old one, or after the commit the new one
    seen = 1 if step == "committed" else 0
    assert rows_of(table.read()) == whole(bronze, seen) and table.current().consumed == seen
    # the next run finds no further load, or finds one
    again = PublishedTable(spark, table.path, "quote", 5)
    for upto in (1, 2, 2):
        assert rows_of(run(bronze, upto, again)) == whole(bronze, upto)
    assert again.current().number == 3


def test_a_first_run_that_dies(spark, bronze, monkeypatch):
    table = PublishedTable(spark, scratch_path(spark, "generations"), "quote", 5)
    monkeypatch.setattr(table, "commit", die)
    with pytest.raises(Dies):
        run(bronze, 1, table)
    monkeypatch.undo()
    assert table.current() is None and table.read() is None
    assert rows_of(run(bronze, 2, table)) == whole(bronze, 2)


def test_leftovers_of_a_dead_run_do_not_come_back(spark):
    """A bucket of an uncommitted generation that the repeated run does not write again."""
    table = PublishedTable(spark, scratch_path(spark, "generations"), "k", 4)
    df = lambda *ks: spark.createDataFrame([(k, f"v{k}") for k in ks], "k long, v string")
    bucket = {k: df(k).select(table.bucket().alias("b")).first()["b"] for k in range(20)}
    one = [k for k in bucket if bucket[k] == bucket[0]][:2]
    other = next(k for k in bucket if bucket[k] != bucket[0])
    table.publish(df(one[0], other), [bucket[one[0]], bucket[other]], 0)
    table.write(df(one[0], one[1], other), 2)
    table.publish(df(one[1]), [bucket[one[0]]], 1)
    assert sorted(r["k"] for r in table.read().collect()) == sorted([one[1], other])
    # a touched bucket without rows is empty afterwards
    table.publish(df(), [bucket[other]], 2)
    assert [r["k"] for r in table.read().collect()] == [one[1]]
    table.publish(df(), [bucket[one[0]]], 3)
    assert table.read().columns == ["k", "v"] and table.read().count() == 0


def test_a_second_writer_is_refused_and_old_generations_expire(spark):
    path = scratch_path(spark, "generations")
    one, two = (PublishedTable(spark, path, "k", 2) for _ in range(2))
    df = lambda n: spark.createDataFrame([(i, n) for i in range(10)], "k long, n long")
    for n in range(4):
        one.publish(df(n), [0, 1], n)
    two.write(df(9), 5)
    one.publish(df(5), [0, 1], 5)
    with pytest.raises(RuntimeError, match="another run"):
        two.commit(df(9), 5, [0, 1], 9)
    old = one.read()
    one.publish(df(6), [0, 1], 6)
    assert one.expire(keep=2) == [1, 2, 3, 4] and one.expire(keep=2) == []
    assert {r["n"] for r in old.collect()} == {5} and {r["n"] for r in one.read().collect()} == {6}
    with pytest.raises(ValueError):
        one.expire(0)


def test_only_a_missing_path_means_nothing_there(spark):
    with pytest.raises(AnalysisException) as missing:
        spark.read.parquet(scratch_path(spark, "nowhere"))
    assert nothing_there(missing.value)
    with pytest.raises(AnalysisException) as other:
        spark.range(1).select("nope")
    assert not nothing_there(other.value)
