from datetime import date

import pytest
from pyspark.sql import functions as F

from quotelift.session import materialize, scratch_path
from quotelift.sources import files, tables
from quotelift.streaming.ingest import drop_late_files, read_deliveries, start_ingest

NAMES = [
    "COTACAO_GENERICO_20240131.csv",
    "COTACAO_GENERICO_7_20240201.csv",
    "COTACAO_GENERICO_20240231.csv",  # not a date
    "COTACAO_GENERICO_2024013.csv",
    "OUTRO_20240131.csv",
    "COTACAO_GENERICO_20240131.csv.bak",
]
TEXT = "\"ID\"|'NOME'|VL\n1|\"São Paulo\"|1,5\n2|a \"b\" c| x\n"


@pytest.fixture()
def folder(tmp_path):
    for name in NAMES:
        (tmp_path / name).write_bytes(TEXT.encode("iso-8859-1"))
    return str(tmp_path)


def test_listing(spark, folder):
    got = files.list_files(spark, folder).select("source_file", "file_date").collect()
    assert sorted(map(tuple, got)) == [
        ("COTACAO_GENERICO_20240131.csv", date(2024, 1, 31)),
        ("COTACAO_GENERICO_7_20240201.csv", date(2024, 2, 1)),
    ]


def test_scan(spark, folder):
    rows = files.scan_csv(spark, [f"{folder}/{NAMES[0]}", f"{folder}/{NAMES[1]}"])
    assert rows.columns == ["ID", "NOME", "VL", "TS_ARQ", "TS_ATUALIZACAO", "SOURCE_FILE"]
    got = rows.filter(F.col("SOURCE_FILE") == NAMES[0]).orderBy("ID").collect()
    assert [(r["ID"], r["NOME"], r["VL"]) for r in got] == [("1", "São Paulo", "1,5"), ("2", "a b c", " x")]
    assert got[0]["TS_ARQ"].date() == date(2024, 1, 31) and got[0]["TS_ATUALIZACAO"] is not None
    assert rows.count() == 4


def test_other_header_fails(spark, folder, tmp_path):
    (tmp_path / "COTACAO_GENERICO_20240301.csv").write_text("NOME|ID|VL\nx|1|2\n")
    paths = [f"{folder}/{NAMES[0]}", f"{folder}/COTACAO_GENERICO_20240301.csv"]
    with pytest.raises(Exception, match="(?i)header"):
        files.scan_csv(spark, paths).collect()


def listing(spark):
    rows = [("b", "2024-01-02"), ("a", "2024-01-02"), ("old", "2024-01-01"), ("done", "2024-01-03"), ("c", "2024-01-04")]
    return spark.createDataFrame(rows, "source_file string, d string").select("source_file", F.to_date("d").alias("file_date"))


def test_candidates(spark):
    loaded = spark.createDataFrame([("done",)], "source_file string")

    def names(**kw):
        return [r["source_file"] for r in files.incremental_candidates(listing(spark), **kw).collect()]

    cutoff = F.lit(date(2024, 1, 2))
    assert names(loaded=loaded, cutoff=cutoff) == ["a", "b", "c"]  # cutoff day included
    assert names(loaded=loaded) == ["old", "a", "b", "c"]
    assert names() == ["old", "a", "b", "done", "c"]
    assert names(loaded=loaded, limit=2) == ["old", "a"]
    empty = files.high_water_mark(spark.createDataFrame([], "TS_ARQ timestamp")).scalar()
    assert names(loaded=loaded, cutoff=empty) == ["old", "a", "b", "c"]


def test_ingest_nothing(spark, folder):
    none = files.list_files(spark, folder).limit(0)
    assert files.ingest_files(spark, none) is None
    some = files.incremental_candidates(files.list_files(spark, folder), limit=1)
    assert files.ingest_files(spark, some).count() == 2


def test_new_rows(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, 1)], "id int, batch_id long")
    assert [r["id"] for r in tables.new_row_flag(df).filter("FL_NOVO").collect()] == [2, 3]
    assert tables.rows_after(df, 1) is None
    assert tables.rows_after(df, 0).count() == 2 and tables.rows_after(df, None).count() == 3


@pytest.fixture()
def schema(spark):
    tables.ensure_schema(spark, "qlt")
    yield "qlt"
    spark.sql("DROP SCHEMA qlt CASCADE")


def test_table_sinks(spark, schema):
    first = spark.createDataFrame([(1, "a")], "id int, v string")
    tables.write_new(first, "qlt.t", partition_by="v")
    with pytest.raises(ValueError):
        tables.write_new(first, "qlt.t")
    one = spark.table("qlt.t").filter("v = 'a'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(v" in plan  # only the files of that segment
    assert tables.next_batch_id(spark, "qlt.bronze") == 0
    tables.append_fixed(tables.tag_batch(first, 0), "qlt.bronze")
    later = spark.createDataFrame([("b", "2")], "v string, id string")
    tables.append_fixed(tables.tag_batch(later, tables.next_batch_id(spark, "qlt.bronze")), "qlt.bronze")
    table = spark.table("qlt.bronze")
    assert dict(table.dtypes)["id"] == "int"
    assert sorted(map(tuple, table.select("id", "v", "batch_id").collect())) == [(1, "a", 0), (2, "b", 1)]
    with pytest.raises(ValueError):
        tables.append_fixed(first, "qlt.bronze")
    assert tables.copy_table(spark, "qlt.bronze", "qlt.copy") is True
    assert tables.copy_table(spark, "qlt.bronze", "qlt.copy") is False
    tables.refresh_dimension(first, "qlt.copy")
    assert spark.table("qlt.copy").count() == 1


def test_dimension_reload(spark, schema, folder):
    for _ in range(2):
        tables.ingest_dimension(spark, f"{folder}/{NAMES[0]}", "qlt.dim")
    assert spark.table("qlt.dim").columns == ["ID", "NOME", "VL", "TS_ATUALIZACAO"]
    assert spark.table("qlt.dim").count() == 2


def test_stream_reads_each_file_once(spark, folder, tmp_path):
    target, state = scratch_path(spark, "stream"), scratch_path(spark, "state")
    source = "`\"ID\"` string, `'NOME'` string, VL string"

    def run():
        query = start_ingest(read_deliveries(spark, folder, source, max_files=1), target, state)
        query.awaitTermination()
        return spark.read.parquet(target)

    batch = files.scan_csv(spark, [f"{folder}/{n}" for n in NAMES[:2]])
    keep = ["ID", "NOME", "VL", "SOURCE_FILE"]
    assert sorted(run().select(keep).collect()) == sorted(batch.select(keep).collect())
    assert run().count() == 4
    assert run().select("batch_id").distinct().count() == 2
    (tmp_path / "COTACAO_GENERICO_20240401.csv").write_bytes(TEXT.encode("iso-8859-1"))
    after = run()
    assert after.count() == 6
    newest = tables.new_row_flag(after, "run_id").filter("FL_NOVO")
    assert {r["SOURCE_FILE"] for r in newest.collect()} == {"COTACAO_GENERICO_20240401.csv"}


def test_late_files(spark):
    df = spark.createDataFrame([("2024-01-01",), ("2024-01-02",)], "d string").select(F.to_timestamp("d").alias("TS_ARQ"))
    assert drop_late_files(df, date(2024, 1, 2)).count() == 1
    assert drop_late_files(df, None).count() == 2


def test_materialize_keeps_rows_and_types(spark):
    df = spark.range(5).withColumn("s", F.col("id").cast("string"))
    again = materialize(df, "x")
    assert again.dtypes == df.dtypes and again.count() == 5


def deliver(folder, name, text):
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(text.encode("iso-8859-1"))


def ingest(spark, folder, target, state):
    start_ingest(read_deliveries(spark, str(folder), "A string, B string", max_files=1), target, state).awaitTermination()
    return spark.read.parquet(target)


def test_stream_refuses_another_header(spark, tmp_path):
    deliver(tmp_path / "in", "COTACAO_GENERICO_20240101.csv", "B|A\nx|y\n")
    with pytest.raises(Exception, match="(?i)header"):
        ingest(spark, tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state"))


def test_new_checkpoint_keeps_old_loads_and_a_run_is_new_as_a_whole(spark, tmp_path):
    target = str(tmp_path / "out")
    deliver(tmp_path / "one", "COTACAO_GENERICO_20240101.csv", "A|B\n1|2\n")
    assert ingest(spark, tmp_path / "one", target, str(tmp_path / "s1")).count() == 1
    for day in (2, 3):
        deliver(tmp_path / "two", f"COTACAO_GENERICO_2024010{day}.csv", f"A|B\n{day}|0\n")
    rows = ingest(spark, tmp_path / "two", target, str(tmp_path / "s2"))
    assert sorted(r["A"] for r in rows.collect()) == ["1", "2", "3"]
    newest = tables.new_row_flag(rows, "run_id").filter("FL_NOVO")
    assert sorted(r["A"] for r in newest.collect()) == ["2", "3"]


def test_value_that_does_not_fit_fails_the_load(spark):
    tables.ensure_schema(spark, "qlt")
    spark.sql("DROP TABLE IF EXISTS qlt.pinned")
    tables.append_fixed(spark.createDataFrame([(1,)], "n int"), "qlt.pinned")
    tables.append_fixed(spark.createDataFrame([("2",), (" ",), (None,)], "n string"), "qlt.pinned")
    with pytest.raises(Exception, match="n does not fit int: abc"):
        tables.append_fixed(spark.createDataFrame([("3",), ("abc",)], "n string"), "qlt.pinned")
    assert sorted(str(r["n"]) for r in spark.table("qlt.pinned").collect()) == ["1", "2", "None", "None"]
