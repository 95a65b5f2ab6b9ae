import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from terrace.functions.audit import AUDIT_COLUMNS, enrich
from terrace.sources.files import file_options, read_files
from terrace.sources.jdbc import jdbc_options, read_increment, read_jdbc
from terrace.sources.readers import (
    READERS, format_reader, read_source, register_type, supported_types)
from terrace.sources.spec import SourceSpec


def file(path="x", fmt="csv", **options):
    return SourceSpec("src", {"path": str(path), "format": fmt, **options})


def test_csv_defaults_keep_text_and_pad_short_rows(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("step,customer,amount\n1,'C,1',4.5\n2,C2\n")
    spec = file(tmp_path, reader_options={"quote": "'"})
    df = read_files(spark, spec)
    assert set(t for _, t in df.dtypes) == {"string"}
    assert rows.of(df) == [("1", "C,1", "4.5"), ("2", "C2", None)]


def test_user_options_win_whatever_their_case(spark, tmp_path):
    assert file_options(file(reader_options={"HEADER": False, "inferschema": True}))[1] == {
        "HEADER": "False", "inferschema": "True", "mode": "PERMISSIVE"}
    (tmp_path / "a.csv").write_text("1\n2\n")
    df = read_files(spark, file(tmp_path, reader_options={"HEADER": False, "inferschema": True}))
    assert df.dtypes == [("_c0", "int")] and df.count() == 2


def test_format_is_case_insensitive_and_guarded():
    assert file_options(file(fmt="JSON")) == ("json", {"multiLine": "false"})
    with pytest.raises(ValueError, match=r"\[src\].*csv.*json.*parquet"):
        file_options(file(fmt="avro"))
    for options in ({"path": "x"}, {"format": "csv"}, {"path": "", "format": "csv"}):
        with pytest.raises(ValueError, match="src"):
            file_options(SourceSpec("src", options))


def test_json_keeps_nesting_and_flags_malformed_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":"x","b":{"c":[1,2]},"d":1.5}\nnot json\n')
    df = read_files(spark, file(tmp_path, "json"))
    assert dict(df.dtypes)["b"] == "struct<c:array<bigint>>"
    assert [r._corrupt_record for r in df.collect()] == [None, "not json"]


def test_stated_schema_skips_inference(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"a":1}\n')
    assert read_files(spark, file(tmp_path, "json", schema="a string, b int")).dtypes == [
        ("a", "string"), ("b", "int")]


def test_glob_and_recursive_lookup(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text("step,customer\n1,a\n2,b\n3,c\n")
    (tmp_path / "sub" / "b.csv").write_text("step,customer\n4,d\n")
    assert read_files(spark, file(f"{tmp_path}/*.csv")).count() == 3
    assert read_files(spark, file(tmp_path)).count() == 3
    assert read_files(spark, file(tmp_path, recursive_lookup=True)).count() == 4


def test_enrich_adds_exactly_the_contract(spark, tmp_path):
    assert AUDIT_COLUMNS == ("_ingested_at", "_source", "_source_type", "_batch_id", "_source_file")
    (tmp_path / "a.csv").write_text("Step,customer\n1,a\n")
    raw = read_files(spark, file(tmp_path))
    out = enrich(raw, "src", "file", "b1", include_source_file=True)
    assert out.columns == ["Step", "customer", *AUDIT_COLUMNS]
    row = out.first()
    assert (row._source, row._source_type, row._batch_id) == ("src", "file", "b1")
    assert row._source_file.endswith("/a.csv") and row._ingested_at is not None
    plain = enrich(spark.range(1), "s", "jdbc", "b1")
    assert plain.first()._source_file is None and dict(plain.dtypes)["_source_file"] == "string"
    with pytest.raises(ValueError, match="_Source"):
        enrich(spark.range(1).withColumn("_Source", F.lit(1)), "s", "file", "b1")


URL = "jdbc:derby:memory:sources;create=true"
DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def jdbc(**options):
    return SourceSpec("db", {"url": URL, "driver": DRIVER, "user_env": "T_USER", "password_env": "T_PW",
                             **options}, "jdbc")


@pytest.fixture
def credentials(monkeypatch):
    monkeypatch.setenv("T_USER", "app")
    monkeypatch.setenv("T_PW", "secret")


@pytest.fixture
def orders(spark, credentials):
    """An embedded in-process database; it opens no port."""
    (spark.range(1, 101).withColumn("amt", F.col("id") * 1.5).write.format("jdbc").mode("overwrite")
     .options(url=URL, driver=DRIVER, dbtable="orders", user="app", password="secret").save())


SPLIT = {"partition_column": "id", "lower_bound": 10, "upper_bound": 50, "num_partitions": 4}


def test_jdbc_bounds_set_the_stride_and_filter_nothing(spark, orders):
    df = read_jdbc(spark, jdbc(dbtable="orders", **SPLIT))
    sizes = df.groupBy(F.spark_partition_id().alias("p")).count().orderBy("p").collect()
    assert [r["count"] for r in sizes] == [19, 10, 10, 61]


def test_jdbc_query_can_be_split(spark, orders):
    text = 'SELECT "id" FROM orders WHERE "amt" > 75'
    assert read_jdbc(spark, jdbc(query=text)).count() == 50
    df = read_jdbc(spark, jdbc(query=text, **SPLIT))
    assert df.count() == 50 and df.rdd.getNumPartitions() == 4


def test_jdbc_filter_reaches_the_database(spark, orders):
    plan = read_increment(read_jdbc(spark, jdbc(dbtable="orders")), "id", 90)
    assert plan.count() == 10
    assert "GreaterThan(id,90)" in plan._jdf.queryExecution().executedPlan().toString()


def test_jdbc_options_are_all_or_none(credentials):
    base = jdbc_options(jdbc(dbtable="orders"))
    assert base["fetchsize"] == "1000" and base["user"] == "app" and "query" not in base
    assert jdbc_options(jdbc(dbtable="orders", fetch_size=5000))["fetchsize"] == "5000"
    assert jdbc_options(jdbc(dbtable="", query="select 1"))["query"] == "select 1"
    for bad in ({}, {"dbtable": "a", "query": "b"}, {"dbtable": "a", "lower_bound": 1},
                {"dbtable": "a", "partition_column": "id", "lower_bound": 1, "upper_bound": 2}):
        with pytest.raises(ValueError, match="db"):
            jdbc_options(jdbc(**bad))


def test_credentials_come_from_the_environment(monkeypatch, credentials):
    monkeypatch.setenv("T_PW", "")
    with pytest.raises(EnvironmentError, match="T_PW"):
        jdbc_options(jdbc(dbtable="orders"))
    os.environ.pop("T_USER")
    with pytest.raises(EnvironmentError, match="T_USER"):
        jdbc_options(jdbc(dbtable="orders"))


def test_increment_is_strict_and_skips_null(spark, rows):
    df = rows.make([(1,), (2,), (None,), (3,)], "v int")
    assert rows.of(read_increment(df, "v", 2)) == [(3,)]
    assert rows.of(read_increment(df, "v")) == [(1,), (2,), (3,)]


def test_new_source_types(spark, rows):
    class Squares(DataSource):
        @classmethod
        def name(cls):
            return "squares"

        def schema(self):
            return "n int, square int"

        def reader(self, schema):
            return SquaresReader(int(self.options["upto"]))

    class SquaresReader(DataSourceReader):
        def __init__(self, upto):
            self.upto = upto

        def partitions(self):
            return [InputPartition(i) for i in range(2)]

        def read(self, partition):
            for n in range(partition.value, self.upto, 2):
                yield n, n * n

    spark.dataSource.register(Squares)
    try:
        register_type("squares", format_reader("squares"))
        assert rows.of(read_source(spark, SourceSpec("sq", {"upto": 3}, "squares"))) == [
            (0, 0), (1, 1), (2, 4)]
        assert {"file", "jdbc", "squares"} <= set(supported_types())
        assert list(supported_types()) == sorted(supported_types())
    finally:
        READERS.pop("squares")
    with pytest.raises(KeyError, match="file.*jdbc"):
        read_source(spark, SourceSpec("k", {}, "kafka"))
    with pytest.raises(ValueError):
        register_type("Mixed", None)
    assert all(name == name.lower() for name in supported_types())
