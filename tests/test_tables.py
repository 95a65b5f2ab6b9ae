import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from datetime import datetime
from unittest.mock import patch

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from terrace.functions.audit import enrich
from terrace.operators import tables
from terrace.operators.governance import expire_table, table_cost
from terrace.operators.partitioning import native_partitions
from terrace.operators.tables import (
    append, delete_rows, evolve_and_append, list_namespaces, list_tables,
    lossless, overwrite_partitions, preview, quoted,
    replace_table, restore, rollback_batch, table_exists, write_partitioned)


def test_append_creates_then_appends(spark, ns, rows):
    df = rows.make([(1, "a")], "id int, s string")
    assert not table_exists(spark, quoted(ns, "t")) and not table_exists(spark, quoted("nowhere", "t"))
    fqn = append(df, ns, "t", properties={"team.owner": "x"})
    assert fqn == f"`{ns}`.`t`" and table_exists(spark, fqn)
    append(df.select("s", "id"), ns, "t")
    assert rows.of(spark.table(fqn)) == [(1, "a"), (1, "a")]
    assert all(f.endswith(".zstd.parquet") for f in spark.table(fqn).inputFiles())
    shown = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {fqn}").collect()}
    assert shown["team.owner"] == "x"
    assert rows.of(list_tables(spark, ns)) == [(ns, "t")]
    assert list_namespaces(spark).where(F.col("namespace") == ns).count() == 1


def test_strict_append_refuses_new_columns(rows, ns):
    append(rows.make([(1,)], "id int"), ns, "t")
    with pytest.raises(ValueError, match="extra"):
        append(rows.make([(1, 2)], "id int, extra int"), ns, "t")


def test_evolution_adds_columns_and_reads_null(spark, ns, rows):
    append(rows.make([(1, "a")], "id int, s string"), ns, "t", partition_by=["s"])
    fqn = evolve_and_append(rows.make([(2, (3, "x"))], "ID int, st struct<a:int,`b c`:string>"), ns, "t")
    assert rows.of(spark.table(fqn).select("id", "s", "st.a")) == [(1, "a", None), (2, None, 3)]


@pytest.mark.parametrize("given", ["id double", "id bigint", "id string", "id decimal(20,0)"])
def test_lossy_types_are_refused_before_writing(spark, ns, rows, given):
    fqn = append(rows.make([(1,)], "id int"), ns, "t")
    with pytest.raises(TypeError, match="id"):
        evolve_and_append(rows.make([(1,)], "id int").selectExpr(f"CAST(id AS {given[3:]}) AS id"), ns, "t")
    assert spark.table(fqn).count() == 1


def test_wider_columns_take_narrower_values(spark, ns, rows):
    fqn = append(rows.make([("a", 1)], "s string, n bigint"), ns, "t")
    append(rows.make([(5, 2)], "s int, n int"), ns, "t")
    assert rows.of(spark.table(fqn)) == [("5", 2), ("a", 1)]


def test_nested_field_cannot_be_added_silently(ns, rows):
    append(rows.make([((1,),)], "s struct<a:int>"), ns, "t")
    with pytest.raises(TypeError):
        evolve_and_append(rows.make([((1, 2),)], "s struct<a:int,b:int>"), ns, "t")


def test_lossless_pairs():
    yes = [("int", "bigint"), ("int", "double"), ("float", "double"), ("int", "decimal(10,0)"),
           ("bigint", "string"), ("date", "timestamp"), ("decimal(5,2)", "decimal(7,3)"), ("array<int>", "array<bigint>"), ("void", "string")]
    no = [("bigint", "double"), ("int", "float"), ("double", "float"), ("decimal(5,2)", "decimal(5,3)"),
          ("bigint", "decimal(18,0)"), ("timestamp", "date"), ("timestamp", "string"),
          ("string", "int"), ("map<string,bigint>", "map<string,int>")]
    for expected, pairs in ((True, yes), (False, no)):
        for given, held in pairs:
            assert lossless(T.DataType.fromDDL(given), T.DataType.fromDDL(held)) is expected, (given, held)


def test_identity_partitions_survive_append_and_replacement(spark, ns, rows):
    df = rows.make([(1, "a"), (2, "b")], "id int, s string")
    fqn = append(df, ns, "t", partition_by=["s"])
    append(df, ns, "t")
    replace_table(spark.table(fqn).where("id = 2"), fqn)
    append(df, ns, "t")
    assert [c.name for c in spark.catalog.listColumns(fqn) if c.isPartition] == ["s"]
    assert rows.of(spark.table(fqn)) == [(1, "a"), (2, "b"), (2, "b"), (2, "b")]


def test_transform_partitions(spark, ns, rows):
    df = rows.make([(1, "abcd", datetime(2024, 5, 6, 7, 8))], "id int, s string, ts timestamp")
    layout = ["days(ts)", "truncate(2, s)", "bucket(3, id)"]
    fqn = append(df, ns, "t", partition_by=layout)
    append(df, ns, "t")
    assert {(str(r.ts_day), r.s_trunc) for r in spark.table(fqn).collect()} == {("2024-05-06", "ab")}
    overwrite_partitions(df.withColumn("id", F.lit(9)), fqn)
    assert [r.id for r in spark.table(fqn).collect()] == [9]
    replace_table(spark.table(fqn), fqn)
    shown = spark.sql(f"SHOW CREATE TABLE {fqn}").first()[0]
    assert "INTO 3 BUCKETS" in shown and "PARTITIONED BY (ts_day, s_trunc)" in shown
    assert native_partitions([*layout, "id"]) == ["days(`ts`)", "truncate(2, `s`)", "bucket(3, `id`)", "`id`"]
    for bad in ("weeks(ts)", "bucket(id)", "days(3, ts)", "days(ts"):
        with pytest.raises(ValueError):
            native_partitions([bad])


def test_hot_partition_is_written_by_several_tasks(spark, ns):
    df = spark.range(400_000).select(F.lit("hot").alias("k"), F.rand(1).alias("v"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "512k")
    try:
        fqn = append(df.repartition(4), ns, "t", partition_by=["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(spark.table(fqn).inputFiles()) > 2 and spark.table(fqn).count() == 400_000


def two_batches(spark, ns, **options):
    df = spark.range(3)
    append(enrich(df, "s", "file", "b1"), ns, "t", **options)
    return append(enrich(df, "s", "file", "b'2"), ns, "t")


@pytest.mark.parametrize("layout", [[], ["_batch_id"]])
def test_rollback(spark, ns, layout):
    fqn = two_batches(spark, ns, partition_by=layout)
    before = spark.table(fqn).inputFiles()
    rollback_batch(spark, fqn, "unknown")
    assert sorted(spark.table(fqn).inputFiles()) == sorted(before)
    rollback_batch(spark, fqn, "b'2")
    assert [r._batch_id for r in spark.table(fqn).collect()] == ["b1"] * 3


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(0, 3), st.sampled_from([None, "a", "b"])), max_size=4),
                min_size=1, max_size=3), st.sampled_from([[], ["s"], ["_batch_id"]]))
def test_rollback_undoes_an_append(spark, ns, rows, batches, layout):
    table = f"t{uuid.uuid4().hex}"
    for i, data in enumerate(batches):
        frame = enrich(rows.make(data, "v int, s string"), "src", "file", f"b{i}")
        fqn = append(frame, ns, table, partition_by=layout)
    before = rows.of(spark.table(fqn).select("v", "s", "_batch_id"))
    append(enrich(rows.make([(7, "a"), (8, "new")], "v int, s string"), "src", "file", "late"), ns, table)
    rollback_batch(spark, fqn, "late")
    assert rows.of(spark.table(fqn).select("v", "s", "_batch_id")) == before


@pytest.mark.parametrize("layout", [[], ["_batch_id"]])
def test_replayed_batch_replaces_itself(spark, ns, layout):
    fqn = two_batches(spark, ns, partition_by=layout)
    append(enrich(spark.range(5), "s", "file", "b1"), ns, "t", replay_of="b1")
    counts = {r._batch_id: r["count"] for r in spark.table(fqn).groupBy("_batch_id").count().collect()}
    assert counts == {"b1": 5, "b'2": 3}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_partition_overwrite_leaves_the_others(spark, ns, rows):
    fqn = write_partitioned(rows.make([(1, "a"), (2, "b")], "id int, s string"), ns, "t", ["s"])
    overwrite_partitions(rows.make([(9, "a"), (8, "c")], "id int, s string"), fqn)
    assert rows.of(spark.table(fqn)) == [(2, "b"), (8, "c"), (9, "a")]
    with pytest.raises(ValueError):
        write_partitioned(spark.range(1), ns, "u", [])
    with pytest.raises(ValueError):
        overwrite_partitions(spark.range(1), append(spark.range(1), ns, "plain"))


def test_deletes_rewrite_only_touched_partitions(spark, ns, rows):
    df = rows.make([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, "c")], "id int, s string")
    fqn = append(df, ns, "t", partition_by=["s"])
    kept = {f for f in spark.table(fqn).inputFiles() if "s=c" in f}
    delete_rows(spark, fqn, "id IN (1, 3, 4)")
    assert rows.of(spark.table(fqn)) == [(2, "a"), (5, "c")]
    assert kept <= set(spark.table(fqn).inputFiles())
    assert len(spark.sql(f"SHOW PARTITIONS {fqn}").collect()) == 2


class Stopped(Exception):
    pass


@contextmanager
def stopped_after(statements):
    """Let a replacement run this many of its statements and then stop."""
    real, left = tables._state, [statements]

    def state(spark, statement):
        if not left[0]:
            raise Stopped
        left[0] -= 1
        real(spark, statement)
    with patch.object(tables, "_state", state):
        try:
            yield
            raise AssertionError("was not stopped")
        except Stopped:
            pass


def test_replacement_is_completed_under_any_spelling(spark, ns, rows):
    """A stop between two statements; the next write names the table in another way."""
    for k, layout in enumerate(([], ["s"])):
        fqn = append(rows.make([(1, "a"), (2, "b"), (3, "c")], "id int, s string"), ns, f"t{k}", partition_by=layout)
        for n, gone in ((1, 1), (2, 2)):
            with stopped_after(n):
                delete_rows(spark, f"{ns}.t{k}", f"id = {gone}")
            spark.sql(f"USE {ns}")
            try:
                delete_rows(spark, f"t{k}", "id = 99")
            finally:
                spark.sql("USE default")
            assert sorted(r.id for r in spark.table(fqn).collect()) == list(range(gone + 1, 4))
        append(rows.make([(4, "d")], "id int, s string"), ns, f"t{k}")
        assert rows.of(spark.table(fqn)) == [(3, "c"), (4, "d")]


def test_replacement_stopped_before_its_intent_changes_nothing(spark, ns):
    fqn = append(spark.range(3), ns, "t")
    with stopped_after(0):
        replace_table(spark.range(9), fqn)
    assert restore(spark, fqn) is False and spark.table(fqn).count() == 3
    with stopped_after(1):
        replace_table(spark.range(9), fqn)
    with pytest.raises(RuntimeError, match="again"):
        replace_table(spark.range(1), fqn)
    assert spark.table(fqn).count() == 9
    replace_table(spark.table(fqn).where("id > 0"), fqn)
    assert spark.table(fqn).count() == 8
    assert [r.table for r in list_tables(spark, ns).collect()] == ["t"]


def test_replacement_leaves_no_files_of_the_old_contents(spark, tmp_path):
    name = f"n{uuid.uuid4().hex[:8]}"
    tables.ensure_namespace(spark, name, location=str(tmp_path))
    data = spark.range(10).selectExpr("id", "id % 2 AS part")
    for table, layout in (("flat", []), ("parted", ["part"]), ("buckets", ["bucket(2, id)"])):
        fqn = append(data, name, table, partition_by=layout)
        for _ in range(3):
            replace_table(spark.table(fqn).where("id < 9"), fqn)
            delete_rows(spark, fqn, "id = 3")
        stored = [p for p in tmp_path.rglob("*.parquet") if p.relative_to(tmp_path).parts[0].startswith(table)]
        assert {f.split(":", 1)[1].lstrip("/") for f in spark.table(fqn).inputFiles()} == {str(p).lstrip("/") for p in stored}
        assert sorted(r.id for r in spark.table(fqn).collect()) == [0, 1, 2, 4, 5, 6, 7, 8]
        overwritten = data.where("id = 1") if layout == ["part"] else None
        if overwritten is not None:  # partitions at new places are appended to and overwritten like others
            append(data.where("id = 3"), name, table)
            assert spark.table(fqn).count() == 9
            overwrite_partitions(overwritten, fqn)
            assert sorted(r.id for r in spark.table(fqn).collect()) == [0, 1, 2, 4, 6, 8]
        spark.sql(f"DROP TABLE {fqn}")
        assert append(data, name, table, partition_by=layout) and spark.table(fqn).count() == 10


def test_replacement_with_odd_partition_values(spark, ns, rows):
    values = ["a b", "x/y=z", "it's", None, "50%", "ü:1"]
    fqn = append(rows.make([(k, v) for k, v in enumerate(values)] * 2, "id int, s string"), ns, "t", partition_by=["s"])
    delete_rows(spark, fqn, "id = 0")
    replace_table(spark.table(fqn).distinct(), fqn)
    assert rows.of(spark.table(fqn)) == sorted([(k, v) for k, v in enumerate(values) if k], key=repr)
    assert len(spark.sql(f"SHOW PARTITIONS {fqn}").collect()) == 5


def test_too_many_partitions_are_refused(spark, ns, monkeypatch):
    monkeypatch.setattr(tables, "MAX_PARTITIONS", 3)
    fqn = append(spark.range(4).selectExpr("id", "id AS part"), ns, "t", partition_by=["part"])
    with pytest.raises(ValueError, match="hash"):
        delete_rows(spark, fqn, "id >= 0")
    delete_rows(spark, fqn, "id > 1")
    assert spark.table(fqn).count() == 2


def test_retention_of_a_stored_table(spark, ns, rows):
    df = rows.make([(1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2, 5)), (3, None)], "id int, ts timestamp")
    for table, layout in (("plain", []), ("daily", ["days(ts)"])):
        fqn = append(df, ns, table, partition_by=layout)
        expire_table(spark, fqn, "ts", datetime(2024, 1, 2))
        assert [r.id for r in spark.table(fqn).collect()] == [2]
        expire_table(spark, fqn, "ts", datetime(2024, 1, 2, 6))
        assert spark.table(fqn).count() == 0


def test_cost_and_preview(spark, ns):
    fqn = append(spark.range(100), ns, "t")
    row = table_cost(spark, [fqn]).first()
    assert row.rows == 100 and row.bytes > 0 and row.files == len(spark.table(fqn).inputFiles())
    assert [r.id for r in preview(spark.table(fqn), [F.desc("id")], 2).collect()] == [99, 98]


def test_other_tables_are_never_taken_for_leftovers(spark, ns, rows):
    """Whatever a user calls a table, writes to its neighbour leave it alone."""
    df = rows.make([(1, "a"), (2, "b")], "id int, s string")
    names = ["t", "t__old", "t__stg", "t__part", "t__in", "old_t"]
    for _ in range(2):
        for name in names:
            append(df, ns, name, partition_by=["s"] if name == "t__part" else [])
    for name in names:
        delete_rows(spark, quoted(ns, name), "id = 2")
        replace_table(spark.table(quoted(ns, name)), quoted(ns, name))
    assert {n: spark.table(quoted(ns, n)).count() for n in names} == dict.fromkeys(names, 2)
    with pytest.raises(ValueError, match="reserved"):
        append(df, ns, "_terrace_old_t")


def test_overwrites_run_side_by_side(spark, ns, rows):
    """Neither a lock nor a session setting: several overwrites at once, each of its own partitions."""
    fqns = [append(rows.make([(1, "a"), (2, "b")], "id int, s string"), ns, f"t{k}", partition_by=["s"]) for k in range(4)]
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda fqn: overwrite_partitions(rows.make([(9, "a")], "id int, s string"), fqn), fqns))
    assert [rows.of(spark.table(f)) for f in fqns] == [[(2, "b"), (9, "a")]] * 4
    spark.range(2).selectExpr("id", "id AS s").writeTo(quoted(ns, "other")).using("parquet").partitionedBy("s").create()
    with pytest.raises(ValueError, match="dynamic"):
        overwrite_partitions(spark.range(1).selectExpr("id", "id AS s"), quoted(ns, "other"))


def test_locations_may_hold_quotes(spark, tmp_path):
    name = f"n{uuid.uuid4().hex[:8]}"
    tables.ensure_namespace(spark, name, location=str(tmp_path / "it's"))
    assert "it's" in append(spark.range(1), name, "t") or spark.table(quoted(name, "t")).count() == 1
