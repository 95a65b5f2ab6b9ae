"""Compaction, depth splits, merged runs, stream dedup, lineage, sketches and drift on small data."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from terrace.operators import compaction, tables
from terrace.operators.compaction import compact
from terrace.operators.drift import DriftGateError, batch_drift, drift_gate
from terrace.operators.governance import lineage_closure, reaches_raw
from terrace.operators.sketches import batch_sketches, distinct_error, merged, rank_error
from terrace.operators.tables import append, quoted, restore
from terrace.plans.ingest import ingest_increment
from terrace.plans.medallion import record_edges
from terrace.sources.jdbc import depth_predicates, jdbc_options, read_jdbc
from terrace.sources.spec import SourceSpec
from terrace.streaming.streams import current_rows, dedup_stream, finish, merge_runs, stream_files, stream_ingest


# ---- compaction ----

def files(spark, fqn):
    return {f.rsplit("/", 1)[1] for f in spark.table(fqn).inputFiles()}


@pytest.mark.parametrize("layout", [[], ["part"]])
def test_small_files_are_packed_and_large_ones_stay(spark, ns, rows, layout):
    data = spark.range(4000).selectExpr("id", "id % 2 AS part", "uuid() AS text").cache()
    fqn = append(data.coalesce(1), ns, "t", partition_by=layout)
    large = files(spark, fqn)
    for k in range(6):
        append(data.where(f"id % 100 = {k}").coalesce(1), ns, "t")
    before, expected = files(spark, fqn), rows.of(spark.table(fqn))
    gone = compact(spark, fqn, target=40_000)
    after = files(spark, fqn)
    assert large <= after and gone == len(before) - len(large) and len(after) - len(large) == max(1, 2 * len(layout))
    assert rows.of(spark.table(fqn)) == expected
    assert compact(spark, fqn, target=40_000) == 0 and files(spark, fqn) == after


def test_compaction_that_stopped_is_completed(spark, ns, rows, monkeypatch):
    fqn = append(spark.range(5).coalesce(1), ns, "t")
    for k in range(4):
        append(spark.range(k, k + 2).coalesce(1), ns, "t")
    expected, real, calls = rows.of(spark.table(fqn)), tables.remove, []

    def stop(spark, path):
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        calls.append(path)
        real(spark, path)
    monkeypatch.setattr(tables, "remove", stop)
    with pytest.raises(RuntimeError):
        compact(spark, fqn)
    monkeypatch.undo()
    assert restore(spark, fqn) and not restore(spark, fqn)
    spark.catalog.refreshTable(fqn)
    assert rows.of(spark.table(fqn)) == expected and len(files(spark, fqn)) == 1


def test_first_fit_descending(spark):
    sizes = [60, 50, 40, 30, 20, 10, 95]
    found = spark.createDataFrame([("d", f"f{k}", n) for k, n in enumerate(sizes)], "folder string, path string, size long")
    bins = {}
    for r in compaction.packed(found, 100).collect():
        bins.setdefault(r.bin, set()).add(sizes[int(r.path[1:])])
    assert sorted(map(sorted, bins.values())) == [[10, 20, 30], [40, 60]] or sorted(map(sorted, bins.values())) == [[10, 30, 50], [40, 60]] \
        or sorted(map(sum, bins.values())) == [100, 100]


def test_bucketed_tables_are_not_compacted(spark, ns):
    with pytest.raises(ValueError, match="buckets"):
        compact(spark, append(spark.range(3), ns, "t", partition_by=["bucket(2, id)"]))


# ---- splits by depth ----

URL = "jdbc:derby:memory:depth;create=true"


@pytest.fixture(scope="module")
def hot_ids(spark):
    """1,000 ids in a narrow range, 60 spread over billions, 30 rows without an id."""
    rows = spark.range(1000).selectExpr("id + 500000000 AS id").union(spark.range(60).selectExpr("id * 100000000 - 7"))
    rows = rows.union(spark.range(30).selectExpr("CAST(NULL AS BIGINT)")).selectExpr("id", "id % 7 AS v")
    rows.write.format("jdbc").mode("overwrite").options(url=URL, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver", dbtable="hot").save()


def hot(monkeypatch, **more):
    monkeypatch.setenv("DEPTH_USER", "app")
    monkeypatch.setenv("DEPTH_PASSWORD", "app")
    return SourceSpec("hot", {"url": URL, "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "user_env": "DEPTH_USER",
                              "password_env": "DEPTH_PASSWORD", "split": "depth", "partition_column": "id", "num_partitions": 8, **more}, "jdbc")


def test_depth_split_of_a_hot_range(spark, hot_ids, monkeypatch):
    for options in ({"dbtable": "hot"}, {"query": 'SELECT "id", "v" FROM hot'}):
        df = read_jdbc(spark, hot(monkeypatch, **options))
        sizes = [r["n"] for r in df.where("id IS NOT NULL").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert df.count() == 1090 and len(sizes) <= 9 and max(sizes) <= 2 * 1060 / 8
        above = read_jdbc(spark, hot(monkeypatch, **options), ("id", 500000899))
        assert above.count() == 100 + 54 and above.where("id IS NULL").count() == 0
        sizes = [r["count"] for r in above.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) > 4 and max(sizes) <= 2 * 154 / 8
    assert read_jdbc(spark, hot(monkeypatch, dbtable="hot"), ("id", 10 ** 12)).count() == 0
    assert depth_predicates(spark, hot(monkeypatch, query='SELECT "id", "v" FROM hot WHERE 1 = 0')) == ["1 = 1"]


def test_increment_is_split_by_depth(spark, ns, hot_ids, monkeypatch):
    spec = hot(monkeypatch, dbtable="hot")
    spec = SourceSpec(spec.name, spec.options, spec.type, ns)
    assert ingest_increment(spark, spec, "id", "b1", (ns, "state"))[1] == 1060
    assert ingest_increment(spark, spec, "id", "b2", (ns, "state"))[1] == 0
    assert spark.table(quoted(ns, "hot")).count() == 1060


def test_depth_split_takes_no_bounds(monkeypatch):
    for wrong in ({"lower_bound": 1}, {"num_partitions": ""}, {"split": "width"}):
        with pytest.raises(ValueError):
            jdbc_options(hot(monkeypatch, dbtable="hot", **wrong))


# ---- change tables ----

def test_a_small_run_rewrites_no_large_one(spark, ns, rows):
    schema = "k long, seq long, op string, _epoch string"
    fqn = append(spark.range(300).selectExpr("id AS k", "0L AS seq", "'i' AS op", "'big' AS _epoch"), ns, "t", partition_by=["_epoch"])
    big = {f for f in spark.table(fqn).inputFiles() if "big" in f}
    for n in range(9):
        append(rows.make([(n % 4, n + 1, "d" if n == 8 else "u", f"r:{n}"), (500 + n, n, "i", f"r:{n}")], schema), ns, "t")
        for runs in merge_runs(spark, fqn, ["k"], "seq", "op", fanout=3):
            assert len(runs) >= 3 and "big" not in runs
    assert big <= set(spark.table(fqn).inputFiles())
    assert len(spark.sql(f"SHOW PARTITIONS {fqn}").collect()) <= 1 + 2 * 3
    found = current_rows(spark.table(fqn), ["k"], "seq", "op")
    assert found.count() == 300 + 9 - 1 and found.where("k = 0").count() == 0
    assert rows.of(found.where("k IN (1, 2, 3)")) == [(1, 6), (2, 7), (3, 8)]


def test_events_delivered_again_come_once(spark, ns, rows, tmp_path):
    spec = SourceSpec("feed", {"path": f"{tmp_path}/in", "format": "parquet"}, namespace=ns)
    schema = "id int, ts timestamp"

    def deliver(*events):
        rows.make([(i, datetime(2024, 1, 1, h)) for i, h in events], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = dedup_stream(stream_files(spark, spec, schema, max_files=1), ["id"], "ts", "2 hours")
        return rows.of(finish(stream_ingest(stream, spec, f"{tmp_path}/ck", "r"), spark, quoted(ns, "feed")).select("id"))
    assert deliver((1, 1), (2, 2), (1, 1)) == [(1,), (2,)]
    assert deliver((2, 2), (3, 5), (1, 1)) == [(1,), (2,), (3,)]
    assert deliver((4, 5), (9, 0)) == [(1,), (2,), (3,), (4,)]  # 9 is older than the watermark


# ---- lineage ----

def test_closure_with_cycles_and_diamonds(rows):
    edges = rows.make([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y1"), ("x", "y2"), ("y1", "z"), ("y2", "z"), ("x", "z"),
                       ("s", "s"), (None, "a"), ("d", None), ("a", "b")], "source string, target string")
    found = rows.of(lineage_closure(edges).select("source", "target", "hops"))
    assert found == sorted([("a", "b", 1), ("a", "c", 2), ("a", "a", 3), ("a", "d", 3), ("b", "c", 1), ("b", "a", 2), ("b", "b", 3), ("b", "d", 2),
                            ("c", "a", 1), ("c", "b", 2), ("c", "c", 3), ("c", "d", 1), ("x", "y1", 1), ("x", "y2", 1), ("x", "z", 1),
                            ("y1", "z", 1), ("y2", "z", 1), ("s", "s", 1)], key=repr)
    tables_ = rows.make([("z",), ("d",), ("y1",), ("alone",)], "table string")
    traced = reaches_raw(tables_, lineage_closure(edges), rows.make([("x",)], "source string"))
    assert rows.of(traced) == [("alone", False), ("d", False), ("y1", True), ("z", True)]
    assert lineage_closure(edges.where("false")).count() == 0


def test_edges_are_recorded_once(spark, ns, rows):
    for _ in range(2):
        record_edges(spark, ["`bronze`.`orders`", "bronze.nation"], "`silver`.`orders`", (ns, "edges"))
    record_edges(spark, [], "x", (ns, "edges"))
    assert rows.of(spark.table(quoted(ns, "edges"))) == [("bronze.nation", "silver.orders"), ("bronze.orders", "silver.orders")]


# ---- sketches and drift ----

def test_merged_sketches_keep_their_bounds(spark):
    data = spark.range(60_000).selectExpr("id % 7 AS batch", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE 'cold' END AS g", "hash(id) % 10000 AS ms", "id % 9000 AS who")
    data = data.union(spark.createDataFrame([(9, "none", None, None)], data.schema))
    found = {r.g: r for r in merged(batch_sketches(data, ["batch", "g"], "ms", "who"), ["g"], 0.95).collect()}
    assert found["none"].quantile_value is None and found["none"].distinct_count == 0 and found["none"].rows == 0
    for g, n, who in (("hot", 20_000, 3000), ("cold", 40_000, 6000)):
        below = data.where(f"g = '{g}' AND ms <= {found[g].quantile_value}").count() / n
        assert abs(below - 0.95) <= rank_error() + 0.001 and found[g].rows == n
        assert abs(found[g].distinct_count - who) <= distinct_error() * who


def test_drift_between_batches(rows):
    even = [("a", float(v)) for v in range(100)] + [("b", float(v) + 0.5) for v in range(100)]
    data = rows.make(even + [("c", 500.0)] * 50 + [("c", None)] * 9 + [("d", 500.0)] * 10, "batch string, v double")
    report = {r.batch: r for r in batch_drift(data, "batch", "v").collect()}
    assert report["a"].drift is None and report["a"].before is None
    assert report["b"].drift < 0.01 and report["c"].drift > 1 and report["c"].rows == 50
    assert report["d"].drift == 0 and report["d"].before == "c"
    assert drift_gate(data, "batch", "v", "b").count() == 4
    with pytest.raises(DriftGateError, match="'c'"):
        drift_gate(data, "batch", "v", "c")
    assert batch_drift(data.where("false"), "batch", "v").count() == 0
