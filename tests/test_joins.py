import pytest
from pyspark.sql import functions as F

from terrace.operators import aggregates
from terrace.operators.aggregates import duplicate_keys, kpi, kpi_sets, unknown_names
from terrace.operators.joins import (
    conform, edges_with_facts, join_unique, lookup, matched, orphans, rows_with_run)


@pytest.fixture(params=["broadcast", "shuffled"])
def route(request, spark):
    """Run a test with and without Spark's own broadcast."""
    if request.param == "shuffled":
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield request.param
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def facts(spark):
    """A third of the rows share one key, some have none, some match nothing."""
    key = (F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, None)
           .otherwise(F.col("id") % 50)).cast("int")
    return spark.range(3000).select(key.alias("k"), "id")


@pytest.fixture
def dim(spark):
    return spark.range(40).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("d"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_join_unique_equals_a_plain_join(route, facts, dim, rows, how):
    assert rows.of(join_unique(facts, dim, "k", how)) == rows.of(facts.join(dim, "k", how))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("kind", ["bigint", "double", "decimal(12,2)"])
def test_keys_of_different_types_meet(route, facts, dim, rows, how, kind):
    wide = dim.withColumn("k", F.col("k").cast(kind))
    assert rows.of(join_unique(facts, wide, "k", how)) == rows.of(facts.join(wide, "k", how))


def test_empty_sides(route, facts, dim, rows):
    assert join_unique(facts.where("false"), dim, "k").count() == 0
    assert join_unique(facts, dim.where("false"), "k", "left_anti").count() == facts.count()


def test_conform(route, rows):
    fact = rows.make([(1, "a"), (2, "b"), (None, "c")], "k int, f string")
    dim = rows.make([(1, "one"), (None, "null")], "k int, d string")
    assert rows.of(conform(fact, dim, "k")) == [(-1, "b", None), (-1, "c", None), (1, "a", "one")]
    with pytest.raises(ValueError, match="unique"):
        conform(fact, dim.where("k = 1").unionByName(dim), "k")


def test_lookup_keeps_the_row_count(route, rows):
    df = rows.make([(1, "x"), (1, "x"), (3, "y")], "k int, v string")
    seed = rows.make([(1, "one"), (2, "two")], "k int, name string")
    assert rows.of(lookup(df, seed, "k")) == [(1, "x", "one"), (1, "x", "one"), (3, "y", None)]


def test_orphans_count_null_keys(route, rows):
    child = rows.make([(1, 1), (2, 1), (None, 1), (1, None)], "a int, b int")
    parent = rows.make([(1, 1), (1, 1), (None, None)], "a int, b int")
    assert rows.of(orphans(child, parent, ["a", "b"])) == [(1, None), (2, 1), (None, 1)]
    assert rows.of(matched(child, parent, ["a", "b"])) == [(1, 1)]


def test_parallel_edges_do_not_multiply_facts(route, rows):
    facts = rows.make([("c1", "m1", 5.0), ("c1", "m2", 6.0)], "source string, target string, amount double")
    edges = rows.make([("c1", "m1", 2), ("c1", "m1", 3)], "source string, target string, weight int")
    assert rows.of(edges_with_facts(facts, edges, ["source", "target"], "weight")) == [("c1", "m1", 5.0, 5)]


def test_rows_with_run(rows):
    raw = rows.make([("b1", "s", 1), ("b2", "s", 2)], "_batch_id string, _source string, v int")
    runs = rows.make([("b1", "s", "failed", None, 1), ("b1", "s", "ok", 1, 2), ("b1", "s", "failed", None, 3), ("b3", "s", "ok", 1, 1)],
                     "batch_id string, source string, status string, rows bigint, started_at int")
    assert rows.of(rows_with_run(raw, runs)) == [("b1", "s", 1, "ok", 1)]


def test_kpi_sets_equal_a_plain_cube(rows):
    df = rows.make([(k % 3 if k % 7 else None, k % 2, k % 5, float(k)) for k in range(60)], "a int, b int, c int, v double")
    measures = {"n": ("count", "*"), "s": ("sum", "v"), "m": ("avg", "v"), "d": ("distinct", "c"), "e": ("distinct", "v"), "x": ("max", "v")}
    plain = {"n": F.count("*"), "s": F.sum("v"), "m": F.avg("v"), "d": F.countDistinct("c"), "e": F.countDistinct("v"), "x": F.max("v")}
    for mode in ("group", "rollup", "cube"):
        assert rows.of(kpi_sets(df, ["a", "b"], measures, mode)) == rows.of(kpi(df, ["a", "b"], plain, mode))
    plan = kpi_sets(df, ["a", "b"], measures)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Expand") < plan.rindex("Aggregate")  # the plan is printed from the top
    with pytest.raises(ValueError):
        kpi_sets(df, ["a"], {"n": ("median", "v")})


def test_kpi_sets_hold_no_value_of_a_set_in_memory(rows, monkeypatch):
    monkeypatch.setattr(aggregates, "PART_ROWS", 7, raising=False)  # many parts
    # A frequent value, NULL values and groups, rows that repeat, both zeros.
    data = [(k % 3 if k % 7 else None, "x" if k % 2 else None, None if k % 11 == 0 else 1 if k % 3 else k, -0.0 if k % 4 else 0.0)
            for k in range(90)] * 2
    df = rows.make(data, "a int, b string, c int, v double")
    measures = {"d": ("distinct", "c"), "n": ("count", "c"), "e": ("distinct", "v"), "s": ("sum", "c")}
    plain = {"d": F.countDistinct("c"), "n": F.count("c"), "e": F.countDistinct("v"), "s": F.sum("c")}
    for mode in ("group", "rollup", "cube"):
        found, expected = kpi_sets(df, ["a", "b"], measures, mode), kpi(df, ["a", "b"], plain, mode)
        assert rows.of(found) == rows.of(expected)
        assert found.schema.simpleString() == expected.schema.simpleString()
    assert rows.of(kpi_sets(df.limit(0), ["a"], {"d": ("distinct", "c")}, "rollup")) == rows.of(
        kpi(df.limit(0), ["a"], {"d": F.countDistinct("c")}, "rollup"))
    lines = kpi_sets(df, ["a", "b"], measures)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    above = lines[:next(i for i, line in enumerate(lines) if "Expand" in line)]
    # What is expanded is grouped by the grouping set alone, never by the values counted distinct.
    keys = [line[line.index("["):line.index("]")] for line in above if "Aggregate [" in line]
    assert keys and not any("_distinct" in k for k in keys)


def test_aggregates(rows):
    df = rows.make([("a", 1), ("a", 1), ("b", 2)], "k string, v int")
    assert rows.of(duplicate_keys(df, ["k", "v"])) == [("a", 1, 2)]
    measures = {"total": F.sum("v"), "kinds": F.countDistinct("v")}
    assert rows.of(kpi(df, ["k"], measures)) == [("a", 2, 1), ("b", 2, 1)]
    assert rows.of(kpi(df, ["k"], measures, "rollup")) == [("a", 2, 1), ("b", 2, 1), (None, 4, 2)]
    assert kpi(df, ["k", "v"], {"n": F.count("*")}, "cube").count() == 2 + 2 + 2 + 1
    with pytest.raises(ValueError):
        kpi(df, ["k"], measures, "pivot")
    known = rows.make([("b",), ("b",)], "name string")
    asked = rows.make([("z",), ("b",), ("a",), ("z",)], "name string")
    assert [r.name for r in unknown_names(asked, known).collect()] == ["a", "z"]
