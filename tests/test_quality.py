from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from terrace.functions import rules as R
from terrace.functions.audit import enrich
from terrace.operators.governance import (
    completeness, expire, freshness, lineage, trust_score)
from terrace.operators.quality import (
    RuleGateError, audit_contract, gate, rule_report, schema_report, split_by_rules)

SCHEMA = "id int, name string, tags array<string>, kind string, a string, b string, m map<string,string>"
DATA = [
    (1, "one", ["x"], "file", "v", None, {"k": "1"}),
    (1, "two", ["x", "x"], "jdbc", "v", "w", {"z": "1"}),
    (2, None, [], "ftp", "", None, None),
    (None, "T", None, None, None, "w", {}),
]


def all_rules():
    return [
        R.required("id"), R.unique("id"), R.matches("name", "^[a-z]+$"), R.one_of("kind", ["file", "jdbc"]),
        R.min_length("name", 2), R.at_least("id", 2), R.unique_items("tags"), R.min_items("tags", 1),
        R.exactly_one_of("a", "b"), R.only_keys("m", ["k"]), R.constant("kind", "file"),
        R.when(F.col("kind") == "jdbc", R.required("b")), R.castable("a", "int", "double"),
    ]


def test_every_rule_kind(rows):
    report = {r.rule: (r.checked, r.failed) for r in rule_report(rows.make(DATA, SCHEMA), all_rules()).collect()}
    assert report == {
        "id:required": (4, 1), "id:unique": (3, 2), "name:pattern": (3, 1), "kind:enum": (3, 1),
        "name:min_length": (3, 1), "id:minimum": (3, 2), "tags:unique_items": (3, 1),
        "tags:min_items": (3, 1), "a|b:one_of": (4, 2), "m:closed": (3, 1), "kind:const": (3, 2),
        "b:required": (1, 0), "a:type": (2, 2)}


def test_split_names_the_broken_rules_in_order(rows):
    df = rows.make(DATA, SCHEMA)
    passed, held = split_by_rules(df, all_rules()[:5])
    assert passed.count() == 0 and passed.columns == df.columns
    assert rows.of(held.select("name", F.array_join("_failed_rules", ","))) == [
        ("T", "id:required,name:pattern,name:min_length"), ("one", "id:unique"),
        ("two", "id:unique"), (None, "kind:enum")]
    among = split_by_rules(df, [R.when(F.col("kind") != "jdbc", R.unique("id"))])
    assert among[1].count() == 0
    assert split_by_rules(df, [])[0].count() == 4


@settings(max_examples=7, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)),
                          st.one_of(st.none(), st.sampled_from(["", "a", "b" * 40, "c" * 40]))), max_size=10))
def test_split_keeps_every_row_once(rows, data):
    df = rows.make(data, "n int, s string")
    rules = [R.unique("n", "s"), R.at_least("n", 1), R.required("s")]
    passed, held = split_by_rules(df, rules)
    assert rows.of(passed.unionByName(held.select("n", "s"))) == rows.of(df)
    bad = [r for r in data if r[1] is None or (r[0] is not None and (r[0] < 1 or data.count(r) > 1))]
    assert rows.of(held.select("n", "s")) == sorted(bad, key=repr)
    for r in rule_report(df, rules).collect():
        assert r.failed == held.where(F.array_contains("_failed_rules", r.rule)).count()


def test_gate(rows):
    df = rows.make([(1,), (2,), (3,), (0,)], "v int")
    rules = [R.at_least("v", 1)]
    assert [f.count() for f in gate(df, rules, 0.25)] == [3, 1]
    with pytest.raises(RuleGateError, match="1 of 4"):
        gate(df, rules, 0.2)
    assert gate(df.where("v > 9"), rules, 0.0)[0].count() == 0


def test_schema_report(spark, rows):
    df = rows.make([(1, "a", 2)], "ID int, s string, x bigint")
    report = schema_report(df, {"id": "int", "s": "int", "missing": "date"})
    assert rows.of(report.select("column", "status")) == [
        ("id", "ok"), ("missing", "missing"), ("s", "type_mismatch"), ("x", "extra")]
    good = audit_contract(enrich(df, "s", "jdbc", "b"))
    assert [r.status for r in good.collect()] == ["ok"] * 5
    assert {r.status for r in audit_contract(df).collect()} == {"missing"}
    assert all(r.column.startswith("_") for r in good.collect())


def test_freshness_and_retention(rows):
    df = rows.make([("a", datetime(2024, 1, 1)), ("a", datetime(2024, 1, 2)), ("b", None)],
                   "k string, ts timestamp")
    as_of = datetime(2024, 1, 2, 1)
    report = freshness(df, "ts", as_of, timedelta(hours=1), ["k"]).orderBy("k").collect()
    assert [(r.age_seconds, r.stale) for r in report] == [(3600, False), (None, True)]
    empty = freshness(df.where("k = 'c'"), "ts", as_of, timedelta(hours=1)).first()
    assert empty.stale is True and empty.newest is None
    assert expire(df, "ts", datetime(2024, 1, 2)).count() == 1
    by_day = df.withColumn("ts_day", F.to_date("ts"))
    assert expire(by_day, "ts", datetime(2024, 1, 1, 12)).count() == 1


def test_completeness(rows):
    df = rows.make([("a", ["x"], 1), (" ", [], None), (None, None, 3), ("b", ["y"], 4)],
                   "s string, tags array<string>, n int")
    assert dict(rows.of(completeness(df, ["s", "tags", "n"]))) == {
        "s": 0.5, "tags": 0.5, "n": 0.75, "overall": pytest.approx(7 / 12)}


def test_trust_score(rows):
    parts = rows.make([("t1", 1.0, 0.5, "me", True), ("t2", 1.0, None, None, True), ("t3", None, None, "me", True),
                       ("t4", 1.0, 1.0, "me", None)],
                      "t string, rules double, fresh double, owner string, has_lineage boolean")
    scored = trust_score(parts, {"rules": 3, "fresh": 1}, 0.8).orderBy("t").collect()
    assert [(r.score, r.promotable) for r in scored] == [
        (0.875, True), (1.0, False), (None, False), (1.0, False)]


def test_lineage_lists_successful_edges_once(rows):
    runs = rows.make([("b", "s", "t", "ok"), ("b", "s", "t", "ok"), ("b", "u", "t", "failed")],
                     "batch_id string, source string, target string, status string")
    assert rows.of(lineage(runs)) == [("b", "s", "t")]
