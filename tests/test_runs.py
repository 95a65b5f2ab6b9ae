from datetime import datetime, timedelta

import pytest

from terrace.__main__ import main
from terrace.operators.changes import unfinished_attempts
from terrace.operators.runs import (
    RUN_SCHEMA, failed_sources, failure_rate, pair_events, run_summary, sla)
from terrace.operators.tables import quoted
from terrace.plans import ingest
from terrace.plans.ingest import ingest_all, ingest_increment, ingest_source, new_batch_id
from terrace.sources.spec import SourceSpec


@pytest.fixture
def specs(ns, tmp_path):
    for name, lines in (("one", 3), ("two", 2)):
        (tmp_path / f"{name}.csv").write_text("v\n" + "".join(f"{i}\n" for i in range(lines)))

    def spec(name, **more):
        return SourceSpec(name, {"path": f"{tmp_path}/{name}.csv", "format": "csv"}, namespace=ns, **more)
    return [spec("one"), spec("gone"), spec("two"), spec("off", enabled=False)]


def outcome(runs):
    return [(r.source, r.status, r.rows) for r in runs.collect()]


@pytest.mark.parametrize("concurrency", [1, 3])
def test_a_failure_stays_with_its_source(spark, ns, specs, concurrency):
    runs = ingest_all(spark, specs, batch_id="b1", audit_table=(ns, "runs"), concurrency=concurrency)
    assert outcome(runs) == [("one", "ok", 3), ("gone", "failed", None), ("two", "ok", 2), ("off", "skipped", None)]
    gone = runs.where("source = 'gone'").first()
    assert "PATH_NOT_FOUND" in gone.error and gone.event == "source.ingest.error" and gone.target == f"{ns}.gone"
    assert spark.table(quoted(ns, "runs")).count() == 4
    assert run_summary(runs).first()[1:] == (2, 1, 1)
    assert [r.source for r in failed_sources(spark.table(quoted(ns, "runs")), "b1").collect()] == ["gone"]


def test_sources_may_share_a_table(spark, ns, specs):
    shared = [SourceSpec(f"s{i}", specs[0].options, namespace=ns, table="all") for i in range(6)]
    assert {s for _, s, _ in outcome(ingest_all(spark, shared, concurrency=6))} == {"ok"}
    assert spark.table(quoted(ns, "all")).count() == 18


def test_fail_fast_and_only(spark, specs):
    assert [s for _, s, _ in outcome(ingest_all(spark, specs, fail_fast=True))] == [
        "ok", "failed", "skipped", "skipped"]
    assert outcome(ingest_all(spark, specs, only=["two", "off"])) == [("two", "ok", 2), ("off", "skipped", None)]
    with pytest.raises(ValueError, match="nope"):
        ingest_all(spark, specs, only=["nope"])


def test_retry_of_failed_sources_only(spark, ns, specs, tmp_path):
    ingest_all(spark, specs, batch_id="b1", audit_table=(ns, "runs"))
    (tmp_path / "gone.csv").write_text("v\n1\n")
    again = [r.source for r in failed_sources(spark.table(quoted(ns, "runs")), "b1").collect()]
    ingest_all(spark, specs, only=again, batch_id="b1", audit_table=(ns, "runs"))
    assert failed_sources(spark.table(quoted(ns, "runs")), "b1").count() == 0
    assert spark.table(quoted(ns, "one")).count() == 3


def test_empty_source_counts_zero_rows(spark, ns, tmp_path):
    spark.range(0).write.parquet(f"{tmp_path}/empty")
    spec = SourceSpec("empty", {"path": f"{tmp_path}/empty", "format": "parquet"}, namespace=ns)
    assert ingest_source(spark, spec, "b1")[1] == 0
    assert ingest_source(spark, spec, "b2")[1] == 0


def test_batch_ids_are_fresh():
    assert new_batch_id() != new_batch_id() and len(new_batch_id()) == 36


def increments(spark, ns, tmp_path):
    spec = SourceSpec("feed", {"path": f"{tmp_path}/feed", "format": "parquet"}, namespace=ns)

    def load(batch):
        return ingest_increment(spark, spec, "id", batch, (ns, "marks"))[1]
    return load


def test_increments(spark, ns, tmp_path, rows):
    load = increments(spark, ns, tmp_path)
    rows.make([(1,), (2,), (None,)], "id int").write.parquet(f"{tmp_path}/feed")
    assert load("b1") == 2
    assert load("b2") == 0
    rows.make([(2,), (5,)], "id int").write.mode("append").parquet(f"{tmp_path}/feed")
    assert load("b3") == 1
    assert rows.of(spark.table(quoted(ns, "feed")).select("id", "_batch_id")) == [
        (1, "b1"), (2, "b1"), (5, "b3")]


def test_increment_stopped_after_its_write_is_taken_back(spark, ns, tmp_path, rows, monkeypatch):
    load = increments(spark, ns, tmp_path)
    rows.make([(1,)], "id int").write.parquet(f"{tmp_path}/feed")
    load("b1")
    other = SourceSpec("other", {"path": f"{tmp_path}/feed", "format": "parquet"}, namespace=ns, table="feed")
    ingest_source(spark, other, "b2")  # the same batch of another source must stay
    rows.make([(2,)], "id int").write.mode("append").parquet(f"{tmp_path}/feed")
    real = ingest._append_counted

    def write_and_die(*args, **options):
        real(*args, **options)
        raise KeyboardInterrupt
    monkeypatch.setattr(ingest, "_append_counted", write_and_die)
    with pytest.raises(KeyboardInterrupt):
        load("b2")
    monkeypatch.undo()
    assert spark.table(quoted(ns, "feed")).count() == 3
    assert load("b3") == 1 and load("b4") == 0
    assert unfinished_attempts(spark.table(quoted(ns, "marks"))) == []
    assert rows.of(spark.table(quoted(ns, "feed")).select("id", "_batch_id")) == [
        (1, "b1"), (1, "b2"), (2, "b3")]


def run(batch, source, status, minute, ms):
    return (batch, source, "file", "t", "e", status, None, datetime(2024, 1, 1, 0, minute), ms, None)


def test_rates(rows):
    runs = rows.make([run("b1", "a", "ok", 1, 100), run("b1", "a", "failed", 2, 900),
                      run("b1", "b", "skipped", 1, None), run("b1", "c", "failed", 1, 50),
                      run("b1", "c", "ok", 3, 700)], RUN_SCHEMA)
    assert rows.of(failure_rate(runs)) == [(4, 0.5)]
    assert rows.of(failure_rate(runs, ["source"])) == [("a", 2, 0.5), ("c", 2, 0.5)]
    assert rows.of(sla(runs, 600)) == [("a", 900, 900, 1), ("b", None, None, 0), ("c", 700, 700, 1)]
    assert rows.of(failed_sources(runs, "b1")) == [("a",)]


def test_log_lines_pair_up(rows):
    start = datetime(2024, 1, 1)
    lines = [("b", s, f"source.ingest.{e}", start + timedelta(seconds=t)) for s, e, t in (
        ("a", "start", 0), ("a", "end", 2), ("f", "start", 1), ("f", "error", 4), ("r", "start", 5),
        ("again", "start", 0), ("again", "error", 1), ("again", "start", 2), ("again", "end", 3))]
    pairs = pair_events(rows.make(lines, "batch_id string, source string, event string, timestamp timestamp"))
    assert rows.of(pairs.select("source", "duration_ms", "status")) == [
        ("a", 2000, "ok"), ("again", 3000, "ok"), ("f", 3000, "failed"), ("r", None, "running")]


def test_command(spark, ns, tmp_path):
    (tmp_path / "one.csv").write_text("v\n1\n")
    text = f"""
version: 1
sources:
- {{name: one_csv, type: file, target: {{namespace: {ns}, table: one}},
   options: {{path: {tmp_path}/one.csv, format: csv}}}}
- {{name: two_csv, type: file, target: {{namespace: {ns}, table: two}},
   options: {{path: {tmp_path}/none.csv, format: csv}}}}
"""
    (tmp_path / "sources.yml").write_text(text)
    args = ["--registry", str(tmp_path / "sources.yml"), "--batch-id", "b7"]
    assert main([*args, "--only", "one_csv"]) == 0
    assert main(args) == 1
    assert spark.table(quoted(ns, "one")).where("_batch_id = 'b7'").count() == 2
