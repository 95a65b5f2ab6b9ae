"""Bronze to Silver and Silver to Gold."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terrace.functions.rules import Rule
from terrace.operators.aggregates import kpi
from terrace.operators.quality import gate
from terrace.operators.staging import dedup, null_policy, type_rules, typed_columns, upsert_into
from terrace.operators.tables import (
    append, quoted, restore, rollback_batch, table_exists, write_partitioned)
from terrace.workspace import materialise, scratch_scope


def stage(raw: DataFrame, types: Mapping[str, str], nulls: Mapping[str, tuple],
          rules: Sequence[Rule], keys: Sequence[str], order_by: str,
          max_failed_share: float | None = None) -> tuple[DataFrame, DataFrame]:
    """Typed, complete, valid, deduplicated rows, and the raw rows that did not qualify.

    Every raw row is judged in one pass: its casts first, and the rules only where all
    casts succeeded.
    """
    casts = type_rules(raw, types, inside="_raw")
    unread = reduce(lambda a, b: a | b, [c.checked & ~c.passed for c in casts], F.lit(False))
    rows = raw.select(*typed_columns(raw, types), F.struct(*[quoted(c) for c in raw.columns]).alias("_raw"))
    rows = null_policy(rows, nulls, exempt=unread)
    passed, held = gate(rows, rules, max_failed_share, first=casts)
    return (dedup(passed.drop("_raw"), keys, [order_by]),
            held.select("_raw.*", "_failed_rules"))


def refresh_silver(raw: DataFrame, table: str, types: Mapping[str, str], keys: Sequence[str],
                   order_by: str, nulls: Mapping[str, tuple] | None = None,
                   rules: Sequence[Rule] = (), namespace: str = "silver",
                   catalog: str | None = None, max_failed_share: float | None = None,
                   partition_by: Sequence[str] = (), batch_ids: Sequence[str] | None = None,
                   fed_by: Sequence[str] = (), edges: tuple[str, str] | None = None) -> str:
    """Merge staged rows into a Silver table; rows that fail go to ``<table>_quarantine``.

    A rerun of the same batch leaves both as they are. ``batch_ids`` names the batches in
    ``raw``; without it they are looked up, which reads that column once more. With
    ``partition_by`` columns that belong to the keys, or transforms of them
    (``hash(64, key)``), a refresh rewrites only the partitions it touches. The tables in ``fed_by``
    are recorded as its sources in the table ``edges`` (namespace, table).
    """
    spark = raw.sparkSession
    fqn = quoted(catalog, namespace, table)
    record_edges(spark, fed_by, fqn, edges, catalog)
    with scratch_scope(spark):
        good, bad = stage(raw, types, nulls or {}, rules, keys, order_by, max_failed_share)
        _quarantine(raw, bad, namespace, f"{table}_quarantine", catalog, batch_ids)
        restore(spark, fqn)
        if not table_exists(spark, fqn):
            return append(good, namespace, table, catalog, partition_by)
        # The staged rows are read three times below, so they are computed once.
        upsert_into(materialise(good, "staged"), fqn, keys, order_by)
    return fqn


def _quarantine(raw: DataFrame, bad: DataFrame, namespace: str, table: str,
                catalog: str | None, batch_ids: Sequence[str] | None) -> None:
    """Replace what is held of the batches in ``raw``; rows without a batch are only added."""
    spark, held = raw.sparkSession, quoted(catalog, namespace, table)
    batched = "_batch_id" in raw.columns
    if batched and table_exists(spark, held):
        if batch_ids is None:
            batch_ids = [r["_batch_id"] for r in raw.select("_batch_id").distinct().dropna().collect()]
        for batch in batch_ids:
            rollback_batch(spark, held, batch)
    append(bad, namespace, table, catalog, ["_batch_id"] if batched else (), evolve=True)


def refresh_gold(facts: DataFrame, table: str, by: Sequence[str], measures: Mapping[str, Column],
                 partition_by: Sequence[str], mode: str = "group", namespace: str = "gold",
                 catalog: str | None = None, fed_by: Sequence[str] = (),
                 edges: tuple[str, str] | None = None) -> str:
    """Aggregate and write, replacing the partitions that were computed."""
    record_edges(facts.sparkSession, fed_by, quoted(catalog, namespace, table), edges, catalog)
    return write_partitioned(kpi(facts, by, measures, mode), namespace, table, partition_by, catalog)


def record_edges(spark: SparkSession, sources: Sequence[str], target: str,
                 edges: tuple[str, str] | None, catalog: str | None = None) -> None:
    """Append ``source, target`` rows that the edge table does not hold yet."""
    if not edges or not sources:
        return
    rows = spark.createDataFrame([(s.replace("`", ""), target.replace("`", "")) for s in sources], "source string, target string")
    held = quoted(catalog, *edges)
    if table_exists(spark, held):
        rows = rows.join(spark.table(held), ["source", "target"], "left_anti")
    if not rows.isEmpty():
        append(rows, *edges, catalog=catalog)


def read_table(spark: SparkSession, namespace: str, table: str,
               catalog: str | None = None) -> DataFrame:
    return spark.table(quoted(catalog, namespace, table))
