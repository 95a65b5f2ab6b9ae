"""Freshness, completeness, trust, retention, lineage and cost."""

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from terrace.operators.tables import (
    bounded, delete_rows, in_partitions, literal, partition_columns, quoted, replace_partitions, restore)
from terrace.workspace import materialise


def _moment(df: DataFrame, ts: str, value: datetime) -> Column:
    """A point in time in the type of a column; text keeps the driver's own zone out of it."""
    return F.lit(str(value)).cast(df.schema[ts].dataType)


def freshness(df: DataFrame, ts: str, as_of: datetime, max_age: timedelta,
              by: Sequence[str] = ()) -> DataFrame:
    """Newest row, its age in seconds at ``as_of`` and whether that is too old.

    An empty table has no age and is stale.
    """
    report = df.groupBy(*by).agg(F.max(ts).alias("newest"))
    now = _moment(df, ts, as_of)
    age = F.timestamp_diff("SECOND", F.col("newest"), now)
    stale = F.coalesce(age > int(max_age.total_seconds()), F.lit(True))
    return report.withColumn("age_seconds", age).withColumn("stale", stale)


def _filled(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.simpleString()
    if kind.startswith(("array", "map")):
        return F.coalesce(F.size(column) > 0, F.lit(False))
    present = F.col(column).isNotNull()
    return present & (F.trim(column) != "") if kind == "string" else present


def completeness(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Share of filled (not NULL, not blank, not empty) values per field and in ``overall``."""
    shares = [F.avg(F.when(_filled(df, c), 1.0).otherwise(0.0)).alias(f"s{i}")
              for i, c in enumerate(fields)]
    rows = [F.struct(F.lit(c).alias("field"), F.col(f"s{i}").alias("share"))
            for i, c in enumerate(fields)]
    mean = sum((F.col(f"s{i}") for i in range(len(fields))), F.lit(0.0)) / len(fields)
    rows.append(F.struct(F.lit("overall").alias("field"), mean.alias("share")))
    return df.agg(*shares).select(F.inline(F.array(*rows)))


def trust_score(parts: DataFrame, weights: Mapping[str, float], threshold: float,
                owner: str = "owner", lineage: str = "has_lineage") -> DataFrame:
    """Weighted mean of the non-NULL score columns, and whether the table may go to Gold."""
    def total(term):
        return reduce(lambda a, b: a + b, [
            F.when(F.col(c).isNotNull(), term(c, w)).otherwise(0.0) for c, w in weights.items()])
    score = F.try_divide(total(lambda c, w: F.col(c) * w), total(lambda c, w: F.lit(float(w))))
    ready = (F.coalesce(score >= threshold, F.lit(False)) & F.col(owner).isNotNull()
             & F.coalesce(F.col(lineage), F.lit(False)))
    return parts.withColumn("score", score).withColumn("promotable", ready)


def expire(df: DataFrame, ts: str, cutoff: datetime) -> DataFrame:
    """Rows inside the retention period; a ``<ts>_day`` partition column prunes the scan."""
    if f"{ts}_day" in df.columns:
        df = df.where(F.col(f"{ts}_day") >= F.lit(str(cutoff.date())).cast("date"))
    return df.where(F.col(ts) >= _moment(df, ts, cutoff))


def expire_table(spark: SparkSession, fqn: str, ts: str, cutoff: datetime) -> None:
    """Apply ``expire`` to a stored table.

    A table partitioned by ``<ts>_day`` drops the days before the cutoff and rewrites at
    most the day the cutoff falls into, all in one replacement.
    """
    restore(spark, fqn)
    table, day = spark.table(fqn), f"{ts}_day"
    kind = table.schema[ts].dataType.simpleString()
    early = f"{quoted(ts)} < CAST({literal(cutoff)} AS {kind})"
    if day not in partition_columns(spark, fqn):
        delete_rows(spark, fqn, f"{quoted(ts)} IS NULL OR {early}")
        return
    # One replacement: the days before the cutoff go, the day it falls into is rewritten.
    last_day = F.lit(str(cutoff.date())).cast("date")
    affected = table.where(F.col(day).isNull() | (F.col(day) < last_day) | ((F.col(day) == last_day) & ~_kept(table, ts, cutoff)))
    days = [r.asDict() for r in bounded(affected.select(*partition_columns(spark, fqn)).distinct(), fqn)]
    if days:
        replace_partitions(in_partitions(table, days).where(_kept(table, ts, cutoff)), fqn, days)


def _kept(table: DataFrame, ts: str, cutoff: datetime) -> Column:
    return F.coalesce(F.col(ts) >= _moment(table, ts, cutoff), F.lit(False))


def lineage(runs: DataFrame) -> DataFrame:
    """Which source fed which table in which batch, from successful runs."""
    return runs.where("status = 'ok'").select("batch_id", "source", "target").distinct()


def lineage_closure(edges: DataFrame) -> DataFrame:
    """Every ``source`` that reaches a ``target`` over the edges, and in how few ``hops``.

    Each round extends the pairs of the round before by one edge and keeps those not seen yet, so the
    rounds end with the longest shortest path, cycles included (a node on a cycle reaches itself), and
    a pair is extended once however many ways lead to it. Rounds are written tables.
    """
    edges = materialise(edges.select("source", "target").where("source IS NOT NULL AND target IS NOT NULL").distinct(), "edges")
    known = frontier = edges.withColumn("hops", F.lit(1))
    step = edges.select(F.col("source").alias("target"), F.col("target").alias("_next"))
    while True:
        further = (frontier.join(step, "target").select("source", F.col("_next").alias("target"), F.col("hops") + 1)
                   .toDF("source", "target", "hops").distinct())
        frontier = materialise(further.join(known, ["source", "target"], "left_anti"), "hops")
        if frontier.isEmpty():
            return known
        known = known.unionByName(frontier)


def reaches_raw(tables: DataFrame, closure: DataFrame, raw: DataFrame, name: str = "table") -> DataFrame:
    """``tables`` with ``has_lineage``: whether a raw source (``raw.source``) leads to them."""
    origins = raw.select("source").distinct()
    traced = closure.join(origins, "source", "left_semi").select(F.col("target").alias(name)).distinct()
    return tables.join(traced.withColumn("has_lineage", F.lit(True)), name, "left").withColumn(
        "has_lineage", F.coalesce("has_lineage", F.lit(False)))


def table_cost(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """Files, bytes and rows of stored tables, read from file metadata and row counts only."""
    parts = []
    for name in tables:
        table = spark.table(name)
        meta = table.metadataColumn("_metadata")
        files = (table.select(meta.getField("file_path").alias("path"),
                              meta.getField("file_size").alias("size"))
                 .groupBy("path").agg(F.max("size").alias("size"), F.count("*").alias("n")))
        parts.append(files.agg(
            F.lit(name.replace("`", "")).alias("table"), F.count("*").alias("files"),
            F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows")))
    return reduce(DataFrame.unionByName, parts)
