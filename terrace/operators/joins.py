"""Joins of fact rows with frames that are unique on the join key."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from terrace.operators.ranking import first_per_key
from terrace.workspace import materialise


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _repeats(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether some complete key occurs twice. A NULL in a key matches nothing, so may repeat."""
    complete = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return not df.where(complete).groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1").isEmpty()


def join_unique(df: DataFrame, other: DataFrame, on: str | Sequence[str], how: str = "left",
                check_unique: bool = True) -> DataFrame:
    """Join to a frame that has one row per key, whatever the key distribution of ``df``.

    Spark broadcasts ``other`` where its statistics are within the session's threshold, at
    planning or, by the size of what was shuffled, at run time; beyond that adaptive
    execution cuts the partitions of hot keys (and of NULL keys, which match nothing).
    Each side is read once. ``how`` is left, inner, left_semi or left_anti.
    """
    keys = _keys(on)
    if check_unique and _repeats(other, keys):
        raise ValueError(f"the joined frame is not unique on {keys}")
    return df.join(other, keys, how)


def lookup(df: DataFrame, seed: DataFrame, on: str | Sequence[str],
           check_unique: bool = True) -> DataFrame:
    """Add reference columns; the row count stays."""
    return join_unique(df, seed, on, "left", check_unique)


def conform(fact: DataFrame, dim: DataFrame, on: str, unknown=-1,
            check_unique: bool = True) -> DataFrame:
    """Left join to a dimension; fact keys without a member get the unknown key."""
    marked = dim.withColumn("_member", F.lit(True))
    joined = join_unique(fact, marked, on, "left", check_unique)
    key = F.when(F.col("_member"), F.col(on)).otherwise(F.lit(unknown))
    return joined.withColumn(on, key.cast(fact.schema[on].dataType)).drop("_member")


def orphans(df: DataFrame, parent: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows without a parent; NULL keys count as orphans."""
    return _by_existence(df, parent, on, "left_anti")


def matched(df: DataFrame, parent: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows that have a parent."""
    return _by_existence(df, parent, on, "left_semi")


def _by_existence(df, parent, on, how):
    keys = _keys(on)
    return join_unique(df, parent.select(*keys).distinct(), keys, how, check_unique=False)


def rows_with_run(rows: DataFrame, runs: DataFrame) -> DataFrame:
    """Raw rows beside the run that loaded them, by batch and source.

    A source that was run again for the same batch has several runs; its rows are those
    of the last that succeeded, or of the last at all.
    """
    order = [(F.col("status") == "ok").desc_nulls_last(), F.col("started_at").desc_nulls_last()]
    last = first_per_key(runs, ["batch_id", "source"], order)
    facts = last.select(F.col("batch_id").alias("_batch_id"), F.col("source").alias("_source"),
                        F.col("status").alias("run_status"), F.col("rows").alias("run_rows"))
    return join_unique(rows, facts, ["_batch_id", "_source"], "inner", check_unique=False)


def edges_with_facts(facts: DataFrame, edges: DataFrame, on: Sequence[str],
                     weight: str) -> DataFrame:
    """Facts whose end points are joined by an edge; parallel edges are summed first."""
    per_pair = materialise(edges.groupBy(*on).agg(F.sum(weight).alias(weight)), "edges")
    return join_unique(facts, per_pair, on, "inner", check_unique=False)
