"""Change logs and high-water marks."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from terrace.operators.ranking import first_per_key


def latest_changes(changes: DataFrame, keys: Sequence[str], seq: str, op: str) -> DataFrame:
    """The last change per key, deletes included; at equal ``seq`` a delete wins."""
    deleted = F.coalesce(F.col(op) == "d", F.lit(False))
    return first_per_key(changes, keys, [F.col(seq).desc_nulls_last(), deleted.desc()])


def apply_changes(changes: DataFrame, keys: Sequence[str], seq: str, op: str) -> DataFrame:
    """The rows a change log leaves: latest per key, deleted keys removed."""
    last = latest_changes(changes, keys, seq, op)
    return last.where(~F.col(op).eqNullSafe("d")).drop(op)


def stored_mark(state: DataFrame, source: str, column: str):
    """The highest mark recorded for a source, or None."""
    return state.where(F.col("source") == source).agg(F.max(column)).first()[0]


def unfinished_attempts(state: DataFrame) -> list[str]:
    """Attempts of one source that were begun but not ended: one row instead of two.

    At most one exists, because the next run takes it back and ends it.
    """
    counted = state.groupBy("attempt").agg(F.count("*").alias("entries"))
    return [r["attempt"] for r in counted.where("entries = 1").collect()]
