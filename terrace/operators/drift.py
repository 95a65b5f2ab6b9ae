"""Expectations between batches: equal-depth histograms and how far a batch has drifted."""

from pyspark.sql import DataFrame, Window, functions as F


class DriftGateError(Exception):
    """A batch drifted further than allowed."""


def batch_histograms(df: DataFrame, batch: str, value: str, bins: int = 10, accuracy: int = 10_000) -> DataFrame:
    """``batch, edges, rows``: the inner edges of an equal-depth histogram of every batch.

    Edges are approximate percentiles, so a batch of any size is summarised in bounded memory; below
    ``accuracy`` values they are exact.
    """
    shares = [i / bins for i in range(1, bins)]
    return df.where(F.col(value).isNotNull()).groupBy(F.col(batch).alias("batch")).agg(
        F.percentile_approx(value, shares, accuracy).alias("edges"), F.count("*").alias("rows"))


def batch_drift(df: DataFrame, batch: str, value: str, bins: int = 10) -> DataFrame:
    """How each batch is spread over the histogram of the batch before: ``batch, before, rows, drift``.

    With ``a`` the share of the earlier batch in a bin and ``b`` that of the later one (both at least a
    tenth of a per mille), the drift is the sum of ``(b - a) * ln(b / a)`` over the bins: 0 for equal
    spreads, above 0.25 by custom a changed one. Bins are bounded above by their edge, edges that
    coincide make one bin. The first batch has no drift. NULL values are left out, and batches of
    nothing else are skipped. The histograms (a row a batch) are joined to the rows; the rows are
    counted by (batch, bin) in two numbers before any shuffle.
    """
    held = batch_histograms(df, batch, value, bins)
    order = Window.partitionBy(F.lit(0)).orderBy("batch")  # one row per batch
    steps = held.withColumns({"before": F.lag("batch").over(order), "own": F.array_distinct("edges")})
    rows = df.where(F.col(value).isNotNull()).select(F.col(batch).alias("batch"), F.col(value).alias("_value"))

    def counted(edges, key):
        """Rows of every ``key`` batch by the bins of an earlier or its own histogram."""
        place = F.size(F.filter("_edges", lambda e: e < F.col("_value")))
        return (rows.join(edges, "batch").groupBy("batch", place.alias("bin"))
                .agg(F.count("*").alias(key)))
    own = steps.select("batch", F.col("own").alias("_edges"))
    earlier = steps.join(own.withColumnsRenamed({"batch": "before", "_edges": "_theirs"}), "before").select(
        "batch", F.col("_theirs").alias("_edges"))
    mine, theirs = counted(own, "n_own"), counted(earlier, "n_later")
    bin_list = steps.select("batch", "before", F.col("rows")).join(
        steps.select(F.col("batch").alias("before"), F.explode(F.sequence(F.lit(0), F.size("own"))).alias("bin"),
                     F.col("rows").alias("rows_before")), "before")
    pairs = (bin_list.join(mine.withColumnRenamed("batch", "before"), ["before", "bin"], "left")
             .join(theirs, ["batch", "bin"], "left"))
    least = F.lit(1e-4)
    a = F.greatest(F.coalesce("n_own", F.lit(0)) / F.col("rows_before"), least)
    b = F.greatest(F.coalesce("n_later", F.lit(0)) / F.col("rows"), least)
    drift = pairs.groupBy("batch").agg(F.sum((b - a) * F.ln(b / a)).alias("drift"))
    return steps.select("batch", "before", "rows").join(drift, "batch", "left")


def drift_gate(df: DataFrame, batch: str, value: str, latest: str, limit: float = 0.25, bins: int = 10) -> DataFrame:
    """``batch_drift``, raising when the batch ``latest`` drifted beyond the limit."""
    report = batch_drift(df, batch, value, bins)
    worst = report.where(F.col("batch") == latest).agg(F.max("drift")).first()[0]
    if worst is not None and worst > limit:
        raise DriftGateError(f"batch {latest!r} drifted by {worst:.3f}, limit {limit}")
    return report
