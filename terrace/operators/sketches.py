"""Mergeable sketches per batch: percentiles and distinct counts over any period without the rows.

A batch stores one row per group: a KLL sketch of the measured column (for percentiles), an HLL sketch of
the counted column, and the number of rows. Periods and coarser groups are answered by merging these few
rows. Both have stated errors: a KLL sketch of size ``k`` returns a value whose rank is off by at most
``rank_error(k)`` of the rows (99 % of the time), an HLL sketch of ``2 ** lg`` registers is off by at most
three standard errors ``distinct_error(lg)`` (99.7 % of the time).
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

K, LG = 400, 14


def rank_error(k: int = K) -> float:
    return 2.446 / k ** 0.9433


def distinct_error(lg: int = LG) -> float:
    return 3 * 1.04 / 2 ** (lg / 2)


def batch_sketches(df: DataFrame, by: Sequence[str], value: str, counted: str, k: int = K, lg: int = LG) -> DataFrame:
    """``by, values_sketch, distinct_sketch, rows``: one row per group, of a size that does not depend on the rows.

    ``value`` must be a whole number (cast to bigint); NULL is in neither sketch.
    """
    return df.groupBy(*by).agg(
        F.kll_sketch_agg_bigint(F.col(value).cast("bigint"), k).alias("values_sketch"),
        F.hll_sketch_agg(F.col(counted), lg).alias("distinct_sketch"), F.count(value).alias("rows"))


def merged(sketches: DataFrame, by: Sequence[str], quantile: float, k: int = K) -> DataFrame:
    """``by, quantile_value, distinct_count, rows`` over all batches of each group."""
    parts = sketches.groupBy(*by).agg(
        F.kll_merge_agg_bigint("values_sketch", k).alias("_values"),
        F.hll_union_agg("distinct_sketch").alias("_distinct"), F.sum("rows").alias("rows"))
    value = F.when(F.col("rows") > 0, F.kll_sketch_get_quantile_bigint("_values", F.lit(quantile)))
    return parts.select(*by, value.alias("quantile_value"), F.hll_sketch_estimate("_distinct").alias("distinct_count"), "rows")
