"""The first row of every key."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def _orderable(field: T.StructField) -> Column:
    column = F.col("`" + field.name.replace("`", "``") + "`")
    return F.to_json(column) if "map<" in field.dataType.simpleString() else column


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key; ties go by all other columns ascending, NULLs last.

    Spark keeps only each task's own first row per key before the shuffle, so a key
    with a large share of the rows sends one row per task, not all of them.
    """
    ties = [_orderable(f).asc_nulls_last() for f in df.schema if f.name not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *ties)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")
