"""Raw to typed rows, null policy, business-key deduplication and upsert."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from terrace.functions.audit import AUDIT_COLUMNS
from terrace.functions.rules import Rule
from terrace.operators.joins import join_unique
from terrace.operators.ranking import first_per_key
from terrace.operators.tables import (
    add_columns, bounded, in_partitions, is_native, partition_columns, partition_sources, quoted, replace_partitions, replace_table,
    restore, with_partitions)
from terrace.workspace import materialise, scratch_scope


def typed(df: DataFrame, types: Mapping[str, str], on_error: str = "null") -> DataFrame:
    """Give every field its declared type; audit columns pass through.

    Strings are trimmed and blanks become NULL. A value that does not read as its
    type becomes NULL, or with ``on_error="fail"`` stops the job.
    """
    return df.select(*typed_columns(df, types, on_error))


def typed_columns(df: DataFrame, types: Mapping[str, str], on_error: str = "null") -> list[Column]:
    undeclared = [c for c in df.columns if c not in types and c not in AUDIT_COLUMNS]
    absent = [c for c in types if c not in df.columns]
    if undeclared or absent:
        raise ValueError(f"fields without a type: {undeclared}; typed fields not found: {absent}")
    return [F.col(c) if c in AUDIT_COLUMNS else _read_as(df.schema[c], types[c], on_error).alias(c)
            for c in df.columns]


def _value(field: T.StructField, inside: str = "") -> Column:
    """A raw value as it is cast: text trimmed, blanks NULL."""
    value = F.col(f"{inside}.{quoted(field.name)}" if inside else quoted(field.name))
    return F.nullif(F.trim(value), F.lit("")) if isinstance(field.dataType, T.StringType) else value


def _read_as(field: T.StructField, data_type: str, on_error: str) -> Column:
    value = _value(field)
    read = value.try_cast(data_type)
    if on_error == "null":
        return read
    message = F.concat(F.lit(f"{field.name} is not {data_type}: "), value.cast("string"))
    return F.when(value.isNotNull() & read.isNull(), F.raise_error(message)).otherwise(read)


def type_rules(df: DataFrame, types: Mapping[str, str], inside: str = "") -> list[Rule]:
    """The casts of ``typed`` that can fail, as rules over the raw rows for the quarantine.

    They look at the very value that ``typed`` casts. ``inside`` names a struct column
    that holds the raw row.
    """
    rules = []
    for column, data_type in types.items():
        field = df.schema[column]
        if field.dataType != T.DataType.fromDDL(data_type):
            value = _value(field, inside)
            rules.append(Rule(f"{column}:type", value.isNotNull(), value.try_cast(data_type).isNotNull()))
    return rules


def null_policy(df: DataFrame, policy: Mapping[str, tuple],
                exempt: Column | None = None) -> DataFrame:
    """``{column: ("drop", None) | ("fill", value) | ("keep", None)}``; drops come first.

    Rows that meet ``exempt`` are never dropped.
    """
    unknown = {a for a, _ in policy.values()} - {"drop", "fill", "keep"}
    if unknown:
        raise ValueError(f"unknown null action(s) {sorted(unknown)}")
    needed = [F.col(c).isNotNull() for c, (action, _) in policy.items() if action == "drop"]
    filled = {c: F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType))
              for c, (action, value) in policy.items() if action == "fill"}
    if needed:
        complete = reduce(lambda a, b: a & b, needed)
        df = df.where(complete if exempt is None else complete | exempt)
    return df.withColumns(filled) if filled else df


def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per business key, the latest by ``order_by``."""
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order_by])


def latest_run(df: DataFrame) -> DataFrame:
    """Of a batch that was loaded more than once, the rows of the last load per source.

    The load times are aggregated first (few rows); the raw rows are then filtered
    against them without shuffling a batch together.
    """
    run = ["_batch_id", "_source"]
    last = materialise(df.groupBy(*run).agg(F.max("_ingested_at").alias("_ingested_at")), "runs")
    return join_unique(df, last, [*run, "_ingested_at"], "left_semi", check_unique=False)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: str,
           target_unique: bool = False) -> DataFrame:
    """Per key the row with the greatest ``order_by``; on a tie the source row wins.

    With ``target_unique`` (a table this function maintains) target rows whose key the
    source does not mention are passed through; with a small source the target is not
    shuffled at all.
    """
    if not target_unique:
        return _winners(target, source, keys, order_by)
    # A struct of the key is never NULL, so keys that are NULL compare equal too.
    names = [f"_key{i}" for i in range(len(keys))]
    stand_in = {n: F.struct(F.col(k).cast(target.schema[k].dataType).alias("key"))
                for n, k in zip(names, keys)}
    touched = materialise(source.select(*[c.alias(n) for n, c in stand_in.items()]).distinct(), "touched")
    marked = target.withColumns(stand_in)
    kept = join_unique(marked, touched, names, "left_anti", check_unique=False)
    contested = join_unique(marked, touched, names, "left_semi", check_unique=False)
    winners = _winners(contested.drop(*names), source, keys, order_by)
    return kept.drop(*names).unionByName(winners, allowMissingColumns=True)


def upsert_into(source: DataFrame, fqn: str, keys: Sequence[str], order_by: str) -> None:
    """``upsert`` into a stored table that has one row per key.

    Columns that only the source has are added to the table. A catalog with row-level
    changes merges. A plain table whose partition columns are among the keys, or derived
    from them (``hash(64, key)`` bounds their number), rewrites only the partitions the
    source touches; any other one is rewritten whole. ``source`` is read more than once
    and should be a stored table.
    """
    spark = source.sparkSession
    if not is_native(spark, fqn):
        restore(spark, fqn)
    source = with_partitions(source, fqn)
    add_columns(source, fqn, evolve=True)
    parts = partition_columns(spark, fqn)
    if is_native(spark, fqn):
        same_columns = spark.table(fqn).limit(0).unionByName(source, allowMissingColumns=True)
        best = first_per_key(same_columns, keys, [F.col(order_by).desc_nulls_last()])
        on = " AND ".join(f"t.{quoted(k)} <=> s.{quoted(k)}" for k in keys)
        newer = f"t.{quoted(order_by)} IS NULL OR s.{quoted(order_by)} >= t.{quoted(order_by)}"
        spark.sql(f"MERGE INTO {fqn} t USING {{best}} s ON {on} WHEN MATCHED AND ({newer}) "
                  "THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *", best=best)
    elif parts and (set(parts) <= set(keys) or partition_sources(spark, fqn) <= set(keys)):
        touched = [r.asDict() for r in bounded(source.select(*parts).distinct(), fqn)]
        if touched:
            target = in_partitions(spark.table(fqn), touched)
            replace_partitions(_winners(target, source, keys, order_by), fqn, touched)
    else:
        with scratch_scope(spark):
            replace_table(upsert(spark.table(fqn), source, keys, order_by, target_unique=True), fqn)


def _winners(target: DataFrame, source: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    both = target.withColumn("_side", F.lit(1)).unionByName(
        source.withColumn("_side", F.lit(0)), allowMissingColumns=True)
    order = [F.col(order_by).desc_nulls_last(), F.col("_side").asc()]
    return first_per_key(both, keys, order).drop("_side")
