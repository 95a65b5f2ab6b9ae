"""The audit envelope carried by every raw row."""

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The five audit columns, in contract order.
AUDIT_SCHEMA = T.StructType([
    T.StructField("_ingested_at", T.TimestampType()),
    T.StructField("_source", T.StringType()),
    T.StructField("_source_type", T.StringType()),
    T.StructField("_batch_id", T.StringType()),
    T.StructField("_source_file", T.StringType()),
])
AUDIT_COLUMNS = tuple(AUDIT_SCHEMA.fieldNames())


def typed_null(data_type: str = "string") -> Column:
    return F.lit(None).cast(data_type)


def enrich(df: DataFrame, source: str, source_type: str, batch_id: str,
           include_source_file: bool = False) -> DataFrame:
    """Append the audit columns and leave the raw columns as they are.

    ``include_source_file`` needs a file scan: the path comes from the scan's
    hidden ``_metadata`` column, which stays right across later shuffles.
    """
    taken = [c for c in df.columns if c.lower() in AUDIT_COLUMNS]
    if taken:
        raise ValueError(f"[{source}] raw columns use reserved audit names: {sorted(taken)}")
    file_path = (df.metadataColumn("_metadata").getField("file_path")
                 if include_source_file else typed_null())
    return df.select(
        "*",
        F.current_timestamp().alias("_ingested_at"),
        F.lit(source).alias("_source"),
        F.lit(source_type).alias("_source_type"),
        F.lit(batch_id).alias("_batch_id"),
        file_path.alias("_source_file"),
    )


def raw_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in AUDIT_COLUMNS]


def select_rows(df: DataFrame, batch_id: str | None = None, source: str | None = None,
                source_type: str | None = None) -> DataFrame:
    """Rows of one batch, one source or one source type; plain filters that reach the scan."""
    wanted = {"_batch_id": batch_id, "_source": source, "_source_type": source_type}
    for column, value in wanted.items():
        if value is not None:
            df = df.where(F.col(column) == value)
    return df
