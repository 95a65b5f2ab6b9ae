"""CSV, JSON and Parquet scans."""

from pyspark.sql import DataFrame, SparkSession

from terrace.sources.spec import SourceSpec

# Supported formats and the reader defaults a source may override.
FILE_DEFAULTS = {
    "csv": {"header": "true", "inferSchema": "false", "mode": "PERMISSIVE"},
    "json": {"multiLine": "false"},
    "parquet": {},
}


def file_options(spec: SourceSpec) -> tuple[str, dict[str, str]]:
    """Checked format and reader options. Option names are case-insensitive, as in Spark."""
    fmt = str(spec.need("path", "format")[1]).lower()
    if fmt not in FILE_DEFAULTS:
        raise ValueError(f"[{spec.name}] unsupported format {fmt!r}; use one of {sorted(FILE_DEFAULTS)}")
    given = {k: str(v) for k, v in (spec.options.get("reader_options") or {}).items()}
    defaults = dict(FILE_DEFAULTS[fmt])
    if spec.options.get("recursive_lookup"):
        defaults["recursiveFileLookup"] = "true"
    named = {k.lower() for k in given}
    return fmt, {k: v for k, v in defaults.items() if k.lower() not in named} | given


def read_files(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """Scan a glob-capable path. An optional ``schema`` (DDL) saves JSON's inference pass."""
    fmt, options = file_options(spec)
    reader = spark.read.format(fmt).options(**options)
    if spec.options.get("schema"):
        reader = reader.schema(spec.options["schema"])
    return reader.load(spec.options["path"])
