"""Pick the reader for a source."""

from pyspark.sql import DataFrame, SparkSession

from terrace.sources.files import read_files
from terrace.sources.jdbc import read_jdbc
from terrace.sources.spec import SourceSpec

# type -> (reader, whether rows come from files)
READERS = {"file": (read_files, True), "jdbc": (read_jdbc, False)}


def supported_types() -> tuple[str, ...]:
    return tuple(sorted(READERS))


def register_type(name: str, reader, from_files: bool = False) -> None:
    """Add a source type; ``reader(spark, spec)`` returns a DataFrame."""
    if name != name.lower() or not name:
        raise ValueError(f"source type must be a lower-case word, not {name!r}")
    READERS[name] = (reader, from_files)


def format_reader(fmt: str):
    """A reader for any format Spark resolves, including registered Python data sources."""
    def read(spark: SparkSession, spec: SourceSpec) -> DataFrame:
        options = {k: str(v) for k, v in spec.options.items() if k != "path"}
        return spark.read.format(fmt).options(**options).load(spec.options.get("path"))
    return read


def read_source(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """The raw frame of a source, verbatim: no cast, no renaming, no cache."""
    return _entry(spec)[0](spark, spec)


def from_files(spec: SourceSpec) -> bool:
    return _entry(spec)[1]


def _entry(spec: SourceSpec):
    if spec.type not in READERS:
        raise KeyError(f"[{spec.name}] unknown source type {spec.type!r}; "
                       f"supported: {list(supported_types())}")
    return READERS[spec.type]
