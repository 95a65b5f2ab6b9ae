"""Numbered pages as a source type: in batches with pushed filters, and as a stream with offsets.

A paged source hands out pages 0, 1, 2, … that never change once they are there. Pages are Parquet
files ``page-<12 digits>.parquet`` in one folder, published in this order (written elsewhere, then
moved in). Any file system that pyarrow reaches will do, and every executor must reach it. The type is
not built in: ``register_type("paged", read_paged)``, ``register_stream_type("paged", stream_paged)``.
"""

import urllib.parse
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    IsNotNull, IsNull, LessThan, LessThanOrEqual)
from pyspark.sql.pandas.types import to_arrow_schema

from terrace.sources.spec import SourceSpec

#: Columns of these types compare alike in Spark and Arrow; floats do not (NaN), so theirs stay with Spark.
_PUSHED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType, T.BooleanType)
_COMPARE = {EqualTo: pc.equal, GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal,
            LessThan: pc.less, LessThanOrEqual: pc.less_equal}


def page_path(folder: str, number: int) -> str:
    return f"{folder.rstrip('/')}/page-{number:012d}.parquet"


def _located(path: str):
    if urllib.parse.urlparse(path).scheme:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def pages_available(folder: str) -> int:
    """How many pages there are, found by doubling and bisection: no listing, however many there are."""
    files, root = _located(folder)

    def there(number):
        return files.get_file_info(page_path(root, number)).type == fs.FileType.File
    if not there(0):
        return 0
    low, high = 0, 1
    while there(high):
        low, high = high, 2 * high
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if there(middle) else (low, middle)
    return high


def _expression(filter_, kinds):
    """The Arrow form of a filter, None where it must stay with Spark."""
    column = getattr(filter_, "attribute", ())
    if len(column) != 1 or not isinstance(kinds.get(column[0]), _PUSHED):
        return None
    field, kind = ds.field(column[0]), to_arrow_schema(T.StructType([T.StructField("x", kinds[column[0]])])).field("x").type
    if isinstance(filter_, IsNull):
        return field.is_null()
    if isinstance(filter_, IsNotNull):
        return field.is_valid()
    if isinstance(filter_, In):
        values = [v for v in filter_.value if v is not None]
        return field.isin(pa.array(values, kind)) if values else None
    make = _COMPARE.get(type(filter_))
    return make(field, pa.scalar(filter_.value, kind)) if make and filter_.value is not None else None


class Pages(InputPartition):
    """Pages ``first`` up to but without ``last``, read by one task."""

    def __init__(self, first: int, last: int):
        super().__init__((first, last))
        self.first, self.last = first, last


class _Reading:
    def __init__(self, options, schema):
        self.folder, self.schema, self.condition = options["path"], schema, None
        self.share = int(options.get("pages_per_task", "1"))
        if self.share < 1:
            raise ValueError("pages_per_task must be at least 1")

    def split(self, first: int, last: int) -> list[Pages]:
        return [Pages(k, min(k + self.share, last)) for k in range(first, last, self.share)]

    def read(self, partition: Pages | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # Spark asks so where there are no pages
            return
        files, root = _located(self.folder)
        wanted = to_arrow_schema(self.schema)
        for number in range(partition.first, partition.last):
            page = ds.dataset(page_path(root, number), schema=wanted, filesystem=files, format="parquet")
            # Row groups that the condition rules out are not read; few batches are in memory at a time.
            scan = page.scanner(filter=self.condition, batch_size=4096, batch_readahead=1, fragment_readahead=1)
            yield from (batch for batch in scan.to_batches() if batch.num_rows)


class PageReader(_Reading, DataSourceReader):
    def partitions(self):
        return self.split(0, pages_available(self.folder))


class FilteringPageReader(PageReader):
    def pushFilters(self, filters):
        kinds = {f.name: f.dataType for f in self.schema}
        for one in filters:
            expression = _expression(one, kinds)
            if expression is None:
                yield one
            else:
                self.condition = expression if self.condition is None else self.condition & expression


class PageStreamReader(_Reading, DataSourceStreamReader):
    """Offsets say how many pages have been read; an epoch takes all pages that are there."""

    def initialOffset(self):
        return {"page": 0}

    def latestOffset(self):
        return {"page": pages_available(self.folder)}

    def partitions(self, start, end):
        return self.split(start["page"], end["page"])


class PagedSource(DataSource):
    """Options: ``path``, ``pages_per_task`` (1), ``pushdown`` (false). The schema must be stated."""

    @classmethod
    def name(cls):
        return "paged"

    def reader(self, schema):
        pushing = self.options.get("pushdown", "false").lower() == "true"
        return (FilteringPageReader if pushing else PageReader)(self.options, schema)

    def streamReader(self, schema):
        return PageStreamReader(self.options, schema)


def _prepared(reader, spark: SparkSession, spec: SourceSpec):
    schema = spec.need("path", "schema")[1]
    spark.dataSource.register(PagedSource)
    options = {k: str(v) for k, v in spec.options.items() if k != "schema"}
    return reader.format("paged").schema(schema).options(**options)


def read_paged(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """All pages; filters reach them where the session has ``spark.sql.python.filterPushdown.enabled``."""
    pushing = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    return _prepared(spark.read, spark, spec).option("pushdown", pushing).load()


def stream_paged(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """The pages as they come; a restart goes on behind the last page of the checkpoint."""
    return _prepared(spark.readStream, spark, spec).load()
