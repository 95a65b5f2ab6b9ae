"""Live progress of streams: offsets of every epoch in a table, and the lag they give."""

import json
import threading
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from terrace.operators.tables import append, quoted

PROGRESS = ("query string, run string, epoch bigint, at timestamp, source int, partition string, "
            "start bigint, `end` bigint, latest bigint, rows bigint")


def positions(offset: str | None) -> dict[str, int]:
    """The numbers of an offset by their path in it: ``{"t": {"0": 5}}`` gives ``{"t/0": 5}``.

    Empty where there is no offset; parts that are not whole numbers are left out.
    """
    try:
        return dict(_flat("", json.loads(offset or "null")))
    except json.JSONDecodeError:  # an absent offset is reported as the word for it
        return {}


def _flat(path, value):
    if isinstance(value, Mapping):
        for key, inner in value.items():
            yield from _flat(f"{path}/{key}" if path else str(key), inner)
    elif isinstance(value, int) and not isinstance(value, bool):
        yield path, value


class ProgressLog(StreamingQueryListener):
    """Appends start, end and latest offset of every source partition, once for each progress report.

    ``source`` is the place of the source in the query. The latest offset is the one that the source
    told when the epoch was planned; file sources tell none. ``latest``, a function from the query's
    name to ``{partition: offset}``, asks the producer at the time of the report instead. One small file is written per report: compact the table
    now and then. A report that could not be written is raised by ``wait``.
    """

    def __init__(self, spark: SparkSession, namespace: str, table: str = "stream_progress", catalog: str | None = None,
                 latest: Callable[[str], Mapping[str, int]] | None = None):
        self.spark, self.place, self.latest = spark, (namespace, table, catalog), latest
        self.fqn = quoted(catalog, namespace, table)
        self._changed, self._ended, self._failed = threading.Condition(), set(), {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        report = event.progress
        try:
            self._write(report)
        except Exception as failure:  # it would only reach the log of the JVM
            with self._changed:
                self._failed[str(report.runId)] = failure

    def onQueryTerminated(self, event):
        with self._changed:
            self._ended.add(str(event.runId))
            self._changed.notify_all()

    def wait(self, query: StreamingQuery, seconds: float = 60) -> DataFrame:
        """The table once every report of a finished query is in it."""
        query.awaitTermination()
        with self._changed:
            if not self._changed.wait_for(lambda: str(query.runId) in self._ended, seconds):
                raise TimeoutError(f"no end of {query.runId} was reported; is the log added to spark.streams?")
            self._ended.discard(str(query.runId))
            failure = self._failed.pop(str(query.runId), None)
        if failure:
            raise RuntimeError(f"progress of {query.runId} was not written") from failure
        self.spark.catalog.refreshTable(self.fqn)
        return self.spark.table(self.fqn)

    def _write(self, report):
        name, rows = report.name or str(report.id), []
        for place, source in enumerate(report.sources):
            start, end = positions(source.startOffset), positions(source.endOffset)
            latest = dict(self.latest(name)) if self.latest else positions(source.latestOffset)
            rows += [(name, str(report.runId), report.batchId, report.timestamp, place, part, start.get(part),
                      end.get(part), latest.get(part), source.numInputRows) for part in sorted({*end, *latest})]
        if rows:
            told = self.spark.createDataFrame(rows, PROGRESS.replace("at timestamp", "at string"))
            append(told.withColumn("at", F.col("at").cast("timestamp")).coalesce(1), *self.place)


def live_lag(progress: DataFrame) -> DataFrame:
    """What each partition of each source of a query still has to read by its latest reports.

    Offsets are counts of what lies before them. NULL where no latest offset was told; never below 0.
    """
    lag = F.greatest(F.max("latest") - F.coalesce(F.max("end"), F.lit(0)), F.lit(0))
    return progress.groupBy("query", "source", "partition").agg(
        F.when(F.max("latest").isNotNull(), lag).alias("lag"), F.max("epoch").alias("epoch"))
