"""Bronze ingest: read, add the audit envelope, append; one audit row per source."""

import time
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import datetime, timezone
from threading import Event, Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from terrace.functions.audit import enrich
from terrace.operators.changes import stored_mark, unfinished_attempts
from terrace.operators.runs import RUN_SCHEMA
from terrace.operators.tables import (
    append, delete_rows, drop_partitions, is_native, literal, partition_columns, quoted, table_exists)
from terrace.sources.jdbc import read_increment, read_jdbc
from terrace.sources.readers import from_files, read_source
from terrace.sources.registry import choose
from terrace.sources.spec import SourceSpec


#: Which call of ``ingest_increment`` wrote a row.
ATTEMPT = "_attempt_id"


def new_batch_id() -> str:
    return str(uuid.uuid4())


def ingest_source(spark: SparkSession, spec: SourceSpec, batch_id: str,
                  catalog: str | None = None) -> tuple[str, int]:
    """Load one source into its table; returns the table and the rows written.

    The row count is observed by the write itself, so the source is scanned once.
    """
    raw = read_source(spark, spec)
    rows = enrich(raw, spec.name, spec.type, batch_id, from_files(spec))
    return _append_counted(rows, spec, catalog)[:2]


def _append_counted(rows: DataFrame, spec: SourceSpec, catalog: str | None, *extra, partition_by=()):
    """Raw tables are partitioned by batch unless the source says otherwise: a batch is
    then taken back by its metadata alone, and needs no shuffle to be written."""
    seen = Observation()
    table = append(rows, spec.namespace, spec.table or spec.name, catalog,
                   partition_by or spec.partition_by or ["_batch_id"], evolve=True, observe=(seen, [F.count(F.lit(1)).alias("rows"), *extra]))
    return table, seen.get["rows"], seen.get


def ingest_all(spark: SparkSession, specs: Sequence[SourceSpec], only: Sequence[str] = (),
               batch_id: str | None = None, fail_fast: bool = False,
               catalog: str | None = None, audit_table: tuple[str, str] | None = None,
               concurrency: int = 1) -> DataFrame:
    """Load every chosen source and return the run audit.

    A failing source leaves a ``failed`` row and does not stop the others unless
    ``fail_fast``. Disabled sources, and with ``fail_fast`` those never started, are
    ``skipped``. ``concurrency`` lets small sources share the cluster. With
    ``audit_table`` (namespace, table) the audit rows are appended there too.
    """
    batch_id = batch_id or new_batch_id()
    chosen = {s.name for s in choose(specs, only)}
    listed = [s for s in specs if not only or s.name in only]
    stop = Event()
    # Two jobs must not write into one table's folder at a time.
    one_writer = {s.target: Lock() for s in listed}

    def run(spec: SourceSpec):
        target = quoted(catalog, spec.namespace, spec.table or spec.name)
        started, clock = datetime.now(timezone.utc), time.monotonic()

        def row(event, status, rows=None, error=None):
            spent = None if status == "skipped" else int((time.monotonic() - clock) * 1000)
            return (batch_id, spec.name, spec.type, target.replace("`", ""), event, status,
                    rows, started, spent, error)
        if spec.name not in chosen or stop.is_set():
            return row("source.skipped", "skipped")
        try:
            with one_writer[spec.target]:
                return row("source.ingest.end", "ok", ingest_source(spark, spec, batch_id, catalog)[1])
        except Exception as problem:  # the boundary between independent sources
            if fail_fast:
                stop.set()
            return row("source.ingest.error", "failed", error=str(problem).split("\n")[0])

    if concurrency > 1:
        with ThreadPoolExecutor(concurrency) as pool:
            outcome = list(pool.map(inheritable_thread_target(spark)(run), listed))
    else:
        outcome = [run(spec) for spec in listed]
    runs = spark.createDataFrame(outcome, RUN_SCHEMA)
    if audit_table:
        append(runs, *audit_table, catalog=catalog, evolve=True)
    return runs


def ingest_increment(spark: SparkSession, spec: SourceSpec, column: str, batch_id: str,
                     state: tuple[str, str] = ("ops", "high_water"),
                     catalog: str | None = None, written: Callable[[], None] | None = None) -> tuple[str, int]:
    """Load only rows above the source's high-water mark and move the mark.

    ``written`` is called between the write and its mark.

    The new mark is the maximum the write itself observed. Every call is an attempt with
    an id of its own, whatever the batch id: its rows carry it as ``_attempt_id``, which
    also partitions the table. The state table records an attempt before its write and its
    mark afterwards; one begun but not ended stopped half-way, and its partition is dropped
    before the next one reads. One run per source at a time.
    """
    target = quoted(catalog, spec.namespace, spec.table or spec.name)
    by_depth = spec.type == "jdbc" and spec.options.get("split") == "depth"
    plain = {k: v for k, v in spec.options.items() if k not in ("split", "partition_column", "num_partitions")}
    raw = read_source(spark, replace(spec, options=plain) if by_depth else spec)
    kind = raw.schema[column].dataType.simpleString()

    def record(attempt, mark):
        row = spark.createDataFrame([(spec.name, batch_id, attempt, mark)],
                                    f"source string, batch_id string, attempt string, mark {kind}")
        append(row.select("source", "batch_id", "attempt", F.col("mark").cast("string").alias("high_water"),
                          F.current_timestamp().alias("recorded_at")), *state, catalog=catalog)

    mark = None
    if table_exists(spark, quoted(catalog, *state)):
        stored = spark.table(quoted(catalog, *state)).where(F.col("source") == spec.name)
        mark = stored_mark(stored.withColumn("high_water", F.col("high_water").cast(kind)),
                           spec.name, "high_water")
        for attempt in unfinished_attempts(stored):
            if table_exists(spark, target):
                _take_back(spark, target, attempt)
            record(attempt, None)
    attempt = new_batch_id()
    record(attempt, None)
    # Split by depth, the rows above the mark are what is dealt to the tasks.
    new = read_jdbc(spark, spec, (column, mark)) if by_depth else read_increment(raw, column, mark)
    rows = enrich(new, spec.name, spec.type, batch_id, from_files(spec))
    rows = rows.withColumn(ATTEMPT, F.lit(attempt))
    table, count, seen = _append_counted(rows, spec, catalog, F.max(column).alias("mark"),
                                         partition_by=[*spec.partition_by, ATTEMPT])
    if written:
        written()
    record(attempt, seen["mark"] if count else mark)
    return table, count


def _take_back(spark: SparkSession, target: str, attempt: str) -> None:
    if not is_native(spark, target) and ATTEMPT in partition_columns(spark, target):
        drop_partitions(spark, target, [{ATTEMPT: attempt}])
    elif ATTEMPT in spark.table(target).columns:
        delete_rows(spark, target, f"{ATTEMPT} = {literal(attempt)}")
