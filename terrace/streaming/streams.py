"""Streaming ingest into Bronze tables, change logs and consumer lag."""

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from terrace.functions.audit import enrich
from terrace.operators.changes import apply_changes, latest_changes
from terrace.operators.tables import (
    append, bounded, drop_partitions, in_partitions, partition_columns, quoted, replace_partitions, replace_table, restore, table_exists)
from terrace.sources.files import file_options
from terrace.sources.spec import SourceSpec


def stream_files(spark: SparkSession, spec: SourceSpec, schema: str,
                 max_files: int | None = None) -> DataFrame:
    """A file source as a stream; a stream needs its schema stated."""
    fmt, options = file_options(spec)
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(spec.options["path"])


def _files(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    return stream_files(spark, spec, spec.need("schema")[0])


# type -> reader of a stream
STREAMS = {"file": _files}


def register_stream_type(name: str, reader) -> None:
    """Add a type of streaming source; ``reader(spark, spec)`` returns a streaming DataFrame."""
    if name != name.lower() or not name:
        raise ValueError(f"source type must be a lower-case word, not {name!r}")
    STREAMS[name] = reader


def read_stream(spark: SparkSession, spec: SourceSpec) -> DataFrame:
    """The stream of a source by its type, verbatim."""
    if spec.type not in STREAMS:
        raise KeyError(f"[{spec.name}] no stream of type {spec.type!r}; supported: {sorted(STREAMS)}")
    return STREAMS[spec.type](spark, spec)


def stream_topic(spark: SparkSession, servers: str, topic: str,
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """A Kafka-protocol topic as a stream. Needs Spark's Kafka package on the session."""
    return (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic).options(**dict(options or {})).load())


def decode_json(df: DataFrame, schema: str, column: str = "value") -> DataFrame:
    """Replace a JSON text column by the fields of its schema."""
    parsed = F.from_json(F.col(column).cast("string"), schema)
    others = [c for c in df.columns if c != column]
    return df.withColumn("_parsed", parsed).select(*others, "_parsed.*")


def unframed(df: DataFrame, column: str = "value") -> DataFrame:
    """Split registry-framed payloads: a zero byte, a 4-byte schema id, then the payload.

    Adds ``schema_id`` and replaces the column by the payload. A value that is not framed so
    has a NULL id and payload.
    """
    value = F.col(column).cast("binary")
    framed = (F.octet_length(value) >= 5) & (F.hex(F.substring(value, 1, 1)) == "00")
    number = F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint")
    payload = F.expr(f"substring(CAST(`{column}` AS BINARY), 6)")
    return df.withColumns({"schema_id": F.when(framed, number), column: F.when(framed, payload)})


def decode_framed(df: DataFrame, schemas: Mapping[int, str], column: str = "value") -> DataFrame:
    """Framed JSON payloads as fields, each read by the schema its id names.

    The fields of all schemas become columns (a name must have one type); rows with an
    unknown id or no frame have NULL in all of them, and their ``schema_id`` tells.
    """
    fields = {}
    for ddl in schemas.values():
        for field in T._parse_datatype_string(ddl):
            if fields.setdefault(field.name, field.dataType) != field.dataType:
                raise ValueError(f"{field.name} has two types")
    rows = unframed(df, column)
    parsed = {i: F.from_json(F.col(column).cast("string"), ddl) for i, ddl in schemas.items()}
    columns = []
    for name, kind in fields.items():
        value = F.lit(None).cast(kind)
        for i, ddl in schemas.items():
            if name in T._parse_datatype_string(ddl).names:
                value = F.when(F.col("schema_id") == i, parsed[i].getField(name)).otherwise(value)
        columns.append(value.alias(name))
    others = [c for c in rows.columns if c != column]
    return rows.select(*others, *columns)


def stream_ingest(stream: DataFrame, spec: SourceSpec, checkpoint: str, run_id: str,
                  catalog: str | None = None, source_type: str | None = None,
                  include_source_file: bool = True, available_now: bool = True) -> StreamingQuery:
    """Append a stream to its Bronze table, every epoch as batch ``<run_id>:<epoch>``.

    ``run_id`` belongs to the checkpoint: keep both for restarts. The table is
    partitioned by ``_batch_id``. Spark can repeat only the first epoch after a start;
    that one replaces its own partition, so a repeat adds nothing, also when the
    earlier attempt stopped half-way.
    """
    table = spec.table or spec.name
    keys = [*spec.partition_by, *([] if "_batch_id" in spec.partition_by else ["_batch_id"])]
    enriched = enrich(stream, spec.name, source_type or spec.type, run_id, include_source_file)
    started = []

    def load(rows: DataFrame, epoch: int) -> None:
        batch = f"{run_id}:{epoch}"
        replay = None if started else batch
        append(rows.withColumn("_batch_id", F.lit(batch)), spec.namespace, table, catalog, keys,
               evolve=True, replay_of=replay)
        started.append(epoch)

    return _start(enriched, load, checkpoint, available_now)


def fold_epochs(spark: SparkSession, fqn: str, run_id: str) -> None:
    """Fold the epochs of a finished run of ``stream_ingest`` into the one batch ``run_id``.

    A long-running stream otherwise leaves a partition per epoch. Afterwards the run can be
    taken back only as a whole. Not beside the running stream, nor before a restart of it.
    """
    restore(spark, fqn)
    table = spark.table(fqn)
    mine = F.startswith("_batch_id", F.lit(f"{run_id}:")) | (F.col("_batch_id") == run_id)
    keys = partition_columns(spark, fqn)
    # One row per epoch and value of the other partition columns.
    touched = [r.asDict() for r in bounded(table.where(mine).select(*keys).distinct(), fqn)]
    if touched:
        folded = in_partitions(table, touched).withColumn("_batch_id", F.lit(run_id))
        into = {tuple(sorted({**p, "_batch_id": run_id}.items(), key=str)) for p in touched}
        every = {tuple(sorted(p.items(), key=str)) for p in touched} | into
        replace_partitions(folded.select(*table.columns), fqn, [{k: dict(p)[k] for k in keys} for p in every])


EPOCH = "_epoch"


def stream_changes(changes: DataFrame, namespace: str, table: str, keys: Sequence[str], seq: str,
                   op: str, checkpoint: str, catalog: str | None = None,
                   available_now: bool = True, run_id: str = "run") -> StreamingQuery:
    """Append every epoch's latest changes per key, deletes included, to a change table.

    Nothing stored is read or rewritten, however large the table is. ``current_rows`` gives
    the rows the changes leave; ``compact_changes`` folds them together now and then. The
    table is partitioned by epoch (``<run_id>:<epoch>``; ``run_id`` belongs to the
    checkpoint), and a repeated epoch replaces its own partition.
    """
    started = []

    def load(rows: DataFrame, epoch: int) -> None:
        name = f"{run_id}:{epoch}"
        last = latest_changes(rows, keys, seq, op).withColumn(EPOCH, F.lit(name))
        replace_partition = not started and table_exists(rows.sparkSession, quoted(catalog, namespace, table))
        if replace_partition:
            drop_partitions(rows.sparkSession, quoted(catalog, namespace, table), [{EPOCH: name}])
        append(last, namespace, table, catalog, [EPOCH], evolve=True)
        started.append(epoch)

    return _start(changes, load, checkpoint, available_now)


def current_rows(changes: DataFrame, keys: Sequence[str], seq: str, op: str) -> DataFrame:
    """The rows that a change table leaves: latest per key, deleted keys removed."""
    return apply_changes(changes.drop(EPOCH), keys, seq, op)


def compact_changes(spark: SparkSession, fqn: str, keys: Sequence[str], seq: str, op: str,
                    epoch: str = "compacted") -> None:
    """Keep the latest change per key, deletes included, as one epoch. Not beside a running stream."""
    last = latest_changes(spark.table(fqn).drop(EPOCH), keys, seq, op)
    replace_table(last.withColumn(EPOCH, F.lit(epoch)), fqn)


def merge_runs(spark: SparkSession, fqn: str, keys: Sequence[str], seq: str, op: str, fanout: int = 4) -> list[list[str]]:
    """Merge runs of similar size in a change table; says which were merged.

    A run is what one epoch, or an earlier merge, holds: the latest change per key. Its level is the
    power of ``fanout`` that its rows reach. As soon as a level has ``fanout`` runs, they become one
    run, mostly of the next level, so a change is rewritten once for each level and a small epoch never
    rewrites a large run; readers meet fewer than ``fanout`` runs a level. Deletes are kept.
    Not beside a running stream.
    """
    restore(spark, fqn)
    merged = []
    while True:
        sizes = bounded(spark.table(fqn).groupBy(EPOCH).agg(F.count("*").alias("rows")), fqn)
        levels = {}
        for run, rows in sorted(sizes):
            level = 0
            while fanout ** (level + 1) <= rows:
                level += 1
            levels.setdefault(level, []).append(run)
        full = min((k for k, runs in levels.items() if len(runs) >= fanout), default=None)
        if full is None:
            return merged
        runs = levels[full]
        # Named by what it holds, so a repeated merge writes the same run.
        name = "merged-" + hashlib.sha256("\n".join(runs).encode()).hexdigest()[:16]
        parts = [{EPOCH: r} for r in runs]
        last = latest_changes(in_partitions(spark.table(fqn), parts).drop(EPOCH), keys, seq, op)
        replace_partitions(last.withColumn(EPOCH, F.lit(name)), fqn, [*parts, {EPOCH: name}])
        merged.append(runs)


def dedup_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """Each event once, also when it is delivered again within ``delay`` of its own time.

    Keys are kept in the state store until the watermark (the latest event time less ``delay``) has
    passed them by ``delay``; events older than the watermark are late and left out.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def _start(df: DataFrame, sink, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def finish(query: StreamingQuery, spark: SparkSession, fqn: str) -> DataFrame:
    """Wait for an available-now query and return the table as it is on disk.

    The sink runs in a session of its own, so the caller's cached file listing is stale.
    """
    query.awaitTermination()
    spark.catalog.refreshTable(fqn)
    return spark.table(fqn)


def consumer_lag(produced: DataFrame, consumed: DataFrame, partition: str = "partition",
                 offset: str = "offset") -> DataFrame:
    """Messages each partition still has to hand out; never below 0."""
    ends = produced.groupBy(partition).agg(F.max(offset).alias("produced"))
    seen = consumed.groupBy(partition).agg(F.max(offset).alias("consumed"))
    behind = F.greatest(F.col("produced") - F.coalesce("consumed", F.lit(-1)), F.lit(0))
    return ends.join(seen, partition, "left").select(partition, behind.cast("bigint").alias("lag"))
