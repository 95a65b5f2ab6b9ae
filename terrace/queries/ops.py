"""Run reports, governance and streaming queries."""

from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from terrace.functions.audit import raw_columns
from terrace.operators.governance import (
    completeness, expire, expire_table, freshness, lineage, table_cost, trust_score)
from terrace.operators.joins import lookup
from terrace.operators.runs import failed_sources, failure_rate, pair_events, run_summary, sla
from terrace.operators.tables import append, quoted
from terrace.plans.ingest import ingest_all
from terrace.queries.registered import fresh_namespace, query, table
from terrace.sources.files import read_files
from terrace.sources.spec import SourceSpec
from terrace.streaming.streams import (
    consumer_lag, current_rows, decode_framed, decode_json, finish, merge_runs, stream_changes, stream_files,
    stream_ingest)
from terrace.workspace import scratch

RUNS_SQL = """SELECT strftime(ts, '%Y-%m-%d') AS batch_id, 'user_' || user_id AS source,
    'bronze.' || event_type AS target,
    CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'skipped' ELSE 'ok' END AS status,
    ts AS started_at, CAST(floor(value * 1000) AS BIGINT) AS duration_ms FROM events"""


def event_runs(spark, sf):
    """The events table read as run-audit rows: a day is a batch, a user is a source."""
    return table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("batch_id"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("source"),
        F.concat(F.lit("bronze."), F.col("event_type")).alias("target"),
        F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "view", "skipped")
        .otherwise("ok").alias("status"),
        F.col("ts").alias("started_at"), F.floor(F.col("value") * 1000).alias("duration_ms"))


@query("run_summary", f"""
    SELECT batch_id, count(*) FILTER (status = 'ok') AS succeeded, count(*) FILTER (status = 'failed') AS failed,
           count(*) FILTER (status = 'skipped') AS skipped FROM ({RUNS_SQL}) GROUP BY 1""")
def run_summary_query(spark, sf):
    return run_summary(event_runs(spark, sf))


@query("failure_rate", f"""
    SELECT source, count(*) AS tasks, avg(CASE WHEN status = 'failed' THEN 1.0::DOUBLE ELSE 0 END) AS failure_rate
    FROM ({RUNS_SQL}) WHERE status <> 'skipped' GROUP BY 1""")
def failure_rate_query(spark, sf):
    return failure_rate(event_runs(spark, sf), ["source"])


@query("latency_sla", f"""
    SELECT target, max(duration_ms) AS max_ms, quantile_disc(duration_ms, 0.95) AS p95_ms,
           count(*) FILTER (duration_ms > 60000) AS breaches FROM ({RUNS_SQL}) GROUP BY 1""")
def latency_sla(spark, sf):
    return sla(event_runs(spark, sf), 60_000, ["target"])


@query("failed_sources", f"""
    SELECT source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY started_at DESC) AS rn
    FROM ({RUNS_SQL}) WHERE batch_id = '2024-01-15') WHERE rn = 1 AND status = 'failed'""")
def failed_sources_query(spark, sf):
    return failed_sources(event_runs(spark, sf), "2024-01-15")


@query("lineage_edges", f"SELECT DISTINCT batch_id, source, target FROM ({RUNS_SQL}) WHERE status = 'ok'")
def lineage_edges(spark, sf):
    return lineage(event_runs(spark, sf))


@query("log_pairing", """
    WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS batch_id, 'user_' || user_id AS source, event_type, ts,
                      ts + to_seconds(CAST(json_extract(props, '$.k') AS BIGINT)) AS done FROM events),
         p AS (SELECT batch_id, source, min(ts) AS started_at,
                      max(done) FILTER (event_type NOT IN ('error', 'view')) AS ended,
                      max(done) FILTER (event_type = 'error') AS broke FROM e GROUP BY ALL)
    SELECT batch_id, source, started_at, greatest(ended, broke) AS finished_at,
           (epoch_us(greatest(ended, broke)) - epoch_us(started_at)) // 1000 AS duration_ms,
           CASE WHEN ended IS NULL AND broke IS NULL THEN 'running'
                WHEN broke IS NULL OR ended > broke THEN 'ok' ELSE 'failed' END AS status FROM p""")
def log_pairing(spark, sf):
    events = table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("batch_id"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("source"), "event_type", "ts",
        F.expr("ts + make_dt_interval(0, 0, 0, get_json_object(props, '$.k'))").alias("done"))
    kind = F.when(F.col("event_type") == "error", "error").otherwise("end")
    lines = events.select("batch_id", "source", F.lit("source.ingest.start").alias("event"),
                          F.col("ts").alias("timestamp")).unionByName(
        events.where("event_type <> 'view'").select(
            "batch_id", "source", F.concat(F.lit("source.ingest."), kind).alias("event"),
            F.col("done").alias("timestamp")))
    path = scratch(spark, "logs")
    lines.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).write.json(path)
    logs = read_files(spark, SourceSpec("logs", {
        "path": path, "format": "json",
        "schema": "batch_id string, source string, event string, timestamp timestamp_ntz"}))
    return pair_events(logs)


@query("table_freshness", """
    SELECT event_type, max(ts) AS newest,
           CAST(floor((epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts))) / 1000000) AS BIGINT) AS age_seconds,
           epoch_us(TIMESTAMP '2024-01-31') - epoch_us(max(ts)) >= 1801000000 AS stale
    FROM events GROUP BY event_type""")
def table_freshness(spark, sf):
    return freshness(table(spark, sf, "events"), "ts", datetime(2024, 1, 31), timedelta(minutes=30),
                     ["event_type"])


@query("metadata_completeness", """
    WITH j AS (SELECT d.*, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
         s AS (SELECT avg(CASE WHEN trim(lang) <> '' THEN 1.0::DOUBLE ELSE 0 END) AS a,
                      avg(CASE WHEN trim(source) <> '' THEN 1.0::DOUBLE ELSE 0 END) AS b,
                      avg(CASE WHEN quality IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END) AS c FROM j)
    SELECT 'lang' AS field, round(a, 9) AS share FROM s UNION ALL SELECT 'source', round(b, 9) FROM s
    UNION ALL SELECT 'quality', round(c, 9) FROM s UNION ALL SELECT 'overall', round((a + b + c) / 3, 9) FROM s""")
def metadata_completeness(spark, sf):
    documents = lookup(table(spark, sf, "documents").select("doc_id", "lang", "source"),
                       table(spark, sf, "labels"), "doc_id")
    return completeness(documents, ["lang", "source", "quality"]).withColumn("share", F.round("share", 9))


@query("trust_score", """
    WITH p AS (SELECT source, avg(CASE WHEN length(text) >= 100 THEN 1.0::DOUBLE ELSE 0 END) AS rules,
                      avg(CASE WHEN l.doc_id IS NOT NULL THEN 1.0::DOUBLE ELSE 0 END) AS labelled,
                      avg(quality::DOUBLE) AS quality,
                      max(CASE WHEN lang = 'fr' THEN lang END) AS owner, count(*) > 20 AS has_lineage
               FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY source),
         s AS (SELECT *, (rules * 2 + labelled * 1 + coalesce(quality * 1, 0))
                         / (3 + CASE WHEN quality IS NULL THEN 0 ELSE 1 END) AS score FROM p)
    SELECT source, round(score, 9) AS score, owner, has_lineage,
           score >= 0.7 AND owner IS NOT NULL AND has_lineage AS promotable FROM s""")
def trust_score_query(spark, sf):
    documents = lookup(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")

    def share(condition):
        return F.avg(F.when(condition, 1.0).otherwise(0.0))
    parts = documents.groupBy("source").agg(
        share(F.length("text") >= 100).alias("rules"), share(F.col("quality").isNotNull()).alias("labelled"),
        F.avg("quality").alias("quality"), F.max(F.when(F.col("lang") == "fr", F.col("lang"))).alias("owner"),
        (F.count("*") > 20).alias("has_lineage"))
    scored = trust_score(parts, {"rules": 2, "labelled": 1, "quality": 1}, 0.7)
    return scored.select("source", F.round("score", 9).alias("score"), "owner", "has_lineage", "promotable")


@query("retention_expire", "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15 12:00:00'")
def retention_expire(spark, sf):
    return expire(table(spark, sf, "events"), "ts", datetime(2024, 1, 15, 12))


@query("retention_expire_table", "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def retention_expire_table(spark, sf):
    events = table(spark, sf, "events")
    fqn = append(events, fresh_namespace(spark, "retain"), "events", partition_by=["days(ts)"])
    expire_table(spark, fqn, "ts", datetime(2024, 1, 15))
    return spark.table(fqn).select(*events.columns)


@query("table_cost", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", TRUE AS bytes_as_listed, TRUE AS files_as_listed, count(*) AS rows FROM {t}"
    for t in ("orders", "lineitem", "documents")))
def table_cost_query(spark, sf):
    namespace, names = fresh_namespace(spark, "cost"), ["orders", "lineitem", "documents"]
    ingest_all(spark, [SourceSpec(n, {"path": f"{sf}/{n}.parquet", "format": "parquet"}, namespace=namespace)
                       for n in names], batch_id="b1", concurrency=3)
    fqns = [quoted(namespace, n) for n in names]
    # What the file system itself lists for these tables.
    listed = reduce(DataFrame.unionByName, [
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
        .load(spark.sql(f"DESCRIBE EXTENDED {fqn}").where("col_name = 'Location'").first()["data_type"])
        .agg(F.lit(fqn.replace("`", "")).alias("table"), F.sum("length").alias("true_bytes"), F.count("*").alias("true_files"))
        for fqn in fqns])
    cost = table_cost(spark, fqns).join(listed, "table")
    return cost.select(F.regexp_extract("table", "([^.]+)$", 1).alias("table"),
                       (F.col("bytes") == F.col("true_bytes")).alias("bytes_as_listed"),
                       (F.col("files") == F.col("true_files")).alias("files_as_listed"), "rows")


def event_files(spark, sf, label):
    path = scratch(spark, label)
    events = table(spark, sf, "events")
    events.repartitionByRange(6, "event_id").write.parquet(path)
    return SourceSpec("events_stream", {"path": path, "format": "parquet"},
                      namespace=fresh_namespace(spark, label)), events.schema


@query("stream_bronze_ingest", """
    SELECT *, 'events_stream' AS _source, 'file' AS _source_type, 'run1' AS run, TRUE AS has_file FROM events""")
def stream_bronze_ingest(spark, sf):
    spec, schema = event_files(spark, sf, "stream")
    stream = stream_files(spark, spec, schema, max_files=2)
    loading = stream_ingest(stream, spec, scratch(spark, "checkpoint"), "run1")
    rows = finish(loading, spark, quoted(spec.namespace, spec.name))
    return rows.select(*raw_columns(rows), "_source", "_source_type",
                       F.split("_batch_id", ":")[0].alias("run"),
                       F.col("_source_file").isNotNull().alias("has_file"))


@query("file_stream_source", """
    SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""")
def file_stream_source(spark, sf):
    path, namespace = scratch(spark, "lines"), fresh_namespace(spark, "lines")
    table(spark, sf, "events").select(F.to_json(F.struct(
        "event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("ts"), "user_id", "event_type", "value",
        F.from_json("props", "k bigint").alias("props"))).alias("value")).write.text(path)
    lines = spark.readStream.text(path)
    decoded = decode_json(lines, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
                                 "props struct<k: bigint>")
    spec = SourceSpec("lines", {"path": path}, "stream", namespace)
    loading = stream_ingest(decoded, spec, scratch(spark, "checkpoint"), "run1", include_source_file=False)
    rows = finish(loading, spark, quoted(namespace, "lines"))
    return rows.select("event_id", "ts", "user_id", "event_type", "value", F.col("props.k").alias("k"))


@query("framed_topic_decode", """
    SELECT event_id, ts, user_id, event_type, props, CASE WHEN event_type = 'view' THEN NULL ELSE value END AS value,
           CASE WHEN event_type = 'view' THEN 7 WHEN event_type = 'error' THEN NULL ELSE 300 END AS schema_id
    FROM (SELECT * REPLACE (CASE WHEN event_type = 'error' THEN NULL ELSE event_id END AS event_id,
                            CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS user_id,
                            CASE WHEN event_type = 'error' THEN NULL ELSE value END AS value) FROM events)""")
def framed_topic_decode(spark, sf):
    """Events as registry-framed messages of two schemas; errors come without a frame."""
    kind = F.col("event_type")
    body = F.when(kind == "view", F.to_json(F.struct("event_id", "user_id"))).otherwise(F.to_json(F.struct("event_id", "user_id", "value")))
    frame = F.when(kind == "view", F.unhex(F.lit("0000000007"))).otherwise(F.unhex(F.lit("000000012C")))
    message = F.when(kind == "error", body.cast("binary")).otherwise(F.concat(frame, body.cast("binary")))
    topic = table(spark, sf, "events").select(message.alias("value"), "ts", "event_type", "props")
    return decode_framed(topic, {7: "event_id bigint, user_id bigint", 300: "event_id bigint, user_id bigint, value double"}).select(
        "event_id", "ts", "user_id", "event_type", "props", "value", F.col("schema_id").cast("int").alias("schema_id"))


@query("stream_cdc", """
    SELECT event_id, ts, user_id, event_type, value, props, TRUE AS merged FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
    WHERE rn = 1 AND event_type <> 'error'""")
def stream_cdc(spark, sf):
    spec, schema = event_files(spark, sf, "cdc")
    changes = stream_files(spark, spec, schema, max_files=1).withColumn(
        "op", F.when(F.col("event_type") == "error", "d").otherwise("u"))
    merging = stream_changes(changes, spec.namespace, "users", ["user_id"], "event_id", "op",
                             scratch(spark, "checkpoint"))
    fqn = quoted(spec.namespace, "users")
    finish(merging, spark, fqn)
    merged = merge_runs(spark, fqn, ["user_id"], "event_id", "op", fanout=3)
    rows = current_rows(spark.table(fqn), ["user_id"], "event_id", "op")
    return rows.withColumn("merged", F.lit(bool(merged)))


@query("consumer_lag", """
    SELECT p AS partition, greatest(produced - coalesce(consumed, -1), 0)::BIGINT AS lag FROM
        (SELECT user_id AS p, max(event_id) AS produced FROM events GROUP BY 1) LEFT JOIN
        (SELECT user_id AS p, max(event_id) AS consumed FROM events WHERE event_type = 'click' AND value > 20
         GROUP BY 1) USING (p)""")
def consumer_lag_query(spark, sf):
    offsets = table(spark, sf, "events").withColumnsRenamed({"user_id": "partition", "event_id": "offset"})
    return consumer_lag(offsets, offsets.where("event_type = 'click' AND value > 20"))
