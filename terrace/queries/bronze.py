"""Raw ingest and table-lifecycle queries."""

import os
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from terrace.functions.audit import AUDIT_COLUMNS, enrich, raw_columns, select_rows
from terrace.operators.aggregates import rows_by
from terrace.operators.joins import join_unique, rows_with_run
from terrace.operators.quality import audit_contract, schema_report
from terrace.operators.governance import completeness
from terrace.operators.runs import failed_sources
from terrace.operators.staging import latest_run
from terrace.operators.tables import (
    append, batch_rows, delete_rows, evolve_and_append, list_tables, overwrite_partitions, preview, quoted,
    replace_table, rollback_batch, write_partitioned)
from terrace.plans.ingest import ingest_all, ingest_increment, ingest_source
from terrace.queries.registered import TABLES, fresh_namespace, query, table
from terrace.sources.jdbc import read_jdbc
from terrace.sources.readers import format_reader, register_type
from terrace.sources.spec import SourceSpec
from terrace.workspace import one_process, scratch


def file_spec(name, path, fmt, namespace, **more):
    options = {"path": path, "format": fmt, **more.pop("options", {})}
    return SourceSpec(name, options, namespace=namespace, **more)


def ingest_file(spark, name, path, fmt, label, **more):
    namespace = fresh_namespace(spark, label)
    fqn, _ = ingest_source(spark, file_spec(name, path, fmt, namespace, **more), "b1")
    return spark.table(fqn)


@query("bronze_parquet_ingest", """
    SELECT *, 'orders_raw' AS _source, 'file' AS _source_type, 'b1' AS _batch_id,
           TRUE AS has_file, TRUE AS has_time FROM orders""")
def bronze_parquet_ingest(spark, sf):
    rows = ingest_file(spark, "orders_raw", f"{sf}/orders.parquet", "parquet", "pq")
    return rows.select(*raw_columns(rows), "_source", "_source_type", "_batch_id",
                       F.col("_source_file").isNotNull().alias("has_file"),
                       F.col("_ingested_at").isNotNull().alias("has_time"))


@query("bronze_csv_all_strings", """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
           CAST(c_acctbal AS VARCHAR) AS c_acctbal, c_mktsegment, 'customer_csv' AS _source
    FROM customer""")
def bronze_csv_all_strings(spark, sf):
    path = scratch(spark, "csv")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    rows = ingest_file(spark, "customer_csv", path, "CSV", "csv")
    return rows.select(*raw_columns(rows), "_source")


@query("bronze_json_nested", """
    SELECT event_id, ts, user_id, event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k
    FROM events""")
def bronze_json_nested(spark, sf):
    path = scratch(spark, "json")
    events = table(spark, sf, "events")
    exact = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    events.select("event_id", "ts", "user_id", "event_type", "value",
                  F.from_json("props", "k bigint").alias("props")).write.option("timestampNTZFormat", exact).json(path)
    rows = ingest_file(spark, "events_json", path, "json", "json", options={"reader_options": {
        "timestampNTZFormat": exact, "inferTimestamp": True, "prefersDecimal": False}, "schema":
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props struct<k: bigint>"})
    return rows.select("event_id", "ts", "user_id", "event_type", "value", F.col("props.k").alias("k"))


@query("csv_recursive_options", """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand, p_type,
           CAST(p_size AS VARCHAR) AS p_size, CAST(p_retailprice AS VARCHAR) AS p_retailprice,
           p_type AS folder FROM part""")
def csv_recursive_options(spark, sf):
    path = scratch(spark, "nested")
    part = table(spark, sf, "part")
    (part.withColumn("kind", F.col("p_type")).write.partitionBy("kind")
     .options(header=True, sep="|", quote="'", quoteAll=True).csv(f"{path}/deep/er"))
    rows = ingest_file(spark, "part_csv", f"{path}/de*", "csv", "nested", options={
        "recursive_lookup": True, "reader_options": {"HEADER": True, "delimiter": "|", "QUOTE": "'"}})
    folder = F.regexp_extract("_source_file", "kind=([^/]+)/", 1).alias("folder")
    return rows.select(*raw_columns(rows), folder)


def demo_database(spark):
    """URL and driver of the database the JDBC queries use.

    Taken from the session; without one a local session uses a database inside its
    own process, which no executor of a cluster could see.
    """
    url = spark.conf.get("spark.terrace.jdbc.url", None)
    if url:
        return url, spark.conf.get("spark.terrace.jdbc.driver")
    if not one_process(spark):
        raise RuntimeError("the JDBC queries need spark.terrace.jdbc.url on a cluster")
    name = scratch(spark, "db").rsplit("-", 1)[1]
    return f"jdbc:derby:memory:d{name};create=true", "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def in_database(spark, df, name, text_columns):
    """Copy a frame into the database; returns the connection options of a source."""
    url, driver = demo_database(spark)
    os.environ.setdefault("TERRACE_DB_USER", "app")
    os.environ.setdefault("TERRACE_DB_PASSWORD", "app")
    (df.write.format("jdbc").mode("overwrite")
     .options(url=url, driver=driver, dbtable=name, user=os.environ["TERRACE_DB_USER"],
              password=os.environ["TERRACE_DB_PASSWORD"], batchsize=5000,
              createTableColumnTypes=", ".join(f"{c} VARCHAR(64)" for c in text_columns)).save())
    return {"url": url, "driver": driver, "user_env": "TERRACE_DB_USER",
            "password_env": "TERRACE_DB_PASSWORD"}


def orders_in_database(spark, sf):
    orders = table(spark, sf, "orders")
    options = in_database(spark, orders, "orders", ["o_orderstatus", "o_orderpriority"])
    low, high = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    return options | {"partition_column": "o_orderkey", "lower_bound": low, "upper_bound": high,
                      "num_partitions": 8, "fetch_size": 5000}


@query("bronze_jdbc_partitioned", """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           o_orderpriority, 'jdbc' AS _source_type, CAST(NULL AS VARCHAR) AS _source_file FROM orders""")
def bronze_jdbc_partitioned(spark, sf):
    spec = SourceSpec("orders_db", orders_in_database(spark, sf) | {"dbtable": "orders"}, "jdbc",
                      namespace=fresh_namespace(spark, "jdbc"))
    rows = spark.table(ingest_source(spark, spec, "b1")[0])
    return rows.select(*raw_columns(rows), "_source_type", "_source_file").withColumn(
        "o_orderdate", F.col("o_orderdate").cast("timestamp_ntz"))


@query("bronze_jdbc_query", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'""")
def bronze_jdbc_query(spark, sf):
    text = 'SELECT "o_orderkey", "o_totalprice" FROM orders WHERE "o_orderstatus" = \'F\''
    spec = SourceSpec("orders_f", orders_in_database(spark, sf) | {"query": text}, "jdbc")
    return read_jdbc(spark, spec)


@query("federated_join", """
    SELECT n_name, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
    FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def federated_join(spark, sf):
    options = in_database(spark, table(spark, sf, "nation"), "nation", ["n_name"])
    nation = read_jdbc(spark, SourceSpec("nation_db", options | {"dbtable": "nation"}, "jdbc"))
    customer = (table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey"))
                .agg(F.count("*").alias("n"), F.sum("c_acctbal").alias("b")))
    joined = join_unique(customer, nation.select("n_nationkey", "n_name"), "n_nationkey", "inner")
    return joined.groupBy("n_name").agg(F.sum("n").alias("customers"),
                                        F.round(F.sum("b"), 2).alias("balance"))


@query("rows_by_source_type", """
    SELECT 'file' AS _source_type, 'customer_file' AS _source, count(*) AS rows, 0 AS without_file FROM customer
    UNION ALL SELECT 'file', 'supplier_file', count(*), 0 FROM supplier
    UNION ALL SELECT 'jdbc', 'nation_db', count(*), count(*) FROM nation""")
def rows_by_source_type(spark, sf):
    namespace = fresh_namespace(spark, "shared")
    options = in_database(spark, table(spark, sf, "nation"), "nation", ["n_name"])
    ingest_all(spark, [
        file_spec("customer_file", f"{sf}/customer.parquet", "parquet", namespace, table="mixed"),
        file_spec("supplier_file", f"{sf}/supplier.parquet", "parquet", namespace, table="mixed"),
        SourceSpec("nation_db", options | {"dbtable": "nation"}, "jdbc", namespace, "mixed"),
    ], batch_id="b1")
    mixed = spark.table(quoted(namespace, "mixed"))
    return mixed.groupBy("_source_type", "_source").agg(
        F.count("*").alias("rows"), F.count_if(F.col("_source_file").isNull()).alias("without_file"))


@query("custom_source", "SELECT *, 'orc' AS _source_type FROM events")
def custom_source(spark, sf):
    path = scratch(spark, "orc")
    table(spark, sf, "events").write.orc(path)
    register_type("orc", format_reader("orc"), from_files=True)
    spec = SourceSpec("events_orc", {"path": path}, "orc", fresh_namespace(spark, "orc"))
    rows = spark.table(ingest_source(spark, spec, "b1")[0])
    return rows.select(*raw_columns(rows), "_source_type")


ALL_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS source, 'ok' AS status, count(*) AS rows FROM {t}" for t in TABLES)


def load_everything(spark, sf, label):
    namespace = fresh_namespace(spark, label)
    specs = [file_spec(t, f"{sf}/{t}.parquet", "parquet", namespace, table=f"raw_{t}") for t in TABLES]
    specs.insert(3, file_spec("broken", f"{sf}/no_such_table.parquet", "parquet", namespace))
    specs.append(file_spec("off", f"{sf}/region.parquet", "parquet", namespace, enabled=False))
    return namespace, ingest_all(spark, specs, batch_id="b1", concurrency=4,
                                 audit_table=(namespace, "ingest_runs"))


@query("bronze_multi_source_audit", f"""{ALL_COUNTS}
    UNION ALL SELECT 'broken', 'failed', NULL UNION ALL SELECT 'off', 'skipped', NULL""")
def bronze_multi_source_audit(spark, sf):
    namespace, _ = load_everything(spark, sf, "audit")
    return spark.table(quoted(namespace, "ingest_runs")).select("source", "status", "rows")


@query("catalog_listing", " UNION ALL ".join(
    f"SELECT 'raw_{t}' AS \"table\", count(*) AS rows FROM {t}" for t in TABLES))
def catalog_listing(spark, sf):
    namespace, _ = load_everything(spark, sf, "listing")
    listed = [r["table"] for r in list_tables(spark, namespace).orderBy("table").collect()]
    counts = [spark.table(quoted(namespace, t)).agg(F.lit(t).alias("table"), F.count("*").alias("rows"))
              for t in listed if t.startswith("raw_")]
    result = counts[0]
    for one in counts[1:]:
        result = result.unionByName(one)
    return result


@query("preview_orders", """
    SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def preview_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    return preview(orders, [F.desc("o_totalprice"), "o_orderkey"], 10)


@query("schema_evolution_append", """
    SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nation, s_acctbal AS balance,
           CAST(NULL AS VARCHAR) AS segment, 'b1' AS _batch_id FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_nationkey, NULL, c_mktsegment, 'b2' FROM customer""")
def schema_evolution_append(spark, sf):
    namespace = fresh_namespace(spark, "evolve")
    first = table(spark, sf, "supplier").selectExpr(
        "s_suppkey AS key", "s_name AS name", "s_nationkey AS nation", "s_acctbal AS balance")
    second = table(spark, sf, "customer").selectExpr(
        "c_mktsegment AS segment", "c_nationkey AS NATION", "c_custkey AS key", "c_name AS name")
    append(enrich(first, "parties", "file", "b1"), namespace, "parties")
    fqn = evolve_and_append(enrich(second, "parties", "file", "b2"), namespace, "parties")
    return spark.table(fqn).select("key", "name", "nation", "balance", "segment", "_batch_id")


def two_batches(spark, sf, label, partition_by=()):
    namespace = fresh_namespace(spark, label)
    events = table(spark, sf, "events")
    append(enrich(events, "events", "file", "b1"), namespace, "events", partition_by=partition_by)
    doubled = events.withColumn("value", F.col("value") * 2)
    return append(enrich(doubled, "events", "file", "b2"), namespace, "events")


@query("batch_rollback", "SELECT *, 'b1' AS _batch_id FROM events")
def batch_rollback(spark, sf):
    fqn = two_batches(spark, sf, "rollback")
    rollback_batch(spark, fqn, "b2")
    rows = spark.table(fqn)
    return rows.select(*raw_columns(rows), "_batch_id")


@query("batch_rollback_partition", "SELECT *, 'b1' AS _batch_id FROM events")
def batch_rollback_partition(spark, sf):
    fqn = two_batches(spark, sf, "rollpart", ["_batch_id"])
    rollback_batch(spark, fqn, "b2")
    rows = spark.table(fqn)
    return rows.select(*raw_columns(rows), "_batch_id")


@query("batch_reemit", """
    SELECT event_id, ts, user_id, event_type, value * 2 AS value, props FROM events""")
def batch_reemit(spark, sf):
    rows = batch_rows(spark.table(two_batches(spark, sf, "reemit")), "b2")
    return rows.select(*raw_columns(rows))


@query("select_by_audit", """
    SELECT 'b1' AS _batch_id, count(*) AS rows FROM events UNION ALL SELECT 'b2', count(*) FROM events""")
def select_by_audit(spark, sf):
    rows = spark.table(two_batches(spark, sf, "select"))
    return rows_by(select_rows(rows, source="events", source_type="file"), "_batch_id")


@query("rerun_dedupe", "SELECT *, 'b1' AS _batch_id, 'orders' AS _source FROM orders")
def rerun_dedupe(spark, sf):
    namespace = fresh_namespace(spark, "rerun")
    spec = file_spec("orders", f"{sf}/orders.parquet", "parquet", namespace)
    ingest_source(spark, spec, "b1")
    rows = latest_run(spark.table(ingest_source(spark, spec, "b1")[0]))
    return rows.select(*raw_columns(rows), "_batch_id", "_source")


@query("partitioned_append", """
    SELECT o_orderstatus, b AS _batch_id, count(*) AS rows, round(sum(o_totalprice), 2) AS total
    FROM orders, (VALUES ('b1'), ('b2')) v(b) GROUP BY ALL""")
def partitioned_append(spark, sf):
    namespace = fresh_namespace(spark, "status")
    spec = file_spec("orders", f"{sf}/orders.parquet", "parquet", namespace,
                     partition_by=("o_orderstatus",))
    ingest_source(spark, spec, "b1")
    rows = spark.table(ingest_source(spark, spec, "b2")[0])
    return rows.groupBy("o_orderstatus", "_batch_id").agg(
        F.count("*").alias("rows"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("transform_partitions", """
    SELECT CAST(ts AS DATE) AS ts_day, count(*) AS rows, count(DISTINCT user_id) AS users
    FROM events GROUP BY ALL""")
def transform_partitions(spark, sf):
    namespace = fresh_namespace(spark, "transform")
    layout = ["days(ts)", "bucket(4, user_id)"]
    fqn = append(table(spark, sf, "events"), namespace, "events", partition_by=layout)
    return spark.table(fqn).groupBy("ts_day").agg(
        F.count("*").alias("rows"), F.countDistinct("user_id").alias("users"))


@query("truncate_partitions", """
    SELECT substr(o_orderpriority, 1, 2) AS o_orderpriority_trunc, date_trunc('year', o_orderdate)::DATE
           AS o_orderdate_year, count(*) AS rows FROM orders GROUP BY ALL""")
def truncate_partitions(spark, sf):
    namespace = fresh_namespace(spark, "truncate")
    layout = ["years(o_orderdate)", "truncate(2, o_orderpriority)"]
    fqn = append(table(spark, sf, "orders"), namespace, "orders", partition_by=layout)
    return rows_by(spark.table(fqn), "o_orderpriority_trunc", "o_orderdate_year")


@query("overwrite_one_partition", """
    SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice) FROM orders""")
def overwrite_one_partition(spark, sf):
    namespace = fresh_namespace(spark, "overwrite")
    orders = table(spark, sf, "orders")
    fqn = write_partitioned(orders, namespace, "orders", ["o_orderstatus"])
    corrected = orders.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    overwrite_partitions(corrected, fqn)
    return spark.table(fqn)


@query("incremental_read", """
    WITH old AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
         mark AS (SELECT max(o_orderkey) AS m FROM old)
    SELECT *, 'b1' AS _batch_id FROM old
    UNION ALL SELECT orders.*, 'b2' FROM orders, mark WHERE o_orderkey > m""")
def incremental_read(spark, sf):
    namespace, path = fresh_namespace(spark, "increment"), scratch(spark, "early")
    early = table(spark, sf, "orders").where("o_orderdate < TIMESTAMP_NTZ '1998-01-01'")
    early.write.parquet(path)
    state = (namespace, "high_water")
    first = file_spec("orders", path, "parquet", namespace)
    ingest_increment(spark, first, "o_orderkey", "b1", state)
    later = file_spec("orders", f"{sf}/orders.parquet", "parquet", namespace)
    fqn, _ = ingest_increment(spark, later, "o_orderkey", "b2", state)
    rows = spark.table(fqn)
    return rows.select(*table(spark, sf, "orders").columns, "_batch_id")


class _Stopped(Exception):
    """Stands for a driver that is lost between the write and its mark."""


@query("incremental_rerun", "SELECT *, 'b1' AS _batch_id FROM orders")
def incremental_rerun(spark, sf):
    """The same batch id again and again: finished once, then stopped twice half-way, then finished."""
    namespace, path = fresh_namespace(spark, "again"), scratch(spark, "early")
    orders = table(spark, sf, "orders")
    middle = orders.agg(F.expr("percentile_approx(o_orderkey, 0.5)")).first()[0]
    orders.where(F.col("o_orderkey") <= middle).write.parquet(path)
    state = (namespace, "high_water")
    ingest_increment(spark, file_spec("orders", path, "parquet", namespace), "o_orderkey", "b1", state)
    later = file_spec("orders", f"{sf}/orders.parquet", "parquet", namespace)

    def stop():
        raise _Stopped
    for _ in range(2):
        try:
            ingest_increment(spark, later, "o_orderkey", "b1", state, written=stop)
        except _Stopped:
            pass
    fqn, _ = ingest_increment(spark, later, "o_orderkey", "b1", state)
    return spark.table(fqn).select(*orders.columns, "_batch_id")


@query("sibling_tables", " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", customer.* FROM customer CROSS JOIN (VALUES (1), (2)) v(n) "
    "WHERE c_nationkey % 5 <> 0" for t in ("t", "t__old", "t__stg", "t__part", "t__in")))
def sibling_tables(spark, sf):
    """Tables whose names look like leftovers, written and rewritten in turn."""
    namespace, names = fresh_namespace(spark, "siblings"), ["t", "t__old", "t__stg", "t__part", "t__in"]
    customer = table(spark, sf, "customer")
    for _ in range(2):
        for name in names:
            append(customer, namespace, name, partition_by=["c_nationkey"] if name == "t__part" else [])
    for name in names:
        delete_rows(spark, quoted(namespace, name), "c_nationkey % 5 = 0")
    parts = [spark.table(quoted(namespace, n)).select(F.lit(n).alias("table"), *customer.columns) for n in names]
    return reduce(DataFrame.unionByName, parts)


@query("table_properties", """
    SELECT t AS "table", k AS key, v AS value, (SELECT count(*) FROM nation) AS rows FROM (VALUES
        ('plain', 'owner.team', 'sales'), ('parted', 'owner.team', 'sales'), ('parted', 'terrace.partition_by', 'hash(4, n_nationkey)'),
        ('plain', 'option.compression', 'zstd'), ('parted', 'option.compression', 'zstd')) v(t, k, v)""")
def table_properties(spark, sf):
    namespace, nation = fresh_namespace(spark, "properties"), table(spark, sf, "nation")
    for name, layout in (("plain", []), ("parted", ["hash(4, n_nationkey)"])):
        append(nation, namespace, name, partition_by=layout, properties={"owner.team": "sales"})
        replace_table(spark.table(quoted(namespace, name)), quoted(namespace, name))  # properties outlive a rewrite
    shown = [spark.sql(f"SHOW TBLPROPERTIES {quoted(namespace, n)}").where(
        F.col("key").isin("owner.team", "terrace.partition_by", "option.compression")).select(
        F.lit(n).alias("table"), "key", "value", F.lit(spark.table(quoted(namespace, n)).count()).alias("rows"))
        for n in ("plain", "parted")]
    return shown[0].unionByName(shown[1])


@query("runs_join_rows", " UNION ALL ".join(
    f"SELECT '{t}' AS _source, 'ok' AS run_status, count(*) AS run_rows, count(*) AS rows FROM {t}"
    for t in ("orders", "customer")))
def runs_join_rows(spark, sf):
    """A batch whose first run of ``customer`` failed and was repeated."""
    namespace = fresh_namespace(spark, "runs")
    good = {t: file_spec(t, f"{sf}/{t}.parquet", "parquet", namespace) for t in ("orders", "customer")}
    broken = file_spec("customer", f"{sf}/no_such_table.parquet", "parquet", namespace)
    first = ingest_all(spark, [good["orders"], broken], batch_id="b1")
    again = [r["source"] for r in failed_sources(first, "b1").collect()]
    runs = first.unionByName(ingest_all(spark, list(good.values()), only=again, batch_id="b1"))
    raw = [spark.table(quoted(namespace, t)).select("_batch_id", "_source") for t in ("orders", "customer")]
    joined = rows_with_run(raw[0].unionByName(raw[1]), runs)
    return joined.groupBy("_source", "run_status", "run_rows").agg(F.count("*").alias("rows"))


@query("audit_contract", """
    SELECT c AS "column", t AS expected, t AS actual, 'ok' AS status,
           (SELECT avg(CASE WHEN o_orderkey IS NULL THEN 0.0 ELSE 1.0 END) FROM orders) AS share
    FROM (VALUES ('_ingested_at', 'timestamp'), ('_source', 'string'), ('_source_type', 'string'),
                 ('_batch_id', 'string'), ('_source_file', 'string')) v(c, t)""")
def audit_contract_query(spark, sf):
    rows = ingest_file(spark, "orders", f"{sf}/orders.parquet", "parquet", "contract")
    filled = completeness(rows, AUDIT_COLUMNS).withColumnRenamed("field", "column")
    return audit_contract(rows).join(filled, "column", "left")


@query("schema_check", """
    SELECT c AS "column", e AS expected, a AS actual, s AS status, share FROM (VALUES
        ('l_orderkey', 'bigint', 'bigint', 'ok'), ('l_linenumber', 'bigint', 'int', 'type_mismatch'),
        ('l_quantity', 'double', 'double', 'ok'), ('l_comment', 'string', NULL, 'missing'),
        ('l_partkey', 'bigint', 'bigint', 'ok'), ('l_suppkey', 'string', 'bigint', 'type_mismatch'),
        ('l_extendedprice', 'double', 'double', 'ok'), ('l_discount', 'decimal(4,2)', 'double', 'type_mismatch'),
        ('l_tax', 'double', 'double', 'ok'), ('l_returnflag', 'string', 'string', 'ok'),
        ('l_linestatus', NULL, 'string', 'extra'),
        ('l_shipdate', NULL, 'timestamp_ntz', 'extra')) v(c, e, a, s)
    LEFT JOIN (UNPIVOT (SELECT avg(CASE WHEN COLUMNS(*) IS NULL THEN 0.0 ELSE 1.0 END) FROM lineitem)
               ON COLUMNS(*) INTO NAME c VALUE share) USING (c)""")
def schema_check(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    expected = {"L_ORDERKEY": "bigint", "l_linenumber": "bigint", "l_quantity": "double",
                "l_comment": "string", "l_partkey": "long", "l_suppkey": "string", "l_extendedprice": "double",
                "l_discount": "decimal(4,2)", "l_tax": "double", "l_returnflag": "string"}
    filled = completeness(lineitem, lineitem.columns).where("field <> 'overall'")
    return schema_report(lineitem, expected).join(
        filled.withColumnRenamed("field", "column"), "column", "left")
