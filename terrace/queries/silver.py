"""Typing, null policy, deduplication, upsert, change-log and rule queries."""

from pyspark.sql import functions as F

from terrace.functions import rules as R
from terrace.operators.aggregates import duplicate_keys, unknown_names
from terrace.operators.changes import apply_changes
from terrace.operators.joins import matched, orphans
from terrace.operators.quality import rule_report, split_by_rules
from terrace.operators.staging import dedup, null_policy, type_rules, typed, upsert, upsert_into
from terrace.operators.tables import append, quoted
from terrace.plans.ingest import ingest_source
from terrace.plans.medallion import refresh_silver
from terrace.queries.registered import fresh_namespace, query, table
from terrace.sources.registry import registry_rules, select_enabled, shared_targets
from terrace.sources.spec import SourceSpec
from terrace.workspace import scratch

ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "int", "o_orderstatus": "string",
               "o_totalprice": "double", "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}

# What the exported text looks like: padded numbers, blanks and words where a number belongs.
DIRTY_ORDERS = {
    "o_totalprice": "CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE concat(' ', o_totalprice, ' ') END",
    "o_orderstatus": "CASE WHEN o_orderstatus = 'P' THEN '  ' ELSE o_orderstatus END",
    "o_custkey": "CASE WHEN o_orderpriority = '1-URGENT' THEN concat(o_custkey, '.5') "
                 "ELSE CAST(o_custkey AS STRING) END",
}


def dirty_orders(spark, sf):
    path = scratch(spark, "dirty")
    orders = table(spark, sf, "orders")
    texts = [F.expr(DIRTY_ORDERS.get(c, f"CAST({c} AS STRING)")).alias(c) for c in orders.columns]
    orders.select(*texts).write.options(
        header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return path


@query("silver_typed_orders", """
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN -1 ELSE o_custkey END::INTEGER AS o_custkey,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice, o_orderdate, o_orderpriority, 'b1' AS _batch_id
    FROM orders WHERE o_orderpriority <> '5-LOW'""")
def silver_typed_orders(spark, sf):
    spec = SourceSpec("orders_text", {"path": dirty_orders(spark, sf), "format": "csv"},
                      namespace=fresh_namespace(spark, "typed"))
    raw = spark.table(ingest_source(spark, spec, "b1")[0])
    rows = null_policy(typed(raw, ORDER_TYPES), {
        "o_totalprice": ("drop", None), "o_custkey": ("fill", -1), "o_orderstatus": ("keep", None)})
    return rows.select(*ORDER_TYPES, "_batch_id")


@query("silver_typed_columns", """
    SELECT o_orderkey, 'int' AS field, CAST(o_totalprice AS BIGINT) IS NULL AS unread, CAST(trunc(o_totalprice) AS VARCHAR) AS read FROM orders
    UNION ALL SELECT o_orderkey, 'small', trunc(o_totalprice) NOT BETWEEN -32768 AND 32767,
        CASE WHEN trunc(o_totalprice) BETWEEN -32768 AND 32767 THEN CAST(CAST(trunc(o_totalprice) AS INTEGER) AS VARCHAR) END FROM orders
    UNION ALL SELECT o_orderkey, 'day', FALSE, strftime(o_orderdate, '%Y-%m-%d') FROM orders
    UNION ALL SELECT o_orderkey, 'nested', FALSE, CAST(o_custkey + 1 AS VARCHAR) FROM orders
    UNION ALL SELECT o_orderkey, 'dec', trunc(o_totalprice) >= 100000, CASE WHEN trunc(o_totalprice) < 100000
        THEN CAST(CAST(trunc(o_totalprice) AS INTEGER) AS VARCHAR) END FROM orders""")
def silver_typed_columns(spark, sf):
    """Raw numbers, decimals, timestamps and arrays declared as other types: what ``typed`` reads,
    the gate passes, and what it cannot read is quarantined, field by field."""
    whole = F.floor("o_totalprice")
    raw = table(spark, sf, "orders").select(
        "o_orderkey", whole.cast("double").alias("int"), whole.cast("double").alias("small"), F.col("o_orderdate").alias("day"),
        F.array(F.col("o_custkey").cast("int"), F.lit(1)).alias("nested"), whole.cast("decimal(12,0)").alias("dec"))
    types = {"o_orderkey": "bigint", "int": "bigint", "small": "smallint", "day": "date", "nested": "array<bigint>", "dec": "decimal(5,0)"}
    read = typed(raw, types)
    passed, held = split_by_rules(raw, type_rules(raw, types))
    broken = held.select("o_orderkey", "_failed_rules").unionByName(passed.select("o_orderkey", F.array().cast("array<string>").alias("_failed_rules")))
    shown = {"int": F.concat(F.col("int").cast("string"), F.lit(".0")), "small": F.col("small").cast("string"), "day": F.col("day").cast("string"),
             "nested": (F.col("nested")[0] + F.col("nested")[1]).cast("string"), "dec": F.col("dec").cast("string")}
    fields = F.explode(F.array(*[F.struct(F.lit(k).alias("field"), v.alias("read")) for k, v in shown.items()])).alias("f")
    return read.join(broken, "o_orderkey").select("o_orderkey", "_failed_rules", fields).select(
        "o_orderkey", "f.field", F.array_contains("_failed_rules", F.concat("f.field", F.lit(":type"))).alias("unread"), "f.read")


@query("silver_dedup_lineitem", """
    SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey,
        l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn FROM lineitem)
    WHERE rn = 1""")
def silver_dedup_lineitem(spark, sf):
    return dedup(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"])


@query("silver_upsert_customer", """
    WITH incoming AS (
        SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment, 2 AS version FROM customer
        WHERE c_mktsegment = 'BUILDING'
        UNION ALL SELECT c_custkey, 'stale', c_nationkey, 0.0, 'OLD', 0 FROM customer WHERE c_mktsegment = 'MACHINERY'
        UNION ALL SELECT c_custkey, 'tie', -1, c_acctbal, c_mktsegment, 1 FROM customer WHERE c_mktsegment = 'HOUSEHOLD'
        UNION ALL SELECT -1 - s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 1 FROM supplier)
    SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, version FROM (
        SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY version DESC, side) AS rn FROM (
            SELECT *, 0 AS side FROM incoming
            UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 1, 1 FROM customer))
    WHERE rn = 1""")
def silver_upsert_customer(spark, sf):
    customer = table(spark, sf, "customer")
    supplier = table(spark, sf, "supplier")
    # Partitioned by a hash of the key: an upsert rewrites only the partitions of its own keys.
    fqn = append(customer.withColumn("version", F.lit(1)), fresh_namespace(spark, "upsert"), "customer",
                 partition_by=["hash(16, c_custkey)"])

    def segment(name, version, **changed):
        rows = customer.where(F.col("c_mktsegment") == name).withColumn("version", F.lit(version))
        return rows.withColumns({c: F.expr(e) for c, e in changed.items()})
    incoming = (
        segment("BUILDING", 2, c_acctbal="c_acctbal + 100")
        .unionByName(segment("MACHINERY", 0, c_name="'stale'", c_acctbal="0D", c_mktsegment="'OLD'"))
        .unionByName(segment("HOUSEHOLD", 1, c_name="'tie'", c_nationkey="-1"))
        .unionByName(supplier.selectExpr("-1 - s_suppkey AS c_custkey", "s_name AS c_name", "s_nationkey AS c_nationkey",
                                         "s_acctbal AS c_acctbal", "CAST(NULL AS STRING) AS c_mktsegment", "1 AS version")))
    upsert_into(incoming, fqn, ["c_custkey"], "version")
    return spark.table(fqn).select(*customer.columns, "version")


@query("silver_upsert_any_target", """
    SELECT * EXCLUDE (side, rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                                     ORDER BY l_shipdate DESC, side, l_partkey, l_suppkey, l_quantity, l_extendedprice,
                                              l_discount, l_tax, l_returnflag, l_linestatus) AS rn
        FROM (SELECT *, 1 AS side FROM lineitem
              UNION ALL SELECT * REPLACE (-l_quantity AS l_quantity), 0 FROM lineitem
              WHERE l_returnflag = 'R')) WHERE rn = 1""")
def silver_upsert_any_target(spark, sf):
    lineitem = table(spark, sf, "lineitem")
    returned = lineitem.where("l_returnflag = 'R'").withColumn("l_quantity", -F.col("l_quantity"))
    return upsert(lineitem, returned, ["l_orderkey", "l_linenumber"], "l_shipdate")


OP_SQL = "CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'i' ELSE 'u' END"


@query("cdc_latest", f"""
    SELECT event_id, user_id, day, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id
            ORDER BY day DESC, (op = 'd') DESC, event_id) AS rn
        FROM (SELECT event_id, user_id, CAST(ts AS DATE) AS day, value, {OP_SQL} AS op FROM events))
    WHERE rn = 1 AND op <> 'd'""")
def cdc_latest(spark, sf):
    changes = table(spark, sf, "events").select(
        "event_id", "user_id", F.to_date("ts").alias("day"), "value", F.expr(OP_SQL).alias("op"))
    return apply_changes(changes, ["user_id"], "day", "op")


def document_rules():
    return [
        R.required("doc_id"), R.unique("doc_id"), R.min_length("text", 20, "text_length"),
        R.one_of("lang", ["en", "fr"], "lang_known"), R.matches("source", "^src1?[0-9]$", "source_name"),
        R.at_least("n_chars", 100, "n_chars_minimum"), R.unique("text", name="text_unique"),
        R.when(F.col("lang") == "en", R.matches("text", "the", "english_text")),
    ]


DOCUMENT_CHECKS = """SELECT doc_id,
    length(text) < 20 AS r1, lang NOT IN ('en', 'fr') AS r2,
    NOT regexp_matches(source, '^src1?[0-9]$') AS r3, n_chars < 100 AS r4,
    count(*) OVER (PARTITION BY text) > 1 AS r5,
    lang = 'en' AND NOT contains(text, 'the') AS r6, lang FROM documents"""


@query("rule_report", f"""
    WITH c AS ({DOCUMENT_CHECKS}), n AS (SELECT count(*) AS n FROM documents)
    SELECT 'doc_id:required' AS rule, n AS checked, 0::BIGINT AS failed FROM n
    UNION ALL SELECT 'doc_id:unique', n, 0 FROM n
    UNION ALL SELECT 'text_length', count(*), count(*) FILTER (r1) FROM c
    UNION ALL SELECT 'lang_known', count(*), count(*) FILTER (r2) FROM c
    UNION ALL SELECT 'source_name', count(*), count(*) FILTER (r3) FROM c
    UNION ALL SELECT 'n_chars_minimum', count(*), count(*) FILTER (r4) FROM c
    UNION ALL SELECT 'text_unique', count(*), count(*) FILTER (r5) FROM c
    UNION ALL SELECT 'english_text', count(*) FILTER (lang = 'en'), count(*) FILTER (r6) FROM c""")
def rule_report_query(spark, sf):
    return rule_report(table(spark, sf, "documents"), document_rules())


@query("quarantine_split", f"""
    WITH c AS (SELECT doc_id, concat_ws(',', CASE WHEN r1 THEN 'text_length' END,
        CASE WHEN r2 THEN 'lang_known' END, CASE WHEN r3 THEN 'source_name' END,
        CASE WHEN r4 THEN 'n_chars_minimum' END, CASE WHEN r5 THEN 'text_unique' END,
        CASE WHEN r6 THEN 'english_text' END) AS broken FROM ({DOCUMENT_CHECKS}))
    SELECT doc_id, broken <> '' AS quarantined, broken FROM c""")
def quarantine_split(spark, sf):
    passed, quarantined = split_by_rules(table(spark, sf, "documents"), document_rules())
    return passed.select("doc_id", F.lit(False).alias("quarantined"), F.lit("").alias("broken")).unionByName(
        quarantined.select("doc_id", F.lit(True).alias("quarantined"),
                           F.array_join("_failed_rules", ",").alias("broken")))


@query("duplicate_keys", """
    SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def duplicate_keys_query(spark, sf):
    return duplicate_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("orphan_keys", """
    SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def orphan_keys(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return orphans(documents, table(spark, sf, "labels"), "doc_id")


@query("matched_keys", """
    SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)""")
def matched_keys(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "lang", "source")
    return matched(documents, table(spark, sf, "labels"), "doc_id")


@query("silver_refresh_orders", """
    SELECT o_orderkey, o_custkey::INTEGER AS o_custkey, o_orderstatus, o_totalprice, o_orderdate,
           o_orderpriority, 'silver' AS layer FROM orders
    WHERE o_orderpriority NOT IN ('5-LOW', '1-URGENT') AND o_orderstatus <> 'P' AND o_totalprice >= 50000
    UNION ALL SELECT o_orderkey, NULL, NULL, NULL, NULL, NULL, 'quarantine' FROM orders
    WHERE o_orderpriority IN ('5-LOW', '1-URGENT') OR (o_orderstatus <> 'P' AND o_totalprice < 50000)""")
def silver_refresh_orders(spark, sf):
    namespace = fresh_namespace(spark, "refresh")
    spec = SourceSpec("orders_text", {"path": dirty_orders(spark, sf), "format": "csv"},
                      namespace=namespace)
    raw = spark.table(ingest_source(spark, spec, "b1")[0])
    for _ in range(2):  # the second run of the same batch must change nothing
        fqn = refresh_silver(raw, "orders", ORDER_TYPES, ["o_orderkey"], "o_orderdate",
                             nulls={"o_orderstatus": ("drop", None)},
                             rules=[R.at_least("o_totalprice", 50000)], namespace=namespace, batch_ids=["b1"],
                             partition_by=["hash(16, o_orderkey)"])
    silver = spark.table(fqn).select(*ORDER_TYPES, F.lit("silver").alias("layer"))
    held = spark.table(quoted(namespace, "orders_quarantine"))
    return silver.unionByName(held.select(F.col("o_orderkey").cast("bigint"), F.lit("quarantine").alias("layer")),
                              allowMissingColumns=True)


def part_registry(spark, sf):
    """The part table read as a registry: one source per part."""
    return table(spark, sf, "part").select(
        F.concat(F.lower("p_type"), F.lit("_"), F.col("p_partkey")).alias("name"),
        F.when(F.col("p_size") > 45, "ftp").otherwise("file").alias("type"),
        F.struct(F.lit("bronze").alias("namespace"), F.lower("p_type").alias("table")).alias("target"),
        F.create_map(F.lit("path"), F.col("p_name"), F.lit("format"),
                     F.when(F.col("p_size") < 5, "xml").otherwise("csv")).alias("options"),
        F.array().cast("array<string>").alias("partition_by"), (F.col("p_size") > 10).alias("enabled"),
        F.split("p_name", " ").alias("tags"), F.col("p_brand").alias("owner"))


@query("registry_uniqueness", """
    SELECT 'name:unique' AS rule, count(*) AS checked, 0::BIGINT AS failed FROM part
    UNION ALL SELECT 'type:enum', count(*), count(*) FILTER (p_size > 45) FROM part
    UNION ALL SELECT 'options.format:enum', count(*) FILTER (p_size <= 45), count(*) FILTER (p_size < 5) FROM part
    UNION ALL SELECT 'name:pattern', count(*), 0 FROM part
    UNION ALL SELECT 'tags:unique_items', count(*),
        count(*) FILTER (len(list_distinct(string_split(p_name, ' '))) <> len(string_split(p_name, ' '))) FROM part
    UNION ALL SELECT r, count(*), 0 FROM part, (VALUES ('name:required'), ('type:required'), ('target.namespace:required'),
        ('target.namespace:pattern'), ('target.table:required'), ('partition_by:unique_items'), ('options:required')) v(r) GROUP BY r
    UNION ALL SELECT 'target.table:pattern', count(*), count(*) FILTER (NOT regexp_full_match(lower(p_type), '[a-z][a-z0-9_]{1,127}')) FROM part
    UNION ALL SELECT r, count(*) FILTER (p_size <= 45), 0 FROM part, (VALUES ('options.path:required'), ('options.format:required')) v(r) GROUP BY r
    UNION ALL SELECT r, 0, 0 FROM part, (VALUES ('options.url:required'), ('options.driver:required'), ('options.user_env:required'),
        ('options.password_env:required'), ('options.num_partitions:minimum'), ('options.fetch_size:minimum'),
        ('options.dbtable|query:one_of')) v(r) GROUP BY r""")
def registry_uniqueness(spark, sf):
    return rule_report(part_registry(spark, sf), registry_rules())


@query("registry_shared_targets", """
    SELECT 'bronze' AS namespace, lower(p_type) AS "table", count(*) AS sources
    FROM part GROUP BY ALL HAVING count(*) > 1""")
def registry_shared_targets(spark, sf):
    return shared_targets(part_registry(spark, sf))


@query("select_enabled", """
    SELECT lower(p_type) || '_' || p_partkey AS name, p_brand AS owner FROM part
    WHERE p_size > 10 AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')""")
def select_enabled_query(spark, sf):
    returned = matched(table(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey"),
                       table(spark, sf, "lineitem").where("l_returnflag = 'R'"), "l_partkey")
    only = returned.select(F.concat(F.lower("p_type"), F.lit("_"), F.col("l_partkey")).alias("name"))
    return select_enabled(part_registry(spark, sf), only).select("name", "owner")


@query("unknown_sources", """
    SELECT 'doc_' || doc_id AS name FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def unknown_sources(spark, sf):
    def names(t):
        return table(spark, sf, t).select(F.concat(F.lit("doc_"), F.col("doc_id")).alias("name"))
    return unknown_names(names("documents"), names("labels"))
