"""Dimension, fact and KPI queries, and the whole flow from raw files to a Gold table."""

from pyspark.sql import functions as F

from terrace.functions import rules as R
from terrace.operators.aggregates import kpi, kpi_sets
from terrace.operators.joins import conform, edges_with_facts, join_unique, lookup
from terrace.operators.tables import quoted
from terrace.plans.ingest import ingest_all, ingest_source
from terrace.plans.medallion import refresh_gold, refresh_silver
from terrace.queries.registered import fresh_namespace, query, table
from terrace.sources.files import read_files
from terrace.sources.spec import SourceSpec
from terrace.workspace import materialise, scratch

def nations(spark, sf):
    region = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return lookup(table(spark, sf, "nation"), region, "n_regionkey").select(
        F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name")


def revenue_by_customer(lineitem, orders):
    """Line revenue summed per order before the orders join, then per customer."""
    revenue = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    per_order = lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum(revenue).alias("revenue"))
    joined = per_order.join(orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    return joined.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.sum("revenue").alias("revenue"), F.count("*").alias("orders"))


@query("gold_revenue_by_nation", """
    SELECT n_name, r_name, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
           count(DISTINCT l_orderkey) AS orders
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY n_name, r_name""")
def gold_revenue_by_nation(spark, sf):
    facts = revenue_by_customer(table(spark, sf, "lineitem"), table(spark, sf, "orders"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    placed = lookup(conform(facts, customer, "c_custkey"), nations(spark, sf), "c_nationkey")
    namespace = fresh_namespace(spark, "revenue")
    fqn = refresh_gold(placed, "revenue_by_nation", ["n_name", "r_name"], {
        "revenue": F.round(F.sum("revenue"), 4), "orders": F.sum("orders")}, ["r_name"], namespace=namespace)
    return spark.table(fqn)


@query("medallion_revenue", """
    WITH latest AS (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC NULLS LAST, l_partkey, l_suppkey,
        l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus) AS rn
        FROM lineitem WHERE l_quantity >= 2)
    SELECT n_name, r_name, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
           count(DISTINCT l_orderkey) AS orders
    FROM latest JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE rn = 1 GROUP BY n_name, r_name""")
def medallion_revenue(spark, sf):
    namespace = fresh_namespace(spark, "medallion")
    names = ["lineitem", "orders", "customer"]
    ingest_all(spark, [SourceSpec(n, {"path": f"{sf}/{n}.parquet", "format": "parquet"},
                                  namespace=namespace) for n in names], batch_id="b1", concurrency=3)
    raw = spark.table(quoted(namespace, "lineitem"))
    types = {f.name: f.dataType.simpleString() for f in raw.schema if not f.name.startswith("_")}
    lineitem = spark.table(refresh_silver(
        raw, "silver_lineitem", types, ["l_orderkey", "l_linenumber"], "l_shipdate",
        rules=[R.at_least("l_quantity", 2)], namespace=namespace))
    facts = revenue_by_customer(lineitem, spark.table(quoted(namespace, "orders")))
    customer = spark.table(quoted(namespace, "customer")).select("c_custkey", "c_nationkey")
    placed = lookup(conform(facts, customer, "c_custkey"), nations(spark, sf), "c_nationkey")
    fqn = refresh_gold(placed, "gold_revenue", ["n_name", "r_name"], {
        "revenue": F.round(F.sum("revenue"), 4), "orders": F.sum("orders")}, ["r_name"], namespace=namespace)
    return spark.table(fqn)


@query("gold_dim_customers", """
    SELECT c_custkey, c_name, c_mktsegment, n_name, r_name, coalesce(n, 0) AS orders,
           CAST(d AS DATE) AS last_order FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    LEFT JOIN (SELECT o_custkey, count(*) AS n, max(o_orderdate) AS d FROM orders GROUP BY 1)
    ON c_custkey = o_custkey""")
def gold_dim_customers(spark, sf):
    activity = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("orders"), F.to_date(F.max("o_orderdate")).alias("last_order"))
    placed = lookup(table(spark, sf, "customer"), nations(spark, sf), "c_nationkey")
    # Both sides have one row per customer, so a plain join cannot meet a hot key.
    return placed.join(activity, "c_custkey", "left").select(
        "c_custkey", "c_name", "c_mktsegment", "n_name", "r_name",
        F.coalesce("orders", F.lit(0)).alias("orders"), "last_order")


@query("conform_unknown_member", """
    SELECT coalesce(q.quality, -1)::INTEGER AS quality, CASE WHEN q.doc_id IS NULL THEN -1 ELSE d.doc_id END
           AS doc_id, count(*) AS documents, sum(n_chars)::BIGINT AS chars
    FROM documents d LEFT JOIN labels q ON d.doc_id = q.doc_id GROUP BY ALL""")
def conform_unknown_member(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    joined = conform(table(spark, sf, "documents").select("doc_id", "n_chars"), labels, "doc_id")
    return joined.groupBy(F.coalesce("quality", F.lit(-1)).alias("quality"), "doc_id").agg(
        F.count("*").alias("documents"), F.sum("n_chars").alias("chars"))


def line_kpi(spark, sf, mode):
    if mode == "group":
        return kpi(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], {
            "rows": F.count("*"), "quantity": F.round(F.sum("l_quantity"), 2),
            "orders": F.countDistinct("l_orderkey"), "cheapest": F.min("l_extendedprice"),
            "dearest": F.max("l_extendedprice"), "mean_tax": F.round(F.avg("l_tax"), 8)}, mode)
    sets = kpi_sets(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], {
        "rows": ("count", "*"), "quantity": ("sum", "l_quantity"), "orders": ("distinct", "l_orderkey"),
        "cheapest": ("min", "l_extendedprice"), "dearest": ("max", "l_extendedprice"), "mean_tax": ("avg", "l_tax")}, mode)
    return sets.withColumns({"quantity": F.round("quantity", 2), "mean_tax": F.round("mean_tax", 8)})


KPI_SQL = """count(*) AS rows, round(sum(l_quantity), 2) AS quantity, count(DISTINCT l_orderkey) AS orders,
    min(l_extendedprice) AS cheapest, max(l_extendedprice) AS dearest, round(avg(l_tax), 8) AS mean_tax"""


@query("gold_kpi", f"SELECT l_returnflag, l_linestatus, {KPI_SQL} FROM lineitem GROUP BY 1, 2")
def gold_kpi(spark, sf):
    return line_kpi(spark, sf, "group")


@query("gold_kpi_rollup", f"SELECT l_returnflag, l_linestatus, {KPI_SQL} FROM lineitem GROUP BY ROLLUP (1, 2)")
def gold_kpi_rollup(spark, sf):
    return line_kpi(spark, sf, "rollup")


@query("gold_kpi_cube", f"SELECT l_returnflag, l_linestatus, {KPI_SQL} FROM lineitem GROUP BY CUBE (1, 2)")
def gold_kpi_cube(spark, sf):
    return line_kpi(spark, sf, "cube")


@query("gold_daily_events", """
    SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS events, round(sum(value), 2) AS total,
           count(DISTINCT user_id) AS users FROM events GROUP BY ALL""")
def gold_daily_events(spark, sf):
    namespace = fresh_namespace(spark, "daily")
    events = table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    measures = {"events": F.count("*"), "total": F.round(F.sum("value"), 2), "users": F.countDistinct("user_id")}
    early = events.where("day < DATE '2024-01-20'")
    refresh_gold(early, "daily", ["day", "event_type"], measures, ["day"], namespace=namespace)
    return spark.table(refresh_gold(
        events.where("day >= DATE '2024-01-10'"), "daily", ["day", "event_type"], measures, ["day"],
        namespace=namespace))


@query("seed_lookup", """
    SELECT c_custkey, c_name, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def seed_lookup(spark, sf):
    path = scratch(spark, "seed")
    table(spark, sf, "nation").write.option("header", True).csv(path)
    seed = read_files(spark, SourceSpec("nation_seed", {"path": path, "format": "csv"}))
    seed = seed.withColumn("c_nationkey", F.col("n_nationkey").cast("int")).drop("n_nationkey")
    return lookup(table(spark, sf, "customer"), seed, "c_nationkey").select(
        "c_custkey", "c_name", "n_name", "n_regionkey")


@query("edge_network", """
    WITH t AS (SELECT o_custkey AS source, l_suppkey AS target, l_extendedprice, l_returnflag
               FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
         e AS (SELECT source, target, sum(1) AS weight FROM t WHERE l_returnflag = 'R' GROUP BY ALL)
    SELECT target, count(*) AS sales, round(sum(l_extendedprice), 2) AS amount, sum(weight)::BIGINT AS weight
    FROM t JOIN e USING (source, target) GROUP BY target""")
def edge_network(spark, sf):
    owner = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                              F.col("o_custkey").alias("source"))
    # Read twice below, by the export and by the join with the edges, so computed once.
    sales = materialise(join_unique(table(spark, sf, "lineitem"), owner, "l_orderkey", "inner").select(
        "source", F.col("l_suppkey").alias("target"), "l_extendedprice", "l_returnflag"), "sales")
    path = scratch(spark, "edges")
    sales.where("l_returnflag = 'R'").select("source", "target", F.lit(1).alias("weight")).write.option(
        "header", True).csv(path)
    spec = SourceSpec("edges", {"path": path, "format": "csv"}, namespace=fresh_namespace(spark, "edges"))
    edges = spark.table(ingest_source(spark, spec, "b1")[0]).select(
        F.col("source").cast("bigint"), F.col("target").cast("bigint"), F.col("weight").cast("bigint"))
    joined = edges_with_facts(sales, edges, ["source", "target"], "weight")
    return joined.groupBy("target").agg(F.count("*").alias("sales"),
                                        F.round(F.sum("l_extendedprice"), 2).alias("amount"),
                                        F.sum("weight").alias("weight"))
