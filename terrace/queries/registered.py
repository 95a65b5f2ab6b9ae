"""How a query is registered, and its tables and namespaces."""

from terrace.operators.tables import ensure_namespace
from terrace.workspace import scratch

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register ``f(spark, sf_dir) -> DataFrame`` with the SQL it must agree with."""
    def add(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run
    return add


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def fresh_namespace(spark, label):
    """A namespace of its own for every call, stored in the shared folder."""
    path = scratch(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    ensure_namespace(spark, name, location=path)
    return name
