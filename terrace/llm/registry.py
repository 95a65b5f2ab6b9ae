"""The queries of this subpackage and the SQL some of them must agree with."""

from pyspark.sql import functions as F

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    """Register ``f(spark, sf_dir) -> DataFrame``."""
    def add(run):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run
    return add


def table(spark, sf, name):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def remainder(column, divisor):
    """crc32 of an id as text, modulo ``divisor``: the folds of the classifiers (NULL for a NULL id)."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor
