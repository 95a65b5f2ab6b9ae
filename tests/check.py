"""Compare every registered query with its SQL in DuckDB: ``python tests/check.py [sf] [name ...]``."""

import math
import os
import sys
import time
from datetime import date, datetime

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry  # noqa: E402
from terrace.queries.registered import TABLES  # noqa: E402


def plain(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return f"{type(value).__name__}:{value}"


def keyed(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(plain(r[i]) for i in order) for r in rows)


def oracle(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def differences(spark, con, sf_dir, name):
    """None when they agree, else a short text."""
    result = entry.queries()[name](spark, sf_dir)
    mine = keyed(result.columns, [tuple(r) for r in result.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return None if mine[1] else "no rows"
    found = con.execute(sql)
    theirs = keyed([d[0] for d in found.description], found.fetchall())
    if mine == theirs:
        return None
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} vs {theirs[0]}"
    a, b = set(mine[1]), set(theirs[1])
    return (f"rows {len(mine[1])} vs {len(theirs[1])}; only ours {sorted(a - b)[:2]}; "
            f"only oracle {sorted(b - a)[:2]}")


if __name__ == "__main__":
    where = f"/root/testdata/sf{sys.argv[1] if len(sys.argv) > 1 else '0.01'}"
    session = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
               .config("spark.driver.memory", "8g").config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    duck = oracle(where)
    wrong = 0
    for key in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            problem = differences(session, duck, where, key)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        wrong += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {key} {time.time() - start:.1f}s {problem or ''}",
              flush=True)
    print(f"{wrong} wrong")
