"""JDBC scans: whole table or query, split by a numeric column, or above a high-water mark.

A split is either of equal strides between two given bounds (``lower_bound``, ``upper_bound``), or of
equal depth (``split: depth``): then the database counts the rows of many strides, and the partitions
are made of neighbouring strides with about as many rows each.
"""

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from terrace.sources.spec import SourceSpec

# Fixed value: rows fetched per round trip unless the source says otherwise.
FETCH_SIZE = 1000

_SPLIT = {"partition_column": "partitionColumn", "lower_bound": "lowerBound",
          "upper_bound": "upperBound", "num_partitions": "numPartitions"}


# Strides counted for each partition of an equal-depth split, and for each stride that is cut again.
STRIDES = 16


def credential(variable: str, source: str) -> str:
    value = os.environ.get(variable)
    if not value:
        raise EnvironmentError(f"[{source}] credential variable {variable!r} is not set")
    return value


def jdbc_options(spec: SourceSpec) -> dict[str, str]:
    """Options for Spark's JDBC reader, credentials taken from the environment."""
    url, driver, user, password = spec.need("url", "driver", "user_env", "password_env")
    table, query = spec.options.get("dbtable"), spec.options.get("query")
    if bool(table) == bool(query):
        raise ValueError(f"[{spec.name}] jdbc source needs exactly one of dbtable, query")

    split = {spark_name: str(spec.options[ours]) for ours, spark_name in _SPLIT.items()
             if spec.options.get(ours) not in (None, "")}
    kind = spec.options.get("split") or "stride"
    if kind not in ("stride", "depth"):
        raise ValueError(f"[{spec.name}] split is stride or depth, not {kind!r}")
    if kind == "depth":
        if set(split) != {"partitionColumn", "numPartitions"}:
            raise ValueError(f"[{spec.name}] a split by depth needs partition_column and num_partitions and takes no bounds")
        split = {}
    bounded = set(split) - {"numPartitions"}
    if bounded and len(split) < len(_SPLIT):
        raise ValueError(f"[{spec.name}] a split read needs all of {sorted(_SPLIT)}")

    # Spark refuses query together with partitionColumn, but accepts a derived table.
    relation = {"dbtable": table} if table else (
        {"dbtable": f"({query}) split_query"} if bounded else {"query": query})
    return {
        "url": url, "driver": driver,
        "user": credential(user, spec.name), "password": credential(password, spec.name),
        "fetchsize": str(int(spec.options.get("fetch_size") or FETCH_SIZE)),
        **relation, **split,
    }


def read_jdbc(spark: SparkSession, spec: SourceSpec, above: tuple | None = None) -> DataFrame:
    """The source as a frame; ``above`` is ``(column, mark)``: only rows beyond it, NULL left out."""
    if (spec.options.get("split") or "stride") == "depth":
        options, where = jdbc_options(spec), depth_predicates(spark, spec, above)
        relation = options.get("dbtable") or f"({options.pop('query')}) depth_query"
        rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(options["url"], relation, predicates=where, properties=rest)
    rows = spark.read.format("jdbc").options(**jdbc_options(spec)).load()
    return rows if above is None else read_increment(rows, *above)


def depth_predicates(spark: SparkSession, spec: SourceSpec, above: tuple | None = None) -> list[str]:
    """Conditions that split the source (or what lies above the mark) into parts of about as many rows.

    The database counts rows by strides of the column's range; a stride with more rows than a quarter of
    a part is counted again in finer strides, down to single values. So a part holds at most
    1.25 times its share, or one value. The first part also takes NULL (unless there is a mark), the
    last one whatever arrives after the counting.
    """
    options = jdbc_options(spec)
    parts = int(spec.options["num_partitions"])
    quote = spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(options["url"]).quoteIdentifier
    column = quote(spec.options["partition_column"])
    beyond = [f"{quote(above[0])} IS NOT NULL" if above[1] is None else f"{quote(above[0])} > {_sql(above[1])}"] if above else []
    relation = options.pop("dbtable", None) or f"({options.pop('query')}) depth_query"
    options.pop("query", None)

    def ask(select, *conditions):
        where = " AND ".join([f"{column} IS NOT NULL", *beyond, *conditions])
        return spark.read.format("jdbc").options(**options).option("query", select.format(f"{relation} WHERE {where}")).load().collect()

    (low, high, rows), = ask(f"SELECT MIN({column}) AS a, MAX({column}) AS b, COUNT(*) AS n FROM {{}}")
    if not rows:
        return [" AND ".join(beyond)] if beyond else ["1 = 1"]
    if low != int(low) or high != int(high):
        raise TypeError(f"[{spec.name}] a split by depth needs an integer column")
    low, high = int(low), int(high)
    enough = max(1, rows // (4 * parts))

    def counted(start, end, strides):
        """``(first value, rows)`` of strides that are not empty, from ``start`` up to but without ``end``."""
        width = max(1, -(-(end - start) // strides))
        found = ask(f"SELECT s, COUNT(*) AS n FROM (SELECT CAST(({column} - {start}) / {width} AS BIGINT) AS s FROM {{}}) t GROUP BY s",
                    f"{column} >= {start}", f"{column} < {end}")
        for s, n in sorted((int(s), int(n)) for s, n in found):
            first = start + s * width
            if n > enough and width > 1:
                yield from counted(first, min(end, first + width), STRIDES)
            else:
                yield first, n

    starts, held, share = [], 0, rows / parts
    for first, n in counted(low, high + 1, STRIDES * parts):
        if starts and held + n > share * 1.25 or not starts:
            starts.append(first)
            held = 0
        held += n
    edges = [None, *starts[1:], None]
    out = []
    for a, b in zip(edges, edges[1:]):
        inside = [c for c, given in ((f"{column} >= {a}", a is not None), (f"{column} < {b}", b is not None)) if given]
        text = " AND ".join(inside)
        if a is None and not beyond:
            text = f"({text} OR {column} IS NULL)" if text else "1 = 1"
        out.append(" AND ".join(x for x in (text, *beyond) if x))
    return out


def _sql(value) -> str:
    """A mark as the database reads it."""
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("'", "''") + "'"


def read_increment(df: DataFrame, column: str, high_water=None) -> DataFrame:
    """Rows strictly above the mark; NULL is never read; no mark reads everything.

    On a JDBC or Parquet frame the comparison is pushed down to the scan.
    """
    present = df.where(F.col(column).isNotNull())
    return present if high_water is None else present.where(F.col(column) > F.lit(high_water))
