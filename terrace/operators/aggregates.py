"""Grouped reports."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def kpi(df: DataFrame, by: Sequence[str], measures: Mapping[str, Column],
        mode: str = "group") -> DataFrame:
    """Named measures per group; ``mode`` is group, rollup or cube."""
    grouping = {"group": df.groupBy, "rollup": df.rollup, "cube": df.cube}
    if mode not in grouping:
        raise ValueError(f"mode is one of {sorted(grouping)}, not {mode!r}")
    return grouping[mode](*by).agg(*[m.alias(name) for name, m in measures.items()])


#: How the parts of a measure are added up again.
_AGAIN = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}

#: Rows of a part of ``kpi_sets``, and parts at most (up to 200 are written without a sort in memory).
PART_ROWS, MOST_PARTS = 250_000, 200


def kpi_sets(df: DataFrame, by: Sequence[str], measures: Mapping[str, tuple[str, str]], mode: str = "cube") -> DataFrame:
    """``kpi`` over grouping sets of large data: ``{name: (kind, column)}``.

    Kinds are count, sum, min, max, avg and distinct (``("count", "*")`` counts rows). Rows are first
    aggregated by all groups and the columns counted distinct. Of what is left, the first row of every
    value within every grouping set is marked, and the marks are added up, so distinct counts stay
    exact and no task holds the values of a set in memory.
    """
    unknown = {kind for kind, _ in measures.values()} - {*_AGAIN, "avg", "distinct"}
    if unknown or mode not in ("group", "rollup", "cube"):
        raise ValueError(f"unknown kind of measure {sorted(unknown)} or mode {mode!r}")
    distinct = list(dict.fromkeys(c for kind, c in measures.values() if kind == "distinct"))
    sets = _grouping_sets(by, mode)
    first, then = {}, {}
    for i, (name, (kind, column)) in enumerate(measures.items()):
        part = f"_part{i}"
        if kind == "distinct":
            k = distinct.index(column)
            then |= {f"{part}_{gid}": F.sum(f"_first{k}_{gid}") for gid in sets}
        elif kind == "avg":
            first |= {part: F.sum(column), f"{part}n": F.count(column)}
            then[name] = F.sum(part) / F.nullif(F.sum(f"{part}n"), F.lit(0))
        else:
            first[part] = getattr(F, kind)(column)
            then[name] = _AGAIN[kind](part)
    partial = [m.alias(n) for n, m in (first or {"_rows": F.count("*")}).items()]
    if not distinct:
        return kpi(df.groupBy(*by).agg(*partial), by, then, mode)

    # Rows are dealt out by all that is read of them, so a frequent value is counted by many tasks.
    read = dict.fromkeys([*by, *(c for _, c in measures.values() if c != "*")])
    parts = max(1, min(MOST_PARTS, -(-df.count() // PART_ROWS)))
    keys = [F.col(c).alias(f"_distinct{i}") for i, c in enumerate(distinct)]
    rows = df.withColumn("_turn", F.pmod(F.xxhash64(*read), F.lit(16 * parts))).repartition(parts, "_turn")
    rows = rows.groupBy("_turn", *by, *keys).agg(*partial).drop("_turn")
    for k in range(len(distinct)):
        value = F.col(f"_distinct{k}")
        rows = rows.repartition(parts, value)
        # The widest set comes last: in a rollup one order serves all sets.
        for gid, names in sorted(sets.items(), reverse=True):
            rest = [c for c in by if c not in names]
            place = F.row_number().over(Window.partitionBy(value, *names).orderBy(*rest or [F.lit(0)]))
            rows = rows.withColumn(f"_first{k}_{gid}", ((place == 1) & value.isNotNull()).cast("int"))
    if mode != "group":
        then["_set"] = F.grouping_id()
    found = kpi(rows, by, then, mode)
    gid = F.lit(0) if mode == "group" else F.col("_set")
    counted = {name: F.coalesce(F.element_at(F.create_map(*[x for g in sets for x in (F.lit(g).cast("long"), F.col(f"_part{i}_{g}"))]),
                                             gid.cast("long")), F.lit(0).cast("long"))
               for i, (name, (kind, _)) in enumerate(measures.items()) if kind == "distinct"}
    return found.select(*by, *[counted[n].alias(n) if n in counted else n for n in measures])


def _grouping_sets(by: Sequence[str], mode: str) -> dict[int, list[str]]:
    """The columns of each grouping set by its ``grouping_id``: the first column is the highest bit, set if it is left out."""
    bits = [1 << k for k in reversed(range(len(by)))]
    left_out = {"group": [0], "rollup": [(1 << k) - 1 for k in range(len(by) + 1)], "cube": range(1 << len(by))}
    return {gid: [c for c, bit in zip(by, bits, strict=True) if not gid & bit] for gid in left_out[mode]}


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).where("copies > 1")


def rows_by(df: DataFrame, *columns: str) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("rows"))


def unknown_names(requested: DataFrame, known: DataFrame, column: str = "name") -> DataFrame:
    """Requested names that are not known, sorted."""
    asked = requested.select(column).distinct()
    return asked.join(known.select(column).distinct(), column, "left_anti").orderBy(column)
