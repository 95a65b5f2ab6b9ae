"""Partition transforms: native where the catalog has them, derived columns otherwise."""

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_TRANSFORM = re.compile(r"(\w+)\(\s*(?:(\d+)\s*,\s*)?([\w.]+)\s*\)")

_CALENDAR = {
    "years": ("year", lambda c: F.trunc(c, "year")),
    "months": ("month", lambda c: F.trunc(c, "month")),
    "days": ("day", lambda c: F.to_date(c)),
    "hours": ("hour", lambda c: F.date_trunc("hour", c)),
}


def _split(entry: str) -> tuple[str, int | None, str]:
    if "(" not in entry:
        return "identity", None, entry
    found = _TRANSFORM.fullmatch(entry.strip())
    kind = found.group(1) if found else ""
    width = found.group(2) if found else None
    if kind in _CALENDAR and width is None or kind in ("bucket", "hash", "truncate") and width:
        return kind, width and int(width), found.group(3)
    raise ValueError(f"unknown partition transform {entry!r}")


def native_partitions(partition_by: Sequence[str]) -> list[str]:
    """The transforms as a ``PARTITIONED BY`` list, for a catalog with hidden partitioning."""
    clauses = []
    for kind, width, name in map(_split, partition_by):
        name = ".".join(f"`{part}`" for part in name.split("."))
        inner = name if width is None else f"{width}, {name}"
        kind = "bucket" if kind == "hash" else kind
        clauses.append(name if kind == "identity" else f"{kind}({inner})")
    return clauses


def derived_columns(partition_by: Sequence[str]) -> dict[str, Column]:
    """Columns that carry the transformed value in a plain Parquet table."""
    derived = {}
    for kind, width, name in map(_split, partition_by):
        if kind in _CALENDAR:
            suffix, value = _CALENDAR[kind]
            derived[f"{name}_{suffix}"] = value(F.col(name))
        elif kind == "truncate":
            derived[f"{name}_trunc"] = F.substring(name, 1, width)
        elif kind == "hash":
            derived[f"{name}_hash"] = F.pmod(F.xxhash64(name), F.lit(width)).cast("int")
    return derived


def source_columns(partition_by: Sequence[str]) -> dict[str, str]:
    """Which column each derived partition column is computed from."""
    return {derived: _split(entry)[2] for entry in partition_by for derived in derived_columns([entry])}


def plain_partitions(partition_by: Sequence[str]) -> list[Column]:
    """Identity and bucket partitions over the frame with its derived columns added."""
    columns = []
    for entry in partition_by:
        kind, width, name = _split(entry)
        if kind == "bucket":
            columns.append(F.partitioning.bucket(width, name))
        else:
            columns.append(F.col(next(iter(derived_columns([entry])), name)))
    return columns


def spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows of one partition value together before a partitioned write.

    ``rebalance`` lets adaptive execution cut a value that holds much of the data
    into several tasks and join small ones, so neither one huge task nor a small
    file per task and value results.
    """
    return df.hint("rebalance", *columns) if columns else df
