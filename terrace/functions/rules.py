"""Row rules: each says which rows it looks at and which of those are right.

A NULL fails only ``required``; every other rule skips it.
"""

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Rule:
    name: str
    checked: Column
    passed: Column | None = None
    unique_key: tuple[str, ...] = ()


def _label(column: str, check: str, name: str | None) -> str:
    return name or f"{column}:{check}"


def _on(column: str, check: str, passed: Column, name: str | None) -> Rule:
    return Rule(_label(column, check, name), F.col(column).isNotNull(), passed)


def required(column: str, name: str | None = None) -> Rule:
    return Rule(_label(column, "required", name), F.lit(True), F.col(column).isNotNull())


def matches(column: str, pattern: str, name: str | None = None) -> Rule:
    return _on(column, "pattern", F.col(column).rlike(pattern), name)


def one_of(column: str, values: Sequence, name: str | None = None) -> Rule:
    return _on(column, "enum", F.col(column).isin(list(values)), name)


def constant(column: str, value, name: str | None = None) -> Rule:
    return _on(column, "const", F.col(column) == F.lit(value), name)


def min_length(column: str, length: int, name: str | None = None) -> Rule:
    return _on(column, "min_length", F.length(column) >= length, name)


def at_least(column: str, minimum, name: str | None = None) -> Rule:
    return _on(column, "minimum", F.col(column) >= F.lit(minimum), name)


def min_items(column: str, count: int, name: str | None = None) -> Rule:
    return _on(column, "min_items", F.size(column) >= count, name)


def unique_items(column: str, name: str | None = None) -> Rule:
    """No value occurs twice inside an array."""
    return _on(column, "unique_items",
               F.size(F.array_distinct(column)) == F.size(column), name)


def castable(column: str, *data_types: str, name: str | None = None) -> Rule:
    """The text reads as at least one of the types; blanks count as NULL."""
    text = F.trim(F.col(column).cast("string"))
    reads = F.lit(False)
    for data_type in data_types:
        reads = reads | text.try_cast(data_type).isNotNull()
    return Rule(_label(column, "type", name), F.coalesce(text != "", F.lit(False)), reads)


def exactly_one_of(*columns: str, name: str | None = None) -> Rule:
    """One of the columns is set (not NULL, not empty) and the others are not."""
    filled = sum((F.coalesce(F.col(c).cast("string") != "", F.lit(False)).cast("int")
                  for c in columns), F.lit(0))
    return Rule(name or f"{'|'.join(columns)}:one_of", F.lit(True), filled == 1)


def only_keys(column: str, allowed: Sequence[str], name: str | None = None) -> Rule:
    """A map column holds no key outside the allowed set."""
    extra = F.array_except(F.map_keys(column), F.array(*[F.lit(k) for k in allowed]))
    return _on(column, "closed", F.size(extra) == 0, name)


def unique(*columns: str, name: str | None = None) -> Rule:
    """No two rows share the key. Every row of a repeated key fails; NULL keys are skipped."""
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return Rule(name or f"{','.join(columns)}:unique", present, unique_key=tuple(columns))


def when(condition: Column, rule: Rule) -> Rule:
    """Apply a rule only where the condition holds; ``unique`` then compares only such rows."""
    return replace(rule, checked=F.coalesce(condition, F.lit(False)) & rule.checked)
