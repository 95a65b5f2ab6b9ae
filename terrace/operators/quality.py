"""Schema, rule and gate checks over whole tables."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from terrace.functions.audit import AUDIT_SCHEMA
from terrace.functions.rules import Rule, when
from terrace.operators.joins import join_unique
from terrace.operators.tables import quoted
from terrace.workspace import materialise


def schema_report(df: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """``(column, expected, actual, status)``, matched on the lower-cased name.

    Status is ok, missing, extra or type_mismatch.
    """
    spark = df.sparkSession
    found = {f.name.lower(): f.dataType.simpleString() for f in df.schema}
    wanted = {name.lower(): T.DataType.fromDDL(t).simpleString() for name, t in expected.items()}
    have = spark.createDataFrame(list(found.items()), "column string, actual string")
    want = spark.createDataFrame(list(wanted.items()), "column string, expected string")
    status = (F.when(F.col("actual").isNull(), "missing")
              .when(F.col("expected").isNull(), "extra")
              .when(F.col("actual") == F.col("expected"), "ok")
              .otherwise("type_mismatch"))
    return want.join(have, "column", "full").select("column", "expected", "actual", status.alias("status"))


def audit_contract(df: DataFrame) -> DataFrame:
    """The schema report of the five audit columns."""
    expected = {f.name: f.dataType.simpleString() for f in AUDIT_SCHEMA}
    return schema_report(df, expected).where("status <> 'extra'")


def _broken(rule: Rule) -> Column:
    return rule.checked & ~F.coalesce(rule.passed, F.lit(False))


def _compact(df: DataFrame, rule: Rule) -> dict[str, Column]:
    """The key of a unique rule as narrow columns.

    Text of 32 bytes and more stands as its 32-byte SHA-256 digest, so counting whole
    documents shuffles little; text kept as it is is shorter than any digest.
    """
    key = {}
    for i, c in enumerate(rule.unique_key):
        column = F.col(c)
        if df.select(c).schema[0].dataType.typeName() == "string":
            column = F.when(F.octet_length(column) < 32, column.cast("binary")).otherwise(
                F.unhex(F.sha2(column, 256)))
        key[f"_key{i}"] = column
    return key


def _key_counts(df: DataFrame, rule: Rule) -> DataFrame:
    key = [c.alias(n) for n, c in _compact(df, rule).items()]
    return df.where(rule.checked).groupBy(*key).agg(F.count("*").alias("copies"))


def rule_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(rule, checked, failed)``: one aggregation for all row rules, one per unique rule."""
    plain = [r for r in rules if not r.unique_key]
    parts = []
    if plain:
        sums = []
        for i, r in enumerate(plain):
            sums += [F.count_if(r.checked).alias(f"c{i}"), F.count_if(_broken(r)).alias(f"f{i}")]
        rows = [F.struct(F.lit(r.name).alias("rule"), F.col(f"c{i}").alias("checked"),
                         F.col(f"f{i}").alias("failed")) for i, r in enumerate(plain)]
        parts.append(df.agg(*sums).select(F.inline(F.array(*rows))))
    for r in rules:
        if r.unique_key:
            copies = F.col("copies")
            parts.append(_key_counts(df, r).agg(
                F.lit(r.name).alias("rule"),
                F.coalesce(F.sum(copies), F.lit(0)).alias("checked"),
                F.coalesce(F.sum(F.when(copies > 1, copies)), F.lit(0)).alias("failed")))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def _verdicts(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, Column, Column]:
    """The frame with what the rules need, whether a row breaks one, and which it breaks."""
    judged, wrong = df, []
    for i, r in enumerate(rules):
        if r.unique_key:
            # The repeated keys are few and narrow beside the rows they are matched with.
            key, mark = _compact(df, r), f"_repeated{i}"
            repeated = materialise(_key_counts(df, r).where("copies > 1").select(
                *key, F.lit(True).alias(mark)), "repeated")
            judged = join_unique(judged.withColumns(key), repeated, list(key),
                                 check_unique=False).drop(*key)
            wrong.append(r.checked & F.coalesce(mark, F.lit(False)))
        else:
            wrong.append(_broken(r))
    names = F.array_compact(F.array(*[F.when(w, F.lit(r.name)) for w, r in zip(wrong, rules)]))
    return judged, reduce(lambda a, b: a | b, wrong, F.lit(False)), names.cast("array<string>")


def split_by_rules(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """Rows that keep every rule, and the others with ``_failed_rules`` in rule order."""
    return gate(df, rules)


class RuleGateError(Exception):
    """Too large a share of the rows broke a rule."""


def gate(df: DataFrame, rules: Sequence[Rule], max_failed_share: float | None = None,
         first: Sequence[Rule] = ()) -> tuple[DataFrame, DataFrame]:
    """``split_by_rules`` that raises when more than the given share would be quarantined.

    Rows that break one of the ``first`` rules, which look at one row each, are not held
    to the others.
    """
    if any(r.unique_key for r in first):
        raise ValueError("a unique rule cannot come first")
    _, unfit, unfit_names = _verdicts(df, first)
    judged, broken, broken_names = _verdicts(
        df, [when(~unfit, r) if first and r.unique_key else r for r in rules])
    wrong = unfit | broken
    names = F.when(unfit, unfit_names).otherwise(broken_names)
    columns = [quoted(c) for c in df.columns]
    # Judged once: both outputs, and the share of failed rows, come from what is stored here.
    judged = materialise(judged.select(*columns, F.when(wrong, names).alias("_failed_rules")), "judged")
    failed = F.col("_failed_rules").isNotNull()
    if max_failed_share is not None:
        total, count = judged.agg(F.count("*"), F.count_if(failed)).first()
        if total and count / total > max_failed_share:
            raise RuleGateError(f"{count} of {total} rows failed, limit {max_failed_share}")
    return judged.where(~failed).select(*columns), judged.where(failed)
