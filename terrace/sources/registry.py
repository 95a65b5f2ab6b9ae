"""The source registry: which sources exist and which of them to run."""

from collections.abc import Iterable, Sequence

import yaml
from pyspark.sql import DataFrame, SparkSession, functions as F

from terrace.functions import rules as R
from terrace.operators.quality import rule_report
from terrace.sources.files import FILE_DEFAULTS
from terrace.sources.spec import SourceSpec, spec_from

REGISTRY_SCHEMA = ("name string, type string, target struct<namespace:string, table:string>, "
                   "options map<string,string>, partition_by array<string>, enabled boolean, "
                   "description string, owner string, tags array<string>")

# Name patterns and the options each source type needs.
NAME_PATTERN = "^[a-z][a-z0-9_]{2,63}$"
NAMESPACE_PATTERN = "^[a-z][a-z0-9_]{1,63}$"
TABLE_PATTERN = "^[a-z][a-z0-9_]{1,127}$"
NEEDED_OPTIONS = {
    "file": ("path", "format"),
    "jdbc": ("url", "driver", "user_env", "password_env"),
}


def registry_rules(types: Sequence[str] = tuple(NEEDED_OPTIONS)) -> list[R.Rule]:
    """The registry contract as rules over ``registry_frame`` rows."""
    def option(key):
        return F.col("options").getItem(key)

    contract = [
        R.required("name"), R.matches("name", NAME_PATTERN), R.unique("name"),
        R.required("type"), R.one_of("type", types),
        R.required("target.namespace"), R.matches("target.namespace", NAMESPACE_PATTERN),
        R.required("target.table"), R.matches("target.table", TABLE_PATTERN),
        R.unique_items("tags"), R.unique_items("partition_by"), R.required("options"),
    ]
    for kind, needed in NEEDED_OPTIONS.items():
        for key in needed:
            present = F.coalesce(F.length(option(key)) >= 1, F.lit(False))
            contract.append(R.when(F.col("type") == kind, R.Rule(
                f"options.{key}:required", F.lit(True), present)))
    contract.append(R.when(F.col("type") == "file", R.Rule(
        "options.format:enum", option("format").isNotNull(),
        option("format").isin(list(FILE_DEFAULTS)))))
    for key in ("num_partitions", "fetch_size"):
        contract.append(R.when(F.col("type") == "jdbc", R.Rule(
            f"options.{key}:minimum", option(key).isNotNull(),
            F.coalesce(option(key).try_cast("int") >= 1, F.lit(False)))))
    given = [F.coalesce(option(k) != "", F.lit(False)).cast("int") for k in ("dbtable", "query")]
    contract.append(R.when(F.col("type") == "jdbc", R.Rule(
        "options.dbtable|query:one_of", F.lit(True), given[0] + given[1] == 1)))
    return contract


def shared_targets(registry: DataFrame) -> DataFrame:
    """Tables that more than one source feeds: allowed, but worth a warning."""
    return (registry.groupBy(F.col("target.namespace").alias("namespace"),
                             F.col("target.table").alias("table"))
            .agg(F.count("*").alias("sources")).where("sources > 1"))


def select_enabled(registry: DataFrame, only: DataFrame | None = None) -> DataFrame:
    """Enabled registry rows, optionally only the listed names."""
    chosen = registry.where("enabled")
    return chosen if only is None else chosen.join(only.select("name").distinct(), "name", "left_semi")


def registry_frame(spark: SparkSession, specs: Iterable[SourceSpec]) -> DataFrame:
    rows = [(s.name, s.type, (s.namespace, s.table or s.name),
             {k: str(v) for k, v in s.options.items() if v is not None}, list(s.partition_by),
             s.enabled, s.description, s.owner, list(s.tags)) for s in specs]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)


def load_registry(path: str) -> list[SourceSpec]:
    """Specifications from a YAML registry file, in file order."""
    with open(path, encoding="utf-8") as text:
        document = yaml.safe_load(text) or {}
    if document.get("version") != 1 or set(document) - {"version", "defaults", "sources"}:
        raise ValueError(f"{path}: expected version 1 with sources")
    if not document.get("sources"):
        raise ValueError(f"{path}: no sources")
    return [spec_from(entry) for entry in document["sources"]]


def check_registry(spark: SparkSession, specs: Sequence[SourceSpec],
                   types: Sequence[str] = tuple(NEEDED_OPTIONS)) -> None:
    """Raise when the registry breaks its contract, naming the broken rules."""
    report = rule_report(registry_frame(spark, specs), registry_rules(types))
    broken = [f"{r['rule']} ({r['failed']})" for r in report.where("failed > 0").collect()]
    if broken:
        raise ValueError(f"registry breaks rule(s): {broken}")


def choose(specs: Sequence[SourceSpec], only: Sequence[str] = ()) -> list[SourceSpec]:
    """Enabled sources in registry order; an unknown name is an error, empty means all."""
    unknown = sorted(set(only) - {s.name for s in specs})
    if unknown:
        raise ValueError(f"unknown source(s): {unknown}")
    return [s for s in specs if s.enabled and (not only or s.name in only)]
