"""``spark-submit``/``python -m terrace``: one ingest run of a YAML registry.

Exit code 0 when every enabled source loaded, 1 when one failed.
"""

import argparse
import sys

from pyspark.sql import SparkSession

from terrace.plans.ingest import ingest_all
from terrace.sources.readers import supported_types
from terrace.sources.registry import check_registry, load_registry


def main(argv=None) -> int:
    parser = argparse.ArgumentParser(prog="terrace", description="Load raw sources into Bronze.")
    parser.add_argument("--registry", required=True, help="YAML registry file")
    parser.add_argument("--catalog", help="catalog of the target tables")
    parser.add_argument("--batch-id", help="run identifier; a new UUID if left out")
    parser.add_argument("--only", nargs="*", default=[], help="names of the sources to load")
    parser.add_argument("--fail-fast", action="store_true", help="stop at the first failure")
    parser.add_argument("--concurrency", type=int, default=1, help="sources loaded at a time")
    args = parser.parse_args(argv)

    specs = load_registry(args.registry)
    spark = SparkSession.builder.appName("terrace ingest").getOrCreate()
    check_registry(spark, specs, supported_types())
    runs = ingest_all(spark, specs, args.only, args.batch_id, args.fail_fast, args.catalog,
                      audit_table=("ops", "ingest_runs"), concurrency=args.concurrency)
    runs.select("source", "status", "rows", "duration_ms", "error").show(truncate=False)
    return 0 if runs.where("status = 'failed'").isEmpty() else 1


if __name__ == "__main__":
    sys.exit(main())
