"""The checks as jobs: ``spark-submit run_job.py <job> <arguments>``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from plumbline import schemas, sinks
from plumbline.functions.metrics import Run
from plumbline.operators.counts import compare_counts
from plumbline.operators.history import ANCHORS, BASELINE_MODES, FROM_RUN, PER_DAY
from plumbline.plans import merge
from plumbline.plans import schema_check as sc
from plumbline.plans.consistency import column_consistency, total_consistency
from plumbline.plans.duplicates import duplicate_check
from plumbline.plans.quality import column_quality
from plumbline.session import discard, materialise
from plumbline.sources.rules import HIGH, PRIORITY_RANK, read_rules
from plumbline.sources.tables import read_rows

QUERY_LOG = "dataValidation_QueryDetails"

# Rows of a result that a job prints at most. The whole result is for ``--results``.
SHOWN = 100

# Job -> (check, rule layout, result table).
CHECKS = {
    "quality": (column_quality, schemas.QUALITY_RULES, "ColumnQualityCheck"),
    "column-consistency": (column_consistency, schemas.QUALITY_RULES, "ColumnConsistencyCheck"),
    "total-consistency": (total_consistency, schemas.TOTAL_RULES, "TotalConsistencyCheck"),
    "duplicates": (duplicate_check, schemas.DUPLICATE_RULES, "DuplicateCheck"),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="run_job.py", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)
    for name in CHECKS:
        job = jobs.add_parser(name)
        job.add_argument("rules", help="rule file or directory")
        job.add_argument("start", help="first day, yyyyMMdd")
        job.add_argument("end", help="last day, yyyyMMdd")
        job.add_argument("--results", default="validation_framework", help="database of the result tables")
        job.add_argument("--delimiter", default="^")
        job.add_argument("--no-header", action="store_true")
        job.add_argument("--max-days", type=int, help="refuse longer ranges; any length by default")
        if name in ("quality", "column-consistency"):
            job.add_argument("--threshold", default=HIGH, choices=list(PRIORITY_RANK))
        if name.endswith("consistency"):
            job.add_argument("--baseline", default=PER_DAY, choices=BASELINE_MODES)
            job.add_argument("--anchor", default=FROM_RUN, choices=ANCHORS)
            job.add_argument("--history", default="log", choices=["log", "source", "both"],
                             help="baseline from logged results, measured from the source, or measured where not logged")
    job = jobs.add_parser("schema")
    job.add_argument("filter", help="text in the first-level path")
    job.add_argument("--reference", required=True)
    job.add_argument("--path", required=True)
    job.add_argument("--depth", type=int, required=True)
    job.add_argument("--results", default="validation_framework")
    job = jobs.add_parser("merge")
    job.add_argument("input")
    job.add_argument("output")
    job.add_argument("filter", nargs="?", default="")
    job.add_argument("--partitions", required=True, help="comma list, without the load column")
    job.add_argument("--load-column", default=merge.LOAD_COLUMN)
    job.add_argument("--no-compact", action="store_true")
    job.add_argument("--results", help="Parquet path (with a slash) or table that the rows per leaf are appended to")
    job = jobs.add_parser("compare")
    job.add_argument("left", help="Parquet path or table")
    job.add_argument("right", help="Parquet path or table")
    job.add_argument("--columns", required=True, help="comma list")
    job.add_argument("--day", help="day column of the pattern")
    job.add_argument("--like", help="pattern such as 2018%%")
    job.add_argument("--results", help="Parquet path (with a slash) or table that all groups are appended to")
    job.add_argument("--show", type=int, default=SHOWN, help="groups to print at most, differences first")
    return top


def names(listed: str) -> list[str]:
    return [n.strip() for n in listed.split(",") if n.strip()]


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"plumbline {args.job}").getOrCreate()
    if args.job in CHECKS:
        run_check(spark, args)
    elif args.job == "schema":
        sinks.create_result_tables(spark, args.results)
        reference = sc.reference_schema(spark, args.reference)
        checked = sc.schema_check(spark, reference, args.path, args.depth, args.filter, Run())
        sinks.store_schema_check(checked, f"{args.results}.schema_check")
    elif args.job == "merge":
        partitions = names(args.partitions)
        merge.merge_loads(
            spark, args.input, args.output, partitions, load_column=args.load_column,
            name_filter=args.filter, compact=not args.no_compact,
        )
        leaves = materialise(merge.reconcile_leaves(
            spark, args.input, args.output, partitions, load_column=args.load_column,
            name_filter=args.filter,
        ), "leaves")
        if args.results:
            sinks.append(leaves, args.results)
        short = leaves.where("NOT complete")
        found = short.count()
        if found:
            short.orderBy(*partitions).show(SHOWN, truncate=False)
            raise SystemExit(f"the merge does not hold the rows of {found} leaves (above: the first {min(found, SHOWN)})")
    else:
        compared = compare_counts(
            read_rows(spark, args.left), read_rows(spark, args.right), names(args.columns),
            day=args.day, like=args.like,
        )
        compared = materialise(compared, "compared")
        if args.results:
            sinks.append(compared, args.results)
        found = compared.agg(F.count(F.lit(1)).alias("groups"), F.count_if(F.col("difference") != 0).alias("differing")).head()
        shown = min(args.show, found["groups"])
        print(f"{found['groups']} groups, {found['differing']} of them differ; the first {shown}:")
        compared.orderBy(F.col("difference") == 0, *names(args.columns)).show(shown, truncate=False)
        discard(compared)


def run_check(spark: SparkSession, args: argparse.Namespace) -> None:
    check, layout, table = CHECKS[args.job]
    results = f"{args.results}.{table}"
    sinks.create_result_tables(spark, args.results)
    rules = read_rules(spark, args.rules, layout, args.delimiter, not args.no_header)
    options = {"max_days": args.max_days}
    if args.job in ("quality", "column-consistency"):
        options["threshold"] = args.threshold
    if args.job.endswith("consistency"):
        history = spark.table(results) if args.history != "source" else None
        options |= {"history": history, "fill_gaps": args.history == "both", "baseline": args.baseline, "anchor": args.anchor}
    sinks.store(
        check(spark, rules, args.start, args.end, **options), results, f"{args.results}.{QUERY_LOG}"
    )


if __name__ == "__main__":
    main()
