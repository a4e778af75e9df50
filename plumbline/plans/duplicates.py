"""Duplicate check: keys that occur in more than one row of a day."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.functions.dates import run_range
from plumbline.functions.metrics import Run
from plumbline.operators.measures import DAY, duplicate_counts
from plumbline.plans.common import CheckResult, by_table, finish, rule_rows, span
from plumbline.sources.rules import bind
from plumbline.sources.tables import KNOWN_TABLES, Catalog, Source, metastore

SCENARIO = "DuplicateCheck"


def split_keys(listed: str) -> tuple[str, ...]:
    """A comma list of key columns as names."""
    return tuple(k.strip() for k in listed.split(",") if k.strip())


def duplicate_check(spark: SparkSession, rules: DataFrame, start, end, *,
                    source: Source | None = None, catalog: Catalog = KNOWN_TABLES,
                    run: Run | None = None, max_days: int | None = None) -> CheckResult:
    """Number of duplicated keys per rule and day; days without duplicates give no row.

    Rules with the same key list share one aggregation of the table, whatever
    their segments and having columns.
    """
    run = run or Run()
    first, last = run_range(start, end, max_days)
    bound = bind(rules, catalog)
    tables = by_table(
        bound, source or metastore(spark),
        lambda r: [r.target["havingColumn"], *split_keys(r.target["duplicateCheckColumns"])],
    )
    measured, statements, fields = [], {}, {}
    shared = 0
    for table in tables:
        by_keys: dict[tuple[str, ...], list] = {}
        for rule in table.rules:
            keys = split_keys(rule.target["duplicateCheckColumns"].lower())
            by_keys.setdefault(keys, []).append(rule)
        for keys, members in by_keys.items():
            segments = list(dict.fromkeys(r.segment for r in members))
            having = list(dict.fromkeys(r.target["havingColumn"].lower() for r in members))
            counts = duplicate_counts(
                table.within(span(first, last)), table.day, segments, keys, having
            )
            measured.append(counts.withColumn("source", F.lit(shared)))
            for rule in members:
                listed, column = rule.target["duplicateCheckColumns"], rule.target["havingColumn"]
                statements[rule.number] = rule.statement(
                    listed, f" GROUP BY {listed} HAVING count({column}) > 1"
                )
                fields[rule.number] = {
                    "selectColumns": listed,
                    "duplicateCheckColumn": column,
                    "source": shared,
                    "segment": segments.index(rule.segment),
                    "having": having.index(column.lower()),
                }
            shared += 1
    ruled = rule_rows(
        spark, bound, statements, fields,
        "selectColumns string, duplicateCheckColumn string, source int, segment int, having int",
    )
    if measured:
        counts = reduce(DataFrame.unionByName, measured).where("n > 0")
        frame = ruled.join(counts, ["source", "segment", "having"])
    else:
        frame = ruled.withColumns({DAY: F.lit(0), "n": F.lit(0).cast("long")}).where(F.lit(False))
    frame = frame.withColumnRenamed("n", "duplicateCount")
    return CheckResult(finish(frame, run, first, last, SCENARIO), schemas.DUPLICATE_CHECK, SCENARIO)
