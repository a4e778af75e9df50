"""Column quality: how many values of a column are missing, too short or placeholders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.functions.dates import run_range
from plumbline.functions.metrics import Run, category, improper_percent, rounded_percent
from plumbline.functions.values import improper_text
from plumbline.operators.measures import DAY, improper_counts
from plumbline.plans.common import CheckResult, by_table, finish, rule_rows, scaffold, span
from plumbline.sources.rules import DEFAULT_MIN_LENGTH, HIGH, bind, passes_gate
from plumbline.sources.tables import KNOWN_TABLES, Catalog, Source, metastore

SCENARIO = "ColumnQuality"


def column_quality(spark: SparkSession, rules: DataFrame, start, end, *,
                   source: Source | None = None, catalog: Catalog = KNOWN_TABLES,
                   threshold: str = HIGH, run: Run | None = None,
                   max_days: int | None = None) -> CheckResult:
    """Check every rule on every day from ``start`` to ``end``.

    Rules under the priority threshold are left out; one without a priority
    counts as high. A row comes out per rule and day even where there is no
    data: its percent is NULL and its category the worst, so that it stands out.
    """
    run = run or Run()
    first, last = run_range(start, end, max_days)
    gated = rules.where(passes_gate(F.col("priority"), threshold, HIGH)).withColumn(
        "columnLength", F.coalesce(F.col("columnLength").cast("int"), F.lit(DEFAULT_MIN_LENGTH))
    ).withColumn("priority", F.coalesce("priority", F.lit(HIGH)))
    bound = bind(gated, catalog)
    tables = by_table(bound, source or metastore(spark), lambda r: [r.target["dataQualityColumn"]])

    measured, statements, fields = [], {}, {}
    for number, table in enumerate(tables):
        counters = list(dict.fromkeys(
            (r.target["dataQualityColumn"].lower(), r.target["columnLength"]) for r in table.rules
        ))
        counts = improper_counts(table.within(span(first, last)), table.day, table.segments, counters)
        measured.append(counts.withColumn("source", F.lit(number)))
        for rule in table.rules:
            column, length = rule.target["dataQualityColumn"], rule.target["columnLength"]
            statements[rule.number] = rule.statement(column, f" AND {improper_text(column, length)}")
            fields[rule.number] = {
                "dataQualityColumn": column,
                "priority": rule.target["priority"],
                "source": number,
                "segment": table.segment_of(rule),
                "counter": counters.index((column.lower(), length)),
            }
    ruled = rule_rows(
        spark, bound, statements, fields,
        "dataQualityColumn string, priority string, source int, segment int, counter int",
    )
    frame = scaffold(ruled, first, last)
    if measured:
        counts = reduce(DataFrame.unionByName, measured)
        frame = frame.join(counts, ["source", "segment", "counter", DAY], "left")
    else:
        frame = frame.withColumns({n: F.lit(None).cast("long") for n in ("improper", "total")})
    bad = F.coalesce("improper", F.lit(0).cast("long"))
    total = F.coalesce("total", F.lit(0).cast("long"))
    frame = frame.withColumns({
        "improperColumnCount": bad,
        "totalColumnCount": total,
        "improperColumnPercent": rounded_percent(bad, total),
        "category": category(improper_percent(bad, total)),
    })
    return CheckResult(finish(frame, run, first, last, SCENARIO), schemas.COLUMN_QUALITY, SCENARIO)
