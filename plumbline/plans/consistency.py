"""Consistency: a day's distinct values or rows against a baseline of earlier days."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.functions.dates import column_windows, day_of, day_runs, day_sequence, run_range, total_windows
from plumbline.functions.metrics import Run, drift_category, percent_difference
from plumbline.operators.history import (
    ANCHORS,
    FROM_DAY,
    FROM_RUN,
    LATEST_ROW,
    MATCH_KEYS,
    PER_DAY,
    daily_baseline,
    logged_counts,
    normalised,
    run_baseline,
)
from plumbline.operators.measures import DAY, distinct_counts, row_counts
from plumbline.plans.common import CheckResult, by_table, finish, rule_rows, scaffold, span
from plumbline.session import materialise
from plumbline.sources.rules import HIGH, LOW, bind, passes_gate
from plumbline.sources.tables import KNOWN_TABLES, Catalog, Source, metastore

COLUMN_SCENARIO = "ColumnConsistencyCheck"
TOTAL_SCENARIO = "TotalConsistencyCheck"

# Separate ranges of unlogged days that a scan is asked for.
MOST_RUNS = 32


def column_consistency(spark: SparkSession, rules: DataFrame, start, end, *,
                       history: DataFrame | None = None, baseline: str = PER_DAY,
                       anchor: str = FROM_RUN, fill_gaps: bool = False,
                       source: Source | None = None, catalog: Catalog = KNOWN_TABLES,
                       threshold: str = HIGH, run: Run | None = None,
                       max_days: int | None = None) -> CheckResult:
    """Distinct values per rule and day against their average over the 30 days before the run.

    ``history`` is the table of earlier results of this check; without it the
    baseline is measured from the source itself, where a day without rows counts 0. With ``anchor="day"`` every day
    looks back from itself, as if it had been a run of its own. With ``fill_gaps`` the days that a rule has not
    logged are measured from the source, and only the days that some rule has not logged are read. A rule without a
    priority counts as low.
    """
    run = run or Run()
    first, last = run_range(start, end, max_days)
    gated = rules.where(passes_gate(F.col("priority"), threshold, LOW)).drop(
        "priority", "columnLength"
    )
    bound = bind(gated, catalog)
    field = "dataQualityColumn"
    tables = by_table(bound, source or metastore(spark), lambda r: [r.target[field]])
    windows = column_windows(F.lit(first), F.lit(last) if anchor == FROM_DAY else None)

    counted, measures, statements, fields = [], [], {}, {}
    for number, table in enumerate(tables):
        wanted: dict[str, set[int]] = {}
        for rule in table.rules:
            wanted.setdefault(rule.target[field].lower(), set()).add(table.segment_of(rule))
        pairs = [(column, sorted(ids)) for column, ids in wanted.items()]
        columns = list(wanted)

        def measure(rows, table=table, pairs=pairs, number=number):
            found = distinct_counts(rows, table.day, table.segments, pairs)
            return found.withColumn("source", F.lit(number))

        counted.append(measure(table.within(span(first, last))))
        measures.append((table, measure))
        for rule in table.rules:
            column = rule.target[field]
            head, tail = rule.statement(f"DISTINCT {column}")
            statements[rule.number] = (head, tail)
            fields[rule.number] = {
                "columnConsistencyField": column,
                "source": number,
                "segment": table.segment_of(rule),
                "column": columns.index(column.lower()),
            }
    ruled = rule_rows(
        spark, bound, statements, fields,
        "columnConsistencyField string, source int, segment int, column int",
    )
    keys = ["source", "segment", "column"]
    counts = _earlier(
        ruled, measures, keys, history, [*MATCH_KEYS, "columnConsistencyField"], windows, baseline, catalog, fill_gaps)
    frame = _with_baseline(
        scaffold(ruled, first, last), counted, keys, counts, anchor, baseline, False,
        "columnConsistencyPercentDiff",
    )
    return CheckResult(finish(frame, run, first, last, COLUMN_SCENARIO), schemas.COLUMN_CONSISTENCY, COLUMN_SCENARIO)


def total_consistency(spark: SparkSession, rules: DataFrame, start, end, *,
                      history: DataFrame | None = None, baseline: str = PER_DAY,
                      anchor: str = FROM_RUN, fill_gaps: bool = False,
                      source: Source | None = None, catalog: Catalog = KNOWN_TABLES,
                      run: Run | None = None, max_days: int | None = None) -> CheckResult:
    """Rows per rule and day against the average of the 30 days before the run and of
    the same month one year earlier.

    ``history`` is the table of earlier results of this check; without it the
    baseline is measured from the source itself, where a day without rows counts 0. With ``anchor="day"`` every day
    looks back from itself, as if it had been a run of its own. With ``fill_gaps`` the days that a rule has not
    logged are measured from the source, and only the days that some rule has not logged are read.
    """
    run = run or Run()
    first, last = run_range(start, end, max_days)
    bound = bind(rules, catalog)
    tables = by_table(bound, source or metastore(spark), lambda r: [])
    windows = total_windows(F.lit(first), F.lit(last) if anchor == FROM_DAY else None)

    counted, measures, statements, fields = [], [], {}, {}
    for number, table in enumerate(tables):
        def measure(rows, table=table, number=number):
            return row_counts(rows, table.day, table.segments).withColumn("source", F.lit(number))

        counted.append(measure(table.within(span(first, last))))
        measures.append((table, measure))
        for rule in table.rules:
            statements[rule.number] = rule.statement(rule.table.partition_column)
            fields[rule.number] = {"source": number, "segment": table.segment_of(rule)}
    ruled = rule_rows(spark, bound, statements, fields, "source int, segment int")
    keys = ["source", "segment"]
    counts = _earlier(ruled, measures, keys, history, list(MATCH_KEYS), windows, baseline, catalog, fill_gaps)
    frame = _with_baseline(
        scaffold(ruled, first, last), counted, keys, counts, anchor, baseline, True,
        "totalConsistencyPercentDiff",
    )
    return CheckResult(finish(frame, run, first, last, TOTAL_SCENARIO), schemas.TOTAL_CONSISTENCY, TOTAL_SCENARIO)


def _earlier(ruled: DataFrame, measures: list[tuple], keys: list[str], history: DataFrame | None, match: list[str],
             windows: list[tuple[Column, Column]], baseline: str, catalog: Catalog, fill_gaps: bool) -> DataFrame | None:
    """Counts of the windows' days as (rule, partitionDate, n): logged, measured, or both."""
    if fill_gaps and baseline != PER_DAY:
        raise ValueError("gaps are filled day by day; a single latest row leaves none")

    def measured(windows) -> list[DataFrame]:
        return [measure(table.within(*windows)) for table, measure in measures]

    if history is None:
        return _every_day(_of_rules(ruled, measured(windows), keys), ruled, windows)
    counts = _of_rules(ruled, [logged_counts(normalised(history, catalog), windows, match, baseline)], match)
    if not fill_gaps:
        return counts
    unlogged = materialise(_days_of(ruled, windows).join(counts, ["rule", DAY], "left_anti"), "unlogged")
    # A number per day of the windows at most.
    days = [row[DAY] for row in unlogged.select(DAY).distinct().orderBy(DAY).collect()]
    if not days:
        return counts
    runs = day_runs(days)
    if len(runs) > MOST_RUNS:  # a longer condition costs more than the days between, whose counts are left out below
        runs = [(runs[0][0], runs[-1][1])]
    found = _of_rules(ruled, measured([span(a, b) for a, b in runs]), keys)
    if found is None:
        return counts
    return counts.unionByName(unlogged.join(found, ["rule", DAY], "left").fillna(0, ["n"]).select(counts.columns))


def _of_rules(ruled: DataFrame, earlier: list[DataFrame], keys: list[str]) -> DataFrame | None:
    """Earlier counts as (rule, partitionDate, n). A missing view mode or type is a key like any other."""
    if not earlier:
        return None
    counts = reduce(DataFrame.unionByName, earlier)
    rules = ruled.select("rule", *[F.col(k).alias(f"_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return counts.join(rules, same).select("rule", DAY, "n")


def _every_day(counts: DataFrame | None, ruled: DataFrame, windows) -> DataFrame | None:
    """Measured counts with 0 for the days of the windows that hold no rows.

    A stored run logs such days as well, so that a baseline measured from the
    source is the one its log would have given.
    """
    if counts is None:
        return None
    return _days_of(ruled, windows).join(counts, ["rule", DAY], "left").fillna(0, ["n"])


def _days_of(ruled: DataFrame, windows) -> DataFrame:
    """Every rule on every day of the windows, as (rule, partitionDate)."""
    days = F.array_distinct(F.flatten(F.array(*[day_sequence(a, b) for a, b in windows])))
    return ruled.select("rule", F.explode(F.transform(days, day_of)).alias(DAY))


def _with_baseline(frame: DataFrame, counted: list[DataFrame], keys: list[str],
                   earlier: DataFrame | None, anchor: str, mode: str, year_ago: bool,
                   difference: str) -> DataFrame:
    """Scaffold rows with their day count, baseline, difference and category.

    Run days and earlier days are separate scans; with the run as anchor, of
    disjoint partitions.
    """
    if anchor not in ANCHORS:
        raise ValueError(f"unknown anchor {anchor!r}; expected one of {ANCHORS}")
    if anchor == FROM_DAY and mode == LATEST_ROW:
        raise ValueError("a single latest row cannot serve every day of a run")
    if counted:
        frame = frame.join(reduce(DataFrame.unionByName, counted), [*keys, DAY], "left")
    else:
        frame = frame.withColumn("n", F.lit(None).cast("long"))
    if earlier is None:
        frame = frame.withColumn("baseline", F.lit(None).cast("double"))
    elif anchor == FROM_RUN:
        frame = frame.join(run_baseline(earlier), "rule", "left")
    else:
        frame = frame.join(daily_baseline(earlier, frame, year_ago), ["rule", DAY], "left")
    count = F.coalesce("n", F.lit(0).cast("long"))
    average = F.coalesce("baseline", F.lit(0.0))
    percent = percent_difference(count, average)
    return frame.withColumns({
        "dayCount": count,
        "averageRecordCount": average,
        difference: percent,
        "category": drift_category(percent),
    })
