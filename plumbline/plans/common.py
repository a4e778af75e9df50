"""What all rule checks share: grouping rules, the rule x day scaffold, and results."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline import schemas
from plumbline.functions.dates import day_of, day_sequence, partition_day, partition_in
from plumbline.functions.metrics import Run
from plumbline.functions.segments import Segment
from plumbline.operators.measures import DAY
from plumbline.session import local_frame
from plumbline.sources.rules import Rule, require_columns
from plumbline.sources.tables import Source

# The checks that write to one query log; a check's place is part of its query ids.
SCENARIOS = ("ColumnQuality", "ColumnConsistencyCheck", "TotalConsistencyCheck", "DuplicateCheck")

_LABELS = (
    "environment string, databaseName string, tableName string, "
    "viewMode string, businessLine string, viewType string"
)


@dataclass(frozen=True)
class CheckResult:
    """A check's rows before they are stored.

    ``frame`` holds the result columns plus the text of each measured query.
    """

    frame: DataFrame
    schema: StructType
    scenario: str

    @property
    def metrics(self) -> DataFrame:
        """Rows for the check's result table."""
        return self.frame.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        )

    @property
    def query_log(self) -> DataFrame:
        """One row per result row with the query that was measured."""
        log_date = next(f.name for f in self.schema.fields if f.name.lower() == "logdate")
        return self.frame.select(
            "queryid",
            "query",
            F.lit(self.scenario).alias("scenario"),
            F.col(DAY).alias("executionDate"),
            F.col(log_date).alias("logDate"),
        ).to(schemas.QUERY_LOG)


@dataclass(frozen=True)
class TableRules:
    """Rules of one source table, with the distinct segments they ask for."""

    rows: DataFrame
    rules: list[Rule]
    segments: list[Segment]

    @property
    def partition(self):
        name = self.rules[0].table.partition_column
        field = next(f for f in self.rows.schema.fields if f.name.lower() == name.lower())
        return field.name, field.dataType

    @property
    def day(self) -> Column:
        return partition_day(*self.partition)

    def within(self, *windows: tuple[Column, Column]) -> DataFrame:
        return self.rows.where(partition_in(*self.partition, windows))

    def segment_of(self, rule: Rule) -> int:
        return self.segments.index(rule.segment)


def by_table(rules: list[Rule], source: Source,
             columns_of: Callable[[Rule], Iterable[str]]) -> list[TableRules]:
    """Rules grouped by (database, table), their column names checked against the table."""
    groups: dict[tuple[str, str], list[Rule]] = {}
    for rule in rules:
        groups.setdefault((rule.database, rule.table.name), []).append(rule)
    out = []
    for (database, name), members in groups.items():
        rows = source(database, name)
        needed = [members[0].table.partition_column]
        for rule in members:
            needed += [*rule.segment.columns(), *columns_of(rule)]
        require_columns(rows, needed, f"{database}.{name}")
        out.append(TableRules(rows, members, list(dict.fromkeys(r.segment for r in members))))
    return out


def span(first: dt.date, last: dt.date) -> tuple[Column, Column]:
    return F.lit(first), F.lit(last)


def rule_rows(spark: SparkSession, rules: list[Rule], statements: dict[int, tuple[str, str]],
              fields: dict[int, dict], field_ddl: str) -> DataFrame:
    """Rules as a small relation: number, labels, query text parts and the check's own fields."""
    rows = [
        {"rule": r.number, **r.labels(), "_head": statements[r.number][0],
         "_tail": statements[r.number][1], **fields[r.number]}
        for r in rules
    ]
    ddl = f"rule int, {_LABELS}, _head string, _tail string"
    return local_frame(spark, rows, ddl + (f", {field_ddl}" if field_ddl else ""))


def scaffold(rules: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Every rule on every day of the run, whether or not the day holds data."""
    lo, hi = span(first, last)
    return rules.withColumn(DAY, F.explode(F.transform(day_sequence(lo, hi), day_of)))


def finish(frame: DataFrame, run: Run, first: dt.date, last: dt.date, scenario: str) -> DataFrame:
    """Add the query id, the query text and the log date to result rows."""
    day_number = F.datediff(F.to_date(F.col(DAY).cast("string"), "yyyyMMdd"), F.lit(first))
    row_number = F.col("rule").cast("long") * ((last - first).days + 1) + day_number
    return (
        frame.withColumn("queryid", run.query_id(row_number, SCENARIOS.index(scenario)))
        .withColumn("query", F.concat("_head", F.col(DAY).cast("string"), "_tail"))
        .withColumn("logdate", F.lit(run.log_date))
    )
