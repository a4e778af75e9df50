"""Rule files: reading, de-duplicating, priority gating and binding to known tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline.functions.segments import Segment
from plumbline.sources.tables import Catalog, TableSpec

# Rule priorities and their ranks.
PRIORITY_RANK = {"LOWPRIORITYCOLUMN": 1, "MEDIUMPRIORITYCOLUMN": 2, "HIGHPRIORITYCOLUMN": 3}
HIGH = "HIGHPRIORITYCOLUMN"
LOW = "lowPriorityColumn"

DEFAULT_MIN_LENGTH = 1


def read_rules(spark: SparkSession, path: str, layout: StructType, sep: str = "^",
               header: bool = True) -> DataFrame:
    """Rules of one file or of every file in a directory, without repeats. Columns go by position."""
    reader = spark.read.schema(layout).option("sep", sep).option("header", header)
    return reader.csv(path).distinct()


def priority_rank(priority: Column) -> Column:
    """1, 2 or 3 for a priority in any letter case; NULL for an unknown one."""
    text = F.upper(priority)
    ranks = list(PRIORITY_RANK.items())
    rank = F.when(text == ranks[0][0], ranks[0][1])
    for name, value in ranks[1:]:
        rank = rank.when(text == name, value)
    return rank


def passes_gate(priority: Column, threshold: str, default: str) -> Column:
    """True for rules at or above the threshold. Unknown priorities never pass."""
    if threshold not in PRIORITY_RANK:
        raise ValueError(f"unknown threshold {threshold!r}; expected one of {list(PRIORITY_RANK)}")
    rank = priority_rank(F.coalesce(priority, F.lit(default)))
    return F.coalesce(rank >= PRIORITY_RANK[threshold], F.lit(False))


@dataclass(frozen=True)
class Rule:
    """One rule bound to its table and segment. ``target`` holds the check's own fields."""

    number: int
    environment: str
    database: str
    table: TableSpec
    business_line: str
    view_mode: str | None
    view_type: str | None
    segment: Segment
    target: dict

    def labels(self) -> dict:
        """The columns every result row starts with, under the canonical table name."""
        return {
            "environment": self.environment,
            "databaseName": self.database,
            "tableName": self.table.name,
            "viewMode": self.view_mode,
            "businessLine": self.business_line,
            "viewType": self.view_type,
        }

    def statement(self, columns: str, extra: str = "") -> tuple[str, str]:
        """The measured query as text, split where the day goes."""
        head = (
            f"SELECT {columns} FROM {self.database.strip()}.{self.table.name.lower()} "
            f"WHERE {self.table.partition_column} = "
        )
        return head, f" AND {self.segment.text()}{extra}"


_COMMON = ("environment", "database", "tableType", "businessLine", "viewMode", "viewType")


def bind(rules: DataFrame, catalog: Catalog) -> list[Rule]:
    """Rules as plan inputs, without repeats, numbered in a stable order.

    A rule file is job configuration: its column names and segments become the
    expressions of the plan, so its lines (not table rows) come to the driver.
    Every error in them is raised here, before any job reads a table.
    """
    lines = [row.asDict() for row in dict.fromkeys(rules.collect())]
    lines.sort(key=lambda line: [(v is not None, str(v)) for v in line.values()])
    bound = []
    for line in lines:
        missing = [k for k in ("environment", "database", "tableType", "businessLine") if not line[k]]
        if missing:
            raise ValueError(f"rule without {', '.join(missing)}: {line}")
        table = catalog.find(line["tableType"].strip())
        mode, kind = line["viewMode"], line["viewType"]
        bound.append(Rule(
            number=len(bound),
            environment=line["environment"],
            database=line["database"],
            table=table,
            business_line=line["businessLine"],
            view_mode=mode,
            view_type=kind,
            segment=table.segment(line["businessLine"], mode, kind),
            target={k: v for k, v in line.items() if k not in _COMMON},
        ))
    return bound


def require_columns(rows: DataFrame, names, table: str) -> None:
    """Refuse names that are not plain columns of the table."""
    known = {c.lower() for c in rows.columns}
    unknown = sorted({n for n in names if n.lower() not in known})
    if unknown:
        raise ValueError(f"{table} has no column {', '.join(unknown)}")
