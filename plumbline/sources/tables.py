"""Checked tables: names, aliases, partition columns, and where their rows come from."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.segments import (
    Segment,
    line_segment,
    status_segment,
    viewing_segment,
    whole_table,
)

SegmentBuilder = Callable[[str, "str | None", "str | None"], Segment]

# (database, canonical table name) -> rows of that table
Source = Callable[[str, str], DataFrame]


@dataclass(frozen=True)
class TableSpec:
    """A table the rules may name. ``segment`` turns (line, mode, type) into a slice."""

    name: str
    partition_column: str
    segment: SegmentBuilder = whole_table
    aliases: tuple[str, ...] = ()


class Catalog:
    """Tables by name or alias, in any letter case."""

    def __init__(self, specs: Iterable[TableSpec]):
        self.specs = tuple(specs)
        self._by_name = {
            name.upper(): spec for spec in self.specs for name in (spec.name, *spec.aliases)
        }

    def find(self, name: str) -> TableSpec:
        try:
            return self._by_name[name.upper()]
        except KeyError:
            known = ", ".join(s.name for s in self.specs)
            raise ValueError(f"unknown table {name!r}; expected one of {known}") from None

    def _lookup(self, name: Column, attribute: str) -> Column:
        pairs = [F.lit(x) for k, s in self._by_name.items() for x in (k, getattr(s, attribute))]
        return F.try_element_at(F.create_map(*pairs), F.upper(name))

    def canonical_name(self, name: Column) -> Column:
        """Canonical table of a name or alias; NULL for an unknown one."""
        return self._lookup(name, "name")

    def partition_column(self, name: Column) -> Column:
        """Partition column of a table name or alias; NULL for an unknown one."""
        return self._lookup(name, "partition_column")


# The known tables with their partition columns and aliases.
KNOWN_TABLES = Catalog([
    TableSpec("EV_VIEWING_HISTORY", "program_watch_start_dt_local", viewing_segment, ("VIEWERSHIP",)),
    TableSpec("EV_ACCOUNT", "data_dt", status_segment, ("ACCOUNT",)),
    TableSpec("EV_CHANNEL", "data_dt", status_segment, ("CHANNEL",)),
    TableSpec("EV_CHANNEL_PROGRAM_SCHEDULE", "data_dt", line_segment),
    TableSpec("EV_CHANNEL_PACKAGE_MARKET_CHANNEL", "data_dt", line_segment),
    TableSpec("EV_CHANNEL_PACKAGE_MARKET", "data_dt", line_segment),
    TableSpec("EV_ACCOUNT_PACKAGE_MARKET", "data_dt", line_segment),
])


def metastore(spark: SparkSession) -> Source:
    """Rows from the session catalog's ``database.table``."""
    return lambda database, table: spark.table(f"{database.strip()}.{table.strip().lower()}")


def frames(by_table: Mapping[str, DataFrame]) -> Source:
    """Rows from given DataFrames, by canonical table name, for any database."""
    found = {k.upper(): v for k, v in by_table.items()}
    return lambda database, table: found[table.upper()]


def read_rows(spark: SparkSession, where: str, base_path: str | None = None) -> DataFrame:
    """Rows of a Parquet path (anything with a slash) or of a catalog table or view."""
    if "/" not in where:
        return spark.table(where)
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    return reader.parquet(where)


def register_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read a Parquet path and make it a temporary view for SQL."""
    rows = spark.read.parquet(path)
    rows.createOrReplaceTempView(name)
    return rows
