"""Partition trees: which locations exist at a given depth, and which files lie under them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.sources.listing import level

# Path texts that mark entries no check should look at.
SKIPPED_MARKS = ("HIVE_DEFAULT_PARTITION", "_SUCCESS")

_GLOB_SPECIALS = "\\*?[]{}"


def escaped(path: str) -> str:
    """A path pattern for just this path."""
    return "".join("\\" + c if c in _GLOB_SPECIALS else c for c in path)


def first_level_pattern(root: str, name_filter: str) -> str:
    """A path pattern for the first-level directories a filter can match.

    A filter that the root itself holds, or that spans a slash, narrows nothing.
    """
    root = root.rstrip("/")
    if not name_filter or "/" in name_filter or name_filter in root:
        return root
    return f"{root}/*{escaped(name_filter)}*"


def locations(spark: SparkSession, root: str, depth: int, name_filter: str = "",
              skipped_marks: Sequence[str] = SKIPPED_MARKS) -> DataFrame:
    """Directories and files ``depth`` levels under ``root`` as (location, path, is_file).

    ``location`` is the path with a ``/`` at its end. Levels are listed one after another by the tasks of a job: only
    directories that lead to a location are looked into, and nothing below a location. ``name_filter`` must occur in
    the path of the first level, base and closing slash included. Locations with a mark anywhere in their path are
    skipped. A depth below 1 is an error; an entry that ends above the depth is no location.
    """
    if depth < 1:
        raise ValueError(f"a location lies at least one level down, not {depth}")

    def keep(entries: DataFrame, number: int) -> DataFrame:
        if number == 1 and name_filter:
            entries = entries.where(F.contains(F.concat("path", F.lit("/")), F.lit(name_filter)))
        for mark in skipped_marks:
            entries = entries.where(~F.contains("path", F.lit(mark)))
        return entries

    found = level(spark, root, depth, keep)
    return found.select(F.concat("path", F.lit("/")).alias("location"), "path", "is_file")
