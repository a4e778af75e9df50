"""Grouped counts, and their comparison between two copies of a dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def grouped_counts(rows: DataFrame, columns: Sequence[str], *, day: str | None = None,
                   like: str | None = None, ordered: bool = False) -> DataFrame:
    """Rows per combination of columns, as ``n``; optionally only days LIKE a pattern."""
    if like is not None:
        if day is None:
            raise ValueError("a pattern needs the day column it applies to")
        rows = rows.where(F.col(day).cast("string").like(like))
    counted = rows.groupBy(*columns).agg(F.count("*").alias("n"))
    return counted.orderBy(*columns) if ordered else counted


def compare_counts(left: DataFrame, right: DataFrame, columns: Sequence[str], *,
                   day: str | None = None, like: str | None = None) -> DataFrame:
    """Grouped counts of two copies side by side, with ``difference = left - right``.

    A group that one side lacks counts 0 there, and NULL group values match each
    other. Each side is counted per group first; the sides then meet in one
    aggregate of those counts.
    """
    sides = []
    for rows, mine, other in ((left, "left_count", "right_count"), (right, "right_count", "left_count")):
        counted = grouped_counts(rows, columns, day=day, like=like)
        sides.append(counted.select(
            *columns, F.col("n").alias(mine), F.lit(0).cast("long").alias(other)
        ))
    met = sides[0].unionByName(sides[1]).groupBy(*columns).agg(
        F.sum("left_count").alias("left_count"), F.sum("right_count").alias("right_count")
    )
    return met.withColumn("difference", F.col("left_count") - F.col("right_count"))
