"""Baselines from logged results of earlier runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.functions.dates import TRAILING_DAYS, date_of, partition_in
from plumbline.operators.measures import DAY
from plumbline.sources.tables import Catalog

PER_DAY = "per_day"
LATEST_ROW = "latest_row"
BASELINE_MODES = (PER_DAY, LATEST_ROW)

# A baseline looks back from the run's first day, or from each of its days.
FROM_RUN = "run"
FROM_DAY = "day"
ANCHORS = (FROM_RUN, FROM_DAY)

# Fixed value: how other writers log a missing view mode or type.
MISSING = "null"

# What a logged row must share with a rule, besides the check's own field.
MATCH_KEYS = ("environment", "tableName", "viewMode", "businessLine", "viewType")


def latest_row(rows: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """The newest row per key, by the given columns in turn.

    Same rows as numbering each key's rows by those columns in descending order
    and keeping the first, but as an aggregate: it combines before the shuffle,
    so no key's whole history gathers in one sorted group.
    """
    others = [c for c in rows.columns if c not in keys]
    newest = F.max_by(F.struct(*others), F.struct(*newest_first)).alias("_newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "_newest.*").select(*rows.columns)


def normalised(history: DataFrame, catalog: Catalog) -> DataFrame:
    """Logged rows under canonical table names, with missing modes and types as NULL.

    Logs of other writers hold the table name as a rule spelled it, and the
    text ``null`` for a missing mode or type.
    """
    return history.withColumns({
        "tableName": F.coalesce(catalog.canonical_name(F.col("tableName")), F.col("tableName")),
        "viewMode": F.nullif(F.col("viewMode"), F.lit(MISSING)),
        "viewType": F.nullif(F.col("viewType"), F.lit(MISSING)),
    })


def logged_counts(history: DataFrame, windows: Sequence[tuple[Column, Column]],
                  keys: Sequence[str], mode: str = PER_DAY) -> DataFrame:
    """Logged day counts inside the windows as (keys, partitionDate, n).

    ``per_day`` keeps the latest run of every day; ``latest_row`` keeps a single
    latest row per key. The database is part of what makes a row "the latest",
    not of what is matched.
    """
    if mode not in BASELINE_MODES:
        raise ValueError(f"unknown baseline mode {mode!r}; expected one of {BASELINE_MODES}")
    inside = history.where(partition_in(DAY, history.schema[DAY].dataType, windows))
    log_date = next(c for c in history.columns if c.lower() == "logdate")
    row_keys = [*keys, "databaseName"]
    if mode == PER_DAY:
        row_keys.append(DAY)
    inside = inside.select(*keys, "databaseName", DAY, log_date, "queryid", "dayCount")
    latest = latest_row(inside, row_keys, [log_date, "queryid"])
    return latest.select(*keys, DAY, F.col("dayCount").alias("n"))


def run_baseline(counts: DataFrame) -> DataFrame:
    """One baseline per rule: the average of the days it has counts of."""
    return counts.groupBy("rule").agg(F.avg("n").alias("baseline"))


def daily_baseline(counts: DataFrame, wanted: DataFrame, year_ago: bool) -> DataFrame:
    """A baseline per rule and wanted day, as if each day had been a run of its own.

    ``counts`` is (rule, partitionDate, n), ``wanted`` (rule, partitionDate). A
    day looks back on the 30 days before it and, with ``year_ago``, on its month
    one year earlier. Both are range frames over one rule's days.
    """
    asked = wanted.select("rule", DAY, F.lit(None).cast("long").alias("n"), F.lit(True).alias("_asked"))
    both = counts.select("rule", DAY, "n", F.lit(False).alias("_asked")).unionByName(asked)
    date = date_of(F.col(DAY))
    both = both.withColumns({
        "_day": F.unix_date(date), "_month": F.year(date) * 12 + F.month(date),
    })
    frames = [Window.partitionBy("rule").orderBy("_day").rangeBetween(-TRAILING_DAYS, -1)]
    if year_ago:
        frames.append(Window.partitionBy("rule").orderBy("_month").rangeBetween(-12, -12))
    zero = F.lit(0).cast("long")
    total = reduce(add, [F.coalesce(F.sum("n").over(w), zero) for w in frames])
    days = reduce(add, [F.count("n").over(w) for w in frames])
    return both.select(
        "rule", DAY, "_asked", F.try_divide(total.cast("double"), days).alias("baseline")
    ).where("_asked").drop("_asked")
