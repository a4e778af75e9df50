"""Every operation as a query over the given tables."""

from __future__ import annotations

import datetime as dt
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue import standins as st
from plumbline import schemas, sinks
from plumbline.functions import dates, metrics, values
from plumbline.functions.segments import (
    line_segment,
    status_segment,
    viewing_segment,
    whole_table,
)
from plumbline.operators import measures
from plumbline.operators.counts import compare_counts, grouped_counts
from plumbline.operators.history import LATEST_ROW, latest_row
from plumbline.operators.footers import location_schemas
from plumbline.plans import merge
from plumbline.plans import schema_check as sc
from plumbline.plans.common import CheckResult
from plumbline.plans.consistency import column_consistency, total_consistency
from plumbline.plans.duplicates import duplicate_check
from plumbline.plans.quality import column_quality
from plumbline.session import materialise, scratch_path
from plumbline.sources.rules import HIGH, PRIORITY_RANK, passes_gate, priority_rank, read_rules
from plumbline.sources.tables import KNOWN_TABLES, frames, read_rows, register_view
from plumbline.sources.tree import locations

Query = Callable[[SparkSession, str], DataFrame]

RUN = metrics.Run(dt.datetime(2024, 2, 1, 6, tzinfo=dt.timezone.utc))
LABELS = ["environment", "databaseName", "tableName", "viewMode", "businessLine", "viewType"]

# Days that hold every row of a table, with empty days at both ends.
ALL_EVENTS = (20231230, 20240202)
ALL_ORDERS = (19941230, 20011231)

_registry: dict[str, Query] = {}


def query(function: Query) -> Query:
    _registry[function.__name__] = function
    return function


def queries() -> dict[str, Query]:
    return dict(_registry)


def _quality(check, *extra: str) -> DataFrame:
    return check.frame.select(
        *LABELS, "dataQualityColumn", "improperColumnCount", "improperColumnPercent",
        "totalColumnCount", "category", "priority", "partitionDate", *extra,
    )


# ---- column quality ---------------------------------------------------------

@query
def quality_viewing(spark, sf_dir):
    """All segment kinds of the viewing table, gated and de-duplicated rules, empty days."""
    check = column_quality(
        spark, st.quality_rules(spark, st.VIEWING_RULES), *ALL_EVENTS,
        source=frames({"EV_VIEWING_HISTORY": st.viewing(spark, sf_dir)}), run=RUN,
    )
    return _quality(check)


@query
def quality_short_values(spark, sf_dir):
    """Too-short values of one segment per day."""
    rules = [("prod", "gold", "CHANNEL", "EVENTS", "click", None, "channel_name", None, "9")]
    check = column_quality(
        spark, st.quality_rules(spark, rules), 20240101, 20240130,
        source=frames({"EV_CHANNEL": st.channel(spark, sf_dir)}), run=RUN,
    )
    return _quality(check)


@query
def quality_null_values(spark, sf_dir):
    """Missing values per account segment over the table's six years."""
    rules = [
        ("prod", "gold", "ev_account", line, status, None, "service_level", "mediumPriorityColumn", "6")
        for line in ("SATELLITE", "OTT") for status in ("Active", "Pending")
    ]
    check = column_quality(
        spark, st.quality_rules(spark, rules), *ALL_ORDERS, threshold="MEDIUMPRIORITYCOLUMN",
        source=frames({"EV_ACCOUNT": st.account(spark, sf_dir)}), run=RUN,
    )
    return _quality(check)


@query
def quality_two_tables(spark, sf_dir):
    """Rules over two tables in one run; one is sliced by business line alone."""
    rules = [
        ("prod", "gold", "EV_CHANNEL_PROGRAM_SCHEDULE", "OTT", None, None, "service_level", None, "1"),
        ("prod", "gold", "EV_ACCOUNT_PACKAGE_MARKET", "EVENTS", "any", "any", "channel_key", None, "3"),
    ]
    check = column_quality(
        spark, st.quality_rules(spark, rules), *ALL_ORDERS, run=RUN,
        source=frames({
            "EV_CHANNEL_PROGRAM_SCHEDULE": st.account(spark, sf_dir),
            "EV_ACCOUNT_PACKAGE_MARKET": st.channel(spark, sf_dir),
        }),
    )
    return _quality(check)


@query
def improper_values(spark, sf_dir):
    """The improper-value test itself, over whole texts and a nullable number."""
    documents = st.table(spark, sf_dir, "documents").join(
        st.table(spark, sf_dir, "labels"), "doc_id", "left"
    )
    types = {f.name: f.dataType for f in documents.schema.fields}

    def bad(column, length):
        return F.count_if(values.improper(column, types[column], length))

    return documents.groupBy("lang", "source").agg(
        bad("text", 200).alias("short_text"),
        bad("quality", 1).alias("missing_quality"),
        bad("n_chars", 4).alias("short_count"),
        F.count("*").alias("n"),
    )


@query
def percent_categories(spark, sf_dir):
    """Percent, its rounding and its category, for returned lines per ship day."""
    lines = st.table(spark, sf_dir, "lineitem").groupBy(
        dates.day_of(F.col("l_shipdate")).alias("day")
    ).agg(F.count_if(F.col("l_returnflag") == "R").alias("bad"), F.count("*").alias("total"))
    percent = metrics.improper_percent(F.col("bad"), F.col("total"))
    return lines.select(
        "day", "bad", "total",
        metrics.rounded_percent(F.col("bad"), F.col("total")).alias("percent"),
        metrics.category(percent).alias("category"),
    )


@query
def priority_gate(spark, sf_dir):
    """Which rules pass each threshold; rules made of parts, one kind without a priority."""
    p_type = F.col("p_type")
    priority = (
        F.when(p_type == "ECONOMY", "highPriorityColumn").when(p_type == "PROMO", "MEDIUMPRIORITYCOLUMN")
        .when(p_type == "LARGE", "lowPriorityColumn").when(p_type == "SMALL", "someday")
        .when(p_type == "MEDIUM", "HighPriorityColumn")
    )
    rules = st.table(spark, sf_dir, "part").select("p_brand", priority.alias("priority"))
    passing = [
        F.count_if(passes_gate(F.col("priority"), threshold, HIGH)).alias(threshold.lower())
        for threshold in PRIORITY_RANK
    ]
    return rules.groupBy("p_brand", priority_rank(F.col("priority")).alias("rank")).agg(
        *passing, F.count("*").alias("n")
    )


@query
def table_resolution(spark, sf_dir):
    """Table names and aliases to canonical tables and partition columns; one is unknown."""
    segment = F.col("c_mktsegment")
    name = (
        F.when(segment == "BUILDING", "Viewership").when(segment == "FURNITURE", "account")
        .when(segment == "MACHINERY", "EV_Channel").when(segment == "HOUSEHOLD", "ev_account_package_market")
        .otherwise("sales")
    )
    named = st.table(spark, sf_dir, "customer").select(name.alias("given"))
    return named.select(
        "given",
        KNOWN_TABLES.canonical_name(F.col("given")).alias("canonical"),
        KNOWN_TABLES.partition_column(F.col("given")).alias("partition_column"),
    ).groupBy("given", "canonical", "partition_column").agg(F.count("*").alias("n"))


@query
def query_log(spark, sf_dir):
    """The log a quality run leaves over all rules, joined back to its result rows by query id."""
    check = column_quality(
        spark, st.quality_rules(spark, st.VIEWING_RULES), *ALL_EVENTS, run=RUN,
        source=frames({"EV_VIEWING_HISTORY": st.viewing(spark, sf_dir)}),
    )
    once = CheckResult(materialise(check.frame, "check"), check.schema, check.scenario)
    rows = once.metrics.select("queryid", "dataQualityColumn", "totalColumnCount")
    return once.query_log.join(rows, "queryid").drop("queryid")


@query
def query_ids_of_all_checks(spark, sf_dir):
    """Eight runs of four checks that start within one second and share a log: rows and different ids of each check.

    The orders' check runs over a month, as the log is what is judged, and a result table has a directory a day.
    """
    log = scratch_path(spark, "log")
    viewing = frames({"EV_VIEWING_HISTORY": st.viewing(spark, sf_dir)})
    account = frames({"EV_ACCOUNT": st.account(spark, sf_dir)})
    channel = frames({"EV_CHANNEL": st.channel(spark, sf_dir)})
    keys = [("prod", "gold", "viewership", "business_line", "ban", "SATELLITE", "STB", "LIVE")]
    for milliseconds in (0, 500):
        run = metrics.Run(RUN.started + dt.timedelta(milliseconds=milliseconds))
        for check in (
            column_quality(spark, st.quality_rules(spark, st.VIEWING_RULES), *ALL_EVENTS, run=run, source=viewing),
            column_consistency(spark, st.quality_rules(spark, CHANNEL_RULES), *ALL_EVENTS, run=run, source=channel),
            total_consistency(spark, st.total_rules(spark, TOTAL_RULES), 19960301, 19960331, run=run, source=account),
            duplicate_check(spark, st.duplicate_rules(spark, keys), *ALL_EVENTS, run=run, source=viewing),
        ):
            sinks.store(check, scratch_path(spark, "results"), log)
    logged = spark.read.parquet(log)
    return logged.groupBy("scenario").agg(F.count("*").alias("n"), F.count_distinct("queryid").alias("ids"))


@query
def result_tables(spark, sf_dir):
    """Result tables that are created, appended to by a check of a catalog table, and read back.

    The run is a month of the table: a result table has a directory a day.
    """
    database = f"results_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'database')}'")
    st.account(spark, sf_dir).write.saveAsTable(f"{database}.ev_account")
    rules = [(environment, database, *rest) for environment, _, *rest in TOTAL_RULES]
    for _ in range(2):
        sinks.create_result_tables(spark, database)
    check = total_consistency(spark, st.total_rules(spark, rules), 19960301, 19960331, run=RUN)
    sinks.store(check, f"{database}.TotalConsistencyCheck", f"{database}.dataValidation_QueryDetails")
    logged = spark.table(f"{database}.dataValidation_QueryDetails").select("queryid", "scenario")
    stored = spark.table(f"{database}.TotalConsistencyCheck").join(logged, "queryid")
    return stored.select("tableName", "viewMode", "businessLine", "dayCount", "partitionDate", "scenario")


@query
def stored_results(spark, sf_dir):
    """Two runs appended to a result table, read back through its partitions."""
    results, log = scratch_path(spark, "results"), scratch_path(spark, "log")
    for day in (1, 2):
        run = metrics.Run(dt.datetime(2024, 2, day, 6, tzinfo=dt.timezone.utc))
        check = column_quality(
            spark, st.quality_rules(spark, st.VIEWING_RULES), 20240101, 20240131, run=run,
            source=frames({"EV_VIEWING_HISTORY": st.viewing(spark, sf_dir)}),
        )
        sinks.store(check, results, log)
    stored, logged = spark.read.parquet(results), spark.read.parquet(log)
    return stored.join(logged.select("queryid", "scenario"), "queryid").groupBy(
        "partitionDate", "logdate", "scenario"
    ).agg(
        F.count("*").alias("n"),
        F.count_distinct("queryid").alias("ids"),
        F.sum("improperColumnCount").alias("improper"),
    )


@query
def rule_files(spark, sf_dir):
    """Rules written as delimited files and read back: header per file, empty is NULL, no repeats."""
    path = scratch_path(spark, "rules")
    parts = st.table(spark, sf_dir, "part")
    layout = dict.fromkeys(schemas.QUALITY_RULES.fieldNames())
    layout.update(
        environment=F.lit("prod"), database=F.lit("gold"), tableType=F.col("p_brand"),
        businessLine=F.col("p_type"), viewMode=F.nullif(F.col("p_type"), F.lit("PROMO")),
        viewType=F.lit(None).cast("string"), dataQualityColumn=F.col("p_name"),
        priority=F.lit("highPriorityColumn"), columnLength=F.col("p_size").cast("string"),
    )
    rules = parts.select(*[c.alias(n) for n, c in layout.items()])
    rules.write.option("sep", "^").option("header", True).option("emptyValue", "").csv(path)
    return read_rules(spark, path, schemas.QUALITY_RULES)


# ---- segments and measures --------------------------------------------------

def _viewing_counts(spark, sf_dir, segments) -> DataFrame:
    rows = st.viewing(spark, sf_dir)
    day = dates.day_of(F.col("program_watch_start_dt_local"))
    return measures.row_counts(rows, day, segments)


@query
def segment_streaming(spark, sf_dir):
    """Rows per day of a line that stands for two streaming sources."""
    segments = [viewing_segment("DTVnow", "STB", "VOD")]
    return _viewing_counts(spark, sf_dir, segments).drop("segment")


@query
def segment_set_top_box(spark, sf_dir):
    """Rows per day of a set-top-box segment."""
    return _viewing_counts(spark, sf_dir, [viewing_segment("SATELLITE", "STB", "LIVE")]).drop("segment")


@query
def segment_other_platforms(spark, sf_dir):
    """Rows per day of a segment on any platform but the set-top box; no platform is in none."""
    return _viewing_counts(spark, sf_dir, [viewing_segment("SATELLITE", "TVE", "LIVE")]).drop("segment")


@query
def segment_account(spark, sf_dir):
    """Rows per day of an account segment."""
    rows, day = st.account(spark, sf_dir), dates.day_of(F.col("data_dt"))
    return measures.row_counts(rows, day, [status_segment("OTT", "Active", None)]).drop("segment")


@query
def segment_package(spark, sf_dir):
    """Rows per day of a segment by business line alone."""
    rows, day = st.account(spark, sf_dir), dates.day_of(F.col("data_dt"))
    return measures.row_counts(rows, day, [line_segment("SATELLITE", None, None)]).drop("segment")


@query
def row_count_per_day(spark, sf_dir):
    """Rows per day of a table without segments."""
    rows, day = st.table(spark, sf_dir, "orders"), dates.day_of(F.col("o_orderdate"))
    return measures.row_counts(rows, day, [whole_table("", None, None)]).drop("segment")


@query
def overlapping_segments(spark, sf_dir):
    """Segments that share rows, counted in one pass."""
    segments = [
        viewing_segment("SATELLITE", "STB", "LIVE"),
        viewing_segment("SATELLITE", "TVE", "LIVE"),
        viewing_segment("SATELLITE", "OTT", "LIVE"),
        viewing_segment("OTT", "STB", "DVR"),
        viewing_segment("DIRECT-NOW", "STB", "DVR"),
        whole_table("", None, None),
    ]
    # Equal segments are one slice; each stays countable under its own number.
    return _viewing_counts(spark, sf_dir, segments)


@query
def distinct_per_day(spark, sf_dir):
    """Distinct values per day and segment, NULL included, of columns of several types."""
    rows, day = st.account(spark, sf_dir), dates.day_of(F.col("data_dt"))
    segments = [status_segment("SATELLITE", "Active", None), line_segment("OTT", None, None)]
    wanted = [("service_level", [0, 1]), ("ban", [0, 1]), ("status", [1])]
    return measures.distinct_counts(rows, day, segments, wanted)


# ---- consistency ------------------------------------------------------------

CHANNEL_RULES = [
    ("prod", "gold", "channel", "EVENTS", status, None, column, "highPriorityColumn", None)
    for status in ("click", "view", "purchase") for column in ("channel_name", "channel_key")
]

# A rule without a priority is low, so it does not pass a high threshold here.
CHANNEL_RULES_GATED = CHANNEL_RULES + [
    ("prod", "gold", "channel", "EVENTS", "signup", None, "channel_key", None, None)
]


def _drift(check, *columns: str) -> DataFrame:
    return check.frame.select(
        *LABELS, "dayCount", "averageRecordCount", "category", "partitionDate", *columns
    )


def _column_drift(check) -> DataFrame:
    return _drift(check, "columnConsistencyField", "columnConsistencyPercentDiff")


def _total_drift(check) -> DataFrame:
    return _drift(check, "totalConsistencyPercentDiff")


@query
def column_consistency_source(spark, sf_dir):
    """Distinct values against a baseline measured from the table itself."""
    check = column_consistency(
        spark, st.quality_rules(spark, CHANNEL_RULES_GATED), 20240116, 20240201, run=RUN,
        source=frames({"EV_CHANNEL": st.channel(spark, sf_dir)}),
    )
    return _column_drift(check)


def _logged_columns(spark, sf_dir) -> DataFrame:
    """A log of two runs per day and event type, the later one over all events; a day is missing."""
    rows = st.table(spark, sf_dir, "events").groupBy(
        F.col("event_type").alias("viewMode"), dates.day_of(F.col("ts")).alias("partitionDate")
    ).agg(
        F.count_distinct(F.when(F.col("value") < 60, F.col("user_id"))).alias("early"),
        F.count_distinct("user_id").alias("late"),
    ).where(F.col("partitionDate") != 20240107)
    runs = F.array(
        F.struct(F.lit(1).alias("run"), F.col("early").alias("dayCount")),
        F.struct(F.lit(2).alias("run"), F.col("late").alias("dayCount")),
    )
    return rows.select("viewMode", "partitionDate", F.inline(runs)).select(
        (F.col("partitionDate").cast("long") * 10 + F.col("run")).alias("queryid"),
        F.lit("prod").alias("environment"), F.lit("gold").alias("databaseName"),
        F.lit("EV_CHANNEL").alias("tableName"), "viewMode", F.lit("EVENTS").alias("businessLine"),
        F.lit(None).cast("string").alias("viewType"),
        F.lit("channel_key").alias("columnConsistencyField"),
        F.col("dayCount").cast("long").alias("dayCount"),
        F.col("partitionDate").alias("logdate"), "partitionDate",
    )


def _consistency_with_log(spark, sf_dir, **mode) -> DataFrame:
    check = column_consistency(
        spark, st.quality_rules(spark, CHANNEL_RULES), 20240116, 20240201, run=RUN,
        source=frames({"EV_CHANNEL": st.channel(spark, sf_dir)}),
        history=_logged_columns(spark, sf_dir), **mode,
    )
    return _column_drift(check)


@query
def column_consistency_per_day(spark, sf_dir):
    """Baseline from logged runs: the latest run of each day, then their average."""
    return _consistency_with_log(spark, sf_dir)


@query
def column_consistency_latest_row(spark, sf_dir):
    """Baseline from logged runs: the one latest row."""
    return _consistency_with_log(spark, sf_dir, baseline=LATEST_ROW)


@query
def large_differences(spark, sf_dir):
    """Differences of any size from a tiny baseline keep their percent."""
    spent = st.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        (F.count("*") * 25_000_000).alias("n"), F.lit(1.0).alias("baseline")
    )
    difference = metrics.percent_difference(F.col("n"), F.col("baseline"))
    return spent.select("o_custkey", difference.alias("difference"), metrics.drift_category(difference).alias("category"))


@query
def column_consistency_daily(spark, sf_dir):
    """Every day against the 30 days before that day, over the whole table."""
    check = column_consistency(
        spark, st.quality_rules(spark, CHANNEL_RULES), *ALL_EVENTS, run=RUN, anchor="day",
        source=frames({"EV_CHANNEL": st.channel(spark, sf_dir)}),
    )
    return _column_drift(check)


TOTAL_RULES = [
    ("prod", "gold", "ACCOUNT", "SATELLITE", "Active", "LIVE"),
    ("prod", "gold", "account", "OTT", "Pending", None),
    ("prod", "gold", "ev_account", "CABLE", "Suspended", "VOD"),
]


@query
def total_consistency_source(spark, sf_dir):
    """Rows per day from the second year on, against the year-ago month and the 30 days before."""
    check = total_consistency(
        spark, st.total_rules(spark, TOTAL_RULES), 19960215, 20011231, run=RUN,
        source=frames({"EV_ACCOUNT": st.account(spark, sf_dir)}),
    )
    return _total_drift(check)


@query
def total_consistency_logged(spark, sf_dir):
    """The same against a stored log of an earlier run, NULL view types included."""
    source = frames({"EV_ACCOUNT": st.account(spark, sf_dir)})
    rules = st.total_rules(spark, TOTAL_RULES)
    results = _two_logged_months(spark, source, rules)
    check = total_consistency(
        spark, rules, 19980301, 20011231, source=source, run=RUN,
        history=spark.read.parquet(results),
    )
    return _total_drift(check)


def _two_logged_months(spark, source, rules) -> str:
    results = scratch_path(spark, "totals")
    for first, last in ((19970301, 19970331), (19980130, 19980228)):
        earlier = metrics.Run(dt.datetime.combine(dates.parse_day(last), dt.time(6), dt.timezone.utc))
        sinks.store(
            total_consistency(spark, rules, first, last, source=source, run=earlier), results
        )
    return results


@query
def total_consistency_latest_row(spark, sf_dir):
    """Baseline from the one latest logged row of each rule."""
    source = frames({"EV_ACCOUNT": st.account(spark, sf_dir)})
    rules = st.total_rules(spark, TOTAL_RULES)
    history = spark.read.parquet(_two_logged_months(spark, source, rules))
    return _total_drift(total_consistency(
        spark, rules, 19980301, 19980331, source=source, run=RUN, history=history, baseline=LATEST_ROW,
    ))


@query
def baseline_of_source_and_log(spark, sf_dir):
    """The baseline of a run, measured from the source and from the log of the same days."""
    source = frames({"EV_ACCOUNT": st.account(spark, sf_dir)})
    rules = st.total_rules(spark, TOTAL_RULES)
    history = spark.read.parquet(_two_logged_months(spark, source, rules))
    found = [
        total_consistency(spark, rules, 19980301, 19980301, source=source, run=RUN, history=earlier)
        .frame.select("viewMode", F.col("averageRecordCount").alias(name))
        for name, earlier in (("from_source", None), ("from_log", history))
    ]
    return found[0].join(found[1], "viewMode")


@query
def total_consistency_daily(spark, sf_dir):
    """Every day against its own year-ago month and last 30 days, over the whole table."""
    check = total_consistency(
        spark, st.total_rules(spark, TOTAL_RULES), *ALL_ORDERS, run=RUN, anchor="day",
        source=frames({"EV_ACCOUNT": st.account(spark, sf_dir)}),
    )
    return _total_drift(check)


@query
def total_consistency_filled(spark, sf_dir):
    """The same from a log that holds every other day: the others are measured where a baseline needs them."""
    source = frames({"EV_ACCOUNT": st.account(spark, sf_dir)})
    rules = st.total_rules(spark, TOTAL_RULES)
    earlier = metrics.Run(dt.datetime(2002, 1, 1, 6, tzinfo=dt.timezone.utc))
    # Baselines of the first days look back one year and a month.
    logged = total_consistency(spark, rules, 19931201, ALL_ORDERS[1], source=source, run=earlier).metrics
    history = materialise(logged.where("partitionDate % 2 = 0"), "log")
    return _total_drift(total_consistency(
        spark, rules, *ALL_ORDERS, run=RUN, anchor="day", history=history, fill_gaps=True, source=source,
    ))


@query
def total_no_baseline(spark, sf_dir):
    """Days without any earlier data have no difference and their own category."""
    check = total_consistency(
        spark, st.total_rules(spark, TOTAL_RULES), 19950101, 20011231, run=RUN,
        source=frames({"EV_ACCOUNT": st.account(spark, sf_dir)}),
    )
    return _total_drift(check)


@query
def latest_row_per_key(spark, sf_dir):
    """The newest order of each customer, ties by order key."""
    orders = st.table(spark, sf_dir, "orders").select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus"
    )
    return latest_row(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query
def date_bounds(spark, sf_dir):
    """Baseline windows for a run starting on each order day."""
    days = st.table(spark, sf_dir, "orders").select(
        dates.day_of(F.col("o_orderdate")).alias("day")
    ).distinct()
    start = dates.date_of(F.col("day"))
    month, trailing = dates.year_ago_month(start), dates.trailing_window(start)
    return days.select(
        "day",
        dates.day_of(month[0]).alias("month_first"), dates.day_of(month[1]).alias("month_last"),
        dates.day_of(trailing[0]).alias("trailing_first"),
        dates.day_of(trailing[1]).alias("trailing_last"),
    )


@query
def day_ranges(spark, sf_dir):
    """Days between each customer's first and last order of a status; reversed ranges hold none."""
    orders = st.table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))).cast("date").alias("a"),
        F.max(F.when(F.col("o_orderstatus") == "O", F.col("o_orderdate"))).cast("date").alias("b"),
    ).where(F.col("a").isNotNull() & F.col("b").isNotNull())
    listed = orders.select(
        "o_custkey", F.explode_outer(dates.day_sequence(F.col("a"), F.col("b"))).alias("d")
    )
    return listed.groupBy("o_custkey").agg(
        F.count("d").alias("days"), dates.day_of(F.max("d")).alias("last_day")
    )


# ---- duplicates -------------------------------------------------------------

def _duplicates(check) -> DataFrame:
    return check.frame.select(
        *LABELS, "selectColumns", "duplicateCheckColumn", "duplicateCount", "partitionDate"
    )


@query
def duplicates_keys(spark, sf_dir):
    """Repeated order lines per return flag and ship day, over the whole table."""
    rules = [
        ("prod", "gold", "lines", "l_shipdate", "l_orderkey, l_linenumber", "any", flag, None)
        for flag in ("A", "N", "R")
    ]
    check = duplicate_check(
        spark, st.duplicate_rules(spark, rules), *ALL_ORDERS, run=RUN,
        catalog=st.LINES, source=frames({"LINEITEM": st.table(spark, sf_dir, "lineitem")}),
    )
    return _duplicates(check)


@query
def duplicates_null_having(spark, sf_dir):
    """Rows whose having column is missing do not count; two having columns share a pass."""
    rows = st.table(spark, sf_dir, "lineitem").withColumn(
        "kept_status", F.nullif(F.col("l_linestatus"), F.lit("F"))
    )
    rules = [
        ("prod", "gold", "lineitem", having, "l_suppkey,l_linenumber", "any", flag, None)
        for flag in ("A", "R") for having in ("kept_status", "l_orderkey")
    ]
    check = duplicate_check(
        spark, st.duplicate_rules(spark, rules), *ALL_ORDERS, run=RUN,
        catalog=st.LINES, source=frames({"LINEITEM": rows}),
    )
    return _duplicates(check)


@query
def duplicates_any_day(spark, sf_dir):
    """Repeated order lines per return flag, whatever their day."""
    rows = st.table(spark, sf_dir, "lineitem")
    segments = [st.LINES.find("lines").segment("any", flag, None) for flag in ("A", "N", "R")]
    return measures.duplicate_counts(
        rows, F.lit(0), segments, ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    ).drop("having")


@query
def duplicates_viewing(spark, sf_dir):
    """One device, one start time: two key lists over several segments, NULL keys included."""
    rules = [
        ("prod", "gold", "viewership", "business_line", keys, line, mode, kind)
        for keys in ("ban, program_watch_start_time_local", "device_id, program_watch_start_time_local")
        for line, mode, kind in (
            ("SATELLITE", "STB", "LIVE"), ("SATELLITE", "TVE", "LIVE"), ("SATELLITE", "OTT", "LIVE"),
            ("CABLE", "STB", "DVR"),
        )
    ]
    check = duplicate_check(
        spark, st.duplicate_rules(spark, rules), *ALL_EVENTS, run=RUN,
        source=frames({"EV_VIEWING_HISTORY": st.viewing(spark, sf_dir)}),
    )
    return _duplicates(check)


# ---- counts -----------------------------------------------------------------

def _dated_orders(spark, sf_dir) -> DataFrame:
    return st.table(spark, sf_dir, "orders").withColumn("day", dates.day_of(F.col("o_orderdate")))


@query
def grouped_count_like(spark, sf_dir):
    """Orders by status and priority on the days that match a pattern."""
    return grouped_counts(
        _dated_orders(spark, sf_dir), ["o_orderstatus", "o_orderpriority"], day="day", like="1998%"
    )


@query
def count_compare(spark, sf_dir):
    """Grouped counts of a path against a view that lacks some rows and groups."""
    everything = read_rows(spark, f"{sf_dir}/orders.parquet")
    register_view(spark, f"{sf_dir}/orders.parquet", "copied_orders")
    copied = read_rows(spark, "copied_orders").where(
        (F.col("o_totalprice") < 400000) & (F.col("o_orderstatus") != "F")
    )
    pair = [
        rows.select(
            dates.day_of(F.col("o_orderdate")).alias("day"), "o_orderstatus",
            F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("priority"),
        )
        for rows in (everything, copied)
    ]
    return compare_counts(*pair, ["o_orderstatus", "priority"], day="day", like="199%")


@query
def grouped_count_loads(spark, sf_dir):
    """Spot check of a merged tree: ordered counts of the merged and the original half."""
    tree = st.order_tree(spark, sf_dir)
    merge.merge_loads(spark, tree, tree, ["yr", "status"])
    rows = merge.read_loads(spark, tree)
    merged = F.col("load_dt") == merge.MERGED_LOAD
    halves = [
        grouped_counts(rows.where(test), ["yr", "status"]).withColumn("half", F.lit(name))
        for name, test in (("merged", merged), ("loads", ~merged))
    ]
    return halves[0].unionByName(halves[1]).orderBy("yr", "status", "half")


# ---- load merge -------------------------------------------------------------

@query
def merge_load_partitions(spark, sf_dir):
    """All loads of every leaf in one merged partition, read back; merged twice."""
    tree, out = st.order_tree(spark, sf_dir), scratch_path(spark, "merged")
    merge.merge_loads(spark, tree, out, ["yr", "status"])
    merge.merge_loads(spark, tree, out, ["yr", "status"])
    return spark.read.parquet(out)


@query
def merge_in_place(spark, sf_dir):
    """Merging a tree into itself leaves the loads and, however often run, one merged copy."""
    tree = st.order_tree(spark, sf_dir)
    merge.merge_loads(spark, tree, tree, ["yr", "status"], compact=False)
    merge.merge_loads(spark, tree, tree, ["yr", "status"], compact=False)
    return grouped_counts(merge.read_loads(spark, tree), ["yr", "status", "load_dt"])


@query
def merge_reconcile(spark, sf_dir):
    """Rows per leaf before and after a merge; years that were not merged do not agree."""
    tree, out = st.order_tree(spark, sf_dir), scratch_path(spark, "merged")
    merge.merge_loads(spark, tree, out, ["yr", "status"], name_filter="yr=199")
    return merge.reconcile_leaves(spark, tree, out, ["yr", "status"])


@query
def merge_mixed_schemas(spark, sf_dir):
    """Leaves of different columns and types merge on their own: no leaf gets another's."""
    tree, out = st.mixed_load_tree(spark, sf_dir), scratch_path(spark, "merged")
    merge.merge_loads(spark, tree, out, ["status"])
    fields = location_schemas(spark, out, 2).select("location", F.inline("fields"))
    leaf = F.regexp_extract("location", "status=([^/]*)/", 1)
    rows = merge.reconcile_leaves(spark, tree, out, ["status"])
    return fields.select(leaf.alias("status"), "position", "name", "type").join(rows, "status")


@query
def merge_written_files(spark, sf_dir):
    """Rows in the files a merge wrote, per leaf."""
    tree, out = st.order_tree(spark, sf_dir), scratch_path(spark, "merged")
    merge.merge_loads(spark, tree, out, ["yr", "status"])
    leaf = F.regexp_extract("file", r"/(yr=[^/]*/status=[^/]*/load_dt=[^/]*)/[^/]*$", 1)
    return merge.written_files(spark, out).where(F.col("bytes") > 0).groupBy(
        leaf.alias("leaf")
    ).agg(F.sum("rows").alias("rows"))


@query
def merge_publish_outcomes(spark, sf_dir):
    """What the second of two merges into one output did to its files: rows written, replaced and kept per leaf."""
    tree, out = st.order_tree(spark, sf_dir), scratch_path(spark, "merged")
    merge.merge_loads(spark, tree, out, ["yr", "status"])
    before = merge.files_now(spark, out)
    merge.merge_loads(spark, tree, out, ["yr", "status"], name_filter="yr=199")
    found = merge.publish_outcomes(before, merge.files_now(spark, out))
    leaf = F.regexp_extract("file", r"/(yr=[^/]*/status=[^/]*/load_dt=[^/]*)/[^/]*$", 1)
    return found.groupBy(leaf.alias("leaf"), "outcome").agg(F.sum("rows").alias("rows"))


# ---- schema check -----------------------------------------------------------

def _reference(spark, tree):
    return sc.reference_schema(spark, f"{tree}/status=F")


def _leaf(column: str = "location"):
    return F.regexp_extract(column, r"([^/]+)/$", 1)


@query
def schema_check(spark, sf_dir):
    """A good, a reordered and a re-typed partition against the reference."""
    tree = st.mixed_schema_tree(spark, sf_dir)
    checked = sc.schema_check(spark, _reference(spark, tree), tree, 1, run=RUN)
    return checked.select("schema_status", _leaf().alias("leaf"), "log_time")


@query
def schema_check_stored(spark, sf_dir):
    """Schema-check rows of two runs, stored by run time and read back."""
    tree, results = st.mixed_schema_tree(spark, sf_dir), scratch_path(spark, "schema-results")
    for hour in (6, 18):
        run = metrics.Run(dt.datetime(2024, 2, 1, hour, tzinfo=dt.timezone.utc))
        checked = sc.schema_check(spark, _reference(spark, tree), tree, 1, run=run)
        sinks.store_schema_check(checked, results)
    return spark.read.parquet(results).groupBy("schema_status", "log_time").agg(
        F.count("*").alias("n")
    )


@query
def schema_failures(spark, sf_dir):
    """Number of wrong partitions."""
    tree = st.mixed_schema_tree(spark, sf_dir)
    return sc.failed_schemas(sc.schema_check(spark, _reference(spark, tree), tree, 1, run=RUN))


@query
def schema_differences(spark, sf_dir):
    """The fields that differ, per wrong partition."""
    tree = st.mixed_schema_tree(spark, sf_dir)
    found = sc.schema_differences(spark, _reference(spark, tree), tree, 1)
    return found.select(_leaf().alias("leaf"), "side", "position", "name", "type")


@query
def schema_check_typed_directories(spark, sf_dir):
    """Days judged against their own read: long numbers, dates, times and mixed values below them, and files whose
    types no writer but Spark named. Each day is right by its own schema, and wrong by another's."""
    tree = st.typed_tree(spark, sf_dir)
    found = []
    for kind in st.DIRECTORY_VALUES:
        reference = sc.reference_schema(spark, f"{tree}/kind={kind}")
        checked = sc.schema_check(spark, reference, tree, 1, run=RUN)
        found.append(checked.select(F.lit(kind).alias("reference"), "schema_status", _leaf().alias("leaf")))
    return functools.reduce(DataFrame.union, found)


@query
def schema_check_merged(spark, sf_dir):
    """Partitions two levels down, judged with the load column below them."""
    tree = st.order_tree(spark, sf_dir)
    reference = sc.reference_schema(spark, f"{tree}/yr=1995/status=F")
    checked = sc.schema_check(spark, reference, tree, 2, "yr=199", run=RUN)
    leaf = F.regexp_extract("location", r"(yr=[^/]*/status=[^/]*)/$", 1)
    return checked.select("schema_status", leaf.alias("leaf"))


@query
def partition_tree_default(spark, sf_dir):
    """Locations of a tree that also holds the partition of missing values, which is skipped."""
    path = scratch_path(spark, "default-tree")
    st.table(spark, sf_dir, "orders").select(
        F.nullif("o_orderstatus", F.lit("P")).alias("status"), F.year("o_orderdate").alias("yr"), "o_orderkey"
    ).write.partitionBy("status", "yr").parquet(path)
    return locations(spark, path, 2).select(F.regexp_extract("location", r"(status=.*)$", 1).alias("place"))


@query
def partition_tree(spark, sf_dir):
    """Locations at each depth of a tree, filtered on the first level."""
    tree = st.order_tree(spark, sf_dir)
    found = [
        locations(spark, tree, depth, "yr=199").select("location", F.lit(depth).alias("depth"))
        for depth in (1, 2, 3)
    ]
    place = F.regexp_extract("location", r"(yr=.*)$", 1)
    return found[0].union(found[1]).union(found[2]).select("depth", place.alias("place"))


# ---- text cleaners ----------------------------------------------------------

@query
def clean_numbers(spark, sf_dir):
    """Digits out of event properties, as a number and as two-decimal text."""
    events = st.table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        values.clean_int(F.col("props")).alias("as_int"),
        values.clean_decimal_text(F.col("props")).alias("as_text"),
    )


@query
def clean_names(spark, sf_dir):
    """Names without digits clean to zero; a stray letter E or dash is no number."""
    parts = st.table(spark, sf_dir, "part")
    text = F.concat("p_brand", F.when(F.col("p_type") == "ECONOMY", "-E").otherwise(""))
    return parts.select(
        "p_partkey",
        values.clean_int(F.col("p_name")).alias("name_int"),
        values.clean_decimal_text(F.col("p_name")).alias("name_text"),
        values.clean_int(text).alias("brand_int"),
        values.clean_decimal_text(text).alias("brand_text"),
    )
