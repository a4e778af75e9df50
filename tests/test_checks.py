"""The rule checks end to end on small tables, with every deliberate decision pinned."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from plumbline import schemas, sinks
from plumbline.functions.metrics import NO_BASELINE, OVER_15, Run
from plumbline.plans.consistency import column_consistency, total_consistency
from plumbline.plans.duplicates import duplicate_check
from plumbline.plans.quality import column_quality
from plumbline.sources.tables import frames

ROWS = "data_dt int, business_line string, status string, zip string, ban bigint"


def accounts(spark, data):
    return frames({"EV_ACCOUNT": spark.createDataFrame(data, ROWS)})


def rules(spark, layout, *rows):
    return spark.createDataFrame(list(rows), layout)


def quality_rule(column="zip", priority="highPriorityColumn", length="5", status="Active", table="account"):
    return ("prod", "gold", table, "A", status, None, column, priority, length)


def test_quality_rows_without_data(spark, run):
    source = accounts(spark, [(20240102, "A", "Active", "123", 1), (20240102, "A", "Active", "12345", 2)])
    check = column_quality(
        spark, rules(spark, schemas.QUALITY_RULES, quality_rule()), 20240101, 20240102, source=source, run=run
    )
    got = {r.partitionDate: r for r in check.metrics.collect()}
    assert check.metrics.schema.simpleString() == schemas.COLUMN_QUALITY.simpleString()
    assert sorted(got) == [20240101, 20240102]
    empty, full = got[20240101], got[20240102]
    assert (empty.improperColumnCount, empty.totalColumnCount, empty.improperColumnPercent) == (0, 0, None)
    assert empty.category == OVER_15
    assert (full.improperColumnCount, full.totalColumnCount, full.improperColumnPercent) == (1, 2, 50.0)
    assert full.tableName == "EV_ACCOUNT" and full.logdate == 20240201


def test_quality_gate_and_defaults(spark, run):
    source = accounts(spark, [(20240101, "A", "Active", "1", 1)])
    rows = rules(
        spark, schemas.QUALITY_RULES, quality_rule(priority=None, length=None),
        quality_rule("ban", "lowPriorityColumn"), quality_rule("ban", "someday"),
        quality_rule("status", "mediumPriorityColumn"),
    )
    check = column_quality(spark, rows, 20240101, 20240101, source=source, run=run)
    got = check.metrics.collect()
    assert [(r.dataQualityColumn, r.priority, r.improperColumnCount) for r in got] == [
        ("zip", "HIGHPRIORITYCOLUMN", 0)
    ]
    low = column_quality(
        spark, rows, 20240101, 20240101, source=source, run=run, threshold="LOWPRIORITYCOLUMN"
    )
    assert sorted(r.dataQualityColumn for r in low.metrics.collect()) == ["ban", "status", "zip"]


def test_no_rules_and_no_days(spark, run):
    source = accounts(spark, [(20240101, "A", "Active", "1", 1)])
    none = rules(spark, schemas.QUALITY_RULES, quality_rule(priority="lowPriorityColumn"))
    assert column_quality(spark, none, 20240101, 20240101, source=source, run=run).metrics.count() == 0
    some = rules(spark, schemas.QUALITY_RULES, quality_rule())
    assert column_quality(spark, some, 20240102, 20240101, source=source, run=run).metrics.count() == 0
    assert column_consistency(spark, none, 20240101, 20240101, source=source, run=run).metrics.count() == 0
    totals = spark.createDataFrame([], schemas.TOTAL_RULES)
    assert total_consistency(spark, totals, 20240101, 20240101, source=source, run=run).metrics.count() == 0
    keys = spark.createDataFrame([], schemas.DUPLICATE_RULES)
    empty = duplicate_check(spark, keys, 20240101, 20240101, source=source, run=run).metrics
    assert empty.count() == 0 and empty.schema.simpleString() == schemas.DUPLICATE_CHECK.simpleString()


def test_a_limit_on_the_length_of_runs(spark):
    with pytest.raises(ValueError, match="31 days"):
        column_quality(
            spark, rules(spark, schemas.QUALITY_RULES, quality_rule()), 20240101, 20240301, max_days=31
        )


def test_nested_columns_by_policy(spark, run):
    rows = spark.createDataFrame(
        [(20240101, "A", "Active", [1], (1,)), (20240101, "A", "Active", [], (1,))],
        "data_dt int, business_line string, status string, tags array<int>, pair struct<a:int>",
    )
    source = frames({"EV_ACCOUNT": rows})
    check = column_quality(
        spark, rules(spark, schemas.QUALITY_RULES, quality_rule("tags")), 20240101, 20240101, source=source, run=run
    )
    assert check.metrics.head().improperColumnCount == 1
    with pytest.raises(ValueError, match="struct"):
        column_quality(
            spark, rules(spark, schemas.QUALITY_RULES, quality_rule("pair")), 20240101, 20240101, source=source
        )


def test_query_log_matches_rows(spark, run):
    source = accounts(spark, [(20240101, "A", "Active", "1", 1), (20240101, "A", "Active", "1", 1)])
    check = column_quality(
        spark, rules(spark, schemas.QUALITY_RULES, quality_rule(), quality_rule("ban")),
        20240101, 20240103, source=source, run=run,
    )
    log = check.query_log.collect()
    assert check.query_log.schema.simpleString() == schemas.QUERY_LOG.simpleString()
    assert {r.queryid for r in log} == {r.queryid for r in check.metrics.collect()}
    assert len({r.queryid for r in log}) == 6
    # The logged text is the measured query: run against the table it counts the same.
    source("gold", "EV_ACCOUNT").createOrReplaceTempView("ev_account")
    counts = {r.queryid: r.improperColumnCount for r in check.metrics.collect()}
    for line in log:
        assert spark.sql(line.query.replace("gold.ev_account", "ev_account")).count() == counts[line.queryid]
    assert {(r.scenario, r.logDate) for r in log} == {("ColumnQuality", 20240201)}


DUPLICATE_RULE = ("prod", "gold", "account", "business_line", "zip, ban", "A", "Active", None)


def test_duplicates(spark, run):
    source = accounts(spark, [
        (20240101, "A", "Active", "1", 1), (20240101, "A", "Active", "1", 1), (20240101, "A", "Active", "1", 1),
        (20240101, "A", "Active", None, 2), (20240101, "A", "Active", None, 2),
        (20240101, "A", "Active", "1", 3), (20240102, "A", "Active", "1", 1), (20240101, "A", "Closed", "1", 3),
    ])
    check = duplicate_check(
        spark, rules(spark, schemas.DUPLICATE_RULES, DUPLICATE_RULE, DUPLICATE_RULE), 20240101, 20240103,
        source=source, run=run,
    )
    got = check.metrics.collect()
    # Groups, not surplus rows; days without duplicates leave no row and no log line.
    assert [(r.partitionDate, r.duplicateCount, r.selectColumns) for r in got] == [(20240101, 2, "zip, ban")]
    log = check.query_log.collect()
    assert [r.queryid for r in log] == [got[0].queryid]
    source("gold", "EV_ACCOUNT").createOrReplaceTempView("ev_account")
    assert spark.sql(log[0].query.replace("gold.ev_account", "ev_account")).count() == 2


HISTORY = (
    "queryid bigint, environment string, databaseName string, tableName string, viewMode string, "
    "businessLine string, viewType string, columnConsistencyField string, dayCount bigint, "
    "logdate int, partitionDate int"
)


def logged(day, count, logdate, queryid, database="gold", mode="Active", kind=None, table="EV_ACCOUNT", field="zip"):
    return (queryid, "prod", database, table, mode, "A", kind, field, count, logdate, day)


def consistency(spark, run, history, **options):
    source = accounts(spark, [(20240201, "A", "Active", z, 1) for z in ("a", "b", None)])
    check = column_consistency(
        spark, rules(spark, schemas.QUALITY_RULES, quality_rule()), 20240201, 20240201, source=source, run=run,
        history=spark.createDataFrame(history, HISTORY), **options,
    )
    assert check.metrics.schema.simpleString() == schemas.COLUMN_CONSISTENCY.simpleString()
    return check.metrics.head()


def test_baseline_is_the_latest_run_of_each_day(spark, run):
    history = [
        logged(20240102, 100, 20240102, 1), logged(20240102, 10, 20240103, 2),  # re-run a day later
        logged(20240131, 100, 20240131, 3), logged(20240131, 20, 20240131, 4),  # re-run the same day
        logged(20240101, 999, 20240131, 5), logged(20240201, 999, 20240201, 6),  # outside the window
        logged(20240105, 999, 20240105, 7, table="EV_CHANNEL"), logged(20240105, 999, 20240105, 8, field="ban"),
        logged(20240105, 999, 20240105, 9, mode="Closed"), logged(20240105, 999, 20240105, 10, kind="LIVE"),
    ]
    row = consistency(spark, run, history)
    # NULL is one of the three values.
    assert (row.dayCount, row.averageRecordCount, row.columnConsistencyPercentDiff) == (3, 15.0, -80.0)


def test_literal_mode_keeps_one_row(spark, run):
    history = [
        logged(20240102, 100, 20240102, 1), logged(20240103, 10, 20240105, 2), logged(20240104, 6, 20240105, 3),
    ]
    assert consistency(spark, run, history, baseline="latest_row").averageRecordCount == 6.0
    assert consistency(spark, run, history).averageRecordCount == pytest.approx(116 / 3)
    # Each database has its own latest row; they are averaged.
    other = [*history, logged(20240110, 16, 20240110, 4, database="silver")]
    assert consistency(spark, run, other, baseline="latest_row").averageRecordCount == 11.0


def test_logs_of_other_writers(spark, run):
    """A table may be logged as a rule spelled it, and a missing type as the text null."""
    history = [
        logged(20240102, 10, 20240102, 1, table="account"), logged(20240103, 20, 20240103, 2, kind="null"),
        logged(20240104, 30, 20240104, 3, table="Ev_Account", kind="null"),
        # One day under two spellings is still one day; the later run counts.
        logged(20240104, 60, 20240105, 4), logged(20240106, 999, 20240106, 5, table="sales"),
    ]
    assert consistency(spark, run, history).averageRecordCount == 30.0


def test_unknown_baseline_mode(spark, run):
    with pytest.raises(ValueError, match="baseline mode"):
        consistency(spark, run, [], baseline="median").collect()


@pytest.mark.parametrize("history", [[], [logged(20240110, 0, 20240110, 1)]])
def test_no_baseline(spark, run, history):
    row = consistency(spark, run, history)
    assert (row.averageRecordCount, row.columnConsistencyPercentDiff, row.category) == (0.0, None, NO_BASELINE)


def test_a_rule_without_priority_is_low_here(spark, run):
    source = accounts(spark, [(20240101, "A", "Active", "1", 1)])
    rows = rules(spark, schemas.QUALITY_RULES, quality_rule(priority=None), quality_rule(priority=None, length="9"))
    assert column_consistency(spark, rows, 20240101, 20240101, source=source, run=run).metrics.count() == 0
    low = column_consistency(
        spark, rows, 20240101, 20240101, source=source, run=run, threshold="LOWPRIORITYCOLUMN"
    )
    # Priority and length are no part of this check, so the two rules are one.
    assert low.metrics.count() == 1


def daily(spark):
    """One row per account and day, 2023-01-01 to 2024-02-10, two on February days of 2023."""
    days = spark.sql("SELECT explode(sequence(DATE'2023-01-01', DATE'2024-02-10')) AS d")
    rows = days.withColumn("n", F.when((F.year("d") == 2023) & (F.month("d") == 2), 2).otherwise(1))
    return rows.select(
        F.date_format("d", "yyyyMMdd").cast("int").alias("data_dt"), F.lit("A").alias("business_line"),
        F.lit("Active").alias("status"), F.explode(F.sequence(F.lit(1), F.col("n"))).alias("ban"),
    )


TOTAL_RULE = ("prod", "gold", "account", "A", "Active", None)


def test_total_windows(spark, run):
    source = frames({"EV_ACCOUNT": daily(spark)})
    check = total_consistency(
        spark, rules(spark, schemas.TOTAL_RULES, TOTAL_RULE), 20240205, 20240212, source=source, run=run
    )
    assert check.metrics.schema.simpleString() == schemas.TOTAL_CONSISTENCY.simpleString()
    got = {r.partitionDate: r for r in check.metrics.collect()}
    # 28 days of two rows a year ago and 30 days of one row before the run.
    assert got[20240205].averageRecordCount == (28 * 2 + 30) / 58
    assert got[20240205].totalConsistencyPercentDiff == int((1 - 86 / 58) / (86 / 58) * 100)
    assert (got[20240212].dayCount, got[20240212].totalConsistencyPercentDiff) == (0, -100.0)


def test_a_stored_log_serves_as_history(spark, tmp_path):
    """Day-by-day runs that append to the table they read give the source's own baseline."""
    source = frames({"EV_ACCOUNT": daily(spark)})
    rows = rules(spark, schemas.TOTAL_RULES, TOTAL_RULE)
    target, log = str(tmp_path / "totals"), str(tmp_path / "log")
    for at, (first, last) in enumerate([(20230201, 20230228), (20240106, 20240204), (20240106, 20240204)]):
        sinks.store(
            total_consistency(
                spark, rows, first, last, source=source, run=Run(dt.datetime(2024, 2, 5, at, tzinfo=dt.timezone.utc))
            ),
            target, log,
        )
    later = Run(dt.datetime(2024, 2, 6, tzinfo=dt.timezone.utc))
    check = total_consistency(
        spark, rows, 20240205, 20240206, source=source, run=later, history=spark.read.parquet(target)
    )
    sinks.store(check, target, log)
    stored = spark.read.parquet(target).where("logDate = 20240206").collect()
    assert {(r.partitionDate, r.averageRecordCount) for r in stored} == {
        (20240205, (28 * 2 + 30) / 58), (20240206, (28 * 2 + 30) / 58)
    }
    assert spark.read.parquet(log).count() == spark.read.parquet(target).count() == 28 + 30 + 30 + 2


def test_same_rules_in_two_databases(spark, run):
    data = {"gold": [(20240101, "A", "Active", "1", 1)], "silver": [(20240101, "A", "Active", "12345", 1)]}
    check = column_quality(
        spark, rules(spark, schemas.QUALITY_RULES, quality_rule(), ("prod", "silver", *quality_rule()[2:])),
        20240101, 20240101, run=run, source=lambda db, table: spark.createDataFrame(data[db], ROWS),
    )
    assert {r.databaseName: r.improperColumnCount for r in check.metrics.collect()} == {"gold": 1, "silver": 0}


def test_daily_anchor_equals_runs_of_one_day(spark, run):
    """A run anchored on each day gives what that many one-day runs give."""
    source = frames({"EV_ACCOUNT": daily(spark)})
    totals = rules(spark, schemas.TOTAL_RULES, TOTAL_RULE)
    columns = rules(spark, schemas.QUALITY_RULES, quality_rule("ban"))
    days = (20240129, 20240212)
    for check, rows, options in ((total_consistency, totals, {}), (column_consistency, columns, {})):
        got = check(spark, rows, *days, source=source, run=run, anchor="day", **options).metrics.drop("queryid")
        singles = [
            check(spark, rows, day, day, source=source, run=run, **options).metrics.drop("queryid").collect()
            for day in (20240129, 20240201, 20240205, 20240212)
        ]
        whole = {r.partitionDate: r for r in got.collect()}
        assert len(whole) == 15
        for (single,) in singles:
            assert whole[single.partitionDate] == single


def test_daily_anchor_with_a_log(spark, run):
    history = [
        logged(20240110, 10, 20240110, 1), logged(20240110, 20, 20240111, 2), logged(20240203, 40, 20240203, 3),
        logged(20240203, 60, 20240203, 4, database="silver"), logged(20240205, 900, 20240205, 5, kind="LIVE"),
    ]
    source = accounts(spark, [(20240201, "A", "Active", "a", 1)])
    check = column_consistency(
        spark, rules(spark, schemas.QUALITY_RULES, quality_rule()), 20240201, 20240210, source=source, run=run,
        history=spark.createDataFrame(history, HISTORY), anchor="day",
    )
    got = {r.partitionDate: r.averageRecordCount for r in check.metrics.collect()}
    assert [got[d] for d in (20240201, 20240203, 20240204, 20240209, 20240210)] == [20.0, 20.0, 40.0, 40.0, 50.0]


@pytest.mark.parametrize("anchor", ["run", "day"])
@pytest.mark.parametrize("keep", ["partitionDate % 2 = 0", "false"])
def test_unlogged_days_are_measured(spark, run, anchor, keep, tmp_path):
    """A baseline of logged and measured days is the one of either, and only unlogged days are read."""
    source = frames({"EV_ACCOUNT": daily(spark)})
    earlier = Run(dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc))
    totals = rules(spark, schemas.TOTAL_RULES, TOTAL_RULE)
    columns = rules(spark, schemas.QUALITY_RULES, quality_rule("ban"), quality_rule("status"))
    for check, rows in ((total_consistency, totals), (column_consistency, columns)):
        results = str(tmp_path / check.__name__)
        for first, last in ((20230101, 20230228), (20231230, 20240204)):
            sinks.store(check(spark, rows, first, last, source=source, run=earlier), results)
        history = spark.read.parquet(results).where(keep)
        options = {"run": run, "anchor": anchor}
        days = (20240129, 20240205)
        measured = check(spark, rows, *days, source=source, **options).metrics.collect()
        both = check(spark, rows, *days, source=source, history=history, fill_gaps=True, **options).metrics.collect()
        assert sorted(measured) == sorted(both) and any(r.averageRecordCount for r in both)


def test_only_unlogged_days_are_read(spark, run, tmp_path):
    day = "20240110"
    path = str(tmp_path / "account")
    daily(spark).write.partitionBy("data_dt").parquet(path)
    read = spark.read.parquet(path)
    totals = rules(spark, schemas.TOTAL_RULES, TOTAL_RULE)
    results = str(tmp_path / "results")
    earlier = Run(dt.datetime(2024, 1, 31, tzinfo=dt.timezone.utc))
    source = frames({"EV_ACCOUNT": read})
    for first, last in ((20230201, 20230228), (20240102, 20240131)):
        sinks.store(total_consistency(spark, totals, first, last, source=source, run=earlier), results)
    history = spark.read.parquet(results).where(f"partitionDate <> {day}")
    check = total_consistency(
        spark, totals, 20240201, 20240201, source=source, run=run, history=history, fill_gaps=True)
    plan = check.frame._jdf.queryExecution().executedPlan().toString()
    # Scans are of the run's day and of the one unlogged day; the source's other days are not read.
    assert set(re.findall(r"data_dt#\d+ >?= (\d{8})", plan)) == {day, "20240201"}
    with pytest.raises(ValueError, match="day by day"):
        total_consistency(spark, totals, 20240201, 20240201, source=source, history=history, fill_gaps=True, baseline="latest_row")


@pytest.mark.parametrize("broken", ["log", "results"])
def test_a_run_that_failed_between_its_writes_is_stored_once(spark, run, tmp_path, monkeypatch, broken):
    source = accounts(spark, [(20240101, "A", "Active", "1", 1), (20240102, "A", "Active", "1", 1)])
    results, log = str(tmp_path / "results"), str(tmp_path / "log")
    own = sinks.append

    def check(days=(20240101, 20240103), run=run):
        return column_quality(spark, rules(spark, schemas.QUALITY_RULES, quality_rule()), *days, source=source, run=run)

    def failing(frame, target, *partition):
        if target.endswith(broken):
            raise OSError("no space")
        own(frame, target, *partition)

    before = Run(run.started - dt.timedelta(seconds=1))
    sinks.store(check(run=before), results, log)
    monkeypatch.setattr(sinks, "append", failing)
    with pytest.raises(OSError):
        sinks.store(check(), results, log)
    monkeypatch.setattr(sinks, "append", own)
    for _ in range(2):
        sinks.store(check(), results, log)
    stored, logged = spark.read.parquet(results), spark.read.parquet(log)
    assert stored.count() == logged.count() == 6
    assert stored.select("queryid").distinct().count() == logged.join(stored, "queryid").count() == 6


@pytest.mark.parametrize("options", [{"anchor": "week"}, {"anchor": "day", "baseline": "latest_row"}])
def test_unknown_anchor(spark, run, options):
    with pytest.raises(ValueError):
        consistency(spark, run, [], **options)


def test_a_wide_rule_set(spark, run):
    """Hundreds of rules over dozens of columns and overlapping segments, in both forms."""
    columns = [f"c{i}" for i in range(57)]
    rows = spark.range(400).select(
        F.lit(20240101).alias("program_watch_start_dt_local"),
        F.element_at(F.array(F.lit("SAT"), F.lit("OTT"), F.lit("ATT-OTT")), (F.col("id") % 3 + 1).cast("int")).alias("business_line"),
        F.element_at(F.array(F.lit("QUICKPLAY"), F.lit("OMNITURE")), (F.col("id") % 2 + 1).cast("int")).alias("source_system"),
        F.when(F.col("id") % 5 < 2, "STB").when(F.col("id") % 5 < 4, "TVE").alias("viewing_platform"),
        F.element_at(F.array(F.lit("Live"), F.lit("VOD")), (F.floor(F.col("id") / 7) % 2 + 1).cast("int")).alias("channel_tune_type"),
        *[F.when(F.col("id") % (i + 2) != 0, F.col("id").cast("string")).alias(c) for i, c in enumerate(columns)],
    )
    wide = rules(spark, schemas.QUALITY_RULES, *[
        ("prod", "gold", "viewership", line, mode, kind, c, "highPriorityColumn", str(1 + i % 4))
        for line in ("SAT", "OTT", "DTVNow") for mode in ("STB", "TVE", "OTT") for kind in ("LIVE", "VOD")
        for i, c in enumerate(columns)
    ])
    source = frames({"EV_VIEWING_HISTORY": rows})
    quality = column_quality(spark, wide, 20240101, 20240101, source=source, run=run).metrics
    picked = quality.where("businessLine = 'SAT' AND viewMode = 'OTT' AND viewType = 'LIVE' AND dataQualityColumn = 'c9'").head()
    mine = rows.where("business_line = 'SAT' AND viewing_platform != 'STB' AND upper(channel_tune_type) = 'LIVE'")
    assert quality.count() == 18 * 57
    assert picked.totalColumnCount == mine.count() > picked.improperColumnCount > 0
    distinct = column_consistency(spark, wide, 20240101, 20240101, source=source, run=run).metrics
    one = distinct.where("businessLine = 'SAT' AND viewMode = 'OTT' AND viewType = 'LIVE' AND columnConsistencyField = 'c9'")
    expected = rows.where(
        "business_line = 'SAT' AND viewing_platform != 'STB' AND upper(channel_tune_type) = 'LIVE'"
    ).select("c9").distinct().count()
    assert distinct.count() == 18 * 57 and one.head().dayCount == expected > 1
