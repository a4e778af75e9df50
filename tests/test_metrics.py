import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from plumbline.functions import metrics as m


def column(spark, values, ddl, expression):
    rows = spark.createDataFrame(list(enumerate(values)), f"i int, x {ddl}").orderBy("i")
    return [r[0] for r in rows.select(expression(F.col("x"))).collect()]


def test_category_bounds(spark):
    sizes = [0.0, 4.999, -4.999, 5.0, -5.0, 9.999, 10.0, 15.0, -15.0, 15.001, -100.0, float("nan"), None]
    assert column(spark, sizes, "double", m.category) == [
        m.UNDER_5, m.UNDER_5, m.UNDER_5, m.FROM_5_TO_9, m.FROM_5_TO_9, m.FROM_5_TO_9,
        m.FROM_10_TO_15, m.FROM_10_TO_15, m.FROM_10_TO_15, m.OVER_15, m.OVER_15, m.OVER_15, m.OVER_15,
    ]


def test_missing_difference_is_no_baseline(spark):
    assert column(spark, [None, 15, 16], "int", m.drift_category) == [
        m.NO_BASELINE, m.FROM_10_TO_15, m.OVER_15,
    ]


def test_difference_is_cut_toward_zero_before_it_is_categorised(spark):
    rows = spark.createDataFrame(
        [(1159, 1000.0), (841, 1000.0), (1000, 0.0), (0, 0.0), (5, None), (0, 10.0)],
        "n bigint, b double",
    )
    percent = m.percent_difference(F.col("n"), F.col("b"))
    got = rows.select(percent, m.drift_category(percent)).collect()
    assert [tuple(r) for r in got] == [
        (15, m.FROM_10_TO_15), (-15, m.FROM_10_TO_15), (None, m.NO_BASELINE),
        (None, m.NO_BASELINE), (None, m.NO_BASELINE), (-100, m.OVER_15),
    ]


@settings(max_examples=5, deadline=None)
@given(hs.lists(hs.tuples(hs.integers(0, 10**6), hs.integers(0, 10**12)), min_size=1, max_size=200))
def test_percent_rounds_half_up(spark, pairs):
    pairs = [(min(a, b), b) for a, b in pairs] + [(1, 80000), (1, 8), (1005, 100000)]
    rows = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a bigint, b bigint")
    got = rows.orderBy("i").select(m.rounded_percent(F.col("a"), F.col("b"))).collect()
    for (a, b), row in zip(pairs, got):
        if b == 0:
            assert row[0] is None
        else:
            exact = (Decimal(a) * 100 / Decimal(b)).quantize(Decimal("0.01"), ROUND_HALF_UP)
            assert row[0] == float(exact)


def test_percent_of_an_empty_day_is_missing(spark):
    rows = spark.createDataFrame([(0, 0)], "a bigint, b bigint")
    assert rows.select(m.improper_percent(F.col("a"), F.col("b"))).head()[0] is None


def test_later_runs_have_larger_ids(spark):
    early = m.Run(dt.datetime(2024, 2, 1, 6, 0, 0, tzinfo=dt.timezone.utc))
    # Twelve hours later: a twelve-hour clock could not tell these apart.
    late = m.Run(dt.datetime(2024, 2, 1, 18, 0, 0, tzinfo=dt.timezone.utc))
    rows = spark.range(1000)
    first = {r[0] for r in rows.select(early.query_id(F.col("id"))).collect()}
    second = {r[0] for r in rows.select(late.query_id(F.col("id"))).collect()}
    assert len(first) == len(second) == 1000
    assert max(first) < min(second)
    assert (early.log_date, early.log_time, late.log_time) == (20240201, 20240201060000, 20240201180000)


def test_checks_that_share_a_log_have_their_own_ids(spark, run):
    rows = spark.range(1000)
    ids = [{r[0] for r in rows.select(run.query_id(F.col("id"), check)).collect()} for check in range(4)]
    assert len(set().union(*ids)) == 4000
    later = m.Run(run.started + dt.timedelta(seconds=1))
    assert max(set().union(*ids)) < rows.select(F.min(later.query_id(F.col("id")))).head()[0]
    with pytest.raises(ValueError):
        run.query_id(F.col("id"), 4)


def test_differences_of_any_size(spark):
    rows = spark.createDataFrame([(25_000_000, 1.0), (10**12, 0.5), (0, 1e9), (1, 3.0), (5, 0.0), (5, None)], "n long, b double")
    got = [r[0] for r in rows.select(m.percent_difference(F.col("n"), F.col("b"))).collect()]
    assert got == [2_499_999_900, 199_999_999_999_900, -100, -66, None, None]


def test_one_log_date_per_run(run):
    with pytest.raises(AttributeError):
        run.started = dt.datetime.now()


def test_ids_of_runs_in_one_second_and_beyond_2038(spark):
    second = dt.datetime(2024, 2, 1, 6, tzinfo=dt.timezone.utc)
    starts = [
        second, second + dt.timedelta(milliseconds=8), second + dt.timedelta(milliseconds=500),
        dt.datetime(2038, 2, 1, tzinfo=dt.timezone.utc), dt.datetime(2105, 12, 31, tzinfo=dt.timezone.utc),
    ]
    rows = spark.range(1000)
    smallest, largest = zip(*(
        rows.select(m.Run(start).query_id(F.col("id")).alias("i")).agg(F.min("i"), F.max("i")).head() for start in starts))
    assert all(a < b for a, b in zip(largest, smallest[1:]))
    assert all(a <= i <= b for start, i in zip(starts, largest) for a, b in [m.Run(start).id_range()])
    with pytest.raises(ValueError, match="no ids"):
        m.Run(dt.datetime(2107, 1, 1, tzinfo=dt.timezone.utc)).query_id(F.col("id"))
    with pytest.raises(Exception, match="at most 4194304 rows"):
        spark.range(1 << 22, (1 << 22) + 1).select(m.Run(second).query_id(F.col("id"))).collect()
