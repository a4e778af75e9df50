"""One-pass measures against the plain way: one query per rule and day."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as hs
from pyspark.sql import functions as F

from plumbline.functions.segments import Condition, Segment
from plumbline.functions.values import improper
from plumbline.operators import measures as m

DDL = "day int, line string, mode string, a string, b bigint, c double"
SEGMENTS = [
    Segment((Condition("line", "x"),)),
    Segment((Condition("mode", "p", negated=True),)),
    Segment((Condition("line", "y"), Condition("mode", "p"))),
    Segment(any_of=((Condition("line", "x"), Condition("mode", "p")), (Condition("line", "z"),))),
    Segment(),
]
COUNTERS = [("a", 1), ("a", 3), ("b", 2), ("c", 4), ("a", 8)]


def day():
    return F.col("day")


row = hs.tuples(
    hs.sampled_from([20240101, 20240102]),
    hs.sampled_from(["x", "y", "z", None]),
    hs.sampled_from(["p", "q", None]),
    hs.sampled_from([None, "", " ", "na", "Unknown", "abc", "abcdefgh"]),
    hs.sampled_from([None, 1, 22, 333]),
    hs.sampled_from([None, 0.0, -0.0, 1.5, float("nan")]),
)
tables = hs.lists(row, max_size=60)


def as_dict(frame, keys, value="n"):
    return {tuple(r[k] for k in keys): r[value] for r in frame.collect() if r[value]}


@settings(max_examples=4, deadline=None)
@given(tables)
def test_improper_counts(spark, data):
    rows = spark.createDataFrame(data, DDL)
    expected = {}
    for s, segment in enumerate(SEGMENTS):
        for c, (column, length) in enumerate(COUNTERS):
            part = rows.where(segment.test()).groupBy("day").agg(
                F.count_if(improper(column, rows.schema[column].dataType, length)).alias("bad"),
                F.count("*").alias("total"),
            )
            expected |= {(r.day, s, c): (r.bad, r.total) for r in part.collect()}
    wide = m.improper_counts(rows, day(), SEGMENTS, COUNTERS)
    narrow = m.improper_counts(rows, day(), SEGMENTS, COUNTERS, per_pass=2)
    for frame in (wide, narrow):
        got = {(r[m.DAY], r.segment, r.counter): (r.improper, r.total) for r in frame.collect()}
        assert got == expected
        assert all(bad <= total for bad, total in got.values())


@settings(max_examples=4, deadline=None)
@given(tables)
def test_row_and_distinct_counts(spark, data):
    rows = spark.createDataFrame(data, DDL)
    wanted = [("a", [0, 1, 4]), ("b", [2, 3]), ("c", [0, 4]), ("line", [4])]
    expected_rows, expected_values = {}, {}
    for s, segment in enumerate(SEGMENTS):
        part = rows.where(segment.test())
        expected_rows |= {(r.day, s): r["count"] for r in part.groupBy("day").count().collect()}
        for c, (column, ids) in enumerate(wanted):
            if s in ids:
                distinct = part.select("day", column).distinct().groupBy("day").count()
                expected_values |= {(r.day, s, c): r["count"] for r in distinct.collect()}
    assert as_dict(m.row_counts(rows, day(), SEGMENTS), [m.DAY, "segment"]) == expected_rows
    for size in (24, 2):
        got = m.distinct_counts(rows, day(), SEGMENTS, wanted, size)
        assert as_dict(got, [m.DAY, "segment", "column"]) == expected_values


@settings(max_examples=4, deadline=None)
@given(tables)
def test_duplicate_counts(spark, data):
    rows = spark.createDataFrame(data, DDL)
    having = ["b", "mode"]
    expected = {}
    for s, segment in enumerate(SEGMENTS):
        for h, column in enumerate(having):
            groups = rows.where(segment.test()).groupBy("day", "a", "c").agg(F.count(column).alias("n"))
            found = groups.where("n > 1").groupBy("day").count()
            expected |= {(r.day, s, h): r["count"] for r in found.collect()}
    got = m.duplicate_counts(rows, day(), SEGMENTS, ["a", "c"], having)
    assert as_dict(got, [m.DAY, "segment", "having"]) == expected


def test_null_is_one_distinct_value(spark):
    rows = spark.createDataFrame([(1, 1), (1, None), (1, None)], "day int, v int")
    got = m.distinct_counts(rows, day(), [Segment()], [("v", [0])]).head()
    assert got.n == 2


def test_values_that_only_look_alike_stay_distinct(spark):
    rows = spark.sql(
        "SELECT 1 AS day, * FROM VALUES ('1', 1, 1.0D, array(1)), ('01', 1, 1.5D, array(1, 1)), "
        "('1 ', 1, -0.0D, array()), ('1', 1, 0.0D, null) AS t(s, i, d, l)"
    )
    wanted = [("s", [0]), ("i", [0]), ("d", [0]), ("l", [0])]
    got = as_dict(m.distinct_counts(rows, day(), [Segment()], wanted), ["column"])
    assert got == {(0,): 3, (1,): 1, (2,): 3, (3,): 4}


def test_null_keys_can_be_duplicates(spark):
    rows = spark.createDataFrame(
        [(1, None, "h"), (1, None, "h"), (1, 2, "h"), (1, 3, "h"), (1, 3, "h"), (1, 3, "h"),
         (1, 4, None), (1, 4, "h"), (1, 5, None), (1, 5, None)],
        "day int, k int, h string",
    )
    got = m.duplicate_counts(rows, day(), [Segment()], ["k"], ["h"]).head()
    assert got.n == 2


def test_row_order_changes_nothing(spark):
    random.seed(7)
    data = [(1, random.choice("xyz"), random.choice("pq"), random.choice(["", "abc"]), i % 7, 1.0) for i in range(500)]
    shuffled = random.sample(data, len(data))
    keys = [m.DAY, "segment", "counter"]
    got = [
        as_dict(m.improper_counts(spark.createDataFrame(d, DDL), day(), SEGMENTS, COUNTERS), keys, "improper")
        for d in (data, shuffled)
    ]
    assert got[0] == got[1]


@pytest.mark.parametrize("share", [0.34, 1.0])
def test_hot_values(spark, share):
    """A key that holds a third (or all) of the rows reaches the shuffle pre-counted."""
    hot = F.when(F.col("id") < 30000 * share, F.lit("hot")).otherwise(F.col("id").cast("string"))
    rows = spark.range(30000).select(F.lit(1).alias("day"), hot.alias("k"))
    cold = 30000 - int(30000 * share)
    assert m.distinct_counts(rows, day(), [Segment()], [("k", [0])]).head().n == cold + 1
    assert m.duplicate_counts(rows, day(), [Segment()], ["k"], ["k"]).head().n == 1


def test_flags_reach_the_scan(spark, tmp_path):
    spark.range(100).selectExpr(
        "id AS day", "'x' AS line", "'p' AS mode", "'v' AS a", "'unused' AS z"
    ).write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    plan = m.improper_counts(rows, day(), SEGMENTS[:2], [("a", 1)])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(line,x)" in plan and "ReadSchema: struct<day:bigint,line:string,mode:string,a:string>" in plan


def test_segments_prune_partitions(spark, tmp_path):
    spark.range(120).selectExpr(
        "id AS a", "CAST(20240101 + id % 6 AS int) AS day", "element_at(array('x', 'y', 'z'), CAST(id % 3 AS int) + 1) AS line",
        "'p' AS mode",
    ).write.partitionBy("day", "line").parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t")).where("day BETWEEN 20240101 AND 20240102")
    for frame in (
        m.improper_counts(rows, day(), SEGMENTS[2:4], [("a", 1)]),
        m.distinct_counts(rows, day(), SEGMENTS[2:3], [("a", [0])]),
        m.duplicate_counts(rows, day(), SEGMENTS[2:3], ["a"], ["a"]),
    ):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        pruned = plan.split("PartitionFilters: [", 1)[1].split("],", 1)[0]
        assert "day#" in pruned and "line#" in pruned


def test_passes_are_even():
    assert [len(c) for c in m._passes(range(57), 24)] == [19, 19, 19]
    assert [len(c) for c in m._passes(range(24), 24)] == [24]
    assert m._passes([], 24) == []


def test_duplicates_repeat_counted_keys_not_rows(spark):
    """No row is repeated for its segments before the first aggregate."""
    rows = spark.createDataFrame([(20240101, "x", "p", "a", 1, 1.0)], DDL)
    frame = m.duplicate_counts(rows, day(), SEGMENTS, ["a"], ["b"])
    plan = frame._jdf.queryExecution().executedPlan().toString().splitlines()
    explode = max(i for i, line in enumerate(plan) if "Generate explode" in line)
    assert any("Aggregate" in line and "partial_count" in line for line in plan[explode + 1:])
