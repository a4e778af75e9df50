import pytest
from pyspark.sql import functions as F

from plumbline.operators.counts import compare_counts, grouped_counts
from plumbline.operators.history import latest_row

DDL = "day int, line string"


def test_grouped_counts(spark):
    rows = spark.createDataFrame([(20180101, "b"), (20180102, "a"), (20180102, "a"), (20190101, None)], DDL)
    assert [tuple(r) for r in grouped_counts(rows, ["line"], ordered=True).collect()] == [
        (None, 1), ("a", 2), ("b", 1)
    ]
    like = grouped_counts(rows, ["day", "line"], day="day", like="2018%", ordered=True)
    assert [tuple(r) for r in like.collect()] == [(20180101, "b", 1), (20180102, "a", 2)]
    with pytest.raises(ValueError, match="day column"):
        grouped_counts(rows, ["line"], like="2018%")


def test_compare_counts(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (1, None), (2, "only left")], DDL)
    right = spark.createDataFrame([(1, "a"), (1, None), (1, None), (3, "only right")], DDL)
    got = {tuple(r)[:2]: tuple(r)[2:] for r in compare_counts(left, right, ["day", "line"]).collect()}
    assert got == {
        (1, "a"): (2, 1, 1), (1, None): (1, 2, -1), (2, "only left"): (1, 0, 1), (3, "only right"): (0, 1, -1)
    }


def test_compare_counts_shuffles_counts_not_rows(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("k"))
    plan = compare_counts(rows, rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "partial_count" in plan


def test_latest_row(spark):
    rows = spark.createDataFrame(
        [("a", 1, 1, "x"), ("a", 2, 1, "y"), ("a", 2, 2, None), ("b", None, 9, "n"), ("b", 1, 0, "z"), (None, 1, 1, "w")],
        "k string, day int, id int, v string",
    )
    got = latest_row(rows, ["k"], ["day", "id"])
    assert got.columns == rows.columns
    assert {r.k: (r.day, r.id, r.v) for r in got.collect()} == {"a": (2, 2, None), "b": (1, 0, "z"), None: (1, 1, "w")}
