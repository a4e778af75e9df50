import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions import dates as d


def days(spark, first, last):
    a, b = d.run_range(first, last)
    rows = spark.range(1).select(F.explode(F.transform(d.day_sequence(F.lit(a), F.lit(b)), d.day_of)))
    return [r[0] for r in rows.collect()]


def test_ranges(spark):
    assert days(spark, 20240301, "20240301") == [20240301]
    assert days(spark, 20240228, 20240301) == [20240228, 20240229, 20240301]
    assert days(spark, 20231231, 20240101) == [20231231, 20240101]
    assert days(spark, 20240102, 20240101) == []


def test_longest_range():
    assert d.run_range(20240101, 20240131, max_days=31)
    with pytest.raises(ValueError, match="31 days"):
        d.run_range(20240101, 20240201, max_days=31)
    assert d.run_range(20240101, 20340201)


@pytest.mark.parametrize("day", [20180230, "2018-02-01", 201802, "x", 20181301])
def test_impossible_days(day):
    with pytest.raises(ValueError):
        d.parse_day(day)


def test_bad_day_values_are_null(spark):
    rows = spark.createDataFrame([(20240229,), (20230229,), (1,), (None,)], "x int")
    assert [r[0] for r in rows.select(d.date_of(F.col("x"))).collect()] == [
        dt.date(2024, 2, 29), None, None, None,
    ]


def test_windows(spark):
    def bounds(start):
        pairs = d.total_windows(F.lit(d.parse_day(start)))
        row = spark.range(1).select(*[d.day_of(x) for pair in pairs for x in pair]).head()
        return list(row)

    assert bounds(20240301) == [20230301, 20230331, 20240131, 20240229]
    assert bounds(20240229) == [20230201, 20230228, 20240130, 20240228]
    assert bounds(20250228) == [20240201, 20240229, 20250129, 20250227]
    assert bounds(20240101) == [20230101, 20230131, 20231202, 20231231]


@pytest.mark.parametrize("ddl", ["int", "bigint", "string", "dashed", "date", "timestamp", "timestamp_ntz"])
def test_partition_types(spark, ddl):
    stamps = spark.createDataFrame(
        [(dt.datetime(2024, 1, 31, 0, 0),), (dt.datetime(2024, 1, 31, 23, 59, 59, 999999),),
         (dt.datetime(2024, 2, 1, 0, 0),), (dt.datetime(2024, 1, 30, 12),), (None,)],
        "t timestamp",
    )
    typed = {
        "int": d.day_of(F.col("t")), "bigint": d.day_of(F.col("t")).cast("bigint"),
        "string": F.date_format("t", "yyyyMMdd"), "dashed": F.date_format("t", "yyyy-MM-dd"), "date": F.col("t").cast("date"),
        "timestamp": F.col("t"), "timestamp_ntz": F.col("t").cast("timestamp_ntz"),
    }
    rows = stamps.select(typed[ddl].alias("p"))
    dtype = rows.schema["p"].dataType
    day = F.lit(dt.date(2024, 1, 31))
    kept = rows.where(d.partition_between("p", dtype, day, day))
    assert [r[0] for r in kept.select(d.partition_day("p", dtype)).collect()] == [20240131] * 2


def test_other_partition_types_are_refused():
    with pytest.raises(ValueError, match="boolean"):
        d.partition_between("p", T.BooleanType(), F.lit(1), F.lit(2))


def test_partition_filter_prunes(spark, tmp_path):
    rows = spark.range(90).select("id", d.day_of(F.date_add(F.lit(dt.date(2024, 1, 1)), F.col("id").cast("int"))).alias("day"))
    rows.write.partitionBy("day").parquet(str(tmp_path / "t"))
    table = spark.read.parquet(str(tmp_path / "t"))
    window = d.trailing_window(F.lit(dt.date(2024, 2, 15)))
    kept = table.where(d.partition_between("day", T.IntegerType(), *window))
    assert len(kept.inputFiles()) >= 1
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "(day#" in plan and ">= 20240116" in plan and "<= 20240214" in plan
    assert kept.count() == 30
