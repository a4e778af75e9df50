import datetime as dt
import decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.values import PLACEHOLDERS, clean_decimal_text, clean_int, improper


def judged(spark, ddl, values, length=1):
    schema = T.StructType.fromDDL(f"i int, x {ddl}")
    rows = spark.createDataFrame(list(enumerate(values)), schema)
    test = improper("x", schema["x"].dataType, length)
    return [r[0] for r in rows.orderBy("i").select(test).collect()]


def test_placeholders_in_any_case(spark):
    texts = [None, "", " ", "na", "N/A", "n/a", "Unknown", "null", "NULL", "Nan", "x", " NA", "unknown "]
    assert judged(spark, "string", texts) == [
        True, True, False, True, True, True, True, True, True, False, False, False, False,
    ]


@pytest.mark.parametrize("length", [1, 2, 3, 4, 5, 7, 8, 14])
def test_lengths_around_the_limit(spark, length):
    texts = ["x" * n for n in range(17)]
    assert judged(spark, "string", texts, length) == [n < length or n == 0 for n in range(17)]


@pytest.mark.parametrize("length", range(10))
def test_same_as_plain_reading_of_the_rule(spark, length):
    texts = [*PLACEHOLDERS, *[p.lower() for p in PLACEHOLDERS], "NULLS", "éé", "ß", "ŉa", "ﬀ", "ı", "unKnown", "K" * 7]
    expected = [len(t) < length or t.upper() in PLACEHOLDERS for t in texts]
    assert judged(spark, "string", texts, length) == expected


def test_lengths_count_characters(spark):
    assert judged(spark, "string", ["éé", "ééé"], 3) == [True, False]


def test_other_types_are_judged_by_their_text(spark):
    assert judged(spark, "int", [1, 12, 123, None], 3) == [True, True, False, True]
    assert judged(spark, "date", [dt.date(2024, 1, 1), None], 10) == [False, True]
    assert judged(spark, "boolean", [True, False, None], 5) == [True, False, True]
    assert judged(spark, "decimal(5,2)", [decimal.Decimal("1.00"), None], 4) == [False, True]


def test_collections_are_improper_when_missing_or_empty(spark):
    assert judged(spark, "array<int>", [None, [], [1]]) == [True, True, False]
    assert judged(spark, "map<string,int>", [None, {}, {"a": 1}]) == [True, True, False]


def test_structs_are_refused():
    with pytest.raises(ValueError, match="struct"):
        improper("x", T.StructType.fromDDL("a int"))


def test_cleaners(spark):
    texts = ["12", "a1b2", "", "abc", None, "-5", "12.5", "1E3", "--", "99999999999"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, x string").orderBy("i")
    got = rows.select(clean_int(F.col("x")), clean_decimal_text(F.col("x"))).collect()
    assert [r[0] for r in got] == [12, 12, 0, 0, None, -5, None, None, None, None]
    assert [r[1] for r in got] == [
        "12.00", "12.00", "0", "0", None, "-5.00", "12.50", "1000.00", None, "99999999999.00",
    ]
