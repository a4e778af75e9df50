import pytest
from pyspark.sql import functions as F

from plumbline.functions import segments as s
from plumbline.operators import measures

ROWS = [
    # business_line, source_system, viewing_platform, channel_tune_type, status
    ("OTT", "QUICKPLAY", "OTT", "LIVE", "Active"),
    ("ATT-OTT", "OMNITURE", "OTT", "live", "Active"),
    ("OTT", "OMNITURE", "OTT", "LIVE", "Closed"),
    ("SATELLITE", "AMS", "STB", "LIVE", "Active"),
    ("SATELLITE", "AMS", "TVE", "Live", None),
    ("SATELLITE", "AMS", None, "LIVE", "Active"),
    ("satellite", "AMS", "STB", "LIVE", "Active"),
    (None, "AMS", "STB", "LIVE", "Active"),
]


@pytest.fixture(scope="module")
def rows(spark):
    ddl = "business_line string, source_system string, viewing_platform string, channel_tune_type string, status string, id int"
    return spark.createDataFrame([(*r, i) for i, r in enumerate(ROWS)], ddl)


def kept(rows, segment):
    return sorted(r.id for r in rows.where(segment.test()).collect())


def test_viewing_segments(rows):
    assert kept(rows, s.viewing_segment("DTVNow", "OTT", "LIVE")) == [0, 1]
    assert kept(rows, s.viewing_segment("direct-now", "OTT", "LIVE")) == [0, 1]
    assert kept(rows, s.viewing_segment("SATELLITE", "STB", "LIVE")) == [3]
    # Any other mode means "not a set-top box"; a missing platform is neither.
    assert kept(rows, s.viewing_segment("SATELLITE", "OTT", "LIVE")) == [4]
    assert kept(rows, s.viewing_segment("SATELLITE", "stb", "LIVE")) == [4]
    # A lower-case type matches nothing; a list of lines is one literal.
    assert kept(rows, s.viewing_segment("SATELLITE", "STB", "live")) == []
    assert kept(rows, s.viewing_segment("SATELLITE,ATT-OTT", "TVE", "LIVE")) == []


def test_other_segments(rows):
    assert kept(rows, s.status_segment("SATELLITE", "Active", None)) == [3, 5]
    assert kept(rows, s.line_segment("SATELLITE", None, None)) == [3, 4, 5]
    assert kept(rows, s.whole_table("x", None, None)) == list(range(8))


def test_missing_modes_are_refused():
    for bad in (lambda: s.viewing_segment("A", None, "LIVE"), lambda: s.viewing_segment("A", "STB", None),
                lambda: s.status_segment("A", None, None)):
        with pytest.raises(ValueError):
            bad()


@pytest.mark.parametrize("segment", [
    s.viewing_segment("DTVNow", "OTT", "LIVE"), s.viewing_segment("SATELLITE", "TVE", "LIVE"),
    s.status_segment("SATELLITE", "Active", None), s.whole_table("", None, None),
])
def test_text_means_the_same(rows, segment):
    assert sorted(r.id for r in rows.where(segment.text()).collect()) == kept(rows, segment)


def test_quotes_stay_literals(spark):
    rows = spark.createDataFrame([("x' OR '1'='1",), ("b",)], "business_line string")
    segment = s.line_segment("x' OR '1'='1", None, None)
    assert rows.where(segment.test()).count() == 1


def test_more_segments_than_one_word_holds(spark):
    rows = spark.range(200).select(F.col("id").cast("string").alias("business_line"), F.lit(1).alias("d"))
    segments = [s.line_segment(str(i), None, None) for i in range(150)] + [s.Segment()]
    counted = measures.row_counts(rows, F.col("d"), segments)
    got = {r.segment: r.n for r in counted.collect()}
    assert got == {**{i: 1 for i in range(150)}, 150: 200}
