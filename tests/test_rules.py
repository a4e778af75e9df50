import pytest
from pyspark.sql import functions as F

from plumbline import schemas
from plumbline.functions import segments as s
from plumbline.sources import rules as r
from plumbline.sources.tables import KNOWN_TABLES, frames, metastore
from plumbline.plans.common import by_table

HEADER = "environment^database^tableType^businessLine^viewMode^viewType^dataQualityColumn^priority^columnLength\n"


def test_directory_of_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text(HEADER + "prod^g^viewership^SATELLITE^STB^DVR^ban^highPriorityColumn^5\n")
    (tmp_path / "b.txt").write_text(
        HEADER + "prod^g^account^CABLE^Active^^zip^^\n"
        "prod^g^viewership^SATELLITE^STB^DVR^ban^highPriorityColumn^5\n"
    )
    got = r.read_rules(spark, str(tmp_path), schemas.QUALITY_RULES).orderBy("tableType").collect()
    assert [tuple(x) for x in got] == [
        ("prod", "g", "account", "CABLE", "Active", None, "zip", None, None),
        ("prod", "g", "viewership", "SATELLITE", "STB", "DVR", "ban", "highPriorityColumn", "5"),
    ]


def test_columns_go_by_position(spark, tmp_path):
    path = tmp_path / "t.txt"
    path.write_text("environment^database^table^businessLine^viewMode^viewType\nKM^g^account^A^B^C\n")
    rule = r.read_rules(spark, str(path), schemas.TOTAL_RULES).head()
    assert rule.tableType == "account"


def gate(spark, priority, threshold, default=r.HIGH):
    rows = spark.createDataFrame([(priority,)], "p string")
    return rows.select(r.passes_gate(F.col("p"), threshold, default)).head()[0]


def test_gate(spark):
    low, medium, high = r.PRIORITY_RANK
    for threshold, passing in ((low, 3), (medium, 2), (high, 1)):
        got = [gate(spark, p, threshold) for p in ("highPriorityColumn", "MediumPriorityColumn", "lowprioritycolumn")]
        assert got == [True] * passing + [False] * (3 - passing)
    assert gate(spark, None, high, r.HIGH) and not gate(spark, None, high, r.LOW)
    assert gate(spark, "someday", low) is False
    with pytest.raises(ValueError, match="threshold"):
        gate(spark, "highPriorityColumn", "highPriorityColumn")


def total_rules(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.TOTAL_RULES)


def test_names_resolve_in_any_case():
    assert KNOWN_TABLES.find("viewership").name == "EV_VIEWING_HISTORY"
    assert KNOWN_TABLES.find("Ev_Account").partition_column == "data_dt"
    assert len(KNOWN_TABLES.specs) == 7


def test_bad_rules_stop_before_any_job(spark):
    with pytest.raises(ValueError, match="unknown table 'sales'"):
        r.bind(total_rules(spark, ("prod", "g", "sales", "A", "B", "C")), KNOWN_TABLES)
    with pytest.raises(ValueError, match="view mode"):
        r.bind(total_rules(spark, ("prod", "g", "viewership", "A", None, "C")), KNOWN_TABLES)
    with pytest.raises(ValueError, match="without businessLine"):
        r.bind(total_rules(spark, ("prod", "g", "account", None, "B", "C")), KNOWN_TABLES)


def test_repeats_are_dropped_and_order_is_stable(spark):
    rows = [("prod", "g", "account", line, "B", None) for line in ("b", "a", "b")]
    bound = r.bind(total_rules(spark, *rows), KNOWN_TABLES)
    assert [(x.number, x.business_line) for x in bound] == [(0, "a"), (1, "b")]
    assert r.bind(total_rules(spark, *rows[::-1]), KNOWN_TABLES) == bound


def test_names_that_are_no_columns_are_refused(spark):
    bound = r.bind(total_rules(spark, ("prod", "g", "account", "A", "B", None)), KNOWN_TABLES)
    rows = spark.createDataFrame([], "data_dt int, business_line string, status string")
    source = frames({"EV_ACCOUNT": rows})
    assert by_table(bound, source, lambda rule: ["STATUS"])
    with pytest.raises(ValueError, match="1 OR 1=1"):
        by_table(bound, source, lambda rule: ["1 OR 1=1"])


def test_metastore_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS gold")
    spark.range(3).write.mode("overwrite").saveAsTable("gold.ev_account")
    assert metastore(spark)(" gold ", "EV_ACCOUNT").count() == 3


def test_segment_of_rule(spark):
    bound = r.bind(total_rules(spark, ("prod", "g", "channel", "A", "B", None)), KNOWN_TABLES)
    assert bound[0].segment == s.status_segment("A", "B", None)
    assert bound[0].labels()["tableName"] == "EV_CHANNEL"
