"""The given tables in the shapes the checks expect.

Each stand-in is a projection of one whole table; the SQL next to it states the
same projection for the comparison queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions.segments import Condition, Segment
from plumbline.session import local_frame, scratch_path
from plumbline.sources.tables import Catalog, TableSpec
from plumbline import schemas


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Viewing history out of events: every column of the segments, with a missing
# platform, mixed-case tune types, and a column of missing and filler values.
VIEWING = [
    "ts AS program_watch_start_dt_local",
    """CASE event_type WHEN 'view' THEN 'SATELLITE' WHEN 'error' THEN 'SATELLITE'
           WHEN 'click' THEN 'OTT' WHEN 'signup' THEN 'ATT-OTT' ELSE 'CABLE' END
       AS business_line""",
    """CASE WHEN value < 20 THEN 'QUICKPLAY' WHEN value < 60 THEN 'OMNITURE' ELSE 'AMS' END
       AS source_system""",
    """CASE WHEN substr(props, 7, 1) < '5' THEN 'STB' WHEN substr(props, 7, 1) < '7' THEN 'TVE'
           WHEN substr(props, 7, 1) < '9' THEN 'OTT' END AS viewing_platform""",
    """CASE WHEN substr(props, 8, 1) = '}' THEN 'OTHER' WHEN substr(props, 8, 1) < '4' THEN 'LIVE'
           WHEN substr(props, 8, 1) < '6' THEN 'Vod' WHEN substr(props, 8, 1) < '8' THEN 'dvr'
           ELSE 'live' END AS channel_tune_type""",
    """CASE WHEN value < 5 THEN NULL WHEN value < 8 THEN 'na' WHEN value < 11 THEN 'Unknown'
           WHEN value < 13 THEN ' ' WHEN value < 15 THEN ''
           ELSE CAST(user_id AS VARCHAR(20)) END AS ban""",
    "CAST(user_id AS VARCHAR(20)) AS device_id",
    """nullif(props, '{"k": 50}') AS series_id""",
    "event_id AS client_id",
    "year(ts) * 1000000 + month(ts) * 10000 + day(ts) * 100 + hour(ts) AS program_watch_start_time_local",
]

# Accounts out of orders: daily partitions over six years, a nullable column.
ACCOUNT = [
    "o_orderdate AS data_dt",
    """CASE WHEN o_orderpriority < '3' THEN 'SATELLITE' WHEN o_orderpriority < '4' THEN 'CABLE'
           ELSE 'OTT' END AS business_line""",
    "CASE o_orderstatus WHEN 'F' THEN 'Active' WHEN 'O' THEN 'Suspended' ELSE 'Pending' END AS status",
    "nullif(o_orderpriority, '4-NOT SPECIFIED') AS service_level",
    "o_custkey AS ban",
    "o_orderkey AS account_key",
]

# Channels out of events: the event type is the status.
CHANNEL = [
    "ts AS data_dt",
    "'EVENTS' AS business_line",
    "event_type AS status",
    "props AS channel_name",
    "user_id AS channel_key",
]


def viewing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*VIEWING)


def account(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*ACCOUNT)


def channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*CHANNEL)


def as_sql(columns: list[str], source: str) -> str:
    """A stand-in's projection as a SQL query over the given table."""
    return f"SELECT {', '.join(columns)} FROM {source}"


# A table of the user's own, next to the known ones: lines by return flag.
LINES = Catalog([
    TableSpec(
        "LINEITEM", "l_shipdate",
        lambda line, mode, kind: Segment((Condition("l_returnflag", mode),)),
        ("LINES",),
    )
])


def quality_rules(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return _rules(spark, schemas.QUALITY_RULES, rows)


def total_rules(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return _rules(spark, schemas.TOTAL_RULES, rows)


def duplicate_rules(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return _rules(spark, schemas.DUPLICATE_RULES, rows)


def _rules(spark, layout, rows):
    names = layout.fieldNames()
    return local_frame(spark, [dict(zip(names, row)) for row in rows], layout)


# Rules over the viewing stand-in: all segment kinds, a repeated rule, a rule
# below the threshold, one of unknown priority and one without a priority.
VIEWING_RULES = [
    ("prod", "gold", "Viewership", "SATELLITE", "STB", "LIVE", "ban", "highPriorityColumn", "2"),
    ("prod", "gold", "Viewership", "SATELLITE", "STB", "LIVE", "ban", "highPriorityColumn", "2"),
    ("prod", "gold", "ev_viewing_history", "SATELLITE", "STB", "LIVE", "series_id", "HIGHpriorityColumn", "9"),
    ("prod", "gold", "EV_VIEWING_HISTORY", "SATELLITE", "STB", "VOD", "ban", None, None),
    ("prod", "gold", "viewership", "SATELLITE", "TVE", "LIVE", "device_id", "highPriorityColumn", "2"),
    ("prod", "gold", "viewership", "SATELLITE", "OTT", "LIVE", "device_id", "highPriorityColumn", "3"),
    ("prod", "gold", "viewership", "DTVNow", "OTT", "DVR", "ban", "highPriorityColumn", "1"),
    ("prod", "gold", "viewership", "Direct-Now", "TVE", "LIVE", "series_id", "highPriorityColumn", "1"),
    ("prod", "gold", "viewership", "CABLE", "STB", "live", "ban", "highPriorityColumn", "1"),
    ("prod", "gold", "viewership", "CABLE", "STB", "LIVE", "client_id", "highPriorityColumn", "4"),
    ("prod", "gold", "viewership", "CABLE", "STB", "LIVE", "ban", "lowPriorityColumn", "1"),
    ("prod", "gold", "viewership", "CABLE", "STB", "DVR", "ban", "someday", "1"),
]


def order_tree(spark: SparkSession, sf_dir: str) -> str:
    """Orders as a partition tree yr / status / load_dt in the shared scratch folder."""
    path = scratch_path(spark, "order-tree")
    orders = table(spark, sf_dir, "orders")
    orders.select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
        F.year("o_orderdate").alias("yr"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderpriority") < "3", "020").otherwise("19980102").alias("load_dt"),
    ).hint("rebalance", F.col("yr"), F.col("status")).write.partitionBy(
        "yr", "status", "load_dt"
    ).parquet(path)
    return path


# Values of a partition column below a kind of directory, two of each.
DIRECTORY_VALUES = {
    "short": ("1", "020"), "long": ("1", "12345678901"), "twenty": ("12345678901234567890", "7"),
    "date": ("1998-01-02", "1998-12-31"), "time": ("1998-01-02 03:04:05", "1998-01-02 00:00:00"),
    "mixed": ("1", "a b"), "fraction": ("0.5", "1"), "no date": ("1998-02-30", "1998-01-01"),
}


def typed_tree(spark: SparkSession, sf_dir: str) -> str:
    """Orders in a directory per kind of partition values, of which each holds half the orders."""
    path = scratch_path(spark, "typed-tree")
    pairs = [{"kind": k, "half": n, "value": v} for k, pair in DIRECTORY_VALUES.items() for n, v in enumerate(pair)]
    values = local_frame(spark, pairs, "kind string, half long, value string")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    halves = orders.withColumn("half", F.pmod("o_orderkey", F.lit(2)))
    halves.join(F.broadcast(values), "half").drop("half").write.partitionBy("kind", "value").parquet(path)
    return path


def mixed_schema_tree(spark: SparkSession, sf_dir: str) -> str:
    """Orders by status: one leaf as the reference, one reordered, the others re-typed."""
    path = scratch_path(spark, "schema-tree")
    for status, leaf in _leaves(spark, sf_dir):
        leaf.drop("load_dt").write.parquet(f"{path}/status={status}")
    return path


def mixed_load_tree(spark: SparkSession, sf_dir: str) -> str:
    """The same leaves, each in two loads."""
    path = scratch_path(spark, "mixed-loads")
    for status, leaf in _leaves(spark, sf_dir):
        leaf.write.partitionBy("load_dt").parquet(f"{path}/status={status}")
    return path


def _leaves(spark: SparkSession, sf_dir: str):
    orders = table(spark, sf_dir, "orders").withColumn("load_dt", F.col("o_orderkey") % 2)
    columns = {
        "F": ["o_orderkey", "o_custkey", "o_totalprice"],
        "O": ["o_custkey", "o_orderkey", "o_totalprice"],
    }
    retyped = ["o_orderkey", "CAST(o_custkey AS int) AS o_custkey", "o_totalprice"]
    for row in orders.select("o_orderstatus").distinct().orderBy("o_orderstatus").collect():
        status = row["o_orderstatus"]
        yield status, orders.where(F.col("o_orderstatus") == status).selectExpr(
            *columns.get(status, retyped), "load_dt"
        )
