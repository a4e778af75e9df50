"""Partition trees, schema check and load merge."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline import sinks
from plumbline.functions.metrics import Run
from plumbline.operators import footers
from plumbline.operators.footers import field_list, location_schemas
from plumbline.plans import merge
from plumbline.plans import schema_check as sc
from plumbline.schemas import RESULT_TABLES
from plumbline.session import CHECKPOINT_DIR, local_frame, scratch_path
from plumbline.sources.tables import read_rows, register_view
from plumbline.sources import listing
from plumbline.sources.tree import locations


@pytest.fixture
def root(spark, tmp_path):
    return str(tmp_path / "table")


def write(spark, path, *columns):
    spark.range(4).selectExpr(*columns).coalesce(1).write.parquet(path)


GOOD = ("id", "CAST(id AS string) AS name", "named_struct('a', 1, 'b', array('x')) AS nested")


def statuses(spark, root, depth=1, **options):
    reference = spark.read.parquet(f"{root}/d=20240101").schema
    checked = sc.schema_check(spark, reference, root, depth, **options)
    return {os.path.basename(r.location.rstrip("/")): r.schema_status for r in checked.collect()}


def test_schema_check_is_exact(spark, root):
    write(spark, f"{root}/d=20240101", *GOOD)
    write(spark, f"{root}/d=same", *GOOD)
    write(spark, f"{root}/d=order", GOOD[1], GOOD[0], GOOD[2])
    write(spark, f"{root}/d=case", "id AS ID", *GOOD[1:])
    write(spark, f"{root}/d=extra", *GOOD, "1 AS more")
    write(spark, f"{root}/d=missing", *GOOD[:2])
    write(spark, f"{root}/d=type", "CAST(id AS int) AS id", *GOOD[1:])
    write(spark, f"{root}/d=nested", *GOOD[:2], "named_struct('b', array('x'), 'a', 1) AS nested")
    write(spark, f"{root}/d=__HIVE_DEFAULT_PARTITION__", "1 AS other")
    assert statuses(spark, root) == {
        "d=20240101": "Correct", "d=same": "Correct", "d=order": "Wrong", "d=case": "Wrong",
        "d=extra": "Wrong", "d=missing": "Wrong", "d=type": "Wrong", "d=nested": "Wrong",
    }
    reference = spark.read.parquet(f"{root}/d=20240101").schema
    checked = sc.schema_check(spark, reference, root, 1)
    assert sc.failed_schemas(checked).head().failed == 6
    different = sc.schema_differences(spark, reference, root, 1).where("location LIKE '%d=type/'").collect()
    assert {(r.side, r.position, r.name, r.type) for r in different} == {
        ("location", 0, "id", "int"), ("reference", 0, "id", "bigint")
    }


def test_single_files_are_locations_too(spark, root):
    write(spark, f"{root}/d=20240101", *GOOD)
    write(spark, f"{root}/d=20240102", *GOOD[:1])
    reference = spark.read.parquet(f"{root}/d=20240101").schema
    got = sc.schema_check(spark, reference, root, 2).collect()
    assert sorted(r.schema_status for r in got) == ["Correct", "Wrong"]
    assert all(r.location.endswith(".parquet/") for r in got)


def test_a_file_that_is_not_parquet_is_wrong(spark, root):
    write(spark, f"{root}/d=20240101", *GOOD)
    os.makedirs(f"{root}/d=broken")
    with open(f"{root}/d=broken/part-0.parquet", "w") as out:
        out.write("not a footer")
    assert statuses(spark, root) == {"d=20240101": "Correct", "d=broken": "Wrong"}


def test_directories_take_their_first_file_and_partition_columns(spark, root):
    """The check agrees with the session's own reader at every depth."""
    for day, load, value in (
        ("20240101", "1", "x"), ("20240101", "99999999999", "y"), ("20240102", "007", "2024-01-05"),
        ("20240103", "a b", "1.5"), ("20240104", "2024-01-05 01:02:03", "z"),
    ):
        spark.range(3).selectExpr("id", "id AS v").withColumn("load", F.lit(load)).withColumn(
            "value", F.lit(value)
        ).write.mode("append").partitionBy("load", "value").parquet(f"{root}/day={day}")
    spark.range(3).selectExpr("CAST(id AS int) AS id").write.mode("append").parquet(f"{root}/day=20240105/load=2/value=q")
    for depth in (1, 2, 3):
        found = location_schemas(spark, root, depth).collect()
        assert len(found) == {1: 5, 2: 6, 3: 6}[depth]
        for row in found:
            own = field_list(spark.read.parquet(row.location).schema)
            assert [(f.position, f.name, f.type) for f in row.fields] == [
                (f["position"], f["name"], f["type"]) for f in own
            ]


@pytest.mark.parametrize("values", [
    ("12345678901234567890", "7"), ("12345678901234567890", "x"), ("2024-01-05", "2024-02-30"), ("2024-01-05", "2024-01-29"),
    ("2024-01-05", "2024-01-05 01:02:03"), ("2024-01-05T01:02:03", "1"), ("1.5", "12345678901"), ("+7", "1"), ("1e3", "2"),
    ("a%b", "c:d"), ("1234567890", "9"), ("123456789", "-5"), ("", "3"), ("true", "false"),
])
def test_directory_values_are_typed_by_the_reader(spark, root, values):
    for place, value in enumerate(values):
        spark.range(2).withColumn("k", F.lit(value)).write.mode("append").partitionBy("k").parquet(f"{root}/day=1")
        spark.range(2).withColumn("k", F.lit(value)).write.partitionBy("k").parquet(f"{root}/day={place + 2}")
    for row in location_schemas(spark, root, 1).collect():
        own = field_list(spark.read.parquet(row.location).schema)
        assert [f.asDict() for f in row.fields] == own, row.location


def test_a_read_per_kind_not_per_location(spark, root, monkeypatch):
    rows = spark.range(400).selectExpr("id", "id DIV 4 AS day", "20240000 + id AS load", "id % 2 AS part")
    rows.repartition(1).write.partitionBy("day", "load", "part").parquet(root)
    reads = []
    own = footers._read_schema
    monkeypatch.setattr(footers, "_read_schema", lambda spark, path: reads.append(path) or own(spark, path))
    assert location_schemas(spark, root, 1).where("fields IS NOT NULL").count() == 100
    assert len(reads) == 1
    write(spark, f"{root}/day=x/load=5/part=0", "CAST(id AS int) AS id")
    assert location_schemas(spark, root, 1).where("fields IS NOT NULL").count() == 101
    assert len(reads) == 3


def test_directories_in_conflict_are_wrong(spark, root):
    write(spark, f"{root}/d=20240101", *GOOD)
    write(spark, f"{root}/d=bad/k=1", *GOOD)
    write(spark, f"{root}/d=bad/j=1", *GOOD)
    os.makedirs(f"{root}/d=empty/k=1")
    assert statuses(spark, root) == {"d=20240101": "Correct", "d=bad": "Wrong"}


def test_levels_below_a_location_are_not_listed(spark, root, monkeypatch):
    for day in range(3):
        for load in range(3):
            write(spark, f"{root}/d={day}/l={load}/x=1/y=2", "id")

    def guarded(uri, opened, recursive=False, inside=listing.listed, top=root):
        if recursive or uri.split(":", 1)[1].count("/") > top.count("/") + guarded.depth - 1:
            raise AssertionError(f"looked into {uri}")
        return inside(uri, opened, recursive)

    monkeypatch.setattr(listing, "listed", guarded)
    for guarded.depth, found in ((1, 3), (2, 9)):
        monkeypatch.setattr(listing, "listed", guarded)
        assert locations(spark, root, guarded.depth).count() == found
        plan = locations(spark, root, guarded.depth)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("MapInArrow") == guarded.depth and "binaryFile" not in plan
    guarded.depth = 1
    with pytest.raises(Exception, match="looked into"):
        locations(spark, root, 2).count()
    # A filter narrows a level before the next one is listed.
    assert locations(spark, root, 1, "d=1").count() == 1


def test_files_of_other_writers(spark, root):
    os.makedirs(f"{root}/d=1")
    table = pa.table({
        "i8": pa.array([1], pa.int8()), "u8": pa.array([1], pa.uint8()), "u16": pa.array([1], pa.uint16()),
        "u32": pa.array([1], pa.uint32()), "u64": pa.array([1], pa.uint64()), "f": pa.array([1.0], pa.float32()),
        "dec": pa.array([None], pa.decimal128(12, 3)), "day": pa.array([1], pa.date32()),
        "at": pa.array([1], pa.timestamp("us", "UTC")), "local": pa.array([1], pa.timestamp("ms")),
        "bin": pa.array([b"x"], pa.binary()), "fixed": pa.array([b"xy"], pa.binary(2)),
        "big": pa.array(["x"], pa.large_string()), "dict": pa.array(["x"]).dictionary_encode(),
        "took": pa.array([1], pa.duration("us")), "list": pa.array([[1]], pa.list_(pa.int32())),
        "map": pa.array([[("a", 1)]], pa.map_(pa.string(), pa.int64())),
        "nest": pa.array([{"a": 1, "b": ["x"]}], pa.struct([("a", pa.int16()), ("b", pa.list_(pa.string()))])),
        "flag": pa.array([True]),
    })
    pq.write_table(table, f"{root}/d=1/x.parquet")
    row = location_schemas(spark, root, 1).head()
    own = field_list(spark.read.parquet(f"{root}/d=1").schema)
    assert [(f.name, f.type) for f in row.fields] == [(f["name"], f["type"]) for f in own]


def test_old_timestamps_of_other_writers(spark, root):
    os.makedirs(f"{root}/d=1")
    pq.write_table(
        pa.table({"t": pa.array([1], pa.timestamp("ns"))}), f"{root}/d=1/x.parquet",
        use_deprecated_int96_timestamps=True,
    )
    row = location_schemas(spark, root, 1).head()
    assert row.fields[0].type == spark.read.parquet(f"{root}/d=1").schema["t"].dataType.simpleString()


def test_paths(spark, root):
    for place in ("d=2018/b=x/l=1", "d=2018/b=y/l=2", "d=2019/b=2018/l=1"):
        write(spark, f"{root}/{place}", "id")

    def found(depth, name_filter="", base=root):
        rows = locations(spark, base, depth, name_filter).collect()
        return sorted(r.location.split("/table/")[1] for r in rows if r.is_file == r.location.endswith(".parquet/"))

    assert found(1) == ["d=2018/", "d=2019/"]
    # The filter applies to the first level only.
    assert found(2, "2018") == ["d=2018/b=x/", "d=2018/b=y/"]
    assert found(3) == ["d=2018/b=x/l=1/", "d=2018/b=y/l=2/", "d=2019/b=2018/l=1/"]
    assert found(2, "d=2019/") == ["d=2019/b=2018/"]
    assert found(1, "nothing") == found(6) == []
    with pytest.raises(ValueError, match="one level"):
        found(0)
    write(spark, f"{root}/d=2020/a=1/b=2/c=3/e=4/f=5/g=6", "id")
    assert found(7) == ["d=2020/a=1/b=2/c=3/e=4/f=5/g=6/"]
    assert found(6)[0] == "d=2020/a=1/b=2/c=3/e=4/f=5/"
    # It is tested on the whole path, so a filter the base holds lets everything pass.
    assert found(1, "table") == found(1)
    assert found(1, "2018", "file:" + root + "/") == ["d=2018/"]
    # Files above the depth belong to no location.
    assert found(9) == []


TREE = [
    # id, day, line, load_dt
    (1, "20240101", "A", "20240102"), (2, "20240101", "A", "20240105"), (3, "20240101", "A", None),
    (4, "20240101", "B", "020"), (5, "20240102", "A", "20240103"), (6, None, "A", "20240103"),
    (7, "007", "A", "1"),
]


@pytest.fixture
def tree(spark, root):
    rows = spark.createDataFrame(TREE, "id int, day string, line string, load_dt string")
    rows.write.partitionBy("day", "line", "load_dt").parquet(root)
    return root


def leaf_rows(frame):
    return sorted((r.id, r.day, r.line, r.load_dt) for r in frame.collect()) if frame else []


def key(row):
    return tuple(str(x) for x in row)


@pytest.mark.parametrize("compact", [True, False])
def test_merge(spark, tree, tmp_path, compact):
    out = str(tmp_path / "out")
    for _ in range(2):
        merge.merge_loads(spark, tree, out, ["day", "line"], compact=compact)
        got = sorted([tuple(r) for r in merge.read_loads(spark, out).select("id", "day", "line", "load_dt").collect()], key=key)
        # Text stays text: leading zeros survive, and so do NULL days and loads.
        assert got == sorted([(i, d, l, "99999999") for i, d, l, _ in TREE], key=key)
    assert spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"
    agreed = merge.reconcile_merge(
        merge.read_loads(spark, tree), merge.read_loads(spark, out), ["day", "line"]
    ).collect()
    assert len(agreed) == 5 and all(r.complete for r in agreed)
    files = merge.written_files(spark, out).collect()
    assert sum(r.rows for r in files) == len(TREE) and all(r.bytes > 0 for r in files)


def test_merge_in_place_twice(spark, tree):
    for _ in range(2):
        merge.merge_loads(spark, tree, tree, ["day", "line"])
        rows = merge.read_loads(spark, tree)
        assert rows.count() == 2 * len(TREE)
        assert all(r.complete for r in merge.reconcile_merge(rows, rows, ["day", "line"]).collect())


def test_merge_of_filtered_days(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    merge.merge_loads(spark, tree, out, ["day", "line"], name_filter="20240101")
    assert sorted(r.id for r in merge.read_loads(spark, out).collect()) == [1, 2, 3, 4]
    short = merge.reconcile_merge(merge.read_loads(spark, tree), merge.read_loads(spark, out), ["day", "line"])
    assert {(r.day, r.complete) for r in short.collect()} == {
        ("20240101", True), ("20240102", False), (None, False), ("007", False)
    }


def test_merge_replaces_only_its_own_partitions(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    merge.merge_loads(spark, tree, out, ["day", "line"], name_filter="20240101")
    merge.merge_loads(spark, tree, out, ["day", "line"], name_filter="20240102")
    assert sorted(r.id for r in merge.read_loads(spark, out).collect()) == [1, 2, 3, 4, 5]


def test_columns_of_some_loads_are_kept(spark, root, tmp_path):
    write(spark, f"{root}/day=1/load_dt=1", "id")
    write(spark, f"{root}/day=1/load_dt=2", "id", "id * 2 AS later")
    merge.merge_loads(spark, root, str(tmp_path / "out"), ["day"])
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.columns == ["id", "later", "day", "load_dt"]
    assert got.where("later IS NULL").count() == got.where("later = id * 2").count() == 4


def test_leaves_keep_their_own_schemas(spark, root, tmp_path):
    write(spark, f"{root}/day=1/load_dt=1", "id", "id AS x")
    write(spark, f"{root}/day=2/load_dt=1", "id", "CAST(id AS int) AS x")
    write(spark, f"{root}/day=3/load_dt=1", "id", "CAST(id AS string) AS x", "id AS own")
    write(spark, f"{root}/day=__HIVE_DEFAULT_PARTITION__/load_dt=1", "id")
    out = str(tmp_path / "out")
    merge.merge_loads(spark, root, out, ["day"])

    def merged(day):
        return spark.read.parquet(f"{out}/day={day}/load_dt=99999999").dtypes

    assert merged(1) == [("id", "bigint"), ("x", "bigint")]
    assert merged(2) == [("id", "bigint"), ("x", "int")]
    assert merged(3) == [("id", "bigint"), ("x", "string"), ("own", "bigint")]
    assert merged("__HIVE_DEFAULT_PARTITION__") == [("id", "bigint")]
    assert merge.reconcile_leaves(spark, root, out, ["day"]).where("complete").count() == 4


def test_loads_that_exclude_each_other_stop_only_their_leaf(spark, root, tmp_path):
    write(spark, f"{root}/day=1/load_dt=1", "id")
    write(spark, f"{root}/day=2/load_dt=1", "id", "id AS x")
    write(spark, f"{root}/day=2/load_dt=2", "id", "CAST(id AS string) AS x")
    out = str(tmp_path / "out")
    with pytest.raises(ValueError, match="day=2"):
        merge.merge_loads(spark, root, out, ["day"])
    assert spark.read.parquet(out).select("day").distinct().count() == 1


def test_thousands_of_leaves_stay_a_table(spark, root, tmp_path):
    """Leaves of three kinds: the driver gets a row per kind, and each kind is read in its own partitions only."""
    os.makedirs(root)
    tables = {
        0: pa.table({"id": [1], "x": [1]}), 1: pa.table({"id": [1], "x": ["a"]}), 2: pa.table({"id": [1]}),
    }
    for leaf in range(2000):
        os.makedirs(f"{root}/day={leaf // 50:03d}/line={leaf % 50}/load_dt=1")
        pq.write_table(tables[leaf % 3 if leaf % 100 == 0 else 0], f"{root}/day={leaf // 50:03d}/line={leaf % 50}/load_dt=1/x.parquet")
    found = merge.group_leaves(spark, root, ["day", "line"])
    assert len(found.samples) == 3 and all(len(files) == 1 for files in found.samples.values())
    assert found.leaves.count() == found.leaves.distinct().count() == 2000
    out = str(tmp_path / "out")
    merge.merge_loads(spark, root, out, ["day", "line"], compact=False)
    checked = merge.reconcile_leaves(spark, root, out, ["day", "line"])
    assert checked.where("complete").count() == 2000
    kinds = {
        str(spark.read.parquet(f"{out}/day={leaf // 50:03d}/line=0").select("id", *(["x"] if leaf % 3 < 2 else [])).dtypes)
        for leaf in (0, 100, 200)
    }
    assert len(kinds) == 3


def test_a_group_reads_its_own_partitions(spark, root):
    write(spark, f"{root}/day=1/load_dt=1", "id AS x")
    write(spark, f"{root}/day=2/load_dt=1", "CAST(id AS string) AS x")
    found = merge.group_leaves(spark, root, ["day"])
    assert len(found.samples) == 2
    for group, files in found.samples.items():
        schema = merge.merged_schema(spark, files, ["day", "load_dt"])
        rows = merge.read_group(spark, root, schema, found.leaves.where(F.col("group") == group).select("leaf"), ["day"])
        assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString()
        assert rows.select("day").distinct().count() == 1 and rows.count() == 4


def test_loads_of_one_schema_need_no_table_of_leaves(spark, tree):
    found = merge.group_leaves(spark, tree, ["day", "line"])
    assert found.leaves is None and len(found.samples) == 1
    assert merge.group_leaves(spark, tree, ["day", "line"], name_filter="nothing").samples == {}


def test_counts_come_from_footers(spark, tree, tmp_path):
    counts = merge.partition_counts(spark, tree, ["day", "line", "load_dt"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan
    assert {tuple(r) for r in counts.collect()} == {(d, line, load, 1) for _, d, line, load in TREE}
    out = str(tmp_path / "out")
    merge.merge_loads(spark, tree, out, ["day", "line"])
    checked = merge.reconcile_leaves(spark, tree, out, ["day", "line"])
    assert checked.columns == ["day", "line", "load_rows", "merged_rows", "complete"]
    assert checked.where("complete").count() == 5
    # A leaf that is short of a row fails.
    spark.createDataFrame([(9, "007", "A", "2")], "id int, day string, line string, load_dt string").write.mode(
        "append").partitionBy("day", "line", "load_dt").parquet(tree)
    short = merge.reconcile_leaves(spark, tree, out, ["day", "line"]).where("NOT complete").collect()
    assert [tuple(r) for r in short] == [("007", "A", 2, 1, False)]


def test_publish_outcomes(spark, tree, tmp_path):
    out = str(tmp_path / "out")
    assert merge.files_now(spark, out).count() == 0

    def outcomes(**options):
        before = merge.files_now(spark, out)
        merge.merge_loads(spark, tree, out, ["day", "line"], **options)
        found = merge.publish_outcomes(before, merge.files_now(spark, out))
        return {(r.outcome, r.file.split("/out/")[1].split("/")[0]): r.n for r in found.groupBy("outcome", "file").agg(
            F.sum("rows").alias("n")).collect() if r.n}

    assert {o for o, _ in outcomes()} == {"written"}
    again = outcomes(name_filter="day=20240101")
    assert {day for o, day in again if o == "written"} == {day for o, day in again if o == "replaced"} == {"day=20240101"}
    assert {day for o, day in again if o == "kept"} == {"day=20240102", "day=007", "day=__HIVE_DEFAULT_PARTITION__"}


def test_a_hot_leaf_is_written_by_many_tasks(spark, root, tmp_path):
    rows = spark.range(200000).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") < 150000, "hot").otherwise((F.col("id") % 5).cast("string")).alias("day"),
        (F.col("id") % 3).cast("string").alias("load_dt"),
    )
    rows.write.partitionBy("day", "load_dt").parquet(root)
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    session.conf.set("spark.sql.shuffle.partitions", "8")
    merge.merge_loads(session, root, str(tmp_path / "out"), ["day"])
    files = merge.written_files(spark, str(tmp_path / "out")).collect()
    assert sum(r.rows for r in files) == 200000
    assert sum("/day=hot/" in r.file for r in files) > 1


def test_result_tables(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS results")
    for _ in range(2):
        sinks.create_result_tables(spark, "results")
    for name, (schema, partition) in RESULT_TABLES.items():
        table = spark.table(f"results.{name}")
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in schema]
        parts = [c.name for c in spark.catalog.listColumns(f"results.{name}") if c.isPartition]
        assert parts == ([partition] if partition else [])


def test_store_into_tables(spark, root, run):
    spark.sql("CREATE DATABASE IF NOT EXISTS kept")
    sinks.create_result_tables(spark, "kept")
    write(spark, f"{root}/d=20240101", *GOOD)
    reference = spark.read.parquet(f"{root}/d=20240101").schema
    later = Run(run.started + dt.timedelta(hours=1))
    for one in (run, run, later):  # a run that is stored again adds nothing
        sinks.store_schema_check(sc.schema_check(spark, reference, root, 1, run=one), "kept.schema_check")
    assert sorted(tuple(r)[::2] for r in spark.table("kept.schema_check").collect()) == [
        ("Correct", 20240201060000), ("Correct", 20240201070000)]
    write(spark, f"{root}/d=20240102", *GOOD)
    sinks.store_schema_check(sc.schema_check(spark, reference, root, 1, run=run), "kept.schema_check")
    assert spark.table("kept.schema_check").where("log_time = 20240201060000").count() == 2


def test_views_and_paths(spark, root):
    write(spark, root, "id")
    assert register_view(spark, root, "some_rows").count() == read_rows(spark, "some_rows").count() == 4
    assert read_rows(spark, root).count() == 4


def test_scratch_is_the_shared_folder(spark, monkeypatch):
    assert scratch_path(spark, "x").startswith(spark.conf.get(CHECKPOINT_DIR))


def test_small_relations_have_a_known_size(spark):
    frame = local_frame(spark, [{"a": 1, "b": None}], "a int, b string")
    assert "LocalTableScan" in frame._jdf.queryExecution().executedPlan().toString()
    assert local_frame(spark, [], T.StructType([T.StructField("a", T.IntegerType())])).count() == 0
