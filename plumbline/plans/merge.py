"""Merging of load partitions: many late loads of a leaf become one partition."""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.operators.counts import compare_counts
from plumbline.operators.footers import with_signatures
from plumbline.session import discard, materialise, metadata_session, session_with
from plumbline.sources.tree import escaped, first_level_pattern

# The load column and the constant load of merged rows.
LOAD_COLUMN = "load_dt"
MERGED_LOAD = "99999999"

# Groups of leaves that are merged at the same time, and leaves that an error names.
JOBS_AT_ONCE, NAMED_LEAVES = 4, 20

# Outcomes of a write for a file.
WRITTEN, REPLACED, KEPT = "written", "replaced", "kept"


def _text_partitions(spark: SparkSession) -> SparkSession:
    """Number-like partition values would otherwise lose leading zeros on their way through."""
    return session_with(spark, spark__sql__sources__partitionColumnTypeInference__enabled="false")


def read_loads(spark: SparkSession, path: str, name_filter: str = "") -> DataFrame:
    """All rows of a partition tree, with partition values as text.

    Columns that only some partitions have are kept and NULL elsewhere.
    """
    reader = _text_partitions(spark).read.option("basePath", path).option("mergeSchema", "true")
    return reader.parquet(first_level_pattern(path, name_filter))


def _files(spark: SparkSession, path: str, columns: Sequence[str], name_filter: str) -> DataFrame:
    """Files of a tree as (path, columns), with the partition values as text that Spark finds in their paths."""
    reader = _text_partitions(metadata_session(spark)).read.format("binaryFile").option("basePath", path)
    pattern = first_level_pattern(path, name_filter)
    try:
        files = reader.load(pattern)
    except AnalysisException as exc:
        if pattern == path.rstrip("/") or exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], ", ".join(f"`{name}` string" for name in ["path", *columns]))
    return files.select("path", *[F.col(column).cast("string").alias(column) for column in columns])


def _leaf_key(columns: Sequence[str]) -> Column:
    """One value per leaf, never NULL."""
    return F.to_json(F.struct(*columns))


@dataclass(frozen=True)
class LeafGroups:
    """Leaves by the schemas of their loads: (group, leaf), one row per leaf, and of each group a file per schema.

    Where all loads have one schema there is one group, and no table of leaves is needed.
    """

    leaves: DataFrame | None
    samples: dict[str, list[str]]


def group_leaves(spark: SparkSession, path: str, partition_columns: Sequence[str], *,
                 load_column: str = LOAD_COLUMN, merged_load: str = MERGED_LOAD, name_filter: str = "") -> LeafGroups:
    """Groups of leaves whose loads have the same schemas, from the footer of each load's first file.

    The leaves stay a table; the driver sees a row per group.
    """
    files = _files(spark, path, [*partition_columns, load_column], name_filter)
    files = files.where(~F.col(load_column).eqNullSafe(F.lit(merged_load)))
    key = _leaf_key(partition_columns).alias("leaf")
    loads = files.groupBy(key, load_column).agg(F.min("path").alias("path")).select("leaf", "path")
    loads = materialise(with_signatures(loads).fillna("unreadable", ["signature"]), "loads")
    schemas = loads.groupBy("signature").agg(F.min("path").alias("path")).limit(2).collect()
    if len(schemas) < 2:
        discard(loads)
        return LeafGroups(None, {row["signature"]: [row["path"]] for row in schemas})
    leaves = loads.groupBy("leaf").agg(F.sort_array(F.collect_set("signature")).alias("signatures"))
    leaves = leaves.select(F.sha2(F.to_json("signatures"), 256).alias("group"), "leaf")
    leaves = materialise(leaves.hint("rebalance"), "leaves")
    # A group has few signatures, however many leaves and loads share them.
    one_of_each = loads.join(leaves, "leaf").groupBy("group", "signature").agg(F.min("path").alias("path"))
    samples = one_of_each.groupBy("group").agg(F.sort_array(F.collect_list("path")).alias("paths")).collect()
    discard(loads)
    return LeafGroups(leaves, {row["group"]: row["paths"] for row in samples})


def merged_schema(spark: SparkSession, files: Sequence[str], partition_columns: Sequence[str]) -> T.StructType:
    """All columns of some files, as Spark merges them, with partition columns as text."""
    schema = spark.read.option("mergeSchema", "true").parquet(*map(escaped, files)).schema
    named = {name.lower() for name in partition_columns}
    return T.StructType(
        [field for field in schema.fields if field.name.lower() not in named]
        + [T.StructField(name, T.StringType()) for name in partition_columns]
    )


def read_group(spark: SparkSession, path: str, schema: T.StructType, leaves: DataFrame | None,
               partition_columns: Sequence[str], name_filter: str = "") -> DataFrame:
    """Rows of the leaves in a table of (leaf), or of all leaves, of a tree.

    The tree is read with the group's schema, and only in the partitions of the group: the leaves are broadcast to
    the join, whose keys prune the scan before a file is opened.
    """
    session = session_with(
        spark, spark__sql__optimizer__dynamicPartitionPruning__enabled="true", spark__sql__exchange__reuse="true")
    rows = session.read.schema(schema).option("basePath", path).parquet(first_level_pattern(path, name_filter))
    if leaves is None:
        return rows
    return rows.join(F.broadcast(leaves), _leaf_key(partition_columns) == F.col("leaf"), "left_semi")


def _excluding(exc: Exception) -> bool:
    """Whether Spark refused to merge schemas."""
    source = getattr(exc, "java_exception", exc)
    condition = getattr(source, "getCondition", None)
    return condition is not None and (condition() or "").startswith("CANNOT_MERGE")


def merge_loads(spark: SparkSession, input_path: str, output_path: str,
                partition_columns: Sequence[str], *, load_column: str = LOAD_COLUMN,
                merged_load: str = MERGED_LOAD, name_filter: str = "",
                compact: bool = True) -> None:
    """Write every leaf's loads under ``input_path`` as one merged partition of ``output_path``.

    Leaves whose loads have the same schemas are written by one job, so that leaves may differ
    in columns and types, and none gets a column that its loads lack. The jobs run side by side. Loads of one
    leaf that cannot be read together are an error, which is raised after all other leaves are merged.

    Rows merged by an earlier run are not read again, so a re-run gives the same
    result, also when both paths are the same. Only the merged partitions
    written here are replaced, when the job that writes them commits.

    With ``compact`` rows are rebalanced by leaf first: small loads end in few
    files, and a leaf that holds much of the data is split over many tasks.
    Without it nothing is shuffled, and each task writes the leaves it read.
    """
    found = group_leaves(spark, input_path, partition_columns, load_column=load_column,
                         merged_load=merged_load, name_filter=name_filter)
    columns = [*partition_columns, load_column]

    def merge(group: str) -> str | None:
        """The group, if its loads exclude each other."""
        try:
            schema = merged_schema(spark, found.samples[group], columns)
        except (PySparkException, Py4JJavaError) as exc:
            if not _excluding(exc):
                raise
            return group
        only = found.leaves.where(F.col("group") == group).select("leaf") if found.leaves is not None else None
        rows = read_group(spark, input_path, schema, only, partition_columns, name_filter)
        _merge_leaves(rows, output_path, partition_columns, load_column, merged_load, compact)
        return None

    with ThreadPoolExecutor(max(1, min(len(found.samples), JOBS_AT_ONCE))) as jobs:
        failed = [group for group in jobs.map(merge, found.samples) if group]
    if failed:
        leaves = found.leaves.where(F.col("group").isin(failed))
        some = [
            "/".join(f"{name}={value}" for name, value in json.loads(row["leaf"]).items())
            for row in leaves.orderBy("leaf").limit(NAMED_LEAVES).collect()
        ]
        raise ValueError(f"the loads of {leaves.count()} leaves have schemas that exclude each other: {', '.join(some)}")
    if found.leaves is not None:
        discard(found.leaves)


def _merge_leaves(rows: DataFrame, output_path: str, partition_columns: Sequence[str], load_column: str,
                  merged_load: str, compact: bool) -> None:
    # NULL loads (the default partition) are loads like any other.
    rows = rows.where(~F.col(load_column).eqNullSafe(F.lit(merged_load)))
    rows = rows.drop(load_column).withColumn(load_column, F.lit(merged_load))
    if compact:
        rows = rows.hint("rebalance", *[F.col(c) for c in partition_columns])
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_columns, load_column).parquet(output_path)
    )


def written_files(spark: SparkSession, path: str, name_filter: str = "") -> DataFrame:
    """What a write left behind: rows and bytes per file, from file metadata alone."""
    reader = metadata_session(spark).read.option("basePath", path)
    rows = reader.parquet(first_level_pattern(path, name_filter))
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")
    ).groupBy("file", "bytes").agg(F.count("*").alias("rows"))


def files_now(spark: SparkSession, path: str, name_filter: str = "") -> DataFrame:
    """``written_files`` of a path as it is now, which later writes do not change; none where there is no such path."""
    try:
        found = written_files(spark, path, name_filter)
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([], "file string, bytes long, rows long")
    return materialise(found, "files")


def publish_outcomes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What a write did to each file, as (file, bytes, rows, outcome), from ``files_now`` before and after it.

    A file is written (new, or of another size), replaced (gone) or kept. Files are told apart by path and
    size; a writer names its files anew, so one that it left alone is the same file.
    """
    key = ["file", "bytes"]
    old, new = before.withColumn("was", F.lit(True)), after.withColumn("is", F.lit(True))
    met = old.withColumnRenamed("rows", "old_rows").join(new, key, "full")
    outcome = F.when(F.col("was").isNull(), WRITTEN).when(F.col("is").isNull(), REPLACED).otherwise(KEPT)
    return met.select(*key, F.coalesce("rows", "old_rows").alias("rows"), outcome.alias("outcome"))


def partition_counts(spark: SparkSession, path: str, columns: Sequence[str], name_filter: str = "") -> DataFrame:
    """Rows per combination of partition values (as text), as ``n``, from footers alone: the count is pushed down to the
    scan, which reads no row."""
    sources = spark.conf.get("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,parquet,text")
    session = session_with(
        _text_partitions(spark), spark__sql__parquet__aggregatePushdown="true",
        spark__sql__sources__useV1SourceList=",".join(name for name in sources.split(",") if name != "parquet"))
    rows = session.read.option("basePath", path).parquet(first_level_pattern(path, name_filter))
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def reconcile_leaves(spark: SparkSession, input_path: str, output_path: str,
                     partition_columns: Sequence[str], *, load_column: str = LOAD_COLUMN,
                     merged_load: str = MERGED_LOAD, name_filter: str = "") -> DataFrame:
    """Rows per leaf before and after a merge, of the leaves that have loads in the input, from footers alone.

    What the output holds of other leaves is none of this merge's business.
    """
    is_merged = F.col(load_column).cast("string").eqNullSafe(F.lit(merged_load))
    nothing = F.lit(0).cast("long")
    sides = []
    for path, test, mine, other in (
        (input_path, ~is_merged, "load_rows", "merged_rows"), (output_path, is_merged, "merged_rows", "load_rows"),
    ):
        counted = partition_counts(spark, path, [*partition_columns, load_column], name_filter)
        values = [F.col(column).cast("string").alias(column) for column in partition_columns]
        sides.append(counted.where(test).select(*values, F.col("n").alias(mine), nothing.alias(other)))
    met = sides[0].unionByName(sides[1]).groupBy(*partition_columns).agg(
        F.sum("load_rows").alias("load_rows"), F.sum("merged_rows").alias("merged_rows"))
    return met.where("load_rows > 0").withColumn("complete", F.col("load_rows") == F.col("merged_rows"))


def reconcile_merge(loads: DataFrame, merged: DataFrame, partition_columns: Sequence[str], *,
                    load_column: str = LOAD_COLUMN, merged_load: str = MERGED_LOAD) -> DataFrame:
    """Rows per leaf before and after a merge, and whether they agree.

    Both frames may be the same tree: loads and merged rows are told apart by
    the load column.
    """
    is_merged = F.col(load_column).cast("string").eqNullSafe(F.lit(merged_load))
    compared = compare_counts(loads.where(~is_merged), merged.where(is_merged), partition_columns)
    return compared.select(
        *partition_columns,
        F.col("left_count").alias("load_rows"),
        F.col("right_count").alias("merged_rows"),
        (F.col("difference") == 0).alias("complete"),
    )
