"""Schemas of Parquet locations: one look at a footer per location, one read by Spark per distinct case.

What a location's schema is, only Spark's reader says. Tasks find each location's first file, and what
its schema and its directories have in common with those of other locations; one location of each kind is then read.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plumbline.session import local_frame, materialise
from plumbline.sources.listing import filesystem, listed, tasks_of
from plumbline.sources.tree import escaped, locations

# Tasks get this module's functions with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIELDS = "array<struct<position:int,name:string,type:string>>"

# Directory values that are alike to any reader that types them: short numbers, and dates that exist.
_ALIKE = [(re.compile(r"\d{1,9}"), "1"), (re.compile(r"\d{4}-(0[1-9]|1[0-2])-(0[1-9]|1\d|2[0-8])"), "2000-01-01")]


def nullable(dtype: T.DataType) -> T.DataType:
    """The type as a file scan reports it: everything nullable."""
    if isinstance(dtype, T.StructType):
        return T.StructType(
            [T.StructField(f.name, nullable(f.dataType), True, f.metadata) for f in dtype.fields]
        )
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(nullable(dtype.elementType), True)
    if isinstance(dtype, T.MapType):
        return T.MapType(nullable(dtype.keyType), nullable(dtype.valueType), True)
    return dtype


def field_list(schema: T.StructType) -> list[dict]:
    """A schema as comparable rows; equal lists mean equal schemas, order, case and type."""
    out = []
    for i, field in enumerate(nullable(schema).fields):
        text = field.dataType.simpleString()
        if isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType)):
            text = field.dataType.json()
        if field.metadata:
            text += " " + json.dumps(field.metadata, sort_keys=True)
        out.append({"position": i, "name": field.name, "type": text})
    return out


def signature(uri: str, opened: dict) -> str | None:
    """A digest of all that a file's footer says of its columns; None if it is not Parquet."""
    system, path = filesystem(uri, opened)
    try:
        footer = pq.read_metadata(path, filesystem=system)
    except pa.ArrowInvalid:
        return None  # Other read errors fail the task, which is tried again.
    columns = str(footer.schema).partition("\n")[2]  # the first line names an object in memory
    stored = sorted((footer.metadata or {}).items())
    return hashlib.sha256(repr((columns, stored)).encode()).hexdigest()


def with_signatures(files: DataFrame, column: str = "path") -> DataFrame:
    """The rows with the signature of the file each names, read by as many tasks as the cluster runs at once."""
    schema = T.StructType([*files.schema.fields, T.StructField("signature", T.StringType())])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            found = [uri and signature(uri, opened) for uri in batch.column(column).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], schema=out)

    return files.repartition(tasks_of(files.sparkSession), column).mapInArrow(run, schema)


def _alike(directory: str) -> str:
    """A directory's name with a value that stands for all that are typed alike."""
    name, equals, value = directory.partition("=")
    for pattern, example in _ALIKE:
        if equals and pattern.fullmatch(value):
            return f"{name}={example}"
    return directory


def _below(found: DataFrame) -> DataFrame:
    """(location, path, marks): the first file under each location, in path order, and a digest of the
    directories between. A location's own entries are spread over tasks."""
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                inside = [("", True)] if row["is_file"] else listed(row["path"], opened)
                rows += [(row["location"], row["path"], name, is_file) for name, is_file in inside]
            yield _batch(rows, ["location", "top", "entry", "is_file"], [pa.string()] * 3 + [pa.bool_()])

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                top, entry = row["top"], row["entry"]
                path = f"{top}/{entry}" if entry else top
                if row["is_file"]:
                    rows.append((row["location"], path, []))
                    continue
                first, marks = None, set()
                for below, is_file in listed(path, opened, recursive=True):
                    if is_file:
                        file = f"{path}/{below}"
                        first = file if first is None else min(first, file)
                        levels = [entry, *below.split("/")[:-1]]
                        marks.add("/".join(directory.partition("=")[0] for directory in levels))
                        marks.update(f"{n} {_alike(directory)}" for n, directory in enumerate(levels))
                if first:
                    rows.append((row["location"], first, sorted(marks)))
            yield _batch(rows, ["location", "path", "marks"], [pa.string(), pa.string(), pa.list_(pa.string())])

    tasks = tasks_of(found.sparkSession)
    inside = found.repartition(tasks, "path").mapInArrow(entries, "location string, top string, entry string, is_file boolean")
    seen = inside.repartition(tasks, "top", "entry").mapInArrow(walked, "location string, path string, marks array<string>")
    first = seen.groupBy("location").agg(F.min("path").alias("path"))
    marks = seen.select("location", F.explode("marks").alias("mark")).distinct().groupBy("location").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("mark")).alias("x"),
        F.bit_xor(F.xxhash64("mark", F.lit(1))).alias("y"))
    return first.join(marks, "location", "left").select("location", "path", F.struct("n", "x", "y").alias("marks"))


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(values, kind) for values, kind in zip(columns, types)], names)


def _read_schema(spark: SparkSession, path: str) -> list[dict] | None:
    """The fields that Spark's reader gives a location; None if it refuses the directories below."""
    try:
        return field_list(spark.read.parquet(escaped(path)).schema)
    except PySparkException as exc:
        if not (exc.getCondition() or "").startswith("CONFLICTING"):
            raise
        return None


def location_schemas(spark: SparkSession, root: str, depth: int, name_filter: str = "") -> DataFrame:
    """Schema per location ``depth`` levels under ``root`` as (location, fields), as Spark's reader gives it: of
    the first file in path order, and of the partition columns below the location.

    Fields are NULL where the first file is not Parquet or Spark finds the directories in conflict; a location
    without files has no row. One footer is read per location. Locations whose footers say the same, and whose directories
    have the same names and values of one kind, are read once by Spark for all of them; the number of such kinds, not of
    locations, is what the driver sees.
    """
    found = _below(locations(spark, root, depth, name_filter))
    found = with_signatures(found).select("location", "path", F.sha2(F.to_json(F.struct("signature", "marks")), 256).alias("kind"),
                                          F.col("signature").isNotNull().alias("readable"))
    found = materialise(found, "locations")
    kinds = found.where("readable").groupBy("kind").agg(F.min_by(F.struct("location", "path"), "location").alias("one"))
    schemas = [
        {"kind": row["kind"], "fields": _read_schema(spark, _readable(row["one"]))} for row in kinds.collect()
    ]
    schemas = local_frame(spark, schemas, f"kind string, fields {FIELDS}")
    return found.join(schemas, "kind", "left").select("location", "fields")


def _readable(one: T.Row) -> str:
    """A location as a path; one that is a file has no slash at its end."""
    return one["path"] if one["location"] == one["path"] + "/" else one["location"].rstrip("/")
