"""Directory listings by the tasks of a job, one level at a time."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import local_frame

# Tasks get this module's functions with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENTRIES = "path string, is_file boolean"


def filesystem(uri: str, opened: dict) -> tuple[pafs.FileSystem, str]:
    """File system and path of a Hadoop-style URI (which is not percent-encoded)."""
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem(), "/" + rest.lstrip("/")
    authority, _, path = rest.lstrip("/").partition("/")
    scheme = {"s3a": "s3", "s3n": "s3"}.get(scheme, scheme)
    key = (scheme, authority)
    if key not in opened:
        opened[key] = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    system, base = opened[key]
    return system, f"{base.rstrip('/')}/{path}"


def is_hidden(name: str) -> bool:
    """Whether a scan passes over an entry of this name."""
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def listed(uri: str, opened: dict, recursive: bool = False) -> list[tuple[str, bool]]:
    """(path below ``uri``, whether it is a file) of the entries of a directory that a scan looks at."""
    system, path = filesystem(uri, opened)
    found = []
    for entry in system.get_file_info(pafs.FileSelector(path, recursive=recursive)):
        below = entry.path[len(path.rstrip("/")) + 1:]
        if not any(map(is_hidden, below.split("/"))):
            found.append((below, entry.type == pafs.FileType.File))
    return found


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its scheme, as scans report it."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return hadoop.makeQualified(system.getUri(), system.getWorkingDirectory()).toString().rstrip("/")


def tasks_of(spark: SparkSession) -> int:
    """Tasks for work that touches a file or directory per row."""
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def children(directories: DataFrame) -> DataFrame:
    """(path, is_file) of the entries of directories, given as (path); only these directories are listed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: dict = {}
        for batch in batches:
            for uri in batch.column("path").to_pylist():
                found = listed(uri, opened)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{uri}/{name}" for name, _ in found], pa.string()),
                     pa.array([is_file for _, is_file in found], pa.bool_())], ["path", "is_file"])

    return directories.select("path").mapInArrow(run, ENTRIES)


def level(spark: SparkSession, root: str, depth: int, keep: Callable[[DataFrame, int], DataFrame]) -> DataFrame:
    """(path, is_file) of what lies ``depth`` levels below ``root``.

    ``keep`` narrows each level, given its number, before the next one is listed. Every level is
    spread over the cluster; nothing below the last is looked at.
    """
    entries = local_frame(spark, [{"path": qualified(spark, root), "is_file": False}], ENTRIES)
    for number in range(1, depth + 1):
        directories = entries.where(~F.col("is_file"))
        if number > 1:
            directories = directories.repartition(tasks_of(spark), "path")
        entries = keep(children(directories), number)
    return entries
