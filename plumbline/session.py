"""Session helpers: small plan-side relations and shared scratch space."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

CHECKPOINT_DIR = "spark.checkpoint.dir"


def local_frame(spark: SparkSession, rows: list[dict], schema: str | StructType) -> DataFrame:
    """Driver-side configuration rows as a relation of known size.

    Because its size is known, Catalyst broadcasts it only when it is under the
    broadcast threshold and shuffles it otherwise; no hint is needed.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return spark.createDataFrame(pa.Table.from_pylist(rows, to_arrow_schema(schema)), schema)


def session_with(spark: SparkSession, **settings: str) -> SparkSession:
    """A session like the given one with some settings changed, for reads that need them.

    The given session is left as it is. Setting names use ``__`` for dots.
    """
    session = spark.newSession()
    fresh = session.conf.getAll
    for key, value in spark.conf.getAll.items():
        # Settings that neither session can change are the application's and already equal.
        if fresh.get(key) != value and (spark.conf.isModifiable(key) or not key.startswith("spark.")):
            session.conf.set(key, value)
    for key, value in settings.items():
        session.conf.set(key.replace("__", "."), value)
    return session


def metadata_session(spark: SparkSession) -> SparkSession:
    """A session whose scans are cut by cores, not bytes.

    For scans that only touch file names and footers: one task then covers many
    files, where the usual cut would plan a task for every 128 MB nobody reads.
    """
    return session_with(spark, spark__sql__files__maxPartitionBytes=str(1 << 60))


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path in the shared folder named by ``spark.checkpoint.dir``.

    Only a session in one process without that setting may use a temporary folder,
    which lasts as long as the process.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
        root = _local_root()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@functools.cache
def _local_root() -> str:
    root = tempfile.mkdtemp(prefix="plumbline-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def discard(frame: DataFrame) -> None:
    """Delete the copy behind a materialised frame, which cannot be read afterwards."""
    spark = frame.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs
    folders = {file.rsplit("/", 1)[0] for file in frame.inputFiles()}
    for folder in folders:
        path = hadoop.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def materialise(frame: DataFrame, purpose: str) -> DataFrame:
    """Compute a frame once and read it back, so that several consumers share one evaluation.

    The copy lies in the shared folder, so it survives the loss of executors.
    """
    path = scratch_path(frame.sparkSession, purpose)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
