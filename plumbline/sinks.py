"""Result tables: creating them, and appending a run's rows in one write each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.plans.common import CheckResult
from plumbline.schemas import QUERY_LOG, RESULT_TABLES
from plumbline.session import discard, materialise


def create_result_tables(spark: SparkSession, database: str) -> None:
    """Create the result tables that do not exist yet."""
    for name, (schema, partition) in RESULT_TABLES.items():
        writer = spark.createDataFrame([], schema).write.mode("ignore").format("parquet")
        if partition:
            writer = writer.partitionBy(partition)
        writer.saveAsTable(f"{database}.{name}")


def append(frame: DataFrame, target: str, partition: str | None = None) -> None:
    """Append to a table, or to a Parquet path (anything with a slash).

    Rows are brought together by partition first, so that a run adds few files.
    """
    frame = frame.hint("rebalance", *([F.col(partition)] if partition else []))
    writer = frame.write.mode("append").format("parquet")
    if partition:
        writer = writer.partitionBy(partition)
    if "/" in target:
        writer.save(target)
    else:
        writer.saveAsTable(target)


def stored(spark: SparkSession, target: str) -> DataFrame | None:
    """The rows of a table, or of a Parquet path (anything with a slash); None while there are none."""
    if "/" not in target:
        return spark.table(target) if spark.catalog.tableExists(target) else None
    try:
        return spark.read.parquet(target)
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def append_new(frame: DataFrame, target: str, keys: Sequence[str], of_run: Column, partition: str | None = None) -> None:
    """Append the rows that an earlier try of the same run has not stored yet.

    ``of_run`` says which stored rows can be the run's, as a condition that a scan can prune by; of these,
    rows with the same ``keys`` are left as they are.
    """
    there = stored(frame.sparkSession, target)
    if there is not None:
        frame = frame.join(there.where(of_run).select(*keys).distinct(), list(keys), "left_anti")
    append(frame, target, partition)


def store(check: CheckResult, results: str, query_log: str | None = None) -> None:
    """Append a check's rows to its result table and its queries to the query log, once per run.

    The check is computed once, before either write, so a check that reads its
    own result table as history never sees rows of the same run. The log is written
    first: the results of a run that failed in between are then missing, never unlogged. Storing the same
    run again (the same ``Run``) adds what is missing and nothing twice.
    The computed copy is deleted once both are written, and also when a write fails.
    """
    frame = materialise(check.frame, "check")
    once = CheckResult(frame, check.schema, check.scenario)
    # The ids of a run are a range of their own, so stored rows of other runs are pruned by their statistics.
    first, last = frame.agg(F.min("queryid"), F.max("queryid")).head()
    of_run = F.col("queryid").between(first, last) if first is not None else F.lit(False)
    try:
        if query_log:
            append_new(once.query_log.to(QUERY_LOG), query_log, ["queryid"], of_run)
        days = once.metrics.agg(F.min("partitionDate"), F.max("partitionDate")).head()
        of_days = of_run if days[0] is None else of_run & F.col("partitionDate").between(*days)
        append_new(once.metrics, results, ["queryid"], of_days, "partitionDate")
    finally:
        discard(frame)


def store_schema_check(checked: DataFrame, results: str) -> None:
    """Append schema-check rows; their partition is the time of the run. A run that is stored again adds
    the locations that are missing."""
    once = materialise(checked, "schema-check")
    times = [row["log_time"] for row in once.select("log_time").distinct().limit(2).collect()]
    of_run = F.col("log_time") == times[0] if len(times) == 1 else F.lit(True)
    try:
        append_new(once, results, ["location", "log_time"], of_run, "log_time")
    finally:
        discard(once)
