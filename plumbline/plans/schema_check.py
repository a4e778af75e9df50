"""Schema check: does every partition have exactly the reference's schema?"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from plumbline import schemas
from plumbline.functions.metrics import Run
from plumbline.operators.footers import FIELDS, field_list, location_schemas

# The two outcomes.
CORRECT = "Correct"
WRONG = "Wrong"


def reference_schema(spark: SparkSession, path: str) -> StructType:
    """Schema of the reference file or directory."""
    return spark.read.parquet(path).schema


def _as_literal(schema: StructType) -> Column:
    entries = [
        F.struct(F.lit(f["position"]), F.lit(f["name"]), F.lit(f["type"])) for f in field_list(schema)
    ]
    return F.array(*entries).cast(FIELDS)


def schema_check(spark: SparkSession, reference: StructType, root: str, depth: int,
                 name_filter: str = "", run: Run | None = None) -> DataFrame:
    """Outcome per location at ``depth`` below ``root``. Field order, case and type all matter."""
    run = run or Run()
    found = location_schemas(spark, root, depth, name_filter)
    same = F.coalesce(F.col("fields") == _as_literal(reference), F.lit(False))
    return found.select(
        F.when(same, CORRECT).otherwise(WRONG).alias("schema_status"),
        "location",
        F.lit(run.log_time).cast("long").alias("log_time"),
    ).to(schemas.SCHEMA_CHECK)


def schema_differences(spark: SparkSession, reference: StructType, root: str, depth: int,
                       name_filter: str = "") -> DataFrame:
    """Fields that only the location or only the reference has, per wrong location."""
    found = location_schemas(spark, root, depth, name_filter)
    wanted, empty = _as_literal(reference), F.array().cast(FIELDS)
    fields = F.coalesce("fields", empty)
    sides = F.array(
        F.struct(F.lit("location").alias("side"), F.array_except(fields, wanted).alias("fields")),
        F.struct(F.lit("reference").alias("side"), F.array_except(wanted, fields).alias("fields")),
    )
    return (
        found.select("location", F.inline(sides))
        .select("location", "side", F.inline("fields"))
    )


def failed_schemas(checked: DataFrame) -> DataFrame:
    """Number of locations whose schema is not the reference's."""
    return checked.where(F.col("schema_status") != CORRECT).agg(F.count("*").alias("failed"))
