"""Layouts of rule files and of the six result tables (fixed values)."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
}


def _columns(listed: str) -> T.StructType:
    """``name type, name type`` as a schema, without needing a running session."""
    pairs = [column.split() for column in listed.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def _texts(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


QUALITY_RULES = _texts(
    "environment", "database", "tableType", "businessLine", "viewMode", "viewType",
    "dataQualityColumn", "priority", "columnLength",
)
TOTAL_RULES = _texts(
    "environment", "database", "tableType", "businessLine", "viewMode", "viewType",
)
DUPLICATE_RULES = _texts(
    "environment", "database", "tableType", "havingColumn", "duplicateCheckColumns",
    "businessLine", "viewMode", "viewType",
)

COLUMN_QUALITY = _columns("""
    queryid bigint, environment string, databaseName string, tableName string,
    viewMode string, businessLine string, viewType string, dataQualityColumn string,
    improperColumnCount bigint, improperColumnPercent float, totalColumnCount bigint,
    category string, logdate int, priority string, partitionDate int
""")
COLUMN_CONSISTENCY = _columns("""
    queryid bigint, environment string, databaseName string, tableName string,
    viewMode string, businessLine string, viewType string, columnConsistencyField string,
    dayCount bigint, averageRecordCount float, columnConsistencyPercentDiff float,
    category string, logdate int, partitionDate int
""")
TOTAL_CONSISTENCY = _columns("""
    queryid bigint, environment string, databaseName string, tableName string,
    viewMode string, businessLine string, viewType string,
    dayCount bigint, averageRecordCount double, totalConsistencyPercentDiff double,
    category string, logDate int, partitionDate int
""")
DUPLICATE_CHECK = _columns("""
    queryid bigint, environment string, databaseName string, tableName string,
    viewMode string, businessLine string, viewType string, selectColumns string,
    duplicateCheckColumn string, duplicateCount bigint, logDate int, partitionDate int
""")
SCHEMA_CHECK = _columns("schema_status string, location string, log_time bigint")
QUERY_LOG = _columns("""
    queryid bigint, query string, scenario string, executionDate int, logDate int
""")

# Table name -> (schema, partition column).
RESULT_TABLES = {
    "ColumnQualityCheck": (COLUMN_QUALITY, "partitionDate"),
    "ColumnConsistencyCheck": (COLUMN_CONSISTENCY, "partitionDate"),
    "TotalConsistencyCheck": (TOTAL_CONSISTENCY, "partitionDate"),
    "DuplicateCheck": (DUPLICATE_CHECK, "partitionDate"),
    "schema_check": (SCHEMA_CHECK, "log_time"),
    "dataValidation_QueryDetails": (QUERY_LOG, None),
}
