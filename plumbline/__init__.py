"""Data-quality checks for large date-partitioned tables, as set-based Spark jobs."""
