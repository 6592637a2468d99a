"""Schemas of the stored tables (Parquet under one store folder).

Superset columns beyond the four rebuilt tables are marked: runs and the
ledger carry ``file_hash``/``run_id`` so readers can tell committed runs
(ledger row written last) from leftovers of an interrupted load; validation
results carry the file so rejected files keep their check rows.
"""

from __future__ import annotations

from pyspark.sql.types import (BooleanType, DateType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType)

RUNS = StructType([
    StructField("run_id", LongType(), False),
    StructField("timestamp", TimestampNTZType(), False),
    StructField("operator", StringType(), True),
    StructField("equipment_id", StringType(), False),
    StructField("source_file", StringType(), True),
    StructField("notes", StringType(), True),
    StructField("created_at", TimestampNTZType(), True),
    StructField("file_hash", StringType(), True),          # superset
    StructField("load_id", StringType(), True),              # partition column
])

MEASUREMENTS = StructType([
    StructField("measurement_id", LongType(), False),
    StructField("run_id", LongType(), False),
    StructField("position", StringType(), False),
    StructField("actual_value", DoubleType(), False),
    StructField("expected_value", DoubleType(), False),
    StructField("deviation", DoubleType(), False),
    StructField("timestamp", TimestampNTZType(), True),
    StructField("axis", StringType(), True),
    StructField("unit", StringType(), True),
    StructField("load_id", StringType(), True),              # partition column
    StructField("ts_date", DateType(), True),                # partition column
])

FILE_IMPORTS = StructType([
    StructField("file_id", LongType(), False),
    StructField("filename", StringType(), False),
    StructField("file_hash", StringType(), True),
    StructField("import_timestamp", TimestampNTZType(), True),
    StructField("status", StringType(), False),
    StructField("rows_imported", LongType(), False),
    StructField("error_message", StringType(), True),
    StructField("run_id", LongType(), True),                 # superset
    StructField("path", StringType(), True),                 # superset
    StructField("load_id", StringType(), True),              # partition column
])

VALIDATION_RESULTS = StructType([
    StructField("validation_id", LongType(), False),
    StructField("run_id", LongType(), True),
    StructField("check_type", StringType(), False),
    StructField("status", StringType(), False),
    StructField("details", StringType(), True),
    StructField("created_at", TimestampNTZType(), True),
    StructField("source_file", StringType(), True),          # superset
    StructField("file_hash", StringType(), True),            # superset
    StructField("check_order", IntegerType(), True),         # superset
    StructField("n_flagged", LongType(), True),              # superset
    StructField("load_id", StringType(), True),              # partition column
])

HOUR_INDEX = StructType([
    StructField("h", LongType(), False),                     # hours since 1970
    StructField("c", LongType(), False),                     # measurements in that hour
    StructField("cum", LongType(), False),                   # and up to its end
    StructField("load_id", StringType(), True),              # partition column
])

INGEST_SUMMARY = StructType([
    StructField("file", StringType(), False),
    StructField("path", StringType(), False),
    StructField("status", StringType(), False),
    StructField("rows", LongType(), False),
    StructField("run_id", LongType(), True),
    StructField("message", StringType(), True),
    StructField("accepted", BooleanType(), True),
])

TABLES = {
    "runs": RUNS,
    "measurements": MEASUREMENTS,
    "file_imports": FILE_IMPORTS,
    "validation_results": VALIDATION_RESULTS,
    "hour_index": HOUR_INDEX,
}
