"""What becomes of each file, and the rows that the store keeps about it.

Frames of one row a file (or one a file and check). A file's fate is data, not
an exception: a file that can't be read, transformed or stored carries its
status and message through the same jobs as its neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COLUMN_ALIASES, REQUIRED_COLUMNS
from ..operators.validation import load_gate

#: Check rows of one file have ids from file_id * CHECK_IDS.
CHECK_IDS = 16


def transform_errors(files: DataFrame) -> DataFrame:
    """(source_file, message): files whose columns can't be mapped.

    A column that the alias mapping chooses is there twice once headers are cleaned (``Pos`` and ``pos ``), so it
    is not known which one is meant. ``files``: source_file, raw_cols (with repeats).
    """
    cols, clash = F.col("raw_cols"), []
    for aliases in [*COLUMN_ALIASES.values(), ["deviation"]]:
        chosen = F.coalesce(*[F.when(F.array_contains(cols, F.lit(a)), F.lit(a)) for a in aliases])
        clash.append(F.when(F.size(F.array_remove(cols, chosen)) < F.size(cols) - 1, chosen))
    clash = F.array_sort(F.array_compact(F.array(*clash)))
    return files.select("source_file", clash.alias("_clash")).filter(F.size("_clash") > 0).select(
        "source_file", F.concat(F.lit("Columns that occur more than once: "), F.array_join("_clash", ", ")).alias("message"))


def file_outcomes(rows: DataFrame, files: DataFrame, results: DataFrame, force: bool = False) -> DataFrame:
    """(source_file, n_rows, _status, _message) of transformed and checked files.

    ``transform_error`` for columns that can't be mapped; ``failed`` for a failed check (unless ``force``), a missing
    required column or a null in a measurement column that the store requires (even with ``force``); else ``success``.
    """
    nulls = rows.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("actual_value").isNull() | F.col("expected_value").isNull()
                   | F.col("deviation").isNull()).alias("n_null"))
    req_missing = F.array_except(F.array(*[F.lit(c) for c in REQUIRED_COLUMNS]), F.col("present_cols"))
    f = (files.select("source_file", req_missing.alias("_req_missing")).join(nulls, "source_file", "left")
         .join(load_gate(results, force), "source_file", "left"))
    if "raw_cols" in files.columns:
        f = f.join(transform_errors(files), "source_file", "left")
    else:
        f = f.withColumn("message", F.lit(None).cast("string"))
    load_err = (F.when(F.size("_req_missing") > 0,
                       F.concat(F.lit("DataFrame missing required columns: "),
                                F.array_join(F.array_sort("_req_missing"), ", ")))
                 .when(F.coalesce("n_null", F.lit(0)) > 0,
                       F.format_string("NOT NULL constraint failed: %d row(s) with a null measurement value",
                                       F.col("n_null"))))
    blocked = F.coalesce(~F.col("accepted"), F.lit(False))
    broken = F.col("message").isNotNull()
    return f.select(
        "source_file", F.when(broken, 0).otherwise(F.coalesce("n_rows", F.lit(0))).cast("long").alias("n_rows"),
        F.when(broken, "transform_error").when(blocked, "failed").when(load_err.isNotNull(), "failed")
         .otherwise("success").alias("_status"),
        F.when(broken, F.col("message"))
         .when(blocked, F.format_string("%d validation failure(s) prevented load.", F.col("n_fail")))
         .otherwise(load_err).alias("_message"))


def ledger_rows(files: DataFrame, now: Column) -> DataFrame:
    """One ledger row per file (``files``: file_id, file_name, file_hash, _status, n_rows, _message, run_id, path)."""
    return files.select(
        "file_id", F.col("file_name").alias("filename"), "file_hash", now.alias("import_timestamp"),
        F.col("_status").alias("status"),
        F.when(F.col("_status") == "success", F.col("n_rows")).otherwise(0).cast("long").alias("rows_imported"),
        F.col("_message").alias("error_message"), "run_id", "path")


def validation_rows(results: DataFrame, files: DataFrame, now: Column) -> DataFrame:
    """One row per file and check, of loaded and rejected files alike."""
    f = files.select(F.col("path").alias("source_file"), "file_id", "run_id", "file_name", "file_hash")
    return results.join(f, "source_file").select(
        (F.col("file_id") * CHECK_IDS + F.col("check_order")).alias("validation_id"), "run_id", "check_type", "status",
        "details", now.alias("created_at"), F.col("file_name").alias("source_file"), "file_hash", "check_order",
        "n_flagged")


def summary_rows(files: DataFrame) -> DataFrame:
    """The outcome of a load, one row per file."""
    run = F.col("run_id") if "run_id" in files.columns else F.lit(None)
    return files.select(
        F.col("file_name").alias("file"), "path", F.col("_status").alias("status"),
        F.when(F.col("_status") == "success", F.col("n_rows")).otherwise(0).cast("long").alias("rows"),
        run.cast("long").alias("run_id"), F.col("_message").alias("message"),
        (F.col("_status") == "success").alias("accepted"))


def dry_run_rows(files: DataFrame) -> DataFrame:
    """The outcome of a dry run: files that could be read are ``dry_run`` with all their rows."""
    unread = F.col("_status").isin("extract_error", "transform_error")
    return files.select(
        F.col("file_name").alias("file"), "path", F.when(unread, F.col("_status")).otherwise("dry_run").alias("status"),
        F.when(unread, 0).otherwise(F.col("n_rows")).cast("long").alias("rows"),
        F.lit(None).cast("long").alias("run_id"), F.col("_message").alias("message"),
        (F.col("_status") == "success").alias("accepted"))


def processed(ledger: DataFrame) -> DataFrame:
    """Files that were loaded (the archive mark), latest first."""
    return (ledger.filter(F.col("status") == "success")
            .select("path", "filename", "file_hash", "run_id", "import_timestamp")
            .orderBy(F.desc("import_timestamp"), F.desc("run_id")))
