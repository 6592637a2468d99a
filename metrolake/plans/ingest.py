"""Ingest plan: files -> canonical rows -> checks -> gated, idempotent load.

All files of a listing are processed by one set of Spark jobs (no per-file
loop): read per format, transform, validate, gate, then append to the
store and commit (S8-S17).

* Hash skip (S12): a file whose SHA-256 already has a ``success`` ledger row
  is skipped unless ``force``; of equal files in one listing the oldest is
  processed, and if it loads the others are skipped, else they share its fate.
* Gate (V10, S13): a file with a failed check is not loaded unless
  ``force``; a file that can not be stored (missing required column, a null
  measurement value after the missing-value strategy) fails even with
  ``force``; one whose columns can't be mapped is a ``transform_error``.
* Commit (S13): a load works on one version of the store and writes under its
  own load id; creating the next version file makes all of it visible at
  once. If another load has taken that version, this one starts again from it
  (its hashes, ids and hour index), up to ``attempts`` times.
* Ids are deterministic (run ids follow file mtime/path order after the
  largest id committed; measurement ids pack run id and row position), so a
  recomputed task writes the same rows.
* The transformed rows are checkpointed once (reliable checkpoint in the
  session's ``spark.checkpoint.dir``) so the checks and the writes do
  not re-read and re-parse the files, and lost executors recompute from the
  checkpoint, not from the sources.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MEASUREMENT_COLUMNS, ValidationConfig
from ..operators.ordered import ordered_index
from ..operators.transforms import transform
from ..operators.validation import run_checks
from ..session import ensure_checkpoint_dir
from ..sources.files import MAX_BYTES, WHOLE_FORMATS, describe_listing, file_hashes, list_files
from ..sources.reader import read_raw
from .outcomes import dry_run_rows, file_outcomes, ledger_rows, summary_rows, validation_rows
from .runs import build_runs
from .store import Conflict, Store

ROW_BITS = 32  # measurement_id = run_id << 32 | row position in the file


def _now_lit(as_of: str | None):
    ts = as_of or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).strftime("%Y-%m-%d %H:%M:%S")
    return F.lit(ts).cast("timestamp_ntz")


def split_known(files: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """``files`` plus ``_first`` and ``_action``.

    ``_action``: ``skip`` if the hash is in ``done(file_hash)``; ``twin`` for a
    file equal to an older one of the listing (``_first`` is that one's path);
    else ``process``. With ``force`` every file is processed.
    """
    if force:
        return files.withColumns({"_first": F.col("path"), "_action": F.lit("process")})
    known = done.select(F.col("file_hash").alias("_done")).distinct()
    f = files.join(known, F.col("file_hash") == F.col("_done"), "left")
    # The oldest file of each content, aggregated map-side; files without a hash stand alone.
    key = F.coalesce("file_hash", F.concat(F.lit("path:"), F.col("path")))
    first = f.groupBy(key.alias("_key")).agg(F.min(F.struct("modificationTime", "path")).alias("_m"))
    f = f.join(first.select("_key", F.col("_m.path").alias("_first")), key == F.col("_key")).drop("_key")
    action = (F.when(F.col("_done").isNotNull(), "skip").when(F.col("_first") != F.col("path"), "twin")
               .otherwise("process"))
    return f.withColumn("_action", action).drop("_done")


def assign_run_ids(files: DataFrame, base: int) -> DataFrame:
    """(path, run_id), ids after ``base`` in file age order; ordered_index keeps a huge batch off one task."""
    k = ordered_index(files.select("path", "modificationTime"), [], ["modificationTime", "path"], "_k")
    return k.select("path", (F.lit(base + 1) + F.col("_k")).cast("long").alias("run_id"))


def measurement_rows(rows: DataFrame, run_ids: DataFrame) -> DataFrame:
    """Accepted rows with their run id and ``_pos``, the place in their file."""
    r = rows.join(run_ids.withColumnRenamed("path", "source_file"), "source_file")
    return ordered_index(r, ["source_file"], ["row_block", "row_idx"], name="_pos")


def stored_measurements(ok_rows: DataFrame) -> DataFrame:
    """What the store keeps of ``measurement_rows``."""
    return ok_rows.select(
        (F.shiftleft(F.col("run_id"), ROW_BITS) + F.col("_pos")).alias("measurement_id"), "run_id",
        "position", *MEASUREMENT_COLUMNS, "timestamp", "axis", "unit", F.to_date("timestamp").alias("ts_date"))


def ingest_folder(spark: SparkSession, location: str, store_root: str, **kw) -> DataFrame:
    """Process every file in ``location`` (oldest first) into the store."""
    return ingest_listing(spark, list_files(spark, location), store_root, **kw)


def ingest_listing(spark: SparkSession, listing: DataFrame, store_root: str,
                   cfg: ValidationConfig = ValidationConfig(), force: bool = False,
                   dry_run: bool = False, missing_strategy: str = "flag",
                   fill_value: float | None = None, equipment_id: str | None = None,
                   operator: str | None = None, as_of: str | None = None, attempts: int = 5) -> DataFrame:
    """Process a listing (``path, modificationTime, length``) into the store.

    Returns the per-file summary (S16): file, path, status, rows, run_id,
    message, accepted. ``dry_run`` (S17) runs everything but the writes.
    """
    if missing_strategy == "fill" and fill_value is None:
        raise ValueError("fill_value must be provided when strategy='fill'.")
    ensure_checkpoint_dir(spark)
    for left in range(attempts - 1, -1, -1):
        try:
            return _load(Store(spark, store_root).pinned(), listing, cfg, force, dry_run, missing_strategy,
                         fill_value, equipment_id, operator, as_of)
        except Conflict:
            if not left:
                raise


def _load(store: Store, listing: DataFrame, cfg: ValidationConfig, force: bool, dry_run: bool, missing_strategy: str,
          fill_value: float | None, equipment_id: str | None, operator: str | None, as_of: str | None) -> DataFrame:
    """One attempt, on one version of the store."""
    spark, now = store.spark, _now_lit(as_of)
    lst = describe_listing(listing).persist()

    # ---- S6/S12: hashes and the already-imported skip ------------------------
    # CSV and log files are read in splits, so they may have any size; a document must fit one row.
    too_large = F.col("format").isin(list(WHOLE_FORMATS)) & (F.col("length") >= MAX_BYTES)
    supported = lst.filter(F.col("format").isNotNull() & ~too_large)
    hashes = file_hashes(spark, [r["path"] for r in supported.filter(F.col("length") < MAX_BYTES).select("path").toLocalIterator()],
                         supported.filter(F.col("length") >= MAX_BYTES))
    files = lst.join(hashes, "path", "left")
    done = store.ledger().filter(F.col("status") == "success").select("file_hash").distinct()
    files = split_known(files, done, force).persist()
    skipped = files.filter("_action = 'skip'").drop("_first", "_action")
    twins = files.filter("_action = 'twin'").drop("_action")
    todo = files.filter("_action = 'process'").drop("_first", "_action")

    groups: dict = {}
    for r in todo.select("path", F.when(~too_large, F.col("format")).alias("format")).toLocalIterator():
        groups.setdefault(r["format"], []).append(r["path"])
    raw = read_raw(spark, todo, groups)

    # ---- T10: transform, checkpointed once ------------------------------------
    raw_rows = raw.rows.withColumnRenamed("path", "source_file")
    raw_files = raw.files.withColumnRenamed("path", "source_file")
    rows, tfiles = transform(raw_rows, raw_files, missing_strategy, fill_value, equipment_id, operator)
    rows = rows.checkpoint()
    tfiles = tfiles.checkpoint()

    # ---- V8/V10: checks and gate ------------------------------------------------
    stored = store.measurements().select("timestamp", "ts_date")
    results = run_checks(rows, tfiles, cfg, stored=stored, stored_index=store.hour_index()).checkpoint()
    fstate = file_outcomes(rows, tfiles, results, force)

    meta = todo.select("path", "file_name", "file_hash", "modificationTime", too_large.alias("too_large"), "length")
    summary_new = (meta.drop("length", "too_large").join(fstate, F.col("path") == F.col("source_file"), "inner").drop("source_file"))
    errors = (raw.errors.join(meta, "path")
                 .select("path", "file_name", "file_hash", "modificationTime", F.lit(0).cast("long").alias("n_rows"),
                         F.lit("extract_error").alias("_status"),
                         F.when(F.col("too_large"), F.format_string(
                             "File of %d bytes is too large for a document (limit 2 GB)", F.col("length")))
                          .otherwise(F.col("message")).alias("_message")))
    # A supported file that yielded neither columns nor a reader error (an
    # empty file) has nothing to parse.
    empty = (meta.join(fstate.select(F.col("source_file").alias("path")), "path", "left_anti")
                 .join(raw.errors.select("path"), "path", "left_anti")
                 .join(todo.filter(F.col("format").isNotNull()).select("path"), "path", "left_semi")
                 .select("path", "file_name", "file_hash", "modificationTime", F.lit(0).cast("long").alias("n_rows"),
                         F.lit("extract_error").alias("_status"),
                         F.lit("No columns to parse from file").alias("_message")))
    summary_new = summary_new.unionByName(errors).unionByName(empty)
    of = summary_new.select(F.col("path").alias("_first"), "n_rows", "_status", "_message")
    loaded = F.col("_status") == "success"
    twin_rows = twins.join(of, "_first").select(
        "path", "file_name", "file_hash", "modificationTime",
        F.when(loaded, F.lit(0).cast("long")).otherwise(F.col("n_rows")).alias("n_rows"),
        F.when(loaded, "skipped_duplicate").otherwise(F.col("_status")).alias("_status"), "_message")
    skip_rows = skipped.select("path", "file_name", "file_hash", "modificationTime",
                               F.lit(0).cast("long").alias("n_rows"), F.lit("skipped_duplicate").alias("_status"),
                               F.lit(None).cast("string").alias("_message")).unionByName(twin_rows)

    if dry_run:
        return _finish(dry_run_rows(summary_new).unionByName(summary_rows(skip_rows)), [lst, files])

    # ---- ids ------------------------------------------------------------------------
    ok_files = summary_new.filter(F.col("_status") == "success")
    run_ids = assign_run_ids(ok_files, store.max_id("runs", "run_id")).checkpoint()
    ok_rows = measurement_rows(rows, run_ids)

    # ---- S9 measurements, S8 runs, S10 validation rows, S11 ledger, hour index, commit --------
    meas = stored_measurements(ok_rows)
    store.append("measurements", meas)

    runs = build_runs(ok_rows, key="run_id", order=("row_block", "row_idx"), as_of=as_of)
    runs = (runs.join(meta.select(F.col("path").alias("source_file"), "file_name", "file_hash"), "source_file")
                .select("run_id", "timestamp", "operator", "equipment_id",
                        F.col("file_name").alias("source_file"), F.lit(None).cast("string").alias("notes"),
                        now.alias("created_at"), "file_hash"))
    store.append("runs", runs)

    all_files = summary_new.unionByName(skip_rows).join(run_ids, "path", "left")
    all_files = ordered_index(all_files, [], ["modificationTime", "path"], "_k")
    file_base = store.max_id("file_imports", "file_id")
    all_files = all_files.withColumn("file_id", (F.lit(file_base + 1) + F.col("_k")).cast("long")).drop("_k").checkpoint()
    store.append("validation_results", validation_rows(results, all_files, now))
    store.append("file_imports", ledger_rows(all_files, now))
    store.append_hours(ok_rows.select("timestamp"))
    store.commit()
    return _finish(summary_rows(all_files), [lst, files])


def _finish(summary: DataFrame, cached: list[DataFrame]) -> DataFrame:
    """Materialise the (small, one row per file) summary and free caches."""
    out = summary.checkpoint()
    for c in cached:
        c.unpersist()
    return out


def outcome_counts(summary: DataFrame) -> DataFrame:
    """S16 totals: files per status."""
    return summary.groupBy("status").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"))
