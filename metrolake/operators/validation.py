"""Per-file quality checks as grouped DataFrame jobs.

Input is the canonical row frame of any number of files:

    source_file, row_block, row_idx, timestamp, position, actual_value,
    expected_value, deviation, ...

where (row_block, row_idx) is the row order inside a file and a row_block
holds a bounded number of rows. Column *presence* is per file and comes in
a separate frame ``files(source_file, present_cols array<string>)``; a
column absent from a file is null in the row frame.

Every check returns one row per file:

    source_file, check_order, check_type, status, n_flagged, details

``status`` is pass / warn / fail. The suite is their union; the roll-up and
the load gate are aggregations over it.

Scale notes: all statistics are partial aggregates (count, avg, stddev,
min/max, percentile's value->count map). Order-dependent parts never put a
whole file in one task: the order check compares neighbours inside bounded
row blocks and then across block boundaries; gaps are found between
adjacent non-empty time buckets of width ``max_gap``; the first-N position
list is a per-partition limited row_number. The suite takes files that are all
small in one shuffle instead (``file_facts``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import (CHECK_ORDER, DUPLICATE_KEY_COLUMNS, MEASUREMENT_COLUMNS,
                      REQUIRED_COLUMNS, ValidationConfig)
from .ordered import groups_within, largest_group, ordered_index
from ..session import ensure_checkpoint_dir
from .quantiles import DEFAULT_MAX_MAP_ROWS, MAX_MAP_ROWS_CONF, group_quantiles

MAX_FILE_ROWS_CONF = "metrolake.checks.maxFileRows"
#: Files of at most so many rows are checked whole, each in a task (``file_facts``).
DEFAULT_MAX_FILE_ROWS = 200_000

CHECKED_COLUMNS = list(dict.fromkeys(["source_file", "row_block", "row_idx", "timestamp", "position",
                                      *MEASUREMENT_COLUMNS, "deviation", *DUPLICATE_KEY_COLUMNS]))
RESULT_COLUMNS = ["source_file", "check_order", "check_type", "status", "n_flagged", "details"]


def files_of(rows: DataFrame, present: Sequence[str] | None = None) -> DataFrame:
    """File frame for rows whose files all carry the same columns."""
    cols = list(present) if present is not None else [
        "timestamp", "position", "actual_value", "expected_value", "deviation",
        "operator", "equipment_id", "axis", "unit"]
    return rows.select("source_file").distinct().withColumn(
        "present_cols", F.array(*[F.lit(c) for c in cols]))


def _has(col: str) -> Column:
    return F.array_contains(F.col("present_cols"), F.lit(col))


def _result(df: DataFrame, check: str, status: Column, n_flagged: Column, details: Column) -> DataFrame:
    return df.select(
        "source_file",
        F.lit(CHECK_ORDER.index(check)).alias("check_order"),
        F.lit(check).alias("check_type"),
        status.alias("status"),
        n_flagged.cast("long").alias("n_flagged"),
        details.alias("details"),
    )


def _py_list(arr: Column) -> Column:
    """array<string> -> "['a', 'b']" (Python list text)."""
    quoted = F.transform(arr, lambda x: F.concat(F.lit("'"), x, F.lit("'")))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def _fmt(x: Column, digits: int = 4) -> Column:
    return F.format_string(f"%.{digits}f", x)


# ---------------------------------------------------------------------------
# Shared per-file profile (one aggregation pass for most checks)
# ---------------------------------------------------------------------------

def file_profile(rows: DataFrame, files: DataFrame, cfg: ValidationConfig = ValidationConfig(),
                 quantiles: str = "auto") -> DataFrame:
    """One partial-aggregation pass per file: row and timestamp counts, time
    range, null counts, threshold breaches and deviation statistics (n,
    mean, sample std, min, max), plus the linear quartiles from
    ``group_quantiles`` (``quantiles``: auto / map / ranked / approx; auto
    picks ``percentile`` while every file is below a size bound and ranks the
    values across tasks otherwise). Files without rows get zeros.
    """
    dev = F.col("deviation")
    if quantiles == "auto":
        limit = int(rows.sparkSession.conf.get(MAX_MAP_ROWS_CONF, str(DEFAULT_MAX_MAP_ROWS)))
        quantiles = ("map" if largest_group(rows, ["source_file"]) <= limit
                     else "ranked")
    in_pass = []
    if quantiles in ("map", "approx"):
        # Bounded buffers ride along with the other aggregates (one pass).
        q = (F.percentile(dev, F.array(F.lit(0.25), F.lit(0.75))) if quantiles == "map"
             else F.percentile_approx(dev, [0.25, 0.75], 100000))
        in_pass = [q.alias("_q")]
    agg = rows.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("timestamp").alias("n_ts"),
        F.min("timestamp").alias("ts_min"), F.max("timestamp").alias("ts_max"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in MEASUREMENT_COLUMNS],
        F.count_if(F.abs(dev) > cfg.drift_threshold).alias("n_breaches"),
        F.count(dev).alias("n"), F.avg(dev).alias("mean"), F.stddev_samp(dev).alias("std"),
        F.min(dev).alias("min"), F.max(dev).alias("max"), *in_pass)
    if in_pass:
        agg = agg.withColumn("q1", F.col("_q")[0]).withColumn("q3", F.col("_q")[1]).drop("_q")
    else:
        agg = agg.join(group_quantiles(rows.select("source_file", "deviation", "row_block", "row_idx"),
                                       ["source_file"], "deviation", [0.25, 0.75], ["q1", "q3"],
                                       strategy="ranked", tie_break=["row_block", "row_idx"]),
                       "source_file", "left")
    zero = F.lit(0).cast("long")
    return (files.select("source_file", "present_cols").join(agg, "source_file", "left").select(
        "source_file", "present_cols",
        F.coalesce("n_rows", zero).alias("n_rows"), F.coalesce("n_ts", zero).alias("n_ts"),
        "ts_min", "ts_max",
        *[F.when(_has(c), F.coalesce(f"_null_{c}", zero)).otherwise(zero).alias(f"null_{c}")
          for c in MEASUREMENT_COLUMNS],
        F.coalesce("n_breaches", zero).alias("n_breaches"), F.coalesce("n", zero).alias("n"),
        "mean", "std", "q1", "q3", "min", "max"))


def _profile(rows, files, cfg, profile):
    return profile if profile is not None else file_profile(rows, files, cfg)


# ---------------------------------------------------------------------------
# V1 required columns
# ---------------------------------------------------------------------------

def check_required_columns(rows: DataFrame, files: DataFrame, cfg: ValidationConfig = ValidationConfig(),
                           profile: DataFrame | None = None) -> DataFrame:
    return _result(files, "required_columns", *_required_verdict(cfg))


def _required_verdict(cfg: ValidationConfig) -> tuple[Column, Column, Column]:
    """(status, n_flagged, details) of a file frame; so the other ``_..._verdict`` of a frame of per-file facts."""
    req = F.array(*[F.lit(c) for c in sorted(REQUIRED_COLUMNS)])
    missing = F.array_sort(F.array_except(req, F.col("present_cols")))
    status = F.when(F.size(missing) > 0, "fail").otherwise("pass")
    details = F.when(F.size(missing) > 0,
                     F.concat(F.lit("Missing columns: "), _py_list(missing))
                     ).otherwise(F.concat(F.lit("All required columns present: "), _py_list(req)))
    return status, F.size(missing), details


# ---------------------------------------------------------------------------
# V2 row count
# ---------------------------------------------------------------------------

def check_row_count(rows: DataFrame, files: DataFrame, cfg: ValidationConfig = ValidationConfig(),
                    profile: DataFrame | None = None) -> DataFrame:
    return _result(_profile(rows, files, cfg, profile), "row_count", *_row_count_verdict(cfg))


def _row_count_verdict(cfg: ValidationConfig) -> tuple[Column, Column, Column]:
    low = F.col("n_rows") < cfg.min_rows
    status = F.when(low, "fail").otherwise("pass")
    details = F.when(low, F.format_string(f"Only %d row(s); minimum expected is {cfg.min_rows}.", F.col("n_rows"))
                     ).otherwise(F.format_string("%d rows present.", F.col("n_rows")))
    return status, F.col("n_rows"), details


# ---------------------------------------------------------------------------
# V3 missing measurements
# ---------------------------------------------------------------------------

def check_missing(rows: DataFrame, files: DataFrame, cfg: ValidationConfig = ValidationConfig(),
                  profile: DataFrame | None = None) -> DataFrame:
    return _result(_profile(rows, files, cfg, profile), "missing_measurements", *_missing_verdict(cfg))


def _missing_verdict(cfg: ValidationConfig) -> tuple[Column, Column, Column]:
    total = sum((F.col(f"null_{c}") for c in MEASUREMENT_COLUMNS), F.lit(0))
    parts = F.array_compact(F.array(*[
        F.when(F.col(f"null_{c}") > 0, F.format_string(f"{c}: %d null(s)", F.col(f"null_{c}")))
        for c in MEASUREMENT_COLUMNS]))
    status = F.when(total > 0, "warn").otherwise("pass")
    details = F.when(total > 0, F.concat(
        F.format_string("%d missing value(s): ", total), F.array_join(parts, "; "))
    ).otherwise(F.lit("No missing measurement values."))
    return status, total, details


# ---------------------------------------------------------------------------
# V4 timestamp order and gaps
# ---------------------------------------------------------------------------

def order_violations(rows: DataFrame) -> DataFrame:
    """Per file: number of places where a non-null timestamp is earlier than
    the previous non-null timestamp in row order.

    Neighbours are compared inside each row block (bounded window), then the
    last timestamp of a block is compared with the first of the next
    non-empty block of the same file (a window over the small block table).
    """
    t = rows.filter(F.col("timestamp").isNotNull()).select(
        "source_file", "row_block", "row_idx", "timestamp")
    w = Window.partitionBy("source_file", "row_block").orderBy("row_idx")
    inside = (t.withColumn("_prev", F.lag("timestamp").over(w))
               .groupBy("source_file", "row_block")
               .agg(F.count_if(F.col("_prev") > F.col("timestamp")).alias("_inv"),
                    F.min_by("timestamp", "row_idx").alias("_first"),
                    F.max_by("timestamp", "row_idx").alias("_last")))
    wb = Window.partitionBy("source_file").orderBy("row_block")
    across = inside.withColumn("_prev_last", F.lag("_last").over(wb))
    return across.groupBy("source_file").agg(
        (F.sum("_inv") + F.count_if(F.col("_prev_last") > F.col("_first"))).alias("n_order_violations"))


def timestamp_gaps(rows: DataFrame, max_gap_hours: float) -> DataFrame:
    """All gaps longer than ``max_gap_hours`` between consecutive sorted
    timestamps, per file: (source_file, gap_start, gap_end, gap_seconds).

    Timestamps are cut into buckets of width ``max_gap``; a longer gap can
    only lie between the max of one non-empty bucket and the min of the
    next, so only bucket extremes are compared. The bucket table grows with
    a file's time span, not with its rows.
    """
    width = max(1, int(round(max_gap_hours * 3600 * 1_000_000)))  # a bound of 0: every step between times
    us = F.unix_micros(F.col("timestamp").cast("timestamp"))
    b = (rows.filter(F.col("timestamp").isNotNull())
             .groupBy("source_file", F.floor(us / F.lit(width)).alias("_b"))
             .agg(F.min("timestamp").alias("_lo"), F.max("timestamp").alias("_hi")))
    w = Window.partitionBy("source_file").orderBy("_b")
    g = b.withColumn("gap_start", F.lag("_hi").over(w)).filter(F.col("gap_start").isNotNull())
    g = g.select("source_file", "gap_start", F.col("_lo").alias("gap_end"),
                 _seconds_between(F.col("gap_start"), F.col("_lo")).alias("gap_seconds"))
    return g.filter(F.col("gap_seconds") > max_gap_hours * 3600)


def _seconds_between(a: Column, b: Column) -> Column:
    return (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / 1e6


def _gap_text(secs: Column, end: Column) -> Column:
    return F.concat(_timedelta_text(secs), F.lit(" gap before "), end.cast("string"))


def _timedelta_text(secs: Column) -> Column:
    """Seconds -> ``D days HH:MM:SS`` (fraction kept when present)."""
    whole = F.floor(secs).cast("long")
    frac = secs - whole
    days = F.floor(whole / 86400).cast("long")
    rem = whole - days * 86400
    hms = F.format_string("%02d:%02d:%02d", F.floor(rem / 3600).cast("int"),
                          F.floor((rem % 3600) / 60).cast("int"), (rem % 60).cast("int"))
    frac_txt = F.when(frac > 0, F.substring(F.format_string("%.6f", frac), 2, 7)).otherwise(F.lit(""))
    return F.concat(days.cast("string"), F.lit(" days "), hms, frac_txt)


def check_timestamps(rows: DataFrame, files: DataFrame, cfg: ValidationConfig = ValidationConfig(),
                     profile: DataFrame | None = None) -> DataFrame:
    p = _profile(rows, files, cfg, profile).select("source_file", "present_cols", "n_ts")
    order = order_violations(rows)
    gaps = timestamp_gaps(rows, cfg.max_gap_hours)
    k = cfg.max_listed_gaps
    # Gaps per file are bounded by its time span / max_gap. One window
    # operator gives each gap's rank and the file's gap count; only the
    # first k per file go on to the aggregation.
    first_w = Window.partitionBy("source_file").orderBy("gap_end")
    all_w = Window.partitionBy("source_file")
    txt = _gap_text(F.col("gap_seconds"), F.col("gap_end"))
    listed = (gaps.select("source_file", "gap_end", "gap_seconds",
                          F.row_number().over(first_w).alias("_r"), F.count(F.lit(1)).over(all_w).alias("_cnt"))
                  .filter(F.col("_r") <= k)
                  .groupBy("source_file")
                  .agg(F.first("_cnt").alias("_n_gaps"),
                       F.sort_array(F.collect_list(F.struct("_r", txt.alias("_txt")))).alias("_first"))
                  .select("source_file", F.col("_n_gaps").alias("n_gaps"),
                          F.transform("_first", lambda s: s["_txt"]).alias("first_gaps")))
    f = p.join(order, "source_file", "left").join(listed, "source_file", "left")
    return _result(f, "timestamp_consistency", *_timestamps_verdict(cfg))


def _timestamps_verdict(cfg: ValidationConfig) -> tuple[Column, Column, Column]:
    n_ts = F.col("n_ts")
    n_gaps = F.coalesce("n_gaps", F.lit(0))
    unordered = F.coalesce("n_order_violations", F.lit(0)) > 0
    gap_txt = F.concat(F.format_string(f"%d gap(s) > {cfg.max_gap_hours}h: ", n_gaps),
                       _py_list(F.coalesce("first_gaps", F.array().cast("array<string>"))))
    issues = F.array_compact(F.array(
        F.when(unordered, F.lit("Timestamps are not in chronological order.")),
        F.when(n_gaps > 0, gap_txt)))
    no_col = ~_has("timestamp")
    all_null = n_ts == 0
    # Not by the texts: a status alone then needs no listed gaps.
    status = F.when(no_col | all_null | unordered | (n_gaps > 0), "warn").otherwise("pass")
    details = (F.when(no_col, F.lit("No 'timestamp' column found."))
                .when(all_null, F.lit("All timestamps are null."))
                .when(F.size(issues) > 0, F.array_join(issues, " | "))
                .otherwise(F.format_string("%d timestamps are consistent.", n_ts)))
    flagged = F.when(no_col | all_null, 0).otherwise(
        n_gaps + F.when(unordered, 1).otherwise(0))
    return status, flagged, details


# ---------------------------------------------------------------------------
# V5 duplicates (in file, and against the store)
# ---------------------------------------------------------------------------

def duplicate_rows(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Rows sharing (timestamp, position, actual_value) within a file, all
    members counted; nulls are equal. Absent key columns are null in every
    row of the file and so drop out of the key by themselves."""
    keyed = (rows.groupBy("source_file", *DUPLICATE_KEY_COLUMNS).count()
                 .filter(F.col("count") > 1)
                 .groupBy("source_file").agg(F.sum("count").alias("n_dupes")))
    return (files.select("source_file", "present_cols").join(keyed, "source_file", "left")
            .select("source_file", "present_cols", _n_dupes().alias("n_dupes")))


def _n_dupes() -> Column:
    any_key = F.exists(F.col("present_cols"), lambda c: c.isin(DUPLICATE_KEY_COLUMNS))
    return F.when(any_key, F.coalesce("n_dupes", F.lit(0))).otherwise(F.lit(0)).cast("long")


HOUR_US = 3600 * 1_000_000
#: Hours of a block of the running total: about a month.
BLOCK_HOURS = 720


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def hour_counts(stored: DataFrame) -> DataFrame:
    """(h, c): measurements per hour since 1970; rows without a timestamp have none."""
    return (stored.filter(F.col("timestamp").isNotNull())
            .groupBy(F.floor(_micros("timestamp") / HOUR_US).alias("h")).agg(F.count(F.lit(1)).alias("c")))


def _blocks(hours: DataFrame) -> DataFrame:
    """(b, before): measurements before each block of hours that has any. A row a month, so one task orders them."""
    per = hours.groupBy(F.floor(F.col("h") / BLOCK_HOURS).alias("b")).agg(F.sum("c").alias("n"))
    w = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    return per.select("b", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"), "n")


def running_hours(hours: DataFrame) -> DataFrame:
    """``hours(h, c)`` plus ``cum``, the total up to the hour's end: inside blocks, plus what lies before the block."""
    w = Window.partitionBy("b").orderBy("h").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    d = hours.withColumn("b", F.floor(F.col("h") / BLOCK_HOURS))
    return d.join(_blocks(hours), "b").select("h", "c", (F.col("before") + F.sum("c").over(w)).alias("cum"))


def hour_index(stored: DataFrame) -> DataFrame:
    """(h, c, cum) of a frame of measurements, as a store keeps it."""
    return running_hours(hour_counts(stored))


def _total_until(q: DataFrame, index: DataFrame) -> DataFrame:
    """``q(_q, ...)`` plus ``_cum``: all measurements of hours <= ``_q`` (the last indexed hour's total)."""
    hours = q.select(F.col("_q").alias("h")).distinct().select("h", F.lit(None).cast("long").alias("cum"), F.lit(True).alias("_is_q"))
    u = hours.unionByName(index.select("h", "cum", F.lit(False).alias("_is_q"))).withColumn(
        "b", F.floor(F.col("h") / BLOCK_HOURS))
    w = Window.partitionBy("b").orderBy("h", "_is_q").rowsBetween(Window.unboundedPreceding, 0)
    filled = u.select("h", "b", "_is_q", F.last("cum", ignorenulls=True).over(w).alias("_in")).filter("_is_q")
    # A block whose own hours all come later takes the total of the last block before it: a row a month.
    ends = index.groupBy(F.floor(F.col("h") / BLOCK_HOURS).alias("b")).agg(F.max("cum").alias("end"))
    both = ends.select("b", "end", F.lit(False).alias("_is_q")).unionByName(
        filled.select("b", F.lit(None).cast("long").alias("end"), F.lit(True).alias("_is_q")).distinct())
    months = both.select("b", "_is_q", F.last("end", ignorenulls=True).over(
        Window.orderBy("b", F.desc("_is_q")).rowsBetween(Window.unboundedPreceding, 0)).alias("_until")).filter("_is_q")
    filled = filled.join(months.select("b", "_until"), "b").select(
        F.col("h").alias("_q"), F.coalesce("_in", "_until", F.lit(0)).alias("_cum"))
    return q.join(filled, "_q")


def store_overlap(rows: DataFrame | None, stored: DataFrame, window_hours: float,
                  ranges: DataFrame | None = None, index: DataFrame | None = None) -> DataFrame:
    """Per file, count of stored measurements with timestamp in
    [min(ts) - w, max(ts) + w] (inclusive).

    Exact range count with equi-joins only (no nested loop, no file x row
    pairs). With hour buckets h_lo / h_hi of the range ends:

    * hours strictly between them: the running totals of ``index``, the
      store's hour index (``Store.hour_index``; made from ``stored`` if none is given);
    * the two edge hours: only their stored rows are read (and only the dates
      they lie on, if ``stored`` has its ``ts_date`` partitions). How many of
      them lie before an edge is a rank lookup: the edges are ranked together
      with the rows of the same hour (``ordered_index``, which spreads a hot
      hour over tasks) and the rank among edges alone is subtracted.

    ``ranges`` (source_file, ts_min, ts_max) can come from a file profile
    instead of ``rows``.
    """
    w_us = int(round(window_hours * 3600 * 1_000_000))
    index = index if index is not None else hour_index(stored)
    if ranges is None:
        ranges = rows.groupBy("source_file").agg(F.min("timestamp").alias("ts_min"),
                                                 F.max("timestamp").alias("ts_max"))
    rng = (ranges.filter(F.col("ts_min").isNotNull())
                 .select("source_file", (_micros("ts_min") - w_us).alias("lo"), (_micros("ts_max") + w_us).alias("hi"))
                 .select("source_file", "lo", "hi", F.floor(F.col("lo") / HOUR_US).alias("h_lo"),
                         F.floor(F.col("hi") / HOUR_US).alias("h_hi")))
    # Interior = total up to h_hi - 1, less the total up to h_lo.
    q = (rng.select("source_file", (F.col("h_hi") - 1).alias("_q"), F.lit(1).alias("_sgn"))
            .unionByName(rng.select("source_file", F.col("h_lo").alias("_q"), F.lit(-1).alias("_sgn"))))
    interior = _total_until(q, index).groupBy("source_file").agg(
        F.sum(F.col("_sgn") * F.col("_cum")).alias("interior"))
    # Edge points: the lower end counts stored rows strictly before it (kind
    # 0 sorts before an equal stored time), the upper end rows up to and
    # including it (kind 2 sorts after).
    edges = (rng.select("source_file", F.col("h_lo").alias("h"), F.col("lo").alias("t"), F.lit(0).alias("kind"))
                .unionByName(rng.select("source_file", F.col("h_hi").alias("h"), F.col("hi").alias("t"),
                                        F.lit(2).alias("kind"))))
    hours = edges.select("h").distinct()
    st = stored.filter(F.col("timestamp").isNotNull())
    if "ts_date" in stored.columns:
        days = hours.select(F.to_date(F.timestamp_seconds(F.col("h") * 3600)).alias("ts_date")).distinct()
        st = st.join(days, "ts_date", "left_semi")
    st = (st.select(_micros("timestamp").alias("t")).select(F.floor(F.col("t") / HOUR_US).alias("h"), "t")
          .join(hours, "h", "left_semi"))
    pts = (st.select("h", "t", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("source_file"))
             .unionByName(edges.select("h", "t", "kind", "source_file")))
    order = ["t", "kind", "source_file"]
    all_rank = ordered_index(pts, ["h"], order, name="_all").filter(F.col("kind") != 1)
    edge_rank = ordered_index(edges, ["h"], order, name="_edges")
    before = (all_rank.join(edge_rank.select("h", "t", "kind", "source_file", "_edges"),
                            ["h", "t", "kind", "source_file"])
                      .select("source_file", "kind", (F.col("_all") - F.col("_edges")).alias("_before")))
    b = before.groupBy("source_file").agg(
        F.max(F.when(F.col("kind") == 0, F.col("_before"))).alias("_lo_before"),
        F.max(F.when(F.col("kind") == 2, F.col("_before"))).alias("_hi_upto"))
    j = (rng.join(interior, "source_file", "left").join(b, "source_file", "left")
            .join(index.select(F.col("h").alias("h_lo"), F.col("c").alias("_c_lo")), "h_lo", "left"))
    same = F.col("h_hi") == F.col("h_lo")
    inner = F.when(F.col("h_hi") > F.col("h_lo") + 1, F.coalesce("interior", F.lit(0))).otherwise(0)
    edge = F.when(same, F.col("_hi_upto") - F.col("_lo_before")).otherwise(
        F.coalesce("_c_lo", F.lit(0)) - F.col("_lo_before") + F.col("_hi_upto"))
    return j.select("source_file", (inner + edge).cast("long").alias("n_stored_in_range"))


def check_duplicates(rows: DataFrame, files: DataFrame, cfg: ValidationConfig = ValidationConfig(),
                     stored: DataFrame | None = None, profile: DataFrame | None = None,
                     index: DataFrame | None = None) -> DataFrame:
    d = duplicate_rows(rows, files)
    if stored is not None:
        ranges = profile.select("source_file", "ts_min", "ts_max") if profile is not None else None
        ov = store_overlap(rows, stored, cfg.duplicate_window_hours, ranges=ranges, index=index)
        d = d.join(ov, "source_file", "left")
    return _result(d, "duplicate_detection", *_duplicates_verdict(cfg, stored is not None))


def _duplicates_verdict(cfg: ValidationConfig, with_store: bool) -> tuple[Column, Column, Column]:
    if with_store:
        can = _has("timestamp") & _has("position")
        n_st = F.when(can, F.coalesce("n_stored_in_range", F.lit(0))).otherwise(0).cast("long")
    else:
        n_st = F.lit(0).cast("long")
    keys_txt = F.concat(F.lit("keys: "), _py_list(F.filter(
        F.array(*[F.lit(c) for c in DUPLICATE_KEY_COLUMNS]),
        lambda c: F.array_contains(F.col("present_cols"), c))))
    issues = F.array_compact(F.array(
        F.when(F.col("n_dupes") > 0, F.concat(
            F.format_string("%d duplicate row(s) within file (", F.col("n_dupes")), keys_txt, F.lit(")."))),
        F.when(n_st > 0, F.format_string(
            "Database already contains %d measurement(s) within ±" + str(cfg.duplicate_window_hours)
            + "h of this file's time range. Possible re-import.", n_st))))
    status = F.when(F.size(issues) > 0, "warn").otherwise("pass")
    details = F.when(F.size(issues) > 0, F.array_join(issues, " | ")).otherwise(
        F.lit("No duplicates detected."))
    return status, F.col("n_dupes") + n_st, details


# ---------------------------------------------------------------------------
# V6 outliers
# ---------------------------------------------------------------------------

def outlier_stats(rows: DataFrame, files: DataFrame, cfg: ValidationConfig = ValidationConfig(),
                  quantiles: str = "auto", profile: DataFrame | None = None) -> DataFrame:
    """Per file: n, mean, sample std, linear quartiles, min, max of deviation
    (from the file profile) and the z-score / IQR / union outlier counts
    (a second pass that joins the one-row-per-file statistics back)."""
    p = profile if profile is not None else file_profile(rows, files, cfg, quantiles)
    st = p.select("source_file", "present_cols", "n", "mean", "std", "q1", "q3", "min", "max")
    is_z, is_iqr = _outlier_flags(cfg)
    d = rows.filter(F.col("deviation").isNotNull()).select("source_file", "deviation")
    # One stats row per file: AQE broadcasts it when its measured size allows.
    flagged = (d.join(st.select("source_file", "mean", "std", "q1", "q3"), "source_file")
                .groupBy("source_file")
                .agg(F.count_if(is_z).alias("n_z"), F.count_if(is_iqr).alias("n_iqr"),
                     F.count_if(is_z | is_iqr).alias("n_outliers")))
    return st.join(flagged, "source_file", "left")


def _outlier_flags(cfg: ValidationConfig) -> tuple[Column, Column]:
    """By z-score and by IQR, of a row that carries its file's statistics."""
    iqr = F.col("q3") - F.col("q1")
    lo = F.col("q1") - cfg.iqr_factor * iqr
    hi = F.col("q3") + cfg.iqr_factor * iqr
    # std is 0 for identical values and null for one value: no z-score then.
    z = F.try_divide(F.abs(F.col("deviation") - F.col("mean")), F.col("std"))
    return z > cfg.outlier_z, (F.col("deviation") < lo) | (F.col("deviation") > hi)


def check_outliers(rows: DataFrame, files: DataFrame, cfg: ValidationConfig = ValidationConfig(),
                   profile: DataFrame | None = None, quantiles: str = "auto") -> DataFrame:
    return _result(outlier_stats(rows, files, cfg, quantiles, profile), "outlier_detection", *_outliers_verdict(cfg))


def _outliers_verdict(cfg: ValidationConfig) -> tuple[Column, Column, Column]:
    pct = F.try_divide(100.0 * F.col("n_outliers"), F.col("n"))
    detail = F.concat(
        F.format_string("%d outlier(s) (", F.col("n_outliers")), _fmt(pct, 1),
        F.format_string("%%) detected. Z-score: %d, IQR: %d. ", F.col("n_z"), F.col("n_iqr")),
        F.lit("Deviation stats: mean="), _fmt(F.col("mean")), F.lit(", std="), _fmt(F.col("std")),
        F.lit(", range=["), _fmt(F.col("min")), F.lit(", "), _fmt(F.col("max")), F.lit("]."))
    no_col = ~_has("deviation")
    few = F.col("n") < cfg.min_outlier_points
    same = F.col("min") == F.col("max")
    status = (F.when(no_col | few, "warn").when(same, "pass")
               .when(F.col("n_outliers") == 0, "pass")
               .when(pct > cfg.outlier_fail_pct, "fail").otherwise("warn"))
    details = (F.when(no_col, F.lit("No 'deviation' column to check."))
                .when(few, F.lit("Too few data points for outlier detection."))
                .when(same, F.lit("All deviations identical — no outliers."))
                .when(F.col("n_outliers") == 0, F.concat(F.lit("No outliers. "), detail))
                .when(pct > cfg.outlier_fail_pct, F.concat(F.lit("High outlier rate. "), detail))
                .otherwise(detail))
    flagged = F.when(no_col | few | same, 0).otherwise(F.col("n_outliers"))
    return status, flagged, details


# ---------------------------------------------------------------------------
# V7 deviation range
# ---------------------------------------------------------------------------

def first_breach_positions(rows: DataFrame, threshold: float, max_listed: int = 10) -> DataFrame:
    """Per file: positions of the first ``max_listed`` rows (row order) with
    |deviation| > threshold. The row_number filter is planned as a window
    group limit, so each task forwards at most ``max_listed`` rows per file
    before the shuffle."""
    b = rows.filter(F.abs(F.col("deviation")) > threshold).select(
        "source_file", "row_block", "row_idx", "position")
    w = Window.partitionBy("source_file").orderBy("row_block", "row_idx")
    return (b.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= max_listed)
             .groupBy("source_file")
             .agg(F.sort_array(F.collect_list(F.struct("_r", "position"))).alias("_l"))
             .select("source_file", F.transform("_l", lambda s: s["position"]).alias("first_positions")))


def range_breaches(rows: DataFrame, threshold: float, max_listed: int = 10) -> DataFrame:
    """Per file with breaches: their count and the first positions."""
    n = (rows.filter(F.abs(F.col("deviation")) > threshold)
             .groupBy("source_file").agg(F.count(F.lit(1)).alias("n_breaches")))
    return n.join(first_breach_positions(rows, threshold, max_listed), "source_file", "left")


def check_deviation_range(rows: DataFrame, files: DataFrame, cfg: ValidationConfig = ValidationConfig(),
                          profile: DataFrame | None = None) -> DataFrame:
    p = _profile(rows, files, cfg, profile).select("source_file", "present_cols", "n_breaches")
    f = p.join(first_breach_positions(rows, cfg.drift_threshold, cfg.max_listed_positions),
               "source_file", "left")
    return _result(f, "deviation_range", *_range_verdict(cfg))


def _range_verdict(cfg: ValidationConfig) -> tuple[Column, Column, Column]:
    n = F.col("n_breaches")
    no_col = ~_has("deviation")
    positions = F.when(_has("position"), F.coalesce("first_positions", F.array())).otherwise(
        F.array().cast("array<string>"))
    more = F.when(_has("position") & (n > cfg.max_listed_positions), "...").otherwise("")
    status = F.when(no_col, "warn").when(n > 0, "warn").otherwise("pass")
    details = (F.when(no_col, F.lit("No 'deviation' column."))
                .when(n > 0, F.concat(
                    F.format_string(f"%d measurement(s) exceed ±{cfg.drift_threshold}: positions=", n),
                    _py_list(positions), more))
                .otherwise(F.lit(f"All deviations within ±{cfg.drift_threshold}.")))
    return status, F.when(no_col, 0).otherwise(n), details


# ---------------------------------------------------------------------------
# All checks of small files from one shuffle
# ---------------------------------------------------------------------------

def file_facts(rows: DataFrame, files: DataFrame, cfg: ValidationConfig = ValidationConfig()) -> DataFrame:
    """What the verdicts of all the checks need, one row per file, from one shuffle of the rows by file.

    Row order, time order (which brings equal keys together) and the file's statistics are windows
    over the rows that the shuffle put together, so a file is one task's work: only for files of
    bounded size. Facts that nobody selects (listed gaps, listed positions) are not made.
    """
    dev, ts, key = F.col("deviation"), F.col("timestamp"), F.struct(*DUPLICATE_KEY_COLUMNS)
    whole = Window.partitionBy("source_file")
    in_order = whole.orderBy("row_block", "row_idx").rowsBetween(Window.unboundedPreceding, -1)
    by_key = whole.orderBy(*DUPLICATE_KEY_COLUMNS)
    quartiles = F.percentile(dev, F.array(F.lit(0.25), F.lit(0.75))).over(whole)
    r = (rows.filter(F.col("source_file").isNotNull())
             .withColumn("_before", F.last("timestamp", ignorenulls=True).over(in_order))
             .withColumns({"_prev": F.lag("timestamp").over(by_key),
                           "_same": key.eqNullSafe(F.lag(key).over(by_key)) | key.eqNullSafe(F.lead(key).over(by_key))})
             .withColumns({"mean": F.avg(dev).over(whole), "std": F.stddev_samp(dev).over(whole), "_q": quartiles})
             .withColumns({"q1": F.col("_q")[0], "q3": F.col("_q")[1], "_secs": _seconds_between(F.col("_prev"), ts)}))
    is_gap = F.col("_secs") > cfg.max_gap_hours * 3600
    is_breach = F.abs(dev) > cfg.drift_threshold
    is_z, is_iqr = _outlier_flags(cfg)
    gaps = F.collect_list(F.when(is_gap, F.struct(ts.alias("end"), F.col("_secs").alias("secs"))))
    positions = F.collect_list(F.when(is_breach, F.struct("row_block", "row_idx", "position")))

    def flagged(c: Column) -> Column:  # null, not 0, for a file without deviations
        return F.sum(F.when(dev.isNotNull(), F.coalesce(c, F.lit(False)).cast("long")))

    agg = r.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(ts).alias("n_ts"), F.min(ts).alias("ts_min"), F.max(ts).alias("ts_max"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in MEASUREMENT_COLUMNS],
        F.count_if(is_breach).alias("n_breaches"), F.count(dev).alias("n"),
        *[F.first(c).alias(c) for c in ("mean", "std")], F.min(dev).alias("min"), F.max(dev).alias("max"),
        F.count_if(F.col("_before") > ts).alias("n_order_violations"), F.count_if(is_gap).alias("n_gaps"),
        F.slice(F.sort_array(gaps), 1, cfg.max_listed_gaps).alias("_gaps"), F.count_if("_same").alias("n_dupes"),
        flagged(is_z).alias("n_z"), flagged(is_iqr).alias("n_iqr"), flagged(is_z | is_iqr).alias("n_outliers"),
        F.slice(F.sort_array(positions), 1, cfg.max_listed_positions).alias("_positions"))
    zero = F.lit(0).cast("long")
    return files.select("source_file", "present_cols").join(agg, "source_file", "left").select(
        "source_file", "present_cols", "ts_min", "ts_max", "mean", "std", "min", "max", "n_z", "n_iqr", "n_outliers",
        *[F.coalesce(c, zero).alias(c) for c in ("n_rows", "n_ts", "n_breaches", "n", "n_order_violations", "n_gaps")],
        *[F.when(_has(c), F.coalesce(f"_null_{c}", zero)).otherwise(zero).alias(f"null_{c}") for c in MEASUREMENT_COLUMNS],
        _n_dupes().alias("n_dupes"),
        F.transform("_gaps", lambda g: _gap_text(g["secs"], g["end"])).alias("first_gaps"),
        F.transform("_positions", lambda p: p["position"]).alias("first_positions"))


def _verdicts(facts: DataFrame, cfg: ValidationConfig, checks: Sequence[str], with_store: bool) -> DataFrame:
    """One row per file and check from ``file_facts``, without another look at the facts for each check."""
    told = {"required_columns": _required_verdict(cfg), "row_count": _row_count_verdict(cfg),
            "missing_measurements": _missing_verdict(cfg), "timestamp_consistency": _timestamps_verdict(cfg),
            "duplicate_detection": _duplicates_verdict(cfg, with_store), "outlier_detection": _outliers_verdict(cfg),
            "deviation_range": _range_verdict(cfg)}
    d = facts.withColumn("check_order", F.explode(F.array(*[F.lit(CHECK_ORDER.index(c)) for c in checks])))

    def of_check(values: dict[str, Column]) -> Column:
        return F.coalesce(*[F.when(F.col("check_order") == CHECK_ORDER.index(c), v) for c, v in values.items()])

    chosen = dict.fromkeys(checks)
    return d.select(
        "source_file", "check_order", of_check({c: F.lit(c) for c in chosen}).alias("check_type"),
        of_check({c: told[c][0] for c in chosen}).alias("status"),
        of_check({c: told[c][1].cast("long") for c in chosen}).alias("n_flagged"),
        of_check({c: told[c][2] for c in chosen}).alias("details"))


# ---------------------------------------------------------------------------
# V8-V11 suite, roll-up, gate, custom suites
# ---------------------------------------------------------------------------

CHECKS: dict[str, Callable[..., DataFrame]] = {
    "required_columns": check_required_columns,
    "row_count": check_row_count,
    "missing_measurements": check_missing,
    "timestamp_consistency": check_timestamps,
    "duplicate_detection": check_duplicates,
    "outlier_detection": check_outliers,
    "deviation_range": check_deviation_range,
}


def run_checks(rows: DataFrame, files: DataFrame, cfg: ValidationConfig = ValidationConfig(),
               checks: Sequence[str] = tuple(CHECK_ORDER), stored: DataFrame | None = None,
               quantiles: str = "auto", materialize: bool = False,
               stored_index: DataFrame | None = None) -> DataFrame:
    """The chosen checks (default: all seven, in suite order).

    While every file has at most ``MAX_FILE_ROWS_CONF`` rows (one narrow pass tells), all the checks come
    from one shuffle of the rows by file (``file_facts``). Otherwise, or for other than exact quantiles by
    value counts, the per-file profile is computed and checkpointed once (one row a file) and shared by
    the checks, so the rows are scanned by one aggregation plus
    the order/gap, duplicate, outlier-count and first-breach passes. When ``rows`` is an expensive
    plan (parsed and transformed files), ``materialize=True`` checkpoints it
    once (into the session's checkpoint folder) so those passes do not each
    re-parse the files; a stored Parquet frame is cheaper to re-scan.
    """
    unknown = [c for c in checks if c not in CHECKS]
    if unknown:
        raise ValueError(f"unknown checks {unknown}; choose from {list(CHECKS)}")
    if materialize:
        ensure_checkpoint_dir(rows.sparkSession)
        rows = rows.select(*[c for c in CHECKED_COLUMNS if c in rows.columns])  # the checks read no others
        rows, files = rows.checkpoint(), files.checkpoint()
    if quantiles in ("auto", "map"):
        conf = rows.sparkSession.conf
        most = int(conf.get(MAX_MAP_ROWS_CONF, str(DEFAULT_MAX_MAP_ROWS)))
        small = min(most, int(conf.get(MAX_FILE_ROWS_CONF, str(DEFAULT_MAX_FILE_ROWS))))
        largest = 0 if groups_within(rows, ["source_file"], small) else largest_group(rows, ["source_file"])
        if largest <= small:
            facts = file_facts(rows, files, cfg)
            with_store = stored is not None and "duplicate_detection" in checks
            if with_store:
                ensure_checkpoint_dir(rows.sparkSession)
                facts = facts.checkpoint()  # read by each part of the overlap
                facts = facts.join(store_overlap(None, stored, cfg.duplicate_window_hours, index=stored_index,
                                                 ranges=facts.select("source_file", "ts_min", "ts_max")), "source_file", "left")
            return _verdicts(facts, cfg, checks, with_store)
        if quantiles == "auto":
            quantiles = "map" if largest <= most else "ranked"
    # One row a file. Left lazy, each check would prune other columns from it and the rows would be
    # aggregated once a check.
    ensure_checkpoint_dir(rows.sparkSession)
    profile = file_profile(rows, files, cfg, quantiles).checkpoint()
    parts = []
    for name in checks:
        fn = CHECKS[name]
        if name == "duplicate_detection":
            parts.append(fn(rows, files, cfg, stored=stored, profile=profile, index=stored_index))
        else:
            parts.append(fn(rows, files, cfg, profile=profile))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rollup(results: DataFrame) -> DataFrame:
    """V9: pass / warn / fail counts per file."""
    return results.groupBy("source_file").agg(
        *[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("pass", "warn", "fail")])


def load_gate(results: DataFrame, force: bool = False) -> DataFrame:
    """A file is accepted iff it has no failed check (or ``force``)."""
    g = results.groupBy("source_file").agg(
        F.count_if(F.col("status") == "fail").alias("n_fail"))
    return g.withColumn("accepted", F.lit(True) if force else (F.col("n_fail") == 0))
