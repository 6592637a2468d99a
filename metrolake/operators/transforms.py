"""Normalisation of raw rows onto the canonical measurement schema.

Raw rows of every format share one shape:

    source_file, row_block, row_idx, fields map<string,string>

plus a file frame ``raw_files(source_file, raw_cols array<string>)`` that
lists the columns (cleaned header names / union of keys) each file has.
Column presence is a per-file fact, so alias choice, deviation derivation
and metadata defaults are decided per file and joined to the rows (one row
per file; AQE broadcasts it when small).

``transform`` returns ``(rows, files)``: rows with the canonical columns
(timestamp, position, actual_value, expected_value, deviation, operator,
equipment_id, axis, unit, extras map) and files with ``present_cols`` (the
canonical names present after the chain) and the per-file cast-failure
counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import COLUMN_ALIASES, MEASUREMENT_COLUMNS
from ..functions.columns import normalize_position, strip, to_number, to_timestamp_any
from ..session import ensure_checkpoint_dir

CANONICAL = list(COLUMN_ALIASES)
MISSING_STRATEGIES = ("flag", "drop", "fill")
#: Per-file frames (one row a file) up to this many rows are stored and broadcast.
MAX_BROADCAST_FILES = 50_000


def clean_keys(fields: Column, json_style: bool = False) -> Column:
    """T1 on map keys: strip, lower, blank runs (and dots for JSON) -> ``_``."""
    pat = r"[\.\s]+" if json_style else r"\s+"
    return F.transform_keys(fields, lambda k, v: F.regexp_replace(F.lower(strip(k)), pat, "_"))


# ---------------------------------------------------------------------------
# T2 alias mapping
# ---------------------------------------------------------------------------

def alias_choice(raw_files: DataFrame) -> DataFrame:
    """Per file and canonical column, the source column that maps onto it:
    the first alias (in priority order) the file has. ``src_<canonical>``
    is null when the file has none."""
    cols = F.col("raw_cols")
    out = [F.col("source_file"), cols]
    for canon, aliases in COLUMN_ALIASES.items():
        pick = F.lit(None).cast("string")
        for a in reversed(aliases):
            pick = F.when(F.array_contains(cols, F.lit(a)), F.lit(a)).otherwise(pick)
        out.append(pick.alias(f"src_{canon}"))
    return raw_files.select(*out)


def normalize_columns(raw: DataFrame, raw_files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Canonical columns from the per-file alias choice; every column not
    chosen stays in ``extras`` under its own name."""
    choice = alias_choice(raw_files)
    chosen = F.array_compact(F.array(*[F.col(f"src_{c}") for c in CANONICAL]))
    choice = choice.withColumn("_chosen", chosen)
    j = raw.join(choice.drop("raw_cols"), "source_file")
    canon = [F.element_at(F.col("fields"), F.col(f"src_{c}")).alias(c) for c in CANONICAL]
    extras = F.map_filter("fields", lambda k, v: ~F.array_contains(F.col("_chosen"), k))
    rows = j.select("source_file", "row_block", "row_idx", *canon,
                    F.element_at(F.col("fields"), F.lit("deviation")).alias("deviation"),
                    extras.alias("extras"))
    # Present canonical names per file: chosen canonicals + a raw 'deviation'.
    present = F.array_compact(F.array(
        *[F.when(F.col(f"src_{c}").isNotNull(), F.lit(c)) for c in CANONICAL],
        F.when(F.array_contains(F.col("raw_cols"), F.lit("deviation")), F.lit("deviation"))))
    files = choice.select("source_file", "raw_cols", present.alias("present_cols"))
    return rows, files


# ---------------------------------------------------------------------------
# T3-T9
# ---------------------------------------------------------------------------

def parse_timestamps(rows: DataFrame) -> DataFrame:
    """Text -> timestamp_ntz; unparseable -> null."""
    return rows.withColumn("timestamp", to_timestamp_any("timestamp"))


def cast_numeric(rows: DataFrame) -> DataFrame:
    """T4: measurement text -> double; bad text -> null, with a per-row flag
    column ``_cast_fail_<c>`` so failures can be counted per file."""
    for c in MEASUREMENT_COLUMNS:
        raw = F.col(c)
        num = to_number(raw)
        rows = rows.withColumn(f"_cast_fail_{c}", raw.isNotNull() & num.isNull()).withColumn(c, num)
    return rows


def calculate_deviation(rows: DataFrame, files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """T5: deviation = actual - expected for files *without* a deviation
    column that have both inputs; a present deviation column is kept."""
    has = lambda c: F.array_contains(F.col("present_cols"), F.lit(c))
    derive = ~has("deviation") & has("actual_value") & has("expected_value")
    f = files.withColumn("_derive_dev", derive)
    r = (rows.join(f.select("source_file", "_derive_dev"), "source_file")
             .withColumn("deviation", F.when(F.col("_derive_dev"),
                                             F.col("actual_value") - F.col("expected_value"))
                         .otherwise(F.col("deviation")))
             .drop("_derive_dev"))
    f = f.withColumn("present_cols", F.when(F.col("_derive_dev"), F.array_union(
        F.col("present_cols"), F.array(F.lit("deviation")))).otherwise(F.col("present_cols"))
    ).drop("_derive_dev")
    return r, f


def handle_missing(rows: DataFrame, files: DataFrame, strategy: str = "flag",
                   fill_value: float | None = None) -> DataFrame:
    """``flag`` adds ``is_missing``; ``drop`` removes rows with a null in
    a present measurement column; ``fill`` puts ``fill_value`` there."""
    if strategy not in MISSING_STRATEGIES:
        raise ValueError(f"missing strategy must be one of {MISSING_STRATEGIES}, got {strategy!r}")
    if strategy == "fill" and fill_value is None:
        raise ValueError("fill_value must be provided when strategy='fill'.")
    j = rows.join(files.select("source_file", F.col("present_cols").alias("_pc")), "source_file")
    has = lambda c: F.array_contains(F.col("_pc"), F.lit(c))
    missing_any = F.lit(False)
    for c in MEASUREMENT_COLUMNS:
        missing_any = missing_any | (has(c) & F.col(c).isNull())
    if strategy == "flag":
        j = j.withColumn("is_missing", missing_any)
    elif strategy == "drop":
        j = j.filter(~missing_any)
    else:
        for c in MEASUREMENT_COLUMNS:
            j = j.withColumn(c, F.when(has(c) & F.col(c).isNull(), F.lit(float(fill_value)))
                             .otherwise(F.col(c)))
    return j.drop("_pc")


def normalize_positions(rows: DataFrame) -> DataFrame:
    """Trimmed upper-case text; a missing position reads ``NAN``."""
    return rows.withColumn("position", normalize_position("position"))


def add_run_metadata(rows: DataFrame, files: DataFrame, equipment_id: str | None = None,
                     operator: str | None = None) -> tuple[DataFrame, DataFrame]:
    """equipment/operator default to the given value (else ``UNKNOWN``)
    when a file lacks the column or has it null in every row; partly null
    columns stay as they are."""
    nn = rows.groupBy("source_file").agg(F.count("equipment_id").alias("_n_eq"),
                                         F.count("operator").alias("_n_op"))
    f = files.join(nn, "source_file", "left")
    r = (rows.join(f.select("source_file", "_n_eq", "_n_op"), "source_file")
             .withColumn("equipment_id", F.when(F.coalesce("_n_eq", F.lit(0)) == 0,
                                                F.lit(equipment_id or "UNKNOWN"))
                         .otherwise(F.col("equipment_id")))
             .withColumn("operator", F.when(F.coalesce("_n_op", F.lit(0)) == 0,
                                            F.lit(operator or "UNKNOWN"))
                         .otherwise(F.col("operator")))
             .drop("_n_eq", "_n_op"))
    f = f.withColumn("present_cols", F.array_union(
        F.col("present_cols"), F.array(F.lit("equipment_id"), F.lit("operator")))).drop("_n_eq", "_n_op")
    return r, f


def drop_blank_rows(rows: DataFrame) -> DataFrame:
    """T9 (opt-in): drop rows whose payload columns are all null."""
    payload = CANONICAL + ["deviation"]
    return rows.filter(F.coalesce(*[F.col(c).cast("string") for c in payload]).isNotNull()
                       | (F.size(F.coalesce("extras", F.create_map())) > 0))


def cast_failures(rows: DataFrame) -> DataFrame:
    """Per file: how many non-null measurement texts were not numbers."""
    return rows.groupBy("source_file").agg(
        *[F.count_if(F.col(f"_cast_fail_{c}")).cast("long").alias(f"cast_fail_{c}")
          for c in MEASUREMENT_COLUMNS])


def transform(raw: DataFrame, raw_files: DataFrame, missing_strategy: str = "flag",
              fill_value: float | None = None, equipment_id: str | None = None,
              operator: str | None = None, drop_blank: bool = False) -> tuple[DataFrame, DataFrame]:
    """The full chain, in the order alias mapping, timestamps, numbers,
    deviation, missing values, positions, run metadata.

    Fused plan: every per-file decision (alias choice, column presence,
    whether deviation is derived) is made on the small file frame and joined
    to the rows once; the column work is a few staged projections; the
    metadata defaults need per-file non-null counts (one partial
    aggregation) and a second join. The step functions above give the same
    results one at a time.

    Spark sizes the rows by the (compressed) files below them and might
    broadcast them to the per-file frames. So up to ``MAX_BROADCAST_FILES``
    files, counted, the two per-file frames are checkpointed and broadcast and
    no row is moved; with more files both sides are joined by a sorted shuffle.
    """
    if missing_strategy not in MISSING_STRATEGIES:
        raise ValueError(f"missing strategy must be one of {MISSING_STRATEGIES}, got {missing_strategy!r}")
    if missing_strategy == "fill" and fill_value is None:
        raise ValueError("fill_value must be provided when strategy='fill'.")
    ensure_checkpoint_dir(raw.sparkSession)
    choice = alias_choice(raw_files)
    few = choice.limit(MAX_BROADCAST_FILES + 1).checkpoint()
    is_small = few.count() <= MAX_BROADCAST_FILES
    choice = few if is_small else choice

    def per_file(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if is_small else df.hint("merge")

    has_raw = lambda c: F.array_contains(F.col("raw_cols"), F.lit(c))
    present = F.array_compact(F.array(
        *[F.when(F.col(f"src_{c}").isNotNull(), F.lit(c)) for c in CANONICAL],
        F.when(has_raw("deviation"), F.lit("deviation"))))
    derive = (~has_raw("deviation") & F.col("src_actual_value").isNotNull()
              & F.col("src_expected_value").isNotNull())
    dec = choice.select(
        "source_file", *[f"src_{c}" for c in CANONICAL],
        F.array_compact(F.array(*[F.col(f"src_{c}") for c in CANONICAL])).alias("_chosen"),
        F.when(derive, F.array_union(present, F.array(F.lit("deviation")))).otherwise(present).alias("_pc"),
        derive.alias("_derive"))
    files = choice.select("source_file", "raw_cols").join(
        dec.select("source_file", F.col("_pc").alias("present_cols")), "source_file")

    j = raw.join(per_file(dec), "source_file")
    r = j.select("source_file", "row_block", "row_idx", "_pc", "_derive",
                 *[F.element_at(F.col("fields"), F.col(f"src_{c}")).alias(c) for c in CANONICAL],
                 F.element_at(F.col("fields"), F.lit("deviation")).alias("deviation"),
                 F.map_filter("fields", lambda k, v: ~F.array_contains(F.col("_chosen"), k)).alias("extras"))
    if drop_blank:
        r = drop_blank_rows(r)
    keep = ["source_file", "row_block", "row_idx", "_pc", "_derive", "position", "operator",
            "equipment_id", "axis", "unit", "extras"]
    nums = {c: to_number(c) for c in MEASUREMENT_COLUMNS}
    r = r.select(*keep, to_timestamp_any("timestamp").alias("timestamp"),
                 *[nums[c].alias(c) for c in MEASUREMENT_COLUMNS],
                 *[(F.col(c).isNotNull() & nums[c].isNull()).alias(f"_cast_fail_{c}") for c in MEASUREMENT_COLUMNS])
    dev = F.when(F.col("_derive"), F.col("actual_value") - F.col("expected_value")).otherwise(F.col("deviation"))
    r = r.withColumn("deviation", dev)
    has = lambda c: F.array_contains(F.col("_pc"), F.lit(c))
    missing_any = F.lit(False)
    for c in MEASUREMENT_COLUMNS:
        missing_any = missing_any | (has(c) & F.col(c).isNull())
    if missing_strategy == "flag":
        r = r.withColumn("is_missing", missing_any)
    elif missing_strategy == "drop":
        r = r.filter(~missing_any)
    else:
        r = r.select(*[c for c in r.columns if c not in MEASUREMENT_COLUMNS],
                     *[F.when(has(c) & F.col(c).isNull(), F.lit(float(fill_value))).otherwise(F.col(c)).alias(c)
                       for c in MEASUREMENT_COLUMNS])
    r = r.withColumn("position", F.when(has("position"), normalize_position("position")))

    stats = r.groupBy("source_file").agg(
        F.count("equipment_id").alias("_n_eq"), F.count("operator").alias("_n_op"),
        *[F.count_if(F.col(f"_cast_fail_{c}")).cast("long").alias(f"cast_fail_{c}") for c in MEASUREMENT_COLUMNS])
    if is_small:
        stats = stats.checkpoint()  # one pass over the rows for both frames returned
    r = r.drop(*[f"_cast_fail_{c}" for c in MEASUREMENT_COLUMNS], "_pc", "_derive")
    r = (r.join(per_file(stats.select("source_file", "_n_eq", "_n_op")), "source_file")
          .withColumn("equipment_id", F.when(F.col("_n_eq") == 0, F.lit(equipment_id or "UNKNOWN"))
                      .otherwise(F.col("equipment_id")))
          .withColumn("operator", F.when(F.col("_n_op") == 0, F.lit(operator or "UNKNOWN"))
                      .otherwise(F.col("operator")))
          .drop("_n_eq", "_n_op"))
    files = (files.withColumn("present_cols", F.array_union(
                 F.col("present_cols"), F.array(F.lit("equipment_id"), F.lit("operator"))))
             .join(stats.drop("_n_eq", "_n_op"), "source_file", "left")
             .select("source_file", "raw_cols", "present_cols",
                     *[F.coalesce(f"cast_fail_{c}", F.lit(0).cast("long")).alias(f"cast_fail_{c}")
                       for c in MEASUREMENT_COLUMNS]))
    return r, files


# ---------------------------------------------------------------------------
# T11
# ---------------------------------------------------------------------------

def threshold_breaches(df: DataFrame, threshold: float) -> DataFrame:
    """Rows whose |deviation| exceeds ``threshold``."""
    return df.filter(F.abs(F.col("deviation")) > threshold)
