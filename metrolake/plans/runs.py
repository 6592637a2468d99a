"""Run records built from accepted rows.

One run per file (or per any grouping key): its timestamp is the earliest
measurement time (or ``as_of`` when a file has none), its equipment and
operator the first non-null value in row order. All of it is one partial
aggregation (min, min_by), so a file of any size is combined map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _first_non_null(col: str, order: Column) -> Column:
    # min_by skips rows whose ordering value is null: null it where col is null.
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), order))


def build_runs(rows: DataFrame, key: str = "source_file",
               order: Sequence[str] = ("row_block", "row_idx"),
               as_of: str | None = None) -> DataFrame:
    """key, timestamp, equipment_id, operator, source_file? (one row per key)."""
    o = F.struct(*[F.col(c) for c in order])
    now = (F.lit(as_of).cast("timestamp_ntz") if as_of is not None
           else F.localtimestamp().cast("timestamp_ntz"))
    aggs = [F.min("timestamp").alias("_ts"),
            _first_non_null("equipment_id", o).alias("_eq"),
            _first_non_null("operator", o).alias("operator")]
    if key != "source_file" and "source_file" in rows.columns:
        aggs.append(F.first("source_file").alias("source_file"))
    r = rows.groupBy(key).agg(*aggs)
    return r.select(
        key,
        F.coalesce("_ts", now).alias("timestamp"),
        F.coalesce(F.col("_eq").cast("string"), F.lit("UNKNOWN")).alias("equipment_id"),
        F.col("operator").cast("string").alias("operator"),
        *([c for c in ["source_file"] if c in r.columns and c != key]),
    )
