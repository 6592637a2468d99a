"""Drift, variation, control-chart, ranking and trend analytics.

Every function takes the measurement frame (one row per stored measurement
joined to its run; see ``measurement_frame``) and answers for *all* runs /
positions / equipment at once as a grouped job. Asking about one id is a
filter on top, which Catalyst pushes into the Parquet scan.

Aggregates are the partial-aggregating built-ins (avg, stddev, count,
min/max, regr_slope), so hot groups are combined map-side before the
shuffle. The two order-dependent statistics (slope on the time-ordered row
index and the half-split trend) use ``ordered_index``, which stays correct
and distributed when one group holds most of the rows.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import AnalysisConfig
from ..functions.buckets import bucket, bucket_from, multiple
from ..session import ensure_checkpoint_dir
from .ordered import ordered_index, segments
from .quantiles import group_quantiles

MEASUREMENT_FRAME_COLUMNS = [
    "measurement_id", "run_id", "position", "actual_value", "expected_value",
    "deviation", "timestamp", "axis", "unit", "equipment_id", "operator",
]

INF = float("inf")


def _ts_lit(as_of) -> Column:
    if isinstance(as_of, str):
        as_of = _dt.datetime.fromisoformat(as_of)
    if isinstance(as_of, _dt.date) and not isinstance(as_of, _dt.datetime):
        as_of = _dt.datetime(as_of.year, as_of.month, as_of.day)
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def lookback_filter(m: DataFrame, as_of, days: int) -> DataFrame:
    """Rows with ``timestamp >= as_of - days`` (inclusive; null timestamps out).

    When the frame carries the store's ``ts_date`` partition column the same
    bound is also put on it, so the scan prunes whole date partitions.
    """
    cutoff = _ts_lit(as_of) - F.make_dt_interval(F.lit(days))
    out = m.filter(F.col("timestamp") >= cutoff)
    if "ts_date" in m.columns:
        out = out.filter(F.col("ts_date") >= F.to_date(cutoff))
    return out


# ---------------------------------------------------------------------------
# Measurement scan
# ---------------------------------------------------------------------------

def measurement_frame(measurements: DataFrame, runs: DataFrame,
                      run_ids: Sequence[int] | None = None) -> DataFrame:
    """Inner join measurements with their runs; the 11 analysis columns.

    ``runs`` holds one row per run; AQE broadcasts it when it is small and
    keeps a shuffle join when it is not. A run filter is pushed to both scans.
    """
    if run_ids is not None:
        ids = list(run_ids)
        measurements = measurements.filter(F.col("run_id").isin(ids))
        runs = runs.filter(F.col("run_id").isin(ids))
    r = runs.select("run_id", "equipment_id", "operator")
    return (measurements.join(r, "run_id", "inner")
            .select(*MEASUREMENT_FRAME_COLUMNS))


def run_listing(runs: DataFrame) -> DataFrame:
    """All runs in time order (S18); ``.count()`` on it is the run total."""
    return runs.orderBy("timestamp", "run_id")


# ---------------------------------------------------------------------------
# Per-run drift
# ---------------------------------------------------------------------------

def drift_per_position(m: DataFrame) -> DataFrame:
    """A1: mean deviation and non-null count per (run, position)."""
    return (m.groupBy("run_id", "position")
             .agg(F.avg("deviation").alias("mean_dev"),
                  F.count("deviation").alias("n_measurements"))
             .orderBy("run_id", F.desc("mean_dev"), "position"))


def drift_slope(m: DataFrame, buckets: int | None = None) -> DataFrame:
    """Least-squares slope of deviation on the time-ordered row index.

    x = 0..n-1 in (timestamp asc nulls last, measurement_id) order per run.
    n < 2 gives a null slope and ``insufficient data``.

    The regression sums are taken per run and range partition with the place
    in the partition as x, then shifted by the run's offset there and merged
    (means and centred sums, so nothing large is subtracted).
    """
    y, k = F.col("deviation"), F.col("__place").cast("double")
    seg = segments(
        m.select("run_id", "measurement_id", "timestamp", "deviation"), ["run_id"], ["timestamp", "measurement_id"],
        [F.regr_count(y, k).alias("c"), F.regr_avgx(y, k).alias("mx"), F.regr_avgy(y, k).alias("my"),
         F.regr_sxx(y, k).alias("sxx"), F.regr_sxy(y, k).alias("sxy")], partitions=buckets)
    seg = seg.withColumn("mx", F.col("mx") - F.col("_k0") + F.col("_off"))
    # One row per run and partition it has rows in.
    run = Window.partitionBy("run_id")
    c = F.col("c").cast("double")
    seg = seg.withColumn("ax", F.sum(c * F.col("mx")).over(run) / F.sum(c).over(run)).withColumn(
        "ay", F.sum(c * F.col("my")).over(run) / F.sum(c).over(run))
    dx, dy = F.col("mx") - F.col("ax"), F.col("my") - F.col("ay")
    agg = seg.groupBy("run_id").agg(
        F.sum("_n").alias("n_measurements"), F.sum(F.col("sxx") + c * dx * dx).alias("xx"),
        F.sum(F.col("sxy") + c * dx * dy).alias("xy")).withColumn(
        "slope", F.when(F.col("xx") > 0, F.col("xy") / F.col("xx")))
    slope = F.when(F.col("n_measurements") >= 2, F.col("slope"))
    direction = (F.when(F.col("n_measurements") < 2, F.lit("insufficient data"))
                  .when(slope > 0, F.lit("positive"))
                  .when(slope < 0, F.lit("negative"))
                  .otherwise(F.lit("flat")))
    return agg.select("run_id", "n_measurements", slope.alias("drift_slope"),
                      direction.alias("drift_direction"))


def recent_runs(runs: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` latest runs by run timestamp (ties: higher run_id first)."""
    return runs.orderBy(F.desc("timestamp"), F.desc("run_id")).limit(n)


def recent_run_drift(m: DataFrame, runs: DataFrame, n: int = 5,
                     buckets: int | None = None) -> DataFrame:
    """A10: per-position drift and run slope for the ``n`` latest runs.

    The top-n run list is tiny; a semi join restricts the measurement frame
    to those runs before any per-run work.
    """
    top = recent_runs(runs, n).select("run_id", F.col("timestamp").alias("run_timestamp"),
                                      "equipment_id")
    sub = m.join(top.select("run_id"), "run_id", "left_semi")
    per_pos = drift_per_position(sub)
    slopes = drift_slope(sub, buckets).select("run_id", "drift_slope", "drift_direction")
    return (per_pos.join(top, "run_id").join(slopes, "run_id", "left")
            .select("run_id", "run_timestamp", "equipment_id", "drift_slope",
                    "drift_direction", "position", "mean_dev", "n_measurements")
            .orderBy(F.desc("run_timestamp"), F.desc("run_id"), F.desc("mean_dev"), "position"))


# ---------------------------------------------------------------------------
# A3: run-to-run variation per position
# ---------------------------------------------------------------------------

def run_variation_series(m: DataFrame, as_of, lookback_days: int = 30,
                         positions: Sequence[str] | None = None) -> DataFrame:
    """Per (position, run) mean deviation and first timestamp."""
    return _variation_series(m, as_of, lookback_days, positions).orderBy("position", "timestamp", "run_id")


def _variation_series(m: DataFrame, as_of, lookback_days: int, positions: Sequence[str] | None) -> DataFrame:
    if positions is not None:
        m = m.filter(F.col("position").isin([p.upper() for p in positions]))
    m = lookback_filter(m, as_of, lookback_days)
    return (m.groupBy("position", "run_id")
             .agg(F.avg("deviation").alias("deviation"), F.min("timestamp").alias("timestamp")))


def run_variation(m: DataFrame, as_of, lookback_days: int = 30,
                  positions: Sequence[str] | None = None) -> DataFrame:
    """n_runs, mean, population std, cv (%), range per position.

    With ``positions`` given, a requested position without data comes back
    with ``n_runs = 0`` and null statistics.
    """
    s = _variation_series(m, as_of, lookback_days, positions)
    mean = F.avg("deviation")
    summary = (s.groupBy("position")
                .agg(F.count(F.lit(1)).alias("n_runs"), mean.alias("mean"),
                     F.stddev_pop("deviation").alias("std"),
                     (F.max("deviation") - F.min("deviation")).alias("range")))
    cv = F.when(F.col("mean") == 0, F.lit(INF)).otherwise(
        F.try_divide(F.col("std"), F.abs(F.col("mean"))) * 100)
    summary = summary.withColumn("cv", cv).select("position", "n_runs", "mean", "std", "cv", "range")
    if positions is not None:
        spark = m.sparkSession
        req = spark.createDataFrame([(p.upper(),) for p in positions], "position string")
        summary = (req.join(summary, "position", "left")
                   .withColumn("n_runs", F.coalesce("n_runs", F.lit(0).cast("long"))))
    return summary


# ---------------------------------------------------------------------------
# A4: control limits, out-of-control count, half-split trend, alert
# ---------------------------------------------------------------------------

def control_limits(m: DataFrame, as_of, cfg: AnalysisConfig = AnalysisConfig()) -> DataFrame:
    """Mean, population std, ucl/lcl per equipment in the lookback."""
    w = lookback_filter(m, as_of, cfg.lookback_days)
    lim = (w.groupBy("equipment_id")
             .agg(F.count(F.lit(1)).alias("n"), F.avg("deviation").alias("mean"),
                  F.stddev_pop("deviation").alias("std")))
    return (lim.withColumn("ucl", F.col("mean") + cfg.sigma * F.col("std"))
               .withColumn("lcl", F.col("mean") - cfg.sigma * F.col("std")))


def control_chart_points(m: DataFrame, as_of, cfg: AnalysisConfig = AnalysisConfig(),
                         limits: DataFrame | None = None) -> DataFrame:
    """A4e: every point in the lookback with its equipment's limits and flag."""
    w = lookback_filter(m, as_of, cfg.lookback_days)
    lim = (limits if limits is not None else control_limits(m, as_of, cfg)).select("equipment_id", "ucl", "lcl")
    # One row per equipment: AQE broadcasts it from its measured size.
    pts = w.select("equipment_id", "run_id", "measurement_id", "timestamp", "deviation").join(
        lim, "equipment_id")
    ooc = (F.col("deviation") > F.col("ucl")) | (F.col("deviation") < F.col("lcl"))
    return pts.withColumn("out_of_control", ooc).orderBy("equipment_id", "timestamp", "measurement_id")


def stability(m: DataFrame, as_of, cfg: AnalysisConfig = AnalysisConfig(),
              equipment: Sequence[str] | None = None, buckets: int | None = None) -> DataFrame:
    """A4a-d/f: Shewhart X-bar assessment per equipment.

    Columns: equipment_id, n, mean, std, ucl, lcl, out_of_control, trend_delta,
    trend, alert. A requested equipment without data gets ``alert = false``.
    """
    if equipment is not None:
        m = m.filter(F.col("equipment_id").isin(list(equipment)))
    lim = control_limits(m, as_of, cfg)
    pts = lookback_filter(m, as_of, cfg.lookback_days).select(
        "equipment_id", "measurement_id", "timestamp", "deviation")
    ix = ordered_index(pts, ["equipment_id"], ["timestamp", "measurement_id"], name="ix", buckets=buckets)
    # Limits and counts are one row per equipment (broadcast by AQE); one pass
    # over the points counts the out-of-control ones and averages each half.
    half = F.floor(F.col("n") / 2)
    outside = (F.col("deviation") > F.col("ucl")) | (F.col("deviation") < F.col("lcl"))
    per_eq = (ix.join(lim.select("equipment_id", "n", "ucl", "lcl"), "equipment_id")
                .groupBy("equipment_id")
                .agg(F.count_if(outside).alias("out_of_control"),
                     F.avg(F.when(F.col("ix") < half, F.col("deviation"))).alias("first_mean"),
                     F.avg(F.when(F.col("ix") >= half, F.col("deviation"))).alias("second_mean")))
    res = lim.join(per_eq, "equipment_id", "left")
    mid = F.floor(F.col("n") / 2)
    delta = F.when(mid >= 2, F.col("second_mean") - F.col("first_mean"))
    trend = (F.when(mid < 2, F.lit("insufficient data"))
              .when(delta > cfg.trend_delta, F.lit("degrading"))
              .when(delta < -cfg.trend_delta, F.lit("improving"))
              .otherwise(F.lit("stable")))
    alert = (F.abs(F.col("mean")) > cfg.alert_threshold) | (F.col("out_of_control") > 0)
    res = res.select("equipment_id", "n", "mean", "std", "ucl", "lcl",
                     F.coalesce("out_of_control", F.lit(0).cast("long")).alias("out_of_control"),
                     delta.alias("trend_delta"), trend.alias("trend"), alert.alias("alert"))
    if equipment is not None:
        spark = m.sparkSession
        req = spark.createDataFrame([(e,) for e in equipment], "equipment_id string")
        res = (req.join(res, "equipment_id", "left")
                  .withColumn("alert", F.coalesce("alert", F.lit(False))))
    return res


# ---------------------------------------------------------------------------
# Rankings, comparisons, trends, feeds
# ---------------------------------------------------------------------------

def worst_positions(m: DataFrame, top_n: int | None = 10) -> DataFrame:
    """A5 (A14 with top_n=5, A17 without a limit): mean |deviation| per position.

    ``n`` counts all rows. Top-n is a TakeOrderedAndProject: each task keeps
    its own n best before the single merge.
    """
    r = (m.groupBy("position")
          .agg(F.avg(F.abs("deviation")).alias("mean_abs_dev"), F.count(F.lit(1)).alias("n"))
          .orderBy(F.desc("mean_abs_dev"), "position"))
    return r.limit(top_n) if top_n is not None else r


def position_chart(m: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Every position's mean |deviation| with the alert flag."""
    return worst_positions(m, None).withColumn(
        "above_threshold", F.col("mean_abs_dev") > threshold)


def _dev_stats(m: DataFrame, key: str) -> DataFrame:
    return (m.groupBy(key)
             .agg(F.avg("deviation").alias("mean_dev"),
                  F.stddev_samp("deviation").alias("std_dev"),
                  F.count("deviation").alias("n_measurements")))


def equipment_comparison(m: DataFrame) -> DataFrame:
    """Mean, sample std, count per equipment, by |mean| descending."""
    return _dev_stats(m, "equipment_id").orderBy(F.abs("mean_dev").desc(), "equipment_id")


def operator_performance(m: DataFrame) -> DataFrame:
    """Same per operator, by std descending (nulls last); null operators out."""
    return (_dev_stats(m.filter(F.col("operator").isNotNull()), "operator")
            .orderBy(F.desc_nulls_last("std_dev"), "operator"))


def drift_alerts(m: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Equipment whose mean deviation exceeds the threshold in size."""
    return equipment_comparison(m).filter(F.abs("mean_dev") > threshold)


def equipment_snapshot(m: DataFrame, threshold: float = 0.5) -> DataFrame:
    """N, mean, min, max per equipment and the drift alert flag."""
    return (m.groupBy("equipment_id")
             .agg(F.count(F.lit(1)).alias("n"), F.avg("deviation").alias("mean_dev"),
                  F.min("deviation").alias("min_dev"), F.max("deviation").alias("max_dev"))
             .withColumn("alert", F.abs("mean_dev") > threshold)
             .orderBy("equipment_id"))


def time_trends(m: DataFrame, freq: str = "D") -> DataFrame:
    """Mean, sample std, count of deviation per calendar bucket.

    Null timestamps are dropped; empty buckets never appear. A multiple
    (``6h``, ``2D``) counts its buckets from midnight of the earliest row.
    """
    m = m.filter(F.col("timestamp").isNotNull())
    if multiple(freq):
        # The origin is one row of one partial aggregation.
        first = m.agg(F.min("timestamp").alias("_origin"))
        m = m.select("timestamp", "deviation").join(F.broadcast(first))  # one row
        by = bucket_from("timestamp", freq, F.col("_origin"))
    else:
        by = bucket("timestamp", freq)
    return (m.groupBy(by.alias("timestamp"))
             .agg(F.avg("deviation").alias("mean_dev"),
                  F.stddev_samp("deviation").alias("std_dev"),
                  F.count("deviation").alias("n_measurements"))
             .filter(F.col("mean_dev").isNotNull())
             .orderBy("timestamp"))


def equipment_boxplot(m: DataFrame, strategy: str = "auto") -> DataFrame:
    """Five-number summary (linear quantiles) of deviation per equipment.

    Equipment ids are few and hot, so the quantiles come from
    ``group_quantiles``: ``percentile`` while every equipment is below its
    size bound, exact ranking across tasks above it (``approx`` for the
    fixed-size sketch).
    """
    names = ["min", "q1", "median", "q3", "max"]
    q = group_quantiles(m.select("equipment_id", "deviation", "measurement_id"), ["equipment_id"],
                        "deviation", [0.0, 0.25, 0.5, 0.75, 1.0], names, strategy=strategy,
                        tie_break=["measurement_id"])
    n = m.groupBy("equipment_id").agg(F.count("deviation").alias("n"))
    return n.join(q, "equipment_id", "left").select("equipment_id", "n", *names).orderBy("equipment_id")


def deviation_over_time(m: DataFrame) -> DataFrame:
    """All measurements in time order with their equipment."""
    return (m.select("timestamp", "equipment_id", "position", "deviation", "measurement_id")
             .orderBy(F.col("timestamp").asc_nulls_last(), "measurement_id"))


# ---------------------------------------------------------------------------
# bundles
# ---------------------------------------------------------------------------

#: Sections of the summary, the column that each is grouped by, and what ``grouping_id`` says of it.
SECTIONS = {"worst_positions": ("position", 0b0111), "equipment_summary": ("equipment_id", 0b1011),
            "operator_summary": ("operator", 0b1101), "daily_trend": ("day", 0b1110)}


def summary_groups(m: DataFrame) -> DataFrame:
    """A9 in one scan: grouping sets over position, equipment, operator and day.

    Columns: section, the four keys (null but for the section's own), n (rows), n_measurements (deviations),
    mean_dev, std_dev, mean_abs_dev. Each task aggregates its rows before anything is shuffled; the result has a row
    for each distinct key.
    """
    keys = [k for k, _ in SECTIONS.values()]
    d = m.select("position", "equipment_id", "operator", bucket("timestamp", "D").alias("day"), "deviation")
    g = d.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(
        F.grouping_id().alias("_g"), F.count(F.lit(1)).alias("n"), F.count("deviation").alias("n_measurements"),
        F.avg("deviation").alias("mean_dev"), F.stddev_samp("deviation").alias("std_dev"),
        F.avg(F.abs("deviation")).alias("mean_abs_dev"))
    section = F.coalesce(*[F.when(F.col("_g") == bits, F.lit(name)) for name, (_, bits) in SECTIONS.items()])
    # The trend drops null times and days without a deviation, the operators' section null operators.
    keep = (F.when(section == "daily_trend", F.col("day").isNotNull() & F.col("mean_dev").isNotNull())
             .when(section == "operator_summary", F.col("operator").isNotNull()).otherwise(True))
    return g.filter(keep).select(section.alias("section"), *keys, "n", "n_measurements", "mean_dev", "std_dev", "mean_abs_dev")


def summary_report(m: DataFrame, cfg: AnalysisConfig = AnalysisConfig()) -> dict[str, DataFrame]:
    """The four summary sections, split from one scan (written once: a row for each distinct key)."""
    ensure_checkpoint_dir(m.sparkSession)
    g = summary_groups(m).checkpoint()
    part = lambda name: g.filter(F.col("section") == name)
    stats = ["mean_dev", "std_dev", "n_measurements"]
    return {
        "worst_positions": part("worst_positions").select("position", "mean_abs_dev", "n")
        .orderBy(F.desc("mean_abs_dev"), "position").limit(cfg.worst_top_n),
        "equipment_summary": part("equipment_summary").select("equipment_id", *stats)
        .orderBy(F.abs("mean_dev").desc(), "equipment_id"),
        "operator_summary": part("operator_summary").select("operator", *stats)
        .orderBy(F.desc_nulls_last("std_dev"), "operator"),
        "daily_trend": part("daily_trend").select(F.col("day").alias("timestamp"), *stats).orderBy("timestamp"),
    }


def report_frame(sections: dict[str, DataFrame]) -> DataFrame:
    """Sections as one frame: section, key (text), and the statistics that a section has."""
    out = None
    for name, df in sections.items():
        stats = [F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in (
            ("mean_dev", "double"), ("std_dev", "double"), ("mean_abs_dev", "double"), ("n_measurements", "long"), ("n", "long"))]
        part = df.select(F.lit(name).alias("section"), F.col(df.columns[0]).cast("string").alias("key"), *stats)
        out = part if out is None else out.unionByName(part)
    return out


def trend_report(m: DataFrame, runs: DataFrame, as_of, cfg: AnalysisConfig = AnalysisConfig(),
                 equipment: str | None = None, position: str | None = None,
                 lookback_days: int | None = None, row_cap: int = 20,
                 daily_cap: int = 30) -> dict[str, DataFrame]:
    """Every report section as a DataFrame, each capped for display.

    The caps are the report's own display limits; the uncapped frames are
    the section functions above.
    """
    if lookback_days is not None:
        cfg = cfg.with_(lookback_days=lookback_days)
    whole = summary_report(m, cfg)  # one scan for five sections
    out = {k: v.limit(daily_cap if k == "daily_trend" else row_cap) for k, v in whole.items()}
    if equipment is not None:
        out["stability"] = stability(m, as_of, cfg, equipment=[equipment])
        out["stability_series"] = control_chart_points(
            m.filter(F.col("equipment_id") == equipment), as_of, cfg).limit(row_cap)
    if position is not None:
        out["run_variation"] = run_variation(m, as_of, cfg.lookback_days, positions=[position])
        out["run_variation_series"] = run_variation_series(
            m, as_of, cfg.lookback_days, positions=[position]).limit(row_cap)
    out["recent_run_drift"] = recent_run_drift(m, runs, cfg.recent_runs)
    out["alerts"] = (whole["equipment_summary"].filter(F.abs("mean_dev") > cfg.alert_threshold)
                     .orderBy(F.abs("mean_dev").desc(), "equipment_id").limit(row_cap))
    return out
