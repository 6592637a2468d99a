"""DuckDB oracle SQL for the queries registered in ``__spark_entry__``.

The views ``m`` (events as measurements), ``ml`` (lineitem ⋈ part as
measurements) and the per-file batches ``fev`` / ``fli`` repeat the
mappings of ``metrolake.sources.tables`` in SQL. Doubles are rounded to 6
digits, as on the Spark side.
"""

from __future__ import annotations

from metrolake.config import STRICT_VALIDATION, AnalysisConfig, ValidationConfig

CFG = AnalysisConfig()
VCFG = ValidationConfig()
CUTOFF = "TIMESTAMP '2024-01-01 00:00:00'"  # as_of 2024-01-31 minus 30 days
CUTOFF_10D = "TIMESTAMP '2024-01-21 00:00:00'"  # as_of 2024-01-31 minus 10 days

M = """m AS (
  SELECT event_id AS measurement_id,
         CAST(day(ts) AS BIGINT) * 10 + user_id % 10 AS run_id,
         'POS_' || upper(event_type) AS position,
         value AS actual_value,
         CAST(50.0 AS DOUBLE) AS expected_value,
         value - CAST(50.0 AS DOUBLE) AS deviation,
         ts AS "timestamp",
         CASE WHEN (user_id % 10) % 3 = 0 THEN 'X' WHEN (user_id % 10) % 3 = 1 THEN 'Y' ELSE 'Z' END AS axis,
         'mm' AS unit,
         'TOOL_' || CAST(user_id % 10 AS VARCHAR) AS equipment_id,
         event_type AS operator
  FROM events)"""

ML = """ml AS (
  SELECT l.l_orderkey * 100 + row_number() OVER (PARTITION BY l.l_orderkey ORDER BY
             l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice,
             l_quantity, l_discount, l_tax, l_returnflag, l_linestatus) AS measurement_id,
         l.l_orderkey AS run_id,
         'POS_' || CAST(l.l_partkey AS VARCHAR) AS position,
         l.l_extendedprice AS actual_value,
         l.l_quantity * p.p_retailprice AS expected_value,
         l.l_extendedprice - l.l_quantity * p.p_retailprice AS deviation,
         l.l_shipdate AS "timestamp",
         l.l_linestatus AS axis,
         'usd' AS unit,
         'TOOL_' || CAST(l.l_suppkey AS VARCHAR) AS equipment_id,
         l.l_returnflag AS operator
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey)"""

FEV = """fev AS (SELECT 'run_' || CAST(run_id AS VARCHAR) AS source_file, measurement_id AS row_idx,
               "timestamp", position, actual_value, expected_value, deviation FROM m)"""
FLI = """fli AS (SELECT 'order_' || CAST(run_id AS VARCHAR) AS source_file, measurement_id AS row_idx,
               "timestamp", position, actual_value, expected_value, deviation FROM ml)"""

RUNS = """runs AS (
  SELECT run_id, min("timestamp") AS "timestamp",
         coalesce(arg_min(equipment_id, measurement_id) FILTER (WHERE equipment_id IS NOT NULL), 'UNKNOWN') AS equipment_id,
         arg_min(operator, measurement_id) FILTER (WHERE operator IS NOT NULL) AS operator
  FROM m GROUP BY run_id)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def r6(x: str) -> str:
    return f"round({x}, 6) + 0.0"


def _dev_stats(view: str, key: str, where: str = "") -> str:
    return (f"SELECT {key}, {r6('avg(deviation)')} AS mean_dev, {r6('stddev_samp(deviation)')} AS std_dev, "
            f"count(deviation) AS n_measurements FROM {view} {where} GROUP BY {key}")


def _trend(view: str, bucket: str) -> str:
    return (f"SELECT CAST({bucket} AS TIMESTAMP) AS \"timestamp\", {r6('avg(deviation)')} AS mean_dev, "
            f"{r6('stddev_samp(deviation)')} AS std_dev, count(deviation) AS n_measurements "
            f"FROM {view} WHERE \"timestamp\" IS NOT NULL GROUP BY 1")


def _slope(view: str) -> str:
    return f"""x AS (SELECT run_id, deviation,
         row_number() OVER (PARTITION BY run_id ORDER BY "timestamp" ASC NULLS LAST, measurement_id) - 1 AS x
         FROM {view}),
  sl AS (SELECT run_id, count(*) AS n_measurements, regr_slope(deviation, x) AS s FROM x GROUP BY run_id)"""


SLOPE_SELECT = """SELECT run_id, n_measurements,
  CASE WHEN n_measurements >= 2 THEN round(s, 6) + 0.0 END AS drift_slope,
  CASE WHEN n_measurements < 2 THEN 'insufficient data' WHEN s > 0 THEN 'positive'
       WHEN s < 0 THEN 'negative' ELSE 'flat' END AS drift_direction FROM sl"""


def _limits(sigma: float, cutoff: str = CUTOFF) -> str:
    return f"""w AS (SELECT * FROM m WHERE "timestamp" >= {cutoff}),
  lim AS (SELECT equipment_id, count(*) AS n, avg(deviation) AS mean, stddev_pop(deviation) AS std,
                 avg(deviation) + {sigma} * stddev_pop(deviation) AS ucl,
                 avg(deviation) - {sigma} * stddev_pop(deviation) AS lcl
          FROM w GROUP BY equipment_id)"""


# ---------------------------------------------------------------------------
# Quality checks on a per-file batch view (``fev`` or ``fli``)
# ---------------------------------------------------------------------------

def _check_ctes(f: str, cfg: ValidationConfig, stored: bool) -> str:
    gap_us = int(round(cfg.max_gap_hours * 3600 * 1_000_000))
    w_hours = cfg.duplicate_window_hours
    ov = ""
    if stored:
        ov = f""",
  rng AS (SELECT source_file, min("timestamp") - INTERVAL ({w_hours} * 3600000000) MICROSECOND AS lo,
                 max("timestamp") + INTERVAL ({w_hours} * 3600000000) MICROSECOND AS hi
          FROM {f} GROUP BY source_file),
  ov AS (SELECT r.source_file, count(s.measurement_id) AS n_st
         FROM rng r LEFT JOIN m s ON s."timestamp" >= r.lo AND s."timestamp" <= r.hi GROUP BY r.source_file)"""
    return f"""files AS (SELECT DISTINCT source_file FROM {f}),
  base AS (SELECT source_file, count(*) AS n_rows, count("timestamp") AS n_ts,
                  count(*) FILTER (WHERE actual_value IS NULL) + count(*) FILTER (WHERE expected_value IS NULL)
                  + count(*) FILTER (WHERE deviation IS NULL) AS n_null,
                  count(*) FILTER (WHERE abs(deviation) > {cfg.drift_threshold}) AS n_breach
           FROM {f} GROUP BY source_file),
  ord AS (SELECT source_file, count(*) FILTER (WHERE prev > "timestamp") AS inv FROM (
            SELECT source_file, "timestamp", lag("timestamp") OVER (PARTITION BY source_file ORDER BY row_idx) AS prev
            FROM {f} WHERE "timestamp" IS NOT NULL) GROUP BY source_file),
  gaps AS (SELECT source_file, count(*) FILTER (WHERE epoch_us("timestamp") - epoch_us(prev) > {gap_us}) AS n_gaps FROM (
            SELECT source_file, "timestamp", lag("timestamp") OVER (PARTITION BY source_file ORDER BY "timestamp") AS prev
            FROM {f} WHERE "timestamp" IS NOT NULL) GROUP BY source_file),
  dup AS (SELECT source_file, coalesce(sum(c) FILTER (WHERE c > 1), 0) AS n_dupes FROM (
            SELECT source_file, "timestamp", position, actual_value, count(*) AS c FROM {f}
            GROUP BY source_file, "timestamp", position, actual_value) GROUP BY source_file),
  ost AS (SELECT source_file, count(*) AS n, avg(deviation) AS mean, stddev_samp(deviation) AS std,
                 quantile_cont(deviation, 0.25) AS q1, quantile_cont(deviation, 0.75) AS q3,
                 min(deviation) AS mn, max(deviation) AS mx
          FROM {f} WHERE deviation IS NOT NULL GROUP BY source_file),
  ocnt AS (SELECT d.source_file,
                  count(*) FILTER (WHERE abs(d.deviation - o.mean) / o.std > {cfg.outlier_z}) AS n_z,
                  count(*) FILTER (WHERE d.deviation < o.q1 - {cfg.iqr_factor} * (o.q3 - o.q1)
                                      OR d.deviation > o.q3 + {cfg.iqr_factor} * (o.q3 - o.q1)) AS n_iqr,
                  count(*) FILTER (WHERE abs(d.deviation - o.mean) / o.std > {cfg.outlier_z}
                                      OR d.deviation < o.q1 - {cfg.iqr_factor} * (o.q3 - o.q1)
                                      OR d.deviation > o.q3 + {cfg.iqr_factor} * (o.q3 - o.q1)) AS n_out
           FROM {f} d JOIN ost o USING (source_file) WHERE d.deviation IS NOT NULL GROUP BY d.source_file){ov}"""


def _check_rows(cfg: ValidationConfig, stored: bool) -> dict[str, str]:
    ov_join = "LEFT JOIN ov USING (source_file)" if stored else ""
    n_st = "coalesce(ov.n_st, 0)" if stored else "0"
    return {
        "required_columns": """SELECT source_file, 0 AS check_order, 'required_columns' AS check_type,
            'pass' AS status, CAST(0 AS BIGINT) AS n_flagged FROM files""",
        "row_count": f"""SELECT source_file, 1 AS check_order, 'row_count' AS check_type,
            CASE WHEN n_rows < {cfg.min_rows} THEN 'fail' ELSE 'pass' END AS status,
            CAST(n_rows AS BIGINT) AS n_flagged FROM base""",
        "missing_measurements": """SELECT source_file, 2 AS check_order, 'missing_measurements' AS check_type,
            CASE WHEN n_null > 0 THEN 'warn' ELSE 'pass' END AS status,
            CAST(n_null AS BIGINT) AS n_flagged FROM base""",
        "timestamp_consistency": """SELECT b.source_file, 3 AS check_order, 'timestamp_consistency' AS check_type,
            CASE WHEN b.n_ts = 0 THEN 'warn'
                 WHEN coalesce(o.inv, 0) > 0 OR coalesce(g.n_gaps, 0) > 0 THEN 'warn' ELSE 'pass' END AS status,
            CAST(CASE WHEN b.n_ts = 0 THEN 0
                 ELSE coalesce(g.n_gaps, 0) + CASE WHEN coalesce(o.inv, 0) > 0 THEN 1 ELSE 0 END END AS BIGINT) AS n_flagged
            FROM base b LEFT JOIN ord o USING (source_file) LEFT JOIN gaps g USING (source_file)""",
        "duplicate_detection": f"""SELECT source_file, 4 AS check_order, 'duplicate_detection' AS check_type,
            CASE WHEN coalesce(dup.n_dupes, 0) > 0 OR {n_st} > 0 THEN 'warn' ELSE 'pass' END AS status,
            CAST(coalesce(dup.n_dupes, 0) + {n_st} AS BIGINT) AS n_flagged
            FROM files LEFT JOIN dup USING (source_file) {ov_join}""",
        "outlier_detection": f"""SELECT source_file, 5 AS check_order, 'outlier_detection' AS check_type,
            CASE WHEN coalesce(o.n, 0) < {cfg.min_outlier_points} THEN 'warn'
                 WHEN o.mn = o.mx THEN 'pass'
                 WHEN c.n_out = 0 THEN 'pass'
                 WHEN 100.0 * c.n_out / o.n > {cfg.outlier_fail_pct} THEN 'fail' ELSE 'warn' END AS status,
            CAST(CASE WHEN coalesce(o.n, 0) < {cfg.min_outlier_points} OR o.mn = o.mx THEN 0
                 ELSE c.n_out END AS BIGINT) AS n_flagged
            FROM files LEFT JOIN ost o USING (source_file) LEFT JOIN ocnt c USING (source_file)""",
        "deviation_range": """SELECT source_file, 6 AS check_order, 'deviation_range' AS check_type,
            CASE WHEN n_breach > 0 THEN 'warn' ELSE 'pass' END AS status,
            CAST(n_breach AS BIGINT) AS n_flagged FROM base""",
    }


def _suite(view_ctes: list[str], f: str, cfg: ValidationConfig, stored: bool,
           only: list[str] | None = None, outer: str | None = None) -> str:
    rows = _check_rows(cfg, stored)
    names = only or list(rows)
    body = "\nUNION ALL\n".join(f"({rows[n]})" for n in names)
    sql = _with(*view_ctes, _check_ctes(f, cfg, stored)) + body
    if outer:
        sql = _with(*view_ctes, _check_ctes(f, cfg, stored), f"suite AS ({body})") + outer
    return sql


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    # ---- analytics ----------------------------------------------------------
    q["equipment_comparison"] = _with(M) + _dev_stats("m", "equipment_id")
    q["operator_performance"] = _with(M) + _dev_stats("m", "operator", "WHERE operator IS NOT NULL")
    for name, view, n in [("worst_positions", "m", 10), ("worst_positions_bulk", "ml", 10),
                          ("top5_positions_bulk", "ml", 5)]:
        cte = M if view == "m" else ML
        q[name] = _with(cte) + (
            f"SELECT position, {r6('avg(abs(deviation))')} AS mean_abs_dev, count(*) AS n FROM {view} "
            f"GROUP BY position ORDER BY avg(abs(deviation)) DESC, position LIMIT {n}")
    q["drift_alerts"] = _with(M) + (
        f"SELECT * FROM ({_dev_stats('m', 'equipment_id')}) t WHERE abs(mean_dev) > {CFG.alert_threshold}")
    for name, view, cte in [("equipment_snapshot", "m", M), ("equipment_snapshot_bulk", "ml", ML)]:
        q[name] = _with(cte) + (
            f"SELECT equipment_id, count(*) AS n, {r6('avg(deviation)')} AS mean_dev, "
            f"{r6('min(deviation)')} AS min_dev, {r6('max(deviation)')} AS max_dev, "
            f"abs(avg(deviation)) > {CFG.alert_threshold} AS alert FROM {view} GROUP BY equipment_id")
    q["trend_hourly"] = _with(M) + _trend("m", "date_trunc('hour', \"timestamp\")")
    q["trend_daily"] = _with(M) + _trend("m", "date_trunc('day', \"timestamp\")")
    for name, step in (("trend_6h", "6 HOUR"), ("trend_2d", "2 DAY")):
        q[name] = _with(M) + _trend("m", f"time_bucket(INTERVAL {step}, \"timestamp\", "
                                         "(SELECT date_trunc('day', min(\"timestamp\")) FROM m)::TIMESTAMP)")
    q["trend_weekly"] = _with(M) + _trend("m", "CAST(date_trunc('week', \"timestamp\") AS DATE) + 6")
    q["trend_monthly"] = _with(M) + _trend("m", "last_day(\"timestamp\")")
    q["trend_month_start_bulk"] = _with(ML) + _trend("ml", "date_trunc('month', \"timestamp\")")
    q["trend_quarterly_bulk"] = _with(ML) + _trend(
        "ml", "CAST(date_trunc('quarter', \"timestamp\") + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE)")
    q["trend_yearly_bulk"] = _with(ML) + _trend(
        "ml", "CAST(date_trunc('year', \"timestamp\") + INTERVAL 12 MONTH - INTERVAL 1 DAY AS DATE)")
    q["drift_per_position"] = _with(M) + (
        f"SELECT run_id, position, {r6('avg(deviation)')} AS mean_dev, count(deviation) AS n_measurements "
        "FROM m GROUP BY run_id, position")
    q["drift_slope"] = _with(M, _slope("m")) + SLOPE_SELECT
    q["drift_slope_bulk"] = _with(ML, _slope("ml")) + SLOPE_SELECT
    q["recent_run_drift"] = _with(
        M, RUNS,
        """top AS (SELECT run_id, "timestamp" AS run_timestamp, equipment_id FROM runs
                   ORDER BY "timestamp" DESC, run_id DESC LIMIT 5)""",
        "sub AS (SELECT * FROM m WHERE run_id IN (SELECT run_id FROM top))",
        _slope("sub"),
        """pp AS (SELECT run_id, position, avg(deviation) AS mean_dev, count(deviation) AS n_measurements
                  FROM sub GROUP BY run_id, position)""") + """
      SELECT pp.run_id, t.run_timestamp, t.equipment_id,
             CASE WHEN sl.n_measurements >= 2 THEN round(sl.s, 6) + 0.0 END AS drift_slope,
             CASE WHEN sl.n_measurements < 2 THEN 'insufficient data' WHEN sl.s > 0 THEN 'positive'
                  WHEN sl.s < 0 THEN 'negative' ELSE 'flat' END AS drift_direction,
             pp.position, round(pp.mean_dev, 6) + 0.0 AS mean_dev, pp.n_measurements
      FROM pp JOIN top t USING (run_id) LEFT JOIN sl USING (run_id)"""
    q["run_listing"] = _with(M, RUNS) + "SELECT run_id, \"timestamp\", equipment_id, operator FROM runs"
    q["measurement_scan"] = _with(M, RUNS) + """
      SELECT m.measurement_id, m.run_id, m.position, round(m.actual_value, 6) + 0.0 AS actual_value,
             round(m.expected_value, 6) + 0.0 AS expected_value, round(m.deviation, 6) + 0.0 AS deviation, m."timestamp",
             m.axis, m.unit, r.equipment_id, r.operator
      FROM m JOIN runs r USING (run_id)"""
    def series(cutoff: str) -> str:
        return f"""s AS (SELECT position, run_id, avg(deviation) AS deviation, min("timestamp") AS "timestamp"
                FROM m WHERE "timestamp" >= {cutoff} GROUP BY position, run_id)"""
    variation = """
      SELECT position, count(*) AS n_runs, round(avg(deviation), 6) + 0.0 AS mean,
             round(stddev_pop(deviation), 6) + 0.0 AS std,
             round(CASE WHEN avg(deviation) = 0 THEN CAST('inf' AS DOUBLE)
                        ELSE stddev_pop(deviation) / abs(avg(deviation)) * 100 END, 6) + 0.0 AS cv,
             round(max(deviation) - min(deviation), 6) + 0.0 AS range
      FROM s GROUP BY position"""
    q["run_variation_series"] = _with(M, series(CUTOFF)) + (
        "SELECT position, run_id, round(deviation, 6) + 0.0 AS deviation, \"timestamp\" FROM s")
    q["run_variation"] = _with(M, series(CUTOFF)) + variation
    q["run_variation_10d"] = _with(M, series(CUTOFF_10D)) + variation
    q["run_variation_positions"] = _with(M, series(CUTOFF), f"v AS ({variation})") + """
      SELECT p.position, coalesce(v.n_runs, 0) AS n_runs, v.mean, v.std, v.cv, v.range
      FROM (VALUES ('POS_VIEW'), ('POS_ERROR'), ('POS_NOWHERE')) p(position) LEFT JOIN v USING (position)"""
    lim = _limits(CFG.sigma)
    q["control_limits"] = _with(M, lim) + (
        "SELECT equipment_id, n, round(mean, 6) + 0.0 AS mean, round(std, 6) + 0.0 AS std, round(ucl, 6) + 0.0 AS ucl, "
        "round(lcl, 6) + 0.0 AS lcl FROM lim")
    q["control_chart_points"] = _with(M, lim) + """
      SELECT w.equipment_id, w.run_id, w.measurement_id, w."timestamp", round(w.deviation, 6) + 0.0 AS deviation,
             round(lim.ucl, 6) + 0.0 AS ucl, round(lim.lcl, 6) + 0.0 AS lcl,
             (w.deviation > lim.ucl OR w.deviation < lim.lcl) AS out_of_control
      FROM w JOIN lim USING (equipment_id)"""
    def stability_sql(lim_cte: str) -> str:
        return _with(M, lim_cte, """ix AS (
        SELECT w.equipment_id, w.deviation, lim.n, lim.ucl, lim.lcl,
               row_number() OVER (PARTITION BY w.equipment_id ORDER BY w."timestamp" ASC NULLS LAST, w.measurement_id) - 1 AS ix
        FROM w JOIN lim USING (equipment_id))""", """agg AS (
        SELECT equipment_id,
               count(*) FILTER (WHERE deviation > ucl OR deviation < lcl) AS ooc,
               avg(deviation) FILTER (WHERE ix < floor(n / 2)) AS first_mean,
               avg(deviation) FILTER (WHERE ix >= floor(n / 2)) AS second_mean
        FROM ix GROUP BY equipment_id)""") + f"""
      SELECT lim.equipment_id, lim.n, round(lim.mean, 6) + 0.0 AS mean, round(lim.std, 6) + 0.0 AS std,
             round(lim.ucl, 6) + 0.0 AS ucl, round(lim.lcl, 6) + 0.0 AS lcl,
             CAST(coalesce(agg.ooc, 0) AS BIGINT) AS out_of_control,
             round(CASE WHEN floor(lim.n / 2) >= 2 THEN agg.second_mean - agg.first_mean END, 6) + 0.0 AS trend_delta,
             CASE WHEN floor(lim.n / 2) < 2 THEN 'insufficient data'
                  WHEN agg.second_mean - agg.first_mean > {CFG.trend_delta} THEN 'degrading'
                  WHEN agg.second_mean - agg.first_mean < -{CFG.trend_delta} THEN 'improving'
                  ELSE 'stable' END AS trend,
             (abs(lim.mean) > {CFG.alert_threshold} OR coalesce(agg.ooc, 0) > 0) AS alert
      FROM lim LEFT JOIN agg USING (equipment_id)"""
    q["stability"] = stability_sql(lim)
    q["stability_10d"] = stability_sql(_limits(CFG.sigma, CUTOFF_10D))
    # Every equipment is judged by itself, so the filter may follow.
    q["stability_equipment"] = f"""
      SELECT e.equipment_id, s.n, s.mean, s.std, s.ucl, s.lcl, s.out_of_control, s.trend_delta, s.trend,
             coalesce(s.alert, false) AS alert
      FROM (VALUES ('TOOL_1'), ('TOOL_7'), ('TOOL_NOWHERE')) e(equipment_id)
      LEFT JOIN ({stability_sql(lim)}) s USING (equipment_id)"""
    files = """files AS (SELECT CAST(doc_id AS VARCHAR) AS path, doc_id AS age,
        sha256(coalesce(text, '')) AS file_hash, source FROM documents)"""
    acts = """acts AS (SELECT path, first_value(path) OVER (PARTITION BY file_hash ORDER BY age, path) AS first_path,
        CASE WHEN file_hash IN (SELECT file_hash FROM files WHERE source = 'src1') THEN 'skip'
             WHEN row_number() OVER (PARTITION BY file_hash ORDER BY age, path) > 1 THEN 'twin'
             ELSE 'process' END AS action FROM files)"""
    q["file_hashes"] = _with(files) + "SELECT path, file_hash FROM files"
    q["known_files"] = _with(files, acts) + "SELECT path, first_path, action FROM acts"
    q["known_file_counts"] = _with(files, acts) + (
        "SELECT action AS status, count(*) AS files, count(*) AS rows FROM acts GROUP BY action")
    q["stored_measurements"] = _with(M, """f AS (SELECT 'run_' || CAST(run_id AS VARCHAR) AS source_file,
        measurement_id AS row_idx, * EXCLUDE (run_id, measurement_id) FROM m)""") + """
      SELECT (40 + dense_rank() OVER (ORDER BY source_file)) * 4294967296
               + row_number() OVER (PARTITION BY source_file ORDER BY row_idx) - 1 AS measurement_id,
             40 + dense_rank() OVER (ORDER BY source_file) AS run_id, position,
             round(actual_value, 6) + 0.0 AS actual_value, round(expected_value, 6) + 0.0 AS expected_value,
             round(deviation, 6) + 0.0 AS deviation, "timestamp", axis, unit, CAST("timestamp" AS DATE) AS ts_date
      FROM f"""
    q["equipment_boxplot"] = _with(M) + """
      SELECT equipment_id, count(deviation) AS n,
             round(quantile_cont(deviation, 0.0), 6) + 0.0 AS min, round(quantile_cont(deviation, 0.25), 6) + 0.0 AS q1,
             round(quantile_cont(deviation, 0.5), 6) + 0.0 AS median, round(quantile_cont(deviation, 0.75), 6) + 0.0 AS q3,
             round(quantile_cont(deviation, 1.0), 6) + 0.0 AS max
      FROM m GROUP BY equipment_id"""
    q["position_chart"] = _with(M) + (
        f"SELECT position, {r6('avg(abs(deviation))')} AS mean_abs_dev, count(*) AS n, "
        f"avg(abs(deviation)) > {CFG.alert_threshold} AS above_threshold FROM m GROUP BY position")
    q["deviation_over_time"] = _with(M) + (
        "SELECT \"timestamp\", equipment_id, position, round(deviation, 6) + 0.0 AS deviation, measurement_id FROM m")
    q["threshold_breaches"] = _with(M) + (
        "SELECT measurement_id, position, round(deviation, 6) + 0.0 AS deviation FROM m WHERE abs(deviation) > 100.0")

    # ---- quality checks -----------------------------------------------------
    ev = [M, FEV]
    li = [ML, FLI]
    q["v_required_columns"] = _suite(ev, "fev", VCFG, False, ["required_columns"])
    q["v_row_count"] = _suite(ev, "fev", VCFG, False, ["row_count"])
    q["v_missing"] = _suite(ev, "fev", VCFG, False, ["missing_measurements"])
    q["v_timestamps"] = _suite(ev, "fev", VCFG, False, ["timestamp_consistency"])
    q["v_timestamps_bulk"] = _suite(li, "fli", VCFG, False, ["timestamp_consistency"])
    q["v_duplicates_bulk"] = _suite(li, "fli", VCFG, False, ["duplicate_detection"])
    q["v_outliers"] = _suite(ev, "fev", VCFG, False, ["outlier_detection"])
    q["v_range"] = _suite(ev, "fev", VCFG, False, ["deviation_range"])
    q["v_suite"] = _suite(ev, "fev", VCFG, True)
    q["v_suite_bulk"] = _suite(li, "fli", VCFG, False)
    q["v_strict_suite"] = _suite(ev, "fev", STRICT_VALIDATION, False)
    q["v_rollup_bulk"] = _suite(li, "fli", VCFG, False, outer="""
      SELECT source_file, count(*) FILTER (WHERE status = 'pass') AS n_pass,
             count(*) FILTER (WHERE status = 'warn') AS n_warn,
             count(*) FILTER (WHERE status = 'fail') AS n_fail
      FROM suite GROUP BY source_file""")
    q["load_gate_bulk"] = _suite(li, "fli", VCFG, False, outer="""
      SELECT source_file, count(*) FILTER (WHERE status = 'fail') AS n_fail,
             count(*) FILTER (WHERE status = 'fail') = 0 AS accepted
      FROM suite GROUP BY source_file""")
    q["v_store_overlap"] = _with(M, FEV) + f"""
      , rng AS (SELECT source_file, min("timestamp") - INTERVAL 1 HOUR AS lo, max("timestamp") + INTERVAL 1 HOUR AS hi
                FROM fev GROUP BY source_file)
      SELECT r.source_file, count(s.measurement_id) AS n_stored_in_range
      FROM rng r LEFT JOIN m s ON s."timestamp" >= r.lo AND s."timestamp" <= r.hi GROUP BY r.source_file"""
    q["v_outlier_stats"] = _with(M, FEV, _check_ctes("fev", VCFG, False)) + """
      SELECT f.source_file, o.n, round(o.mean, 6) + 0.0 AS mean, round(o.std, 6) + 0.0 AS std, round(o.q1, 6) + 0.0 AS q1,
             round(o.q3, 6) + 0.0 AS q3, round(o.mn, 6) + 0.0 AS min, round(o.mx, 6) + 0.0 AS max, c.n_z, c.n_iqr,
             c.n_out AS n_outliers
      FROM files f LEFT JOIN ost o USING (source_file) LEFT JOIN ocnt c USING (source_file)"""
    q["v_range_breaches"] = _with(M, FEV) + """
      , b AS (SELECT source_file, position, row_number() OVER (PARTITION BY source_file ORDER BY row_idx) AS r
              FROM fev WHERE abs(deviation) > 100.0)
      SELECT source_file, count(*) AS n_breaches,
             string_agg(position, ',' ORDER BY r) FILTER (WHERE r <= 10) AS first_positions
      FROM b GROUP BY source_file"""

    # ---- readers over Spark-rendered text -------------------------------------
    canon = ("round(actual_value, 6) + 0.0 AS actual_value, round(expected_value, 6) + 0.0 AS expected_value, "
             "round(deviation, 6) + 0.0 AS deviation, operator, equipment_id")
    q["log_parse"] = _with(M) + (
        "SELECT 'run_' || CAST(run_id AS VARCHAR) || '.log' AS source_file, "
        "date_trunc('second', \"timestamp\") AS \"timestamp\", position, " + canon + " FROM m")
    q["csv_parse"] = _with(M) + (
        "SELECT 'run_' || CAST(run_id AS VARCHAR) || '.csv' AS source_file, \"timestamp\", position, "
        + canon + ", 'X' AS axis, 'mm' AS unit FROM m")
    q["json_parse"] = _with(M) + (
        "SELECT 'ev_' || CAST(measurement_id AS VARCHAR) || '.json' AS source_file, \"timestamp\", position, "
        + canon + ", CAST(CAST(json_extract(e.props, '$.k') AS BIGINT) AS VARCHAR) AS meta_data_k "
        "FROM m JOIN events e ON e.event_id = m.measurement_id")
    flog = """flog AS (SELECT 'run_' || CAST(run_id AS VARCHAR) || '.log' AS source_file, measurement_id AS row_idx,
               date_trunc('second', "timestamp") AS "timestamp", position, actual_value, expected_value, deviation
               FROM m)"""
    q["log_suite"] = _suite([M, flog], "flog", VCFG, False)

    # ---- missing-value strategies and metadata defaults ----------------------
    q["csv_quoted"] = _with(M) + """
      SELECT 'run_' || CAST(run_id AS VARCHAR) || '.csv' AS source_file, "timestamp", position,
             round(actual_value, 6) + 0.0 AS actual_value, round(deviation, 6) + 0.0 AS deviation,
             CASE measurement_id % 7 WHEN 0 THEN 'at ' || measurement_id || ', late'
                  WHEN 1 THEN 'the "' || measurement_id || '" one' WHEN 2 THEN 'first' || chr(10) || measurement_id
                  WHEN 3 THEN 'tube 5" ' || measurement_id WHEN 4 THEN 'no ' || measurement_id WHEN 5 THEN NULL
                  ELSE 'note ' || measurement_id END AS note
      FROM m"""
    q["csv_blank_rows"] = _with(M) + """
      SELECT 'run_' || CAST(run_id AS VARCHAR) || '.csv' AS source_file, measurement_id AS row_idx, position,
             round(actual_value, 6) + 0.0 AS actual_value
      FROM m WHERE measurement_id % 11 <> 0"""
    q["csv_required_columns"] = _with(M) + """
      , f AS (SELECT DISTINCT run_id, CASE run_id % 5 WHEN 0 THEN [] WHEN 1 THEN ['position']
                     WHEN 2 THEN ['actual_value', 'deviation', 'expected_value'] WHEN 3 THEN ['deviation', 'expected_value']
                     ELSE ['actual_value', 'deviation', 'expected_value', 'position'] END AS missing FROM m)
      SELECT 'run_' || CAST(run_id AS VARCHAR) || '.csv' AS source_file,
             CASE WHEN len(missing) > 0 THEN 'fail' ELSE 'pass' END AS status, len(missing) AS n_flagged,
             array_to_string(missing, ',') AS missing
      FROM f"""
    blank = """b AS (SELECT 'run_' || CAST(run_id AS VARCHAR) || '.csv' AS source_file, measurement_id AS row_idx,
                      "timestamp", position, CASE WHEN actual_value < 1.0 THEN NULL ELSE actual_value END AS actual_value,
                      expected_value FROM m),
           bd AS (SELECT *, actual_value - expected_value AS deviation FROM b)"""
    q["csv_missing_flag"] = _with(M, blank) + (
        "SELECT source_file, row_idx, round(actual_value, 6) + 0.0 AS actual_value, "
        "round(deviation, 6) + 0.0 AS deviation, (actual_value IS NULL) AS is_missing FROM bd")
    q["csv_missing_drop"] = _with(M, blank) + (
        "SELECT source_file, row_idx, round(actual_value, 6) + 0.0 AS actual_value, "
        "round(deviation, 6) + 0.0 AS deviation FROM bd WHERE actual_value IS NOT NULL")
    q["csv_missing_fill"] = _with(M, blank) + (
        "SELECT source_file, row_idx, round(coalesce(actual_value, 0.0), 6) + 0.0 AS actual_value, "
        "round(coalesce(deviation, 0.0), 6) + 0.0 AS deviation FROM bd")
    q["csv_missing_suite"] = _suite([M, blank], "bd", VCFG, False)
    # The log writes dd/MM/yyyy; an ambiguous date (day <= 12) is read month
    # first, as documented for the timestamp parser.
    txt = """t0 AS (SELECT *, date_trunc('second', "timestamp") AS ts0 FROM m),
           t AS (SELECT 'run_' || CAST(run_id AS VARCHAR) || '.txt' AS source_file,
                        CASE WHEN day(ts0) <= 12
                             THEN make_timestamp(year(ts0), day(ts0), month(ts0), hour(ts0), minute(ts0),
                                                 CAST(second(ts0) AS DOUBLE))
                             ELSE ts0 END AS "timestamp",
                        upper(operator) AS position, actual_value, expected_value, deviation, operator FROM t0)"""
    q["log_metadata_default"] = _with(M, txt) + (
        "SELECT source_file, \"timestamp\", position, round(actual_value, 6) + 0.0 AS actual_value, "
        "round(expected_value, 6) + 0.0 AS expected_value, round(deviation, 6) + 0.0 AS deviation, operator, "
        "'UNKNOWN' AS equipment_id FROM t")
    q["log_metadata_given"] = _with(M, txt) + (
        "SELECT source_file, \"timestamp\", 'TOOL_LAB' AS equipment_id, operator FROM t")
    # ---- outcome frames of a load ------------------------------------------------
    some = ["row_count", "timestamp_consistency", "outlier_detection"]
    fate = """
      , s AS (SELECT source_file, count(*) FILTER (WHERE status = 'fail') AS n_fail FROM suite GROUP BY source_file),
        z AS (SELECT f.source_file, count(*) AS n_rows,
                     count(*) FILTER (WHERE actual_value IS NULL OR expected_value IS NULL OR deviation IS NULL) AS n_null
              FROM fev f GROUP BY f.source_file),
        x AS (SELECT z.source_file, CAST(regexp_extract(z.source_file, '([0-9]+)$', 1) AS BIGINT) AS run, n_rows,
                     CASE WHEN n_fail > 0 OR n_null > 0 THEN 'failed' ELSE 'success' END AS status,
                     CASE WHEN n_fail > 0 THEN n_fail || ' validation failure(s) prevented load.'
                          WHEN n_null > 0 THEN 'NOT NULL constraint failed: ' || n_null
                               || ' row(s) with a null measurement value' END AS message
              FROM z JOIN s USING (source_file)),
        y AS (SELECT *, CASE WHEN status = 'success' THEN run + 1000 END AS run_id,
                     CASE WHEN status = 'success' THEN n_rows ELSE 0 END AS loaded FROM x)"""
    stamp = "TIMESTAMP '2024-01-31 00:00:00'"
    load = lambda sql: _suite([M, FEV], "fev", STRICT_VALIDATION, False, some, outer=fate + sql)
    q["load_ledger"] = load(f"""
      SELECT run AS file_id, source_file || '.csv' AS filename, CAST(NULL AS VARCHAR) AS file_hash,
             {stamp} AS import_timestamp, status, loaded AS rows_imported, message AS error_message, run_id,
             source_file AS path FROM y""")
    q["load_validation_rows"] = load(f"""
      SELECT run * 16 + check_order AS validation_id, run_id, check_type, suite.status, {stamp} AS created_at,
             source_file || '.csv' AS source_file, CAST(NULL AS VARCHAR) AS file_hash, check_order, n_flagged
      FROM suite JOIN y USING (source_file)""")
    q["load_summary"] = load("""
      SELECT source_file || '.csv' AS file, source_file AS path, status, loaded AS rows, run_id, message,
             status = 'success' AS accepted FROM y""")
    q["load_dry_run"] = load("""
      SELECT source_file || '.csv' AS file, source_file AS path, 'dry_run' AS status, n_rows AS rows,
             CAST(NULL AS BIGINT) AS run_id, message, status = 'success' AS accepted FROM y""")
    q["load_processed"] = load(f"""
      SELECT source_file AS path, source_file || '.csv' AS filename, CAST(NULL AS VARCHAR) AS file_hash, run_id,
             {stamp} AS import_timestamp FROM y WHERE status = 'success'""")
    q["load_counts"] = load("SELECT status, count(*) AS files, sum(loaded)::BIGINT AS rows FROM y GROUP BY status")
    q["transform_errors"] = _with(M) + """
      , f AS (SELECT run_id, count(*) AS n, run_id % 4 AS k FROM m GROUP BY run_id)
      SELECT 'run_' || CAST(run_id AS VARCHAR) || '.csv' AS source_file, CASE WHEN k IN (0, 1) THEN 0 ELSE n END AS n_rows,
             CASE WHEN k IN (0, 1) THEN 'transform_error' WHEN n < 5 THEN 'failed' ELSE 'success' END AS status,
             CASE k WHEN 0 THEN 'Columns that occur more than once: location'
                    WHEN 1 THEN 'Columns that occur more than once: nominal, reading'
                    ELSE CASE WHEN n < 5 THEN '1 validation failure(s) prevented load.' END END AS message
      FROM f"""
    for key, cte, view in (("hour_index", M, "m"), ("hour_index_bulk", ML, "ml")):
        q[key] = _with(cte) + f"""
          , h AS (SELECT CAST(floor(epoch_us("timestamp") / 3600000000) AS BIGINT) AS h, count(*) AS c FROM {view}
                  WHERE "timestamp" IS NOT NULL GROUP BY 1)
          SELECT h, c, CAST(sum(c) OVER (ORDER BY h) AS BIGINT) AS cum FROM h"""
    # ---- bundles ------------------------------------------------------------------
    def stats(key: str, view: str, where: str = "TRUE") -> str:
        return (f"SELECT {key} AS k, count(*) AS n, count(deviation) AS n_measurements, avg(deviation) AS mean_dev, "
                f"stddev_samp(deviation) AS std_dev, avg(abs(deviation)) AS mean_abs_dev FROM {view} WHERE {where} GROUP BY 1")

    def sections(view: str) -> str:
        return f"""
          , p AS ({stats("position", view)}), e AS ({stats("equipment_id", view)}),
            o AS ({stats("operator", view, "operator IS NOT NULL")}),
            t AS (SELECT * FROM ({stats("date_trunc('day', \"timestamp\")", view, '"timestamp" IS NOT NULL')})
                  WHERE mean_dev IS NOT NULL)"""

    def block(name: str, source: str, key: str = "k", worst: bool = False) -> str:
        own = ("CAST(NULL AS DOUBLE) AS mean_dev, CAST(NULL AS DOUBLE) AS std_dev, round(mean_abs_dev, 6) + 0.0 AS "
               "mean_abs_dev, CAST(NULL AS BIGINT) AS n_measurements, n" if worst else
               "round(mean_dev, 6) + 0.0 AS mean_dev, round(std_dev, 6) + 0.0 AS std_dev, CAST(NULL AS DOUBLE) AS "
               "mean_abs_dev, n_measurements, CAST(NULL AS BIGINT) AS n")
        return f"SELECT '{name}' AS section, {key} AS key, {own} FROM ({source})"
    day = "strftime(k, '%Y-%m-%d %H:%M:%S')"
    worst = block("worst_positions", "SELECT * FROM p ORDER BY mean_abs_dev DESC, k LIMIT 10", worst=True)
    q["summary_report"] = _with(M) + sections("m") + " UNION ALL ".join([
        worst, block("equipment_summary", "FROM e"), block("operator_summary", "FROM o"), block("daily_trend", "FROM t", day)])
    q["trend_report"] = _with(M) + sections("m") + " UNION ALL ".join([
        worst, block("equipment_summary", "SELECT * FROM e ORDER BY abs(mean_dev) DESC, k LIMIT 20"),
        block("operator_summary", "SELECT * FROM o ORDER BY std_dev DESC NULLS LAST, k LIMIT 20"),
        block("daily_trend", "SELECT * FROM t ORDER BY k LIMIT 30", day),
        block("alerts", "SELECT * FROM e WHERE abs(mean_dev) > 0.5 ORDER BY abs(mean_dev) DESC, k LIMIT 20")])
    rest = ("n, n_measurements, round(mean_dev, 6) + 0.0 AS mean_dev, round(std_dev, 6) + 0.0 AS std_dev, "
            "round(mean_abs_dev, 6) + 0.0 AS mean_abs_dev")
    none = {c: f"CAST(NULL AS {'TIMESTAMP' if c == 'day' else 'VARCHAR'}) AS {c}" for c in
            ("position", "equipment_id", "operator", "day")}
    q["summary_groups"] = _with(M) + sections("m") + " UNION ALL ".join(
        "SELECT '" + name + "' AS section, " + ", ".join(f"k AS {c}" if c == own else x for c, x in none.items())
        + f", {rest} FROM {source}" for name, own, source in (
            ("worst_positions", "position", "p"), ("equipment_summary", "equipment_id", "e"),
            ("operator_summary", "operator", "o"), ("daily_trend", "day", "t")))
    return q
