"""

Every query reads the driver's Parquet tables (``events``, ``lineitem``,
``part``) through the measurement views of ``metrolake.sources.tables`` and
runs one metrolake operator over the whole tables. Floating results are
rounded to 6 digits here and in the oracle SQL so that both engines'
last-bit summation differences do not show.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

# The package and the helper modules live next to this file.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from metrolake.config import STRICT_VALIDATION, AnalysisConfig, ValidationConfig
from metrolake.operators import analytics as A
from metrolake.operators import transforms as TR
from metrolake.operators import validation as V
from metrolake.plans import ingest, outcomes
from metrolake.plans.runs import build_runs
from metrolake.session import apply_conf
from metrolake.sources import parsers as P
from metrolake.sources import tables as T
from metrolake.sources.files import content_hash
import feeds
from oracle_queries import oracle_sql as _oracle_sql

# The training-data operators (subpackage llm, with corpus_pipeline.py) are an optional part.
try:
    from metrolake.llm import registry as _llm
except ImportError as e:
    if e.name not in ("metrolake.llm", "metrolake.llm.registry", "corpus_pipeline"):
        raise
    _llm = None

AS_OF = "2024-01-31 00:00:00"
CFG = AnalysisConfig()
VCFG = ValidationConfig()


def _r(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (presentation for the cross-engine check)."""
    return df.select(*[
        F.round(F.col(f.name), digits).alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def _m(spark, d):
    return T.events_measurements(spark, d)


def _ml(spark, d):
    return T.lineitem_measurements(spark, d)


def _ev_files(spark, d):
    rows = T.as_file_batch(_m(spark, d), prefix="run_")
    return rows, V.files_of(rows)


def _li_files(spark, d):
    rows = T.as_file_batch(_ml(spark, d), prefix="order_")
    return rows, V.files_of(rows)


def _runs(spark, d):
    return build_runs(_m(spark, d), key="run_id", order=("measurement_id",), as_of=AS_OF)


def _checks(df: DataFrame) -> DataFrame:
    return df.select("source_file", "check_order", "check_type", "status", "n_flagged")


CANON_OUT = ["source_file", "timestamp", "position", "actual_value", "expected_value", "deviation",
             "operator", "equipment_id"]


def _parsed(batch) -> DataFrame:
    """Reader output -> full transform chain -> canonical columns."""
    rows, _ = TR.transform(batch.rows.withColumnRenamed("path", "source_file"),
                           batch.files.withColumnRenamed("path", "source_file"))
    return rows


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: equipment comparison over the sf0.001 events."""
    apply_conf(spark)
    return _r(A.equipment_comparison(_m(spark, "/root/testdata/sf0.001")))


def _q() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

    # ---- analytics over stored measurements (A1-A18, S14, S18) ----------
    q["equipment_comparison"] = lambda s, d: _r(A.equipment_comparison(_m(s, d)))
    q["operator_performance"] = lambda s, d: _r(A.operator_performance(_m(s, d)))
    q["worst_positions"] = lambda s, d: _r(A.worst_positions(_m(s, d), 10))
    q["worst_positions_bulk"] = lambda s, d: _r(A.worst_positions(_ml(s, d), 10))
    q["top5_positions_bulk"] = lambda s, d: _r(A.worst_positions(_ml(s, d), 5))
    q["drift_alerts"] = lambda s, d: _r(A.drift_alerts(_m(s, d), CFG.alert_threshold))
    q["equipment_snapshot"] = lambda s, d: _r(A.equipment_snapshot(_m(s, d), CFG.alert_threshold))
    q["equipment_snapshot_bulk"] = lambda s, d: _r(A.equipment_snapshot(_ml(s, d), CFG.alert_threshold))
    q["trend_hourly"] = lambda s, d: _r(A.time_trends(_m(s, d), "h"))
    q["trend_daily"] = lambda s, d: _r(A.time_trends(_m(s, d), "D"))
    q["trend_6h"] = lambda s, d: _r(A.time_trends(_m(s, d), "6h"))
    q["trend_2d"] = lambda s, d: _r(A.time_trends(_m(s, d), "2D"))
    q["trend_weekly"] = lambda s, d: _r(A.time_trends(_m(s, d), "W"))
    q["trend_monthly"] = lambda s, d: _r(A.time_trends(_m(s, d), "ME"))
    q["trend_month_start_bulk"] = lambda s, d: _r(A.time_trends(_ml(s, d), "MS"))
    q["trend_quarterly_bulk"] = lambda s, d: _r(A.time_trends(_ml(s, d), "QE"))
    q["trend_yearly_bulk"] = lambda s, d: _r(A.time_trends(_ml(s, d), "YE"))
    q["drift_per_position"] = lambda s, d: _r(A.drift_per_position(_m(s, d)))
    q["drift_slope"] = lambda s, d: _r(A.drift_slope(_m(s, d)))
    q["drift_slope_bulk"] = lambda s, d: _r(A.drift_slope(_ml(s, d)))
    q["recent_run_drift"] = lambda s, d: _r(A.recent_run_drift(_m(s, d), _runs(s, d), CFG.recent_runs))
    q["run_listing"] = lambda s, d: _r(A.run_listing(_runs(s, d)))
    q["measurement_scan"] = lambda s, d: _r(A.measurement_frame(
        _m(s, d).drop("equipment_id", "operator"), _runs(s, d)))
    q["run_variation_series"] = lambda s, d: _r(A.run_variation_series(_m(s, d), AS_OF, CFG.lookback_days))
    q["run_variation"] = lambda s, d: _r(A.run_variation(_m(s, d), AS_OF, CFG.lookback_days))
    q["run_variation_10d"] = lambda s, d: _r(A.run_variation(_m(s, d), AS_OF, 10))
    q["stability_10d"] = lambda s, d: _r(A.stability(_m(s, d), AS_OF, CFG.with_(lookback_days=10)))
    q["control_limits"] = lambda s, d: _r(A.control_limits(_m(s, d), AS_OF, CFG))
    q["control_chart_points"] = lambda s, d: _r(A.control_chart_points(_m(s, d), AS_OF, CFG))
    q["stability"] = lambda s, d: _r(A.stability(_m(s, d), AS_OF, CFG))
    q["equipment_boxplot"] = lambda s, d: _r(A.equipment_boxplot(_m(s, d)))
    q["position_chart"] = lambda s, d: _r(A.position_chart(_m(s, d), CFG.alert_threshold))
    q["deviation_over_time"] = lambda s, d: _r(A.deviation_over_time(_m(s, d)))
    q["threshold_breaches"] = lambda s, d: _r(
        TR.threshold_breaches(_m(s, d), 100.0).select("measurement_id", "position", "deviation"))

    q["run_variation_positions"] = lambda s, d: _r(A.run_variation(
        _m(s, d), AS_OF, CFG.lookback_days, positions=["pos_view", "POS_ERROR", "POS_NOWHERE"]))
    q["stability_equipment"] = lambda s, d: _r(A.stability(
        _m(s, d), AS_OF, CFG, equipment=["TOOL_1", "TOOL_7", "TOOL_NOWHERE"]))

    # ---- the ingest's own frames (S6, S8, S9, S12, S16) over the given tables --
    def text_files(s, d):
        """Every document plays a file: its id the path and age, its text the content."""
        return T.read_table(s, d, "documents").select(
            F.col("doc_id").cast("string").alias("path"), F.timestamp_seconds("doc_id").alias("modificationTime"),
            content_hash(F.coalesce("text", F.lit("")).cast("binary")).alias("file_hash"), "source")

    def known(s, d):
        f = text_files(s, d)
        return ingest.split_known(f.drop("source"), f.filter("source = 'src1'").select("file_hash"))

    q["file_hashes"] = lambda s, d: text_files(s, d).select("path", "file_hash")
    q["known_files"] = lambda s, d: known(s, d).select("path", F.col("_first").alias("first_path"),
                                                       F.col("_action").alias("action"))
    q["known_file_counts"] = lambda s, d: ingest.outcome_counts(known(s, d).select(
        F.col("_action").alias("status"), F.lit(1).cast("long").alias("rows")))

    def stored(s, d):
        rows, files = _ev_files(s, d)
        listing = files.select(F.col("source_file").alias("path"), F.lit(0).alias("modificationTime"))
        return ingest.stored_measurements(ingest.measurement_rows(rows, ingest.assign_run_ids(listing, 40)))

    q["stored_measurements"] = lambda s, d: _r(stored(s, d))

    # ---- bundles (A9, A12): one scan, split into sections ------------------
    q["summary_groups"] = lambda s, d: _r(A.summary_groups(_m(s, d)))
    q["summary_report"] = lambda s, d: _r(A.report_frame(A.summary_report(_m(s, d), CFG)))

    def trend_sections(s, d):
        r = A.trend_report(_m(s, d), _runs(s, d), AS_OF, CFG)
        return A.report_frame({k: r[k] for k in (*A.SECTIONS, "alerts")})

    q["trend_report"] = lambda s, d: _r(trend_sections(s, d))

    # ---- outcome frames of a load (S10, S11, S13, S15, S16, S17): orders play files, runs the strict profile --
    stamp = lambda: F.lit(AS_OF).cast("timestamp_ntz")  # noqa: E731 - needs a session

    def loaded(s, d):
        """(results, file frame as the load numbers it, outcomes) of checked files; no hash."""
        rows, files = _ev_files(s, d)
        results = V.run_checks(rows, files, STRICT_VALIDATION, checks=("row_count", "timestamp_consistency",
                                                                       "outlier_detection"))
        state = outcomes.file_outcomes(rows, files, results)
        run = F.regexp_extract("source_file", "([0-9]+)$", 1).cast("long")
        return results, state.select(
            F.col("source_file").alias("path"), F.concat("source_file", F.lit(".csv")).alias("file_name"),
            F.lit(None).cast("string").alias("file_hash"), run.alias("file_id"),
            F.when(F.col("_status") == "success", run + 1000).alias("run_id"), "n_rows", "_status", "_message")

    q["load_ledger"] = lambda s, d: outcomes.ledger_rows(loaded(s, d)[1], stamp())
    q["load_validation_rows"] = lambda s, d: outcomes.validation_rows(*loaded(s, d), stamp()).drop("details")
    q["load_summary"] = lambda s, d: outcomes.summary_rows(loaded(s, d)[1])
    q["load_dry_run"] = lambda s, d: outcomes.dry_run_rows(loaded(s, d)[1])
    q["load_processed"] = lambda s, d: outcomes.processed(outcomes.ledger_rows(loaded(s, d)[1], stamp()))
    q["load_counts"] = lambda s, d: ingest.outcome_counts(outcomes.summary_rows(loaded(s, d)[1]))

    def clashing(s, d):
        b = P.parse_csv(feeds.csv_lines_clashing(s, d))
        rows, files = TR.transform(b.rows.withColumnRenamed("path", "source_file"),
                                   b.files.withColumnRenamed("path", "source_file"))
        return outcomes.file_outcomes(rows, files, V.check_row_count(rows, files, VCFG)).select(
            "source_file", "n_rows", F.col("_status").alias("status"), F.col("_message").alias("message"))

    q["transform_errors"] = clashing
    q["hour_index"] = lambda s, d: V.hour_index(_m(s, d))
    q["hour_index_bulk"] = lambda s, d: V.hour_index(_ml(s, d))

    # ---- per-file quality checks (V1-V11); a run plays one file ---------
    q["v_required_columns"] = lambda s, d: _checks(V.check_required_columns(*_ev_files(s, d), VCFG))
    q["v_row_count"] = lambda s, d: _checks(V.check_row_count(*_ev_files(s, d), VCFG))
    q["v_missing"] = lambda s, d: _checks(V.check_missing(*_ev_files(s, d), VCFG))
    q["v_timestamps"] = lambda s, d: _checks(V.check_timestamps(*_ev_files(s, d), VCFG))
    q["v_timestamps_bulk"] = lambda s, d: _checks(V.check_timestamps(*_li_files(s, d), VCFG))
    q["v_duplicates_bulk"] = lambda s, d: _checks(V.check_duplicates(*_li_files(s, d), VCFG))
    q["v_store_overlap"] = lambda s, d: V.store_overlap(_ev_files(s, d)[0], _m(s, d), VCFG.duplicate_window_hours)
    q["v_outlier_stats"] = lambda s, d: _r(V.outlier_stats(*_ev_files(s, d), VCFG).drop("present_cols"))
    q["v_outliers"] = lambda s, d: _checks(V.check_outliers(*_ev_files(s, d), VCFG))
    q["v_range_breaches"] = lambda s, d: V.range_breaches(_ev_files(s, d)[0], 100.0).select(
        "source_file", "n_breaches", F.array_join("first_positions", ",").alias("first_positions"))
    q["v_range"] = lambda s, d: _checks(V.check_deviation_range(*_ev_files(s, d), VCFG))
    q["v_suite"] = lambda s, d: _checks(V.run_checks(*_ev_files(s, d), VCFG, stored=_m(s, d)))
    q["v_suite_bulk"] = lambda s, d: _checks(V.run_checks(*_li_files(s, d), VCFG))
    q["v_rollup_bulk"] = lambda s, d: V.rollup(V.run_checks(*_li_files(s, d), VCFG))
    q["load_gate_bulk"] = lambda s, d: V.load_gate(V.run_checks(*_li_files(s, d), VCFG))
    q["v_strict_suite"] = lambda s, d: _checks(V.run_checks(*_ev_files(s, d), STRICT_VALIDATION))

    # ---- readers (S1, S3, S4) and the transform chain (T1-T10) ------------
    q["log_parse"] = lambda s, d: _r(_parsed(P.parse_log(feeds.log_lines(s, d))).select(*CANON_OUT))
    q["csv_parse"] = lambda s, d: _r(_parsed(P.parse_csv(feeds.csv_lines(s, d))).select(*CANON_OUT, "axis", "unit"))
    q["json_parse"] = lambda s, d: _r(_parsed(P.parse_json(feeds.json_documents(s, d))).select(
        *CANON_OUT, F.element_at("extras", F.lit("meta_data_k")).alias("meta_data_k")))
    q["log_suite"] = lambda s, d: _checks(V.run_checks(*TR.transform(
        P.parse_log(feeds.log_lines(s, d)).rows.withColumnRenamed("path", "source_file"),
        P.parse_log(feeds.log_lines(s, d)).files.withColumnRenamed("path", "source_file")), materialize=True))
    def blanks(s, d, **kw):
        b = P.parse_csv(feeds.csv_lines_with_blanks(s, d))
        return TR.transform(b.rows.withColumnRenamed("path", "source_file"),
                            b.files.withColumnRenamed("path", "source_file"), **kw)

    q["csv_missing_flag"] = lambda s, d: _r(blanks(s, d)[0].select(
        "source_file", "row_idx", "actual_value", "deviation", "is_missing"))
    q["csv_missing_drop"] = lambda s, d: _r(blanks(s, d, missing_strategy="drop")[0].select(
        "source_file", "row_idx", "actual_value", "deviation"))
    q["csv_missing_fill"] = lambda s, d: _r(blanks(s, d, missing_strategy="fill", fill_value=0.0)[0].select(
        "source_file", "row_idx", "actual_value", "deviation"))
    q["csv_missing_suite"] = lambda s, d: _checks(V.run_checks(*blanks(s, d), materialize=True))

    q["csv_quoted"] = lambda s, d: _r(_parsed(P.parse_csv(feeds.csv_lines_quoted(s, d))).select(
        "source_file", "timestamp", "position", "actual_value", "deviation",
        F.element_at("extras", F.lit("note")).alias("note")))

    def blank_rows(s, d):
        b = P.parse_csv(feeds.csv_lines_with_empty_rows(s, d))
        return TR.transform(b.rows.withColumnRenamed("path", "source_file"),
                            b.files.withColumnRenamed("path", "source_file"), drop_blank=True)[0]

    q["csv_blank_rows"] = lambda s, d: _r(blank_rows(s, d).select("source_file", "row_idx", "position", "actual_value"))

    def short_files(s, d):
        b = P.parse_csv(feeds.csv_lines_short(s, d))
        return TR.transform(b.rows.withColumnRenamed("path", "source_file"),
                            b.files.withColumnRenamed("path", "source_file"))

    q["csv_required_columns"] = lambda s, d: V.check_required_columns(*short_files(s, d), VCFG).select(
        "source_file", "status", "n_flagged", F.when(F.col("n_flagged") > 0, F.regexp_replace(
            F.regexp_extract("details", r"\[(.*)\]", 1), "[' ]", "")).otherwise("").alias("missing"))

    def no_equipment(s, d, **kw):
        b = P.parse_log(feeds.log_lines_without_equipment(s, d))
        return TR.transform(b.rows.withColumnRenamed("path", "source_file"),
                            b.files.withColumnRenamed("path", "source_file"), **kw)[0]

    q["log_metadata_default"] = lambda s, d: _r(no_equipment(s, d).select(*CANON_OUT))
    q["log_metadata_given"] = lambda s, d: _r(no_equipment(s, d, equipment_id="TOOL_LAB").select(
        "source_file", "timestamp", "equipment_id", "operator"))
    return q


def _with_conf(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Apply metrolake's runtime SQL settings (UTC session time, AQE, last-wins
    map keys) to the caller's session before building the query."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_conf(spark)
        return fn(spark, sf_dir)
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = _q() | (_llm.queries() if _llm else {})
    return {k: _with_conf(v) for k, v in own.items()}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for each key of ``queries()`` that SQL can express."""
    return _oracle_sql() | (_llm.oracle_sql() if _llm else {})
