"""Thresholds and fixed values.

Thresholds are plain frozen dataclasses passed to operators (no YAML, no
global state). The fixed values below must equal the behaviour being
rebuilt: canonical column aliases, null tokens, supported suffixes.
"""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class ValidationConfig:
    """Per-file quality-check thresholds. All comparisons are strict ``>``."""

    outlier_z: float = 3.0
    max_gap_hours: float = 24.0
    duplicate_window_hours: float = 1.0
    min_rows: int = 5
    drift_threshold: float = 0.5
    outlier_fail_pct: float = 20.0
    iqr_factor: float = 1.5
    min_outlier_points: int = 4
    max_listed_positions: int = 10
    max_listed_gaps: int = 3

    def with_(self, **kw) -> "ValidationConfig":
        return replace(self, **kw)


# The tightened profile used for the custom-suite example.
STRICT_VALIDATION = ValidationConfig(
    outlier_z=2.0, max_gap_hours=4.0, duplicate_window_hours=0.5,
    drift_threshold=0.1, min_rows=8,
)


@dataclass(frozen=True)
class AnalysisConfig:
    lookback_days: int = 30
    alert_threshold: float = 0.5
    sigma: float = 3.0
    trend_delta: float = 0.01
    worst_top_n: int = 10
    recent_runs: int = 5

    def with_(self, **kw) -> "AnalysisConfig":
        return replace(self, **kw)


# ---------------------------------------------------------------------------
# Fixed values (must match the rebuilt behaviour exactly).
# ---------------------------------------------------------------------------

# Canonical column -> aliases in priority order; the canonical name is first.
COLUMN_ALIASES: dict[str, list[str]] = {
    "timestamp": ["timestamp", "time", "date", "datetime", "measured_at", "ts"],
    "position": ["position", "pos", "location", "point", "site", "id"],
    "actual_value": ["actual_value", "actual", "measured", "measured_value", "value", "reading"],
    "expected_value": ["expected_value", "expected", "nominal", "target", "reference", "ref"],
    "operator": ["operator", "user", "technician", "tech", "operator_id"],
    "equipment_id": ["equipment_id", "equipment", "machine", "tool", "tool_id", "system"],
    "axis": ["axis", "direction", "component"],
    "unit": ["unit", "units", "uom"],
}

MEASUREMENT_COLUMNS = ["actual_value", "expected_value", "deviation"]
REQUIRED_COLUMNS = ["position", "actual_value", "expected_value", "deviation"]
DUPLICATE_KEY_COLUMNS = ["timestamp", "position", "actual_value"]

# Text values read as null in CSV / workbook cells (the pandas default set).
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# Suffix -> format.
SUPPORTED_SUFFIXES = {
    ".csv": "csv", ".xlsx": "excel", ".xls": "excel", ".json": "json",
    ".log": "log", ".txt": "log",
}

# Keys of a top-level JSON object that may hold the record list, in order.
JSON_RECORD_KEYS = ["data", "measurements", "records", "results"]

# Check names in suite order.
CHECK_ORDER = [
    "required_columns", "row_count", "missing_measurements",
    "timestamp_consistency", "duplicate_detection", "outlier_detection",
    "deviation_range",
]

# Status vocabulary of the ingest summary and the import ledger.
INGEST_STATUSES = ["success", "failed", "skipped_duplicate", "extract_error",
                   "transform_error", "dry_run"]
