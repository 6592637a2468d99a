import pytest
from metrolake.operators import transforms as TR
from metrolake.operators.transforms import threshold_breaches, transform
from metrolake.sources import parsers as P


def _raw(spark, rows, file="f1"):
    """rows: list of dicts (one file)."""
    keys = sorted({k for r in rows for k in r})
    data = [(file, 0, i, {k: (None if v is None else str(v)) for k, v in r.items()}) for i, r in enumerate(rows)]
    raw = spark.createDataFrame(data, "source_file string, row_block long, row_idx long, fields map<string,string>")
    files = spark.createDataFrame([(file, keys)], "source_file string, raw_cols array<string>")
    return raw, files


def _run(spark, rows, **kw):
    raw, files = _raw(spark, rows)
    r, f = transform(raw, files, **kw)
    return r.orderBy("row_idx").collect(), f.first()


def test_alias_mapping_and_unknown_columns_kept(spark):
    rows, f = _run(spark, [{"time": "2024-01-01 00:00:00", "pos": "a1", "measured": "1.5", "nominal": "1.0",
                            "tech": "T1", "machine": "M1", "direction": "X", "uom": "mm", "batch": "b7"}])
    r = rows[0]
    assert (r["position"], r["actual_value"], r["expected_value"]) == ("A1", 1.5, 1.0)
    assert (r["operator"], r["equipment_id"], r["axis"], r["unit"]) == ("T1", "M1", "X", "mm")
    assert r["extras"] == {"batch": "b7"}
    assert r["deviation"] == pytest.approx(0.5)


def test_first_alias_in_priority_order_wins(spark):
    rows, _ = _run(spark, [{"position": "p", "value": "9", "actual": "1", "expected": "0"}])
    assert rows[0]["actual_value"] == 1.0
    assert rows[0]["extras"] == {"value": "9"}


def test_bad_date_and_bad_number_become_null(spark):
    rows, f = _run(spark, [{"timestamp": "not-a-date", "position": "p", "actual_value": "abc", "expected_value": "1"},
                           {"timestamp": "2024-01-02", "position": "p", "actual_value": "2", "expected_value": "1"}])
    assert rows[0]["timestamp"] is None and rows[0]["actual_value"] is None
    assert f["cast_fail_actual_value"] == 1


def test_existing_deviation_is_not_overwritten(spark):
    rows, f = _run(spark, [{"position": "p", "actual_value": "2", "expected_value": "1", "deviation": "7"},
                           {"position": "p", "actual_value": "2", "expected_value": "1", "deviation": None}])
    assert rows[0]["deviation"] == 7.0
    assert rows[1]["deviation"] is None        # column present: no per-row derivation


def test_missing_strategies(spark):
    data = [{"position": "p", "actual_value": "1", "expected_value": "1"},
            {"position": "p", "actual_value": None, "expected_value": "1"}]
    flagged, _ = _run(spark, data, missing_strategy="flag")
    assert [r["is_missing"] for r in flagged] == [False, True]
    dropped, _ = _run(spark, data, missing_strategy="drop")
    assert len(dropped) == 1
    filled, _ = _run(spark, data, missing_strategy="fill", fill_value=0.0)
    assert filled[1]["actual_value"] == 0.0
    assert filled[1]["deviation"] == 0.0       # fill runs after deviation: filled, not recomputed
    with pytest.raises(ValueError):
        _run(spark, data, missing_strategy="fill")
    with pytest.raises(ValueError):
        _run(spark, data, missing_strategy="guess")


def test_position_upper_and_metadata_defaults(spark):
    rows, f = _run(spark, [{"position": " pos_a1 ", "actual_value": "1", "expected_value": "1", "operator": None}])
    assert rows[0]["position"] == "POS_A1"
    assert rows[0]["equipment_id"] == "UNKNOWN" and rows[0]["operator"] == "UNKNOWN"
    rows2, _ = _run(spark, [{"position": "p", "actual_value": "1", "expected_value": "1"}],
                    equipment_id="EQ9", operator="OPX")
    assert (rows2[0]["equipment_id"], rows2[0]["operator"]) == ("EQ9", "OPX")


def test_partial_null_metadata_stays(spark):
    rows, _ = _run(spark, [{"position": "p", "actual_value": "1", "expected_value": "1", "operator": "A"},
                           {"position": "p", "actual_value": "1", "expected_value": "1", "operator": None}])
    assert [r["operator"] for r in rows] == ["A", None]


def test_threshold_breaches(spark):
    df = spark.createDataFrame([("a", 0.004), ("b", -0.002), ("c", -0.01)], "position string, deviation double")
    got = sorted(r["position"] for r in threshold_breaches(df, 0.003).collect())
    assert got == ["a", "c"]


def test_mixed_files_choose_aliases_per_file(spark):
    data = [("f1", 0, 0, {"actual": "1", "value": "9", "expected": "0", "position": "p"}),
            ("f2", 0, 0, {"value": "5", "expected": "0", "position": "p"})]
    raw = spark.createDataFrame(data, "source_file string, row_block long, row_idx long, fields map<string,string>")
    files = spark.createDataFrame([("f1", ["actual", "value", "expected", "position"]),
                                   ("f2", ["value", "expected", "position"])],
                                  "source_file string, raw_cols array<string>")
    r, _ = transform(raw, files)
    got = {x["source_file"]: x["actual_value"] for x in r.collect()}
    assert got == {"f1": 1.0, "f2": 5.0}


def test_drop_blank_rows_opt_in(spark):
    data = [{"position": "p", "actual_value": "1", "expected_value": "1"},
            {"position": None, "actual_value": None, "expected_value": None}]
    kept, _ = _run(spark, data)
    assert len(kept) == 2                       # default: the blank row stays (and reads position NAN)
    assert kept[1]["position"] == "NAN"
    dropped, _ = _run(spark, data, drop_blank=True)
    assert len(dropped) == 1


def test_step_functions_equal_fused_chain(spark):
    from metrolake.operators import transforms as T
    data = [{"time": "2024-01-01 00:00:00", "pos": " a1 ", "measured": "1.5", "nominal": "1.0", "user": None},
            {"time": "bad", "pos": "b2", "measured": "x", "nominal": "1.0", "user": None},
            {"time": "2024-01-02", "pos": None, "measured": "2", "nominal": None, "user": None}]
    raw, files = _raw(spark, data)
    fused, _ = T.transform(raw, files, missing_strategy="fill", fill_value=-1.0, equipment_id="EQ")
    r, f = T.normalize_columns(raw, files)
    r = T.cast_numeric(T.parse_timestamps(r)).drop("_cast_fail_actual_value", "_cast_fail_expected_value",
                                                   "_cast_fail_deviation")
    r, f = T.calculate_deviation(r, f)
    r = T.handle_missing(r, f, "fill", -1.0)
    r = T.normalize_positions(r)
    r, f = T.add_run_metadata(r, f, equipment_id="EQ")
    cols = ["row_idx", "timestamp", "position", "actual_value", "expected_value", "deviation", "operator",
            "equipment_id"]
    assert r.select(*cols).orderBy("row_idx").collect() == fused.select(*cols).orderBy("row_idx").collect()


def _log_lines(spark, n_files=5):
    return spark.createDataFrame(
        [(f"f{k % n_files}.log", 0, k, f"2024-03-01 08:{k:02d}:00 pos=a{k} reading={k} nominal=1 tech=t") for k in range(40)]
        + [("f0.log", 0, 90, "just=one"), ("f0.log", 0, 91, "# no=record at=all")],
        "path string, row_block long, row_idx long, line string")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_log_patterns_run_once_a_line(spark):
    rows = P.parse_log(_log_lines(spark)).rows
    assert rows.count() == 40  # the record with one field is dropped
    # A filter on the fields was pushed below them with all their patterns.
    assert _plan(rows).count("regexp_extract_all") == 2


def test_rows_are_never_broadcast_to_the_file_frames(spark, monkeypatch, tmp_path):
    _log_lines(spark).write.parquet(str(tmp_path / "lines"))
    b = P.parse_log(spark.read.parquet(str(tmp_path / "lines")))
    raw, files = b.rows.withColumnRenamed("path", "source_file"), b.files.withColumnRenamed("path", "source_file")
    few, few_files = TR.transform(raw, files)
    assert "BuildRight" in _plan(few) and "BuildLeft" not in _plan(few) and "SortMergeJoin" not in _plan(few)
    monkeypatch.setattr(TR, "MAX_BROADCAST_FILES", 4)  # five files
    many, many_files = TR.transform(raw, files)
    assert "SortMergeJoin" in _plan(many) and "BroadcastHashJoin" not in _plan(many)
    got = [sorted(map(str, x.collect())) for x in (few, many, few_files, many_files)]
    assert got[0] == got[1] and got[2] == got[3] and len(got[0]) == 40 and len(got[2]) == 5
    assert {(r.equipment_id, r.operator) for r in few.collect()} == {("UNKNOWN", "t")}
