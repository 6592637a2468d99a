import datetime as dt
import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from metrolake.operators import analytics as A
from metrolake.operators.ordered import ordered_index
from metrolake.plans.ingest import ingest_folder, outcome_counts
from metrolake.plans.store import Store

from .conftest import write_csv

AS_OF = "2024-03-10 00:00:00"


@pytest.fixture()
def loaded(spark, fixture_dir, store_dir):
    summary = ingest_folder(spark, fixture_dir, store_dir, as_of=AS_OF)
    return summary, Store(spark, store_dir)


def test_ingest_loads_three_formats(loaded):
    summary, store = loaded
    got = {r["file"]: (r["status"], r["rows"], r["run_id"]) for r in summary.collect()}
    assert got == {"sample_calibration.csv": ("success", 10, 1), "sample_calibration.json": ("success", 6, 2),
                   "sample_calibration.log": ("success", 6, 3)}
    assert store.measurement_frame().count() == 22
    runs = {r["run_id"]: (r["equipment_id"], r["operator"]) for r in store.committed_runs().collect()}
    assert runs == {1: ("TOOL_X1", "OP001"), 2: ("TOOL_X1", "OP002"), 3: ("TOOL_X2", "OP003")}


def test_reimport_is_skipped_and_force_reloads(spark, loaded, fixture_dir, store_dir):
    again = ingest_folder(spark, fixture_dir, store_dir, as_of=AS_OF)
    assert {r["status"] for r in again.collect()} == {"skipped_duplicate"}
    assert Store(spark, store_dir).measurement_frame().count() == 22
    forced = ingest_folder(spark, fixture_dir, store_dir, as_of=AS_OF, force=True)
    assert {r["status"] for r in forced.collect()} == {"success"}
    assert Store(spark, store_dir).measurement_frame().count() == 44


def test_failed_validation_blocks_unless_forced(spark, store_dir):
    d = tempfile.mkdtemp()
    write_csv(os.path.join(d, "short.csv"), devs=[1, 2, 3])
    s = ingest_folder(spark, d, store_dir, as_of=AS_OF).first()
    assert (s["status"], s["message"]) == ("failed", "1 validation failure(s) prevented load.")
    ledger = Store(spark, store_dir).ledger().first()
    assert (ledger["status"], ledger["rows_imported"]) == ("failed", 0)
    s2 = ingest_folder(spark, d, store_dir, as_of=AS_OF, force=True).first()
    assert s2["status"] == "success" and s2["rows"] == 3


def test_null_measurement_rejects_even_when_forced(spark, store_dir):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "n.csv"), "w") as f:
        f.write("position,actual_value,expected_value\n" + "".join(f"P{i},1.{i},1.0\n" for i in range(6)) + "P9,,1.0\n")
    s = ingest_folder(spark, d, store_dir, as_of=AS_OF, force=True).first()
    assert s["status"] == "failed" and s["message"].startswith("NOT NULL")
    s2 = ingest_folder(spark, d, store_dir, as_of=AS_OF, missing_strategy="drop").first()
    assert s2["status"] == "success" and s2["rows"] == 6


def test_dry_run_writes_nothing(spark, fixture_dir, store_dir):
    s = ingest_folder(spark, fixture_dir, store_dir, as_of=AS_OF, dry_run=True)
    assert {r["status"] for r in s.collect()} == {"dry_run"}
    assert not os.path.exists(os.path.join(store_dir, "file_imports"))
    assert outcome_counts(s).first()["files"] == 3


def test_golden_equipment_operator_positions(loaded):
    m = loaded[1].measurement_frame()
    eq = {r["equipment_id"]: r for r in A.equipment_comparison(m).collect()}
    assert eq["TOOL_X1"]["n_measurements"] == 16
    assert eq["TOOL_X1"]["mean_dev"] == pytest.approx(0.0351875)
    assert eq["TOOL_X1"]["std_dev"] == pytest.approx(0.137302, abs=1e-6)
    assert eq["TOOL_X2"]["std_dev"] == pytest.approx(0.002608, abs=1e-6)
    ops = [r["operator"] for r in A.operator_performance(m).collect()]
    assert ops == ["OP001", "OP003", "OP002"]
    worst = A.worst_positions(m, 10).collect()
    assert worst[0]["position"] == "POS_D1" and worst[0]["mean_abs_dev"] == pytest.approx(0.55)
    assert len(A.worst_positions(m, 3).collect()) == 3


def test_golden_stability_and_variation(loaded):
    m = loaded[1].measurement_frame()
    st = {r["equipment_id"]: r for r in A.stability(m, AS_OF).collect()}
    x1 = st["TOOL_X1"]
    assert x1["std"] == pytest.approx(0.1329423, abs=1e-7)
    assert x1["ucl"] == pytest.approx(0.4340144, abs=1e-7) and x1["lcl"] == pytest.approx(-0.3636394, abs=1e-7)
    assert (x1["out_of_control"], x1["trend"], x1["alert"]) == (1, "degrading", True)
    assert x1["trend_delta"] == pytest.approx(0.069125)
    x2 = st["TOOL_X2"]
    assert (x2["out_of_control"], x2["trend"], x2["alert"]) == (0, "stable", False)
    v = A.run_variation(m, AS_OF, positions=["pos_a1", "POS_Z9"]).collect()
    v = {r["position"]: r for r in v}
    assert v["POS_A1"]["n_runs"] == 3 and v["POS_A1"]["cv"] == pytest.approx(28.284271)
    assert v["POS_Z9"]["n_runs"] == 0
    missing = A.stability(m, AS_OF, equipment=["TOOL_NONE"]).first()
    assert missing["alert"] is False


def test_golden_slopes_and_trends(loaded):
    m = loaded[1].measurement_frame()
    s = {r["run_id"]: r for r in A.drift_slope(m).collect()}
    assert s[1]["drift_slope"] == pytest.approx(0.02998182, abs=1e-8)
    assert s[2]["drift_direction"] == "negative" and s[3]["drift_direction"] == "positive"
    w = A.time_trends(m, "W").collect()
    assert len(w) == 1 and w[0]["timestamp"] == dt.datetime(2024, 3, 3) and w[0]["n_measurements"] == 22
    d = A.time_trends(m, "D").collect()
    assert [r["n_measurements"] for r in d] == [10, 6, 6]
    rr = A.recent_run_drift(m, loaded[1].committed_runs(), 2).select("run_id").distinct().collect()
    assert sorted(r["run_id"] for r in rr) == [2, 3]


def test_empty_store_gives_empty_results(spark, store_dir):
    m = Store(spark, store_dir).measurement_frame()
    assert A.equipment_comparison(m).count() == 0
    assert A.time_trends(m).count() == 0


def test_ordered_index_sorted_equals_window(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["hot"] * 8 + ["a", "b", None]), rnd.randint(0, 50), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, t int, id long")
    a = ordered_index(df, ["g"], ["t", "id"], "ix", buckets=1)
    b = ordered_index(df, ["g"], ["t", "id"], "ix", buckets=9)
    key = lambda r: r["id"]
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key)
    assert b.filter(F.col("g") == "hot").agg(F.max("ix")).first()[0] == b.filter(F.col("g") == "hot").count() - 1


def test_ordered_index_with_payload_and_a_hot_group(spark):
    """Positions carry all columns, no row is lost, and buckets never change them."""
    df = (spark.range(0, 120_000, numPartitions=8).selectExpr(
        "case when id % 10 < 8 then 'hot' else concat('g', id % 7) end as g",
        "cast((id * 7919) % 5003 as int) as t", "id", "sqrt(id) as payload", "cast(id as string) as note")
        .withColumn("t", F.when(F.col("id") % 1001 == 0, None).otherwise(F.col("t"))))
    a = ordered_index(df, ["g"], ["t", "id"], "ix", buckets=1)
    b = ordered_index(df, ["g"], ["t", "id"], "ix", buckets=16)
    assert b.count() == 120_000
    assert a.exceptAll(b).count() == 0
    assert b.select("g", "ix").distinct().count() == 120_000
    m = df.select(F.when(F.col("g") == "hot", 1).otherwise(2).cast("long").alias("run_id"),
                  F.col("id").alias("measurement_id"), F.timestamp_seconds("t").cast("timestamp_ntz").alias("timestamp"),
                  F.col("payload").alias("deviation"), F.lit("E").alias("equipment_id"))
    one = {r["run_id"]: r["drift_slope"] for r in A.drift_slope(m, buckets=1).collect()}
    many = {r["run_id"]: r["drift_slope"] for r in A.drift_slope(m, buckets=12).collect()}
    assert one.keys() == many.keys() and all(one[k] == pytest.approx(many[k], rel=1e-9) for k in one)


def test_slope_sorted_strategy_matches(spark):
    rows = [(i % 3, i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), float(i % 7) * 0.01 * (i % 3))
            for i in range(300)]
    m = spark.createDataFrame(rows, "run_id long, measurement_id long, timestamp timestamp_ntz, deviation double")
    w = {r["run_id"]: r["drift_slope"] for r in A.drift_slope(m, buckets=1).collect()}
    s = {r["run_id"]: r["drift_slope"] for r in A.drift_slope(m, buckets=5).collect()}
    assert w.keys() == s.keys() and all(w[k] == pytest.approx(s[k]) for k in w)


def test_group_quantiles_strategies_match_numpy(spark):
    import numpy as np
    from metrolake.operators.quantiles import group_quantiles
    rnd = random.Random(1)
    rows = [(rnd.choice(["hot"] * 6 + ["a", "b"]), float(rnd.randint(-50, 50)) / 7 if rnd.random() > 0.02 else None, i)
            for i in range(3000)] + [("one", 3.5, 10 ** 6), ("two", 1.0, 10 ** 6 + 1), ("two", 2.0, 10 ** 6 + 2)]
    df = spark.createDataFrame(rows, "g string, v double, id long")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    names = ["p0", "p25", "p50", "p75", "p100"]
    for strategy in ["map", "ranked"]:
        got = {r["g"]: [r[n] for n in names]
               for r in group_quantiles(df, ["g"], "v", probs, names, strategy=strategy, tie_break=["id"]).collect()}
        for g, q in got.items():
            vals = np.array([v for gg, v, _ in rows if gg == g and v is not None])
            assert q == pytest.approx(list(np.quantile(vals, probs)), abs=1e-12), (strategy, g)


def test_profile_ranked_quartiles_equal_map(spark):
    from metrolake.operators import validation as V
    rows = [(f"f{i % 3}", 0, i, dt.datetime(2024, 1, 1), "P", 1.0, 1.0, float((i * 37) % 11) / 3)
            for i in range(600)]
    df = spark.createDataFrame(rows, "source_file string, row_block long, row_idx long, timestamp timestamp_ntz, "
                                     "position string, actual_value double, expected_value double, deviation double")
    files = V.files_of(df)
    a = {r["source_file"]: (r["q1"], r["q3"]) for r in V.file_profile(df, files, quantiles="map").collect()}
    b = {r["source_file"]: (r["q1"], r["q3"]) for r in V.file_profile(df, files, quantiles="ranked").collect()}
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k]) for k in a)


def test_report_bundles(loaded):
    m = loaded[1].measurement_frame()
    rep = A.summary_report(m)
    assert set(rep) == {"worst_positions", "equipment_summary", "operator_summary", "daily_trend"}
    assert rep["daily_trend"].count() == 3
    full = A.trend_report(m, loaded[1].committed_runs(), AS_OF, equipment="TOOL_X1", position="POS_A1",
                          row_cap=2)
    assert full["worst_positions"].count() == 2                       # display cap
    assert full["stability"].first()["out_of_control"] == 1
    assert full["run_variation"].first()["n_runs"] == 3
    assert full["alerts"].count() == 0
    assert full["recent_run_drift"].select("run_id").distinct().count() == 3


def test_single_file_listing_and_ingest(spark, fixture_dir, store_dir):
    from metrolake.sources.files import list_files
    one = os.path.join(fixture_dir, "sample_calibration.log")
    assert [r["file_name"] for r in list_files(spark, one).collect()] == ["sample_calibration.log"]
    s = ingest_folder(spark, one, store_dir, as_of=AS_OF).first()
    assert (s["status"], s["rows"]) == ("success", 6)


def test_ordered_index_without_groups(spark):
    df = spark.range(0, 3000).selectExpr("id", "cast(id % 97 as long) as t")
    a = {r["id"]: r["ix"] for r in ordered_index(df, [], ["t", "id"], "ix", buckets=1).collect()}
    b = {r["id"]: r["ix"] for r in ordered_index(df, [], ["t", "id"], "ix", buckets=9).collect()}
    assert a == b and sorted(b.values()) == list(range(3000))


def test_workbook_ingest_end_to_end(spark, store_dir):
    from .conftest import write_xlsx
    d = tempfile.mkdtemp()
    header = ["Position", "Actual", "Nominal", "Operator", "Tool", "Time"]
    rows = [[f"POS_{i}", 10 + (i % 3) / 1000, 10.0, "OP004", "TOOL_X3", 45352.5 + i / 1440] for i in range(8)]
    write_xlsx(os.path.join(d, "cal.xlsx"), header, rows, date_cols={5})
    s = ingest_folder(spark, d, store_dir, as_of=AS_OF).first()
    assert (s["status"], s["rows"]) == ("success", 8)
    m = Store(spark, store_dir).measurement_frame()
    eq = A.equipment_snapshot(m).first()
    assert (eq["equipment_id"], eq["n"]) == ("TOOL_X3", 8)
    assert m.agg(F.min("timestamp")).first()[0] == dt.datetime(2024, 3, 1, 12, 0)


def test_lookback_prunes_date_partitions(loaded):
    m = loaded[1].measurement_frame()
    plan = A.control_limits(m, AS_OF, A.AnalysisConfig().with_(lookback_days=8))._jdf.queryExecution() \
        .executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ts_date" in plan and "ts_date" in plan.split("PartitionFilters")[1]
    scan = [ln for ln in plan.split("\n") if "FileScan parquet" in ln and "measurements" in ln][0]
    assert "ReadSchema: struct<run_id:bigint,deviation:double,timestamp:timestamp_ntz>" in scan
    # Cutoff 2024-03-02 00:00: the 03-01 run (10 rows of TOOL_X1) falls out, 03-02 and 03-03 stay.
    assert {r["equipment_id"]: r["n"] for r in A.control_limits(
        m, AS_OF, A.AnalysisConfig().with_(lookback_days=8)).collect()} == {"TOOL_X1": 6, "TOOL_X2": 6}
