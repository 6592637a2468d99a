import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from metrolake.config import STRICT_VALIDATION, ValidationConfig
from metrolake.operators import validation as V
from metrolake.operators.ordered import groups_within

COLS = "source_file string, row_block long, row_idx long, timestamp timestamp_ntz, position string, " \
       "actual_value double, expected_value double, deviation double"
T0 = dt.datetime(2024, 1, 1)


def frame(spark, devs=None, file="f", ts=None, positions=None, actual=None):
    """G3-like frame: 10 rows, one per minute, deviation = i * 0.001."""
    devs = devs if devs is not None else [i * 0.001 for i in range(10)]
    n = len(devs)
    ts = ts if ts is not None else [T0 + dt.timedelta(minutes=i) for i in range(n)]
    positions = positions or [f"POS_{i}" for i in range(n)]
    actual = actual if actual is not None else [None if d is None else 10 + d for d in devs]
    rows = [(file, 0, i, ts[i], positions[i], actual[i], 10.0, devs[i]) for i in range(n)]
    df = spark.createDataFrame(rows, COLS)
    return df, V.files_of(df)


def status(res, check):
    return {r["check_type"]: r for r in res.collect()}[check]


def test_clean_file_has_no_fail(spark):
    rows, files = frame(spark)
    res = V.run_checks(rows, files)
    st = [r["status"] for r in res.orderBy("check_order").collect()]
    assert len(st) == 7 and "fail" not in st


def test_required_columns_fail_lists_missing_sorted(spark):
    rows, _ = frame(spark)
    files = V.files_of(rows, present=["timestamp", "position"])
    r = status(V.check_required_columns(rows, files), "required_columns")
    assert r["status"] == "fail"
    assert r["details"] == "Missing columns: ['actual_value', 'deviation', 'expected_value']"


def test_row_count_fail_and_empty_file(spark):
    rows, files = frame(spark, devs=[0.0, 0.001])
    assert status(V.check_row_count(rows, files), "row_count")["status"] == "fail"
    empty_files = files.union(files.withColumn("source_file", F.lit("empty")))
    res = {r["source_file"]: r for r in V.check_row_count(rows, empty_files).collect()}
    assert res["empty"]["n_flagged"] == 0 and res["empty"]["status"] == "fail"


def test_missing_measurement_warns(spark):
    devs = [i * 0.001 for i in range(10)]
    devs[3] = None
    rows, files = frame(spark, devs=devs)
    r = status(V.check_missing(rows, files), "missing_measurements")
    assert r["status"] == "warn" and r["n_flagged"] == 2
    assert r["details"] == "2 missing value(s): actual_value: 1 null(s); deviation: 1 null(s)"


def test_large_gap_warns_with_true_timestamp(spark):
    ts = [T0 + dt.timedelta(minutes=i) for i in range(10)]
    ts[5:] = [t + dt.timedelta(hours=36) for t in ts[5:]]
    rows, files = frame(spark, ts=ts)
    r = status(V.check_timestamps(rows, files), "timestamp_consistency")
    assert r["status"] == "warn" and r["n_flagged"] == 1
    assert "1 gap(s) > 24.0h" in r["details"]
    assert "1 days 12:01:00 gap before 2024-01-02 12:05:00" in r["details"]


def test_out_of_order_warns(spark):
    ts = [T0 + dt.timedelta(minutes=i) for i in range(10)]
    ts[2], ts[3] = ts[3], ts[2]
    rows, files = frame(spark, ts=ts)
    r = status(V.check_timestamps(rows, files), "timestamp_consistency")
    assert r["status"] == "warn" and "not in chronological order" in r["details"]


def test_all_null_timestamps_warn(spark):
    rows, files = frame(spark, ts=[None] * 10)
    r = status(V.check_timestamps(rows, files), "timestamp_consistency")
    assert r["details"] == "All timestamps are null."


def test_in_file_duplicates_count_all_members(spark):
    ts = [T0] * 3 + [T0 + dt.timedelta(minutes=i) for i in range(3, 10)]
    rows, files = frame(spark, devs=[0.0] * 10, ts=ts, positions=["P"] * 3 + [f"Q{i}" for i in range(7)])
    r = status(V.check_duplicates(rows, files), "duplicate_detection")
    assert r["status"] == "warn" and r["n_flagged"] == 3


def test_outlier_and_range_checks(spark):
    devs = [i * 0.001 for i in range(10)]
    devs[9] = 999.0
    rows, files = frame(spark, devs=devs)
    assert status(V.check_outliers(rows, files), "outlier_detection")["status"] == "warn"
    r = status(V.check_deviation_range(rows, files), "deviation_range")
    assert r["status"] == "warn" and r["details"] == "1 measurement(s) exceed ±0.5: positions=['POS_9']"


def test_outlier_rate_fail_and_degenerate_cases(spark):
    rows, files = frame(spark, devs=[0.0] * 9 + [10.0] * 3)   # q3 = 2.5: 3 of 12 (25%) flagged
    assert status(V.check_outliers(rows, files), "outlier_detection")["status"] == "fail"
    rows, files = frame(spark, devs=[0.1] * 10)
    r = status(V.check_outliers(rows, files), "outlier_detection")
    assert r["status"] == "pass" and "identical" in r["details"]
    rows, files = frame(spark, devs=[0.1, 0.2, 0.3])
    assert status(V.check_outliers(rows, files), "outlier_detection")["details"].startswith("Too few")


def test_range_lists_first_ten_in_row_order(spark):
    rows, files = frame(spark, devs=[1.0] * 12, positions=[f"P{i:02d}" for i in range(12)],
                        ts=[T0 + dt.timedelta(minutes=i) for i in range(12)])
    r = status(V.check_deviation_range(rows, files), "deviation_range")
    assert r["details"].endswith("'P09']...") and "'P00'" in r["details"] and r["n_flagged"] == 12


def test_strict_profile_flags_more(spark):
    devs = [i * 0.001 for i in range(10)]
    devs[9] = 0.2
    rows, files = frame(spark, devs=devs)
    strict = {r["check_type"]: r["status"] for r in V.run_checks(rows, files, STRICT_VALIDATION).collect()}
    assert strict["deviation_range"] == "warn"
    default = {r["check_type"]: r["status"] for r in V.run_checks(rows, files).collect()}
    assert default["deviation_range"] == "pass"


def test_custom_check_selection_and_rollup_gate(spark):
    rows, files = frame(spark, devs=[0.0, 0.001])
    res = V.run_checks(rows, files, ValidationConfig(min_rows=3), checks=["required_columns", "row_count"])
    assert res.count() == 2
    roll = V.rollup(res).first()
    assert (roll["n_pass"], roll["n_warn"], roll["n_fail"]) == (1, 0, 1)
    assert V.load_gate(res).first()["accepted"] is False
    assert V.load_gate(res, force=True).first()["accepted"] is True
    with pytest.raises(ValueError):
        V.run_checks(rows, files, checks=["nope"])


def _brute_gaps(ts, hours):
    s = sorted(t for t in ts if t is not None)
    return sum(1 for a, b in zip(s, s[1:]) if (b - a).total_seconds() > hours * 3600)


def test_bucketed_gaps_equal_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    truth = {}
    for f in range(20):
        ts = []
        t = T0
        for i in range(rnd.randint(1, 60)):
            t = t + dt.timedelta(minutes=rnd.choice([1, 30, 600, 1439, 1440, 1441, 2000, 5000]))
            ts.append(t if rnd.random() > 0.05 else None)
        rnd.shuffle(ts)
        truth[f"f{f}"] = _brute_gaps(ts, 24)
        rows += [(f"f{f}", 0, i, x, "P", 1.0, 1.0, 0.0) for i, x in enumerate(ts)]
    df = spark.createDataFrame(rows, COLS)
    got = {r["source_file"]: r["count"] for r in V.timestamp_gaps(df, 24).groupBy("source_file").count().collect()}
    assert {k: got.get(k, 0) for k in truth} == truth


def test_order_check_across_blocks_equals_brute_force(spark):
    rnd = random.Random(3)
    rows, truth = [], {}
    for f in range(15):
        n = rnd.randint(2, 40)
        ts = [T0 + dt.timedelta(minutes=i) for i in range(n)]
        if rnd.random() < 0.5:
            i = rnd.randrange(n - 1)
            ts[i], ts[i + 1] = ts[i + 1], ts[i]
        seq = [t for t in ts if t is not None]
        truth[f"f{f}"] = sum(1 for a, b in zip(seq, seq[1:]) if a > b)
        rows += [(f"f{f}", i // 7, i, t, "P", 1.0, 1.0, 0.0) for i, t in enumerate(ts)]  # blocks of 7 rows
    df = spark.createDataFrame(rows, COLS)
    got = {r["source_file"]: r["n_order_violations"] for r in V.order_violations(df).collect()}
    assert got == truth


def test_store_overlap_equals_brute_force(spark):
    rnd = random.Random(11)
    stored = [T0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 5)) for _ in range(500)]
    st = spark.createDataFrame([(t,) for t in stored], "timestamp timestamp_ntz")
    rows, truth = [], {}
    for f in range(25):
        a = T0 + dt.timedelta(minutes=rnd.randint(-300, 60 * 24 * 5))
        b = a + dt.timedelta(minutes=rnd.choice([0, 5, 59, 61, 300, 3000]))
        lo, hi = a - dt.timedelta(hours=1), b + dt.timedelta(hours=1)
        truth[f"f{f}"] = sum(1 for t in stored if lo <= t <= hi)
        rows += [(f"f{f}", 0, 0, a, "P", 1.0, 1.0, 0.0), (f"f{f}", 0, 1, b, "P", 1.0, 1.0, 0.0)]
    df = spark.createDataFrame(rows, COLS)
    got = {r["source_file"]: r["n_stored_in_range"] for r in V.store_overlap(df, st, 1.0).collect()}
    assert got == truth


def test_stored_rows_hold_only_what_the_checks_read(spark, monkeypatch):
    rows = spark.createDataFrame([("f", 0, k, f"p{k}", float(k), 1.0, k - 1.0, {"note": "x"}) for k in range(9)],
                                 "source_file string, row_block long, row_idx long, position string, actual_value double,"
                                 "expected_value double, deviation double, extras map<string,string>").withColumn(
        "timestamp", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    kept, store = [], type(rows).checkpoint
    monkeypatch.setattr(type(rows), "checkpoint", lambda self, *a, **k: (kept.append(self.columns), store(self, *a, **k))[1])
    out = V.run_checks(rows, V.files_of(rows), materialize=True)
    assert "extras" not in kept[0] and set(kept[0]) == set(V.CHECKED_COLUMNS)
    want = V.run_checks(rows, V.files_of(rows))
    assert sorted(map(str, out.collect())) == sorted(map(str, want.collect()))


def _odd_files(spark):
    """Files with nulls, equal rows, gaps, disorder, breaches and outliers; one without a name, one without rows."""
    rnd = random.Random(5)
    rows = []
    for f in [f"f{k}" for k in range(40)] + [None]:
        for i in range(rnd.choice([1, 2, 3, 5, 8, 30])):
            t = T0 + dt.timedelta(hours=rnd.choice([0, 1, 2, 30, 70, 200, 300]))
            dev = rnd.choice([None, 0.0, 0.1, -0.1, 0.2, 0.7, -9.0, float("nan")] if rnd.random() < 0.2 else [0.0, 0.1, 0.6])
            rows.append((f, i // 4, i, t if rnd.random() > 0.2 else None, rnd.choice(["P1", "P2", None]),
                         rnd.choice([1.0, 2.0, 0.0, -0.0, None]), rnd.choice([1.0, None]), dev))
    df = spark.createDataFrame(rows, COLS)
    files = V.files_of(df).unionByName(V.files_of(df.limit(1), present=["position"]).withColumn("source_file", F.lit("empty")))
    return df, files.withColumn("present_cols", F.when(F.col("source_file") == "f3", F.array(F.lit("deviation"))).otherwise(
        F.col("present_cols")))


@pytest.mark.parametrize("store", [False, True])
def test_one_shuffle_equals_the_passes(spark, store):
    rows, files = _odd_files(spark)
    stored = spark.createDataFrame([(T0 + dt.timedelta(minutes=7 * i),) for i in range(900)], "timestamp timestamp_ntz")
    kw = {"stored": stored if store else None}
    told = [tuple(r) for r in V.run_checks(rows, files, **kw).collect()]
    spark.conf.set(V.MAX_FILE_ROWS_CONF, "0")
    try:
        want = V.run_checks(rows, files, **kw)
        assert V.run_checks(rows, files).schema.simpleString() == want.schema.simpleString()
        want = [tuple(r) for r in want.collect()]
    finally:
        spark.conf.unset(V.MAX_FILE_ROWS_CONF)
    assert len(told) == 42 * 7 and sorted(map(str, told)) == sorted(map(str, want))
    by_check = V.run_checks(rows, files, checks=["deviation_range", "row_count"], **kw).collect()
    assert sorted(map(str, map(tuple, by_check))) == sorted(
        str(r) for r in told if r[2] in ("deviation_range", "row_count"))


def _scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("parquet")


def test_small_files_are_read_once_for_all_checks(spark, tmp_path):
    rows, _ = frame(spark)
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    out = V.run_checks(rows, V.files_of(rows))
    assert _scans(out) == 2  # the checks and the list of files
    assert _scans(V.rollup(out)) == 2
    plan = V.rollup(out)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan  # listed gaps and positions are made for the details only


def test_group_sizes_are_bounded_by_hash_buckets(spark):
    df = spark.range(100).select((F.col("id") % 10).alias("g"))
    assert not groups_within(df, ["g"], 9) and groups_within(df, ["g"], 100)
    assert groups_within(df.filter("g < 0"), ["g"], 0)
