"""Interrupted loads, equal files in one batch, odd file names, malformed files."""

import datetime as dt
import os
import shutil

import pytest
from pyspark.sql import functions as F

from metrolake.functions.columns import to_number, to_timestamp_any
from metrolake.plans import store as store_module
from metrolake.plans.ingest import ingest_folder
from metrolake.plans.store import Store
from metrolake.sources import parsers as P

from .conftest import write_csv

AS_OF = "2024-03-10 00:00:00"


def lines(spark, rows):
    return spark.createDataFrame([(p, 0, i, x) for i, (p, x) in enumerate(rows)],
                                 "path string, row_block long, row_idx long, line string")


@pytest.mark.parametrize("broken", ["measurements", "runs", "validation_results", "file_imports"])
def test_load_broken_after_any_write_is_redone_exactly(spark, tmp_path, monkeypatch, broken):
    src, root = tmp_path / "in", str(tmp_path / "store")
    src.mkdir()
    write_csv(src / "a.csv", devs=[1, 2, 3, 4, 5, 6])
    real = store_module.Store.append

    def append(self, name, df):
        if broken == "file_imports" and name == "file_imports":
            raise RuntimeError("lost")
        real(self, name, df)
        if name == broken:
            raise RuntimeError("lost")
    monkeypatch.setattr(store_module.Store, "append", append)
    with pytest.raises(RuntimeError):
        ingest_folder(spark, str(src), root, as_of=AS_OF)
    assert Store(spark, root).measurements().count() == 0
    monkeypatch.setattr(store_module.Store, "append", real)
    assert ingest_folder(spark, str(src), root, as_of=AS_OF).first()["status"] == "success"
    s = Store(spark, root)
    m = s.measurements()
    assert m.count() == 6 and m.select("measurement_id").distinct().count() == 6
    v = s.validation_results()
    assert v.count() == v.select("validation_id").distinct().count() > 0
    assert s.committed_runs().count() == 1


def test_equal_files_and_odd_names_in_one_batch(spark, tmp_path):
    src, root = tmp_path / "in", str(tmp_path / "store")
    src.mkdir()
    for k, name in enumerate(["my run 1.csv", "run[1].csv", "100%+é.csv", "q{a,b}.csv"]):
        write_csv(src / name, devs=[1, 2, 3, 4, 5, 6 + k], day=f"2024-03-0{k + 1}")
        os.utime(src / name, (1_700_000_000 + k, 1_700_000_000 + k))
    shutil.copy(src / "my run 1.csv", src / "copy.csv")
    os.utime(src / "copy.csv", (1_700_000_900, 1_700_000_900))
    got = {r["file"]: (r["status"], r["rows"]) for r in ingest_folder(spark, str(src), root, as_of=AS_OF).collect()}
    assert got == {"my run 1.csv": ("success", 6), "run[1].csv": ("success", 6), "100%+é.csv": ("success", 6),
                   "q{a,b}.csv": ("success", 6), "copy.csv": ("skipped_duplicate", 0)}
    assert Store(spark, root).measurements().count() == 24


def test_store_writes_few_files_a_date(spark, tmp_path):
    m = spark.range(0, 6000, numPartitions=8).selectExpr(
        "id AS measurement_id", "1L AS run_id", "'P' AS position", "1.0 AS actual_value", "1.0 AS expected_value",
        "0.0 AS deviation", "timestamp_ntz'2024-03-01 00:00:00' + make_dt_interval(cast(id % 5 as int)) AS timestamp",
        "'X' AS axis", "'mm' AS unit").withColumn("ts_date", F.to_date("timestamp"))
    Store(spark, str(tmp_path)).append("measurements", m)
    files = [f for d, _, names in os.walk(tmp_path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 10 and Store(spark, str(tmp_path)).table("measurements").count() == 6000


def test_csv_quoted_line_breaks_and_wide_rows(spark):
    b = P.parse_csv(lines(spark, [("a", "x,y"), ("a", '1,"two'), ("a", 'lines"'), ("a", "3,4"), ("b", "x,y,z"),
                                  ("b", "1,2"), ("c", "x"), ("c", "1,2"), ("d", "\t "), ("d", "q"), ("d", '"a""b"')]))
    rows = {(r.path, tuple(sorted(r.fields.items(), key=str))) for r in b.rows.collect()}
    assert rows == {("a", (("x", "1"), ("y", "two\nlines"))), ("a", (("x", "3"), ("y", "4"))),
                    ("b", (("x", "1"), ("y", "2"), ("z", None))), ("d", (("q", 'a"b'),))}
    assert [r.path for r in b.errors.collect()] == ["c"] and {r.path for r in b.files.collect()} == {"a", "b", "d"}


def test_json_depth_braces_and_non_objects(spark):
    docs = [("a", '\n {"records":[{"p":"{A1}","d":{"e":{"f":{"g":{"h":{"i":1}}}}},"l":[{"z":1}]},{"p":"}{"}]}'),
            ("b", '[{"a":1},5]'), ("c", "{bad"), ("d", '[{"a":1},{"b":{"c":2}}]')]
    b = P.parse_json(spark.createDataFrame(docs, "path string, doc string"))
    got = sorted((r.path, r.row_idx, tuple(sorted(r.fields.items()))) for r in b.rows.collect())
    assert got == [("a", 0, (("d_e_f_g_h_i", "1"), ("l", '[{"z":1}]'), ("p", "{A1}"))), ("a", 1, (("p", "}{"),)),
                   ("d", 0, (("a", "1"),)), ("d", 1, (("b_c", "2"),))]
    assert sorted(r.path for r in b.errors.collect()) == ["b", "c"]


def test_log_lines_and_numbers_are_stripped_of_tabs(spark):
    b = P.parse_log(lines(spark, [("a", "\t# POSITION=X ACTUAL=1"), ("a", "\tPOSITION=Y ACTUAL=2 ")]))
    assert [r.fields["position"] for r in b.rows.collect()] == ["Y"]
    got = spark.createDataFrame([("\t1.5",), (" 2 ",), ("1,0",)], "t string").select(to_number("t").alias("n")).collect()
    assert [r.n for r in got] == [1.5, 2.0, None]


def test_timestamp_layouts(spark):
    at = dt.datetime(2024, 3, 1, 8)
    want = {"2024-03-01 08:00:00": at, "3/1/2024 8:00:00": at, "03/01/2024 08:00": at, "2024/03/01 08:00:00": at,
            "01.03.2024 08:00:00": dt.datetime(2024, 1, 3, 8), "13.03.2024 08:00": dt.datetime(2024, 3, 13, 8),
            "3/1/2024 8:00 PM": dt.datetime(2024, 3, 1, 20), "03/01/2024 08:00:00.25": at.replace(microsecond=250000),
            "\t25/12/2024 ": dt.datetime(2024, 12, 25), "1709280000000000000": at, "20240301": dt.datetime(2024, 3, 1),
            "2024-03-01 10:00:00+02:00": at, "01-Mar-2024 08:00:00": at, "junk": None}
    df = spark.createDataFrame([(k,) for k in want], "t string")
    assert {r.t: r.x for r in df.select("t", to_timestamp_any(F.col("t")).alias("x")).collect()} == want
