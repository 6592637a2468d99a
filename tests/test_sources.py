import hashlib
import json
import os
import tempfile

from pyspark.sql import functions as F

from metrolake.sources import parsers
from metrolake.sources.files import file_hashes, list_files
from metrolake.sources.reader import read_raw

from .conftest import write_csv


def _rows(batch, path_end):
    return (batch.rows.filter(F.col("path").endswith(path_end))
            .orderBy("row_block", "row_idx").collect())


def test_each_format_row_counts(spark, fixture_dir):
    b = read_raw(spark, list_files(spark, fixture_dir))
    assert len(_rows(b, ".csv")) == 10
    assert len(_rows(b, ".json")) == 6
    assert len(_rows(b, ".log")) == 6          # two comment lines skipped
    assert b.errors.count() == 0


def test_csv_headers_lowercased_and_values_text(spark):
    d = tempfile.mkdtemp()
    write_csv(os.path.join(d, "a.csv"), header="Timestamp, Position ,Actual Value,Expected_Value,Operator,"
                                               "Equipment_ID,Axis,Unit")
    b = read_raw(spark, list_files(spark, d))
    cols = b.files.first()["raw_cols"]
    assert cols == ["timestamp", "position", "actual_value", "expected_value", "operator",
                    "equipment_id", "axis", "unit"]
    first = _rows(b, "a.csv")[0]["fields"]
    assert first["actual_value"] == "10.002" and first["position"] == "POS_A1"


def test_csv_files_with_different_layouts_bind_by_name(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "one.csv"), "w") as f:
        f.write("position,actual,expected\nP1,1.5,1.0\n")
    with open(os.path.join(d, "two.csv"), "w") as f:
        f.write("expected,actual,position\n2.0,2.5,P2\n\n")
    b = read_raw(spark, list_files(spark, d))
    one = _rows(b, "one.csv")[0]["fields"]
    two = _rows(b, "two.csv")[0]["fields"]
    assert one == {"position": "P1", "actual": "1.5", "expected": "1.0"}
    assert two == {"position": "P2", "actual": "2.5", "expected": "2.0"}


def test_csv_quotes_null_tokens_and_duplicate_headers(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "q.csv"), "w") as f:
        f.write('position,note,note,value\n"P,1","say ""hi""",N/A,\n')
    b = read_raw(spark, list_files(spark, d))
    row = _rows(b, "q.csv")[0]["fields"]
    assert row["position"] == "P,1"
    assert row["note"] == 'say "hi"'
    assert row["note.1"] is None
    assert row["value"] is None


def test_json_shapes(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "list.json"), "w") as f:
        json.dump([{"a": 1}, {"a": 2, "b": "x"}], f)
    with open(os.path.join(d, "records.json"), "w") as f:
        json.dump({"meta": {"v": 1}, "records": [{"Pos": "p", "Nested": {"Inner Key": 5, "deep": {"x": 1}}}]}, f)
    with open(os.path.join(d, "single.json"), "w") as f:
        json.dump({"position": "p1", "vals": [1, 2]}, f)
    with open(os.path.join(d, "bad.json"), "w") as f:
        f.write("{not json")
    b = read_raw(spark, list_files(spark, d))
    assert [r["fields"] for r in _rows(b, "list.json")] == [{"a": "1"}, {"a": "2", "b": "x"}]
    rec = _rows(b, "records.json")[0]["fields"]
    assert rec == {"pos": "p", "nested_inner_key": "5", "nested_deep_x": "1"}
    single = _rows(b, "single.json")[0]["fields"]
    assert single["position"] == "p1" and single["vals"] == "[1,2]"
    errs = [r["path"] for r in b.errors.collect()]
    assert any(p.endswith("bad.json") for p in errs)


def test_log_timestamp_forms_and_kv_precedence(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "x.txt"), "w") as f:
        f.write("03/04/2024 10:00:00 POS=A1 VALUE=1.5; ref=1.0\n")
        f.write("04-Mar-2024 10:01:00 pos = A2 | value=2\n")
        f.write("2024-03-04T10:02:00 TIMESTAMP=2024-03-05 pos=A3\n")
        f.write("only text here\n")
        f.write("\n# comment\n")
        f.write("KEY=1 key=2\n")
    b = read_raw(spark, list_files(spark, d))
    rows = [r["fields"] for r in _rows(b, "x.txt")]
    assert rows[0] == {"timestamp": "03/04/2024 10:00:00", "pos": "A1", "value": "1.5", "ref": "1.0"}
    assert rows[1] == {"timestamp": "04-Mar-2024 10:01:00", "pos": "A2", "value": "2"}
    assert rows[2]["timestamp"] == "2024-03-05"            # explicit pair beats the found one
    assert len(rows) == 3                                  # 'KEY=1 key=2' collapses to one field


def test_log_without_records_is_an_error(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "empty.log"), "w") as f:
        f.write("# nothing\nplain words\n")
    b = read_raw(spark, list_files(spark, d))
    assert b.rows.count() == 0
    assert b.errors.first()["message"].startswith("No parseable records")


def test_unsupported_suffix_and_dispatch(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "readme.md"), "w") as f:
        f.write("x")
    b = read_raw(spark, list_files(spark, d))
    msg = b.errors.first()["message"]
    assert "Unsupported file extension '.md'" in msg and "'.csv'" in msg


def test_file_hash_matches_hashlib(spark, fixture_dir):
    paths = sorted(os.path.join(fixture_dir, f) for f in os.listdir(fixture_dir))
    got = {r["path"].split("/")[-1]: r["file_hash"] for r in file_hashes(spark, paths).collect()}
    for p in paths:
        with open(p, "rb") as f:
            assert got[os.path.basename(p)] == hashlib.sha256(f.read()).hexdigest()
        assert len(got[os.path.basename(p)]) == 64


def test_listing_is_oldest_first_and_metadata_only(spark, fixture_dir):
    lst = list_files(spark, fixture_dir)
    assert "content" not in lst.columns
    names = [r["file_name"] for r in lst.orderBy("modificationTime").collect()]
    assert names == ["sample_calibration.csv", "sample_calibration.json", "sample_calibration.log"]


def test_row_order_follows_lines_across_splits(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "big.log")
    with open(p, "w") as f:
        for i in range(20000):
            f.write(f"pos=P{i} idx={i}\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        lines = parsers.read_lines(spark, [p])
        assert lines.rdd.getNumPartitions() > 1
        b = parsers.parse_log(lines)
        idx = [int(r["fields"]["idx"]) for r in b.rows.orderBy("row_block", "row_idx").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert idx == list(range(20000))


def test_workbook_first_sheet_with_data(spark):
    from .conftest import write_xlsx
    d = tempfile.mkdtemp()
    header = ["Position", "Actual Value", "expected_value", "Operator", "equipment_id", "Timestamp"]
    rows = [[f"POS_{i}", 10 + i / 1000, 10.0, "OP004", "TOOL_X3", 45352.5 + i / 1440] for i in range(8)]
    write_xlsx(os.path.join(d, "cal.xlsx"), header, rows, sheets_before_empty=1, date_cols={5})
    with open(os.path.join(d, "empty.xlsx"), "wb") as f:
        f.write(b"not a zip")
    b = read_raw(spark, list_files(spark, d))
    got = _rows(b, "cal.xlsx")
    assert len(got) == 8
    assert got[0]["fields"]["actual_value"] == "10.0" and got[1]["fields"]["position"] == "POS_1"
    assert got[0]["fields"]["timestamp"] == "2024-03-01 12:00:00"
    assert b.files.filter(F.col("path").endswith("cal.xlsx")).first()["raw_cols"][1] == "actual_value"
    assert any(r["path"].endswith("empty.xlsx") for r in b.errors.collect())
