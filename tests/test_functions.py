import datetime as dt
import math

from pyspark.sql import functions as F

from metrolake.functions.buckets import bucket
from metrolake.functions.columns import clean_header, normalize_position, to_number, to_timestamp_any
from metrolake.functions.maps import map_last_wins


def _one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("o")).first()["o"]


def test_numeric_coercion_edges(spark):
    good = {" 10.5 ": 10.5, "1e3": 1000.0, "+5": 5.0, "-.5": -0.5, "3.": 3.0}
    for text, want in good.items():
        assert _one(spark, to_number, text) == want, text
    assert math.isinf(_one(spark, to_number, "inf"))
    for text in ["", "1,000", "1_000", "0x1A", "True", "1.0d", "5f", "abc", "nan"]:
        assert _one(spark, to_number, text) is None, text


def test_timestamp_parse_forms(spark):
    cases = {
        "2024-03-01 08:00:00": dt.datetime(2024, 3, 1, 8, 0),
        "2024-03-01T08:00:00": dt.datetime(2024, 3, 1, 8, 0),
        "2024-03-01": dt.datetime(2024, 3, 1),
        "03/04/2024 10:00:00": dt.datetime(2024, 3, 4, 10, 0),   # month first
        "25/12/2024 10:00:00": dt.datetime(2024, 12, 25, 10, 0),  # day-first fallback
        "01-Mar-2024 08:00:00": dt.datetime(2024, 3, 1, 8, 0),
        "20240301": dt.datetime(2024, 3, 1),
    }
    for text, want in cases.items():
        assert _one(spark, to_timestamp_any, text) == want, text
    assert _one(spark, to_timestamp_any, "not a date") is None


def test_header_clean():
    assert clean_header("  Actual Value ") == "actual_value"
    assert clean_header("Meta.Operator", json_style=True) == "meta_operator"
    assert clean_header("a\t b") == "a_b"


def test_position_normalize(spark):
    assert _one(spark, normalize_position, " pos_a1 ") == "POS_A1"
    assert _one(spark, normalize_position, None) == "NAN"


def test_bucket_labels(spark):
    rows = [(dt.datetime(2024, 3, 3, 23, 59, 59),), (dt.datetime(2024, 3, 4, 0, 0),),
            (dt.datetime(2024, 2, 29, 12, 0),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    got = df.select(*[bucket("ts", f).alias(f) for f in ["D", "W", "ME", "QE", "MS", "YE", "h"]]).collect()
    assert got[0]["D"] == dt.datetime(2024, 3, 3) and got[0]["W"] == dt.datetime(2024, 3, 3)
    assert got[0]["ME"] == dt.datetime(2024, 3, 31)
    assert got[1]["D"] == dt.datetime(2024, 3, 4) and got[1]["W"] == dt.datetime(2024, 3, 10)
    assert got[2]["W"] == dt.datetime(2024, 3, 3) and got[2]["ME"] == dt.datetime(2024, 2, 29)
    assert got[2]["QE"] == dt.datetime(2024, 3, 31) and got[2]["MS"] == dt.datetime(2024, 2, 1)
    assert got[2]["YE"] == dt.datetime(2024, 12, 31) and got[2]["h"] == dt.datetime(2024, 2, 29, 12)


def test_map_last_wins(spark):
    df = spark.createDataFrame([(["a", "b", "a"], ["1", "2", "3"])], "k array<string>, v array<string>")
    m = df.select(map_last_wins(F.col("k"), F.col("v")).alias("m")).first()["m"]
    assert m == {"a": "3", "b": "2"}
