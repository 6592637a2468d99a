"""Measurement frames derived from the driver's Parquet tables.

``events_measurements`` maps the ``events`` table onto the measurement
frame (one run per equipment and day); ``lineitem_measurements`` maps
``lineitem`` (joined to ``part`` for the nominal value) onto it for bulk,
order-insensitive work. Both are plain projections over a Parquet scan, so
column pruning and filter pushdown reach the files.

``as_file_batch`` turns a measurement frame into the per-file shape the
quality checks take (``source_file``, file row order), grouping by run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import COLUMN_ALIASES

# Fixed mapping of the events table onto measurements.
EVENTS_NOMINAL = 50.0
EVENTS_EQUIPMENT_COUNT = 10
LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice",
              "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan of a driver table, listed anew each time."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events -> measurement frame (``m``).

    measurement_id = event_id; run = one equipment on one day
    (``day(ts) * 10 + user_id % 10``); position = ``POS_<EVENT_TYPE>``;
    actual = value, expected = 50, deviation = value - 50;
    equipment = ``TOOL_<user_id % 10>``; operator = event_type.
    """
    e = read_table(spark, sf_dir, "events")
    eq = F.col("user_id") % EVENTS_EQUIPMENT_COUNT
    return e.select(
        F.col("event_id").alias("measurement_id"),
        (F.dayofmonth("ts").cast("long") * EVENTS_EQUIPMENT_COUNT + eq).alias("run_id"),
        F.concat(F.lit("POS_"), F.upper("event_type")).alias("position"),
        F.col("value").alias("actual_value"),
        F.lit(EVENTS_NOMINAL).alias("expected_value"),
        (F.col("value") - F.lit(EVENTS_NOMINAL)).alias("deviation"),
        F.col("ts").cast("timestamp_ntz").alias("timestamp"),
        F.when(eq % 3 == 0, "X").when(eq % 3 == 1, "Y").otherwise("Z").alias("axis"),
        F.lit("mm").alias("unit"),
        F.concat(F.lit("TOOL_"), eq.cast("string")).alias("equipment_id"),
        F.col("event_type").alias("operator"),
    )


def lineitem_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem ⋈ part -> measurement frame (``ml``); run = order.

    actual = extendedprice, expected = quantity * retailprice,
    position = ``POS_<partkey>``, equipment = ``TOOL_<suppkey>``,
    operator = returnflag, timestamp = shipdate. ``measurement_id`` is
    ``orderkey * 100 + k`` with k the line's place in its order by
    (linenumber, partkey, suppkey, shipdate, price, ...): a total row order
    inside each order. The numbering window spans the lines of one order
    (a handful), never a large group. ``part`` is joined on its key; AQE
    picks a broadcast from its measured size.
    """
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    line_order = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    li = li.withColumn("_k", F.row_number().over(line_order))
    j = li.join(part, li.l_partkey == part.p_partkey, "left")
    expected = F.col("l_quantity") * F.col("p_retailprice")
    return j.select(
        (F.col("l_orderkey") * 100 + F.col("_k")).alias("measurement_id"),
        F.col("l_orderkey").alias("run_id"),
        F.concat(F.lit("POS_"), F.col("l_partkey").cast("string")).alias("position"),
        F.col("l_extendedprice").alias("actual_value"),
        expected.alias("expected_value"),
        (F.col("l_extendedprice") - expected).alias("deviation"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("timestamp"),
        F.col("l_linestatus").alias("axis"),
        F.lit("usd").alias("unit"),
        F.concat(F.lit("TOOL_"), F.col("l_suppkey").cast("string")).alias("equipment_id"),
        F.col("l_returnflag").alias("operator"),
    )


CANONICAL_COLUMNS = list(COLUMN_ALIASES) + ["deviation"]


def as_file_batch(m: DataFrame, file_col: str = "run_id", order_col: str = "measurement_id",
                  prefix: str = "run_") -> DataFrame:
    """Measurement frame -> canonical per-file frame for the quality checks.

    Each group of ``file_col`` plays one file; ``order_col`` is the file's
    row order (``row_idx``), ``row_block`` cuts it into bounded slices.
    """
    return m.select(
        F.concat(F.lit(prefix), F.col(file_col).cast("string")).alias("source_file"),
        F.col(order_col).cast("long").alias("row_idx"),
        F.shiftright(F.col(order_col).cast("long"), 20).alias("row_block"),
        "timestamp", "position", "actual_value", "expected_value", "deviation",
        "operator", "equipment_id", "axis", "unit",
    )
