"""The summary in one scan against its section functions."""

import random

from pyspark.sql import functions as F

from metrolake.operators import analytics as A


def _measurements(spark):
    rng, rows = random.Random(5), []
    for k in range(600):
        rows.append((k, rng.choice(["P1", "P2", "P3", None]), rng.choice(["E1", "E2", None]), rng.choice(["o", "p", None]),
                     None if rng.random() < 0.1 else rng.choice(["2024-01-01", "2024-01-02", "2024-02-01"]) + " 10:00:00",
                     None if rng.random() < 0.1 else rng.randrange(-50, 50) / 8))
    rows.append((1000, "P9", "E9", "q", "2024-03-03 00:00:00", None))  # a day and keys without a deviation
    return spark.createDataFrame(rows, "measurement_id long, position string, equipment_id string, operator string, "
                                       "t string, deviation double").withColumn("timestamp", F.col("t").cast("timestamp_ntz"))


def test_sections_equal_their_functions(spark):
    m = _measurements(spark)
    got = A.summary_report(m)
    want = {"worst_positions": A.worst_positions(m, 10), "equipment_summary": A.equipment_comparison(m),
            "operator_summary": A.operator_performance(m), "daily_trend": A.time_trends(m, "D")}
    rounded = lambda df: [tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.collect()]
    for name, df in want.items():
        assert got[name].columns == df.columns and rounded(got[name]) == rounded(df)


def test_summary_is_one_scan(spark, tmp_path):
    _measurements(spark).write.parquet(str(tmp_path / "m"))
    m = spark.read.parquet(str(tmp_path / "m"))
    plan = A.summary_groups(m)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Expand") == 1
    for df in A.summary_report(m).values():
        assert "FileScan" not in df._jdf.queryExecution().executedPlan().toString()


def test_quantiles_by_refinement_equal_percentile_to_the_last_bit(spark):
    from metrolake.operators.quantiles import group_quantiles
    rng, rows = random.Random(11), []
    for k in range(4000):
        rows.append(("hot", rng.choice([rng.gauss(0, 1e6), rng.gauss(0, 1e-6), 0.5, -0.0, 0.0])))
    rows += [("wide", rng.choice([1.7e308, -1.7e308, 5e-324, 0.0, rng.random()])) for _ in range(51)]
    rows += [("one", 3.25), ("same", 7.0), ("same", 7.0), ("two", 1.0), ("two", 2.0), (None, 4.0), (None, 9.0),
             ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs, names = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0], list("abcdefg")
    a, b = ({r.g: tuple(r)[1:] for r in group_quantiles(df, ["g"], "v", probs, names, strategy=s).collect()}
            for s in ("map", "ranked"))
    assert a == b and set(a) == {"hot", "wide", "one", "same", "two", None}
