"""Rounding that only serves the comparison with SQL."""

import duckdb
from pyspark.sql import functions as F

from checks.spec import rounded_columns


def test_doubles_are_rounded_as_in_duckdb(spark):
    values = [
        0.0, -0.0, 0.5, 1.5, 2.5, -0.5, -2.5, 0.49999999999999994, -0.49999999999999994, 1.005, 2.675, 1 / 512, 3 / 512, -3 / 512,
        1e15, 123456789012345.67, 4.5e15, 1e17, 1e300, -1e300, 1 / 3, float("inf"), float("-inf"), None,
    ]
    df = spark.createDataFrame([(i, v, v, i) for i, v in enumerate(values)], "id int, a double, b double, n int")
    rows = rounded_columns(df, {"a": 2, "b": 8, "n": 1}).orderBy("id").collect()
    assert df.columns == list(rows[0].asDict())
    for row, v in zip(rows, values):
        want = duckdb.execute("SELECT round(?::DOUBLE, 2), round(?::DOUBLE, 8)", [v, v]).fetchone()
        assert (row.a, row.b) == want and row.n == row.id


def test_rounding_makes_no_decimals(spark):
    df = spark.range(3).select((F.col("id") / 3).alias("a"))
    plan = rounded_columns(df, {"a": 4})._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" not in plan
    nan = rounded_columns(spark.createDataFrame([(float("nan"),)], "a double"), {"a": 4}).first().a
    assert nan != nan
