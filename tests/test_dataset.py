import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldmark.operators.quality import assert_no_leakage
from fieldmark.plans import dataset, features

SPINE = "policy_id string, ref_month date, k int"
M = dt.date(2020, 1, 1)


def test_lookup_keeps_rows(spark):
    spine = spark.createDataFrame([("a", M, 1), ("a", M, 1), ("b", M, 2)], SPINE)
    table = spark.createDataFrame([(M, 1, 0.5)], "ref_month date, k int, x double")
    out = dataset.lookup(spine, {"t": table}, {"t": ("ref_month", "k")})
    assert sorted((r.policy_id, r.x) for r in out.collect()) == [("a", 0.5), ("a", 0.5), ("b", None)]
    clash = table.withColumnRenamed("x", "policy_id")
    with pytest.raises(ValueError, match="repeats"):
        dataset.lookup(spine, {"t": clash}, {"t": ("ref_month", "k")})


def test_derived_features(spark):
    rows = [(0.05, 0.0, 3), (0.10, 0.20, 9), (0.1, None, 12)]
    df = spark.createDataFrame(rows, "policy_rate double, rate_mean_365d double, start_month int")
    got = dataset.derived(df).collect()
    assert [r.rate_anomaly for r in got] == [None, 0.5, None]
    assert [r.policy_rate for r in got] == [0.05, 0.10, 0.1]
    months = spark.createDataFrame([(0.1, 0.1, m) for m in range(1, 13)], df.schema)
    for r in dataset.derived(months).collect():
        assert -1 <= r.month_sin <= 1 and -1 <= r.month_cos <= 1
        assert r.month_sin**2 + r.month_cos**2 == pytest.approx(1)


def test_leakage_gate():
    assert_no_leakage(["rate", "state"])
    with pytest.raises(ValueError, match="peril"):
        assert_no_leakage(["rate", "peril"])


def test_split_is_stratified_and_repeatable(spark):
    df = spark.range(5000).select("id", (F.col("id") % 5 == 0).cast("int").alias("y"))
    marked = dataset.stratified_split(df, "y", ["id"])
    share = {r.y: r.s for r in marked.groupBy("y").agg(F.avg(F.col("is_test").cast("int")).alias("s")).collect()}
    assert share == pytest.approx({0: 0.3, 1: 0.3}, abs=0.001)
    again = dataset.stratified_split(df.repartition(7), "y", ["id"])
    assert marked.exceptAll(again).isEmpty()
    other = dataset.stratified_split(df, "y", ["id"], seed=1)
    assert not marked.exceptAll(other).isEmpty()


def test_scoring_spine_cut(spark):
    fields = "policy_id string, start_date date, area_id int, state string, crop string, crop_group string, insurer string, region string"
    rows = [(str(d), d, 1, "s", "c", "g", "i", "r") for d in (dt.date(2019, 12, 31), dt.date(2020, 1, 1), dt.date(2020, 2, 5))]
    df = spark.createDataFrame(rows, fields)
    assert dataset.scoring_spine(df, "2020-01-01").count() == 2
    # The month of a mid-month cut starts before it.
    assert dataset.scoring_spine(df, "2020-01-15").count() == 1
    with pytest.raises(ValueError):
        dataset.scoring_spine(df, "2030-01-01", check_not_empty=True)


def test_monitoring_does_not_double_scores(spark):
    scores = spark.createDataFrame([("a", M, 0.4), ("b", M, 0.1)], "policy_id string, ref_month date, score double")
    labels = spark.createDataFrame([("a", dt.date(2020, 1, 5), 1), ("a", dt.date(2020, 1, 9), 1)], "policy_id string, start_date date, claim int")
    got = sorted((r.policy_id, r.claim) for r in dataset.monitored(scores, labels).collect())
    assert got == [("a", 1), ("b", None)]


def test_feature_keys_hold(spark, sf_dir):
    from checks.tables import policies
    from fieldmark.operators.quality import key_violations

    held = policies(spark, sf_dir)
    for name, table in features.REGISTRY.items():
        assert key_violations(table.build(held), table.key).isEmpty(), name


def test_the_time_cut_reaches_the_scan(spark, tmp_path):
    rows = [("p", dt.date(2020, m, 15), dt.date(2021, m, 15)) for m in range(1, 13)]
    source = spark.createDataFrame(rows, "policy_id string, start_date date, end_date date")
    for column in ("area_id", "state", "crop", "crop_group", "insurer", "region", "peril"):
        source = source.withColumn(column, F.lit("x"))
    source.write.parquet(str(tmp_path / "t"))
    spine = dataset.training_spine(spark.read.parquet(str(tmp_path / "t")), "2030-01-01", "2020-07-01")
    assert spine.count() == 6
    plan = spine._jdf.queryExecution().sparkPlan().toString()
    assert "LessThan(start_date,2020-07-01)" in plan
