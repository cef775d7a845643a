"""Running sums over ranges and what is built on them: null groups, many groups, dominant values, long reports."""

import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fieldmark.ml import preparation
from fieldmark.operators import ranking, stats
from fieldmark.operators.prefix import join_groups, with_running_sums
from fieldmark.operators.quantiles import between, quantile_table


@pytest.mark.parametrize("ranges", [None, 1, 7])
def test_running_sums_by_hand(spark, ranges):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(40), rng.choice([1, 2, None])) for _ in range(500)]
    df = spark.createDataFrame(rows, "g string, k int, v int").withColumn("id", F.monotonically_increasing_id())
    got = with_running_sums(df, [F.col("k").desc()], {"through": "v"}, ["g"], {"total": "v"}, ranges).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.through == sum(v or 0 for g, k, v in rows if g == r.g and k >= r.k)
        assert r.total == sum(v or 0 for g, k, v in rows if g == r.g)


def test_running_sums_of_nothing(spark):
    df = spark.createDataFrame([], "g string, k int, v int")
    assert with_running_sums(df, [F.col("k").asc()], {"through": "v"}, ["g"]).count() == 0


def test_groups_join_null_safely(spark):
    left = spark.createDataFrame([("a", 1), (None, 2)], "g string, x int")
    right = spark.createDataFrame([("a", 3), (None, 4)], "g string, y int")
    assert sorted(map(tuple, join_groups(left, right, ["g"]).collect()), key=repr) == [("a", 1, 3), (None, 2, 4)]


def scores(spark, rows):
    return spark.createDataFrame(rows, "model string, label int, score double")


def test_metrics_keep_a_null_group(spark):
    rng = random.Random(3)
    rows = [(m, rng.randrange(2), rng.randrange(9) / 8) for m in ("a", None) for _ in range(200)]
    # The null group holds the same rows as a named one, so its metrics are the same.
    rows += [("twin", l, s) for m, l, s in rows if m is None]
    df = scores(spark, rows)
    got = {r.model: r[1:] for r in ranking.all_metrics(df, "label", "score", "model").collect()}
    assert set(got) == {"a", None, "twin"} and got[None] == pytest.approx(got["twin"])
    counts = ranking.running_counts(df, "label", "score", ["model"])
    for made in (ranking.roc_points(counts, "score", ["model"]), ranking.precision_recall_points(counts, "score", ["model"])):
        points = made.groupBy("model").count().collect()
        sizes = {r["model"]: r["count"] for r in points}
        assert sizes[None] == sizes["twin"] > 0
    cut = {r.model: r.accuracy for r in ranking.accuracy_and_f1(df, "label", "score", "model").collect()}
    assert cut[None] == cut["twin"] == pytest.approx(got["twin"][0])


def test_reports_keep_a_null_class(spark):
    rows = [(g, float(v)) for g in ("a", None) for v in range(100)]
    df = spark.createDataFrame(rows, "g string, v double")
    for report in (
        stats.mean_and_median(df, ["v"], "g"), stats.box_summary(df, ["v"], "g"), stats.density_histogram(df, "v", "g", 10),
    ):
        by_group = {}
        for r in report.collect():
            by_group.setdefault(r["g"], []).append(tuple(r)[1:])
        assert sorted(by_group[None]) == sorted(by_group["a"])


def test_a_dominant_score_and_many_groups(spark):
    rows = spark.range(30_000).select(
        (F.col("id") % 3000).alias("model"),
        (F.col("id") % 2).cast("int").alias("label"),
        F.when(F.col("id") % 3 > 0, 0.5).otherwise(F.col("id") / 30_000).alias("score"),
    )
    got = ranking.all_metrics(rows, "label", "score", "model")
    assert got.count() == 3000
    whole = ranking.all_metrics(rows.withColumn("model", F.lit("all")), "label", "score", "model").first()
    assert 0.4 < whole.auc_roc < 0.6 and whole.lift_10 is not None


def test_interpolation_stays_between_its_neighbours(spark):
    # 5/12 at a share of 0.9 used to come out above both of its equal neighbours.
    rows = [(0, 0.0)] * 18 + [(0, 5 / 12)] * 4 + [(1, 0.3), (0, 0.3)]
    df = spark.createDataFrame(rows, "label int, score double").withColumn("m", F.lit("x"))
    assert ranking.all_metrics(df, "label", "score", "m").first().lift_10 == 0.0
    table = quantile_table(df, ["score"], {"q": 0.9}, "m").first()
    assert table.q <= 5 / 12


@settings(max_examples=200, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(*[st.floats(-1e6, 1e6)] * 2, st.floats(0, 1)), min_size=1, max_size=30))
def test_between_property(spark, drawn):
    rows = [(min(a, b), max(a, b), s) for a, b, s in drawn]
    df = spark.createDataFrame(rows, "low double, high double, share double")
    for r in df.select("*", between(F.col("low"), F.col("high"), F.col("share")).alias("v")).collect():
        assert r.low <= r.v <= r.high


def test_running_percent_of_a_long_report(spark):
    report = spark.range(100_000).select(F.col("id").alias("key"), (F.col("id") % 1000).alias("n"))
    got = stats.with_running_percent(report, "n", "key")
    total = 100 * sum(range(1000))
    ends = got.filter("(n = 999 AND key = 999) OR (n = 0 AND key = 99000)").orderBy(F.col("n").desc()).collect()
    assert [r.running_percent for r in ends] == pytest.approx([99900 / total, 100.0])
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    # Windows without a group stand over the totals of ranges, never over the report's rows.
    assert got.count() == 100_000 and "_range" in plan
    for line in plan.splitlines():
        if "Window" in line and "running" not in line and "key" in line:
            assert "_range" in line


def test_codes_of_very_many_categories(spark):
    df = spark.range(20_000).select(F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("a"), F.lit("x").alias("b"))
    codes = preparation.fit_categories(df, ["a", "b"])
    assert codes.filter("column = 'a'").count() == 20_000
    wrong = codes.filter("column = 'a' AND code <> cast(substring(category, 2) AS double)")
    assert wrong.count() == 0
    assert codes.filter("column = 'b'").first()["code"] == 0.0
