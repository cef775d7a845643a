import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from fieldmark.operators import ranking
from fieldmark.operators.quantiles import exact_quantiles, quantile_table


@pytest.mark.parametrize("buckets", [1, 7, 200])
def test_quantiles_match_numpy(spark, buckets):
    rng = random.Random(1)
    # A third of the rows share one value.
    values = [0.0 if rng.random() < 0.34 else rng.lognormvariate(0, 3) for _ in range(3000)]
    groups = [rng.choice("ab") for _ in values]
    df = spark.createDataFrame(list(zip(groups, values)), "g string, v double")
    probs = [0.0, 0.1, 0.33, 0.5, 0.905, 1.0]
    found = exact_quantiles(df, ["v"], probs, "g", buckets=buckets)
    for g in "ab":
        want = np.percentile([v for k, v in zip(groups, values) if k == g], [p * 100 for p in probs])
        assert found[g, "v"] == pytest.approx(list(want), rel=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([("a", None), ("b", 2.0)], "g string, v double")
    assert exact_quantiles(df, ["v"], [0.5], "g") == {("a", "v"): [None], ("b", "v"): [2.0]}


def metrics_by_hand(rows):
    pos = [s for l, s in rows if l == 1]
    neg = [s for l, s in rows if l == 0]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    cuts = sorted({s for _, s in rows}, reverse=True)
    ap, last, ks = 0.0, 0.0, 0.0
    for c in cuts:
        tp, fp = sum(p >= c for p in pos), sum(n >= c for n in neg)
        ap += (tp / len(pos) - last) * tp / (tp + fp)
        last = tp / len(pos)
        ks = max(ks, abs(tp / len(pos) - fp / len(neg)))
    limit = np.percentile([s for _, s in rows], 90)
    best = [l for l, s in rows if s >= limit]
    lift = (sum(best) / len(best)) / (len(pos) / len(rows))
    tp = sum(p >= 0.5 for p in pos)
    f1 = 2 * tp / (tp + sum(n >= 0.5 for n in neg) + len(pos)) if pos else 0.0
    accuracy = sum((s >= 0.5) == (l == 1) for l, s in rows) / len(rows)
    return {"auc_roc": auc, "auc_pr": ap, "ks": ks, "lift_10": lift, "f1": f1, "accuracy": accuracy}


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 12)), min_size=2, max_size=60))
def test_metrics_match_definitions(spark, drawn):
    rows = [(1, 0.3), (0, 0.3), *[(l, s / 12) for l, s in drawn]]
    df = spark.createDataFrame(rows, "label int, score double").withColumn("model", F.lit("m"))
    got = ranking.all_metrics(df, "label", "score", "model").first().asDict()
    want = metrics_by_hand(rows)
    assert {k: got[k] for k in want} == pytest.approx(want)


@pytest.mark.parametrize("buckets", [1, 3, 50])
def test_buckets_do_not_change_counts(spark, buckets):
    rng = random.Random(2)
    rows = [(rng.randrange(2), rng.randrange(200) / 7) for _ in range(800)]
    df = spark.createDataFrame(rows, "label int, score double")
    got = ranking.running_counts(df, "label", "score", buckets=buckets).collect()
    for r in got:
        assert r.tp == sum(l for l, s in rows if s >= r.score)
        assert r.fp == sum(1 - l for l, s in rows if s >= r.score)


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.9)], "label int, score double").withColumn("m", F.lit("x"))
    row = ranking.all_metrics(df, "label", "score", "m").first()
    assert row.auc_roc is None and row.accuracy == 0.5


def test_roc_starts_at_origin(spark):
    df = spark.createDataFrame([(1, 0.2), (0, 0.1)], "label int, score double")
    counts = ranking.running_counts(df, "label", "score")
    points = sorted((p.fpr, p.tpr) for p in ranking.roc_points(counts, "score").collect())
    assert points == [(0.0, 0.0), (0.0, 1.0), (1.0, 1.0)]
    assert any(math.isinf(p.threshold) for p in ranking.roc_points(counts, "score").collect())


def test_any_number_of_groups(spark):
    df = spark.range(9000).select((F.col("id") % 3000).alias("g"), F.col("id").cast("double").alias("v"))
    table = quantile_table(df, ["v"], {"median": 0.5}, "g")
    assert table.count() == 3000 and table.filter(F.col("median") != F.col("g") + 3000).count() == 0
    scored = df.select("g", (F.col("v") % 2).cast("int").alias("label"), (F.col("v") / 9000).alias("score"))
    assert ranking.threshold_metrics(scored, "label", "score", "g").count() == 3000


def test_quantiles_shuffle_cells_not_values(spark, monkeypatch):
    from fieldmark.operators import quantiles

    summed = []
    real = quantiles.with_running_sums
    monkeypatch.setattr(quantiles, "with_running_sums", lambda df, *a, **k: summed.append(df.count()) or real(df, *a, **k))
    rng = random.Random(3)
    values = [rng.random() for _ in range(20_000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_quantiles(df, ["v"], [0.5])[None, "v"] == pytest.approx([np.percentile(values, 50)], rel=1e-15)
    # Of the distinct values only those near the wanted rank are sorted.
    assert 0 < summed[0] < 500


def test_quantiles_of_signs_zeros_and_nan(spark):
    values = [-2.5, -0.0, 0.0, 1e-310, 3.0, float("nan"), float("-inf"), float("inf"), None]
    df = spark.createDataFrame([(g, v) for g in ("a", None) for v in values], "g string, v double")
    ranks = [k / 7 for k in range(8)]
    want = [float("-inf"), -2.5, 0.0, 0.0, 1e-310, 3.0, float("inf"), float("nan")]
    for g, found in exact_quantiles(df, ["v"], ranks, "g").items():
        assert g[0] in ("a", None) and [repr(x + 0.0) for x in found] == [repr(x) for x in want]


def test_box_summary_moves_no_rows_to_their_fences(spark):
    from fieldmark.operators.stats import box_summary

    df = spark.range(1000).selectExpr("id % 2 as c", "cast(id as double) as v")
    plan = box_summary(df, ["v"], "c")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
