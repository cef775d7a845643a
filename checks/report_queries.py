"""Dataset assembly, portfolio reports, window and top-k operators, ranking metrics."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from checks import feature_queries as fq
from checks.spec import Check, digits
from checks.tables import on_policy, on_raw, policies, raw
from fieldmark.functions import dates
from fieldmark.ml import importance
from fieldmark.operators import quality, ranking, stats
from fieldmark.operators.quantiles import quantile_table
from fieldmark.plans import dataset, features
from fieldmark.plans.schema import FEATURE_COLUMNS, LABEL_COLUMNS, REF
from fieldmark.session import scratch_path, written

AS_OF, CUTOFF = "2001-01-01", "2000-01-01"
AMOUNTS = ["area_ha", "premium", "rate", "subsidy", "sum_insured", "coverage_level"]
REF_SQL = f"{fq.MONTH} AS ref_month"
SPINE = ["policy_id", "start_date", "end_date", "peril", *dataset.LOOKUP_KEYS]
# What spines and feature tables read of the policies.
FEATURED = list(dict.fromkeys([*SPINE, "indemnity", *features.ECONOMICS_INPUT]))


def held(*columns):
    return lambda spark, sf: policies(spark, sf, list(columns))


def over(columns, transform):
    return lambda spark, sf: transform(policies(spark, sf, list(columns)))


# --- dataset assembly ----------------------------------------------------------------------------

SPINE_SQL = f"""spine AS (
SELECT policy_id, {REF_SQL}, area_id, state, crop, crop_group, insurer, region,
  CASE WHEN peril <> 'none' THEN 1 ELSE 0 END AS has_claim
FROM policy WHERE end_date < DATE '{AS_OF}')"""


def _named(table: str, body: str) -> str:
    return f"{table} AS (\n{body}\n)"


# The mesh CTE has a different key per table, so each table is one nested query.
FEATURE_SQL = [
    _named("f_place", f"WITH {', '.join(fq.PLACE_CTES)} {fq.PLACE_BODY}"),
    _named("f_market", f"WITH {', '.join(fq.MARKET_CTES)} {fq.MARKET_BODY}"),
    _named("f_policy", f"WITH {fq.ECONOMICS_CTE} {fq.ECONOMICS_BODY}"),
    _named("f_insurer", f"WITH {fq.mesh('insurer', 'crop_group')} {fq.INSURER_BODY}"),
    _named("f_rate", f"WITH {fq.mesh('crop', 'state')} {fq.RATE_BODY}"),
    _named("f_portfolio", f"WITH {', '.join(fq.PORTFOLIO_CTES)} {fq.PORTFOLIO_BODY}"),
]
DERIVED_SQL = """CASE WHEN rate_mean_365d > 0 THEN policy_rate / rate_mean_365d END AS rate_anomaly,
  sin(start_month * (2 * pi() / 12)) AS month_sin, cos(start_month * (2 * pi() / 12)) AS month_cos"""
LOOKUP_SQL = """{spine} s
LEFT JOIN f_place USING (ref_month, area_id)
LEFT JOIN f_market USING (ref_month, state, crop_group)
LEFT JOIN f_policy USING (ref_month, policy_id)
LEFT JOIN f_insurer USING (ref_month, insurer, crop_group)
LEFT JOIN f_rate USING (ref_month, crop, state)
LEFT JOIN f_portfolio USING (ref_month, insurer, area_id)"""
ALL_FLOATS = {
    **fq.PLACE_FLOATS, **fq.MARKET_FLOATS, **fq.INSURER_FLOATS, **fq.RATE_FLOATS, **fq.PORTFOLIO_FLOATS,
    **fq.ECONOMICS_FLOATS, **digits(8, "rate_anomaly", "month_sin", "month_cos"),
}
SCORING_SQL = f"""scoring AS (
SELECT policy_id, {REF_SQL}, area_id, state, crop, crop_group, insurer, region
FROM policy WHERE date_trunc('month', start_date) >= DATE '{CUTOFF}')"""


def written_policies(spark, sf, columns=None):
    """The policy table (or some of its columns) as the jobs after the cleaning meet it: written once."""
    return written(policies(spark, sf, columns), "policies")


def _training(spark, sf):
    held = written_policies(spark, sf, FEATURED)
    tables = dataset.lookup_tables(held, scratch_path(spark, "features"))
    return dataset.training_set(held, AS_OF, CUTOFF, tables)


def _scoring(spark, sf):
    held = written_policies(spark, sf, FEATURED)
    tables = dataset.lookup_tables(held, scratch_path(spark, "features"))
    return dataset.scoring_set(held, CUTOFF, tables)


def _gated(spark, sf):
    """Features written after the gate passed; the gate looks at names before any write."""
    kept, _ = dataset.gold(policies(spark, sf, ["policy_id", "start_date", "state", "rate", "peril", "claim"]))
    path = scratch_path(spark, "gold")
    kept.write.parquet(path)
    return spark.read.schema(kept.schema).parquet(path)


def _looked_up(spark, sf):
    held = written_policies(spark, sf, FEATURED)
    names = ("market_risk", "insurer_risk", "portfolio")
    tables = dataset.written_feature_tables(held, scratch_path(spark, "features"), names, by_month=False)
    keys = {n: features.REGISTRY[n].key for n in tables}
    return dataset.lookup(dataset.training_spine(held, AS_OF), tables, keys)


def _derived(spark, sf):
    held = policies(spark, sf)
    spine = dataset.training_spine(held, AS_OF).select("policy_id", REF, "crop", "state")
    # The economics are dealt out by the key of their lookup as they are made; the reference is small once it is made.
    tables = {"policy_economics": features.policy_economics(held)}
    tables |= dataset.written_feature_tables(held, scratch_path(spark, "features"), ["rate_reference"], by_month=False)
    keys = {n: features.REGISTRY[n].key for n in tables}
    full = dataset.derived(dataset.lookup(spine, tables, keys))
    return full.select("policy_id", REF, "crop", "state", "rate_anomaly", "month_sin", "month_cos")


DERIVED_BODY = f"""SELECT s.policy_id, s.ref_month, s.crop, s.state, {DERIVED_SQL}
FROM spine s LEFT JOIN f_policy USING (ref_month, policy_id) LEFT JOIN f_rate USING (ref_month, crop, state)"""


def _split(spark, sf):
    spine = dataset.training_spine(policies(spark, sf, SPINE), AS_OF)
    marked = dataset.stratified_split(spine, "has_claim", ["policy_id", REF])
    return marked.groupBy("has_claim", "is_test").agg(F.count("*").alias("n_rows"))


def _monitored(spark, sf):
    held = policies(spark, sf, ["policy_id", "start_date", "claim", "rate"])
    scored = dataset.out_of_time(features.with_ref_month(held), CUTOFF).groupBy("policy_id", REF)
    return dataset.monitored(scored.agg(F.max("rate").alias("score")), held.filter("claim = 1"))


# --- reports ------------------------------------------------------------------------------------------

GROUPED = "count(*) AS policies, CAST(sum(claim) AS BIGINT) AS claims, sum(claim) * 1e0 / count(*) AS claim_rate"


def _yearly(spark, sf):
    dated = policies(spark, sf, ["start_date", "claim"]).withColumn("year", F.year("start_date"))
    return stats.volume(dated, ["year"]).filter(F.col("year") >= 1996)


def _regions(spark, sf):
    report = stats.with_share(stats.volume(policies(spark, sf, ["region", "claim"]), ["region"]), "policies")
    return stats.with_running_percent(report, "policies", "region")


def _crop_groups(spark, sf):
    report = stats.with_share(stats.volume(policies(spark, sf, ["crop_group", "claim"]), ["crop_group"]), "policies")
    return report.select(
        "crop_group", "policies", "claims",
        stats.in_percent(F.col("share")).alias("share_percent"),
        stats.in_percent(F.col("claim_rate")).alias("rate_percent"),
    )


def _report_sql(group: str) -> str:
    return f"""SELECT {group}, {GROUPED}, count(*) * 1e0 / sum(count(*)) OVER () AS share,
  sum(count(*)) OVER (ORDER BY count(*) DESC, {group}) * 1e2 / sum(count(*)) OVER () AS running_percent
FROM policy GROUP BY {group}"""


def _long_amounts(by: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {by + ',' if by else ''} '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM policy" for c in AMOUNTS
    )


QUARTER_SQL = "quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.75) AS q3"
BOX_SQL = f"""SELECT l.claim, l."column", any_value(q1) AS q1, any_value(median) AS median, any_value(q3) AS q3,
  min(CASE WHEN v BETWEEN q1 - (q3 - q1) * 1.5e0 AND q3 + (q3 - q1) * 1.5e0 THEN v END) AS low_whisker,
  max(CASE WHEN v BETWEEN q1 - (q3 - q1) * 1.5e0 AND q3 + (q3 - q1) * 1.5e0 THEN v END) AS high_whisker,
  count(CASE WHEN v NOT BETWEEN q1 - (q3 - q1) * 1.5e0 AND q3 + (q3 - q1) * 1.5e0 THEN 1 END) AS n_outliers
FROM long l JOIN boxes USING (claim, "column") GROUP BY 1, 2"""

# --- scores ---------------------------------------------------------------------------------------------------


def scored(spark, sf):
    """A deterministic score with many values and ties, by region as the model."""
    held = policies(spark, sf, ["policy_id", "region", "claim", "sum_insured", "area_ha", "start_date"])
    return held.select(
        "policy_id", F.col("region").alias("model"), F.col("claim").alias("label"),
        (F.floor((F.col("sum_insured") / 110000.0 + F.col("claim") * F.col("area_ha") / 500.0) * 10000) / 10000.0).alias("score"),
        dates.ref_month(F.col("start_date")).alias(REF),
    )


SCORED = f"""scored AS (
SELECT policy_id, region AS model, claim AS label,
  floor((sum_insured / 110000e0 + claim * area_ha / 500e0) * 10000) / 10000e0 AS score, {REF_SQL} FROM policy)"""
POINTS = """points AS (
SELECT model, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg FROM scored GROUP BY 1, 2)"""
RUNNING = """running AS (
SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
  sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n
FROM points WINDOW w AS (PARTITION BY model ORDER BY score DESC))"""
# Area under the curve from average ranks, unlike the running sums on the Spark side.
RANKED = """ranked AS (
SELECT model, label, rank() OVER (PARTITION BY model ORDER BY score)
  + (count(*) OVER (PARTITION BY model, score) - 1) / 2e0 AS mean_rank FROM scored)"""
AUC = """SELECT model, (sum(mean_rank) FILTER (label = 1) - count(*) FILTER (label = 1)
    * (count(*) FILTER (label = 1) + 1) / 2e0)
  / (count(*) FILTER (label = 1) * 1e0 * count(*) FILTER (label = 0)) AS auc_roc FROM ranked GROUP BY 1"""
AP = "SELECT model, sum(pos * (tp * 1e0 / (tp + fp))) / max(p) AS auc_pr FROM running GROUP BY 1"
KS = """SELECT model, max(abs(up - un)) AS ks FROM (
  SELECT model, sum(pos) OVER w * 1e0 / sum(pos) OVER (PARTITION BY model) AS up,
    sum(neg) OVER w * 1e0 / sum(neg) OVER (PARTITION BY model) AS un
  FROM points WINDOW w AS (PARTITION BY model ORDER BY score)) GROUP BY 1"""
CUTS = """SELECT s.model, avg(CASE WHEN (score >= 0.5) = (label = 1) THEN 1e0 ELSE 0e0 END) AS accuracy,
  2e0 * count(*) FILTER (score >= 0.5 AND label = 1)
    / (count(*) FILTER (score >= 0.5) + count(*) FILTER (label = 1)) AS f1,
  (count(*) FILTER (score >= cut AND label = 1) * 1e0 / count(*) FILTER (score >= cut))
    / (count(*) FILTER (label = 1) * 1e0 / count(*)) AS lift_10
FROM scored s JOIN (SELECT model, quantile_cont(score, 0.9) AS cut FROM scored GROUP BY 1) c ON c.model = s.model
GROUP BY 1"""
METRIC_NAMES = ("accuracy", "f1", "lift_10", "auc_roc", "auc_pr", "ks")
METRICS_SQL = f"""SELECT * FROM ({CUTS}) JOIN ({AUC}) USING (model) JOIN ({AP}) USING (model) JOIN ({KS}) USING (model)"""
SCORE_CTES = (SCORED, POINTS, RUNNING, RANKED)


def _counts(spark, sf):
    return ranking.running_counts(scored(spark, sf), "label", "score", ["model"])


def _cuts(column):
    return lambda spark, sf: ranking.threshold_metrics(scored(spark, sf), "label", "score", "model").select("model", column)


def _right(column):
    return lambda spark, sf: ranking.accuracy_and_f1(scored(spark, sf), "label", "score", "model").select("model", column)


def _curve(column):
    return lambda spark, sf: ranking.curve_metrics(_counts(spark, sf), ["model"]).select("model", column)


def _all(spark, sf):
    path = scratch_path(spark, "scores")
    scored(spark, sf).select("model", "label", "score").write.parquet(path)
    return ranking.all_metrics(spark.read.parquet(path), "label", "score", "model")


def _pivot(spark, sf):
    models = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
    pivoted = ranking.metric_table(_all(spark, sf), METRIC_NAMES, models)
    return pivoted.withColumnRenamed("MIDDLE EAST", "MIDDLE_EAST")


NULLABLE = ["policy_no", "place_code", "head_text", "rate_value", "indemnity_value"]


def _null_counts(spark, sf):
    return quality.null_counts(raw(spark, sf, NULLABLE))


def _classified(spark, sf):
    named = policies(spark, sf, ["insurer", "sum_insured"]).groupBy("insurer").agg(F.sum("sum_insured").alias("importance"))
    pattern = F.when(F.col("insurer").endswith("1"), "place_claims_90d").when(F.col("insurer").endswith("2"), "portfolio_hhi")
    named = named.select(F.coalesce(pattern, "insurer").alias("feature"), "importance")
    grouped = importance.with_group(named.groupBy("feature").agg(F.sum("importance").alias("importance")))
    return grouped


CLASSIFIED = """named AS (
SELECT CASE WHEN insurer LIKE '%1' THEN 'place_claims_90d' WHEN insurer LIKE '%2' THEN 'portfolio_hhi' ELSE insurer END
  AS feature, sum(sum_insured) AS importance FROM policy GROUP BY 1),
classified AS (
SELECT feature, importance, CASE WHEN feature LIKE 'place%' THEN 'place history'
  WHEN feature LIKE 'portfolio%' THEN 'portfolio concentration' ELSE 'other' END AS feature_group FROM named)"""


def _importance_groups(spark, sf):
    return importance.by_group(_classified(spark, sf))


NARROWED = ["premium", "rate"]


def _quantile_probe(spark, sf):
    held = policies(spark, sf, ["claim", *NARROWED])
    return quantile_table(held, NARROWED, {"median": 0.5, "p90": 0.9}, "claim")


CHECKS = {
    "d1_gold_features": Check(
        lambda spark, sf: dataset.gold(policies(spark, sf))[0],
        on_policy("SELECT " + ", ".join(c for c in FEATURE_COLUMNS if c not in ("lat", "lon")) + " FROM policy"),
        digits(6, "premium", "subsidy", "insured_yield", "coverage_level"),
        ["start_date", "end_date"],
    ),
    "d1_gold_labels": Check(
        lambda spark, sf: dataset.gold(policies(spark, sf))[1],
        on_policy("SELECT " + ", ".join(LABEL_COLUMNS) + " FROM policy"),
        digits(6, "indemnity") | digits(9, "loss_ratio"),
        ["start_date"],
    ),
    "d2_leakage_gate": Check(
        _gated,
        on_policy("SELECT policy_id, start_date, state, rate FROM policy"),
        dates=["start_date"],
    ),
    "d3_training_spine": Check(
        over(SPINE, lambda d: dataset.training_spine(d, AS_OF)), on_policy("SELECT * FROM spine", SPINE_SQL),
        dates=["ref_month"],
    ),
    "d4_scoring_spine": Check(
        over(SPINE, lambda d: dataset.scoring_spine(d, CUTOFF)), on_policy("SELECT * FROM scoring", SCORING_SQL),
        dates=["ref_month"],
    ),
    "d5_training_set": Check(
        _training,
        on_policy(
            f"SELECT * EXCLUDE (area_id, state, crop, policy_id), {DERIVED_SQL} FROM "
            + LOOKUP_SQL.format(spine="spine") + f" WHERE s.ref_month < DATE '{CUTOFF}'",
            SPINE_SQL, *FEATURE_SQL,
        ),
        ALL_FLOATS,
        ["ref_month"],
    ),
    "d4_scoring_set": Check(
        _scoring,
        on_policy(f"SELECT *, {DERIVED_SQL} FROM " + LOOKUP_SQL.format(spine="scoring"), SCORING_SQL, *FEATURE_SQL),
        ALL_FLOATS,
        ["ref_month"],
    ),
    "d6_stratified_split": Check(_split),
    "d7_class_balance": Check(
        over(SPINE, lambda d: dataset.class_balance(dataset.training_spine(d, AS_OF), "has_claim")),
        on_policy(
            "SELECT count(*) FILTER (has_claim = 0) AS negatives, count(*) FILTER (has_claim = 1) AS positives,"
            " avg(has_claim) AS claim_rate, count(*) FILTER (has_claim = 0) * 1e0 / count(*) FILTER (has_claim = 1)"
            " AS positive_weight FROM spine", SPINE_SQL,
        ),
        digits(9, "claim_rate", "positive_weight"),
    ),
    "f6_mature_labels": Check(
        over(["policy_id", "end_date"], lambda d: dataset.mature(d, AS_OF)),
        on_policy(f"SELECT policy_id, end_date FROM policy WHERE end_date < DATE '{AS_OF}'"),
        dates=["end_date"],
    ),
    "f7_out_of_time": Check(
        over(["policy_id", "start_date"], lambda d: dataset.out_of_time(features.with_ref_month(d), CUTOFF).drop("start_date")),
        on_policy(f"SELECT policy_id, {REF_SQL} FROM policy WHERE start_date >= DATE '{CUTOFF}'"),
        dates=["ref_month"],
    ),
    "f7_in_time": Check(
        over(["policy_id", "start_date"], lambda d: dataset.in_time(features.with_ref_month(d), CUTOFF).drop("start_date")),
        on_policy(f"SELECT policy_id, {REF_SQL} FROM policy WHERE start_date < DATE '{CUTOFF}'"),
        dates=["ref_month"],
    ),
    "f8_rare_and_class_filter": Check(
        over(["peril", "claim"], lambda d: stats.peril_ranking(d, rare=0.3)),
        on_policy(
            "SELECT * FROM (SELECT peril, count(*) AS claims, count(*) * 1e0 / sum(count(*)) OVER () AS share"
            " FROM policy WHERE claim = 1 GROUP BY 1) WHERE share > 0.3"
        ),
        digits(9, "share"),
    ),
    "j9_feature_lookup": Check(
        _looked_up,
        on_policy(
            """SELECT * FROM spine s
LEFT JOIN f_market USING (ref_month, state, crop_group)
LEFT JOIN f_insurer USING (ref_month, insurer, crop_group)
LEFT JOIN f_portfolio USING (ref_month, insurer, area_id)""",
            SPINE_SQL, FEATURE_SQL[1], FEATURE_SQL[3], FEATURE_SQL[5],
        ),
        {**fq.MARKET_FLOATS, **fq.INSURER_FLOATS, **fq.PORTFOLIO_FLOATS},
        ["ref_month"],
    ),
    "j10_monitoring_join": Check(
        _monitored,
        on_policy(
            f"""SELECT p.policy_id, p.ref_month, p.score, l.claim FROM (
  SELECT policy_id, {REF_SQL}, max(rate) AS score FROM policy WHERE start_date >= DATE '{CUTOFF}' GROUP BY 1, 2) p
LEFT JOIN (SELECT policy_id, {REF_SQL}, min(claim) AS claim FROM policy WHERE claim = 1 GROUP BY 1, 2) l
  ON l.policy_id = p.policy_id AND l.ref_month = p.ref_month"""
        ),
        dates=["ref_month"],
    ),
    "p30_rate_anomaly": Check(
        lambda spark, sf: _derived(spark, sf).drop("month_sin", "month_cos"),
        on_policy(f"SELECT * EXCLUDE (month_sin, month_cos) FROM ({DERIVED_BODY})", SPINE_SQL, FEATURE_SQL[2], FEATURE_SQL[4]),
        digits(8, "rate_anomaly"),
        ["ref_month"],
    ),
    "p31_cyclic_month": Check(
        lambda spark, sf: _derived(spark, sf).drop("rate_anomaly"),
        on_policy(f"SELECT * EXCLUDE (rate_anomaly) FROM ({DERIVED_BODY})", SPINE_SQL, FEATURE_SQL[2], FEATURE_SQL[4]),
        digits(9, "month_sin", "month_cos"),
        ["ref_month"],
    ),
    "p26_per_area": fq._part(
        "policy_economics", ["policy_id", "ref_month"], ["insured_per_ha", "premium_per_ha"], fq.ECONOMICS_SQL, fq.ECONOMICS_FLOATS
    ),
    "p27_cover_and_subsidy": fq._part(
        "policy_economics", ["policy_id", "ref_month"], ["yield_cover_ratio", "subsidy_ratio"], fq.ECONOMICS_SQL, fq.ECONOMICS_FLOATS
    ),
    "p28_pass_through": fq._part(
        "policy_economics", ["policy_id", "ref_month"], ["duration_days", "policy_rate", "policy_coverage"], fq.ECONOMICS_SQL, fq.ECONOMICS_FLOATS
    ),
    "p29_area_per_head": fq._part(
        "policy_economics", ["policy_id", "ref_month"], ["area_per_head"], fq.ECONOMICS_SQL, fq.ECONOMICS_FLOATS
    ),
    "p34_report_percent": Check(
        _crop_groups,
        on_policy(
            "SELECT crop_group, count(*) AS policies, CAST(sum(claim) AS BIGINT) AS claims,"
            " round(count(*) * 1e2 / sum(count(*)) OVER (), 2) AS share_percent,"
            " round(sum(claim) * 1e2 / count(*), 2) AS rate_percent FROM policy GROUP BY 1"
        ),
    ),
    "p35_feature_groups": Check(
        _classified, on_policy("SELECT * FROM classified", CLASSIFIED), digits(2, "importance")
    ),
    # --- reports ----------------------------------------------------------------------------------------
    "a13_loss_ratio_percent": Check(
        over(["indemnity", "premium"], stats.loss_ratio_percent),
        on_policy("SELECT sum(indemnity) / sum(premium) * 100 AS loss_ratio_percent FROM policy"),
        digits(6, "loss_ratio_percent"),
    ),
    "a14_null_counts": Check(
        _null_counts,
        on_raw(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null FROM raw" for c in NULLABLE)),
    ),
    "a15_distinct_values": Check(
        over(["peril", "crop"], lambda d: d.groupBy("peril").agg(F.countDistinct("crop").alias("n_crops"))),
        on_policy("SELECT peril, count(DISTINCT crop) AS n_crops FROM policy GROUP BY 1"),
    ),
    "a16_yearly": Check(
        _yearly,
        on_policy(f"SELECT year(start_date) AS year, {GROUPED} FROM policy WHERE year(start_date) >= 1996 GROUP BY 1"),
        digits(9, "claim_rate"),
    ),
    "a17_by_region": Check(_regions, on_policy(_report_sql("region")), digits(9, "claim_rate", "share", "running_percent")),
    "a18_target_distribution": Check(
        over(["claim"], stats.target_distribution),
        on_policy("SELECT claim, count(*) AS policies, count(*) * 1e0 / sum(count(*)) OVER () AS share FROM policy GROUP BY 1"),
        digits(9, "share"),
    ),
    "a19_numeric_summary": Check(
        over(AMOUNTS, lambda d: stats.numeric_summary(d, AMOUNTS)),
        on_policy(
            f'SELECT "column", avg(v) AS mean, min(v) AS min, max(v) AS max, stddev_samp(v) AS std, {QUARTER_SQL} FROM long GROUP BY 1',
            f"long AS ({_long_amounts()})",
        ),
        digits(5, "mean", "min", "max", "std", "q1", "median", "q3"),
    ),
    "a20_mean_and_median": Check(
        over(["claim", *AMOUNTS], lambda d: stats.mean_and_median(d, AMOUNTS, "claim")),
        on_policy(
            'SELECT claim, "column", avg(v) AS mean, quantile_cont(v, 0.5) AS median FROM long GROUP BY 1, 2',
            f"long AS ({_long_amounts('claim')})",
        ),
        digits(5, "mean", "median"),
    ),
    "a21_box_summary": Check(
        over(["claim", *AMOUNTS], lambda d: stats.box_summary(d, AMOUNTS, "claim")),
        on_policy(
            BOX_SQL, f"long AS ({_long_amounts('claim')})",
            f'boxes AS (SELECT claim, "column", {QUARTER_SQL} FROM long GROUP BY 1, 2)',
        ),
        digits(5, "q1", "median", "q3", "low_whisker", "high_whisker"),
    ),
    "a22_peril_ranking": Check(
        over(["peril", "claim"], lambda d: stats.with_running_percent(stats.peril_ranking(d), "claims", "peril")),
        on_policy(
            "SELECT peril, claims, share, sum(claims) OVER (ORDER BY claims DESC, peril) * 1e2 / sum(claims) OVER ()"
            " AS running_percent FROM (SELECT peril, count(*) AS claims, count(*) * 1e0 / sum(count(*)) OVER () AS share"
            " FROM policy WHERE claim = 1 GROUP BY 1) WHERE share > 0.001"
        ),
        digits(9, "share", "running_percent"),
    ),
    "a23_density_histogram": Check(
        over(["claim", "sum_insured"], lambda d: stats.density_histogram(d, "sum_insured", "claim")),
        on_policy(
            """SELECT claim, bin, lo + bin * ((hi - lo) / 50) AS left_edge, count(*) AS n_rows,
  count(*) / (n * ((hi - lo) / 50)) AS density
FROM (SELECT claim, lo, hi, n,
  CAST(least(floor((sum_insured - lo) / ((hi - lo) / 50)), 49) AS INT) AS bin
  FROM policy JOIN (SELECT claim, min(sum_insured) AS lo, max(sum_insured) AS hi, count(*) AS n FROM policy GROUP BY 1)
  USING (claim)) GROUP BY claim, bin, lo, hi, n"""
        ),
        digits(4, "left_edge") | digits(12, "density"),
    ),
    "a24_importance_by_group": Check(
        _importance_groups,
        on_policy(
            "SELECT feature_group, round(sum(importance) / (SELECT sum(importance) FROM classified) * 100, 2)"
            " AS importance_percent FROM classified GROUP BY 1", CLASSIFIED,
        ),
    ),
    "quantiles_by_narrowing": Check(
        _quantile_probe,
        on_policy(
            'SELECT claim, "column", quantile_cont(v, 0.5) AS median, quantile_cont(v, 0.9) AS p90 FROM long'
            " WHERE \"column\" IN ('premium', 'rate') GROUP BY 1, 2",
            f"long AS ({_long_amounts('claim')})",
        ),
        digits(5, "median", "p90"),
    ),
    # --- windows, order, top-k -----------------------------------------------------------------------------
    "w4_total_of_counts": Check(
        over(
            ["state", "insurer"],
            lambda d: stats.volume(d.withColumn("claim", F.lit(0)), ["state", "insurer"]).select(
                "state", "insurer", "policies",
                F.sum("policies").over(W.partitionBy("state")).alias("in_state"),
            ),
        ),
        on_policy(
            "SELECT state, insurer, count(*) AS policies, CAST(sum(count(*)) OVER (PARTITION BY state) AS BIGINT) AS in_state"
            " FROM policy GROUP BY 1, 2"
        ),
    ),
    "w5_top_per_group": Check(
        over(["state", "crop"], lambda d: stats.top_per_group(d, ["state"], "crop")),
        on_policy(
            "SELECT state, crop, n_rows FROM (SELECT state, crop, count(*) AS n_rows, row_number() OVER"
            " (PARTITION BY state ORDER BY count(*) DESC, crop) AS rn FROM policy GROUP BY 1, 2) WHERE rn = 1"
        ),
    ),
    "w6_share_of_total": Check(
        over(["insurer", "claim"], lambda d: stats.with_share(stats.volume(d, ["insurer"]), "policies").drop("claim_rate")),
        on_policy(
            "SELECT insurer, count(*) AS policies, CAST(sum(claim) AS BIGINT) AS claims,"
            " count(*) * 1e0 / (SELECT count(*) FROM policy) AS share FROM policy GROUP BY 1"
        ),
        digits(10, "share"),
    ),
    "w7_running_percent": Check(
        over(["crop", "claim"], lambda d: stats.with_running_percent(stats.volume(d, ["crop"]), "claims", "crop").drop("claim_rate")),
        on_policy(
            "SELECT crop, count(*) AS policies, CAST(sum(claim) AS BIGINT) AS claims, sum(sum(claim)) OVER"
            " (ORDER BY sum(claim) DESC, crop) * 1e2 / sum(sum(claim)) OVER () AS running_percent FROM policy GROUP BY 1"
        ),
        digits(9, "running_percent"),
    ),
    "o1_sort_descending": Check(
        over(["state", "claim"], lambda d: stats.volume(d, ["state"]).orderBy(F.col("policies").desc(), "state")),
        on_policy(f"SELECT state, {GROUPED} FROM policy GROUP BY 1 ORDER BY policies DESC, state"),
        digits(9, "claim_rate"),
    ),
    "o2_champion": Check(
        lambda spark, sf: stats.top_rows(ranking.curve_metrics(_counts(spark, sf), ["model"]), 1, "auc_roc", "model").select("model", "auc_roc"),
        on_policy(f"SELECT * FROM ({AUC}) ORDER BY auc_roc DESC, model LIMIT 1", *SCORE_CTES),
        digits(10, "auc_roc"),
    ),
    "o3_top_15": Check(
        over(["insurer", "claim"], lambda d: stats.top_rows(stats.volume(d, ["insurer"]), 15, "claims", "insurer")),
        on_policy(f"SELECT insurer, {GROUPED} FROM policy GROUP BY 1 ORDER BY claims DESC, insurer LIMIT 15"),
        digits(9, "claim_rate"),
    ),
    # --- ranking metrics ------------------------------------------------------------------------------------------
    "e1_accuracy": Check(_right("accuracy"), on_policy(f"SELECT model, accuracy FROM ({CUTS})", SCORED), digits(10, "accuracy")),
    "e2_f1": Check(_right("f1"), on_policy(f"SELECT model, f1 FROM ({CUTS})", SCORED), digits(10, "f1")),
    "e3_auc_roc": Check(_curve("auc_roc"), on_policy(AUC, *SCORE_CTES), digits(10, "auc_roc")),
    "e4_average_precision": Check(_curve("auc_pr"), on_policy(AP, *SCORE_CTES), digits(10, "auc_pr")),
    "e5_ks": Check(_curve("ks"), on_policy(KS, *SCORE_CTES), digits(10, "ks")),
    "e6_lift_10": Check(_cuts("lift_10"), on_policy(f"SELECT model, lift_10 FROM ({CUTS})", SCORED), digits(10, "lift_10")),
    "e7_roc_points": Check(
        lambda spark, sf: ranking.roc_points(_counts(spark, sf), "score", ["model"]).filter("threshold < 1e300"),
        on_policy("SELECT model, score AS threshold, fp * 1e0 / n AS fpr, tp * 1e0 / p AS tpr FROM running", *SCORE_CTES),
        digits(10, "fpr", "tpr"),
    ),
    "e8_precision_recall_points": Check(
        lambda spark, sf: ranking.precision_recall_points(_counts(spark, sf), "score", ["model"]),
        on_policy(
            'SELECT model, score AS threshold, tp * 1e0 / (tp + fp) AS "precision", tp * 1e0 / p AS recall,'
            " p * 1e0 / (p + n) AS base_rate FROM running",
            *SCORE_CTES,
        ),
        digits(10, "precision", "recall", "base_rate"),
    ),
    "e9_metric_pivot": Check(
        _pivot,
        on_policy(
            "SELECT metric, " + ", ".join(
                f"max(value) FILTER (model = '{m}') AS {m.replace(' ', '_')}" for m in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
            ) + f" FROM (UNPIVOT ({METRICS_SQL}) ON {', '.join(METRIC_NAMES)} INTO NAME metric VALUE value) GROUP BY 1",
            *SCORE_CTES,
        ),
        digits(9, "AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE_EAST"),
    ),
    "e_all_metrics": Check(_all, on_policy(METRICS_SQL, *SCORE_CTES), digits(10, *METRIC_NAMES)),
    "e11_score_drift": Check(
        lambda spark, sf: ranking.score_drift(scored(spark, sf), "score", REF),
        on_policy("SELECT ref_month, avg(score) AS mean_score, count(score) AS n_scored FROM scored GROUP BY 1", SCORED),
        digits(12, "mean_score"),
        ["ref_month"],
    ),
}
