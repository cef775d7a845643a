"""Second queries beside narrower ones: all columns, all tables, whole reports, and models whose values SQL can state."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from checks import report_queries as rq
from checks.spec import Check, digits
from checks.tables import RAW, on_policy, on_raw, policies, raw, read
from fieldmark.ml import boosting, importance, models, preparation
from fieldmark.operators import cleaning, quality, ranking, stats
from fieldmark.plans import dataset, features
from fieldmark.plans.schema import REF
from fieldmark.session import discard, scratch_path, written
from fieldmark.sources import readers, writers

# --- all columns and tables --------------------------------------------------------------------------


def _all_lookups(spark, sf):
    held = rq.written_policies(spark, sf, rq.FEATURED)
    tables = dataset.lookup_tables(held, scratch_path(spark, "features"))
    keys = {n: features.REGISTRY[n].key for n in tables}
    return dataset.lookup(dataset.training_spine(held, rq.AS_OF), tables, keys)


NUMBERS = [*preparation.HISTORY, *preparation.CONTRACT]
TRAINING_SQL = (
    f"full_set AS (SELECT *, {rq.DERIVED_SQL} FROM {rq.LOOKUP_SQL.format(spine='spine')} WHERE s.ref_month < DATE '{rq.CUTOFF}')"
)


def _training(spark, sf):
    held = rq.written_policies(spark, sf, rq.FEATURED)
    tables = dataset.lookup_tables(held, scratch_path(spark, "features"))
    early = {name: dataset.in_time(table, rq.CUTOFF) for name, table in tables.items()}
    full = dataset.with_features(dataset.training_spine(held, rq.AS_OF, rq.CUTOFF), early)
    made = written(full.select("policy_id", REF, dataset.LABEL, *preparation.ALL_FEATURES), "training")
    # Nothing reads what the rows were made of again.
    discard(held, *tables.values())
    return made


def _all_medians(spark, sf):
    found = preparation.fit_medians(_training(spark, sf), NUMBERS)
    return spark.createDataFrame(list(found.items()), "column string, median double")


def _all_scales(spark, sf):
    fitted = preparation.fit(_training(spark, sf), linear=True)
    return spark.createDataFrame([(c, *fitted.scales[c]) for c in fitted.features], "column string, mean double, deviation double")


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


MEDIANS_SQL = _union(
    f"SELECT '{c}' AS \"column\", coalesce(quantile_cont({c}, 0.5), 0) AS median FROM full_set" for c in NUMBERS
)
_MODE = "(SELECT {c} FROM full_set WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
SCALES_SQL = _union(
    [
        f"SELECT '{c}' AS \"column\", avg(v) AS mean, CASE WHEN stddev_pop(v) = 0 THEN 1 ELSE stddev_pop(v) END AS deviation"
        f" FROM (SELECT coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont({c}, 0.5) FROM full_set), 0) AS v FROM full_set)"
        for c in [*NUMBERS, *preparation.CYCLIC]
    ]
    + [
        f"SELECT '{c}', avg(v), stddev_pop(v) FROM (SELECT dense_rank() OVER (ORDER BY coalesce({c}, {_MODE.format(c=c)})) - 1 AS v FROM full_set)"
        for c in preparation.CATEGORIES
    ]
)

RULES_SQL = "CASE " + " ".join(f"WHEN contains(feature, '{part}') THEN '{name}'" for part, name in importance.GROUPS) + " ELSE 'other' END"


def _named_features(spark, sf):
    """An importance per feature name: the insured sum of the areas dealt to it."""
    names = F.array(*[F.lit(n) for n in preparation.ALL_FEATURES])
    held = policies(spark, sf, ["area_id", "sum_insured"])
    dealt = held.withColumn("feature", F.element_at(names, F.col("area_id") % len(preparation.ALL_FEATURES) + 1))
    return importance.with_group(dealt.groupBy("feature").agg(F.sum("sum_insured").alias("importance")))


NAMED_SQL = f"""listed AS (SELECT {preparation.ALL_FEATURES!r} AS names),
named AS (SELECT names[area_id % {len(preparation.ALL_FEATURES)} + 1] AS feature, sum(sum_insured) AS importance
  FROM policy, listed GROUP BY 1),
ruled AS (SELECT feature, importance, {RULES_SQL} AS feature_group FROM named)"""

# --- sources -------------------------------------------------------------------------------------------------


def _column_sets(spark, sf):
    """Columns on which two landed sources differ, with how many values each has."""
    left = policies(spark, sf, ["policy_id", "state", "rate", "insurer"])
    right = raw(spark, sf, ["policy_no", "state_code", "insurer_name"]).withColumnsRenamed(
        {"policy_no": "policy_id", "state_code": "state"}
    )
    found = readers.column_sets({"left": left, "right": right}).filter(~F.col("same"))
    counts = []
    for name, table in (("left", left), ("right", right)):
        filled = table.agg(*[F.count(c).alias(c) for c in table.columns])
        counts.append(filled.unpivot([], filled.columns, "c", "n").withColumn("t", F.lit(name)))
    held = counts[0].unionByName(counts[1]).groupBy("c").pivot("t", ["left", "right"]).agg(F.first("n"))
    joined = found.join(held, F.col("column") == F.col("c"))
    return joined.select(
        "column", F.array_join("tables", "+").alias("tables"), F.array_join("types", "+").alias("types"),
        F.col("left").alias("n_left"), F.col("right").alias("n_right"),
    )


COLUMN_SETS_SQL = """SELECT 'policy_id' AS "column", 'left+right' AS tables, 'bigint+string' AS types,
  (SELECT count(policy_id) FROM policy) AS n_left, (SELECT count(policy_no) FROM raw) AS n_right
UNION ALL SELECT 'rate', 'left', 'double', (SELECT count(rate) FROM policy), NULL
UNION ALL SELECT 'insurer', 'left', 'string', (SELECT count(insurer) FROM policy), NULL
UNION ALL SELECT 'insurer_name', 'right', 'string', NULL, (SELECT count(insurer_name) FROM raw)"""


def _titled_files(spark, sf):
    """A dimension from several files as offices publish them: six title rows, a header, then the rows."""
    held = read(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    path = scratch_path(spark, "titled")
    files = 5
    quoted = F.concat(F.lit('"'), "c_name", F.lit('; x"'))
    body = held.select(
        (F.col("c_custkey") % files).alias("file"), F.col("c_custkey").alias("line"),
        F.concat_ws(";", F.col("c_custkey").cast("string"), quoted, F.col("c_nationkey").cast("string")).alias("value"),
    )
    title = spark.range(files * 7).select(
        F.floor(F.col("id") / 7).alias("file"), (F.col("id") % 7 - 7).alias("line"),
        F.when(F.col("id") % 7 == 6, "code;name;state").otherwise(F.concat(F.lit("Title; row "), F.col("id") % 7)).alias("value"),
    )
    lines = title.unionByName(body).repartition(files, "file").sortWithinPartitions("file", "line")
    lines.select("value", "file").write.partitionBy("file").text(path)
    return readers.read_below_title(spark, path, "code bigint, name string, state int", 6, sep=";")


# --- reports --------------------------------------------------------------------------------------------------


def _preview(spark, sf):
    held = policies(spark, sf, ["policy_id", "state", "insurer", "area_ha", "sum_insured"])
    return held.orderBy(*held.columns).limit(20)


def _roc_with_origin(spark, sf):
    points = ranking.roc_points(rq._counts(spark, sf), "score", ["model"])
    return points.withColumn("threshold", F.when(F.col("threshold") < float("inf"), F.col("threshold")))


MODELS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def _tuned_gain(spark, sf):
    return ranking.baseline_and_tuned(rq._all(spark, sf), rq.METRIC_NAMES, "AFRICA", "ASIA")


def _split_shares(spark, sf):
    spine = dataset.training_spine(policies(spark, sf, rq.SPINE), rq.AS_OF)
    marked = dataset.stratified_split(spine, dataset.LABEL, ["policy_id", REF])
    share = F.avg(F.col("is_test").cast("double"))
    return marked.groupBy(dataset.LABEL).agg(F.count("*").alias("n_rows"), (F.abs(share - 0.3) < 0.01).alias("share_holds"))


# --- models on one two-valued feature, whose fits have closed forms --------------------------------------------

SMALL = {
    "decision_tree": {"maxDepth": 1},
    "random_forest": {"maxDepth": 1, "numTrees": 3, "bootstrap": False},
    "adaboost": {"rounds": 1},
    "gradient_boosting": {"maxDepth": 1, "maxIter": 1},
}
LARGE = "CASE WHEN sum_insured > 40000 THEN 1 ELSE 0 END"
FIRM = "CASE WHEN area_ha > 25 THEN 1 ELSE 0 END"


def _vectors(spark, sf, expressions=(LARGE,)):
    held = policies(spark, sf, ["policy_id", "start_date", "claim", "sum_insured", "area_ha"])
    names = [f"x{i}" for i in range(len(expressions))]
    held = held.select(
        "policy_id", features.dates.ref_month(F.col("start_date")).alias(REF), F.col("claim").alias("label"),
        *[F.expr(e).cast("double").alias(n) for e, n in zip(expressions, names)],
    )
    return written(VectorAssembler(inputCols=names, outputCol="features").transform(held), "vectors")


def _leaves(name):
    def build(spark, sf):
        rows = _vectors(spark, sf)
        model = models.fit_model(name, rows, "label", **SMALL[name])
        return models.with_score(model, rows).groupBy("x0").agg(F.count("*").alias("n_rows"), F.avg("score").alias("score"))

    return build


# Class weights: balanced for tree and forest, negatives over positives for boosting.
SIDES = f"""sides AS (SELECT {LARGE} * 1e0 AS x0, count(*) AS n, sum(claim) * 1e0 AS pos, count(*) - sum(claim) * 1e0 AS neg
  FROM policy GROUP BY 1),
totals AS (SELECT sum(pos) AS p, sum(neg) AS q FROM sides)"""
TREE_LEAVES = "SELECT x0, n AS n_rows, (pos / p) / (pos / p + neg / q) AS score FROM sides, totals"
BOOSTED_LEAVES = """SELECT x0, n AS n_rows, 1e0 / (1 + exp(-2 * (pos * q / p - neg) / (pos * q / p + neg))) AS score
FROM sides, totals"""


def _two_rounds(spark, sf):
    rows = _vectors(spark, sf, (LARGE, FIRM))
    found = boosting.fit_boosted_stumps(rows, "label", rounds=2, rate=0.5)
    listed = [(k, s.feature, s.threshold, s.below, s.above, s.weight) for k, s in enumerate(found.stumps, 1)]
    return spark.createDataFrame(listed, "round int, feature int, threshold double, below int, above int, vote double")


def _round_sql(r: int, weights: str) -> str:
    """The best of the two stumps under the given row weights, its error and its vote."""
    return f"""cells{r} AS (
  SELECT feature, x, sum(w) FILTER (claim = 1) AS pos, sum(w) FILTER (claim = 0) AS neg FROM (
    SELECT 0 AS feature, x0 AS x, claim, {weights} AS w FROM rows_ UNION ALL SELECT 1, x1, claim, {weights} FROM rows_) GROUP BY 1, 2),
stumps{r} AS (
  SELECT feature, sum(pos + neg - (pos * pos + neg * neg) / (pos + neg)) AS cost, sum(least(pos, neg)) / sum(pos + neg) AS error,
    max(CASE WHEN x = 0 AND pos > neg THEN 1 ELSE 0 END) AS below, max(CASE WHEN x = 1 AND pos > neg THEN 1 ELSE 0 END) AS above
  FROM cells{r} GROUP BY 1),
best{r} AS (
  SELECT CASE WHEN below = above THEN -1 ELSE feature END AS feature, feature AS looked, below, above, 0.5e0 * ln((1 - error) / error) AS vote
  FROM stumps{r} ORDER BY round(cost, 6), looked LIMIT 1)"""


# Rows that the first stump misses weigh exp(vote) times as much in the second round.
ROUNDS_SQL = f"""rows_ AS (SELECT {LARGE} AS x0, {FIRM} AS x1, claim FROM policy),
{_round_sql(1, "1e0")},
{_round_sql(2, "exp((SELECT vote FROM best1) * CASE WHEN CASE WHEN CASE (SELECT looked FROM best1) WHEN 0 THEN x0 ELSE x1 END = 0 THEN (SELECT below FROM best1) ELSE (SELECT above FROM best1) END <> claim THEN 1 ELSE 0 END)")}"""
ROUNDS_BODY = " UNION ALL ".join(
    f"SELECT {r} AS round, feature, CASE WHEN feature < 0 THEN 0e0 ELSE 0.5e0 END AS threshold, below, above, vote FROM best{r}" for r in (1, 2)
)


def _compared(spark, sf):
    rows = _vectors(spark, sf)
    outcome = models.compare(
        rows.filter("policy_id % 3 <> 0"), rows.filter("policy_id % 3 = 0"), "label", SMALL
    )
    return outcome.metrics.select("model", "split", "auc_roc", "ks", (F.col("model") == outcome.champion).alias("is_champion"))


# All four models order the rows as the feature does, whichever way; so does SQL.
COMPARED_SQL = f"""parts AS (SELECT CASE WHEN policy_id % 3 = 0 THEN 'test' ELSE 'train' END AS split, claim, {LARGE} AS x FROM policy),
rates AS (SELECT split, sum(claim) FILTER (x = 1) * 1e0 / sum(claim) AS up,
  count(*) FILTER (x = 1 AND claim = 0) * 1e0 / count(*) FILTER (claim = 0) AS un FROM parts GROUP BY 1),
way AS (SELECT CASE WHEN avg(claim) FILTER (x = 1) >= avg(claim) FILTER (x = 0) THEN 1e0 ELSE -1e0 END AS sign FROM parts WHERE split = 'train'),
names AS (SELECT unnest(['decision_tree', 'random_forest', 'adaboost', 'gradient_boosting']) AS model)"""
COMPARED_BODY = """SELECT model, split, CASE WHEN model = 'adaboost' THEN 0.5e0 ELSE 0.5e0 + sign * (up - un) / 2 END AS auc_roc,
  CASE WHEN model = 'adaboost' THEN 0e0 ELSE abs(up - un) END AS ks,
  model = CASE WHEN (SELECT sign * (up - un) FROM rates, way WHERE split = 'test') < 0 THEN 'adaboost' ELSE 'random_forest' END AS is_champion
FROM rates, way, names"""


def _fitted_tree(spark, sf, path):
    """A one-split tree with its preparation, saved and loaded again, next to the one in memory."""
    rows = _vectors(spark, sf).drop("features")
    fitted = preparation.fit(rows, ["x0"], [], [])
    model = models.fit_model("decision_tree", fitted.transform(rows), "label", maxDepth=1)
    models.save_model(spark, path, "decision_tree", model, fitted)
    return rows, fitted, model, models.load_model(spark, path)


def _loaded_scores(spark, sf):
    rows, fitted, model, (name, version, loaded, prep) = _fitted_tree(spark, sf, scratch_path(spark, "models"))
    before = models.with_score(model, fitted.transform(rows), "before")
    both = models.with_score(loaded, prep.transform(before.drop("features")), "after")
    apart = F.max(F.abs(F.col("before") - F.col("after")))
    return both.groupBy("x0").agg(
        F.count("*").alias("n_rows"), F.avg("after").alias("score"), apart.alias("apart"), F.lit(version).alias("version")
    )


def _batch_values(spark, sf):
    rows, _, _, (name, version, loaded, prep) = _fitted_tree(spark, sf, scratch_path(spark, "models"))
    path = scratch_path(spark, "scores")
    late = dataset.out_of_time(rows, rq.CUTOFF)
    writers.overwrite(models.score_batch(late, prep, loaded, name, version), path, ["model_name"])
    back = spark.read.parquet(path)
    return back.groupBy(REF, "model_name", "label").agg(F.count("*").alias("n_rows"), F.sum("prob_label").alias("prob_total"))


BATCH_SQL = f"""SELECT ref_month, 'decision_tree' AS model_name, label, count(*) AS n_rows,
  sum(CASE WHEN label = 1 THEN score ELSE 1 - score END) AS prob_total
FROM (SELECT {rq.REF_SQL}, {LARGE} * 1e0 AS x0 FROM policy WHERE start_date >= DATE '{rq.CUTOFF}') JOIN ({TREE_LEAVES}) USING (x0)
CROSS JOIN (SELECT unnest([0, 1]) AS label) GROUP BY 1, 3"""


def _importance_names(spark, sf):
    """Importances of a tree over named columns: one row per name, shares that sum to one."""
    names = ["sum_insured", "area_ha", "rate", "premium", "coverage_level"]
    rows = policies(spark, sf, ["claim", *names])
    fitted = preparation.fit(rows, names, [], [])
    model = models.fit_model("decision_tree", fitted.transform(rows), "claim", maxDepth=3)
    found = models.feature_importances(model, fitted, spark)
    total = found.agg(F.sum("share")).scalar()
    present = rows.unpivot([], names, "feature", "v").groupBy("feature").agg(F.count("v").alias("n_values"))
    return found.join(present, "feature").select("feature", "n_values", F.round(total, 9).alias("share_total"))


def _slot_sums(spark, sf):
    """Sums over the assembled vector, slot by slot."""
    from pyspark.ml.functions import vector_to_array

    # Written: the fit and the sums read it several times.
    held = written(raw(spark, sf, ["rate_value", "indemnity_value", "product_class", "place_code"]), "raw")
    fitted = preparation.fit(held, ["rate_value", "indemnity_value"], ["product_class", "place_code"], [])
    slots = fitted.transform(held).select(F.posexplode(vector_to_array("features")).alias("slot", "value"))
    return slots.groupBy("slot").agg(F.count("*").alias("n_rows"), F.sum("value").alias("total"))


def _slot_code(c: str) -> str:
    mode = f"(SELECT {c} FROM raw WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
    return f"(SELECT dense_rank() OVER (ORDER BY coalesce({c}, {mode})) - 1 AS v FROM raw)"


SLOTS_SQL = _union(
    [
        f"SELECT {k} AS slot, count(*) AS n_rows, sum(coalesce({c}, (SELECT quantile_cont({c}, 0.5) FROM raw))) AS total FROM raw"
        for k, c in enumerate(("rate_value", "indemnity_value"))
    ]
    + [f"SELECT {k}, count(*), CAST(sum(v) AS DOUBLE) FROM {_slot_code(c)}" for k, c in ((2, "product_class"), (3, "place_code"))]
)

RAW_COLUMNS = list(RAW)

CHECKS = {
    "j9_all_lookups": Check(
        _all_lookups,
        on_policy("SELECT * FROM " + rq.LOOKUP_SQL.format(spine="spine"), rq.SPINE_SQL, *rq.FEATURE_SQL),
        {k: v for k, v in rq.ALL_FLOATS.items() if k not in ("rate_anomaly", "month_sin", "month_cos")},
        ["ref_month"],
    ),
    "m1_all_medians": Check(_all_medians, on_policy(MEDIANS_SQL, rq.SPINE_SQL, *rq.FEATURE_SQL, TRAINING_SQL), digits(5, "median")),
    "m5_all_scales": Check(_all_scales, on_policy(SCALES_SQL, rq.SPINE_SQL, *rq.FEATURE_SQL, TRAINING_SQL), digits(5, "mean", "deviation")),
    "p35_all_rules": Check(_named_features, on_policy("SELECT * FROM ruled", NAMED_SQL), digits(2, "importance")),
    "a24_all_groups": Check(
        lambda spark, sf: importance.by_group(_named_features(spark, sf)),
        on_policy(
            "SELECT feature_group, round(sum(importance) / (SELECT sum(importance) FROM ruled) * 100, 2) AS importance_percent"
            " FROM ruled GROUP BY 1", NAMED_SQL,
        ),
    ),
    "a14_all_null_counts": Check(
        lambda spark, sf: quality.null_counts(raw(spark, sf)),
        on_raw(_union(f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null FROM raw" for c in RAW_COLUMNS)),
    ),
    "p1_every_column": Check(
        lambda spark, sf: cleaning.all_to_string(policies(spark, sf, ["policy_id", "start_date", "end_date", "duration_days", "state", "claim", "area_id", "head_count", "crop"])),
        on_policy(
            "SELECT " + ", ".join(
                f"CAST({c} AS VARCHAR) AS {c}"
                for c in ("policy_id", "start_date", "end_date", "duration_days", "state", "claim", "area_id", "head_count", "crop")
            ) + " FROM policy"
        ),
    ),
    "s3_column_sets": Check(_column_sets, on_policy(COLUMN_SETS_SQL, on_raw("")[len("WITH "):].rstrip())),
    "s11_titled_files": Check(
        _titled_files, "SELECT c_custkey AS code, c_name || '; x' AS name, CAST(c_nationkey AS INT) AS state FROM customer"
    ),
    "o4_ordered_preview": Check(
        _preview,
        on_policy("SELECT policy_id, state, insurer, area_ha, sum_insured FROM policy ORDER BY ALL LIMIT 20"),
    ),
    "e7_roc_with_origin": Check(
        _roc_with_origin,
        on_policy(
            "SELECT model, score AS threshold, fp * 1e0 / n AS fpr, tp * 1e0 / p AS tpr FROM running"
            " UNION ALL SELECT DISTINCT model, NULL, 0e0, 0e0 FROM running", *rq.SCORE_CTES,
        ),
        digits(10, "fpr", "tpr"),
    ),
    "e9_baseline_and_tuned": Check(
        _tuned_gain,
        on_policy(
            "SELECT metric, max(value) FILTER (model = 'AFRICA') AS baseline, max(value) FILTER (model = 'ASIA') AS tuned,"
            " max(value) FILTER (model = 'ASIA') - max(value) FILTER (model = 'AFRICA') AS gain"
            f" FROM (UNPIVOT ({rq.METRICS_SQL}) ON {', '.join(rq.METRIC_NAMES)} INTO NAME metric VALUE value) GROUP BY 1",
            *rq.SCORE_CTES,
        ),
        digits(9, "baseline", "tuned", "gain"),
    ),
    "d6_split_shares": Check(
        _split_shares, on_policy("SELECT has_claim, count(*) AS n_rows, true AS share_holds FROM spine GROUP BY 1", rq.SPINE_SQL)
    ),
    "m4_slot_sums": Check(_slot_sums, on_raw(SLOTS_SQL), digits(3, "total")),
    "m6_tree_leaves": Check(_leaves("decision_tree"), on_policy(TREE_LEAVES, SIDES), digits(9, "score")),
    "m7_forest_leaves": Check(_leaves("random_forest"), on_policy(TREE_LEAVES, SIDES), digits(9, "score")),
    "m9_boosted_leaves": Check(_leaves("gradient_boosting"), on_policy(BOOSTED_LEAVES, SIDES), digits(9, "score")),
    "m8_two_rounds": Check(_two_rounds, on_policy(ROUNDS_BODY, ROUNDS_SQL), digits(9, "vote")),
    "m10_one_feature": Check(_compared, on_policy(COMPARED_BODY, COMPARED_SQL), digits(9, "auc_roc", "ks")),
    "m12_importance_names": Check(
        _importance_names,
        on_policy(
            _union(
                f"SELECT '{c}' AS feature, count({c}) AS n_values, 1e0 AS share_total FROM policy"
                for c in ("sum_insured", "area_ha", "rate", "premium", "coverage_level")
            )
        ),
    ),
    "m13_loaded_scores": Check(
        _loaded_scores,
        on_policy(f"SELECT x0, n_rows, score, 0e0 AS apart, 1 AS version FROM ({TREE_LEAVES})", SIDES),
        digits(9, "score", "apart"),
    ),
    "m15_batch_values": Check(_batch_values, on_policy(BATCH_SQL, SIDES), digits(6, "prob_total"), ["ref_month"]),
}
