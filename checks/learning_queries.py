"""Preparation, models, tuning, run log and scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.report_queries import AS_OF, CUTOFF, FEATURED, scored, written_policies
from checks.spec import Check, digits
from checks.tables import on_policy, on_raw, policies, raw
from fieldmark.ml import models, preparation
from fieldmark.plans import dataset
from fieldmark.plans.schema import REF
from fieldmark.session import SCRATCH_CODEC, discard, scratch_path
from fieldmark.sources import writers

LABEL = dataset.LABEL


def prepared(spark, sf):
    """Train and test parts with features, read back from a written table, and the fit.

    Then the policies and feature tables they are made of, for rows to be scored.
    """
    held = written_policies(spark, sf, FEATURED)
    tables = dataset.lookup_tables(held, scratch_path(spark, "features"))
    # The split needs no features, so the lookups are made once, for the write.
    spine = dataset.stratified_split(dataset.training_spine(held, AS_OF, CUTOFF), LABEL, ["policy_id", REF])
    marked = dataset.with_features(spine, {name: dataset.in_time(table, CUTOFF) for name, table in tables.items()})
    path = scratch_path(spark, "training")
    columns = ["policy_id", REF, LABEL, "is_test", *preparation.ALL_FEATURES]
    writers.overwrite(marked.select(*columns), path, compression=SCRATCH_CODEC)
    table = spark.read.parquet(path)
    train, test = table.filter(~F.col("is_test")), table.filter("is_test")
    fitted = preparation.fit(
        train, [*preparation.HISTORY, *preparation.CONTRACT], preparation.CATEGORIES, preparation.CYCLIC
    )
    return train, test, fitted, held, tables


def parts(spark, sf):
    """Train and test parts and the fit, for queries that score no other rows: what they were made of goes."""
    train, test, fitted, *sources = prepared(spark, sf)
    if sources:
        held, tables = sources
        discard(held, *tables.values())
    return train, test, fitted


def _model(name):
    def build(spark, sf):
        train, test, fitted = parts(spark, sf)
        model = models.fit_model(name, fitted.transform(train), LABEL)
        return models.evaluate(model, fitted.transform(train), fitted.transform(test), LABEL, name)

    return build


def _compared(spark, sf):
    train, test, fitted = parts(spark, sf)
    outcome = models.compare(fitted.transform(train), fitted.transform(test), LABEL)
    return outcome.metrics.withColumn("is_champion", F.col("model") == outcome.champion)


def _tuned(spark, sf):
    train, _, fitted = parts(spark, sf)
    vectors = fitted.transform(train)
    model, chosen, score = models.tune("decision_tree", vectors, LABEL, folds=3)
    path = scratch_path(spark, "runs")
    models.log_run(spark, path, "decision_tree", chosen, {"grid_best_cv_auc_roc": score})
    return models.best_parameters(spark.read.parquet(path), list(chosen))


def _importances(spark, sf):
    train, _, fitted = parts(spark, sf)
    model = models.fit_model("decision_tree", fitted.transform(train), LABEL)
    return models.feature_importances(model, fitted, spark)


def _saved(spark, sf):
    """Scores of the out-of-time policies by a model that was saved and loaded again."""
    train, _, fitted, *sources = prepared(spark, sf)
    model = models.fit_model("decision_tree", fitted.transform(train), LABEL)
    path = scratch_path(spark, "models")
    models.save_model(spark, path, "decision_tree", model, fitted)
    name, version, loaded, prep = models.load_model(spark, path)
    late = dataset.scoring_set(sources[0], CUTOFF, sources[1])
    return models.score_batch(late, prep, loaded, name, version)


def _batch_scores(spark, sf):
    """Out-of-time policies scored and written by model; counts per month and class."""
    train, _, fitted, *sources = prepared(spark, sf)
    model = models.fit_model("decision_tree", fitted.transform(train), LABEL)
    late = dataset.scoring_set(sources[0], CUTOFF, sources[1])
    path = scratch_path(spark, "scores")
    writers.overwrite(models.score_batch(late, fitted, model, "decision_tree", 1), path, ["model_name"])
    return spark.read.parquet(path).groupBy(REF, "model_name", "model_version", "label").agg(F.count("*").alias("n_rows"))


def _predictions_written(spark, sf):
    path = scratch_path(spark, "predictions")
    writers.overwrite(models.predictions(scored(spark, sf).withColumn("score", F.col("score") / 3), "probe", 1), path, ["model_name"])
    return spark.read.parquet(path).groupBy("model_name", "label").agg(F.count("*").alias("n_rows"))


def _runs(spark, sf):
    """A run log with one run per region: its claim rate and volume."""
    held = policies(spark, sf, ["region", "claim", "start_date"])
    per = held.groupBy("region").agg(
        F.avg("claim").alias("claim_rate"), F.count("*").cast("double").alias("policies"),
        F.max(F.unix_date("start_date")).cast("double").alias("started_at"),
    )
    long = per.unpivot(["region", "started_at"], ["claim_rate", "policies"], "name", "value")
    status = F.when(F.col("region") == "EUROPE", "RUNNING").otherwise("FINISHED")
    return long.select(
        F.col("region").alias("run_id"), F.col("region").alias("run_name"), status.alias("status"), "started_at",
        F.when(F.col("name") == "policies", "param").otherwise("metric").alias("kind"), "name",
        F.col("value").cast("string").alias("value"),
    )


def _latest(spark, sf):
    path = scratch_path(spark, "runs")
    _runs(spark, sf).write.mode("append").parquet(path)
    last = models.latest_run(spark.read.schema(models.RUN_SCHEMA).parquet(path))
    return last.select("run_id", "name", F.col("value").cast("double").alias("value"))


def _best(spark, sf):
    runs = _runs(spark, sf)
    return models.best_parameters(runs, ["policies"], "claim_rate").withColumn("value", F.col("value").cast("double"))


RUN_SQL = """runs AS (
SELECT region AS run_id, avg(claim) AS claim_rate, count(*) * 1e0 AS policies, max(start_date) AS started_at
FROM policy WHERE region <> 'EUROPE' GROUP BY 1),
latest AS (SELECT * FROM runs ORDER BY started_at DESC, run_id DESC LIMIT 1)"""

WITH_GAPS = ["rate_value", "indemnity_value"]


def _imputed(spark, sf):
    held = raw(spark, sf, ["policy_no", *WITH_GAPS])
    return preparation.impute(held, preparation.fit_medians(held, WITH_GAPS))


def _moded(spark, sf):
    held = raw(spark, sf, ["policy_no", "place_code", "head_text"])
    return preparation.impute(held, {}, preparation.fit_modes(held, ["place_code", "head_text"]))


def _encoded(spark, sf):
    held = policies(spark, sf, ["policy_id", "insurer", "crop", "region"])
    known = held.filter(F.col("region") != "ASIA").filter(F.col("crop") != "Brand#7")
    categories = preparation.fit_categories(known, ["insurer", "crop", "region"])
    return preparation.encode(held, categories, ["insurer", "crop", "region"])


def _scaled(spark, sf):
    columns = ["rate", "sum_insured", "area_ha"]
    held = policies(spark, sf, ["policy_id", *columns])
    return preparation.scale(held, preparation.fit_scale(held, columns))


def _assembled(spark, sf):
    from pyspark.ml.functions import vector_to_array

    train, _, fitted = parts(spark, sf)
    return fitted.transform(train).groupBy(F.size(vector_to_array("features")).alias("n_features")).count()


def _code(column: str, cond: str) -> str:
    return f"c_{column} AS (SELECT {column}, dense_rank() OVER (ORDER BY {column}) - 1 AS code FROM (SELECT DISTINCT {column} FROM policy WHERE {cond}))"


KNOWN = "region <> 'ASIA' AND crop <> 'Brand#7'"

CHECKS = {
    "m1_median_imputation": Check(
        _imputed,
        on_raw(
            "SELECT policy_no, coalesce(rate_value, (SELECT quantile_cont(rate_value, 0.5) FROM raw)) AS rate_value,"
            " coalesce(indemnity_value, (SELECT quantile_cont(indemnity_value, 0.5) FROM raw)) AS indemnity_value FROM raw"
        ),
        digits(5, "rate_value", "indemnity_value"),
    ),
    "m2_mode_imputation": Check(
        _moded,
        on_raw(
            "SELECT policy_no, " + ", ".join(
                f"coalesce({c}, (SELECT {c} FROM raw WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS {c}"
                for c in ("place_code", "head_text")
            ) + " FROM raw"
        ),
    ),
    "m3_ordinal_encoding": Check(
        _encoded,
        on_policy(
            "SELECT policy_id, coalesce(a.code, -1) * 1e0 AS insurer, coalesce(b.code, -1) * 1e0 AS crop,"
            " coalesce(c.code, -1) * 1e0 AS region FROM policy p LEFT JOIN c_insurer a ON a.insurer = p.insurer"
            " LEFT JOIN c_crop b ON b.crop = p.crop LEFT JOIN c_region c ON c.region = p.region",
            _code("insurer", KNOWN), _code("crop", KNOWN), _code("region", KNOWN),
        ),
    ),
    "m4_assembled_features": Check(_assembled),
    "m5_standard_scaling": Check(
        _scaled,
        on_policy(
            "SELECT policy_id, " + ", ".join(
                f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in ("rate", "sum_insured", "area_ha")
            ) + " FROM policy"
        ),
        digits(7, "rate", "sum_insured", "area_ha"),
    ),
    "m6_decision_tree": Check(_model("decision_tree")),
    "m7_random_forest": Check(_model("random_forest")),
    "m8_adaboost": Check(_model("adaboost")),
    "m9_gradient_boosting": Check(_model("gradient_boosting")),
    "m10_model_comparison": Check(_compared),
    "m11_grid_search": Check(_tuned),
    "m12_feature_importances": Check(_importances),
    "m13_saved_model_scores": Check(_saved, dates=["ref_month"]),
    "m15_batch_scoring": Check(
        _batch_scores,
        on_policy(
            "SELECT CAST(date_trunc('month', start_date) AS DATE) AS ref_month, 'decision_tree' AS model_name,"
            f" 1 AS model_version, label, count(*) AS n_rows FROM policy CROSS JOIN (SELECT unnest([0, 1]) AS label)"
            f" WHERE start_date >= DATE '{CUTOFF}' GROUP BY 1, 4"
        ),
        dates=["ref_month"],
    ),
    "p33_score_columns": Check(
        lambda spark, sf: models.predictions(scored(spark, sf), "probe", 7).filter("label = 1").drop("label"),
        on_policy(
            """SELECT CAST(date_trunc('month', start_date) AS DATE) AS ref_month, 'probe' AS model_name, 7 AS model_version,
  policy_id, floor((sum_insured / 110000e0 + claim * area_ha / 500e0) * 10000) / 10000e0 AS prob_label FROM policy"""
        ),
        digits(6, "prob_label"),
        ["ref_month"],
    ),
    "m14_latest_run": Check(
        _latest,
        on_policy(
            "SELECT run_id, 'claim_rate' AS name, claim_rate AS value FROM latest"
            " UNION ALL SELECT run_id, 'policies', policies FROM latest", RUN_SQL,
        ),
        digits(10, "value"),
    ),
    "e10_best_parameters": Check(
        _best,
        on_policy("SELECT 'policies' AS name, policies AS value, claim_rate AS cv_auc_roc FROM latest", RUN_SQL),
        digits(10, "value", "cv_auc_roc"),
    ),
    "p32_long_by_class": Check(
        lambda spark, sf: models.predictions(scored(spark, sf), "probe", 1),
        on_policy(
            """SELECT CAST(date_trunc('month', start_date) AS DATE) AS ref_month, 'probe' AS model_name, 1 AS model_version,
  policy_id, label, CASE WHEN label = 1 THEN score ELSE 1 - score END AS prob_label
FROM (SELECT start_date, policy_id,
  floor((sum_insured / 110000e0 + claim * area_ha / 500e0) * 10000) / 10000e0 AS score FROM policy)
CROSS JOIN (SELECT unnest([0, 1]) AS label)"""
        ),
        digits(6, "prob_label"),
        ["ref_month"],
    ),
    "s9_predictions_by_model": Check(
        _predictions_written,
        on_policy(
            "SELECT 'probe' AS model_name, label, count(*) AS n_rows FROM policy CROSS JOIN (SELECT unnest([0, 1]) AS label) GROUP BY 1, 2"
        ),
    ),
}
