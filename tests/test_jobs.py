"""Landed files to scores, once through."""

import pytest
from pyspark.sql import functions as F

from checks import cleaning_queries as cq
from checks.tables import policies, raw
from fieldmark.ml import models
from fieldmark.plans import jobs, silver
from fieldmark.plans.schema import FEATURE_COLUMNS
from fieldmark.sources import writers

QUICK = {
    "decision_tree": {"maxDepth": 3}, "random_forest": {"numTrees": 3, "maxDepth": 3},
    "adaboost": {"rounds": 2}, "gradient_boosting": {"maxIter": 2, "maxDepth": 2},
}
GRIDS = {
    "decision_tree": {"maxDepth": [2, 3]}, "random_forest": {"numTrees": [3]},
    "adaboost": {"rounds": [2], "rate": [0.5]}, "gradient_boosting": {"maxIter": [2]},
}


def test_clean_and_split(spark, sf_dir, tmp_path):
    paths = jobs.Paths(str(tmp_path))
    source = raw(spark, sf_dir)
    source.write.parquet(paths.of("landed"))
    assert jobs.land(spark, paths.of("landed"), "parquet", source.schema, paths.of("raw")) == 6000
    landed = spark.read.parquet(paths.of("raw"))
    dims = silver.Dimensions(perils=cq.perils(spark, sf_dir), regions=cq.regions(spark, sf_dir))
    options = silver.Options(decimal_comma=["sum_insured"])
    # The second source brings nothing new, so deduplication leaves one of each keyed row.
    keyed = landed.filter(F.col("proposal_id").isNotNull())
    once = jobs.clean([keyed], dims, paths, options)
    assert jobs.clean([keyed, keyed], dims, paths, options) == once
    n_features, n_labels = jobs.split_gold(spark, paths)
    assert n_features == n_labels == once
    assert set(spark.read.parquet(paths.of("gold_features")).columns) <= set(FEATURE_COLUMNS)


def test_features_train_and_score(spark, sf_dir, tmp_path):
    paths = jobs.Paths(str(tmp_path))
    policies(spark, sf_dir).write.parquet(paths.of("policies"))
    for name in jobs.REGISTRY:
        assert jobs.refresh_feature(spark, paths, name) == 1
    # Merging the same table again changes nothing but the version.
    before = jobs.feature_tables(spark, paths)["rate_reference"].count()
    assert jobs.refresh_feature(spark, paths, "rate_reference") == 2
    assert jobs.feature_tables(spark, paths)["rate_reference"].count() == before
    jobs.check_features(spark, paths)
    trained = jobs.train(spark, paths, "2001-01-01", "2000-01-01", QUICK, GRIDS)
    assert trained.metrics.count() == 10 and trained.version == 1
    last = models.latest_run(spark.read.parquet(paths.of("runs")))
    assert last.filter("name = 'champion'").first()["value"] == trained.champion
    late = policies(spark, sf_dir, ["start_date"]).filter("start_date >= '2000-01-01'").count()
    assert jobs.score(spark, paths, "2000-01-01") == 2 * late
    scores = spark.read.parquet(paths.of("predictions"))
    sums = scores.agg(F.min("prob_label"), F.max("prob_label"), F.sum("prob_label")).first()
    assert 0 <= sums[0] <= sums[1] <= 1 and abs(sums[2] - late) < 1e-6


def test_cleaned_policies_make_features(spark, sf_dir, tmp_path):
    """The project's own output, unknown places and all, is what the feature tables are built on."""
    paths = jobs.Paths(str(tmp_path))
    cq._silver(spark, sf_dir).write.parquet(paths.of("policies"))
    assert spark.read.parquet(paths.of("policies")).filter("area_id IS NULL").count() > 0
    for name in ("place_history", "portfolio"):
        assert jobs.refresh_feature(spark, paths, name) == 1
        assert writers.read_latest(spark, paths.feature(name)).filter("area_id IS NULL").count() == 0


def test_training_refuses_outcomes(spark):
    from fieldmark.ml import preparation

    rows = spark.createDataFrame([(1.0, 1.0)], "rate double, has_claim double")
    with pytest.raises(ValueError, match="has_claim"):
        preparation.fit(rows, ["rate", "has_claim"], [], [])
