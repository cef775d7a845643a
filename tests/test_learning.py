import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from fieldmark.ml import models, preparation
from fieldmark.ml.boosting import fit_boosted_stumps
from fieldmark.plans import dataset

NUMERIC, CATEGORICAL, CYCLIC = ["a", "b"], ["c"], ["s"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(42)
    data = []
    for i in range(400):
        a = rng.random() if i % 3 else None
        b = rng.random()
        y = int((a or 0) + b + rng.gauss(0, 0.15) > 0.9)
        data.append((i, a, b, rng.choice(["x", "y", None, "y"]), math.sin(i), y))
    return spark.createDataFrame(data, "id int, a double, b double, c string, s double, y int").cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return preparation.fit(rows, NUMERIC, CATEGORICAL, CYCLIC)


def vectors(df):
    return [list(r[0]) for r in df.select(vector_to_array("features")).collect()]


def test_tree_preparation(spark, rows, fitted):
    out = vectors(fitted.transform(rows))
    assert {len(v) for v in out} == {4}
    assert not any(math.isnan(x) for v in out for x in v)
    unseen = fitted.transform(rows.withColumn("c", F.lit("never seen")))
    assert {v[2] for v in vectors(unseen)} == {-1.0}
    assert fitted.modes == {"c": "y"}


def test_linear_preparation(rows):
    linear = preparation.fit(rows, NUMERIC, CATEGORICAL, CYCLIC, linear=True)
    out = linear.columns(rows).agg(*[f(c) for c in linear.features for f in (F.avg, F.stddev_pop)]).first()
    assert list(out) == pytest.approx([0, 1] * 4, abs=1e-9)


def test_all_null_column_is_filled(spark):
    df = spark.createDataFrame([(None, "q"), (None, None)], "a double, c string")
    prep = preparation.fit(df, ["a"], ["c"], [])
    assert [tuple(r) for r in prep.columns(df).collect()] == [(0.0, 0.0), (0.0, 0.0)]


def test_ties_go_to_the_smaller_category(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "c string")
    assert preparation.fit_modes(df, ["c"]) == {"c": "a"}


@pytest.mark.parametrize("name", ["decision_tree", "random_forest", "gradient_boosting", "adaboost"])
def test_models_learn_save_and_load(spark, rows, fitted, tmp_path, name):
    small = {
        "decision_tree": {"minInstancesPerNode": 5}, "random_forest": {"numTrees": 5, "minInstancesPerNode": 5},
        "gradient_boosting": {"maxIter": 3, "maxDepth": 3}, "adaboost": {"rounds": 4, "rate": 1.0},
    }[name]
    train = fitted.transform(rows)
    model = models.fit_model(name, train, "y", **small)
    metrics = models.evaluate(model, train, train, "y", name).filter("split = 'train'").first()
    assert metrics.auc_roc > 0.7
    path = str(tmp_path / name)
    assert models.save_model(spark, path, name, model, fitted) == 1
    loaded_name, version, loaded, prep = models.load_model(spark, path)
    assert (loaded_name, version) == (name, 1)
    before = {r.id: r.score for r in models.with_score(model, train).collect()}
    after = {r.id: r.score for r in models.with_score(loaded, prep.transform(rows)).collect()}
    assert after == pytest.approx(before)
    shares = models.feature_importances(model, fitted, spark).agg(F.sum("share")).first()[0]
    assert shares == pytest.approx(1.0)
    with pytest.raises(ValueError):
        models.load_model(spark, path, "9")


def test_boosting_matches_hand_computation(spark):
    data = [(0.0, 0), (1.0, 0), (2.0, 1), (3.0, 0), (4.0, 1), (5.0, 1), (6.0, 1), (7.0, 1)]
    from pyspark.ml.feature import VectorAssembler

    df = VectorAssembler(inputCols=["v"], outputCol="features").transform(spark.createDataFrame(data, "v double, y int"))
    model = fit_boosted_stumps(df, "y", rounds=1, rate=1.0)
    stump = model.stumps[0]
    # One of eight rows is missed.
    assert stump.weight == pytest.approx(math.log(7))
    assert 1.0 < stump.threshold < 2.0 or 3.0 < stump.threshold < 4.0


def test_one_class_is_an_error(rows, fitted):
    with pytest.raises(ValueError, match="both classes"):
        models.fit_model("decision_tree", fitted.transform(rows.withColumn("y", F.lit(1))), "y")


def test_tuning_and_run_log(spark, rows, fitted, tmp_path):
    _, chosen, score = models.tune("decision_tree", fitted.transform(rows), "y", {"maxDepth": [1, 4]}, folds=2)
    assert chosen["maxDepth"] in (1, 4) and 0.5 < score <= 1
    path = str(tmp_path / "runs")
    models.log_run(spark, path, "old", {"maxDepth": 9}, {"grid_best_cv_auc_roc": 0.1}, started_at=1.0)
    run = models.log_run(spark, path, "new", chosen, {"grid_best_cv_auc_roc": score}, started_at=2.0)
    models.log_run(spark, path, "open", {"maxDepth": 7}, {}, started_at=3.0, status="RUNNING")
    runs = spark.read.parquet(path)
    assert {r.run_id for r in models.latest_run(runs).collect()} == {run}
    best = models.best_parameters(runs, ["maxDepth"]).collect()
    assert [(r.value, r.cv_auc_roc) for r in best] == [(str(chosen["maxDepth"]), pytest.approx(score))]


def test_tuning_boosted_stumps(rows, fitted):
    _, chosen, score = models.tune("adaboost", fitted.transform(rows), "y", {"rounds": [1], "rate": [0.5, 1.0]}, folds=2)
    assert chosen["rounds"] == 1 and score > 0.5


def test_comparison_picks_best_on_test(spark, rows, fitted):
    train, test = (fitted.transform(rows.filter(F.col("id") % 4 != 0)), fitted.transform(rows.filter(F.col("id") % 4 == 0)))
    settings = {"decision_tree": {"maxDepth": 2}, "adaboost": {"rounds": 1}}
    outcome = models.compare(train, test, "y", settings, names=("decision_tree", "adaboost"))
    scores = {r.model: r.auc_roc for r in outcome.metrics.filter("split = 'test'").collect()}
    assert outcome.champion == max(scores, key=scores.get)


def test_registered_queries_learn_from_all_features(spark, sf_dir):
    from checks.learning_queries import CHECKS

    got = CHECKS["m4_assembled_features"].query(spark, sf_dir).collect()
    assert [r.n_features for r in got] == [len(preparation.ALL_FEATURES)] == [55]


def test_registered_queries_fit_the_librarys_settings(spark, sf_dir, monkeypatch):
    from checks import learning_queries

    class Done(Exception):
        pass

    def stop(*given, **settings):
        seen.append((given, settings))
        raise Done

    class Unfitted:
        transform = staticmethod(lambda df: df)

    monkeypatch.setattr(learning_queries, "prepared", lambda spark, sf: (None, None, Unfitted))
    seen = []
    for name in ("fit_model", "compare", "tune"):
        monkeypatch.setattr(models, name, stop)
    for key in ("m6_decision_tree", "m7_random_forest", "m8_adaboost", "m9_gradient_boosting", "m10_model_comparison",
                "m11_grid_search", "m12_feature_importances", "m13_saved_model_scores", "m15_batch_scoring"):
        with pytest.raises(Done):
            learning_queries.CHECKS[key].query(spark, sf_dir)
    assert len(seen) == 9
    assert not any(isinstance(v, dict) for given, _ in seen for v in given)
    assert all(set(settings) <= {"folds"} for _, settings in seen)


@pytest.mark.parametrize("key", ["m13_saved_model_scores", "m15_batch_scoring"])
def test_training_and_scoring_read_the_same_written_tables(spark, sf_dir, monkeypatch, key):
    from checks import learning_queries

    written = []
    for module, name in ((learning_queries, "written_policies"), (dataset, "written_feature_tables")):
        made = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *given, made=made, name=name, **named: written.append(name) or made(*given, **named))
    assert learning_queries.CHECKS[key].query(spark, sf_dir).count() > 0
    assert sorted(written) == ["written_feature_tables", "written_policies"]


def test_lookup_query_reads_written_feature_tables(spark, sf_dir, monkeypatch):
    from checks import report_queries

    looked = []
    real = dataset.lookup
    monkeypatch.setattr(dataset, "lookup", lambda spine, tables, keys: looked.append(tables) or real(spine, tables, keys))
    report_queries.CHECKS["j9_feature_lookup"].query(spark, sf_dir)
    assert looked and all(table.inputFiles() and "features-" in table.inputFiles()[0] for table in looked[0].values())
