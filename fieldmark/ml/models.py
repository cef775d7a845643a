"""Classifiers, comparison, tuning, persistence, run log and batch scoring."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import product

from pyspark.ml.classification import (
    DecisionTreeClassificationModel,
    DecisionTreeClassifier,
    GBTClassificationModel,
    GBTClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldmark.ml.boosting import BoostedStumps, fit_boosted_stumps
from fieldmark.ml.importance import importances
from fieldmark.ml.preparation import Preparation
from fieldmark.operators.ranking import all_metrics, curve_metrics, running_counts
from fieldmark.plans.schema import REF
from fieldmark.session import scratch_path, written
from fieldmark.sources import writers

WEIGHT = "class_weight"
SEED = 42
#: Rows from which fits run one after the other: each then has work for all cores, and holds a copy of its rows binned.
MANY_ROWS = 5_000_000
#: Node ids (rows times trees, four bytes each) from which a forest walks its trees from the root at every level instead.
MANY_NODE_IDS = 1_000_000_000

# Settings of the untuned models and the grids searched.
SETTINGS = {
    "decision_tree": {"maxDepth": 8, "minInstancesPerNode": 50},
    "random_forest": {"numTrees": 200, "maxDepth": 8, "minInstancesPerNode": 30},
    "adaboost": {"rounds": 100, "rate": 0.1},
    "gradient_boosting": {"maxIter": 200, "stepSize": 0.1, "maxDepth": 6},
}
GRIDS = {
    "decision_tree": {"maxDepth": [4, 6, 8], "minInstancesPerNode": [20, 50, 100]},
    "random_forest": {
        "numTrees": [150, 200, 250], "maxDepth": [6, 8, 10, 12], "minInstancesPerNode": [10, 20, 30],
    },
    "adaboost": {"rounds": [50, 100, 200], "rate": [0.03, 0.1, 0.3]},
    "gradient_boosting": {"maxIter": [150, 250], "maxDepth": [4, 6, 8], "stepSize": [0.05, 0.1]},
}
# The setting along which one fit holds all smaller ones: its first levels, trees or rounds are the smaller model.
PREFIXES = {
    "decision_tree": "maxDepth", "random_forest": "numTrees", "adaboost": "rounds", "gradient_boosting": "maxIter",
}
ESTIMATORS = {
    "decision_tree": DecisionTreeClassifier,
    "random_forest": RandomForestClassifier,
    "gradient_boosting": GBTClassifier,
}
LOADERS = {
    "decision_tree": DecisionTreeClassificationModel,
    "random_forest": RandomForestClassificationModel,
    "gradient_boosting": GBTClassificationModel,
}


def with_class_weight(df: DataFrame, label: str, name: str) -> DataFrame:
    """Row weights: balanced classes for trees and forests, weighted positives for boosting.

    AdaBoost weighs rows itself.  The class counts come from one aggregate.
    """
    counts = {row[label]: row["n"] for row in df.groupBy(label).agg(F.count("*").alias("n")).limit(3).collect()}
    negatives, positives = counts.get(0, 0), counts.get(1, 0)
    if not negatives or not positives:
        raise ValueError(f"{label} needs rows of both classes, got {counts}")
    if name in ("decision_tree", "random_forest"):
        total = negatives + positives
        light, heavy = total / (2 * negatives), total / (2 * positives)
    elif name == "gradient_boosting":
        light, heavy = 1.0, negatives / positives
    else:
        light = heavy = 1.0
    return df.withColumn(WEIGHT, F.when(F.col(label) == 1, heavy).otherwise(light))


def estimator(name: str, label: str, **settings):
    if name not in ESTIMATORS:
        raise ValueError(f"unknown model {name!r}; choose one of {sorted(SETTINGS)}")
    return ESTIMATORS[name](
        featuresCol="features", labelCol=label, weightCol=WEIGHT, seed=SEED, **{**SETTINGS[name], **settings}
    )


def fit_model(name: str, df: DataFrame, label: str, **settings):
    """Fit one classifier on a prepared frame (``features`` vector and label)."""
    return fit_weighted(name, df if name == "adaboost" else with_class_weight(df, label, name), label, **settings)


def fit_weighted(name: str, df: DataFrame, label: str, **settings):
    """The same on a frame that already has row weights."""
    if name == "adaboost":
        return fit_boosted_stumps(df, label, **{**SETTINGS[name], **settings})
    made = estimator(name, label, **settings)
    if name == "random_forest":
        # The same trees: a row's node in every tree is kept from level to level, so that no level walks down to it again.
        made.setCacheNodeIds(df.count() * made.getNumTrees() < MANY_NODE_IDS)
    # The copy leaves the training summary behind: it holds the session, which
    # cannot be sent to the tasks that apply the model.
    return made.fit(df).copy()


def _first_levels(node, depth: int, package):
    """A fitted tree's node cut ``depth`` levels below it; leaves side by side that predict the same are one, as after a fit."""
    if node.subtreeDepth() == 0:
        return node
    stats = node.impurityStats()
    if depth == 0:
        return package.LeafNode(node.prediction(), node.impurity(), stats)
    left, right = (_first_levels(child, depth - 1, package) for child in (node.leftChild(), node.rightChild()))
    if left.subtreeDepth() == right.subtreeDepth() == 0 and left.prediction() == right.prediction():
        return package.LeafNode(left.prediction(), node.impurity(), stats)
    return package.InternalNode(node.prediction(), node.impurity(), node.gain(), left, right, node.split(), stats)


def first_trees(model, n: int):
    """The ensemble of a fitted one's first ``n`` trees or rounds; of a single tree, its first ``n`` levels.

    A tree grows level by level, so a shallower fit is its beginning.
    """
    if isinstance(model, BoostedStumps):
        return model.prefix(n)
    java = model._java_obj
    jvm = SparkSession.active().sparkContext._jvm
    if isinstance(model, DecisionTreeClassificationModel):
        root = _first_levels(java.rootNode(), n, jvm.org.apache.spark.ml.tree)
        made = jvm.org.apache.spark.ml.classification.DecisionTreeClassificationModel(
            java.uid(), root, java.numFeatures(), java.numClasses()
        )
        return DecisionTreeClassificationModel(java.copyValues(made, java.extractParamMap()))
    trees = java.trees()[:n]
    kind = "org.apache.spark.ml.regression.DecisionTreeRegressionModel"
    if isinstance(model, RandomForestClassificationModel):
        kind = "org.apache.spark.ml.classification.DecisionTreeClassificationModel"
    gateway = SparkSession.active().sparkContext._gateway
    held = gateway.new_array(_jvm_class(jvm, kind), len(trees))
    for k, tree in enumerate(trees):
        held[k] = tree
    package = jvm.org.apache.spark.ml.classification
    if isinstance(model, RandomForestClassificationModel):
        made = package.RandomForestClassificationModel(java.uid(), held, java.numFeatures(), java.numClasses())
        return RandomForestClassificationModel(java.copyValues(made, java.extractParamMap()))
    weights = gateway.new_array(gateway.jvm.double, len(trees))
    for k, weight in enumerate(java.treeWeights()[:n]):
        weights[k] = weight
    made = package.GBTClassificationModel(java.uid(), held, weights, java.numFeatures(), java.numClasses())
    return GBTClassificationModel(java.copyValues(made, java.extractParamMap()))


def _jvm_class(jvm, name: str):
    out = jvm
    for part in name.split("."):
        out = getattr(out, part)
    return out


def with_score(model, df: DataFrame, name: str = "score") -> DataFrame:
    """Adds ``score`` (or ``name``), the probability of the positive class."""
    if isinstance(model, BoostedStumps):
        scored = model.transform(df if name == "score" else df.drop("score"))
        return scored.withColumnRenamed("score", name)
    scored = model.transform(df)
    return scored.withColumn(name, vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def with_scores(models: Mapping[str, object], df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per row of ``df`` and model: the columns of ``keep``, ``model`` and ``score``.

    All models are applied in one pass over the rows.
    """
    out = df
    columns = {name: f"_score_{i}" for i, name in enumerate(models)}
    for name, model in models.items():
        out = with_score(model, out, columns[name])
    pairs = F.array(*[F.struct(F.lit(n).alias("model"), F.col(c).alias("score")) for n, c in columns.items()])
    return out.select(*keep, F.inline(pairs))


def feature_importances(model, preparation: Preparation, spark: SparkSession) -> DataFrame:
    names = preparation.features
    if isinstance(model, BoostedStumps):
        return importances(spark, names, model.importances(len(names)))
    return importances(spark, names, list(model.featureImportances.toArray()))


def evaluate_all(models: Mapping[str, object], train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """The six metrics of every model on both parts, one row per model and split.

    Every model is applied once to every row; label and scores are written once.
    """
    parts = [
        with_scores(models, df, [label]).withColumn("split", F.lit(split)) for split, df in (("train", train), ("test", test))
    ]
    scores = written(parts[0].unionByName(parts[1]), "scores")
    return all_metrics(scores, label, "score", ["model", "split"])


def evaluate(model, train: DataFrame, test: DataFrame, label: str, name: str) -> DataFrame:
    """The six metrics on both parts, one row per split."""
    return evaluate_all({name: model}, train, test, label)


def fits_at_once(rows: DataFrame, parallelism: int) -> int:
    """How many fits on the written ``rows`` are submitted together: so many copies are held (and spilled) at once."""
    return 1 if rows.count() >= MANY_ROWS else parallelism


def side_by_side(jobs: Mapping[str, Callable[[], object]], parallelism: int) -> dict[str, object]:
    """Results of independent Spark jobs that are submitted together."""
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(jobs)))) as pool:
        return dict(zip(jobs, pool.map(lambda job: job(), jobs.values())))


@dataclass(frozen=True)
class Comparison:
    models: dict[str, object]
    metrics: DataFrame  # one row per model and split
    champion: str


def compare(
    train: DataFrame, test: DataFrame, label: str, settings: Mapping[str, Mapping] | None = None,
    names: Sequence[str] = tuple(SETTINGS), parallelism: int = 4,
) -> Comparison:
    """Fit every model and keep the one with the best AUC on the test rows.

    The fits do not depend on each other and are submitted side by side unless there
    are many rows; the prepared rows are written first, since every fit reads them.
    """
    train, test = (written(df.select(label, "features"), "prepared") for df in (train, test))
    models = side_by_side(
        {n: lambda n=n: fit_model(n, train, label, **(settings or {}).get(n, {})) for n in names},
        fits_at_once(train, parallelism),
    )
    # Two rows per model; collected so that later steps do not score again.
    rows = evaluate_all(models, train, test, label).collect()
    metrics = train.sparkSession.createDataFrame(rows)
    best = max((r for r in rows if r["split"] == "test"), key=lambda r: (r["auc_roc"], r["model"]))
    return Comparison(models, metrics, best["model"])


def bounded_rows(df: DataFrame, label: str, most: int | None) -> DataFrame:
    """At most about ``most`` labelled rows, the same share of both classes, chosen by a hash of the row."""
    if most is None:
        return df
    held = df.agg(F.count(label)).first()[0]
    if held <= most:
        return df
    spot = F.pmod(F.xxhash64(F.lit(SEED), "features"), F.lit(1 << 30))
    return df.filter(spot < int((1 << 30) * (most / held)))


def grid_scores(
    name: str, train: DataFrame, label: str, grid: Mapping[str, Sequence] | None = None, folds: int = 3,
    parallelism: int = 4,
) -> DataFrame:
    """The cross-validated AUC of every point of the grid: ``point`` (JSON of its settings) and ``cv_auc_roc``.

    Folds are cut once.  Along the axis in ``PREFIXES`` one fit with the largest value serves all
    points, as its first levels, trees or rounds; so there are fits for the other axes only.  They are submitted
    side by side (one by one if there are many rows), each writes the scores of its held-out rows, and one pass computes every AUC.
    """
    grid = dict(grid or GRIDS[name])
    prefix = PREFIXES.get(name) if PREFIXES.get(name) in grid else None
    lengths = sorted(grid.pop(prefix)) if prefix else [None]
    weighted = with_class_weight(train.select(label, "features"), label, name)
    fold = F.pmod(F.xxhash64(F.lit(SEED), "features"), F.lit(folds)).cast("int")
    cut = written(weighted.withColumn("_fold", fold), "folds")
    folder = scratch_path(train.sparkSession, "grid")

    def job(number: int, settings: dict, k: int) -> None:
        longest = {**settings, prefix: lengths[-1]} if prefix else settings
        model = fit_weighted(name, cut.filter(F.col("_fold") != k), label, **longest)
        points = {
            json.dumps({**settings, **({prefix: n} if prefix else {})}, sort_keys=True): first_trees(model, n) if n else model
            for n in lengths
        }
        scored = with_scores(points, cut.filter(F.col("_fold") == k), [label, F.lit(k).alias("fold")])
        # A folder each: jobs that write at the same time would clear each other's unfinished files.
        scored.withColumnRenamed("model", "point").write.parquet(f"{folder}/{number}")

    combos = [(dict(zip(grid, values)), k) for values in product(*grid.values()) for k in range(folds)]
    side_by_side({i: lambda i=i, c=c: job(i, *c) for i, c in enumerate(combos)}, fits_at_once(cut, parallelism))
    scores = train.sparkSession.read.parquet(*[f"{folder}/{i}" for i in range(len(combos))])
    by_fold = curve_metrics(running_counts(scores, label, "score", ["point", "fold"]), ["point", "fold"])
    return by_fold.groupBy("point").agg(F.avg("auc_roc").alias("cv_auc_roc"))


def tune(
    name: str, train: DataFrame, label: str, grid: Mapping[str, Sequence] | None = None, folds: int = 3,
    parallelism: int = 4,
) -> tuple[object, dict, float]:
    """Grid search by cross-validated AUC; returns the refitted model, its settings and score."""
    # As many rows as the grid has points.
    rows = grid_scores(name, train, label, grid, folds, parallelism).collect()
    best = max(rows, key=lambda r: (r["cv_auc_roc"] or 0.0, r["point"]))
    chosen = json.loads(best["point"])
    return fit_model(name, train, label, **chosen), chosen, best["cv_auc_roc"]


def save_model(spark: SparkSession, path: str, name: str, model, preparation: Preparation) -> int:
    """Write the next version: preparation and model first, then the info that completes it."""
    number = (writers.latest_version(spark, path, marker=writers.INFO_MARKER) or 0) + 1
    folder = writers.version_path(path, number)
    preparation.save(f"{folder}/preparation")
    if isinstance(model, BoostedStumps):
        model.save(spark, f"{folder}/model")
    else:
        model.write().overwrite().save(f"{folder}/model")
    info = spark.createDataFrame([(name, number)], "model_name string, model_version int")
    info.write.mode("overwrite").parquet(f"{folder}/info")
    return number


def load_model(spark: SparkSession, path: str, version: int | str = "latest"):
    """(name, version, model, preparation) of the given or the newest complete version."""
    number = writers.latest_version(spark, path, version, marker=writers.INFO_MARKER)
    if number is None:
        raise ValueError(f"no saved model below {path}")
    folder = writers.version_path(path, number)
    name = spark.read.parquet(f"{folder}/info").first()["model_name"]
    if name == "adaboost":
        model = BoostedStumps.load(spark, f"{folder}/model")
    else:
        model = LOADERS[name].load(f"{folder}/model")
    return name, number, model, Preparation.load(spark, f"{folder}/preparation")


def predictions(scored: DataFrame, model_name: str, version: int, score: str = "score") -> DataFrame:
    """Two rows per policy: the probability of each class."""
    named = scored.select(
        REF,
        F.lit(model_name).alias("model_name"),
        F.lit(version).alias("model_version"),
        "policy_id",
        (F.lit(1.0) - F.col(score)).alias("0"),
        F.col(score).alias("1"),
    )
    ids = [REF, "model_name", "model_version", "policy_id"]
    return named.unpivot(ids, ["0", "1"], "label", "prob_label").withColumn("label", F.col("label").cast("int"))


def score_batch(df: DataFrame, preparation: Preparation, model, model_name: str, version: int) -> DataFrame:
    return predictions(with_score(model, preparation.transform(df)), model_name, version)


RUN_SCHEMA = "run_id string, run_name string, status string, started_at double, kind string, name string, value string"


def log_run(
    spark: SparkSession, path: str, run_name: str, params: Mapping[str, object], metrics: Mapping[str, float],
    started_at: float | None = None, status: str = "FINISHED", clock: Callable[[], float] = time.time,
) -> str:
    """Append a run's parameters and metrics as rows."""
    run_id = uuid.uuid4().hex
    head = (run_id, run_name, status, float(clock() if started_at is None else started_at))
    rows = [(*head, "param", k, str(v)) for k, v in params.items()]
    rows += [(*head, "metric", k, repr(float(v))) for k, v in metrics.items()]
    spark.createDataFrame(rows, RUN_SCHEMA).write.mode("append").parquet(path)
    return run_id


def latest_run(runs: DataFrame) -> DataFrame:
    """All rows of the finished run that started last."""
    finished = runs.filter(F.col("status") == "FINISHED")
    newest = finished.agg(F.max_by("run_id", F.struct("started_at", "run_id"))).scalar()
    return finished.filter(F.col("run_id") == newest)


def best_parameters(runs: DataFrame, names: Sequence[str], score: str = "grid_best_cv_auc_roc") -> DataFrame:
    """The listed parameters of the latest run next to its cross-validated score."""
    last = latest_run(runs)
    best = last.filter((F.col("kind") == "metric") & (F.col("name") == score)).agg(F.max("value")).scalar()
    params = last.filter((F.col("kind") == "param") & F.col("name").isin(*names))
    return params.select("name", "value", best.try_cast("double").alias("cv_auc_roc"))
