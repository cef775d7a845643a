"""What fits hold in their blocks and how many run at once."""

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector

from fieldmark.ml import boosting, models


def test_blocks_hold_bin_and_label_by_feature():
    values = pa.array([[0.0, 5.0], [2.0, 7.0], [1.0, 9.0]], pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([values, pa.array([1, 0, 1])], names=["values", "label"])
    block = next(boosting._binned([np.array([0.5]), np.array([6.0, 8.0])])([batch]))
    row = block.to_pylist()[0]
    assert np.frombuffer(row["cells"], np.uint8).reshape(2, 3).tolist() == [[1, 2, 3], [1, 2, 5]]
    made = next(boosting._weight_sums([], 2, 3, 0.0)([block]))
    sums = np.array(made.column(1)).reshape(2, 3, 2)
    assert sums.tolist() == [[[0, 1], [1, 1], [0, 0]], [[0, 1], [1, 0], [0, 1]]]


def test_fits_on_many_rows_run_one_by_one(spark, monkeypatch):
    rng = np.random.default_rng(5)
    data = [(int(a + b > 1), [float(a), float(b)]) for a, b in rng.random((200, 2))]
    rows = spark.createDataFrame(data, "y int, a array<double>").select("y", array_to_vector("a").alias("features"))
    asked = []
    real = models.side_by_side
    monkeypatch.setattr(models, "side_by_side", lambda jobs, n: asked.append(n) or real(jobs, n))
    grid = {"maxDepth": [1, 2]}
    few = {r.point: r.cv_auc_roc for r in models.grid_scores("decision_tree", rows, "y", grid, folds=2).collect()}
    monkeypatch.setattr(models, "MANY_ROWS", 100)
    many = {r.point: r.cv_auc_roc for r in models.grid_scores("decision_tree", rows, "y", grid, folds=2).collect()}
    assert asked == [4, 1] and few == many and len(few) == 2


def test_a_forest_keeps_its_node_ids_unless_there_are_many(spark, monkeypatch):
    rng = np.random.default_rng(7)
    data = [(int(a + b > 1), [float(a), float(b)]) for a, b in rng.random((300, 2))]
    rows = spark.createDataFrame(data, "y int, a array<double>").select("y", array_to_vector("a").alias("features"))

    def fitted():
        return models.fit_model("random_forest", rows, "y", numTrees=5, minInstancesPerNode=2)

    few = fitted()
    monkeypatch.setattr(models, "MANY_NODE_IDS", 300 * 5)
    many = fitted()
    assert few.getOrDefault("cacheNodeIds") and not many.getOrDefault("cacheNodeIds")
    trees = [m.toDebugString.split("\n", 1)[1] for m in (few, many)]
    assert trees[0] == trees[1] and trees[0].count("Tree ") == 5


def test_one_deep_tree_serves_all_depths_of_a_grid(spark, monkeypatch):
    rng = np.random.default_rng(11)
    data = [(int(a + b + c / 3 > 1.1), [float(a), float(b)]) for a, b, c in rng.random((600, 3))]
    rows = spark.createDataFrame(data, "y int, a array<double>").select("y", array_to_vector("a").alias("features"))
    deep = models.fit_model("decision_tree", rows, "y", maxDepth=6, minInstancesPerNode=3)
    for depth in range(1, 7):
        own = models.fit_model("decision_tree", rows, "y", maxDepth=depth, minInstancesPerNode=3)
        cut = models.first_trees(deep, depth)
        assert cut.toDebugString.split("\n", 1)[1] == own.toDebugString.split("\n", 1)[1]
        assert list(cut.featureImportances.toArray()) == list(own.featureImportances.toArray())
        scores = [[r.score for r in models.with_score(m, rows).select("score").collect()] for m in (cut, own)]
        assert scores[0] == scores[1]

    fits, fit = [], models.fit_weighted
    monkeypatch.setattr(models, "fit_weighted", lambda *given, **settings: fits.append(settings) or fit(*given, **settings))
    grid = {"maxDepth": [2, 4], "minInstancesPerNode": [3, 9]}
    found = {r.point: r.cv_auc_roc for r in models.grid_scores("decision_tree", rows, "y", grid, folds=2).collect()}
    assert len(fits) == 4 and all(settings["maxDepth"] == 4 for settings in fits)
    monkeypatch.setattr(models, "PREFIXES", {})
    assert found == {r.point: r.cv_auc_roc for r in models.grid_scores("decision_tree", rows, "y", grid, folds=2).collect()}
    assert len(fits) == 12 and len(found) == 4
