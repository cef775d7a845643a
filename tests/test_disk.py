"""What stays on disk while queries run: shuffle files, scratch tables, tables made side by side."""

import os
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from checks import learning_queries, wider_queries
from checks.tables import policies
from fieldmark import session
from fieldmark.plans import dataset
from fieldmark.plans.schema import REF


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(k).getName() for k in range(files.size())]
    return {name for name in names if name.startswith("shuffle_")}


def scratch_folders(spark):
    root = session.scratch_path(spark, "x").rsplit("/", 1)[0]
    return {name for name in os.listdir(root.removeprefix("file:")) if not name.startswith(".")}


@pytest.fixture
def limit(spark):
    name = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(name)
    yield lambda value: spark.conf.set(name, value)
    spark.conf.set(name, before)


def test_writes_of_several_threads_leave_the_setting_as_it_was(spark):
    setting = spark.conf.get(session.DROP_SHUFFLES, None)
    frames = [spark.range(1000).groupBy((F.col("id") % k).alias("k")).count() for k in (5, 7, 9)]
    with ThreadPoolExecutor(3) as pool:
        made = list(pool.map(lambda df: session.written(df, "counts"), frames))
    assert [df.count() for df in made] == [5, 7, 9]
    assert spark.conf.get(session.DROP_SHUFFLES, None) == setting


def test_a_write_drops_its_own_shuffle_files(spark):
    held = spark.range(1000).groupBy((F.col("id") % 5).alias("k")).count()
    before = shuffle_files(spark)
    session.written(held, "counts")
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    # The frame is still there, so its files would be too.
    assert not shuffle_files(spark) - before and held.count() == 5


def test_only_scratch_tables_are_discarded(spark, tmp_path):
    made = session.written(spark.range(3), "gone")
    spark.range(4).write.parquet(str(tmp_path / "kept"))
    kept = spark.read.parquet(str(tmp_path / "kept"))
    folder = made.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file://")
    assert os.path.isdir(folder)
    session.discard(made, kept)
    assert not os.path.isdir(folder) and kept.count() == 4


def test_tables_of_few_values_are_broadcast_whatever_sparks_limit(spark, limit, monkeypatch):
    spine = spark.range(20).select(F.col("id").cast("string").alias("policy_id"), (F.col("id") % 7).alias("k"))
    table = session.written(spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x")), "few")

    def plan():
        return dataset.lookup(spine, {"t": table}, {"t": ("k",)})._jdf.queryExecution().executedPlan().toString()

    limit("10")
    assert "BroadcastHashJoin" in plan()
    monkeypatch.setattr(session, "SMALL_VALUES", 9)
    assert "SortMergeJoin" in plan()
    monkeypatch.undo()
    limit("-1")
    assert "SortMergeJoin" in plan()


def test_many_large_tables_are_looked_up_one_after_the_other(spark, limit):
    rows = [(1, "a", 1), (1, "a", 1), (2, None, 2), (None, "b", 3), (3, "c", None)]
    spine = spark.createDataFrame(rows, "i int, s string, j int")
    tables = {
        "wide": spark.createDataFrame([(1, 10, 11, 12), (3, 30, 31, 32)], "i int, w0 int, w1 int, w2 int"),
        "mid": spark.createDataFrame([("a", 5, 6), ("b", 7, None)], "s string, m0 int, m1 int"),
        "thin": spark.createDataFrame([(1, 100), (2, 200), (4, 400)], "j int, t0 int"),
    }
    keys = {"wide": ("i",), "mid": ("s",), "thin": ("j",)}
    want = sorted(
        [(1, "a", 1, 10, 11, 12, 5, 6, 100)] * 2
        + [(2, None, 2, None, None, None, None, None, 200), (None, "b", 3, None, None, None, 7, None, None),
           (3, "c", None, 30, 31, 32, None, None, None)],
        key=repr,
    )
    limit("-1")
    before = scratch_folders(spark)
    found = dataset.lookup(spine, tables, keys)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and "w0" in plan
    # Of what the rows had found before the last join, only the last state is kept.
    assert len(scratch_folders(spark) - before) == 1
    assert sorted(map(tuple, found.collect()), key=repr) == want


def test_feature_tables_of_many_policies_are_made_one_by_one(spark, sf_dir, tmp_path, monkeypatch):
    held = session.written(policies(spark, sf_dir), "policies")
    asked = []
    monkeypatch.setattr(dataset, "ThreadPoolExecutor", lambda max_workers: asked.append(max_workers) or ThreadPoolExecutor(max_workers))
    names = ("insurer_risk", "rate_reference")
    few = dataset.written_feature_tables(held, str(tmp_path / "few"), names, by_month=False)
    monkeypatch.setattr(dataset, "MANY_BYTES", 1)
    many = dataset.written_feature_tables(held, str(tmp_path / "many"), names, by_month=False)
    assert asked == [2, 1]
    assert all(few[n].count() == many[n].count() > 0 for n in names)


def test_what_training_rows_are_made_of_goes(spark, sf_dir):
    before = scratch_folders(spark)
    train, test, fitted = learning_queries.parts(spark, sf_dir)
    new = {name.rsplit("-", 1)[0]: name for name in scratch_folders(spark) - before}
    assert "training" in new and "policies" not in new
    root = session.scratch_path(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    assert not os.listdir(f"{root}/{new['features']}")
    assert fitted.transform(train).count() > 0 and test.filter(F.col(REF).isNull()).count() == 0

    before = scratch_folders(spark)
    assert wider_queries._training(spark, sf_dir).count() > 0
    assert "policies" not in {name.rsplit("-", 1)[0] for name in scratch_folders(spark) - before}
