"""Months-only refresh, counted writes, versions, lookups by key, files below titles, boosting's constant plan."""

import datetime as dt
import os

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from checks.tables import policies
from fieldmark.ml import boosting, models
from fieldmark.plans import dataset, jobs
from fieldmark.plans.schema import REF
from fieldmark.sources import readers, writers


def files_of(folder):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(folder) for f in fs if f.endswith(".parquet")}


def shaped(df):
    return sorted(
        (tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()), key=repr
    )


@pytest.mark.parametrize("name", ["place_history", "market_risk", "portfolio"])
def test_only_affected_months_are_rebuilt(spark, sf_dir, tmp_path, name):
    before = policies(spark, sf_dir).filter("area_id < 40")
    paths, fresh = jobs.Paths(str(tmp_path / "kept")), jobs.Paths(str(tmp_path / "fresh"))
    before.write.parquet(paths.of("policies"))
    assert jobs.refresh(spark, paths, name).rows > 0
    # Late policies change their outcome, one goes, one is new in a month of its own.
    late = F.col("start_date") >= F.lit("1997-06-01").cast("date")
    gone = before.filter(late).agg(F.max("policy_id")).first()[0]
    new = before.filter(late).limit(1).withColumns(
        {"start_date": F.lit("2003-05-07").cast("date"), "end_date": F.lit("2003-08-01").cast("date"), "policy_id": F.lit(-1).cast("bigint")}
    )
    after = before.filter(~((F.col("policy_id") == gone) & late)).withColumn("sum_insured", F.when(late, F.col("sum_insured") * 2).otherwise(F.col("sum_insured")))
    after = after.unionByName(new)
    changed = jobs.changed_policies(before, after)
    after.write.parquet(fresh.of("policies"))
    after_paths = jobs.Paths(str(tmp_path / "kept"))
    spark.read.parquet(fresh.of("policies")).write.mode("overwrite").parquet(after_paths.of("policies"))

    folder = writers.version_path(paths.feature(name), 1)
    kept_before = files_of(folder)
    done = jobs.refresh_changed(spark, paths, name, changed)
    assert done.version == 1 and min(done.months) >= dt.date(1997, 6, 1)
    jobs.refresh(spark, fresh, name)
    got = spark.read.parquet(folder)
    assert shaped(got) == shaped(writers.read_latest(spark, fresh.feature(name)))
    # Partitions of other months keep their files, to the last one.
    other = {f: t for f, t in kept_before.items() if f.split(f"{REF}=")[1][:10] < str(min(done.months))}
    assert other and other.items() <= files_of(folder).items()
    assert jobs.refresh_changed(spark, paths, name, changed.limit(0)).rows == 0


def test_changed_policies_cancel_out(spark):
    before = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None)], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (3, None)], "k int, v string")
    assert sorted(map(tuple, jobs.changed_policies(before, after).collect())) == [(1, "a"), (2, "B"), (2, "b")]


def test_rows_without_a_key_are_reported(spark, sf_dir, tmp_path):
    paths = jobs.Paths(str(tmp_path))
    held = policies(spark, sf_dir).withColumn("area_id", F.when(F.col("area_id") > 3, F.col("area_id")))
    held.write.parquet(paths.of("policies"))
    done = jobs.refresh(spark, paths, "place_history")
    months = held.filter("area_id IS NULL").select(F.trunc("start_date", "MM")).distinct().count()
    assert done.without_key == months > 0
    assert done.rows == writers.read_latest(spark, paths.feature("place_history")).count()


def test_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "t")
    for k in range(4):
        writers.write_version(spark.range(k + 1), path)
    assert writers.drop_old_versions(spark, path, keep=2) == [1, 2]
    assert writers.read_latest(spark, path).count() == 4
    with pytest.raises(ValueError):
        writers.latest_version(spark, path, 1)
    with pytest.raises(ValueError):
        writers.drop_old_versions(spark, path, keep=0)


def test_writes_count_their_rows_in_one_job(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    df = spark.range(100, numPartitions=3).mapInArrow(seen, "id long")
    assert writers.overwrite(df, str(tmp_path / "t")) == 100
    assert calls.value == 100
    assert writers.overwrite(df.filter("id < 0"), str(tmp_path / "none")) == 0
    assert writers.overwrite(spark.range(0), str(tmp_path / "empty")) == 0


def test_lookups_shuffle_the_spine_at_most_once(spark, sf_dir, tmp_path):
    held = policies(spark, sf_dir)
    spine = dataset.training_spine(held, "2001-01-01")
    names = ("place_history", "market_risk", "insurer_risk")
    tables = dataset.written_feature_tables(held, str(tmp_path), names)
    keys = {n: jobs.REGISTRY[n].key for n in names}
    broadcast = shaped(dataset.lookup(spine, tables, keys))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = dataset.lookup(spine, tables, keys)
        assert shaped(out) == broadcast and out.columns == dataset.lookup(spine, {}, {}).columns + [
            c for n in names for c in tables[n].columns if c not in keys[n]
        ]
        formatted = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        plan = out._jdf.queryExecution().explainString(formatted)
        exchanges = [part for part in plan.split("\n\n") if ") Exchange" in part]
        assert exchanges and sum("has_claim" in part for part in exchanges) <= 1
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_written_features_are_checked(spark, sf_dir, tmp_path, monkeypatch):
    held = policies(spark, sf_dir)
    doubled = jobs.REGISTRY["rate_reference"]
    made = type(doubled)(lambda df: doubled.build(df).unionByName(doubled.build(df)), doubled.key)
    monkeypatch.setitem(jobs.REGISTRY, "rate_reference", made)
    with pytest.raises(ValueError, match="key"):
        dataset.written_feature_tables(held, str(tmp_path), ["rate_reference"])


def test_files_below_titles(spark, tmp_path):
    for k in range(3):
        lines = [f"title {n}; of {k}" for n in range(6)] + ["code;name"] + [f'{k}{n:04d};"n {n}; x"' for n in range(2000)]
        (tmp_path / f"f{k}.csv").write_text("\n".join(lines) + "\n")
    want = {(int(f"{k}{n:04d}"), f"n {n}; x") for k in range(3) for n in range(2000)}
    for size in ("134217728", "4096"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            got = readers.read_below_title(spark, str(tmp_path), "code int, name string", 6, sep=";").collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    with pytest.raises(ValueError, match="header"):
        readers.read_below_title(spark, str(tmp_path), "id int, name string", 6, sep=";")


def test_column_sets(spark):
    left, right = spark.createDataFrame([], "a int, b string"), spark.createDataFrame([], "a bigint, b string")
    rows = {r.column: (r.tables, r.types, r.same) for r in readers.column_sets({"l": left, "r": right}).collect()}
    assert rows == {"a": (["l", "r"], ["bigint", "int"], False), "b": (["l", "r"], ["string"], True)}


def test_boosting_plan_does_not_grow(spark):
    rows = spark.range(400).select(
        (F.col("id") % 17).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"),
        ((F.col("id") * 7 % 17 + F.col("id") % 5) > 9).cast("int").alias("y"),
    )
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    long = boosting.fit_boosted_stumps(df, "y", rounds=25, rate=0.5)
    assert len(long.stumps) > boosting.KEEP
    # The weights that are written every few rounds are those of one pass: a shorter fit is the longer one's beginning.
    short = boosting.fit_boosted_stumps(df, "y", rounds=12, rate=0.5)
    assert [s.feature for s in short.stumps] == [s.feature for s in long.prefix(12).stumps]
    assert [s.weight for s in short.stumps] == pytest.approx([s.weight for s in long.prefix(12).stumps])

    def nodes(model):
        return model.transform(df)._jdf.queryExecution().analyzed().toString().count("\n")

    assert nodes(long) == nodes(long.prefix(2))


@pytest.mark.parametrize("name,axis", [("random_forest", "numTrees"), ("gradient_boosting", "maxIter"), ("adaboost", "rounds")])
def test_prefixes_are_smaller_models(spark, name, axis):
    rows = spark.range(300).select(
        F.rand(1).alias("a"), F.rand(2).alias("b"), (F.rand(1) + F.rand(3) > 1).cast("int").alias("y")
    ).cache()
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    settings = {"minInstancesPerNode": 5, "maxDepth": 3} if name != "adaboost" else {}
    model = models.fit_model(name, df, "y", **{axis: 6}, **settings)
    first = models.first_trees(model, 2)
    found = models.with_scores({"six": model, "two": first}, df, ["y"]).groupBy("model").agg(F.count("*").alias("n"), F.avg("score").alias("s"))
    assert {r.model: r.n for r in found.collect()} == {"six": 300, "two": 300}
    if name != "random_forest":
        again = models.fit_model(name, df, "y", **{axis: 2}, **settings)
        a, b = (models.with_score(m, df).agg(F.sum("score")).first()[0] for m in (first, again))
        assert a == pytest.approx(b)
    grid = models.grid_scores(name, df, "y", {axis: [2, 6]}, folds=2).collect()
    assert len(grid) == 2 and all(0.5 < r.cv_auc_roc <= 1 for r in grid)
