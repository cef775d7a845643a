"""The batch jobs from landed files to scores, as functions over paths.

Each job reads written tables, writes one, and returns how many rows it wrote
(or what it fitted).  Any scheduler can call them; none is built here.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldmark.ml import models, preparation
from fieldmark.operators.quality import assert_key
from fieldmark.plans import dataset, silver
from fieldmark.plans.features import REGISTRY, feature_table
from fieldmark.plans.schema import LONGEST_LOOKBACK, OPENING_WINDOWS, REF
from fieldmark.session import written
from fieldmark.sources import readers, writers

# The first month kept out of training, and the share of rows tested on.
CUTOFF = "2025-01-01"
TEST_SHARE = 0.3


@dataclass(frozen=True)
class Paths:
    """Where the tables live; any file system all executors reach."""

    root: str

    def of(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def feature(self, name: str) -> str:
        return self.of(f"features/{name}")


def land(spark: SparkSession, source: str, fmt: str, schema, target: str, **options: str) -> int:
    """Landed files of one source to a raw table, in as many files as there are splits."""
    return writers.overwrite(readers.read_table(spark, source, fmt, schema, **options), target)


def clean(sources: Sequence[DataFrame], dims: silver.Dimensions, paths: Paths, options: silver.Options | None = None) -> int:
    return writers.overwrite(silver.build(silver.union_sources(*sources), dims, options), paths.of("policies"))


def split_gold(spark: SparkSession, paths: Paths) -> tuple[int, int]:
    features, labels = dataset.gold(spark.read.parquet(paths.of("policies")))
    return writers.overwrite(features, paths.of("gold_features")), writers.overwrite(labels, paths.of("gold_labels"))


@dataclass(frozen=True)
class Refreshed:
    """What a refresh wrote: the version, its rows, the built rows that have no key, and the months it touched."""

    version: int
    rows: int
    without_key: int
    months: Sequence[dt.date] = ()


def _built(table, policies: DataFrame, name: str, months: Sequence[dt.date] | None = None) -> tuple[DataFrame, int, int]:
    """The table's rows, written once and checked, with how many there are and how many were left out.

    Rows without a key, such as those of places that no dimension knows, cannot be looked up.
    """
    made = table.build(policies)
    if months is not None:
        made = made.filter(F.col(REF).isin(list(months)))
    no_key = F.lit(False)
    for k in table.key:
        no_key = no_key | F.col(k).isNull()
    made, seen = writers.counted(made, without_key=F.count_if(no_key))
    rows = written(made.filter(~no_key), name)
    found = seen.get
    assert_key(rows, table.key)
    without = found.get("without_key", 0)
    return rows, found.get("rows", 0) - without, without


def refresh(spark: SparkSession, paths: Paths, name: str, keep: int = 2) -> Refreshed:
    """Build one feature table from all policies and merge it into its last version.

    The versions before the newest ``keep`` are deleted.
    """
    table = feature_table(name)
    rows, n, without = _built(table, spark.read.parquet(paths.of("policies")), name)
    version = writers.upsert(rows, paths.feature(name), table.key, [REF])
    writers.drop_old_versions(spark, paths.feature(name), keep)
    return Refreshed(version, n, without)


def refresh_feature(spark: SparkSession, paths: Paths, name: str) -> int:
    """``refresh``, returning the new version alone."""
    return refresh(spark, paths, name).version


def changed_policies(before: DataFrame, after: DataFrame) -> DataFrame:
    """Policies that were added, removed or altered: their rows as they were and as they are.

    One pass: every distinct row is counted with a sign, and rows that stay cancel out.
    """
    columns = after.columns
    signed = before.select(*columns, F.lit(-1).alias("_sign")).unionByName(after.select(*columns, F.lit(1).alias("_sign")))
    return signed.groupBy(*columns).agg(F.sum("_sign").alias("_left")).filter("_left <> 0").drop("_left")


def affected_months(changed: DataFrame) -> list[dt.date]:
    """Reference months whose features a changed policy can alter.

    These run from the month it starts in to the last one whose longest lookback still sees its end.
    """
    first = F.trunc("start_date", "MM")
    last = F.trunc(F.date_add(F.greatest("start_date", "end_date"), LONGEST_LOOKBACK), "MM")
    months = changed.select(F.explode(F.sequence(first, last, F.expr("INTERVAL 1 MONTH"))).alias(REF)).distinct()
    # As many rows as the calendar has months.
    return sorted(row[REF] for row in months.collect())


def seen_from(policies: DataFrame, months: Sequence[dt.date]) -> DataFrame:
    """The policies that features of these months look at: the months' own and those in their lookbacks."""
    low, high = (F.lit(m) for m in (min(months), max(months)))
    start, end = F.col("start_date"), F.col("end_date")
    recent = (start >= F.date_sub(low, max(OPENING_WINDOWS))) | (end >= F.date_sub(low, LONGEST_LOOKBACK))
    return policies.filter(recent & ((start < F.add_months(high, 1)) | (end < high)))


def refresh_changed(spark: SparkSession, paths: Paths, name: str, changed: DataFrame) -> Refreshed:
    """Bring one feature table up to date after ``changed`` policies: only their months are rebuilt.

    The months' partitions of the newest version are replaced in place, all others keep their files.  A month
    that has no rows any more loses its partition.  Without a version the whole table is built.
    """
    table = feature_table(name)
    version = writers.latest_version(spark, paths.feature(name))
    if version is None:
        return refresh(spark, paths, name)
    months = affected_months(changed)
    if not months:
        return Refreshed(version, 0, 0)
    seen = seen_from(spark.read.parquet(paths.of("policies")), months)
    rows, n, without = _built(table, seen, name, months)
    target = writers.version_path(paths.feature(name), version)
    kept = {row[REF] for row in rows.select(REF).distinct().collect()}
    if kept:
        writers.replace_partitions(rows.hint("rebalance", REF), target, [REF])
    for month in months:
        if month not in kept:
            writers.remove(spark, f"{target}/{REF}={month}")
    return Refreshed(version, n, without, months)


def feature_tables(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    return {name: writers.read_latest(spark, paths.feature(name)) for name in REGISTRY}


@dataclass(frozen=True)
class Trained:
    champion: str
    version: int
    settings: Mapping[str, object]
    metrics: DataFrame


def train(
    spark: SparkSession,
    paths: Paths,
    as_of: str,
    cutoff: str = CUTOFF,
    settings: Mapping[str, Mapping] | None = None,
    grids: Mapping[str, Mapping[str, Sequence]] | None = None,
) -> Trained:
    """Training set, four models, grid search of the best, saved model and run log."""
    check_features(spark, paths)
    policies = spark.read.parquet(paths.of("policies"))
    spine = dataset.training_spine(policies, as_of, cutoff)
    # The split needs the spine alone, so it is made before the lookups.
    marked = dataset.stratified_split(spine, dataset.LABEL, ["policy_id", REF], TEST_SHARE)
    writers.overwrite(dataset.with_features(marked, feature_tables(spark, paths)), paths.of("training"))
    table = spark.read.parquet(paths.of("training"))
    train_rows, test_rows = table.filter(~F.col("is_test")), table.filter("is_test")
    prep = preparation.fit(train_rows)
    # The prepared rows are read by every fit, so they are written too.
    for part, rows in (("train", train_rows), ("test", test_rows)):
        prep.transform(rows).select("policy_id", REF, dataset.LABEL, "features").write.mode("overwrite").parquet(
            paths.of(f"prepared/{part}")
        )
    ready, held = (spark.read.parquet(paths.of(f"prepared/{part}")) for part in ("train", "test"))
    baseline = models.compare(ready, held, dataset.LABEL, settings)
    model, chosen, score = models.tune(baseline.champion, ready, dataset.LABEL, (grids or {}).get(baseline.champion))
    tuned = models.evaluate(model, ready, held, dataset.LABEL, f"tuned_{baseline.champion}")
    metrics = spark.createDataFrame(baseline.metrics.unionByName(tuned).collect())
    version = models.save_model(spark, paths.of("models"), baseline.champion, model, prep)
    flat = {f"{r['model']}_{m}_{r['split']}": r[m] for r in metrics.collect() for m in METRICS if r[m] is not None}
    for part, rows in (("train", ready), ("test", held)):
        flat[f"claim_rate_{part}"] = rows.agg(F.avg(dataset.LABEL)).first()[0]
    params = {"champion": baseline.champion, "cutoff": cutoff, "as_of": as_of, **chosen}
    models.log_run(spark, paths.of("runs"), baseline.champion, params, {"grid_best_cv_auc_roc": score, **flat})
    return Trained(baseline.champion, version, chosen, metrics)


METRICS = ("accuracy", "auc_roc", "auc_pr", "ks", "f1", "lift_10")


def score(spark: SparkSession, paths: Paths, cutoff: str = CUTOFF, version: int | str = "latest") -> int:
    """Probabilities for every policy from the cutoff month on, by model name."""
    check_features(spark, paths)
    name, number, model, prep = models.load_model(spark, paths.of("models"), version)
    policies = spark.read.parquet(paths.of("policies"))
    spine = dataset.scoring_spine(policies, cutoff, check_not_empty=True)
    ready = dataset.with_features(spine, feature_tables(spark, paths))
    return writers.overwrite(models.score_batch(ready, prep, model, name, number), paths.of("predictions"), ["model_name"])


def check_features(spark: SparkSession, paths: Paths) -> None:
    """Primary keys of all feature tables, checked side by side: a repeated key would multiply rows."""
    tables = feature_tables(spark, paths)
    models.side_by_side({n: lambda n=n: assert_key(tables[n], REGISTRY[n].key) for n in tables}, len(tables))
