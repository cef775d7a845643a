"""Writing tables: overwrite, partitions, versions, upsert, CSV export.

A path that is being read is never overwritten: an upsert writes the next
version folder and readers take the newest complete one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from fieldmark.operators.quality import assert_key
from fieldmark.session import shuffles_dropped


def counted(df: DataFrame, **measures: Column) -> tuple[DataFrame, Observation]:
    """The same rows, counted (and measured otherwise) while another step consumes them."""
    seen = Observation()
    rows = F.count(F.lit(1)).alias("rows")
    return df.observe(seen, rows, *[c.alias(name) for name, c in measures.items()]), seen


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = (), **options: str) -> int:
    """Replace the table at ``path`` with whatever schema ``df`` has; returns the row count.

    The rows are counted while they are written: one job, no second read.
    """
    rows, seen = counted(df)
    writer = rows.write.mode("overwrite").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with shuffles_dropped(df.sparkSession):
        writer.parquet(path)
    # A plan that Spark has proven empty is not observed.
    return seen.get.get("rows", 0)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace only the partitions present in ``df``, e.g. whole reference months."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def merged(target: DataFrame, changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Upsert: changed and new keys from ``changes``, the rest from ``target``.

    Keys that ``changes`` lacks stay; nothing is deleted.  Both sides must be
    unique on ``key`` and keys must not be null.
    """
    kept = target.join(changes.select(*key), list(key), "left_anti")
    return kept.unionByName(changes.select(*target.columns))


# A version is complete once its marker exists.
TABLE_MARKER = "_SUCCESS"
INFO_MARKER = "info/_SUCCESS"


def _versions(spark: SparkSession, path: str, marker: str) -> list[int]:
    """Numbers of the complete versions below ``path``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found = []
    for status in files.listStatus(root):
        name = status.getPath().getName()
        done = jvm.org.apache.hadoop.fs.Path(status.getPath(), marker)
        if name.startswith("v") and name[1:].isdigit() and files.exists(done):
            found.append(int(name[1:]))
    return sorted(found)


def version_path(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/v{version:06d}"


def latest_version(
    spark: SparkSession, path: str, version: int | str = "latest", marker: str = TABLE_MARKER
) -> int | None:
    """The newest complete version, or the one asked for after checking that it exists."""
    found = _versions(spark, path, marker)
    if version == "latest":
        return found[-1] if found else None
    if not str(version).isdigit():
        raise ValueError(f"version must be 'latest' or a whole number, not {version!r}")
    if int(version) not in found:
        raise ValueError(f"no version {version} below {path}; there are {found}")
    return int(version)


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    version = latest_version(spark, path)
    if version is None:
        raise ValueError(f"no complete version below {path}")
    return spark.read.parquet(version_path(path, version))


def write_version(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Write the next version next to the ones that readers may still use."""
    spark = df.sparkSession
    number = (latest_version(spark, path) or 0) + 1
    # Spark splits large partitions over several files and keeps small ones in one.
    dealt = df.hint("rebalance", *partition_by) if partition_by else df
    overwrite(dealt, version_path(path, number), partition_by)
    return number


def drop_old_versions(spark: SparkSession, path: str, keep: int = 2, marker: str = TABLE_MARKER) -> list[int]:
    """Delete all but the newest ``keep`` complete versions; returns the numbers that went.

    Keep as many as readers may still use.  Folders without a marker are left: a writer may be at work there.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    old = _versions(spark, path, marker)[:-keep]
    for number in old:
        remove(spark, version_path(path, number))
    return old


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a folder; false if there is none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def upsert(changes: DataFrame, path: str, key: Sequence[str], partition_by: Sequence[str] = ()) -> int:
    """Merge ``changes`` into the table at ``path``, creating it if absent."""
    assert_key(changes, key)
    spark = changes.sparkSession
    if latest_version(spark, path) is None:
        return write_version(changes, path, partition_by)
    return write_version(merged(read_latest(spark, path), changes, key), path, partition_by)
