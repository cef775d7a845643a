"""Session settings shared by jobs, tests and the bench."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(app: str = "fieldmark", master: str | None = None, **conf: str) -> SparkSession:
    """Build (or reuse) a session.  On a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Every executor has to reach it.  Only a local session that names none gets a
    temporary folder, which it then keeps in its settings.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="fieldmark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the application's own folder in the scratch root; the folder goes when the driver ends."""
    context = spark.sparkContext
    folder = f"{scratch_root(spark)}/fieldmark-{context.applicationId}"
    place = context._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(context._jsc.hadoopConfiguration())
    if files.mkdirs(place):
        files.deleteOnExit(place)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


#: Spark's setting by which a query's shuffle files go as it ends; otherwise they stay until the driver collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Scratch tables are written densely: they take disk while a query runs.
SCRATCH_CODEC = "zstd"
_dropping = threading.Lock()
_holders: dict[str, tuple[int, str | None]] = {}


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What is written inside leaves no shuffle files behind, also where several threads write."""
    name = spark._jsparkSession.sessionUUID()
    with _dropping:
        held, before = _holders.get(name) or (0, spark.conf.get(DROP_SHUFFLES, None))
        _holders[name] = held + 1, before
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _dropping:
            held, before = _holders[name]
            if held > 1:
                _holders[name] = held - 1, before
            else:
                del _holders[name]
                spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate table and read it back: its lineage ends there, and its rows stay as they are."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_dropped(df.sparkSession):
        df.write.option("compression", SCRATCH_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of scratch tables that nothing reads again; files elsewhere stay."""
    files = {file for table in tables for file in table.inputFiles()}
    for folder in {file.rsplit("/", 1)[0] for file in files}:
        spark = tables[0].sparkSession
        own = f"{scratch_root(spark)}/fieldmark-{spark.sparkContext.applicationId}/"
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        system = place(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if str(place(folder).toUri().getPath()).startswith(str(place(own).toUri().getPath()) + "/"):
            system.delete(place(folder), True)


#: Values (rows times columns) up to which a table is small: some sixty megabytes, whatever its files take.
SMALL_VALUES = 6_000_000


def broadcast_if_small(table: DataFrame) -> DataFrame:
    """The table with a hint to broadcast it if its size is known to allow it and broadcasts are not switched off.

    Spark's own limit is on the bytes it expects, this one on the counted rows.  Only a table that is read as it is,
    without a shuffle, is counted.
    """
    execution = table._jdf.queryExecution()
    if table.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() < 0:
        return table
    if "Exchange" in execution.executedPlan().toString() or int(str(execution.optimizedPlan().stats().sizeInBytes())) > 8 * SMALL_VALUES:
        return table
    return F.broadcast(table) if table.count() * len(table.columns) <= SMALL_VALUES else table
