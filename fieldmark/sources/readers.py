"""Reading landed files and dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F, types as T

from fieldmark.functions.text import slug

FORMATS = ("csv", "parquet", "json", "orc")


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | str | None = None, **options: str
) -> DataFrame:
    """One table from a folder of files; csv needs a header row and a schema."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; choose one of {FORMATS}")
    reader = spark.read.format(fmt)
    if fmt == "csv":
        if schema is None:
            raise ValueError("give csv files a schema; inferring one costs a second scan")
        reader = reader.option("header", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.options(**options).load(path)


def read_if_present(spark: SparkSession, path: str, fmt: str = "parquet", **kwargs) -> DataFrame | None:
    """The table, or None when its path does not exist.  Other errors are raised."""
    try:
        return read_table(spark, path, fmt, **kwargs)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_below_title(
    spark: SparkSession, path: str, schema: T.StructType | str, leading: int = 6, **options: str
) -> DataFrame:
    """Delimited files whose header comes after ``leading`` title rows, each file with its own.

    Lines are told apart by where they stand: only the first block of a file can hold its title, and in it lines
    are numbered in the order of the file.  Other blocks are parsed as they are, so large files stay split.  The
    header has to name the columns of ``schema`` in order.  A quoted field may not contain a line end.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"),
    )
    # A block is read by one task, line after line.
    number = F.row_number().over(W.partitionBy("_file").orderBy("_line"))
    first = lines.filter(F.col("_block") == 0).withColumn("_number", number)
    rest = lines.filter(F.col("_block") > 0).withColumn("_number", F.lit(leading + 2))
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = F.from_csv("value", ", ".join(f"`{f.name}` string" for f in fields), options)
    headers = first.filter(F.col("_number") == leading + 1).select(header.alias("h")).distinct().limit(2).collect()
    wrong = [r["h"] for r in headers if [str(v).strip() for v in r["h"]] != fields.names]
    if wrong:
        raise ValueError(f"the header after {leading} rows is {list(wrong[0])}, not {fields.names}")
    body = first.filter(F.col("_number") > leading + 1).unionByName(rest)
    row = F.from_csv("value", ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), options)
    return body.filter(F.trim("value") != "").select(row.alias("row")).select("row.*")


def empty_like(df: DataFrame) -> DataFrame:
    """A table with the same columns and no rows; the source is not read."""
    return df.sparkSession.createDataFrame([], df.schema)


def schema_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns on which two tables disagree; no rows means the sets are equal."""
    ours = {f.name: f.dataType.simpleString() for f in left.schema.fields}
    theirs = {f.name: f.dataType.simpleString() for f in right.schema.fields}
    rows = [
        (name, ours.get(name), theirs.get(name))
        for name in sorted({*ours, *theirs})
        if ours.get(name) != theirs.get(name)
    ]
    return left.sparkSession.createDataFrame(rows, "column string, left_type string, right_type string")


def column_sets(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column found in any table: in which tables it is, with which types, and whether all agree."""
    names = list(tables)
    types = {n: {f.name: f.dataType.simpleString() for f in t.schema.fields} for n, t in tables.items()}
    rows = []
    for column in sorted({c for t in types.values() for c in t}):
        found = [types[n].get(column) for n in names]
        rows.append((column, [n for n, v in zip(names, found) if v], sorted({v for v in found if v}), len(set(found)) == 1))
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "column string, tables array<string>, types array<string>, same boolean")


def same_columns(left: DataFrame, right: DataFrame) -> bool:
    return left.columns == right.columns


def shared_columns(left: DataFrame, right: DataFrame) -> list[str]:
    """Columns both tables have, in the order of the left one."""
    theirs = set(right.columns)
    return [c for c in left.columns if c in theirs]


def geography(
    df: DataFrame, columns: Mapping[str, str], names: Sequence[str], state: str, states: Mapping[int, str]
) -> DataFrame:
    """A geography dimension: picked columns, slugged names, state codes as letters.

    ``columns`` maps source to target names; ``names`` are the target columns to
    slug; ``states`` maps numeric state codes to their letters (27 entries).
    """
    picked = df.select(*[F.col(old).alias(new) for old, new in columns.items()])
    letters = F.create_map(*[F.lit(v) for pair in states.items() for v in (str(pair[0]), pair[1])])
    text_state = F.col(state).cast("string")
    changed = {n: slug(F.col(n)) for n in names}
    changed[state] = F.coalesce(F.try_element_at(letters, text_state), text_state)
    return picked.withColumns(changed)
