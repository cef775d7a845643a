"""Code dictionaries and geography dimensions.

Dimensions are plain DataFrames.  Nothing here forces a broadcast: Spark
broadcasts a dimension when its size is below
``spark.sql.autoBroadcastJoinThreshold`` and shuffles it otherwise.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldmark.functions import text
from fieldmark.session import written


def code_table(spark: SparkSession, codes: Mapping[str, str]) -> DataFrame:
    """A two-column (code, value) dimension from a small dictionary."""
    return spark.createDataFrame([(str(k), str(v)) for k, v in codes.items()], "code string, value string")


def normalised(dim: DataFrame, key: str = "code", fold_marks: bool = True) -> DataFrame:
    """Fold the dimension's key like the data, so accented entries still match."""
    return dim.withColumn(key, F.trim(text.strip_accents(F.col(key), fold_marks)))


def unique(dim: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row per key: equal rows are merged, rows that differ raise an error.

    Folding accents can make two entries of a dictionary one; a duplicate would
    multiply the rows of the data.  The dimension is computed once, by one aggregate
    that is written; the check and the joins read what was written, and Spark
    chooses those joins by its real size.
    """
    row = F.struct(*[c for c in dim.columns if c not in key])
    held = written(dim.groupBy(*key).agg(F.min(row).alias("_low"), F.max(row).alias("_high")), "dimension")
    repeated = held.filter(~F.col("_low").eqNullSafe(F.col("_high"))).limit(5).collect()
    if repeated:
        raise ValueError(f"dimension key {list(key)} has several values, for example: {repeated}")
    return held.select(*key, "_low.*")


def map_code(
    df: DataFrame,
    column: str,
    dim: DataFrame,
    target: str | None = None,
    default: str | None = None,
    keep_unmapped: bool = True,
) -> DataFrame:
    """Look ``column`` up in a (code, value) dimension.

    Unmapped codes keep their own text, or take ``default`` when
    ``keep_unmapped`` is false.  A code with two values is an error.
    """
    target = target or column
    fallback: Column = F.col(column) if keep_unmapped else F.lit(default)
    looked_up = unique(dim.select(F.col("code").alias("_code"), F.col("value").alias("_value")), ["_code"])
    joined = df.join(looked_up, F.col(column) == F.col("_code"), "left")
    return joined.withColumn(target, F.coalesce("_value", fallback)).drop("_code", "_value")


def correct_names(df: DataFrame, name: str, corrections: DataFrame, state: str | None = None) -> DataFrame:
    """One pass of old name to right name, optionally only within the same state.

    ``corrections`` has ``old_name, new_name`` and, with ``state``, a ``state``.
    One pass on purpose: a corrected name is not corrected again.
    """
    dim = corrections.select(
        F.col("old_name").alias("_old"),
        F.col("new_name").alias("_new"),
        *([F.col("state").alias("_state")] if state else []),
    )
    dim = unique(dim, ["_old", *(["_state"] if state else [])])
    cond = F.col(name) == F.col("_old")
    if state:
        cond = cond & (F.col(state) == F.col("_state"))
    joined = df.join(dim, cond, "left").withColumn(name, F.coalesce("_new", name))
    return joined.drop("_old", "_new", "_state")


def place_codes(
    df: DataFrame,
    places: DataFrame,
    districts: DataFrame | None = None,
    name: str = "place_name",
    state: str = "state",
    code: str = "place_code",
) -> DataFrame:
    """Fill the place code from (name, state), then from district names.

    ``places`` has ``name, state, code`` (unique on name and state);
    ``districts`` has ``district, state, code, place_name``.  Both lookups are
    left joins over one scan of the policies; only rows whose code is still
    missing (null or 0) take the district's code and place name.
    """
    place_dim = places.select(
        F.col("name").alias("_p_name"), F.col("state").alias("_p_state"), F.col("code").cast("int").alias("_p_code")
    )
    place_dim = unique(place_dim, ["_p_name", "_p_state"])
    out = df.join(place_dim, (F.col(name) == F.col("_p_name")) & (F.col(state) == F.col("_p_state")), "left")
    known = F.coalesce("_p_code", F.nullif(F.col(code), F.lit(0)))
    if districts is None:
        out = out.withColumn(code, known)
        return out.drop("_p_name", "_p_state", "_p_code")
    district_dim = districts.select(
        F.col("district").alias("_d_name"),
        F.col("state").alias("_d_state"),
        F.col("code").cast("int").alias("_d_code"),
        F.col("place_name").alias("_d_place"),
    )
    district_dim = unique(district_dim, ["_d_name", "_d_state"])
    out = out.withColumn("_known", known)
    out = out.join(
        district_dim,
        F.col("_known").isNull() & (F.col(name) == F.col("_d_name")) & (F.col(state) == F.col("_d_state")),
        "left",
    )
    out = out.withColumns({code: F.coalesce("_known", "_d_code"), name: F.coalesce("_d_place", name)})
    return out.drop("_p_name", "_p_state", "_p_code", "_known", "_d_name", "_d_state", "_d_code", "_d_place")


def unmatched(df: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Distinct keys of ``df`` that the dimension lacks, with their row counts."""
    counted = df.groupBy(*on).agg(F.count("*").alias("n_rows"))
    return counted.join(dim.select(*on), list(on), "left_anti")
