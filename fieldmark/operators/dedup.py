"""Keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key.

    ``row_number() = 1`` lets Spark cut every key to one row per map task before
    the shuffle, so a key with a third of all rows costs no more than any other.
    All columns close the ordering, missing values last: equal rows are the only ties left.
    """
    order = [*order_by, *[F.col(c).asc_nulls_last() for c in df.columns]]
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def deduplicate(
    df: DataFrame,
    key: str,
    order_by: Sequence[Column],
    keep_null_keys: bool = True,
) -> DataFrame:
    """One row per ``key``; rows without a key are kept unless told otherwise.

    With ``keep_null_keys=False`` all rows without a key collapse to one.
    """
    if not keep_null_keys:
        return first_per_key(df, [key], order_by)
    # One pass: rows without a key are told apart by a row number, so that each is a key of its own.
    own = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    rows = df.select(*[F.col(c) for c in df.columns], own.alias("_own"))
    return first_per_key(rows, [key, "_own"], order_by).drop("_own")
