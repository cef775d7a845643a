"""Contracts and quality reports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F

from fieldmark.plans.schema import OUTCOME_COLUMNS


def key_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that are null or repeated, with their row counts; empty when the key holds."""
    counted = df.groupBy(*key).agg(F.count("*").alias("n_rows"))
    any_null = F.lit(False)
    for k in key:
        any_null = any_null | F.col(k).isNull()
    return counted.filter((F.col("n_rows") > 1) | any_null)


def assert_key(df: DataFrame, key: Sequence[str]) -> None:
    sample = key_violations(df, key).limit(5).collect()
    if sample:
        raise ValueError(f"key {list(key)} is broken, for example: {sample}")


def leaked_columns(columns: Iterable[str], outcomes: Iterable[str] = OUTCOME_COLUMNS) -> list[str]:
    """Outcome columns found among the given ones (names only, no data)."""
    forbidden = set(outcomes)
    return [c for c in columns if c in forbidden]


def assert_no_leakage(columns: Iterable[str], outcomes: Iterable[str] = OUTCOME_COLUMNS) -> None:
    found = leaked_columns(columns, outcomes)
    if found:
        raise ValueError(f"outcome columns among the features: {found}")


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column with its number of nulls."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counted.unpivot([], df.columns, "column", "n_null")


def unmapped_codes(df: DataFrame, column: str, dim: DataFrame) -> DataFrame:
    """Codes the dictionary lacks, with how many rows carry them."""
    counted = df.groupBy(F.col(column).alias("code")).agg(F.count("*").alias("n_rows"))
    return counted.join(dim.select("code"), "code", "left_anti")
