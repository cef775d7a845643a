"""Portfolio reports: groups, shares, summaries, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fieldmark.functions.numbers import ratio
from fieldmark.operators.prefix import join_groups, with_running_sums
from fieldmark.operators.quantiles import quantile_table
from fieldmark.session import written

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def volume(df: DataFrame, by: Sequence[str], label: str = "claim") -> DataFrame:
    """Policies, claims and claim rate per group."""
    grouped = df.groupBy(*by).agg(F.count("*").alias("policies"), F.sum(label).cast("bigint").alias("claims"))
    return grouped.withColumn("claim_rate", ratio(F.col("claims"), F.col("policies")))


def with_share(df: DataFrame, value: str, target: str = "share") -> DataFrame:
    """Share of the column total, read as a scalar subquery: no join, no global window."""
    total = df.agg(F.sum(value)).scalar()
    return df.withColumn(target, ratio(F.col(value), total))


def with_running_percent(report: DataFrame, value: str, key: str, target: str = "running_percent") -> DataFrame:
    """Pareto percent in falling order of ``value``, ties by ``key``; null values come last and add nothing.

    The running sum goes over ranges of the report, whatever its length.
    """
    order = [F.col(value).desc_nulls_last(), F.col(key).asc()]
    running = with_running_sums(report, order, {"_through": value}, totals={"_total": value})
    percent = ratio(F.col("_through") * 100, F.col("_total"))
    return running.withColumn(target, percent).drop("_through", "_total")


def loss_ratio_percent(df: DataFrame) -> DataFrame:
    """Indemnity over premium of the whole portfolio, in percent."""
    return df.agg(ratio(F.sum("indemnity") * 100, F.sum("premium")).alias("loss_ratio_percent"))


def target_distribution(df: DataFrame, label: str = "claim") -> DataFrame:
    return with_share(df.groupBy(label).agg(F.count("*").alias("policies")), "policies")


def top_per_group(df: DataFrame, group: Sequence[str], category: str) -> DataFrame:
    """The most frequent category of each group; ties go to the smaller name."""
    counts = df.groupBy(*group, category).agg(F.count("*").alias("n_rows"))
    order = W.partitionBy(*group).orderBy(F.col("n_rows").desc(), F.col(category).asc())
    return counts.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") == 1).drop("_rank")


def peril_ranking(df: DataFrame, peril: str = "peril", none: str = "none", rare: float = 0.001) -> DataFrame:
    """Claims per peril with their share; perils at or below the ``rare`` share are left out."""
    counts = df.filter(F.col("claim") == 1).groupBy(peril).agg(F.count("*").alias("claims"))
    return with_share(counts, "claims").filter((F.col(peril) != none) & (F.col("share") > rare))


def numeric_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, extremes, exact quartiles and sample deviation, one row per column."""
    parts = [("mean", F.avg), ("min", F.min), ("max", F.max), ("std", F.stddev_samp)]
    wide = df.agg(*[f(F.col(c).cast("double")).alias(f"{c}__{n}") for c in columns for n, f in parts])
    stacked = F.array(
        *[F.struct(F.lit(c).alias("column"), *[F.col(f"{c}__{n}").alias(n) for n, _ in parts]) for c in columns]
    )
    return wide.select(F.inline(stacked)).join(quantile_table(df, columns, QUARTILES), "column", "left")


def mean_and_median(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Mean and exact median of every column per class, one row per (class, column)."""
    means = df.groupBy(by).agg(*[F.avg(c).alias(c) for c in columns]).unpivot([by], list(columns), "column", "mean")
    return join_groups(means, quantile_table(df, columns, {"median": 0.5}, by), [by, "column"])


def box_summary(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges and outliers per class."""
    # One row per (class, column), written so that Spark knows how small it is and leaves the long side where it is.
    quartiles = written(quantile_table(df, columns, QUARTILES, by), "quartiles")
    spread = F.col("q3") - F.col("q1")
    fences = quartiles.withColumns(
        {"low_fence": F.col("q1") - spread * 1.5, "high_fence": F.col("q3") + spread * 1.5}
    )
    held = [F.col(c).cast("double").alias(c) for c in columns]
    long = df.select(by, *held).unpivot([by], list(columns), "column", "value").filter(F.col("value").isNotNull())
    inside = F.col("value").between(F.col("low_fence"), F.col("high_fence"))
    return (
        join_groups(long, fences, [by, "column"])
        .groupBy(by, "column")
        .agg(
            *[F.first(c).alias(c) for c in ("q1", "median", "q3")],
            F.min(F.when(inside, F.col("value"))).alias("low_whisker"),
            F.max(F.when(inside, F.col("value"))).alias("high_whisker"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )


def density_histogram(df: DataFrame, value: str, by: str, bins: int = 50) -> DataFrame:
    """Equal-width bins over each class's own range; empty bins are left out.

    The last bin includes its upper edge, and densities integrate to one.
    """
    present = df.filter(F.col(value).isNotNull()).select(by, F.col(value).cast("double").alias(value))
    # One row per class: Spark broadcasts the ranges where their size allows, else it sorts and merges.
    ranges = present.groupBy(by).agg(
        F.min(value).alias("_low"), F.max(value).alias("_high"), F.count("*").alias("_total")
    )
    width = (F.col("_high") - F.col("_low")) / bins
    spot = F.floor((F.col(value) - F.col("_low")) / F.nullif(width, F.lit(0.0)))
    bin_no = F.least(F.coalesce(spot, F.lit(0)), F.lit(bins - 1)).cast("int")
    counts = join_groups(present, ranges, [by]).groupBy(by, bin_no.alias("bin"), "_low", "_high", "_total")
    return counts.agg(F.count("*").alias("n_rows")).select(
        by,
        "bin",
        (F.col("_low") + F.col("bin") * width).alias("left_edge"),
        "n_rows",
        ratio(F.col("n_rows"), F.col("_total") * width).alias("density"),
    )


def in_percent(col: Column, digits: int = 2) -> Column:
    return F.round(col * 100, digits)


def top_rows(df: DataFrame, n: int, value: str, key: str) -> DataFrame:
    """The ``n`` best rows of a report, ties by ``key``."""
    return df.orderBy(F.col(value).desc(), F.col(key).asc()).limit(n)
