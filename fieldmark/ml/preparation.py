"""Imputation, encoding and scaling: fitted on Spark, applied as expressions and joins."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldmark.operators.dedup import first_per_key
from fieldmark.operators.prefix import with_running_sums
from fieldmark.operators.quality import assert_no_leakage
from fieldmark.operators.quantiles import exact_quantiles
from fieldmark.plans.schema import MARKET_WINDOWS, NEVER_FEATURES, OPENING_WINDOWS, PLACE_WINDOWS
from fieldmark.session import written

HISTORY = [
    *[f"place_{m}_{n}d" for n in PLACE_WINDOWS for m in ("policies", "claims", "claim_rate", "severity")],
    *[f"place_opened_{n}d" for n in OPENING_WINDOWS],
    *[f"market_{m}_{n}d" for n in MARKET_WINDOWS for m in ("policies", "claims", "claim_rate", "severity")],
    "market_mean_coverage_365d", "market_insurer_hhi_365d",
    "insurer_policies_365d", "insurer_claim_rate_365d", "insurer_severity_365d",
    "rate_policies_365d", "rate_mean_365d", "rate_std_365d",
    "portfolio_share_365d", "portfolio_hhi_365d",
    "rate_anomaly",
]
CONTRACT = [
    "start_quarter", "start_year", "duration_days", "relative_duration", "summer_season", "insured_per_ha",
    "premium_per_ha", "yield_cover_ratio", "subsidy_ratio", "policy_rate", "policy_coverage", "area_per_head",
]
CATEGORIES = ["crop_group", "region", "insurer", "place_dominant_peril_365d"]
CYCLIC = ["month_sin", "month_cos"]
ALL_FEATURES = [*HISTORY, *CONTRACT, *CATEGORIES, *CYCLIC]

UNSEEN = -1


def fit_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians; a column without any value is filled with 0."""
    found = exact_quantiles(df, columns, [0.5])
    return {c: found[None, c][0] if found[None, c][0] is not None else 0.0 for c in columns}


def fit_modes(df: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """Most frequent category per column; ties go to the smaller name."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "category")
    counts = long.filter(F.col("category").isNotNull()).groupBy("column", "category").agg(F.count("*").alias("n"))
    top = first_per_key(counts, ["column"], [F.col("n").desc(), F.col("category").asc()])
    return {row["column"]: row["category"] for row in top.collect()}


def fit_categories(df: DataFrame, columns: Sequence[str], modes: dict[str, str] | None = None) -> DataFrame:
    """(column, category, code): codes number the sorted categories from 0."""
    if not columns:
        return df.sparkSession.createDataFrame([], "column string, category string, code double")
    filled = [F.coalesce(F.col(c).cast("string"), F.lit((modes or {}).get(c))).alias(c) for c in columns]
    seen = df.select(*filled).unpivot([], list(columns), "column", "category").filter(F.col("category").isNotNull())
    known = seen.distinct().withColumn("_one", F.lit(1))
    ranked = with_running_sums(known, [F.col("category").asc()], {"_place": "_one"}, ["column"])
    return ranked.select("column", "category", (F.col("_place") - 1).cast("double").alias("code"))


def impute(df: DataFrame, medians: dict[str, float], modes: dict[str, str] | None = None) -> DataFrame:
    numbers = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in medians.items()}
    names = {c: F.coalesce(F.col(c).cast("string"), F.lit(v)) for c, v in (modes or {}).items()}
    return df.withColumns({**numbers, **names})


def encode(df: DataFrame, categories: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace categories by their codes; ones the fit has not seen become -1."""
    out = df
    for c in columns:
        dim = categories.filter(F.col("column") == c).select(F.col("category").alias("_cat"), F.col("code").alias("_code"))
        joined = out.join(dim, F.col(c) == F.col("_cat"), "left")
        out = joined.withColumn(c, F.coalesce("_code", F.lit(float(UNSEEN)))).drop("_cat", "_code")
    return out


def fit_scale(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation; a constant column keeps its scale."""
    stats = df.agg(*[f(F.col(c)).alias(f"{c}__{n}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_pop))])
    row = stats.first()
    return {c: (row[f"{c}__m"] or 0.0, row[f"{c}__s"] or 1.0) for c in columns}


def scale(df: DataFrame, scales: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scales.items()})


@dataclass(frozen=True)
class Preparation:
    """A fitted preparation.  ``scales`` is filled for linear models only."""

    numeric: list[str]
    categorical: list[str]
    cyclic: list[str]
    medians: dict[str, float]
    modes: dict[str, str]
    categories: DataFrame
    scales: dict[str, tuple[float, float]] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical, *self.cyclic]

    def columns(self, df: DataFrame) -> DataFrame:
        """Imputed, encoded and (for linear models) scaled columns."""
        filled = encode(impute(df, self.medians, self.modes), self.categories, self.categorical)
        return scale(filled, self.scales) if self.scales else filled

    def transform(self, df: DataFrame) -> DataFrame:
        """The same plus the ``features`` vector."""
        return VectorAssembler(inputCols=self.features, outputCol="features").transform(self.columns(df))

    def save(self, path: str) -> None:
        rows = [("numeric", c, self.medians[c], None) for c in self.numeric]
        rows += [("categorical", c, None, self.modes.get(c)) for c in self.categorical]
        rows += [("cyclic", c, None, None) for c in self.cyclic]
        rows += [("scale_mean", c, m, None) for c, (m, _) in self.scales.items()]
        rows += [("scale_deviation", c, s, None) for c, (_, s) in self.scales.items()]
        numbered = [(i, *row) for i, row in enumerate(rows)]
        spark = self.categories.sparkSession
        table = spark.createDataFrame(numbered, "position int, kind string, name string, number double, text string")
        table.write.mode("overwrite").parquet(f"{path}/columns")
        self.categories.write.mode("overwrite").parquet(f"{path}/categories")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Preparation":
        rows = spark.read.parquet(f"{path}/columns").orderBy("position").collect()

        def kept(kind: str) -> list:
            return [r for r in rows if r["kind"] == kind]

        deviations = {r["name"]: r["number"] for r in kept("scale_deviation")}
        return Preparation(
            numeric=[r["name"] for r in kept("numeric")],
            categorical=[r["name"] for r in kept("categorical")],
            cyclic=[r["name"] for r in kept("cyclic")],
            medians={r["name"]: r["number"] for r in kept("numeric")},
            modes={r["name"]: r["text"] for r in kept("categorical") if r["text"] is not None},
            categories=spark.read.parquet(f"{path}/categories"),
            scales={r["name"]: (r["number"], deviations[r["name"]]) for r in kept("scale_mean")},
        )


def fit(
    df: DataFrame,
    numeric: Sequence[str] = (*HISTORY, *CONTRACT),
    categorical: Sequence[str] = tuple(CATEGORIES),
    cyclic: Sequence[str] = tuple(CYCLIC),
    linear: bool = False,
) -> Preparation:
    """Fit on the training rows; ``linear`` adds standard scaling of all columns.

    Outcomes among the features are an error.  The categories are written once and
    read by every transform.
    """
    assert_no_leakage([*numeric, *categorical, *cyclic], NEVER_FEATURES)
    modes = fit_modes(df, categorical) if categorical else {}
    categories = written(fit_categories(df, categorical, modes), "categories")
    prepared = Preparation(
        list(numeric), list(categorical), list(cyclic),
        fit_medians(df, numeric) if numeric else {}, modes, categories,
    )
    if not linear:
        return prepared
    scales = fit_scale(prepared.columns(df), prepared.features)
    return Preparation(**{**prepared.__dict__, "scales": scales})
