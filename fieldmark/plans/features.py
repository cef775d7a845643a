"""The six point-in-time feature tables, keyed by reference month and entity.

Every function takes the policy table (canonical column names) and returns one
row per key.  History is what ended before the reference month, never the
month's own policies.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from fieldmark.functions import dates
from fieldmark.functions.numbers import ratio
from fieldmark.operators.concentration import dominant_category, market_concentration, portfolio_concentration
from fieldmark.operators.dedup import first_per_key
from fieldmark.operators.lookback import Clock, lookback_spread, lookback_sums
from fieldmark.plans.schema import MARKET_WINDOWS, NO_CLAIM, OPENING_WINDOWS, PLACE_WINDOWS, REF, YEAR


# What the contract features read; also the order in which equal starts are told apart.
ECONOMICS_INPUT = [
    "start_date", "duration_days", "sum_insured", "area_ha", "premium", "insured_yield",
    "expected_yield", "subsidy", "rate", "coverage_level", "head_count",
]


def with_ref_month(policies: DataFrame) -> DataFrame:
    return policies.withColumn(REF, dates.ref_month(F.col("start_date")))


def _claim_count():
    return F.when(F.col("peril") != NO_CLAIM, 1).otherwise(0)


def _rates(prefix: str, n: int) -> dict:
    """Counts as integers, claim frequency and severity, null without history."""
    policies, claims = F.col(f"ended_policies_{n}d"), F.col(f"ended_claims_{n}d")
    return {
        f"{prefix}_policies_{n}d": policies.cast("bigint"),
        f"{prefix}_claims_{n}d": claims.cast("bigint"),
        f"{prefix}_claim_rate_{n}d": ratio(claims, policies),
        f"{prefix}_severity_{n}d": ratio(F.col(f"ended_indemnity_{n}d"), F.col(f"ended_insured_{n}d")),
    }


def _history_sums(counted) -> dict:
    return {
        "policies": counted,
        "claims": _claim_count(),
        "indemnity": F.col("indemnity"),
        "insured": F.col("sum_insured"),
    }


def place_history(policies: DataFrame) -> DataFrame:
    """Volume, claims, severity, recent openings and dominant peril per place."""
    dated = with_ref_month(policies)
    counted = F.when(F.col("policy_id").isNotNull(), 1).otherwise(0)
    clocks = {
        "ended": Clock("end_date", PLACE_WINDOWS, _history_sums(counted)),
        "opened": Clock("start_date", OPENING_WINDOWS, {"policies": counted}),
    }
    sums = lookback_sums(dated, ["area_id"], REF, clocks)
    known = F.col("area_id").isNotNull()
    metrics = {name: F.when(known, c) for n in PLACE_WINDOWS for name, c in _rates("place", n).items()}
    openings = {f"place_opened_{n}d": F.col(f"opened_policies_{n}d").cast("bigint") for n in OPENING_WINDOWS}
    table = sums.select(REF, "area_id", *[c.alias(n) for n, c in {**metrics, **openings}.items()])
    claimed = dated.filter(F.col("peril") != NO_CLAIM)
    peril = dominant_category(claimed, ["area_id"], REF, "end_date", "peril", YEAR, "place_dominant_peril_365d")
    return table.join(peril, [REF, "area_id"], "left")


def market_risk(policies: DataFrame, null_when_empty: bool = False) -> DataFrame:
    """State x crop group: volume, claims, severity, mean cover, insurer concentration.

    Without history the concentration is 1.0, or null with ``null_when_empty``.
    """
    keys = ["state", "crop_group"]
    dated = with_ref_month(policies)
    sums = {
        **_history_sums(F.lit(1)),
        "cover": F.col("coverage_level"),
        "covered": F.when(F.col("coverage_level").isNotNull(), 1).otherwise(0),
    }
    wide = lookback_sums(dated, keys, REF, {"ended": Clock("end_date", MARKET_WINDOWS, sums)})
    columns = {name: c for n in MARKET_WINDOWS for name, c in _rates("market", n).items()}
    columns["market_mean_coverage_365d"] = ratio(F.col("ended_cover_365d"), F.col("ended_covered_365d"))
    table = wide.select(REF, *keys, *[c.alias(n) for n, c in columns.items()])
    hhi = market_concentration(dated, keys, REF, "end_date", "insurer", YEAR, "market_insurer_hhi_365d")
    joined = table.join(hhi, [REF, *keys], "left")
    if null_when_empty:
        return joined
    known = F.col("state").isNotNull() & F.col("crop_group").isNotNull() & F.col(REF).isNotNull()
    filled = F.when(known, F.coalesce("market_insurer_hhi_365d", F.lit(1.0)))
    return joined.withColumn("market_insurer_hhi_365d", filled)


def policy_economics(policies: DataFrame) -> DataFrame:
    """Contract features known on the start day, one row per (policy, month)."""
    dated = with_ref_month(policies).select("policy_id", REF, *ECONOMICS_INPUT)
    one = first_per_key(dated, ["policy_id", REF], [F.col("start_date").asc()])
    start = F.col("start_date")
    return one.select(
        "policy_id",
        REF,
        F.month(start).alias("start_month"),
        F.quarter(start).alias("start_quarter"),
        F.year(start).alias("start_year"),
        "duration_days",
        dates.relative_duration(F.col("duration_days")).alias("relative_duration"),
        dates.summer_flag(start).alias("summer_season"),
        ratio(F.col("sum_insured"), F.col("area_ha")).alias("insured_per_ha"),
        ratio(F.col("premium"), F.col("area_ha")).alias("premium_per_ha"),
        ratio(F.col("insured_yield"), F.col("expected_yield")).alias("yield_cover_ratio"),
        ratio(F.col("subsidy"), F.col("premium")).alias("subsidy_ratio"),
        F.col("rate").alias("policy_rate"),
        F.col("coverage_level").alias("policy_coverage"),
        F.when(F.col("head_count") > 0, ratio(F.col("area_ha"), F.col("head_count"))).alias("area_per_head"),
    )


def insurer_risk(policies: DataFrame) -> DataFrame:
    """Insurer x crop group: volume, claim frequency, severity over a year."""
    keys = ["insurer", "crop_group"]
    clock = Clock("end_date", [YEAR], _history_sums(F.lit(1)))
    sums = lookback_sums(with_ref_month(policies), keys, REF, {"ended": clock}, many=True)
    columns = _rates("insurer", YEAR)
    columns.pop("insurer_claims_365d")
    return sums.select(REF, *keys, *[c.alias(n) for n, c in columns.items()])


def rate_reference(policies: DataFrame) -> DataFrame:
    """Crop x state: count, mean and sample deviation of the rate over a year."""
    priced = with_ref_month(policies.filter(F.col("rate").isNotNull()))
    spread = lookback_spread(priced, ["crop", "state"], REF, "end_date", "rate", YEAR)
    return spread.select(
        REF,
        "crop",
        "state",
        F.col("n_rows").cast("bigint").alias("rate_policies_365d"),
        F.col("mean").alias("rate_mean_365d"),
        F.col("std").alias("rate_std_365d"),
    )


def portfolio(policies: DataFrame, scope: str = "active") -> DataFrame:
    """Insurer x place: share of the insurer's insured sum, and its concentration."""
    dated = with_ref_month(policies)
    out = portfolio_concentration(dated, "insurer", "area_id", REF, "end_date", "sum_insured", YEAR, scope)
    return out.withColumnsRenamed({"place_share": "portfolio_share_365d", "portfolio_hhi": "portfolio_hhi_365d"})


@dataclass(frozen=True)
class FeatureTable:
    """A feature table's builder and its primary key."""

    build: Callable[[DataFrame], DataFrame]
    key: tuple[str, ...]


REGISTRY: dict[str, FeatureTable] = {
    "place_history": FeatureTable(place_history, (REF, "area_id")),
    "market_risk": FeatureTable(market_risk, (REF, "state", "crop_group")),
    "policy_economics": FeatureTable(policy_economics, (REF, "policy_id")),
    "insurer_risk": FeatureTable(insurer_risk, (REF, "insurer", "crop_group")),
    "rate_reference": FeatureTable(rate_reference, (REF, "crop", "state")),
    "portfolio": FeatureTable(portfolio, (REF, "insurer", "area_id")),
}


def feature_table(name: str) -> FeatureTable:
    """Look a feature table up; an unknown name is an error that lists the choices."""
    if name not in REGISTRY:
        raise ValueError(f"unknown feature table {name!r}; choose one of {sorted(REGISTRY)}")
    return REGISTRY[name]
