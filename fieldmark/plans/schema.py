"""Names of the canonical policy table and of the tables built from it."""

from __future__ import annotations

# Order of the canonical (silver) columns.
POLICY_COLUMNS = [
    "policy_id", "start_date", "end_date",
    "area_id", "place_name", "state", "region", "lat", "lon",
    "insurer", "product_type", "crop", "crop_group",
    "area_ha", "head_count", "duration_days",
    "expected_yield", "insured_yield", "coverage_level", "sum_insured", "premium",
    "rate", "subsidy", "indemnity", "peril", "claim", "loss_ratio",
]

# What is known only after the contract ends, and its join keys.
LABEL_KEYS = ["policy_id", "start_date"]
OUTCOME_COLUMNS = ["peril", "indemnity", "claim", "loss_ratio"]
# Names that no model may see: the outcomes, the label made of them and the time axis.
NEVER_FEATURES = [*OUTCOME_COLUMNS, "has_claim", "ref_month"]
LABEL_COLUMNS = LABEL_KEYS + OUTCOME_COLUMNS
FEATURE_COLUMNS = [c for c in POLICY_COLUMNS if c not in OUTCOME_COLUMNS]

NO_CLAIM = "none"
REF = "ref_month"

# Lookback lengths in days.
PLACE_WINDOWS = [90, 365, 730, 1095]
OPENING_WINDOWS = [30, 90]
MARKET_WINDOWS = [365, 730]
YEAR = 365
LONGEST_LOOKBACK = max(*PLACE_WINDOWS, *OPENING_WINDOWS, *MARKET_WINDOWS, YEAR)
