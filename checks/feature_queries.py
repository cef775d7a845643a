"""Feature tables and their parts.  The SQL side is the plain range self-join."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.spec import Check, digits
from checks.tables import on_policy, policies
from fieldmark.operators.concentration import dominant_category
from fieldmark.operators.lookback import Clock, lookback_sums
from fieldmark.plans import features
from fieldmark.plans.schema import MARKET_WINDOWS, OPENING_WINDOWS, PLACE_WINDOWS, REF

MONTH = "CAST(date_trunc('month', start_date) AS DATE)"


def mesh(*keys: str) -> str:
    return f"mesh AS (SELECT DISTINCT {MONTH} AS ref_month, {', '.join(keys)} FROM policy)"


def on_keys(*keys: str) -> str:
    return " AND ".join(f"h.{k} = m.{k}" for k in keys)


def seen(n: int) -> str:
    return f"h.end_date >= m.ref_month - {n} AND h.end_date < m.ref_month"


def rates_sql(prefix: str, n: int, counted: str = "1") -> str:
    w = seen(n)
    policies_n = f"count(CASE WHEN {w} THEN {counted} END)"
    claims_n = f"count(CASE WHEN {w} AND h.peril <> 'none' THEN 1 END)"
    return f"""
  {policies_n} AS {prefix}_policies_{n}d,
  {claims_n} AS {prefix}_claims_{n}d,
  {claims_n} * 1e0 / nullif({policies_n}, 0) AS {prefix}_claim_rate_{n}d,
  sum(CASE WHEN {w} THEN h.indemnity ELSE 0 END)
    / nullif(sum(CASE WHEN {w} THEN h.sum_insured ELSE 0 END), 0) AS {prefix}_severity_{n}d"""


def group_by_key(*keys: str) -> str:
    return "GROUP BY " + ", ".join(f"m.{k}" for k in ("ref_month", *keys))


PLACE_AGG = f"""place_agg AS (
SELECT m.ref_month, m.area_id, {','.join(rates_sql('place', n, 'h.policy_id') for n in PLACE_WINDOWS)}
FROM mesh m LEFT JOIN policy h ON {on_keys('area_id')} AND h.end_date < m.ref_month
{group_by_key('area_id')})"""

OPENED = "opened AS (SELECT m.ref_month, m.area_id, " + ", ".join(
    f"count(CASE WHEN h.start_date >= m.ref_month - {n} THEN h.policy_id END) AS place_opened_{n}d"
    for n in OPENING_WINDOWS
) + f""" FROM mesh m LEFT JOIN policy h ON {on_keys('area_id')}
  AND h.start_date >= m.ref_month - 90 AND h.start_date < m.ref_month
{group_by_key('area_id')})"""

DOMINANT = f"""counted AS (
SELECT m.ref_month, m.area_id, h.peril, count(*) AS n
FROM mesh m JOIN policy h ON {on_keys('area_id')} AND {seen(365)} AND h.peril <> 'none'
{group_by_key('area_id')}, h.peril),
dominant AS (
SELECT ref_month, area_id, peril AS place_dominant_peril_365d FROM (
  SELECT *, row_number() OVER (PARTITION BY ref_month, area_id ORDER BY n DESC, peril ASC) AS rn FROM counted)
WHERE rn = 1)"""

PLACE_CTES = (mesh("area_id"), PLACE_AGG, OPENED, DOMINANT)
PLACE_BODY = """SELECT a.*, o.* EXCLUDE (ref_month, area_id), d.place_dominant_peril_365d
FROM place_agg a
LEFT JOIN opened o ON o.ref_month = a.ref_month AND o.area_id = a.area_id
LEFT JOIN dominant d ON d.ref_month = a.ref_month AND d.area_id = a.area_id"""

MARKET_CTES = (
    mesh("state", "crop_group"),
    f"""by_insurer AS (
SELECT m.ref_month, m.state, m.crop_group, h.insurer, count(*) AS n
FROM mesh m LEFT JOIN policy h ON {on_keys('state', 'crop_group')} AND {seen(365)}
{group_by_key('state', 'crop_group')}, h.insurer)""",
    """shares AS (
SELECT *, n * 1e0 / sum(n) OVER (PARTITION BY ref_month, state, crop_group) AS share FROM by_insurer)""",
    """hhi AS (
SELECT ref_month, state, crop_group, sum(share * share) AS market_insurer_hhi_365d FROM shares GROUP BY ALL)""",
    f"""market_agg AS (
SELECT m.ref_month, m.state, m.crop_group, {','.join(rates_sql('market', n) for n in MARKET_WINDOWS)},
  avg(CASE WHEN {seen(365)} THEN h.coverage_level END) AS market_mean_coverage_365d
FROM mesh m LEFT JOIN policy h ON {on_keys('state', 'crop_group')}
{group_by_key('state', 'crop_group')})""",
)
MARKET_BODY = "SELECT a.*, hhi.market_insurer_hhi_365d FROM market_agg a JOIN hhi USING (ref_month, state, crop_group)"

INSURER_AGG = f"""SELECT m.ref_month, m.insurer, m.crop_group, {rates_sql('insurer', 365)}
FROM mesh m LEFT JOIN policy h ON {on_keys('insurer', 'crop_group')}
{group_by_key('insurer', 'crop_group')}"""
INSURER_BODY = f"SELECT * EXCLUDE (insurer_claims_365d) FROM (\n{INSURER_AGG})"

RATE_BODY = f"""SELECT m.ref_month, m.crop, m.state,
  count(CASE WHEN {seen(365)} THEN 1 END) AS rate_policies_365d,
  avg(CASE WHEN {seen(365)} THEN h.rate END) AS rate_mean_365d,
  stddev_samp(CASE WHEN {seen(365)} THEN h.rate END) AS rate_std_365d
FROM mesh m LEFT JOIN policy h ON {on_keys('crop', 'state')}
{group_by_key('crop', 'state')}"""

HELD = f"""held AS (
SELECT m.ref_month, m.insurer, m.area_id, sum(CASE WHEN {seen(365)} THEN h.sum_insured ELSE 0 END) AS amount
FROM mesh m LEFT JOIN policy h ON {on_keys('insurer', 'area_id')}
{group_by_key('insurer', 'area_id')})"""

PORTFOLIO_CTES = (
    mesh("insurer", "area_id"),
    HELD,
    "totals AS (SELECT ref_month, insurer, sum(amount) AS total FROM held GROUP BY ALL)",
    """shared AS (
SELECT h.ref_month, h.insurer, h.area_id, h.amount / nullif(t.total, 0) AS portfolio_share_365d
FROM held h JOIN totals t USING (ref_month, insurer))""",
    """portfolio_hhi AS (
SELECT ref_month, insurer, sum(portfolio_share_365d * portfolio_share_365d) AS portfolio_hhi_365d
FROM shared GROUP BY ALL)""",
)
PORTFOLIO_BODY = "SELECT s.*, p.portfolio_hhi_365d FROM shared s JOIN portfolio_hhi p USING (ref_month, insurer)"

BOOK_CTES = (
    mesh("insurer", "area_id"),
    HELD,
    """months AS (SELECT DISTINCT ref_month, insurer FROM mesh)""",
    f"""book AS (
SELECT m.ref_month, m.insurer, h.area_id, sum(h.sum_insured) AS amount
FROM months m JOIN policy h ON h.insurer = m.insurer AND {seen(365)}
GROUP BY ALL)""",
    """whole AS (
SELECT ref_month, insurer, sum(amount) AS total, sum(amount * amount) / (sum(amount) * sum(amount)) AS hhi
FROM book GROUP BY ALL)""",
)
BOOK_BODY = """SELECT h.ref_month, h.insurer, h.area_id,
  h.amount / nullif(w.total, 0) AS portfolio_share_365d, w.hhi AS portfolio_hhi_365d
FROM held h LEFT JOIN whole w ON w.ref_month = h.ref_month AND w.insurer = h.insurer"""

ECONOMICS_ORDER = "start_date, " + ", ".join(["policy_id", "ref_month", *features.ECONOMICS_INPUT])
ECONOMICS_CTE = f"""one AS (
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY policy_id, ref_month ORDER BY {ECONOMICS_ORDER}) AS rn
  FROM (SELECT *, {MONTH} AS ref_month FROM policy))
WHERE rn = 1)"""
ECONOMICS_COLUMNS = """month(start_date) AS start_month, quarter(start_date) AS start_quarter,
  year(start_date) AS start_year, duration_days,
  duration_days / 365e0 AS relative_duration,
  CASE WHEN month(start_date) >= 9 OR month(start_date) = 1 THEN 1 ELSE 0 END AS summer_season,
  sum_insured / nullif(area_ha, 0) AS insured_per_ha,
  premium / nullif(area_ha, 0) AS premium_per_ha,
  insured_yield / nullif(expected_yield, 0) AS yield_cover_ratio,
  subsidy / nullif(premium, 0) AS subsidy_ratio,
  rate AS policy_rate, coverage_level AS policy_coverage,
  CASE WHEN head_count > 0 THEN area_ha / head_count END AS area_per_head"""
ECONOMICS_BODY = f"SELECT policy_id, ref_month, {ECONOMICS_COLUMNS} FROM one"

PLACE_FLOATS = digits(10, *[f"place_{m}_{n}d" for n in PLACE_WINDOWS for m in ("claim_rate", "severity")])
MARKET_FLOATS = digits(
    10,
    *[f"market_{m}_{n}d" for n in MARKET_WINDOWS for m in ("claim_rate", "severity")],
    "market_mean_coverage_365d",
    "market_insurer_hhi_365d",
)
INSURER_FLOATS = digits(10, "insurer_claim_rate_365d", "insurer_severity_365d")
RATE_FLOATS = digits(10, "rate_mean_365d", "rate_std_365d")
PORTFOLIO_FLOATS = digits(10, "portfolio_share_365d", "portfolio_hhi_365d")
ECONOMICS_FLOATS = digits(
    9, "relative_duration", "insured_per_ha", "premium_per_ha", "yield_cover_ratio", "subsidy_ratio",
    "policy_rate", "policy_coverage", "area_per_head",
)

INPUTS = {
    "place_history": ["policy_id", "start_date", "end_date", "area_id", "peril", "indemnity", "sum_insured"],
    "market_risk": [
        "start_date", "end_date", "state", "crop_group", "insurer", "peril", "indemnity", "sum_insured",
        "coverage_level",
    ],
    "policy_economics": ["policy_id", *features.ECONOMICS_INPUT],
    "insurer_risk": ["start_date", "end_date", "insurer", "crop_group", "peril", "indemnity", "sum_insured"],
    "rate_reference": ["start_date", "end_date", "crop", "state", "rate"],
    "portfolio": ["start_date", "end_date", "insurer", "area_id", "sum_insured"],
}


def table(name: str):
    return lambda spark, sf: features.feature_table(name).build(policies(spark, sf, INPUTS[name]))


def picked(name: str, *columns: str):
    """A few columns of a feature table; Catalyst drops the rest of the work."""
    return lambda spark, sf: table(name)(spark, sf).select(*columns)


def _part(name: str, key: list[str], columns: list[str], sql: str, floats: dict) -> Check:
    kept = {c: d for c, d in floats.items() if c in columns}
    body = f"SELECT {', '.join([*key, *columns])} FROM (\n{sql}\n)"
    return Check(picked(name, *key, *columns), body, kept, ["ref_month"])


def _mesh(spark, sf):
    dated = features.with_ref_month(policies(spark, sf, ["start_date", "area_id"]))
    return dated.select(REF, "area_id").distinct()


def _unbounded(spark, sf):
    """All history before the reference month."""
    dated = features.with_ref_month(policies(spark, sf, ["start_date", "end_date", "area_id", "sum_insured"]))
    clock = Clock("end_date", [None], {"n": F.lit(1), "insured": F.col("sum_insured")})
    sums = lookback_sums(dated, ["area_id"], REF, {"ended": clock})
    return sums.select(
        REF, "area_id", F.col("ended_n_all").cast("bigint").alias("n_ended"),
        F.col("ended_insured_all").alias("insured_ended"),
    )


def _dominant(spark, sf):
    dated = features.with_ref_month(policies(spark, sf, ["start_date", "end_date", "area_id", "peril"]))
    claimed = dated.filter(F.col("peril") != "none")
    return dominant_category(claimed, ["area_id"], REF, "end_date", "peril", 365, "place_dominant_peril_365d")


PLACE_SQL = on_policy(PLACE_BODY, *PLACE_CTES)
MARKET_SQL = on_policy(MARKET_BODY, *MARKET_CTES)
INSURER_SQL = on_policy(INSURER_BODY, mesh("insurer", "crop_group"))
RATE_SQL = on_policy(RATE_BODY, mesh("crop", "state"))
PORTFOLIO_SQL = on_policy(PORTFOLIO_BODY, *PORTFOLIO_CTES)
ECONOMICS_SQL = on_policy(ECONOMICS_BODY, ECONOMICS_CTE)

AREA, MARKET, INSURER = ["ref_month", "area_id"], ["ref_month", "state", "crop_group"], ["ref_month", "insurer"]
COUNTS = [f"place_policies_{n}d" for n in PLACE_WINDOWS]
CLAIMS = [f"place_claims_{n}d" for n in PLACE_WINDOWS]

CHECKS = {
    "fs_place_history": Check(table("place_history"), PLACE_SQL, PLACE_FLOATS, ["ref_month"]),
    "fs_market_risk": Check(table("market_risk"), MARKET_SQL, MARKET_FLOATS, ["ref_month"]),
    "fs_policy_economics": Check(table("policy_economics"), ECONOMICS_SQL, ECONOMICS_FLOATS, ["ref_month"]),
    "fs_insurer_risk": Check(table("insurer_risk"), INSURER_SQL, INSURER_FLOATS, ["ref_month"]),
    "fs_rate_reference": Check(table("rate_reference"), RATE_SQL, RATE_FLOATS, ["ref_month"]),
    "fs_portfolio": Check(table("portfolio"), PORTFOLIO_SQL, PORTFOLIO_FLOATS, ["ref_month"]),
    "a1_key_mesh": Check(_mesh, on_policy("SELECT * FROM mesh", mesh("area_id")), dates=["ref_month"]),
    "a2_lookback_count": _part("place_history", AREA, COUNTS, PLACE_SQL, {}),
    "a3_lookback_claims": _part("place_history", AREA, CLAIMS, PLACE_SQL, {}),
    "a4_claim_frequency": _part(
        "insurer_risk", ["ref_month", "insurer", "crop_group"], ["insurer_claim_rate_365d"], INSURER_SQL, INSURER_FLOATS
    ),
    "a5_severity": _part(
        "market_risk", MARKET, ["market_severity_365d", "market_severity_730d"], MARKET_SQL, MARKET_FLOATS
    ),
    "a6_recent_openings": _part("place_history", AREA, ["place_opened_30d", "place_opened_90d"], PLACE_SQL, {}),
    "a7_mean_coverage": _part("market_risk", MARKET, ["market_mean_coverage_365d"], MARKET_SQL, MARKET_FLOATS),
    "a8_rate_spread": Check(table("rate_reference"), RATE_SQL, RATE_FLOATS, ["ref_month"]),
    "a9_dominant_peril": Check(
        lambda spark, sf: _dominant(spark, sf).join(_mesh(spark, sf), [REF, "area_id"]),
        on_policy("SELECT * FROM dominant", mesh("area_id"), DOMINANT),
        dates=["ref_month"],
    ),
    "a10_market_hhi": _part("market_risk", MARKET, ["market_insurer_hhi_365d"], MARKET_SQL, MARKET_FLOATS),
    "a10_market_hhi_null_when_empty": Check(
        lambda spark, sf: features.market_risk(policies(spark, sf, INPUTS["market_risk"]), null_when_empty=True).select(
            *MARKET, "market_insurer_hhi_365d"
        ),
        on_policy(
            "SELECT ref_month, state, crop_group, sum(CASE WHEN insurer IS NOT NULL THEN share * share END)"
            " AS market_insurer_hhi_365d FROM shares GROUP BY ALL",
            *MARKET_CTES[:3],
        ),
        digits(10, "market_insurer_hhi_365d"),
        ["ref_month"],
    ),
    "a11_portfolio_share": _part(
        "portfolio", [*INSURER, "area_id"], ["portfolio_share_365d"], PORTFOLIO_SQL, PORTFOLIO_FLOATS
    ),
    "a11_portfolio_share_book": Check(
        lambda spark, sf: features.portfolio(policies(spark, sf, INPUTS["portfolio"]), scope="book"),
        on_policy(BOOK_BODY, *BOOK_CTES),
        PORTFOLIO_FLOATS,
        ["ref_month"],
    ),
    "a12_portfolio_hhi": Check(
        lambda spark, sf: table("portfolio")(spark, sf).select(*INSURER, "portfolio_hhi_365d").distinct(),
        on_policy("SELECT * FROM portfolio_hhi", *PORTFOLIO_CTES),
        digits(10, "portfolio_hhi_365d"),
        ["ref_month"],
    ),
    "j4_unbounded_history": Check(
        _unbounded,
        on_policy(
            f"""SELECT m.ref_month, m.area_id, count(h.policy_id) AS n_ended,
  coalesce(sum(h.sum_insured), 0) AS insured_ended
FROM mesh m LEFT JOIN policy h ON {on_keys('area_id')} AND h.end_date < m.ref_month
{group_by_key('area_id')}""",
            mesh("area_id"),
        ),
        digits(2, "insured_ended"),
        ["ref_month"],
    ),
    "f9_point_in_time_predicate": _part(
        "place_history", AREA, ["place_policies_90d", "place_claims_1095d"], PLACE_SQL, {}
    ),
    "j5_two_bound_history": _part(
        "place_history", AREA, ["place_opened_90d", "place_dominant_peril_365d"], PLACE_SQL, {}
    ),
    "j6_bounds_in_case": _part(
        "insurer_risk",
        ["ref_month", "insurer", "crop_group"],
        ["insurer_policies_365d", "insurer_severity_365d"],
        INSURER_SQL,
        INSURER_FLOATS,
    ),
    "j7_join_of_aggregates": _part(
        "place_history",
        AREA,
        ["place_policies_365d", "place_opened_30d", "place_dominant_peril_365d"],
        PLACE_SQL,
        {},
    ),
    "j8_detail_to_group_total": _part(
        "portfolio", [*INSURER, "area_id"], ["portfolio_share_365d", "portfolio_hhi_365d"], PORTFOLIO_SQL,
        PORTFOLIO_FLOATS,
    ),
    "w2_one_row_per_policy_month": _part(
        "policy_economics", ["policy_id", "ref_month"], ["start_month", "insured_per_ha"], ECONOMICS_SQL,
        ECONOMICS_FLOATS,
    ),
    "w3_lookback_frame": Check(table("place_history"), PLACE_SQL, PLACE_FLOATS, ["ref_month"]),
}
