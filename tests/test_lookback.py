"""Edges of the lookback and its independence from anything at or after the month."""

import datetime as dt
import random
import statistics

import pytest
from pyspark.sql import functions as F

from fieldmark.operators.lookback import Clock, lookback_sums
from fieldmark.plans import features

D = dt.date
FIELDS = (
    "policy_id string, start_date date, end_date date, area_id int, state string, crop_group string, crop string, "
    "insurer string, peril string, sum_insured double, indemnity double, coverage_level double, rate double"
)


def policy(n, start, end, area=1, state="S", group="g", crop="c", insurer="i", peril="none", insured=100.0, paid=0.0,
           cover=0.5, rate=0.1):
    return (f"p{n}", start, end, area, state, group, crop, insurer, peril, insured, paid, cover, rate)


def frame(spark, rows):
    return spark.createDataFrame(rows, FIELDS)


REF = D(2020, 3, 1)
PROBE = policy(0, D(2020, 3, 15), D(2021, 1, 1))


def place_row(spark, rows):
    table = features.place_history(frame(spark, [PROBE, *rows]))
    return table.filter(F.col("ref_month") == F.lit(REF)).filter("area_id = 1").first()


def ended(n, end, **kw):
    return policy(n, D(2010, 1, 5), end, **kw)


@pytest.mark.parametrize("days", [90, 365, 730, 1095])
def test_frame_edges(spark, days):
    rows = [ended(i, REF - dt.timedelta(days=d)) for i, d in enumerate((0, 1, days, days + 1), start=1)]
    row = place_row(spark, rows)
    # The reference day and the day before the frame are out; both ends of the frame are in.
    assert row[f"place_policies_{days}d"] == 2


def test_no_history(spark):
    row = place_row(spark, [])
    assert row.place_policies_365d == 0 and row.place_claims_365d == 0
    assert row.place_claim_rate_365d is None and row.place_severity_365d is None
    assert row.place_opened_90d == 0 and row.place_dominant_peril_365d is None


def test_zero_insured_gives_null_severity(spark):
    row = place_row(spark, [ended(1, D(2020, 2, 1), insured=0.0, paid=5.0)])
    assert row.place_policies_90d == 1 and row.place_severity_90d is None


def test_openings_exclude_own_month(spark):
    rows = [policy(1, D(2020, 2, 29), D(2022, 1, 1)), policy(2, D(2020, 1, 20), D(2022, 1, 1)),
            policy(3, D(2020, 3, 1), D(2022, 1, 1))]
    row = place_row(spark, rows)
    assert (row.place_opened_30d, row.place_opened_90d) == (1, 2)


def test_dominant_peril_tie_goes_to_smaller_name(spark):
    rows = [ended(1, D(2020, 1, 1), peril="hail"), ended(2, D(2020, 1, 2), peril="drought"), ended(3, D(2020, 1, 3))]
    assert place_row(spark, rows).place_dominant_peril_365d == "drought"


def test_market_concentration(spark):
    rows = [PROBE, ended(1, D(2020, 1, 1), insurer="a"), ended(2, D(2020, 2, 1), insurer="b"),
            ended(3, D(2020, 2, 2), insurer="b"), ended(4, D(2019, 2, 28), insurer="z"), ended(5, REF, insurer="z")]
    held = frame(spark, rows)
    row = features.market_risk(held).filter(F.col("ref_month") == F.lit(REF)).first()
    assert row.market_insurer_hhi_365d == pytest.approx((1 + 4) / 9)
    first = features.market_risk(held).filter("ref_month = '2010-01-01'").first()
    assert first.market_insurer_hhi_365d == 1.0
    empty = features.market_risk(held, null_when_empty=True).filter("ref_month = '2010-01-01'").first()
    assert empty.market_insurer_hhi_365d is None


def test_rate_spread(spark):
    one = [PROBE, ended(1, D(2020, 1, 1), rate=0.3)]
    row = features.rate_reference(frame(spark, one)).filter(F.col("ref_month") == F.lit(REF)).first()
    assert (row.rate_policies_365d, row.rate_mean_365d, row.rate_std_365d) == (1, 0.3, None)
    rates = [0.1, 0.1, 0.1000001, 0.9]
    many = [PROBE, *[ended(i, D(2020, 1, 1 + i), rate=r) for i, r in enumerate(rates)]]
    row = features.rate_reference(frame(spark, many)).filter(F.col("ref_month") == F.lit(REF)).first()
    assert row.rate_std_365d == pytest.approx(statistics.stdev(rates), rel=1e-12)
    same = [PROBE, *[ended(i, D(2020, 1, 1 + i), rate=0.07) for i in range(3)], ended(9, D(2012, 1, 1), rate=0.04)]
    row = features.rate_reference(frame(spark, same)).filter(F.col("ref_month") == F.lit(REF)).first()
    assert row.rate_std_365d == 0.0


def test_portfolio_scopes(spark):
    rows = [PROBE, ended(1, D(2020, 1, 1), insured=30.0), ended(2, D(2020, 1, 1), area=2, insured=70.0)]
    held = frame(spark, rows)
    active = features.portfolio(held).filter(F.col("ref_month") == F.lit(REF)).first()
    assert (active.portfolio_share_365d, active.portfolio_hhi_365d) == (1.0, 1.0)
    book = features.portfolio(held, scope="book").filter(F.col("ref_month") == F.lit(REF)).first()
    assert book.portfolio_share_365d == pytest.approx(0.3)
    assert book.portfolio_hhi_365d == pytest.approx(0.09 + 0.49)
    with pytest.raises(ValueError):
        features.portfolio(held, scope="other")


def test_missing_entity_matches_nothing(spark):
    rows = [policy(1, D(2020, 3, 2), D(2021, 1, 1), area=None), ended(2, D(2020, 1, 1), area=None)]
    table = features.place_history(frame(spark, rows)).filter("area_id IS NULL")
    assert {r.place_policies_365d for r in table.collect()} == {None}


def test_future_does_not_change_features(spark):
    rng = random.Random(3)
    base = D(2018, 1, 1)

    def some(n):
        start = base + dt.timedelta(days=rng.randrange(900))
        return policy(n, start, start + dt.timedelta(days=rng.randrange(20, 400)), area=rng.randrange(3),
                      state=rng.choice("AB"), insurer=rng.choice("xyz"), peril=rng.choice(["none", "hail", "dry"]),
                      insured=float(rng.randrange(1, 50)), paid=float(rng.randrange(9)), rate=rng.random())

    rows = [some(n) for n in range(300)]
    ref = D(2019, 6, 1)
    changed = [r if r[2] < ref else (*r[:8], "flood", r[9] + 7, r[10] + 3, 0.9, 0.9) for r in rows]
    for name, table in features.REGISTRY.items():
        if name == "policy_economics":
            continue
        before, after = (
            sorted(map(repr, table.build(frame(spark, r)).filter(F.col("ref_month") <= F.lit(ref)).collect()))
            for r in (rows, changed)
        )
        assert before == after, name


def test_against_brute_force(spark):
    rng = random.Random(7)
    rows = [
        policy(n, D(2019, 1, 1) + dt.timedelta(days=rng.randrange(800)), D(2019, 1, 1) + dt.timedelta(days=rng.randrange(900)),
               area=rng.choice([1, 1, 1, 2]), insured=float(rng.randrange(100)))
        for n in range(400)
    ]
    held = features.with_ref_month(frame(spark, rows))
    windows = [1, 30, 31, 59, 365, 366]
    got = lookback_sums(held, ["area_id"], "ref_month", {"e": Clock("end_date", windows, {"s": F.col("sum_insured")})})
    for r in got.collect():
        for n in windows:
            want = sum(x[9] for x in rows if x[3] == r.area_id and r.ref_month - dt.timedelta(days=n) <= x[2] < r.ref_month)
            assert r[f"e_s_{n}d"] == want


def test_policy_economics_edges(spark):
    fields = "policy_id string, " + ", ".join(
        f"{c} {'date' if c == 'start_date' else 'int' if c in ('duration_days', 'head_count') else 'double'}"
        for c in features.ECONOMICS_INPUT
    )
    head = ("a", D(2020, 1, 9), 124, 10.0, 0.0, 5.0, 1.0, 0.0, 2.0, 0.1, 0.7, 0)
    later = ("a", D(2020, 1, 20), 1, 99.0, 1.0, 5.0, 1.0, 1.0, 2.0, 0.1, 0.7, 4)
    rows = features.policy_economics(spark.createDataFrame([later, head], fields)).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.insured_per_ha, row.yield_cover_ratio, row.area_per_head) == (None, None, None)
    assert row.summer_season == 1 and row.subsidy_ratio == 0.4
    # A plain double, not a six-digit decimal.
    assert row.relative_duration == 124 / 365


def test_unknown_feature_table():
    with pytest.raises(ValueError, match="place_history"):
        features.feature_table("nope")


def test_running_views_equal_repeated_cells(spark):
    from fieldmark.operators.concentration import portfolio_concentration
    from fieldmark.operators.lookback import monthly_views, running_views

    rng = random.Random(5)
    rows = [
        (rng.choice("ab"), rng.randrange(3), f"20{rng.randrange(10, 16)}-{rng.randrange(1, 13):02d}-{rng.randrange(1, 29):02d}",
         None if rng.random() < 0.2 else float(rng.randrange(1000)))
        for _ in range(300)
    ] + [("c", 1, "2012-02-29", 1.0), ("c", 1, "2012-12-31", None), ("c", 1, "2015-01-31", 4.0), ("d", 1, None, 4.0)]
    df = spark.createDataFrame(rows, "h string, p int, d string, x double").withColumn("d", F.col("d").cast("date"))
    got = running_views(df, ["h", "p"], "m", "d", 365, F.col("x")).select("m", "h", "p", "value").collect()
    want = monthly_views(df, ["h", "p"], "m", "d", 365, {"value": F.col("x")}).select("m", "h", "p", "value").collect()
    assert len(got) == len(set(got)) and set(got) == set(want)
    dated = df.withColumn("ref", F.trunc("d", "MM"))
    plan = portfolio_concentration(dated, "h", "p", "ref", "d", "x", 365, "book")._jdf.queryExecution().optimizedPlan().toString()
    # Months are not repeated for every cell and summed again.
    assert "collect_list" in plan
