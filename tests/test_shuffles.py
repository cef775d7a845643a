"""What queries shuffle, write and read again, seen in their plans."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from checks.tables import policies
from fieldmark.ml import preparation
from fieldmark.operators.concentration import market_concentration, portfolio_concentration
from fieldmark.operators.lookback import Clock, lookback_sums, running_views
from fieldmark.plans import dataset


def below(plan: str, mark: str) -> str:
    """The lines of a printed plan below the first one that holds ``mark``."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if mark in line)

    def depth(line: str) -> int:
        return next(i for i, c in enumerate(line) if c.isalpha())

    deeper = []
    for line in lines[at + 1 :]:
        if depth(line) <= depth(lines[at]):
            break
        deeper.append(line)
    return "\n".join(deeper)


def test_lines_are_not_shuffled_by_the_customer(spark, sf_dir):
    table = policies(spark, sf_dir, ["policy_id", "place_name", "crop", "state"])
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    side = below(plan, "Join Inner, (o_custkey")
    assert "o_orderkey" in side and "l_orderkey" not in side


def test_slot_sums_read_the_raw_table_once(spark, sf_dir, monkeypatch):
    from checks import wider_queries

    seen = []
    fit = preparation.fit
    monkeypatch.setattr(preparation, "fit", lambda df, *given, **named: seen.append(df) or fit(df, *given, **named))
    wider_queries.CHECKS["m4_slot_sums"].query(spark, sf_dir)
    assert seen and all("/raw-" in f for f in seen[0].inputFiles())


def test_a_single_large_table_is_looked_up_by_its_key(spark):
    spine = spark.range(20).select(F.col("id").cast("string").alias("policy_id"), (F.col("id") % 7).alias("k"))
    table = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = dataset.lookup(spine, {"t": table}, {"t": ("k",)})
        assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
        assert not found.inputFiles()
        assert {(r.k, r.x) for r in found.collect()} == {(k, 2 * k if k < 5 else None) for k in range(7)}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_market_concentration_counts_before_it_makes_changes(spark):
    rng = random.Random(7)
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(900)]
    months = [dt.date(2020 + m // 12, m % 12 + 1, 1) for m in range(36)]
    rows = [
        (rng.choice("ab"), rng.choice(["x", "y", "z", None]), rng.choice(months), rng.choice([*days, None])) for _ in range(400)
    ]
    df = spark.createDataFrame(rows, "k string, m string, ref date, d date")
    out = market_concentration(df, ["k"], "ref", "d", "m", 365, "hhi")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # Both changes of a policy come out of one counted row.
    assert "_leave" in next(line for line in plan.splitlines() if "Aggregate" in line and "_enter" in line)
    want = {}
    for k, ref in {(r[0], r[2]) for r in rows}:
        seen = Counter(r[1] for r in rows if r[0] == k and r[3] and ref - dt.timedelta(days=365) <= r[3] < ref)
        n = sum(seen.values())
        want[k, ref] = sum(c * c for c in seen.values()) / n**2 if n else None
    assert {(r.k, r.ref): r.hhi for r in out.collect()} == pytest.approx(want)


def test_the_widest_table_is_looked_up_last_and_its_columns_are_shuffled_once(spark):
    spine = spark.range(20).select(F.col("id").alias("policy_id"), (F.col("id") % 7).alias("k"))
    narrow = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    wide = spark.range(9).select(F.col("id").alias("policy_id"), *[(F.col("id") + i).alias(f"w{i}") for i in range(3)])
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = dataset.lookup(spine, {"wide": wide, "narrow": narrow}, {"wide": ("policy_id",), "narrow": ("k",)})
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Join ") == 2 and not found.inputFiles()
        assert "w0" not in below(plan, next(line for line in plan.splitlines() if "Join LeftOuter, (k" in line))
        assert found.columns == ["policy_id", "k", "w0", "w1", "w2", "x"]
        want = {(i, i % 7, i if i < 9 else None, 2 * (i % 7) if i % 7 < 5 else None) for i in range(20)}
        assert {(r.policy_id, r.k, r.w0, r.x) for r in found.collect()} == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_lookups_write_no_table_with_a_row_per_policy(spark, sf_dir, tmp_path):
    held = policies(spark, sf_dir)
    tables = dataset.lookup_tables(held, str(tmp_path))
    assert list(tables) == list(dataset.REGISTRY)
    assert sorted(p.name for p in tmp_path.iterdir()) == sorted(set(tables) - {"policy_economics"})
    # The lookup's bound reaches the scan, below the choice of one row a key.
    early = dataset.in_time(tables["policy_economics"], "1996-01-01")
    plan = early._jdf.queryExecution().optimizedPlan().toString()
    assert "1996-01-01" in below(plan, "Window")


def test_changes_are_sorted_by_a_hash_before_the_names(spark, sf_dir):
    held = policies(spark, sf_dir, ["state", "crop_group", "insurer", "start_date", "end_date"])
    dated = held.withColumn("ref", F.trunc("start_date", "MM"))
    table = market_concentration(dated, ["state", "crop_group"], "ref", "end_date", "insurer", 365, "hhi")
    plan = table._jdf.queryExecution().executedPlan().toString()
    sorts = [line for line in plan.splitlines() if "Sort [" in line and "_member" in line]
    assert sorts and all("Sort [_spot" in line for line in sorts)
    assert not any("_spot" in line for line in plan.splitlines() if "Exchange" in line)


def _odd_rows(spark, n=500):
    rng = random.Random(3)
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(900)]
    months = [dt.date(2020 + m // 12, m % 12 + 1, 1) for m in range(36)]
    rows = [
        (rng.choice(["a", "b", None]), rng.choice([1, 2, 3, None]), rng.choice([*months, None]), rng.choice([*days, None]),
         rng.choice([1.5, 2.0, -4.0, None]))
        for _ in range(n)
    ]
    return spark.createDataFrame([*rows, *rows[:50]], "h string, p int, m date, d date, x double")


def exchanges(df):
    # Of a plan that has not run, which holds each exchange once.
    return [line for line in df.select("*")._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]


def test_many_entities_are_dealt_out_before_probes_and_events_are_made(spark):
    rows = _odd_rows(spark)
    clocks = {
        "ended": Clock("d", [90, 365, None], {"n": F.lit(1), "x": F.col("x")}),
        "opened": Clock("m", [30], {"n": F.when(F.col("p").isNotNull(), 1).otherwise(0)}),
    }
    few, many = (lookback_sums(rows, ["h", "p"], "m", clocks, many=m) for m in (False, True))
    assert few.columns == many.columns
    assert sorted(map(tuple, many.collect()), key=repr) == sorted(map(tuple, few.collect()), key=repr)
    assert any("_kind" in line for line in exchanges(few)) and len(exchanges(many)) == 2
    assert not any("_kind" in line for line in exchanges(many))


def test_the_months_of_a_book_are_not_shuffled(spark):
    rows = _odd_rows(spark).filter("h IS NOT NULL AND p IS NOT NULL")
    apart, near = (running_views(rows, ["h", "p"], "m", "d", 365, F.col("x"), near=n) for n in ((), ["h"]))
    assert sorted(map(tuple, near.collect()), key=repr) == sorted(map(tuple, apart.collect()), key=repr)
    totals = near.groupBy("m", "h").agg(F.sum("value").alias("v"))
    assert len(exchanges(totals)) == len(exchanges(near)) == 2
    book = portfolio_concentration(rows, "h", "p", "m", "d", "x", 365, "book")
    plan = book._jdf.queryExecution().executedPlan().toString()
    # The place goes into no exchange as a month of the book: only cells and rows do.
    assert "_held" in plan and not any("_held" in line for line in exchanges(book))
