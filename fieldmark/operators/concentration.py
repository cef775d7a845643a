"""Dominant category, market share and Herfindahl concentration."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from fieldmark.functions.numbers import ratio
from fieldmark.operators.dedup import first_per_key
from fieldmark.operators.lookback import Clock, all_present, lookback_sums, monthly_views, running_views


def dominant_category(
    policies: DataFrame, keys: Sequence[str], ref: str, day: str, category: str, window: int, target: str
) -> DataFrame:
    """Most frequent category per (ref, keys) over the lookback; ties go to the smaller name."""
    present = policies.filter(all_present([*keys, category]))
    counts = monthly_views(present, [*keys, category], ref, day, window, {"n": F.lit(1)})
    top = first_per_key(counts, [ref, *keys], [F.col("n").desc(), F.col(category).asc()])
    return top.select(ref, *keys, F.col(category).alias(target))


def market_concentration(
    policies: DataFrame, keys: Sequence[str], ref: str, day: str, member: str, window: int, target: str
) -> DataFrame:
    """Sum of squared row shares of ``member`` at each (ref, keys); null without history.

    A row enters the count of its member in the first month after ``day`` and
    leaves once ``window`` days have passed.  Counts are whole numbers, so the
    sum of squares can be carried exactly from one change to the next: policies of
    equal months are counted first, on the map side, and what is left gives two
    changes a row, instead of one row for every month that sees it.
    """
    whole = "decimal(19,0)"
    leave = F.add_months(F.trunc(F.date_add(F.col(day), window), "MM"), 1)
    enter = F.add_months(F.trunc(F.col(day), "MM"), 1)
    known = all_present([*keys, day])

    def entry(member, enter, leave, probe: bool):
        return F.struct(member.alias("_member"), enter.alias("_enter"), leave.alias("_leave"), F.lit(probe).alias("_probe"))

    # A probe belongs to the market, not to one of its members.
    nobody = F.lit(None).cast(policies.schema[member].dataType)
    entries = F.array(
        entry(nobody, F.col(ref), F.lit(None).cast("date"), True),
        entry(F.col(member), F.when(known, enter), F.when(known, leave), False),
    )
    stacked = policies.select(*keys, F.inline(entries)).filter(F.col("_probe") | F.col("_enter").isNotNull())
    counted = stacked.groupBy(*keys, "_member", "_probe", "_enter", "_leave").agg(F.count("*").alias("_n"))
    changes = F.when(
        F.col("_probe"), F.array(F.struct(F.col("_enter").alias("_month"), F.lit(0).cast("bigint").alias("_change")))
    ).otherwise(
        F.array(
            F.struct(F.col("_enter").alias("_month"), F.col("_n").alias("_change")),
            F.struct(F.col("_leave").alias("_month"), (-F.col("_n")).alias("_change")),
        )
    )
    # Dealt out by member before it becomes changes, so that half as many rows are shuffled.
    of_member = [*keys, "_member", "_probe"]
    spot = F.xxhash64(*of_member).alias("_spot")
    per_member = counted.repartition(*of_member).select(spot, *of_member, F.inline(changes))
    # after^2 - before^2 = change * (after + before), and before = after - change.  Over the rows of a month these
    # differences add up to the month's own, in whatever order the rows come.
    # The hash goes first so that the sort seldom compares names; rows of equal hashes are still told apart by them.
    by_month = W.partitionBy("_spot", *of_member).orderBy("_month")
    running = F.sum("_change").over(by_month.rowsBetween(W.unboundedPreceding, W.currentRow))
    step = F.col("_change").cast(whole) * (running * 2 - F.col("_change")).cast(whole)
    squares = per_member.select(*keys, "_probe", "_month", "_change", step.alias("_squares"))
    per_market = squares.groupBy(*keys, "_probe", "_month").agg(
        F.sum("_change").alias("_change"), F.sum("_squares").alias("_squares")
    )
    so_far = W.partitionBy(*keys).orderBy("_month").rangeBetween(W.unboundedPreceding, W.currentRow)
    totals = per_market.select(
        F.col("_month").alias(ref),
        *keys,
        "_probe",
        F.sum("_change").over(so_far).cast("double").alias("_n"),
        F.sum("_squares").over(so_far).cast("double").alias("_sq"),
    )
    return totals.filter("_probe").select(ref, *keys, ratio(F.col("_sq"), F.col("_n") * F.col("_n")).alias(target))


def portfolio_concentration(
    policies: DataFrame,
    holder: str,
    place: str,
    ref: str,
    day: str,
    amount: str,
    window: int,
    scope: str = "active",
) -> DataFrame:
    """Share of a place in the holder's insured sum, and the holder's concentration.

    ``scope='active'`` measures against the places where the holder starts a
    policy in that month; ``scope='book'`` against all places with history.
    """
    clocks = {"ended": Clock(day, [window], {"amount": F.col(amount)})}
    held = lookback_sums(policies, [holder, place], ref, clocks, many=True).withColumnRenamed(f"ended_amount_{window}d", "amount")
    if scope == "active":
        group = W.partitionBy(ref, holder)
        shares = held.withColumn("place_share", ratio(F.col("amount"), F.sum("amount").over(group)))
        squared = F.col("place_share") * F.col("place_share")
        out = shares.withColumn("portfolio_hhi", F.sum(squared).over(group))
    elif scope == "book":
        present = policies.filter(all_present([holder, place]))
        # A holder's cells, bounded by places x calendar, come together; the months that they become are not shuffled.
        book = running_views(present, [holder, place], ref, day, window, F.col(amount), near=[holder])
        book = book.withColumnRenamed("value", "amount")
        total = F.sum("amount")
        whole = book.groupBy(ref, holder).agg(
            total.alias("_total"),
            ratio(F.sum(F.col("amount") * F.col("amount")), total * total).alias("portfolio_hhi"),
        )
        joined = held.join(whole, [ref, holder], "left")
        out = joined.withColumn("place_share", ratio(F.col("amount"), F.col("_total")))
    else:
        raise ValueError(f"unknown scope: {scope!r}; use 'active' or 'book'")
    # A missing holder matches no group total, so it gets no row.
    return out.filter(F.col(holder).isNotNull()).select(ref, holder, place, "place_share", "portfolio_hhi")
