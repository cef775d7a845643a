"""N-day history before a reference month, without self-joins.

For every (entity, reference month) the history is the set of rows whose clock
day lies in ``[ref - N, ref - 1]``.  The work is one scan and two shuffles:

1. every policy contributes one probe (entity, its own reference month) and one
   event per clock, from the same scan;
2. events are pre-aggregated per (entity, clock, cell).  A cell is a stretch of
   days that no frame edge can split, so an entity keeps a few rows per month
   however many policies it has; the map side already combines hot entities;
3. a range frame over the day number sums the cells seen from each probe.

What remains after step 2 is bounded by entities x calendar, not by the data.
Where that is no less than the data, since there are about as many entities as
rows (``many``), rows of equal months and cells are put together first and
dealt out by the entity; probes and events are made there, so that not twice
as many rows as policies are shuffled, twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

PROBE = "probe"


@dataclass(frozen=True)
class Clock:
    """A date that places a row in time, the values it carries and the lookbacks in days (None: all history)."""

    day: str
    windows: Sequence[int | None]
    sums: Mapping[str, Column]


def cell_start(day: Column, windows: Sequence[int]) -> Column:
    """Last day on or before ``day`` at which some frame edge falls.

    Frame edges are month starts and month starts minus N days; replacing a day
    by the last edge before it moves it across no frame.
    """
    month = F.trunc(day, "MM")
    edges = [F.date_sub(F.trunc(F.date_add(day, n), "MM"), n) for n in windows if n is not None]
    return F.greatest(month, *edges) if edges else month


def day_number(day: Column) -> Column:
    return F.unix_date(day)


def all_present(columns: Sequence[str]) -> Column:
    present = F.lit(True)
    for c in columns:
        present = present & F.col(c).isNotNull()
    return present


def _stacked(policies: DataFrame, keys: Sequence[str], ref: str, clocks: Mapping[str, Clock]) -> DataFrame:
    """One row per probe and per event: keys, kind, day, values (null elsewhere)."""
    value_names = [f"{kind}_{name}" for kind, clock in clocks.items() for name in clock.sums]

    def entry(kind: str, day: Column, values: Mapping[str, Column]) -> Column:
        filled = [values.get(v, F.lit(None)).cast("double").alias(v) for v in value_names]
        return F.struct(F.lit(kind).alias("_kind"), day.alias("_day"), *filled)

    entries = [entry(PROBE, F.col(ref), {})]
    for kind, clock in clocks.items():
        # A missing entity or day matches no history, so such rows carry no event.
        cell = F.when(all_present(keys), cell_start(F.col(clock.day), clock.windows))
        entries.append(entry(kind, cell, {f"{kind}_{n}": c for n, c in clock.sums.items()}))
    stacked = policies.select(*keys, F.inline(F.array(*entries)))
    return stacked.filter((F.col("_kind") == PROBE) | F.col("_day").isNotNull())


def _dealt(
    policies: DataFrame, keys: Sequence[str], ref: str, clocks: Mapping[str, Clock]
) -> tuple[DataFrame, dict[str, Clock]]:
    """Rows of equal keys, ref and cells added up and dealt out by the keys; an entity keeps at most months x cells."""
    cells = {f"_cell_{kind}": cell_start(F.col(clock.day), clock.windows) for kind, clock in clocks.items()}
    values = {f"_{kind}_{name}": c.cast("double") for kind, clock in clocks.items() for name, c in clock.sums.items()}
    rows = policies.select(*keys, ref, *[c.alias(n) for n, c in {**cells, **values}.items()])
    added = rows.groupBy(*keys, ref, *cells).agg(*[F.sum(n).alias(n) for n in values])
    # The start of a cell is its own start.
    made = {
        kind: Clock(f"_cell_{kind}", clock.windows, {name: F.col(f"_{kind}_{name}") for name in clock.sums})
        for kind, clock in clocks.items()
    }
    return added.repartition(*keys), made


def lookback_sums(
    policies: DataFrame,
    keys: Sequence[str],
    ref: str,
    clocks: Mapping[str, Clock],
    many: bool = False,
) -> DataFrame:
    """Sums over every lookback for each distinct (ref, keys).

    Columns: ``ref``, the keys and ``{clock}_{value}_{N}d`` (``_all`` for all history);
    sums are 0.0 where there is no history.  ``many`` (entities) changes how the work is cut, not the result.
    """
    if many:
        policies, clocks = _dealt(policies, keys, ref, clocks)
    stacked = _stacked(policies, keys, ref, clocks)
    names = [f"{kind}_{name}" for kind, clock in clocks.items() for name in clock.sums]
    cells = stacked.groupBy(*keys, "_kind", "_day").agg(*[F.sum(n).alias(n) for n in names])
    by_day = W.partitionBy(*keys).orderBy(day_number(F.col("_day")))

    def framed_sum(value: str, n: int | None) -> Column:
        frame = by_day.rangeBetween(W.unboundedPreceding if n is None else -n, -1)
        name = f"{value}_all" if n is None else f"{value}_{n}d"
        return F.coalesce(F.sum(value).over(frame), F.lit(0.0)).alias(name)

    framed = [
        framed_sum(f"{kind}_{name}", n)
        for kind, clock in clocks.items()
        for name in clock.sums
        for n in clock.windows
    ]
    seen = cells.select(F.col("_day").alias(ref), *keys, "_kind", *framed)
    return seen.filter(F.col("_kind") == PROBE).drop("_kind")


def lookback_spread(
    policies: DataFrame,
    keys: Sequence[str],
    ref: str,
    day: str,
    value: str,
    window: int,
) -> DataFrame:
    """Count, mean and sample standard deviation of ``value`` over one lookback.

    Cells carry (n, mean, sum of squared deviations).  They are combined around
    the mean of the entity's earliest cell, so no large squares cancel and not
    even the last digit depends on what comes after the reference month.
    """
    stamped = policies.select(
        *keys,
        F.inline(
            F.array(
                F.struct(F.lit(True).alias("_probe"), F.col(ref).alias("_day"), F.lit(None).cast("double").alias("_x")),
                F.struct(
                    F.lit(False).alias("_probe"),
                    F.when(all_present(keys), cell_start(F.col(day), [window])).alias("_day"),
                    F.col(value).cast("double").alias("_x"),
                ),
            )
        ),
    ).filter(F.col("_probe") | (F.col("_day").isNotNull()))
    cells = stamped.groupBy(*keys, "_probe", "_day").agg(
        F.count("_x").alias("_n"),
        F.count(F.when(~F.col("_probe"), 1)).alias("_rows"),
        F.avg("_x").alias("_mean"),
        (F.var_pop("_x") * F.count("_x")).alias("_m2"),
    )
    by_day = W.partitionBy(*keys).orderBy(day_number(F.col("_day")))
    weighted = F.col("_n") * F.col("_mean")
    earliest = F.first("_mean", ignorenulls=True).over(by_day.rangeBetween(W.unboundedPreceding, W.currentRow))
    centred = cells.withColumn("_off", F.col("_mean") - earliest)
    frame = by_day.rangeBetween(-window, -1)
    seen = centred.select(
        F.col("_day").alias(ref),
        *keys,
        "_probe",
        F.coalesce(F.sum("_rows").over(frame), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum("_n").over(frame), F.lit(0)).alias("_n"),
        F.sum(weighted).over(frame).alias("_sum"),
        F.sum(F.col("_n") * F.col("_off")).over(frame).alias("_d1"),
        F.sum(F.col("_m2") + F.col("_n") * F.col("_off") * F.col("_off")).over(frame).alias("_d2"),
    ).filter("_probe")
    n = F.nullif(F.col("_n"), F.lit(0))
    residue = F.col("_d2") - F.col("_d1") * F.col("_d1") / n
    # What is left of equal values after rounding is no spread.
    squares = F.when(residue > F.col("_d2") * 1e-14, residue).otherwise(0.0)
    return seen.select(
        ref,
        *keys,
        "n_rows",
        (F.col("_sum") / n).alias("mean"),
        F.when(F.col("_n") > 1, F.sqrt(squares / F.nullif(F.col("_n") - 1, F.lit(0)))).alias("std"),
    )


def monthly_views(
    policies: DataFrame,
    keys: Sequence[str],
    ref: str,
    day: str,
    window: int,
    sums: Mapping[str, Column],
) -> DataFrame:
    """Sums per (ref, keys) for every month from which some history is visible.

    The other direction of :func:`lookback_sums`, for when the entity is split
    by a category (peril, insurer, place) and probes for every category would be
    needed: pre-aggregated cells are repeated for the months that can see them
    (13 at most for a 365-day window) and summed again.
    """
    known = policies.filter(F.col(day).isNotNull())
    cells = (
        known.select(*keys, cell_start(F.col(day), [window]).alias("_day"), *[c.alias(n) for n, c in sums.items()])
        .groupBy(*keys, "_day")
        .agg(*[F.sum(n).alias(n) for n in sums])
    )
    first = F.add_months(F.trunc("_day", "MM"), 1)
    last = F.trunc(F.date_add("_day", window), "MM")
    months = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month")))
    seen = cells.select(F.explode(months).alias(ref), *keys, *sums)
    return seen.groupBy(ref, *keys).agg(*[F.sum(n).alias(n) for n in sums])


def running_views(
    policies: DataFrame,
    keys: Sequence[str],
    ref: str,
    day: str,
    window: int,
    value: Column,
    near: Sequence[str] = (),
) -> DataFrame:
    """The same sum of one ``value`` without repeating the cells: one shuffle of cells, none of months.

    A cell is answerable for the months from its first one to the one before the next cell's; what these
    see lies in the cells up to it, so a frame that looks back over the window holds it.  A month
    comes once per key, as ``(ref, keys, value)``.  Cells are dealt out by ``near``, some of the keys, if given:
    months of equal ``near`` then need no shuffle to be added up.
    """
    known = policies.filter(F.col(day).isNotNull())
    cells = (
        known.select(*keys, cell_start(F.col(day), [window]).alias("_day"), value.alias("_value"))
        .groupBy(*keys, "_day")
        .agg(F.sum("_value").alias("_value"))
    )
    if near:
        cells = cells.repartition(*near)
    by_day = W.partitionBy(*keys).orderBy(day_number(F.col("_day")))
    first = F.add_months(F.trunc("_day", "MM"), 1)
    last = F.trunc(F.date_add("_day", window), "MM")
    # No month of a cell sees further back than the window before the cell's own day.
    frame = by_day.rangeBetween(-window, 0)
    held = F.collect_list(F.struct("_day", "_value")).over(frame)
    placed = cells.select(
        *keys, first.alias("_first"), last.alias("_last"), held.alias("_held"), F.lead(first).over(by_day).alias("_next")
    )
    until = F.least(F.col("_last"), F.add_months("_next", -1))
    months = F.when(F.col("_first") <= until, F.sequence("_first", until, F.expr("interval 1 month")))
    seen = placed.select(*keys, "_held", F.explode(months).alias(ref))
    inside = F.filter("_held", lambda c: c["_day"] >= F.date_sub(ref, window))
    total = F.aggregate(
        inside, F.lit(None).cast("double"),
        lambda so_far, c: F.coalesce(so_far + c["_value"], so_far, c["_value"].cast("double")),
    )
    return seen.select(ref, *keys, total.alias("value"))
