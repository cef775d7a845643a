"""Running sums in a global order, without ordering a table or a group in one task.

Rows are sorted by range over (group, order) and written, which fixes each row's
range.  Sums are then taken inside the ranges, and every range starts from the
totals of those before it: the only rows that come together for a whole group are
its totals by range, as many as there are shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fieldmark.session import written


def equal_keys(keys: Sequence[str], renamed: Mapping[str, str]) -> Column:
    """Join condition under which a null key equals a null key."""
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(renamed[key]))
    return same


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on group columns, null groups included; the keys come from the left side."""
    renamed = {k: f"_key_{i}" for i, k in enumerate(keys)}
    other = right.select(*[F.col(k).alias(renamed[k]) for k in keys], *[c for c in right.columns if c not in keys])
    return left.join(other, equal_keys(keys, renamed), how).drop(*renamed.values())


def with_running_sums(
    df: DataFrame,
    order: Sequence[Column],
    sums: Mapping[str, str],
    by: Sequence[str] = (),
    totals: Mapping[str, str] | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """Add running sums of the columns of ``sums`` (new name to column) in the given order per group.

    Rows that the order does not tell apart share a sum.  ``totals`` (new name to
    column) adds the sums of whole groups.  A null group is a group; null values
    count as nothing.  ``ranges`` changes how the work is cut, not the result.
    """
    totals = dict(totals or {})
    spots = [*[F.col(c).asc_nulls_first() for c in by], *order]
    dealt = df.repartitionByRange(ranges, *spots) if ranges else df.repartitionByRange(*spots)
    placed = written(dealt.withColumn("_range", F.spark_partition_id()), "ranges")

    columns = list(dict.fromkeys([*sums.values(), *totals.values()]))
    held = {c: f"_held_{i}" for i, c in enumerate(columns)}
    whole = W.partitionBy(*by)
    before = whole.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    by_range = placed.groupBy(*by, "_range").agg(*[F.sum(c).alias(h) for c, h in held.items()])
    bases = by_range.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(held[c]).over(before), F.lit(0)).alias(f"_before_{held[c]}") for c in set(sums.values())],
        *[F.sum(held[c]).over(whole).alias(name) for name, c in totals.items()],
    )
    inside = W.partitionBy(*by, "_range").orderBy(*order)
    running = placed.withColumns({name: F.coalesce(F.sum(c).over(inside), F.lit(0)) for name, c in sums.items()})
    joined = join_groups(running, bases, [*by, "_range"])
    return joined.select(
        *df.columns,
        *[(F.col(name) + F.col(f"_before_{held[c]}")).alias(name) for name, c in sums.items()],
        *totals,
    )
