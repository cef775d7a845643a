"""Exact quantiles without sorting the data, gathering a group in one task or shuffling every value.

The doubles' bits, read as whole numbers, are ordered like the values; their upper ``CELL_BITS`` bits cut
the line into cells (256 to a doubling).  A first scan counts rows per group, column and cell, and the
running counts over a column's cells say in which cells the wanted ranks lie.  A second scan counts the
distinct values of those cells alone; running counts over them (see ``prefix``) give the exact value of
each rank.  Both scans count inside their batches, so what is shuffled does not grow with the rows
outside the wanted cells.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from fieldmark.operators.prefix import equal_keys, with_running_sums
from fieldmark.session import written

#: Sign, exponent and eight bits of the fraction.  A column has at most 2^CELL_BITS cells, whatever its rows.
CELL_BITS = 20
_SHIFT = 64 - CELL_BITS
#: Below the cells of all values: where a row without one is counted, as no row.
_NONE = 1 << CELL_BITS


def between(low: Column, high: Column, share: Column) -> Column:
    """Linear interpolation that never leaves its two neighbours."""
    inner = low * (1 - share) + high * share
    return F.when((low == high) | (share <= 0), low).otherwise(F.greatest(F.least(inner, high), low))


def _ordered(values: np.ndarray) -> np.ndarray:
    """Whole numbers ordered as Spark orders the doubles: both zeros alike, NaN last."""
    # Adding zero turns the negative zero into the other one.
    values = values + 0.0
    missing = np.isnan(values)
    if missing.any():
        values[missing] = np.nan
    bits = values.view(np.int64)
    return np.where(bits < 0, bits ^ np.int64(0x7FFF_FFFF_FFFF_FFFF), bits) if (bits < 0).any() else bits


def _values(ordered: np.ndarray) -> np.ndarray:
    return np.where(ordered < 0, ordered ^ np.int64(0x7FFF_FFFF_FFFF_FFFF), ordered).view(np.float64)


def _grouped(batch: pa.RecordBatch, grouped: bool) -> tuple[np.ndarray, pa.Array | None]:
    """A number per row and the group values these numbers stand for."""
    if not grouped:
        return np.zeros(batch.num_rows, np.int64), None
    held = batch.column(0).dictionary_encode(null_encoding="encode")
    return held.indices.to_numpy(zero_copy_only=False).astype(np.int64), held.dictionary


def _counter(columns: int, grouped: bool, wanted: Sequence[np.ndarray] | None, schema: pa.Schema):
    """Counts per group, column and cell; with ``wanted`` cells, per distinct value in these."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            of, groups = _grouped(batch, grouped)
            found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
            for k in range(columns):
                column, present = batch.column(k + grouped), None
                if column.null_count:
                    present = column.is_valid().to_numpy(zero_copy_only=False)
                    column = column.fill_null(0.0)
                points = _ordered(column.to_numpy(zero_copy_only=False))
                if wanted is None:
                    # Group and cell as one number: sorting numbers is faster than sorting places.
                    cells = (points >> _SHIFT) + _NONE
                    if present is not None:
                        # A row without a value keeps its group and column in the result, in a cell below all.
                        cells[~present] = 0
                    cells = np.sort((of << CELL_BITS + 1) + cells)
                    new = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
                    own, points, rows = cells[new] >> CELL_BITS + 1, (cells[new] & 2 * _NONE - 1) - _NONE, len(cells)
                else:
                    cells, kept = points >> _SHIFT, np.zeros(len(points), bool)
                    for cell in wanted[k] if len(wanted[k]) <= 8 else ():
                        kept |= cells == cell
                    if len(wanted[k]) > 8:
                        kept = np.isin(cells, wanted[k])
                    if present is not None:
                        kept &= present
                    points, own = points[kept], of[kept]
                    if not len(points):
                        continue
                    order = np.lexsort((points, own))
                    points, own, rows = points[order], own[order], len(order)
                    new = np.flatnonzero(np.r_[True, (points[1:] != points[:-1]) | (own[1:] != own[:-1])])
                    own, points = own[new], points[new]
                found.append((own, np.full(len(new), k), points, np.diff(np.r_[new, rows])))
            if not found:
                continue
            own, at, points, counts = (np.concatenate(x) for x in zip(*found))
            if wanted is None:
                counts = np.where(points == -_NONE, 0, counts)
                cells = [pa.array(points, pa.int64())]
            else:
                cells = [pa.array(points >> _SHIFT, pa.int64()), pa.array(_values(points), pa.float64())]
            keys = [groups.take(pa.array(own))] if groups is not None else []
            made = [*keys, pa.array(at, pa.int32()), *cells, pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays([a.cast(t) for a, t in zip(made, schema.types)], schema=schema)

    return counted


def quantile_table(
    df: DataFrame,
    columns: Sequence[str],
    names: Mapping[str, float],
    by: str | None = None,
    buckets: int | None = None,
) -> DataFrame:
    """Quantiles with linear interpolation: one row per (group, column), one column per name.

    Nulls are ignored; a group without values of a column has nulls there, a null
    group is a group.  ``buckets`` changes how the work is cut, not the result.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    held = df.select(*([F.col(by).alias("_group")] if by else []), *[F.col(c).cast("double").alias(f"v{k}") for k, c in enumerate(columns)])
    group = ["_group"] if by else []
    keys = [held.schema["_group"]] if by else []
    at_column, at_cell, rows = StructField("_at", IntegerType()), StructField("_cell", LongType()), StructField("_n", LongType())

    def scan(wanted: Sequence[np.ndarray] | None, cells: Sequence[StructField]) -> DataFrame:
        schema = StructType([*keys, at_column, *cells, rows])
        counter = _counter(len(columns), by is not None, wanted, to_arrow_schema(schema))
        made = held.mapInArrow(counter, schema)
        return made.groupBy(*[f.name for f in schema.fields[:-1]]).agg(F.sum("_n").alias("_n"))

    # At most 2^CELL_BITS cells a group and column, however many rows it has.
    whole = W.partitionBy(*group, "_at")
    running = F.sum("_n").over(whole.orderBy("_cell"))
    cells = scan(None, [at_cell]).withColumns({"_through": running, "_total": F.sum("_n").over(whole)})
    cells = written(cells.withColumn("_before", F.col("_through") - F.col("_n")), "cells")

    def spot(p: float) -> Column:
        return (F.col("_total") - 1) * F.lit(float(p))

    def ranks(p: float) -> tuple[Column, Column]:
        low = F.floor(spot(p))
        return low, F.least(low + 1, F.col("_total") - 1)

    first, last = F.col("_before"), F.col("_through")
    asked = F.lit(False)
    for p in names.values():
        for rank in ranks(p):
            asked = asked | ((first <= rank) & (rank < last))
    targets = cells.filter(asked)
    # Distinct cells over all groups: no more than a column has cells.
    spots = targets.select("_at", "_cell").distinct().toArrow()
    at, cell = (spots.column(k).to_numpy() for k in range(2))
    wanted = [np.sort(cell[at == k]) for k in range(len(columns))]

    points = scan(wanted, [at_cell, StructField("_value", DoubleType())])
    inside = with_running_sums(points, [F.col("_value").asc()], {"_inside": "_n"}, [*group, "_at", "_cell"], ranges=buckets)
    renamed = {k: f"_of{k}" for k in (*group, "_at", "_cell")}
    other = targets.select(*[F.col(k).alias(v) for k, v in renamed.items()], "_before", "_total")
    placed = inside.join(other, equal_keys(list(renamed), renamed)).drop(*renamed.values())
    value_first = F.col("_before") + F.col("_inside") - F.col("_n")
    value_last = F.col("_before") + F.col("_inside")

    def at_rank(rank: Column) -> Column:
        return F.max(F.when((value_first <= rank) & (rank < value_last), F.col("_value")))

    picked = []
    for name, p in names.items():
        low, high = ranks(p)
        picked += [
            at_rank(low).alias(f"_low_{name}"),
            at_rank(high).alias(f"_high_{name}"),
            F.max(spot(p) - low).alias(f"_share_{name}"),
        ]
    found = placed.groupBy(*group, "_at").agg(*picked)
    quantiles = [
        between(*(F.col(f"_{k}_{name}") for k in ("low", "high", "share"))).alias(name) for name in names
    ]
    found = found.select(*[F.col(k).alias(f"_of{k}") for k in (*group, "_at")], *quantiles)
    every = cells.select(*group, "_at").distinct()
    listed = every.join(found, equal_keys([*group, "_at"], renamed), "left")
    label = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("_at") + 1).alias("column")
    return listed.select(*([F.col("_group").alias(by)] if by else []), label, *names)


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    by: str | None = None,
    buckets: int | None = None,
) -> dict[tuple[object, str], list[float | None]]:
    """The same as a dictionary by (group, column), for a ``by`` of few values (a label) or none."""
    names = {f"q{k}": p for k, p in enumerate(probabilities)}
    rows = quantile_table(df, columns, names, by, buckets).collect()
    found = {} if by else {(None, c): [None] * len(probabilities) for c in columns}
    return found | {(row[by] if by else None, row["column"]): [row[n] for n in names] for row in rows}
