"""Row-wise cleaning steps.  Each is one narrow ``select``: no shuffle, no Python."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from fieldmark.functions import numbers, text


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _rewrite(df: DataFrame, changed: Mapping[str, Column]) -> DataFrame:
    return df.withColumns(dict(changed)) if changed else df


def all_to_string(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Cast every column to string, except those in ``keep``."""
    kept = set(keep)
    return df.select(*[F.col(c) if c in kept else F.col(c).cast("string").alias(c) for c in df.columns])


def replace_sentinels(df: DataFrame, sentinels: Sequence[str] = text.SENTINELS, value: str = "0") -> DataFrame:
    return df.replace(list(sentinels), value, subset=string_columns(df))


def strip_accents_in_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[text.strip_accents_name(c) for c in df.columns])


def strip_accents_in_values(df: DataFrame, fold_marks: bool = False) -> DataFrame:
    return _rewrite(df, {c: text.strip_accents(F.col(c), fold_marks) for c in string_columns(df)})


def trim_strings(df: DataFrame) -> DataFrame:
    return _rewrite(df, {c: F.trim(F.col(c)) for c in string_columns(df)})


def drop_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop the listed columns; names the frame lacks are ignored."""
    return df.drop(*names)


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def select_present(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Canonical column order, restricted to the columns the frame has."""
    return df.select(*[c for c in order if c in df.columns])


def fill_by_type(df: DataFrame, string_value: str = "0", number_value: float = 0) -> DataFrame:
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    out = df.fillna(string_value, subset=string_columns(df)) if string_columns(df) else df
    return out.fillna(number_value, subset=numeric) if numeric else out


def fill_with_mean(df: DataFrame, column: str) -> DataFrame:
    """Nulls take the column mean, read as a scalar subquery (no join, no window)."""
    mean = df.agg(F.avg(column)).scalar()
    return df.withColumn(column, F.coalesce(F.col(column), mean))


def cast_numbers(df: DataFrame, ints: Iterable[str] = (), doubles: Iterable[str] = ()) -> DataFrame:
    """Guarded casts; text that is no number becomes null rather than an error."""
    changed = {c: numbers.to_int(F.col(c)) for c in ints if c in df.columns}
    changed |= {c: numbers.to_double(F.col(c)) for c in doubles if c in df.columns}
    return _rewrite(df, changed)


def plausible_end(df: DataFrame, end: str, last_year: int = 2035) -> DataFrame:
    """Keep rows that end no later than ``last_year``; rows without an end go too.

    The bound is put on the bare column so that it reaches the file scan.
    """
    return df.filter(F.col(end) < F.lit(f"{last_year + 1}-01-01").cast("date"))


def valid_code(df: DataFrame, column: str, invalid: str = "0") -> DataFrame:
    return df.filter(F.col(column).isNotNull() & (F.col(column) != invalid))


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.dropna("all")


def drop_any_null(df: DataFrame) -> DataFrame:
    return df.dropna("any")


def rows_with_null(df: DataFrame) -> DataFrame:
    """The complement of :func:`drop_any_null`."""
    any_null = F.lit(False)
    for c in df.columns:
        any_null = any_null | F.col(c).isNull()
    return df.filter(any_null)


def year_slice(df: DataFrame, date: str, first: int, last: int | None = None) -> DataFrame:
    """Rows of the given years, as bounds on the bare date column (pushed to the scan)."""
    out = df.filter(F.col(date) >= F.lit(f"{first}-01-01").cast("date"))
    return out if last is None else out.filter(F.col(date) < F.lit(f"{last + 1}-01-01").cast("date"))
