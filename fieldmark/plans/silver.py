"""Raw records to the canonical policy table, as one chain of narrow steps and dimension joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from fieldmark.functions import dates, numbers, text
from fieldmark.functions.numbers import ratio
from fieldmark.operators import cleaning, dedup, dimensions
from fieldmark.plans.schema import NO_CLAIM, POLICY_COLUMNS
from fieldmark.sources.headers import SOURCE_HEADERS

# Raw column to canonical column.
RENAMED = {
    "policy_no": "policy_id",
    "insurer_name": "insurer",
    "place_text": "place_name",
    "state_code": "state",
    "place_code": "area_id",
    "product_class": "product_type",
    "crop_name": "crop",
    "peril_text": "peril",
    "area_text": "area_ha",
    "head_text": "head_count",
    "sum_text": "sum_insured",
    "premium_value": "premium",
    "rate_value": "rate",
    "subsidy_value": "subsidy",
    "indemnity_value": "indemnity",
    "expected_yield_text": "expected_yield",
    "insured_yield_text": "insured_yield",
    "coverage_text": "coverage_level",
    "start_text": "start_date",
    "end_text": "end_date",
}

# Source columns without a canonical name: personal data, source ids and the parts of the coordinates.
DROPPED = [c for c in SOURCE_HEADERS.values() if c not in RENAMED]

DOUBLES = (
    "area_ha", "expected_yield", "insured_yield", "coverage_level", "sum_insured", "premium", "rate", "subsidy", "indemnity",
    "lat", "lon",
)
INTS = ("head_count", "area_id")


@dataclass(frozen=True)
class Dimensions:
    """Code dictionaries (``code, value``) and geography, all optional DataFrames.

    Keys of the dictionaries are folded like the data before they are joined.
    """

    product_types: DataFrame | None = None
    perils: DataFrame | None = None
    crop_groups: DataFrame | None = None
    insurers: DataFrame | None = None
    regions: DataFrame | None = None
    corrections: DataFrame | None = None
    places: DataFrame | None = None
    districts: DataFrame | None = None


@dataclass(frozen=True)
class Options:
    """Choices the cleaning makes; the defaults follow the documented behaviour."""

    dedup_key: str = "proposal_id"
    dedup_order: Sequence[Column] = field(
        default_factory=lambda: [F.col("proposed_on").asc(), F.col("issued_on").desc()]
    )
    keep_null_keys: bool = True
    last_year: int = 2035
    fold_marks: bool = False
    fill_nulls: bool = True
    loss_ratio_without_premium: float | None = 0.0
    decimal_comma: Sequence[str] = ()  # canonical columns whose text has a decimal comma
    renamed: Mapping[str, str] = field(default_factory=lambda: RENAMED)
    other_group: str = "other"
    other_region: str = "Other"


def claim_flag(peril: Column) -> Column:
    """1 unless the peril is the no-claim code; unmapped and blank perils count."""
    return F.when(peril == NO_CLAIM, 0).otherwise(1)


def union_sources(*sources: DataFrame) -> DataFrame:
    """All sources as text except their date columns, aligned by name."""
    aligned = []
    for source in sources:
        kept = [f.name for f in source.schema.fields if f.dataType.simpleString() in ("date", "timestamp")]
        aligned.append(cleaning.all_to_string(source, keep=kept))
    out = aligned[0]
    for other in aligned[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out


def _coordinates(df: DataFrame) -> DataFrame:
    for axis, negative in (("lat", "S"), ("lon", "W")):
        parts = [f"{axis}_{p}" for p in ("deg", "min", "sec", "half")]
        if all(p in df.columns for p in parts):
            df = df.withColumn(axis, numbers.signed_degrees(*[F.col(p) for p in parts], negative))
    return df


def tidy(raw: DataFrame, options: Options) -> DataFrame:
    """Text, dates, coordinates, names and types: narrow steps only."""
    df = cleaning.strip_accents_in_names(cleaning.replace_sentinels(raw))
    df = cleaning.strip_accents_in_values(df, options.fold_marks)
    df = cleaning.rename_present(df, options.renamed)
    df = df.withColumns({c: dates.parse_date(F.col(c).cast("string")) for c in ("start_date", "end_date")})
    df = cleaning.plausible_end(df, "end_date", options.last_year)
    df = df.withColumn("duration_days", F.datediff("end_date", "start_date"))
    df = df.withColumn("peril", F.coalesce(text.collapse_spaces(F.col("peril")), F.lit("0")))
    df = _coordinates(cleaning.trim_strings(df))
    df = cleaning.drop_present(df, DROPPED)
    if options.fill_nulls:
        df = cleaning.fill_by_type(df)
    commas = {c: numbers.from_decimal_comma(F.col(c)) for c in options.decimal_comma if c in df.columns}
    return cleaning.cast_numbers(df.withColumns(commas), INTS, DOUBLES)


def _mapped(df: DataFrame, column: str, dim: DataFrame | None, options: Options, **kwargs) -> DataFrame:
    if dim is None:
        return df
    return dimensions.map_code(df, column, dimensions.normalised(dim, fold_marks=options.fold_marks), **kwargs)


def build(raw: DataFrame, dims: Dimensions, options: Options | None = None) -> DataFrame:
    """The canonical policy table."""
    options = options or Options()
    df = dedup.deduplicate(raw, options.dedup_key, options.dedup_order, options.keep_null_keys)
    df = tidy(df, options)
    df = _mapped(df, "product_type", dims.product_types, options)
    # The no-claim code is ours, so it is not left to the dictionary.
    df = df.withColumn("peril", F.when(F.col("peril") == "0", NO_CLAIM).otherwise(F.col("peril")))
    df = _mapped(df, "peril", dims.perils, options)
    df = _mapped(
        df, "crop", dims.crop_groups, options, target="crop_group", default=options.other_group, keep_unmapped=False
    )
    df = df.withColumns(
        {
            "claim": claim_flag(F.col("peril")),
            "loss_ratio": ratio(F.col("indemnity"), F.col("premium"), options.loss_ratio_without_premium),
        }
    )
    df = cleaning.valid_code(df, "state")
    df = df.withColumn("place_name", text.slug(F.col("place_name")))
    if dims.corrections is not None:
        df = dimensions.correct_names(df, "place_name", dims.corrections)
    if dims.places is not None:
        df = dimensions.place_codes(df, dims.places, dims.districts, code="area_id")
    df = _mapped(df, "insurer", dims.insurers, options)
    df = _mapped(
        df, "state", dims.regions, options, target="region", default=options.other_region, keep_unmapped=False
    )
    return cleaning.drop_all_null(cleaning.select_present(df, POLICY_COLUMNS))
