"""How a registered query and its SQL twin are declared and made comparable."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType


#: The largest double below a half: what is added before a cut to the whole number, so that only ties and more go up.
BELOW_HALF = 0.49999999999999994


def _round_at(n: int):
    scale = 10.0**n

    def rounded(x: Column) -> Column:
        # Halves go away from zero, as in DuckDB's round; beyond 2^52 a double has no fraction.
        whole = F.floor(F.abs(x) * scale + BELOW_HALF) / scale * F.signum(x)
        return F.when(F.abs(x) < 2.0**52 / scale, whole + 0.0).otherwise(x * scale / scale)

    return rounded


def rounded_columns(df: DataFrame, floats: Mapping[str, int]) -> DataFrame:
    """The same columns, doubles rounded to the given digits without a way through decimal text.

    Columns of equal digits are rounded as one array: an expression a column would be more
    code than the JVM compiles.
    """
    doubles = {c: d for c, d in floats.items() if df.schema[c].dataType == DoubleType()}
    others = {c: F.round(F.col(c), d) for c, d in floats.items() if c not in doubles}
    groups = {d: [c for c in doubles if doubles[c] == d] for d in sorted(set(doubles.values()))}
    arrays = {f"_at_{d}": F.transform(F.array(*[F.col(c) for c in cs]), _round_at(d)) for d, cs in groups.items()}
    back = {c: F.get(F.col(f"_at_{d}"), F.lit(k)) for d, cs in groups.items() for k, c in enumerate(cs)}
    return df.withColumns({**others, **arrays}).withColumns(back).drop(*arrays) if floats else df


@dataclass(frozen=True)
class Check:
    """A query, its SQL and the columns whose form both sides share.

    ``floats`` are rounded to the given digits and ``dates`` become ISO text on
    both sides, so that neither summation order nor driver types matter.
    """

    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    floats: Mapping[str, int] = field(default_factory=dict)
    dates: Sequence[str] = ()

    def query(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(spark, sf_dir)
        shaped = {c: F.col(c).cast("string") for c in self.dates}
        df = rounded_columns(df, self.floats)
        return df.withColumns(shaped) if shaped else df

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        shaped = [f"round({c}, {d}) AS {c}" for c, d in self.floats.items()]
        shaped += [f"CAST(CAST({c} AS DATE) AS VARCHAR) AS {c}" for c in self.dates]
        if not shaped:
            return self.sql
        return f"SELECT * REPLACE ({', '.join(shaped)}) FROM (\n{self.sql}\n)"


def digits(n: int, *names: str) -> dict[str, int]:
    return {name: n for name in names}
