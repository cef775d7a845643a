"""AdaBoost over depth-1 trees.

Features are binned once: the training rows become a written table of blocks with
one byte per feature and row (feature by feature: bin and label as one number), the
label and each row's running weight.  A round is
one job over the blocks, whose tasks return weight sums by (feature, bin, class);
these give the stump, its error and its vote without another pass.  A round's plan
holds only the stumps found since the blocks were last written, every ``KEEP``
rounds, so neither the plan nor a round's work grows with the rounds.

Rows without a label are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fieldmark.operators.prefix import with_running_sums
from fieldmark.session import written

NO_FEATURE = -1
#: Bins of a feature, at most; a feature of as many distinct values or fewer is split between any two of them.
BINS = 32
#: Rounds after which the running weights are written.
KEEP = 10
#: Rows of a block, at most.
BLOCK = 1 << 16


@dataclass(frozen=True)
class Stump:
    """``below`` is predicted up to the threshold, ``above`` beyond it; ``weight`` is its vote.

    A stump whose two sides predict the same class has feature ``NO_FEATURE`` and
    always predicts ``below``.
    """

    feature: int
    threshold: float
    below: int
    above: int
    weight: float


@dataclass(frozen=True)
class BoostedStumps:
    stumps: list[Stump]

    def prefix(self, rounds: int) -> "BoostedStumps":
        """The ensemble as it was after so many rounds."""
        return BoostedStumps(self.stumps[:rounds])

    def margin(self, features: str = "features") -> Column:
        """Weighted vote in [-1, 1]: one fold over the stumps, which are a literal array."""
        values = vector_to_array(features)
        listed = F.array(
            *[
                F.struct(
                    # Element numbers count from 1; a stump without a feature may read any.
                    F.lit(max(s.feature, 0) + 1).alias("spot"),
                    F.lit(math.inf if s.feature == NO_FEATURE else s.threshold).alias("threshold"),
                    F.lit(s.weight * (2 * s.below - 1)).alias("below"),
                    F.lit(s.weight * (2 * s.above - 1)).alias("above"),
                )
                for s in self.stumps
            ]
        )

        def vote(total: Column, s: Column) -> Column:
            below = F.element_at(values, s["spot"]) <= s["threshold"]
            return total + F.when(below, s["below"]).otherwise(s["above"])

        return F.aggregate(listed, F.lit(0.0), vote) / F.lit(sum(s.weight for s in self.stumps))

    def transform(self, df: DataFrame, features: str = "features") -> DataFrame:
        """Adds ``score``, the probability of the positive class."""
        return df.withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin(features))))

    def importances(self, size: int) -> list[float]:
        total = sum(s.weight for s in self.stumps if s.feature != NO_FEATURE)
        votes = [sum(s.weight for s in self.stumps if s.feature == i) for i in range(size)]
        return [v / total for v in votes] if total else votes

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [(i, s.feature, s.threshold, s.below, s.above, s.weight) for i, s in enumerate(self.stumps)]
        schema = "position int, feature int, threshold double, below int, above int, weight double"
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "BoostedStumps":
        rows = spark.read.parquet(path).orderBy("position").collect()
        return BoostedStumps([Stump(r.feature, r.threshold, r.below, r.above, r.weight) for r in rows])


def split_points(df: DataFrame, features: str = "features", bins: int = BINS) -> list[np.ndarray]:
    """Thresholds of each feature, ascending: midpoints of few distinct values, else equal shares of the rows."""
    values = df.select(F.posexplode(vector_to_array(features)).alias("feature", "value"))
    points = values.groupBy("feature", "value").agg(F.count("*").alias("rows")).withColumn("one", F.lit(1))
    running = with_running_sums(
        points, [F.col("value").asc()], {"through": "rows"}, ["feature"], {"total": "rows", "distinct": "one"}
    )
    share = F.lit(bins) / F.col("total")
    crosses = F.floor(F.col("through") * share) > F.floor((F.col("through") - F.col("rows")) * share)
    kept = running.filter((F.col("distinct") <= bins) | crosses).select("feature", "value", "distinct")
    # At most ``bins`` rows a feature.
    found: dict[int, list[tuple[float, bool]]] = {}
    for row in kept.collect():
        found.setdefault(row["feature"], []).append((row["value"], row["distinct"] <= bins))
    points_of = []
    for k in range(max(found, default=-1) + 1):
        rows = sorted(found.get(k, []))
        spots = np.array([v for v, _ in rows])
        whole = bool(rows) and rows[0][1]
        # The last kept value is the largest one, beyond which nothing lies.
        points_of.append((spots[:-1] + spots[1:]) / 2 if whole else spots[:-1])
    return points_of


_BLOCK_SCHEMA = "n int, labels binary, cells binary, exponents binary"
_BLOCK_ARROW = pa.schema([("n", pa.int32()), ("labels", pa.binary()), ("cells", pa.binary()), ("exponents", pa.binary())])


def _binned(points: Sequence[np.ndarray]):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                part = batch.slice(at, BLOCK)
                n = part.num_rows
                rows = part.column(0).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
                labels = part.column(1).to_numpy().astype(np.uint8)
                cells = np.empty((len(points), n), np.uint8)
                for k, p in enumerate(points):
                    cells[k] = np.searchsorted(p, rows[:, k]) * 2 + labels
                row = (n, labels.tobytes(), cells.tobytes(), np.zeros(n).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _BLOCK_ARROW.types)], schema=_BLOCK_ARROW)

    return blocks


#: (feature, last bin below, class below, class above, vote)
_Recent = tuple[int, int, int, int, float]


def _block(row: dict, recent: Sequence[_Recent]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels, cells by feature and the exponents of the weights, the recent stumps' misses included."""
    labels = np.frombuffer(row["labels"], np.uint8)
    cells = np.frombuffer(row["cells"], np.uint8).reshape(-1, row["n"])
    exponents = np.frombuffer(row["exponents"]).copy()
    for feature, last, below, above, vote in recent:
        said = np.full(row["n"], below) if feature == NO_FEATURE else np.where(cells[feature] <= 2 * last + 1, below, above)
        exponents[said != labels] += vote
    return labels, cells, exponents


def _weight_sums(recent: Sequence[_Recent], size: int, bins: int, top: float):
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((size, bins * 2))
        for batch in batches:
            for row in batch.to_pylist():
                _, cells, exponents = _block(row, recent)
                weights = np.exp(exponents - top)
                for k in range(size):
                    sums[k] += np.bincount(cells[k], weights, minlength=bins * 2)
        sums = sums.reshape(-1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(sums)], names=["cell", "weight"]
        )

    return summed


def _reweighted(recent: Sequence[_Recent]):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                made = (row["n"], row["labels"], row["cells"], _block(row, recent)[2].tobytes())
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(made, _BLOCK_ARROW.types)], schema=_BLOCK_ARROW)

    return blocks


def best_stump(sums: np.ndarray) -> tuple[int, int, int, int, float]:
    """(feature, last bin below, class below, class above, error) of the split of least Gini impurity.

    ``sums`` are weights by feature, bin and class.  Ties go to the lower feature and bin.
    """
    total = sums[0].sum(axis=0)
    below = sums.cumsum(axis=1)[:, :-1]
    above = total - below
    sizes = np.stack([below.sum(axis=2), above.sum(axis=2)])
    squares = np.stack([(below**2).sum(axis=2), (above**2).sum(axis=2)])
    # Weight times impurity of both sides; a side without rows is no split.
    cost = np.where((sizes > 1e-12 * total.sum()).all(axis=0), sizes.sum(axis=0) - (squares / np.maximum(sizes, 1e-300)).sum(axis=0), np.inf)
    # Sums in another order differ in their last digits; equal splits stay equal.
    cost = np.round(cost / total.sum(), 12)
    if not cost.size or not np.isfinite(cost.min()):
        always = int(total[1] > total[0])
        return NO_FEATURE, 0, always, always, float(total[1 - always] / total.sum())
    feature, last = divmod(int(cost.argmin()), cost.shape[1])
    sides = (below[feature, last], above[feature, last])
    said = [int(side[1] > side[0]) for side in sides]
    error = float(sum(side[1 - k] for side, k in zip(sides, said)) / total.sum())
    if said[0] == said[1]:
        return NO_FEATURE, 0, said[0], said[0], error
    return feature, last, said[0], said[1], error


def fit_boosted_stumps(
    df: DataFrame, label: str, features: str = "features", rounds: int = 100, rate: float = 0.1, bins: int = BINS
) -> BoostedStumps:
    rows = df.select(features, label).filter(F.col(label).isNotNull())
    points = split_points(rows, features, bins)
    arrays = rows.select(vector_to_array(features).alias("values"), F.col(label).cast("int").alias("label"))
    blocks = written(arrays.mapInArrow(_binned(points), _BLOCK_SCHEMA), "boosting")
    size, width = len(points), max([len(p) + 1 for p in points], default=1)
    stumps: list[Stump] = []
    recent: list[_Recent] = []
    held = 0.0
    for _ in range(rounds):
        # Exponents stay where exp() does, however many rounds there are.
        top = max(0.0, held - 500)
        cells = blocks.mapInArrow(_weight_sums(recent, size, width, top), "cell int, weight double")
        sums = np.zeros(size * width * 2)
        for cell, weight in cells.groupBy("cell").agg(F.sum("weight")).collect():
            sums[cell] = weight
        if not sums.any():
            break
        feature, last, below, above, error = best_stump(sums.reshape(size, width, 2))
        if error >= 0.5:
            break
        threshold = float(points[feature][last]) if feature != NO_FEATURE else 0.0
        if error <= 0:
            stumps.append(Stump(feature, threshold, below, above, 1.0))
            break
        vote = rate * math.log((1 - error) / error)
        stumps.append(Stump(feature, threshold, below, above, vote))
        recent.append((feature, last, below, above, vote))
        held += vote
        if len(recent) == KEEP:
            blocks = written(blocks.mapInArrow(_reweighted(recent), _BLOCK_SCHEMA), "boosting")
            recent = []
    if not stumps:
        raise ValueError("no stump does better than chance")
    return BoostedStumps(stumps)
