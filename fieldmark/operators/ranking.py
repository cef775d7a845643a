"""Exact ranking metrics from scored rows.

Scores are first counted per group and distinct value (combined on the map
side).  Running counts from the best score down (see ``prefix``) then hold all that
the metrics need, so one scan of the scores gives all of them, at any size, for
any number of groups, null groups included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from fieldmark.functions.numbers import ratio
from fieldmark.operators.prefix import with_running_sums
from fieldmark.operators.quantiles import between


def running_counts(
    df: DataFrame, label: str, score: str, by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Per distinct score, highest first: counts at it and counts at or above it.

    Columns: ``by``, the score, ``pos``, ``neg``, ``tp``, ``fp``, the class totals
    ``n_pos``, ``n_neg``, and the same of all rows, with or without a label: ``rows``,
    ``above``, ``n_rows``.  Rows without a score are left out.
    """
    scored = df.filter(F.col(score).isNotNull())
    points = scored.groupBy(*by, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) == 0).alias("neg"),
        F.count("*").alias("rows"),
    )
    return with_running_sums(
        points,
        [F.col(score).desc()],
        {"tp": "pos", "fp": "neg", "above": "rows"},
        by,
        {"n_pos": "pos", "n_neg": "neg", "n_rows": "rows"},
        buckets,
    )


def _share(top: str, bottom: str) -> Column:
    return ratio(F.col(top), F.col(bottom))


def roc_points(counts: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """False and true positive rate at every distinct threshold, from the origin on."""
    points = counts.select(
        *by, F.col(score).alias("threshold"), _share("fp", "n_neg").alias("fpr"), _share("tp", "n_pos").alias("tpr")
    )
    origin = counts.groupBy(*by).agg(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def precision_recall_points(counts: DataFrame, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall and base rate at every distinct threshold."""
    tp, fp = F.col("tp"), F.col("fp")
    return counts.select(
        *by,
        F.col(score).alias("threshold"),
        ratio(tp, tp + fp).alias("precision"),
        _share("tp", "n_pos").alias("recall"),
        ratio(F.col("n_pos"), F.col("n_pos") + F.col("n_neg")).alias("base_rate"),
    )


def _curve_parts() -> dict[str, Column]:
    """Aggregates over the rows of ``running_counts``."""
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    n_pos, n_neg = F.max("n_pos").cast("double"), F.max("n_neg").cast("double")
    won = F.sum(neg * (tp - pos) + neg * pos / 2.0)
    return {
        "auc_roc": ratio(won, n_pos * n_neg),
        "auc_pr": ratio(F.sum(pos * ratio(tp, tp + fp)), n_pos),
        "ks": F.max(F.abs(_share("tp", "n_pos") - _share("fp", "n_neg"))),
    }


def _cut_parts(score: str, cut: float, top: float) -> dict[str, Column]:
    """Counts at the cut, and the two scores between which the best ``top`` share begins."""
    chosen = F.col(score) >= cut
    # Ranks from the lowest score on, as a quantile counts them.
    first = F.col("n_rows") - F.col("above")
    spot = (F.col("n_rows") - 1) * F.lit(1 - top)
    low = F.floor(spot)
    here = F.struct(F.col(score).alias("score"), "tp", "above")

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < first + F.col("rows")), here))

    return {
        "n_rows": F.max("n_rows"),
        "n_pos": F.max("n_pos"),
        "_n_neg": F.max("n_neg"),
        "_tp": F.coalesce(F.sum(F.when(chosen, F.col("pos"))), F.lit(0)),
        "_fp": F.coalesce(F.sum(F.when(chosen, F.col("neg"))), F.lit(0)),
        "_low": at(low),
        "_high": at(F.least(low + 1, F.col("n_rows") - 1)),
        "_spot": F.max(spot - low),
    }


def _from_cut_parts(found: DataFrame) -> dict[str, Column]:
    tp, fp = F.col("_tp"), F.col("_fp")
    wrong = fp + F.col("n_pos") - tp
    limit = between(F.col("_low.score"), F.col("_high.score"), F.col("_spot"))
    # No score lies between the two, so the best rows begin at one of them.
    best = F.when(limit <= F.col("_low.score"), F.col("_low")).otherwise(F.col("_high"))
    precision = ratio(best.getField("tp"), best.getField("above"))
    return {
        "accuracy": ratio(tp + F.col("_n_neg") - fp, F.col("n_rows")),
        "f1": F.coalesce(ratio(tp * 2, tp * 2 + wrong), F.lit(0.0)),
        "top_threshold": limit,
        "lift_10": ratio(precision, _share("n_pos", "n_rows")),
    }


def curve_metrics(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve (ties count half), average precision, KS distance."""
    return counts.groupBy(*by).agg(*[c.alias(name) for name, c in _curve_parts().items()])


def accuracy_and_f1(df: DataFrame, label: str, score: str, by: str, cut: float = 0.5) -> DataFrame:
    """Accuracy and F1 at ``cut`` from one aggregate of the scored rows."""
    scored = df.filter(F.col(score).isNotNull())
    actual, chosen = F.col(label) == 1, F.col(score) >= cut
    counted = scored.groupBy(by).agg(
        F.count("*").alias("_rows"),
        F.count_if(actual == chosen).alias("_right"),
        F.count_if(actual & chosen).alias("_tp"),
        F.count_if(actual != chosen).alias("_wrong"),
    )
    hits = F.col("_tp") * 2
    return counted.select(
        by,
        _share("_right", "_rows").alias("accuracy"),
        F.coalesce(ratio(hits, hits + F.col("_wrong")), F.lit(0.0)).alias("f1"),
    )


def _keys(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def threshold_metrics(
    df: DataFrame, label: str, score: str, by: str | Sequence[str], cut: float = 0.5, top: float = 0.1
) -> DataFrame:
    """Accuracy and F1 at ``cut``, and the lift of the best-scored ``top`` share."""
    keys = _keys(by)
    counts = running_counts(df, label, score, keys)
    found = counts.groupBy(*keys).agg(*[c.alias(name) for name, c in _cut_parts(score, cut, top).items()])
    return found.select(*keys, "n_rows", "n_pos", *[c.alias(n) for n, c in _from_cut_parts(found).items()])


def all_metrics(
    df: DataFrame, label: str, score: str, by: str | Sequence[str], cut: float = 0.5, top: float = 0.1
) -> DataFrame:
    """The six reported metrics, one row per value of ``by`` (model, split, month), from one scan of the scores."""
    keys = _keys(by)
    counts = running_counts(df, label, score, keys)
    parts = {**_cut_parts(score, cut, top), **_curve_parts()}
    found = counts.groupBy(*keys).agg(*[c.alias(name) for name, c in parts.items()])
    cuts = {n: c for n, c in _from_cut_parts(found).items() if n != "top_threshold"}
    return found.select(*keys, *[c.alias(n) for n, c in cuts.items()], *_curve_parts())


def metric_table(
    metrics: DataFrame, names: Sequence[str], models: Sequence[str], by: str = "model"
) -> DataFrame:
    """Metrics as rows, models as columns.  The models are named, so no pass looks for them."""
    long = metrics.select(by, *names).unpivot([by], list(names), "metric", "value")
    return long.groupBy("metric").pivot(by, list(models)).agg(F.first("value"))


def baseline_and_tuned(
    metrics: DataFrame, names: Sequence[str], baseline: str, tuned: str, by: str = "model"
) -> DataFrame:
    """One row per metric: the untuned model, the tuned one, and what tuning gained."""
    table = metric_table(metrics, names, [baseline, tuned], by)
    return table.select(
        "metric",
        F.col(f"`{baseline}`").alias("baseline"),
        F.col(f"`{tuned}`").alias("tuned"),
        (F.col(f"`{tuned}`") - F.col(f"`{baseline}`")).alias("gain"),
    )


def score_drift(df: DataFrame, score: str, ref: str) -> DataFrame:
    """Mean score and volume per reference month."""
    return df.groupBy(ref).agg(F.avg(score).alias("mean_score"), F.count(score).alias("n_scored"))
