"""Mixing sources to target weights along a time-varying curriculum.

Targets.  Every source has a weight; together the targets are ``total`` times all words.  A target
stops at ``most`` times its source's size; what is cut off is reshared by weight until none is above.

Passes.  A source is read floor(target / size) times as a whole, and once more for the documents
that come first in a fixed shuffled order until the rest of the target is reached; the document at
that border is read again up to the words that remain, so a source's words meet its target.

Positions.  A source's share changes over the training run: its demand at time t in [0, 1] is
``target * (1 + slope * (2t - 1))``, which integrates to ``target``.  The n-th word that the source
gives is needed when the cumulative demand ``target * ((1 - slope) t + slope t**2)`` reaches n; that
time, by inverting the integral, is the document's position, and documents are range-sorted by it.

Cases: null and empty texts have no words and are never taken; null sources are one source, the
last; sources are ranked by code point; equal ids and repeated rows are rows of their own, ties in
the shuffled order being broken by id and text hash (rows equal in both are interchangeable).
An empty table gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldmark.llm.common import cut, partitions

#: Fixed values of the contract.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
TOTAL = 1.5
MOST = 2.0
#: Slopes of the demand, by rank of the source: rising, falling, even.
SLOPES = (0.5, -0.5, 0.0)


def _by_rank(values: tuple, rank: Column) -> Column:
    """The value of a rank, repeating."""
    return F.element_at(F.array(*(F.lit(float(v)) for v in values)), (rank % len(values) + 1).cast("int"))


def targets(sizes: DataFrame, total: float = TOTAL, most: float = MOST, weights: tuple = WEIGHTS) -> DataFrame:
    """``sizes`` (source, source_size; a row per source) with rank and target.

    The ranks come from one window over the sources: a row per source, whatever the number of
    documents.  The resharing rounds send two sums to the driver each.
    """
    whole = "sum(source_size) OVER ()"
    ranked = sizes.select(
        "source",
        "source_size",
        (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1).alias("rank"),
        F.expr(whole).cast("double").alias("whole"),
    )
    ranked = ranked.select("*", _by_rank(weights, F.col("rank")).alias("weight"))
    ranked = cut(ranked, "mix-sources")
    limit = F.col("source_size") * F.lit(float(most))
    level = None
    while True:
        capped = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= limit
        found = ranked.select(
            F.max("whole").alias("whole"),
            F.sum(F.when(capped, limit).otherwise(0.0)).alias("given"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        if not found.whole or not found.open:
            break
        raised = (found.whole * total - found.given) / found.open
        if level is not None and raised <= level:
            break
        level = raised
    share = F.lit(0.0) if level is None else F.col("weight") * F.lit(level)
    return ranked.select("source", "source_size", "rank", F.least(share, limit).alias("target"))


def _position(words_before: Column, target: Column, slope: Column) -> Column:
    """The time at which a source's cumulative demand reaches ``words_before``."""
    share = F.least(words_before / target, F.lit(1.0))
    even = 1 - slope
    # The root of slope t^2 + even t = share, in the form that also holds for slope 0.
    return 2 * share / (even + F.sqrt(even * even + 4 * slope * share))


def _sized(docs: DataFrame, id_column: str, text_column: str, source_column: str, carried: list[Column]) -> DataFrame:
    """Source, number of words, place in the shuffled order and its bucket, beside the carried columns."""
    buckets = max(64, 4 * partitions(docs.sparkSession))
    text = F.coalesce(F.col(text_column), F.lit(""))
    sized = docs.select(
        *carried,
        F.col(source_column).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit("order"), F.col(id_column).cast("string"), text).alias("place"),
    )
    # Buckets are ranges of the hash: the order, and so the mix, is the same for any number of them.
    sized = sized.withColumn("high", F.shiftrightunsigned("place", 32))
    return sized.withColumn("bucket", F.shiftrightunsigned(F.col("high") * F.lit(buckets).cast("long"), 32))


def _decided(sized: DataFrame, total: float, most: float) -> DataFrame:
    """``sized`` with its source's size and target, the words before each row, words taken and passes.

    Running sums never gather a source: its shuffled order is cut into buckets by hash, the buckets'
    sums are added up first (a row per source and bucket), and each bucket is summed on its own.
    """
    parts = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    in_order = Window.partitionBy("source").orderBy("bucket")
    parts = parts.select(
        "source",
        "bucket",
        (F.sum("words").over(in_order) - F.col("words")).alias("before"),
        F.sum("words").over(Window.partitionBy("source")).alias("source_size"),
    )
    parts = cut(parts, "mix-parts")
    sources = targets(parts.select("source", "source_size").distinct(), total, most)
    parts = parts.select("source", "bucket", "before").join(
        sources.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))
    )
    parts = cut(
        parts.select(F.col("source").alias("s"), F.col("bucket").alias("b"), "before", "source_size", "rank", "target"),
        "mix-targets",
    )
    within = Window.partitionBy("source", "bucket").orderBy("high", "place")
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = sized.withColumn("through", F.sum("size").over(within))
    placed = running.join(parts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    placed = placed.withColumns(
        {
            "slope": _by_rank(SLOPES, F.col("rank")),
            "passes": passes.cast("long"),
            "words_before": F.col("before") + F.col("through") - F.col("size"),
        }
    )
    rest = F.floor(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")
    more = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("words_before")))
    placed = placed.withColumn("taken", F.col("passes") * F.col("size") + more)
    times = F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0)
    return placed.withColumn("times", times.cast("int"))


def _position_of(nth: Column) -> Column:
    return _position(F.col("words_before") + nth * F.col("source_size"), F.col("target"), F.col("slope"))


def mixture(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    total: float = TOTAL,
    most: float = MOST,
) -> DataFrame:
    """One row per document: its size, its source's size and target, the words taken, its positions.

    ``position`` is the time of the first pass, ``again`` that of the last; both are null for a
    document that is not taken.  Rows are range-sorted by position, documents not taken last.
    """
    sized = _sized(docs, id_column, text_column, source_column, [F.col(id_column).alias("doc_id")])
    placed = _decided(cut(sized, "mix-sizes"), total, most)
    taken = F.col("times") > 0
    rows = placed.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        "taken",
        "times",
        F.when(taken, _position_of(F.lit(0))).alias("position"),
        F.when(taken, _position_of(F.col("times") - 1)).alias("again"),
        "place",
    )
    return rows.orderBy(F.col("position").asc_nulls_last(), "place").drop("place")


def mixed(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    size_column: str | None = None,
    total: float = TOTAL,
    most: float = MOST,
) -> DataFrame:
    """The training order: a row of ``docs`` per pass over a document, range-sorted by position.

    The document at a source's border is cut to the words that remain, joined by single spaces;
    ``size_column``, if given, then holds its new number of characters.
    """
    sized = _sized(docs, id_column, text_column, source_column, [F.struct(*docs.columns).alias("row")])
    placed = _decided(sized, total, most)
    nth = F.explode(F.expr("CASE WHEN times > 0 THEN sequence(0, times - 1) END")).alias("nth")
    rows = placed.select("row", "place", "size", "taken", "words_before", "source_size", "target", "slope", nth)
    words = F.least(F.col("size"), F.col("taken") - F.col("nth") * F.col("size"))
    rows = rows.select(
        "row",
        "place",
        _position_of(F.col("nth")).alias("position"),
        F.when(words < F.col("size"), words).cast("int").alias("words"),
    )
    rows = rows.orderBy("position", "place")
    text, words = F.col("row")[text_column], F.col("words")
    listed = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    short = F.when(words.isNull(), text).otherwise(F.array_join(F.slice(listed, 1, words), " "))
    columns = []
    for name in docs.columns:
        value = F.col("row")[name]
        if name == text_column:
            value = short
        elif name == size_column:
            value = F.when(words.isNull(), value).otherwise(F.length(short).cast("long"))
        columns.append(value.alias(name))
    return rows.select(*columns)
