"""Quality classifier: nearest-neighbour voting in a latent-semantic space.

Terms.  A document's terms are its words and the five-character shapes of its text (letters by case,
digits and spaces as classes, other signs as themselves), hashed to ``TERMS`` columns, and a few
whole-text statistics in steps (repeated lines and words, share of signs, capitals, digits).  Counts
are damped by a logarithm and weighted by inverse document frequency.

Fit.  At most ``MAX_LABELLED`` labelled rows, those with the least hash of their id, give the
frequencies, the ``DIMENSIONS`` leading singular vectors and the labelled vectors.  That bound is
this classifier's documented parameter; it bounds what is collected and broadcast.

Score.  Every document's vector is multiplied with all labelled vectors, in blocks of documents; the
``NEIGHBOURS`` of largest cosine vote with their similarity to the power ``SHARPNESS``, and the score
is the weighted share of label 1, drawn to the base rate by ``PRIOR`` votes.

Cases: a null or empty text, and any text if nothing is labelled, scores the base rate (0.5 without
labels); a row whose labels disagree counts by their mean; null labels and ids are not learnt from.
Repeated rows get a row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fieldmark.llm.common import Spans, held_back, slices, tidy, utf8, word_bounds

MAX_LABELLED = 8192
SHAPES, WORDS, STEPS = 512, 448, 64
TERMS = SHAPES + WORDS + STEPS
DIMENSIONS = 48
NEIGHBOURS = 15
SHARPNESS = 12.0
PRIOR = 0.25
THRESHOLD = 0.3
SHAPE_WIDTH = 5
#: Documents whose cosines stand in memory at once.
BLOCK_ROWS = 512


def _shape_classes() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("a") : ord("z") + 1] = ord("a")
    table[128:] = ord("a")
    table[ord("A") : ord("Z") + 1] = ord("A")
    table[ord("0") : ord("9") + 1] = ord("0")
    return table


_SHAPE = _shape_classes()


def _shares(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


def _distinct_share(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """The share of distinct hashes among each row's; 1 for a row that has none."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
    kinds, all_ = np.bincount(r[new], minlength=n), np.bincount(rows, minlength=n)
    return np.where(all_ > 0, kinds / np.maximum(all_, 1), 1.0)


def term_counts(column: pa.Array) -> np.ndarray:
    """Damped term counts, a row per text."""
    data, offsets = utf8(column)
    n = len(column)
    out = np.zeros((n, TERMS), np.float32)
    if not len(data):
        return out
    rows = np.repeat(np.arange(n), np.diff(offsets))
    shapes = Spans(_SHAPE[data]).windows(SHAPE_WIDTH)
    if len(shapes):
        inside = rows[: len(shapes)] == rows[SHAPE_WIDTH - 1 :]
        slots = (shapes[inside] >> np.uint64(40)).astype(np.int64) % SHAPES
        counts = np.bincount(rows[: len(shapes)][inside] * SHAPES + slots, minlength=n * SHAPES)
        out[:, :SHAPES] = counts.reshape(n, SHAPES)
    starts, ends, of = word_bounds(data, offsets)
    spans = Spans(data)
    words = spans.hashed(starts, ends)
    if len(words):
        counts = np.bincount(of * WORDS + (words >> np.uint64(40)).astype(np.int64) % WORDS, minlength=n * WORDS)
        out[:, SHAPES : SHAPES + WORDS] = counts.reshape(n, WORDS)
    breaks = np.union1d(np.flatnonzero(data == 10), offsets[1:-1] - 1)
    line_ends = np.append(breaks[breaks >= 0] + 1, len(data))
    line_starts = np.concatenate([[0], line_ends[:-1]])
    filled = line_ends > line_starts
    line_starts, line_ends = line_starts[filled], line_ends[filled]
    lines = spans.hashed(line_starts, line_ends)
    letters = _SHAPE[data]
    word_char = (letters == 97) | (letters == 65)
    stats = (
        1 - _distinct_share(lines, rows[line_starts], n),
        1 - _distinct_share(words, of, n),
        _shares(letters == 65, offsets),
        _shares(letters == 48, offsets),
        _shares(~word_char & (data != 32) & (data != 10) & (letters != 48), offsets),
        _shares(data == 10, offsets) * 10,
        np.log1p(np.diff(offsets)) / 16,
        np.bincount(of, minlength=n) / np.maximum(np.diff(offsets), 1) * 3,
    )
    steps = STEPS // len(stats)
    for k, value in enumerate(stats):
        step = np.minimum((np.sqrt(np.clip(value, 0, 1)) * steps).astype(np.int64), steps - 1)
        out[np.arange(n), SHAPES + WORDS + k * steps + step] = 8
    return np.log1p(out)


def _row_slices(column: pa.Array) -> Iterator[tuple[int, int]]:
    for a, b in slices(column):
        for c in range(a, b, BLOCK_ROWS):
            yield c, min(b, c + BLOCK_ROWS)


@dataclass
class Classifier:
    weights: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    base: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        """Unit vectors of the latent space; zero where there are no terms."""
        weighted = counts * self.weights
        weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-9)
        latent = weighted @ self.directions
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def scores(self, column: pa.Array) -> np.ndarray:
        out = np.full(len(column), self.base)
        if not len(self.labels):
            return out
        sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
        k = min(NEIGHBOURS, len(self.labels))
        for a, b in _row_slices(column):
            cosines = self.project(term_counts(column.slice(a, b - a))) @ self.vectors.T
            nearest = np.argpartition(-cosines, k - 1, axis=1)[:, :k]
            votes = np.maximum(np.take_along_axis(cosines, nearest, axis=1), 0).astype(np.float64) ** SHARPNESS
            found = (votes * self.labels[nearest]).sum(axis=1) + PRIOR * self.base
            out[a:b] = np.where(sizes[a:b] > 0, found / (votes.sum(axis=1) + PRIOR), self.base)
        return out


def fit(counts: np.ndarray, labels: np.ndarray) -> Classifier:
    """The classifier of labelled documents, by their term counts."""
    if not len(labels):
        return Classifier(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32), counts[:, :1], labels, 0.5)
    seen = (counts > 0).sum(axis=0)
    weights = (np.log((1 + len(labels)) / (1 + seen)) + 1).astype(np.float32)
    weighted = counts * weights
    weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-9)
    values, vectors = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    directions = vectors[:, ::-1][:, :DIMENSIONS].astype(np.float32)
    made = Classifier(weights, directions, counts[:0], labels.astype(np.float64), float(labels.mean()))
    made.vectors = made.project(counts)
    return made


def train(
    docs: DataFrame,
    labels: DataFrame,
    label_column: str = "quality",
    id_column: str = "doc_id",
    text_column: str = "text",
    max_labelled: int = MAX_LABELLED,
) -> Classifier:
    """The classifier of at most ``max_labelled`` rows of ``labels``, with their texts from ``docs``."""
    chosen = labels.where(F.col(id_column).isNotNull() & F.col(label_column).isNotNull())
    chosen = chosen.groupBy(F.col(id_column).cast("long").alias("id")).agg(F.avg(label_column).alias("label"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    # One row per chosen id, summed up before the shuffle: repeated ids bring no more rows than labels were chosen.
    rows = texts.join(chosen, F.col("doc_id") == F.col("id"))
    order = F.struct(F.col("text").isNull(), F.xxhash64("text"), F.col("text"))
    rows = rows.groupBy("doc_id").agg(F.first("label").alias("label"), F.min_by("text", order).alias("text"))

    @tidy
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in _row_slices(batch.column(2)):
                part = batch.slice(a, b - a)
                packed = pa.array([row.tobytes() for row in term_counts(part.column(2))], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), packed], names=["doc_id", "label", "terms"]
                )

    found = rows.mapInArrow(counted, "doc_id long, label double, terms binary").toArrow().sort_by("doc_id")
    terms = [np.frombuffer(t.as_py(), np.float32) for t in found.column("terms")]
    counts = np.stack(terms) if terms else np.zeros((0, TERMS), np.float32)
    return fit(counts, found.column("label").to_numpy())


def predict(docs: DataFrame, model: Classifier, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = np.clip(shared.value.scores(batch.column(1)), 0, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(judged, "doc_id long, score double")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The registered query: learn from four fifths of the labelled rows, score all documents."""
    held_out = held_back("doc_id", 5, 0)
    model = train(docs, labels.where(~held_out))
    scored = predict(docs, model)
    predicted = (F.col("score") >= THRESHOLD).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))
