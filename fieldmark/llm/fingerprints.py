"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

Each paragraph (line) is hashed to a wide vector; a document's fingerprint is the sum of its
paragraphs' vectors, lane by lane, modulo a power of two.  So the order of paragraphs does not
matter, and a paragraph is inserted or deleted by adding or subtracting its vector.

A paragraph's vector has two parts.  ``EXACT`` lanes of 64 bits are the paragraph's BLAKE2b digest of 512
bits: a collision of one lane is none of the others, and sums modulo 2**64 that agree in all lanes mean equal
multisets, unless somebody solves for paragraphs whose digests add up (repeated 2**64 times, say).  ``LIKENESS`` lanes of 32 bits
are a signed count sketch of the paragraph's byte windows: the angle between two sums estimates
how much of two texts is shared, also when every paragraph was touched.

Cases: a null or empty text, and one of line ends only, has the zero fingerprint; two zero
fingerprints are alike (1.0).  A paragraph shorter than the window is one window.
Repeated rows get a row each.  Documents are ordered by descending id, null ids last, equal ids by
their text's hash, so the neighbour of each row is defined up to rows that are equal.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from fieldmark.llm.common import Spans, partitions, tidy

EXACT = 8
LIKENESS = 128
WINDOW = 12
#: Id ranges per shuffle partition: ranges are dealt by hash, so several per task even the load out.
RANGES_PER_TASK = 8

_LOWEST = np.iinfo(np.int64).min


class Fingerprint:
    """Sums of paragraph vectors; ``+`` inserts and ``-`` deletes paragraphs."""

    __slots__ = ("exact", "lanes")

    def __init__(self, exact: np.ndarray, lanes: np.ndarray):
        self.exact, self.lanes = exact, lanes

    def __add__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact + other.exact, self.lanes + other.lanes)

    def __sub__(self, other: Fingerprint) -> Fingerprint:
        return Fingerprint(self.exact - other.exact, self.lanes - other.lanes)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Fingerprint) and self.encoded() == other.encoded()

    def encoded(self) -> str:
        return base64.b64encode(self.exact.astype("<u8").tobytes() + self.lanes.astype("<i4").tobytes()).decode()

    def likeness(self, other: Fingerprint) -> float:
        """Cosine of the two sketches, 0 to 1; 1 for equal fingerprints."""
        if np.array_equal(self.lanes, other.lanes):
            return 1.0 if np.array_equal(self.exact, other.exact) else 0.999999
        a, b = self.lanes.astype(np.float64), other.lanes.astype(np.float64)
        size = float(np.sqrt((a @ a) * (b @ b)))
        return min(0.999999, max(0.0, float(a @ b) / size)) if size else 0.0


def fingerprint(text: str | None) -> Fingerprint:
    """The fingerprint of a whole text."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    exact, lanes = np.zeros(EXACT, np.uint64), np.zeros(LIKENESS, np.int32)
    breaks = np.flatnonzero(data == 10)
    starts = np.concatenate([[0], breaks + 1])
    ends = np.concatenate([breaks, [len(data)]])
    filled = ends > starts
    starts, ends = starts[filled], ends[filled]
    if not len(starts):
        return Fingerprint(exact, lanes)
    spans = Spans(data)
    whole = spans.hashed(starts, ends)
    raw = data.tobytes()
    digests = b"".join(
        hashlib.blake2b(raw[a:b], digest_size=8 * EXACT).digest() for a, b in zip(starts.tolist(), ends.tolist())
    )
    exact = np.frombuffer(digests, "<u8").reshape(-1, EXACT).sum(axis=0, dtype=np.uint64)
    lines = np.zeros(len(data) + 1, np.int32)
    np.cumsum(data == 10, out=lines[1:])
    windows = spans.windows(WINDOW)
    if len(windows):
        windows = windows[lines[WINDOW:] == lines[: len(windows)]]
    windows = np.concatenate([windows, whole[ends - starts < WINDOW]])
    slots = (windows >> np.uint64(40)).astype(np.int64) & (2 * LIKENESS - 1)
    counts = np.bincount(slots, minlength=2 * LIKENESS)
    return Fingerprint(exact, (counts[:LIKENESS] - counts[LIKENESS:]).astype(np.int32))


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by the start of the following document."""
    k = len(text) // 3
    return text[: len(text) - k] + following[:k]


_RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_ARROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def _row(doc_id: int | None, text: str, own: Fingerprint, following: str, following_print: Fingerprint) -> tuple:
    changed = edited(text, following)
    changed_print = own if changed == text else fingerprint(changed)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    likeness = own.likeness(changed_print), own.likeness(following_print)
    return (doc_id, len(text), digest, own.encoded(), changed_print.encoded(), *likeness)


@tidy
def _against_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges one after another: each one's rows in order, then the first row of the range it precedes."""
    at, waiting = None, None
    for batch in batches:
        rows = []
        columns = (batch.column(name).to_pylist() for name in ("span", "guard", "doc_id", "text"))
        for span, guard, doc_id, text in zip(*columns):
            if span != at:
                at, waiting = span, None
            elif waiting is None:
                continue  # further copies of the first row
            print_ = fingerprint(text)
            if waiting is not None:
                rows.append(_row(*waiting, text, print_))
            waiting = None if guard else (doc_id, text, print_)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _ARROW.types)], schema=_ARROW)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its fingerprint, that of its edited text, and their likeness.

    Ids are cut into ranges by their quantiles (a number of ranges, not of rows, reaches the
    driver); each range is sorted in one task, and the first row of the following range is sent
    along, so that every row meets its successor although no task sees the whole order.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(_LOWEST)).alias("key"),
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
    )
    n = RANGES_PER_TASK * partitions(spark)
    at = ", ".join(f"{k / n:.10g}D" for k in range(1, n))
    found = rows.select(F.expr(f"percentile_approx(key, array({at}), 20000)").alias("cuts")).first()
    cuts = np.unique(np.array(found.cuts or [], np.int64))

    @pandas_udf("int")
    def span_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(), "left").astype(np.int32))

    ranges = rows.select("key", span_of("key").alias("span")).groupBy("span").agg(F.max("key").alias("head"))
    heads = {r.span: r.head for r in ranges.collect()}
    order = sorted(heads)
    # The range that is served before a range in descending order; the lowest is followed by the highest.
    guarded = {heads[span]: order[(i + 1) % len(order)] for i, span in enumerate(order)}
    head_ids = np.array(sorted(guarded), np.int64)
    head_spans = np.array([guarded[k] for k in sorted(guarded)], np.int32)

    @pandas_udf("array<int>")
    def spans_of(keys: pd.Series) -> pd.Series:
        """The range of a row, and for the first row of a range also the range it follows."""
        values = keys.to_numpy()
        own = np.searchsorted(cuts, values, "left").astype(np.int32)
        place = np.minimum(np.searchsorted(head_ids, values), len(head_ids) - 1)
        head = head_ids[place] == values
        return pd.Series([[o, g] if h else [o] for o, h, g in zip(own.tolist(), head, head_spans[place].tolist())])

    dealt = (
        rows.select("*", F.posexplode(spans_of("key")).alias("guard", "span"))
        .repartition(partitions(spark), "span")
        .sortWithinPartitions("span", "guard", F.desc("key"), F.desc(F.xxhash64("text")))
        .select("span", "guard", "doc_id", "text")
    )
    return dealt.mapInArrow(_against_next, _RESULT)
