"""Vector code compression: product codes whose codebooks are fitted over anchors-hierarchy metric trees.

Components become whole numbers, vectors are cut into equal parts, and each part position has a codebook
fitted by Lloyd's rounds in exact integer arithmetic.  Rows are taken in blocks where they lie.

**Trees.**  Each block has a tree of balls for every part position, built once and written.  It is built
from the middle out: about the square root of the points become anchors, each new one the point farthest
from its anchor, which takes over only points that the triangle inequality lets come nearer; anchors
with many points are built in turn below, and the anchors' balls are merged in pairs, the smallest merged
ball first, up to the root.  Every ball caches the number, the sum and the sum of squares of its points.

**Rounds.**  A ball inherits its parent's list of candidate entries and strikes those that are farther
than the nearest one for every point of the ball.  A ball with one candidate left is wholly owned: its
cached sum and count go to the entry and no point is read.  At leaves, points are compared with the
candidates that are left.  Strikes keep a margin for rounding; comparisons are exact (integers below 2^53
in floating point, Python integers beyond).  A task adds up its blocks and returns a row per codebook
number; Spark adds these up, and only the codebooks, whose size is fixed, reach the driver.

Cases: rows whose vector is null, empty or holds null or non-finite components are dropped.  Null ids are
coded like others and come last in the order of ids; among equal ids the smaller vector comes first;
repeated rows count each time.  With fewer kept rows than entries the codebook has as many entries as
rows.  Equal entries: the lowest index wins.  An empty table gives none.  Vectors of unequal lengths, lengths
that the parts do not divide and components of 2^51 or more are errors.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldmark.llm.common import cut, tidy

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Rows of a block, at most.
BLOCK = 8192
#: Points of a leaf, at most.
LEAF = 256

_EXACT = float(1 << 53)


def _node_type(width: int) -> np.dtype:
    return np.dtype(
        [
            ("start", "<i4"), ("end", "<i4"), ("left", "<i4"), ("right", "<i4"), ("radius", "<f8"),
            ("squares", "<i8"), ("center", "<f8", (width,)), ("sums", "<i8", (width,)),
        ]
    )


def _anchors(points: np.ndarray) -> np.ndarray:
    """The anchor that owns each point."""
    n = len(points)
    owner = np.zeros(n, np.int64)
    pivots = points[:1].copy()
    reach = np.sqrt(((points - pivots[0]) ** 2).sum(axis=1))
    for k in range(1, math.isqrt(n - 1) + 1):
        far = int(reach.argmax())
        if reach[far] == 0:
            break
        pivot = points[far]
        # A point nearer to its anchor than half the way between the two pivots stays.
        half = np.sqrt(((pivots - pivot) ** 2).sum(axis=1)) / 2
        open_to = np.flatnonzero(reach >= half[owner])
        offered = np.sqrt(((points[open_to] - pivot) ** 2).sum(axis=1))
        nearer = offered < reach[open_to]
        taken = open_to[nearer]
        owner[taken], reach[taken] = k, offered[nearer]
        pivots = np.append(pivots, pivot[None], axis=0)
    return owner


class _Tree:
    """Balls over the points of one part; ``order`` lists the points leaf by leaf."""

    def __init__(self, points: np.ndarray):
        self.points = points.astype(np.float64)
        self.whole = points
        self.order: list[np.ndarray] = []
        self.placed = 0
        self.rows: list[tuple] = []
        self.root = self._build(np.arange(len(points)))

    def _ball(self, at: np.ndarray) -> tuple[np.ndarray, float, np.ndarray, int]:
        own = self.whole[at]
        sums = own.sum(axis=0)
        center = sums / len(at)
        radius = float(np.sqrt(((self.points[at] - center) ** 2).sum(axis=1).max()))
        return center, radius, sums, int((own * own).sum())

    def _leaf(self, at: np.ndarray) -> int:
        center, radius, sums, squares = self._ball(at)
        start = self.placed
        self.order.append(at)
        self.placed += len(at)
        self.rows.append((start, self.placed, -1, -1, radius, squares, center, sums))
        return len(self.rows) - 1

    def _build(self, at: np.ndarray) -> int:
        if len(at) <= LEAF:
            return self._leaf(at)
        owner = _anchors(self.points[at])
        sizes = np.bincount(owner)
        if len(sizes) == 1:  # equal points
            return self._leaf(at)
        parts = np.split(at[np.argsort(owner, kind="stable")], np.cumsum(sizes)[:-1])
        # The order of points follows the tree, so the balls are merged before anything is placed.
        balls = [self._ball(part) for part in parts]
        merges = _merged(np.array([b[0] for b in balls]), np.array([b[1] for b in balls]), sizes)
        return self._place(parts, merges)

    def _place(self, parts: list[np.ndarray], merges: list[tuple[int, int]]) -> int:
        """Nodes for the anchors, then for their merged balls."""
        nodes: list[int] = []
        turns = [len(parts) + len(merges) - 1]
        ordered: list[int] = []
        while turns:  # leaves from left to right, so that each ball is a range
            k = turns.pop()
            if k < len(parts):
                ordered.append(k)
            else:
                turns += merges[k - len(parts)][::-1]
        nodes = [-1] * (len(parts) + len(merges))
        for k in ordered:
            nodes[k] = self._build(parts[k])
        for k, (a, b) in enumerate(merges, len(parts)):
            nodes[k] = self._parent(nodes[a], nodes[b])
        return nodes[-1]

    def _parent(self, left: int, right: int) -> int:
        a, b = self.rows[left], self.rows[right]
        n_a, n_b = a[1] - a[0], b[1] - b[0]
        sums = a[7] + b[7]
        center = sums / (n_a + n_b)
        radius = max(float(np.sqrt(((r[6] - center) ** 2).sum())) + r[4] for r in (a, b))
        self.rows.append((a[0], b[1], left, right, radius, a[5] + b[5], center, sums))
        return len(self.rows) - 1

    def nodes(self) -> np.ndarray:
        """The root is the last one."""
        return np.array(self.rows, _node_type(self.points.shape[1]))


def _merged(centers: np.ndarray, radii: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of balls in the order in which they are merged; a merged ball has the next free number."""
    k = len(sizes)
    numbers = list(range(k))
    centers, radii, sizes = centers.copy(), radii.copy(), sizes.astype(np.float64)

    def with_all(i: int) -> np.ndarray:
        """Radius of the ball that would hold ball i and each other."""
        apart = np.sqrt(((centers - centers[i]) ** 2).sum(axis=1))
        share = sizes / (sizes + sizes[i])
        held = np.maximum(apart * share + radii[i], apart * (1 - share) + radii)
        held[i] = np.inf
        return held

    costs = np.array([with_all(i) for i in range(k)])
    out = []
    for made in range(k, 2 * k - 1):
        i, j = divmod(int(costs.argmin()), k)
        out.append((numbers[i], numbers[j]))
        radii[i] = costs[i, j]
        centers[i] = (centers[i] * sizes[i] + centers[j] * sizes[j]) / (sizes[i] + sizes[j])
        sizes[i] += sizes[j]
        numbers[i] = made
        costs[j], costs[:, j] = np.inf, np.inf
        gone = np.isinf(costs).all(axis=1)
        fresh = with_all(i)
        fresh[gone | (np.arange(k) == i)] = np.inf
        fresh[j] = np.inf
        costs[i], costs[:, i] = fresh, fresh
    return out


def _walk(nodes: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Wholly owned balls with their entry, and leaves with the candidates left to them."""
    book = entries.astype(np.float64)
    book_squares = (book**2).sum(axis=1)
    apart = np.sqrt(((book[:, None] - book[None]) ** 2).sum(axis=2))
    # Of equal entries only the first can win.
    first = np.array([not (entries[:k] == e).all(axis=1).any() for k, e in enumerate(entries)])
    at, masks = np.array([len(nodes) - 1]), first[None]
    owned, owners, leaves, left = [], [], [], []
    while len(at):
        centers = nodes["center"][at]
        squares = (centers**2).sum(axis=1)[:, None]
        far = np.where(masks, squares - 2 * centers @ book.T + book_squares, np.inf)
        best = far.argmin(axis=1)
        nearest = far[np.arange(len(at)), best][:, None]
        # Rounding grows with the numbers that were subtracted.
        margin = 1e-9 * (squares + book_squares.max() + 1)
        masks = masks & (far - nearest <= 2 * nodes["radius"][at][:, None] * apart[best] * (1 + 1e-9) + margin)
        single = masks.sum(axis=1) == 1
        leaf = nodes["left"][at] < 0
        owned.append(at[single])
        owners.append(best[single])
        leaves.append(at[~single & leaf])
        left.append(masks[~single & leaf])
        further = ~single & ~leaf
        masks = np.repeat(masks[further], 2, axis=0)
        at = np.column_stack([nodes["left"][at[further]], nodes["right"][at[further]]]).reshape(-1)
    return tuple(np.concatenate(found) for found in (owned, owners, leaves, left))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _nearest(points: np.ndarray, entries: np.ndarray, masks: np.ndarray | None = None) -> np.ndarray:
    """Index of the nearest entry, exactly; ties go to the lower index."""
    far = (points**2).sum(axis=1)[:, None] - 2 * (points @ entries.T) + (entries**2).sum(axis=1)
    return (far if masks is None else np.where(masks, far, np.inf)).argmin(axis=1)


def _fits(points: np.ndarray, entries: np.ndarray) -> bool:
    """True if all distances are whole numbers that floating point holds exactly."""
    largest = max(float(np.abs(a).max(initial=0)) for a in (points.astype(np.float64), entries.astype(np.float64)))
    return 4 * largest * largest * points.shape[1] * BLOCK < _EXACT


def _totals(points: np.ndarray, nodes: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number and sum of the points nearest to each entry."""
    k = len(entries)
    counts, sums = np.zeros(k, object), np.zeros((k, points.shape[1]), object)
    if not len(nodes) or not _fits(points, entries):
        own = points.astype(object)
        codes = _nearest(own, entries.astype(object)).astype(np.int64)
        for code in np.unique(codes).tolist():
            counts[code] += int((codes == code).sum())
            sums[code] += own[codes == code].sum(axis=0)
        return counts, sums
    owned, owners, leaves, masks = _walk(nodes, entries)
    held = np.zeros((k, points.shape[1] + 1))
    sizes = (nodes["end"] - nodes["start"]).astype(np.int64)
    cached = np.column_stack([sizes[owned], nodes["sums"][owned]]).astype(np.float64)
    np.add.at(held, owners, cached)
    at = _spread(nodes["start"][leaves].astype(np.int64), sizes[leaves])
    own = points[at].astype(np.float64)
    codes = _nearest(own, entries.astype(np.float64), np.repeat(masks, sizes[leaves], axis=0))
    chosen = (codes[:, None] == np.arange(k)).astype(np.float64)
    held += chosen.T @ np.column_stack([np.ones(len(own)), own])
    held = held.astype(np.int64)
    return held[:, 0].astype(object), held[:, 1:].astype(object)


def _codes(points: np.ndarray, nodes: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each point and the squared distance to it."""
    if not len(nodes) or not _fits(points, entries):
        own, book = points.astype(object), entries.astype(object)
        codes = _nearest(own, book).astype(np.int64)
        return codes, ((own - book[codes]) ** 2).sum(axis=1)
    owned, owners, leaves, masks = _walk(nodes, entries)
    sizes = (nodes["end"] - nodes["start"]).astype(np.int64)
    codes = np.zeros(len(points), np.int64)
    codes[_spread(nodes["start"][owned].astype(np.int64), sizes[owned])] = np.repeat(owners, sizes[owned])
    at = _spread(nodes["start"][leaves].astype(np.int64), sizes[leaves])
    own, book = points.astype(np.float64), entries.astype(np.float64)
    codes[at] = _nearest(own[at], book, np.repeat(masks, sizes[leaves], axis=0))
    return codes, ((own - book[codes]) ** 2).sum(axis=1).astype(np.int64)


def whole_numbers(vectors: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) as 64-bit integers."""
    scaled = np.floor(vectors.astype(np.float64) * scale)
    if (np.abs(scaled) >= 2.0**63).any():
        raise ValueError("components of 2^51 or more cannot be coded")
    return scaled.astype(np.int64)


def _packed(points: np.ndarray) -> tuple[str, bytes]:
    """The smallest integer type that holds the points, and their bytes."""
    for kind in ("<i2", "<i4", "<i8"):
        if not len(points) or np.abs(points).max() < 2 ** (8 * int(kind[2]) - 1):
            return kind, points.astype(kind).tobytes()
    return "<i8", points.astype("<i8").tobytes()


def _trees(label_type: pa.DataType, width: int, parts: int, scale: int):
    schema = pa.schema(
        [
            ("ids", pa.list_(pa.int64())),
            ("labels", pa.list_(label_type)),
            ("kinds", pa.list_(pa.string())),
            ("points", pa.list_(pa.binary())),
            ("rows", pa.list_(pa.binary())),
            ("nodes", pa.list_(pa.binary())),
        ]
    )

    def block(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, vectors, labels = batch.columns
        n = len(ids)
        sizes = np.diff(vectors.offsets.to_numpy())
        if (sizes != width).any():
            raise ValueError(f"vectors need one length: {width} and {int(sizes[sizes != width][0])} were found")
        found = whole_numbers(vectors.flatten().to_numpy(zero_copy_only=False).reshape(n, width), scale)
        kinds, points, rows, nodes = [], [], [], []
        for part in np.split(found, parts, axis=1):
            order, made = np.arange(n), np.zeros(0, _node_type(part.shape[1]))
            if _fits(part, part):
                tree = _Tree(part)
                order, made = np.concatenate(tree.order), tree.nodes()
            kind, data = _packed(part[order])
            kinds.append(kind)
            points.append(data)
            rows.append(order.astype("<i4").tobytes())
            nodes.append(made.tobytes())
        row = [[ids.to_pylist()], [labels.to_pylist()], [kinds], [points], [rows], [nodes]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, schema.types)], schema=schema)

    @tidy
    def built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            step = -(-n // -(-n // BLOCK)) if n else 1
            for at in range(0, n, step):
                yield block(batch.slice(at, step))

    return built


def _unpacked(row: dict, p: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    points = np.frombuffer(row["points"][p], row["kinds"][p]).astype(np.int64).reshape(-1, width)
    return points, np.frombuffer(row["rows"][p], "<i4"), np.frombuffer(row["nodes"][p], _node_type(width))


_TOTALS_ARROW = pa.schema([("part", pa.int32()), ("entry", pa.int32()), ("place", pa.int32()), ("total", pa.decimal128(38, 0))])


def _summed(books: np.ndarray):
    """A row per codebook number: place 0 is the count, the others are the sums of the components."""
    parts, k, width = books.shape

    @tidy
    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((parts, k, width + 1), object)
        for batch in batches:
            for row in batch.to_pylist():
                for p in range(parts):
                    points, _, nodes = _unpacked(row, p, width)
                    counts, sums = _totals(points, nodes, books[p])
                    held[p, :, 0] += counts
                    held[p, :, 1:] += sums
        p, e, c = (axis.reshape(-1).astype(np.int32) for axis in np.indices(held.shape))
        totals = pa.array([int(v) for v in held.reshape(-1)], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(p), pa.array(e), pa.array(c), totals], schema=_TOTALS_ARROW)

    return summed


def _coded(books: np.ndarray, label_type: pa.DataType):
    parts, _, width = books.shape
    schema = pa.schema([("vec_id", pa.int64()), ("label", label_type), ("code", pa.string()), ("error", pa.int64())])

    @tidy
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["ids"])
                codes, errors = np.zeros((n, parts), np.uint8), np.zeros(n, object)
                for p in range(parts):
                    points, rows, nodes = _unpacked(row, p, width)
                    codes[rows, p], apart = _codes(points, nodes, books[p])
                    errors[rows] += apart.astype(object)
                text = codes.tobytes().hex()
                names = [text[at : at + 2 * parts] for at in range(0, len(text), 2 * parts)]
                columns = (row["ids"], row["labels"], names, [int(v) for v in errors])
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, schema.types)], schema=schema)

    return coded


def digest(books: np.ndarray) -> str:
    """SHA-256 of all numbers of the codebooks, in order, as decimal text."""
    return hashlib.sha256(",".join(str(int(v)) for v in books.reshape(-1)).encode()).hexdigest()


def fit_codebooks(trees: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Lloyd's rounds from ``books`` (part x entry x component) over the written trees."""
    parts, k, width = books.shape
    for _ in range(rounds):
        totals = trees.mapInArrow(_summed(books), "part int, entry int, place int, total decimal(38,0)")
        # As many rows as the codebooks have numbers and counts.
        rows = totals.groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect()
        held = np.zeros((parts, k, width + 1), object)
        for row in rows:
            held[row["part"], row["entry"], row["place"]] = int(row["total"])
        used = held[:, :, 0] > 0
        fresh = books.astype(object)
        fresh[used] = held[used][:, 1:] // held[used][:, :1]
        books = fresh.astype(np.int64)
    return books


def vector_codes(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept row; ``entries`` is at most 256."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark = vectors.sparkSession
    kept = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
        F.col(label_column).alias("label"),
    ).filter(
        (F.size("vector") > 0)
        & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    label = kept.schema["label"].dataType
    coded_schema = f"vec_id long, label {label.simpleString()}, code string, error long"
    # As many rows as the codebook has entries.
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(entries).collect()
    if not first:
        return spark.createDataFrame(
            [], "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
        )
    width = len(first[0]["vector"])
    if width % parts or any(len(r["vector"]) != width for r in first):
        raise ValueError(f"vectors need one length that {parts} divides: {sorted({len(r['vector']) for r in first})}")
    start = whole_numbers(np.array([r["vector"] for r in first]), scale)
    books = np.stack(np.split(start, parts, axis=1))
    arrow_label = to_arrow_type(label)
    tree_schema = (
        f"ids array<long>, labels array<{label.simpleString()}>, kinds array<string>, points array<binary>, "
        "rows array<binary>, nodes array<binary>"
    )
    trees = cut(kept.mapInArrow(_trees(arrow_label, width, parts, scale), tree_schema), "trees")
    books = fit_codebooks(trees, books, rounds)
    coded = cut(trees.mapInArrow(_coded(books, arrow_label), coded_schema), "codes")
    # Written, so that the join's choice rests on the table's real size.
    totals = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    totals = cut(totals, "label-errors")
    return coded.join(totals, F.col("label").eqNullSafe(F.col("_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
