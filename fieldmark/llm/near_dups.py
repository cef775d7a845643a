"""Near-duplicates by BagMinHash: weighted-Jaccard signatures, banding, verified multiset overlap.

A document is the multiset of its five-word shingles.  Two documents are linked if their weighted
Jaccard similarity (shared shingles with multiplicity over all) is at least 0.8; a class is a
connected component of links.

Signatures.  Weights are discretised into rings (0, 1], (1, 2], (2, 4], (4, 8], ...  Every pair of
shingle and ring drives a Poisson process of points, each with a time, a signature position and a
weight level within the ring; a document sees the points up to its weight.  The first time per
position is the signature, two signatures agree at a position with exactly the probability of the
weighted Jaccard similarity.  A process is followed only while its time is below the latest first
time so far, so a document costs its shingles plus m log m points, not m times its shingles.

Classes.  Documents with equal words are one node (an aggregation, so copies cost nothing further).
Nodes that share a band hang together loosely.  Each loose component is cut into blocks of bounded
size by hash, and for each pair of blocks exact overlaps of all its documents come from blocked
matrix products; a task returns a spanning forest of the links that hold, not the pairs.  The
forests' components are the classes.  No candidate is left out or capped: at a similarity of 0.8 a
pair shares none of 32 bands of 4 with probability 5e-8.

Words are runs of letters, digits and non-ASCII characters, in lower case.  Cases: a document of
fewer than five words has one shingle of all its words; a null, empty or wordless text is a class of
its own; equal ids and repeated rows are documents like others, null ids rank last.  An empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from fieldmark.llm.common import Spans, cut, mix, partitions, release, shingles, slices, tidy, utf8, word_bounds
from fieldmark.llm.graphs import components

WIDTH = 5
SIMILARITY = 0.8
POSITIONS = 128
BAND = 4
#: Documents and shingles of a block, about; two blocks meet in a task.
BLOCK = 256
BLOCK_SHINGLES = 1 << 17
#: Points of all processes that are drawn at once.
DRAWN = 1 << 18
#: Columns of the overlap matrices at a time.
COLUMNS = 4096
#: Bits of the table that keeps texts without candidates from being read into a shuffle.
FILTER_BITS = 23

_STEP = np.uint64(0x9E3779B97F4A7C15)


def bags(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shingle hashes and their rows, in text order, and each row's hash of its words (0: no words)."""
    data, offsets = utf8(pc.utf8_lower(column))
    starts, ends, rows = word_bounds(data, offsets)
    n = len(column)
    nodes = np.zeros(n, np.uint64)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), nodes
    words = Spans(data).hashed(starts, ends)
    found, of = shingles(words, rows, n, WIDTH)
    # The words in order: a polynomial in the words' hashes.
    place = np.arange(len(words)) - np.searchsorted(rows, rows)
    terms = mix(words + mix(place.astype(np.uint64) + np.uint64(1)))
    firsts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    sums = np.add.reduceat(terms, firsts)
    sizes = np.diff(np.append(firsts, len(words))).astype(np.uint64)
    nodes[rows[firsts]] = mix(sums + sizes) | np.uint64(1)
    return found, of, nodes


def signatures(found: np.ndarray, rows: np.ndarray, n_rows: int, positions: int = POSITIONS) -> np.ndarray:
    """BagMinHash signatures of weighted sets: an (n_rows, positions) array; rows without elements are infinite."""
    first = np.full((n_rows, positions), np.inf)
    if not len(found):
        return first
    order = np.lexsort((found, rows))
    found, rows = found[order], rows[order]
    new = np.concatenate([[True], (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])])
    at = np.flatnonzero(new)
    weight = np.diff(np.append(at, len(found)))
    found, rows = found[at], rows[at]
    rings = np.ceil(np.log2(weight)).astype(np.int64) + 1
    of = np.repeat(np.arange(len(found)), rings)
    ring = np.arange(len(of)) - np.repeat(np.cumsum(rings) - rings, rings)
    seed = mix(found[of] + ring.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    low = np.where(ring > 0, 2.0 ** (ring - 1), 0.0)
    width = np.where(ring > 0, low, 1.0)
    weight, row = weight[of].astype(float), rows[of]
    time = np.zeros(len(of))
    flat = first.reshape(-1)
    done, take = 0, 1
    while len(seed):
        steps = np.arange(done + 1, done + take + 1, dtype=np.uint64) * _STEP
        draw = mix(seed[:, None] + steps)
        gaps = -np.log1p(-(draw >> np.uint64(11)).astype(float) * 2.0**-53) / (width[:, None] * positions)
        gaps[:, 0] += time
        times = np.cumsum(gaps, axis=1)
        second = mix(draw)
        position = (second & np.uint64(positions - 1)).astype(np.int64)
        level = low[:, None] + width[:, None] * ((second >> np.uint64(11)).astype(float) * 2.0**-53)
        seen = level <= weight[:, None]
        np.minimum.at(flat, (row[:, None] * positions + position)[seen], times[seen])
        time = times[:, -1]
        going = time < first.max(axis=1)[row]
        seed, low, width, weight, row, time = (x[going] for x in (seed, low, width, weight, row, time))
        done += take
        take = min(64, max(1, done // 2), max(1, DRAWN // max(1, len(seed))))
    return first


def bands(signature: np.ndarray, size: int = BAND) -> np.ndarray:
    """A key per band and row; the band's number is part of the key."""
    bits = signature.view(np.uint64)
    count = bits.shape[1] // size
    key = np.broadcast_to(mix(np.arange(1, count + 1, dtype=np.uint64)), (len(bits), count))
    for k in range(size):
        key = mix(key + bits[:, k::size][:, :count])
    return key


_SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("node", pa.int64()), ("size", pa.int64()), ("bands", pa.list_(pa.int64()))]
)


@tidy
def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Id, node, number of shingles and band keys of each row."""
    release()
    for batch in batches:
        for a, b in slices(batch.column(1)):
            part = batch.slice(a, b - a)
            found, rows, nodes = bags(part.column(1))
            keys = bands(signatures(found, rows, len(part))).view(np.int64)
            bounds = pa.array(np.arange(len(part) + 1, dtype=np.int32) * keys.shape[1])
            lists = pa.ListArray.from_arrays(bounds, pa.array(keys.reshape(-1)))
            node = pa.array(nodes.view(np.int64), mask=nodes == 0)
            size = pa.array(np.bincount(rows, minlength=len(part)))
            yield pa.RecordBatch.from_arrays([part.column(0), node, size, lists], schema=_SIGNED)


_BAGS = pa.schema([("node", pa.int64()), ("bag", pa.binary())])


def _wanted_slot(nodes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    return (mix(nodes.view(np.uint64) ^ mix(ids.view(np.uint64))) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


def _bit_table(wanted: DataFrame) -> bytes:
    """A table of 2**FILTER_BITS bits that is set for each (node, id) of ``wanted``, whatever their number."""

    @tidy
    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.unique(_wanted_slot(batch.column(0).to_numpy(), _ids(batch.column(1))))
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32))], names=["slot"])

    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[wanted.mapInArrow(slots, "slot int").distinct().toArrow().column(0).to_numpy()] = True
    return np.packbits(bits).tobytes()


def _bags_of(shared):
    @tidy
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The sorted shingles of the rows that the table lets through."""
        release()
        wanted = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        for batch in batches:
            for a, b in slices(batch.column(1)):
                part = batch.slice(a, b - a)
                found, rows, nodes = bags(part.column(1))
                chosen = (nodes != 0) & wanted[_wanted_slot(nodes, _ids(part.column(0)))]
                if not chosen.any():
                    continue
                at = np.searchsorted(rows, np.arange(len(part) + 1))
                packed = [np.sort(found[at[r] : at[r + 1]]).tobytes() for r in np.flatnonzero(chosen)]
                columns = [pa.array(nodes[chosen].view(np.int64)), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=_BAGS)

    return made


def overlaps(bags_: list[np.ndarray]) -> np.ndarray:
    """Exact multiset overlaps of sorted shingle arrays, all against all."""
    sizes = np.array([len(b) for b in bags_])
    joined = np.concatenate(bags_)
    owner = np.repeat(np.arange(len(bags_)), sizes)
    # The second, third, ... copy of a shingle in a bag counts as a shingle of its own.
    new = np.concatenate([[True], (joined[1:] != joined[:-1]) | (owner[1:] != owner[:-1])])
    starts = np.flatnonzero(new)
    copy = np.arange(len(joined)) - np.repeat(starts, np.diff(np.append(starts, len(joined))))
    element = mix(joined + copy.astype(np.uint64) * _STEP)
    _, number, count = np.unique(element, return_inverse=True, return_counts=True)
    shared = count[number] > 1
    number, owner = number[shared], owner[shared]
    _, number = np.unique(number, return_inverse=True)
    total = np.zeros((len(bags_), len(bags_)), np.float32)
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    for start in range(0, int(number[-1]) + 1 if len(number) else 0, COLUMNS):
        a, b = np.searchsorted(number, [start, start + COLUMNS])
        matrix = np.zeros((len(bags_), COLUMNS), np.float32)
        matrix[owner[a:b], number[a:b] - start] = 1
        total += matrix @ matrix.T
    return total


def forest(nodes: np.ndarray, bags_: list[np.ndarray], similarity: float = SIMILARITY) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest of the pairs that are similar enough: each node with its tree's first."""
    sizes = np.array([len(b) for b in bags_], float)
    shared = overlaps(bags_).astype(float)
    linked = shared >= similarity * (sizes[:, None] + sizes[None, :] - shared) - 1e-9
    label = np.arange(len(nodes))
    while True:
        lowest = np.where(linked, label[None, :], len(nodes)).min(axis=1)
        lowest = np.minimum(lowest, label)
        lowest = lowest[lowest]
        if np.array_equal(lowest, label):
            break
        label = lowest
    hung = label != np.arange(len(nodes))
    return nodes[hung], nodes[label[hung]]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


@tidy
def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group; each group is a pair of blocks."""
    group, nodes, held = None, [], []

    def close() -> pa.RecordBatch:
        a, b = forest(np.array(nodes, np.int64), held)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], schema=_LINKS)

    for batch in batches:
        for node, bag, *key in zip(*(batch.column(k).to_pylist() for k in range(5))):
            if key != group:
                if len(nodes) > 1:
                    yield close()
                group, nodes, held = key, [], []
            nodes.append(node)
            held.append(np.frombuffer(bag, np.uint64))
    if len(nodes) > 1:
        yield close()


def _candidates(signed: DataFrame) -> DataFrame:
    """(node, root) of the loose components: nodes that share a band hang below the least of the band."""
    nodes = signed.where("node IS NOT NULL").dropDuplicates(["node"])
    keys = nodes.select("node", F.explode("bands").alias("band"))
    least = keys.groupBy(F.col("band").alias("k")).agg(F.min("node").alias("least"), F.count("*").alias("n"))
    least = least.where("n > 1").select("k", "least")
    loose = keys.join(least, F.col("band") == F.col("k")).where("node <> least")
    return components(loose.select(F.col("node").alias("a"), F.col("least").alias("b")))


def classes(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (the class's least id), ``node`` (equal for equal words), ``root``.

    ``root`` tells classes apart even where ids are null or repeated; it is null for a wordless text.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    signed = cut(texts.mapInArrow(_signed, "doc_id long, node long, size long, bands array<long>"), "signed")
    loose = _candidates(signed)

    # One text per node: that of its least id.  A table of bits, of fixed size, keeps all others back.
    least = signed.where("node IS NOT NULL").groupBy("node")
    least = least.agg(F.min("doc_id").alias("least"), F.first("size").alias("size"))
    loose = cut(loose.join(least, "node"), "candidates")
    shared = spark.sparkContext.broadcast(_bit_table(loose.select("node", "least")))
    kept = texts.mapInArrow(_bags_of(shared), "node long, bag binary")

    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("size") / BLOCK_SHINGLES)).cast("int")
    sizes = loose.groupBy(F.col("root").alias("r")).agg(blocks.alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = loose.join(sizes, F.col("root") == F.col("r")).select("node", "root", "blocks", block.alias("own"))
    meets = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = dealt.select(F.col("node").alias("n"), "root", "own", meets.alias("other"))
    dealt = dealt.select("n", "root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    kept = kept.dropDuplicates(["node"])
    pairs = kept.join(dealt, F.col("node") == F.col("n")).select("node", "bag", "root", "i", "j")
    pairs = pairs.repartition(partitions(spark), "root", "i", "j").sortWithinPartitions("root", "i", "j")
    links = cut(pairs.mapInArrow(_linked, "a long, b long"), "verified")

    roots = components(links)
    rows = signed.select("doc_id", "node")
    rooted = rows.join(roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
    rooted = rooted.select("doc_id", "node", F.coalesce("root", "node").alias("root"))
    lowest = rooted.where("root IS NOT NULL").groupBy(F.col("root").alias("r")).agg(F.min("doc_id").alias("lowest"))
    # Written, so that both sides of the join are dealt for it alone and a large class can be split.
    lowest = cut(lowest, "lowest")
    judged = rooted.join(lowest, F.col("root") == F.col("r"), "left")
    class_id = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("lowest"))
    return judged.select("doc_id", class_id.alias("class_id"), "node", "root")


def one_per_class(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` without those that another of their class stands for, all columns as they were.

    The row of the least id stays; of rows that share that id, the one of the least words' hash, and
    one of each set of repeated rows.  Wordless texts all stay.
    """
    judged = classes(docs, id_column, text_column)
    stays = judged.where("root IS NOT NULL AND doc_id <=> class_id").groupBy("root")
    stays = stays.agg(F.min("node").alias("stay_node"), F.first("class_id").alias("stay_id"))
    stays = cut(stays.select("stay_node", "stay_id"), "stays")
    shared = docs.sparkSession.sparkContext.broadcast(_bit_table(stays))
    mark = "node"
    while mark in docs.columns:
        mark += "_"
    at_id, at_text = docs.columns.index(id_column), docs.columns.index(text_column)

    @tidy
    def noted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows that the table lets through, and the wordless ones, with their node."""
        release()
        wanted = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        for batch in batches:
            for a, b in slices(batch.column(at_text)):
                part = batch.slice(a, b - a)
                nodes = bags(part.column(at_text))[2]
                chosen = (nodes == 0) | wanted[_wanted_slot(nodes, _ids(part.column(at_id).cast(pa.int64())))]
                marked = part.append_column(mark, pa.array(nodes.view(np.int64), mask=nodes == 0))
                yield marked.filter(pa.array(chosen))

    rows = docs.mapInArrow(noted, docs.withColumn(mark, F.lit(None).cast("long")).schema)
    # Wordless rows have no node; a key from their id keeps them apart.
    key, nth = mark + "_key", mark + "_nth"
    while {key, nth} & set(docs.columns):
        key, nth = key + "_", nth + "_"
    rows = rows.withColumn(key, F.coalesce(F.col(mark), F.xxhash64(id_column, text_column))).alias("d")
    kept = rows.join(stays.alias("s"), F.col(f"d.{key}") == F.col("s.stay_node"), "left")
    own_id = F.col(f"d.`{id_column}`").cast("long").eqNullSafe(F.col("s.stay_id"))
    kept = kept.withColumn(nth, F.row_number().over(Window.partitionBy(key, own_id).orderBy(key)))
    stay = own_id & (F.col(nth) == 1) & F.col("s.stay_node").isNotNull()
    return kept.where(F.col(mark).isNull() | stay).select(*(F.col(f"d.`{c}`") for c in docs.columns))
