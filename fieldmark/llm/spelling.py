"""Spelling variants: a bit-sliced position index over the vocabulary finds the words one edit away.

Words are counted in Spark.  Two words are near if one inserted, deleted or replaced code point turns
one into the other; a word's form is its near word of largest count (ties: the smallest in code-point
order) where that count is at least ``RATIO`` times the word's own.

**Index.**  A block of words has one bitset per (position, letter): which of its words have that letter
there.  All words of the block are looked up in it at once.  The recurrence goes over the positions of
the looked-up words and keeps two bitsets for each of them: words met without an error so far, and words
met with one error, which is a replaced letter (next position of both), an inserted letter (the index is
read one position further on from then on) or none yet.  64 words are handled by one machine word.

**Dealing.**  One edit leaves the first or the last half of the shorter word as it is.  So each word goes
to the group of its first half and to that of its last half, once as the shorter or equal word and once as
the longer one: four rows a word, and each near pair meets in exactly one group.  A group of more than
``CROWD`` words (a beginning that very many words share) is dealt once more by the whole word but one
position, which at most the alphabet's number of words share for each position; nothing is left out.
Tasks return one row per word and group: how many words are near and which counts most.

``root`` follows the forms to the last one by pointer jumping.  Counts grow ``RATIO`` times with each
form, so the number of jumps is bounded by the largest count.

Cases: a null text has no words; a null id is the empty text in what is hashed; repeated rows and texts
count each time; ties are settled by the code points; an empty table gives none; other columns are not
read.  A word whose h is divided by ``EVERY`` loses one code point, as the contract says.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fieldmark.llm.common import cut, tidy

LEAST_LENGTH = 6
LEAST_COUNT = 5
RATIO = 5
EVERY = 199
#: Words of one index.
BLOCK = 2048
#: Words of a group above which it is dealt again.
CROWD = 4096

# The letters of a word, and those that are lower-cased.
RUN = "[A-Za-zÀ-ÿ]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", every: int = EVERY
) -> DataFrame:
    """(word, n): the words of at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences."""
    doc_id = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    runs = docs.select(
        doc_id.alias("doc_id"), F.explode(F.regexp_extract_all(text_column, F.lit(RUN), F.lit(0))).alias("run")
    )
    # Runs below the least length cannot become words.
    runs = runs.filter(F.length("run") >= LEAST_LENGTH)
    lowered = F.translate("run", _UPPER, _LOWER)
    runs = runs.select(lowered.alias("run"), F.crc32(F.concat("doc_id", F.lit(":"), lowered)).alias("h"))
    spot = (F.col("h") % F.length("run")).cast("int")
    without = F.concat(F.substring("run", F.lit(1), spot), F.substring("run", spot + 2, F.length("run")))
    word = F.when(F.col("h") % every == 0, without).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).filter(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A row of code points per word, filled up with zeros, and the lengths."""
    texts = words.to_pylist()
    lengths = np.array([len(t) for t in texts], np.int64)
    width = int(lengths.max(initial=1))
    joined = "".join(t.ljust(width, "\0") for t in texts)
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(-1, width).astype(np.int32), lengths


class Index:
    """Bitsets of one block of words by (position, letter)."""

    def __init__(self, letters: np.ndarray):
        self.n, width = letters.shape
        self.words = -(-self.n // 64)
        alphabet, spots = np.unique(letters, return_inverse=True)
        self.spots = spots.reshape(letters.shape)
        #: Position (one past the last is empty) x letter x 64-bit words.
        self.sets = np.zeros((width + 1, len(alphabet), self.words), np.uint64)
        for p in range(width):
            bits = np.zeros((len(alphabet), self.words * 64), bool)
            bits[self.spots[:, p], np.arange(self.n)] = True
            self.sets[p] = np.packbits(bits, axis=-1, bitorder="little").view(np.uint64)

    def near(self, asked: np.ndarray, length: int, further: int) -> np.ndarray:
        """For each asked word of the block, all of ``length`` letters, the bitset of those one edit away.

        The words met have ``length + further`` letters, where ``further`` is 0 (a letter replaced) or 1
        (a letter inserted); those of other lengths have to be masked by the caller.
        """
        none = np.full((len(asked), self.words), ~np.uint64(0))
        one = np.zeros_like(none)
        for p in range(length):
            spots = self.spots[asked, p]
            here = self.sets[p][spots]
            if further:
                # Made before or made here: from the error on, letters are read one position further on.
                one |= none
                one &= self.sets[p + 1][spots]
            else:
                one &= here
                one |= none & ~here
            none &= here
        # What has no error yet lacks the longer word's last letter.
        return one | none if further else one


def _bits(sets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the bits that are set."""
    rows, words = np.nonzero(sets)
    spread = np.unpackbits(sets[rows, words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    hit, bit = np.nonzero(spread)
    return rows[hit], words[hit] * 64 + bit


def _pairs(
    letters: np.ndarray, lengths: np.ndarray, groups: np.ndarray, longer: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Near pairs inside the groups of one block, each in both directions; two longer words do not meet."""
    index = Index(letters)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for length in np.unique(lengths[~longer]).tolist():
        asked = np.flatnonzero((lengths == length) & ~longer)
        for further in (0, 1):
            met = (lengths == length + further) & (longer == bool(further))
            if not met.any():
                continue
            mask = np.zeros(index.words * 64, bool)
            mask[: index.n] = met
            mask = np.packbits(mask, bitorder="little").view(np.uint64)
            rows, columns = _bits(index.near(asked, length, further) & mask)
            rows = asked[rows]
            same = groups[rows] == groups[columns]
            rows, columns = rows[same], columns[same]
            left += [rows, columns][: 1 + further]
            right += [columns, rows][: 1 + further]
    return np.concatenate(left), np.concatenate(right)


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut between groups; the column ``group`` ascends."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        groups = batch.column("group")
        n = batch.num_rows
        if not n:
            continue
        codes = groups.dictionary_encode().indices.to_numpy()
        cuts = np.flatnonzero(codes[1:] != codes[:-1]) + 1
        if not len(cuts):
            held.append(batch)
            continue
        last = int(cuts[-1])
        yield pa.Table.from_batches([*held, batch.slice(0, last)]).combine_chunks().to_batches()[0]
        held = [batch.slice(last)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


_FOUND = "word string, n long, near long, best_n long, best string"
_FOUND_ARROW = pa.schema(
    [("word", pa.string()), ("n", pa.int64()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]
)


def _block_near(
    words: pa.Array, counts: np.ndarray, groups: np.ndarray, ends: np.ndarray, longer: np.ndarray
) -> pa.RecordBatch | None:
    """What one block finds.  ``ends`` is true for the rows dealt by their last halves."""
    letters, lengths = _code_points(words)
    left, right = _pairs(letters, lengths, groups, longer)
    if len(left):
        # A pair whose first halves agree meets by them; by the last halves only the others do.
        half = np.minimum(lengths[left], lengths[right]) // 2
        unlike = (letters[left] != letters[right]) & (np.arange(letters.shape[1]) < half[:, None])
        kept = ~ends[left] | unlike.any(axis=1)
        left, right = left[kept], right[kept]
    if not len(left):
        return None
    near = np.bincount(left, minlength=len(counts))
    # The best of each word: largest count, then the smallest word.
    names = np.empty(len(counts), np.int64)
    names[np.lexsort(letters.T[::-1])] = np.arange(len(counts))
    order = np.lexsort((names[right], -counts[right], left))
    firsts = order[np.append(True, left[order][1:] != left[order][:-1])]
    own, best = left[firsts], right[firsts]
    return pa.RecordBatch.from_arrays(
        [words.take(pa.array(own)), pa.array(counts[own]), pa.array(near[own]), pa.array(counts[best]), words.take(pa.array(best))],
        schema=_FOUND_ARROW,
    )


@tidy
def _near_in_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _by_group(batches):
        codes = batch.column("group").dictionary_encode().indices.to_numpy()
        words, counts, shorter = batch.column("word"), batch.column("n").to_numpy(), batch.column("shorter").to_numpy()
        ends, longer = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("ending", "longer"))
        starts = np.append(np.flatnonzero(np.append(True, codes[1:] != codes[:-1])), len(codes))
        # Groups of one length stand together, so a block's letters fill a rectangle.
        turns = np.append(np.flatnonzero(np.diff(shorter[starts[:-1]])) + 1, len(starts) - 1)
        at = 0
        while at < len(starts) - 1:
            # Whole groups up to the block's size; a larger group is a block of its own.
            size = max(1, BLOCK * LEAST_LENGTH * 4 // max(int(shorter[starts[at]]), LEAST_LENGTH * 4))
            to = int(np.searchsorted(starts, starts[at] + size, "right")) - 1
            to = max(at + 1, min(to, int(turns[np.searchsorted(turns, at, "right")])))
            a, b = int(starts[at]), int(starts[to])
            if b - a > to - at:  # else every group has one word
                found = _block_near(words.slice(a, b - a), counts[a:b], codes[a:b], ends[a:b], longer[a:b])
                if found is not None:
                    yield found
            at = to


def _halves(words: DataFrame) -> DataFrame:
    """Four rows a word: by first and last half, as the shorter (or equal) and as the longer word."""
    length = F.length("word")

    def dealt(ending: bool, longer: bool) -> Column:
        m = length - 1 if longer else length
        kept = (m - F.floor(m / 2)) if ending else F.floor(m / 2)
        kept = kept.cast("int")
        part = F.substring("word", length - kept + 1, kept) if ending else F.substring("word", F.lit(1), kept)
        key = F.concat(F.lit(">" if ending else "<"), m.cast("string"), F.lit(":"), part)
        columns = {"group": key, "shorter": m, "ending": F.lit(ending), "longer": F.lit(longer)}
        return F.struct(*[c.alias(name) for name, c in columns.items()])

    cases = [dealt(e, l) for e in (False, True) for l in (False, True)]
    return words.select("word", "n", F.inline(F.array(*cases)))


def _but_one(crowded: DataFrame) -> DataFrame:
    """Members of crowded groups, dealt by the group and the word without one position.

    Equal lengths meet by the position that is left out; a longer word meets the shorter by what is left.
    """
    length = F.length("word")

    def without(p: Column) -> Column:
        return F.concat(F.substring("word", F.lit(1), p - 1), F.substring("word", p + 1, length))

    spots = F.sequence(F.lit(1), length)
    equal = F.transform(spots, lambda p: F.concat(p.cast("string"), F.lit("/"), without(p)))
    shorter = F.array(F.concat(F.lit("0/"), F.col("word")))
    longer = F.array_distinct(F.transform(spots, lambda p: F.concat(F.lit("0/"), without(p))))
    keys = F.when(F.col("longer"), longer).otherwise(F.concat(equal, shorter))
    dealt = crowded.withColumn("_rest", F.explode(keys))
    return dealt.withColumn("group", F.concat("group", F.lit("|"), "_rest")).drop("_rest")


def near_words(words: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(word, n_near, form_n, form) of the words of ``vocabulary`` that have near words.

    ``crowd`` changes how the work is cut, not the result.
    """
    dealt = _halves(words)
    sizes = dealt.groupBy("group").agg(F.count("*").alias("_held"))
    # The crowded groups: at most four rows a word over ``crowd``.
    crowded = cut(sizes.filter(F.col("_held") > crowd).select(F.col("group").alias("_g")), "crowded")
    fine = dealt.join(crowded, F.col("group") == F.col("_g"), "left_anti")
    again = _but_one(dealt.join(crowded, F.col("group") == F.col("_g"), "left_semi"))
    placed = fine.unionByName(again).repartition(F.col("group")).sortWithinPartitions("shorter", "group")
    found = placed.mapInArrow(_near_in_groups, _FOUND)
    return found.groupBy("word").agg(
        F.sum("near").alias("n_near"),
        F.max("best_n").alias("best_n"),
        F.min(F.struct((-F.col("best_n")).alias("k"), F.col("best").alias("best"))).getField("best").alias("best"),
    )


def variants(words: DataFrame, crowd: int = CROWD, ratio: int = RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word; see the module's description."""
    words = cut(words, "words")
    near = near_words(words, crowd).withColumnRenamed("word", "_w")
    enough = F.col("best_n") >= F.col("n") * ratio
    formed = words.join(near, F.col("word") == F.col("_w"), "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(enough, F.col("best")).alias("form"),
        F.when(enough, F.col("best_n")).alias("form_n"),
    )
    formed = cut(formed, "forms")
    largest = formed.agg(F.max("n")).first()[0] or 1
    steps = max(1, math.ceil(math.log(max(largest, ratio), ratio)))
    jumps = formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps + 1))):
        onward = jumps.select(F.col("word").alias("_w"), F.col("root").alias("_next"))
        jumps = jumps.join(onward, F.col("root") == F.col("_w"), "left").select(
            "word", F.coalesce("_next", "root").alias("root")
        )
        jumps = cut(jumps, "roots")
    roots = jumps.select(F.col("word").alias("_w"), F.col("root").alias("_root"))
    return formed.join(roots, F.col("word") == F.col("_w"), "left").select(
        "word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``variants`` of the words of all texts."""
    return variants(vocabulary(docs, id_column, text_column))
