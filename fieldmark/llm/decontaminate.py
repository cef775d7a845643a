"""Benchmark decontamination by template canonicalisation.

Texts become templates: numbers, names and units are replaced with typed placeholders, all other
words are lower-cased.  Windows of five template tokens of the documents are hash-joined with those
of the benchmark, so a question whose values were changed still meets its template.  Slot
consistency then tells a re-parameterised question from chance: every value of the item must always
stand for the same value of the document.

An alignment is the distance between a window's place in the document and in the item; tokens put in
or left out shift it.  Alignments of a pair whose neighbours differ by no more tokens than the item
has make a run.  In a run alignments are taken in order of their windows, most first, each if the
slots of all that are taken stay consistent.  An item leaks into a document if those taken hold at
least 0.8 of its windows.  Names are told by capitals, which sentence borders blur, so windows
are made in three forms, and an item leaks if any form says so: without name placeholders, with them
for the capitalised words that do not begin a sentence, and with them for capitalised words at any
place, ``FUNCTION_WORDS`` aside.

Token rules: a number begins with a digit, parts joined by one point or comma are one number; a unit
is a word of ``UNITS`` right after a number; a run of names in a sentence is one name.  Windows without
a literal word are left out on both sides.

What is broadcast is a table of 2**FILTER_BITS bits over the benchmark's window hashes, of fixed
size however large the benchmark; what passes it goes through Spark's join.

Cases: an item of fewer than five tokens has one shorter window; documents are searched for windows
of those widths from two on, so such an item leaks wherever it stands as a whole with consistent slots.
An item below ``shortest`` tokens (by default of one, a word) only meets documents that are the item.  Null and empty texts and items match nothing; repeated items each give a row,
repeated documents too; equal ids with different texts are told apart by their text's hash.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldmark.llm.common import Spans, cut, release, shingles, slices, tidy, utf8, word_bounds

WIDTH = 5
SHARE = 0.8
FILTER_BITS = 20
#: Least number of tokens of an item that is searched inside longer documents, if the caller does not say.
SHORTEST = 2
#: Name placeholders: none, inside sentences, anywhere.
FORMS = (0, 1, 2)

#: Unit words and signs, lower case.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles mg g kg lb lbs oz ounce ounces ton tons tonne "
    "tonnes ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours "
    "day days week weeks month months year years dollar dollars euro euros pound pounds cent cents percent degree "
    "degrees meter meters metre metres kilometer kilometers kilometre kilometres gram grams kilogram kilograms"
).split()

#: Words that begin sentences without being names, lower case; no word that is a given name too.
FUNCTION_WORDS = (
    "a about above after again all also although among an and another any anyone are as at be because been before "
    "below between both but by can could did do does during each either else every everyone few finally find first "
    "for from given had has have he hence her here hers him his how however i if in into is it its later less let "
    "many more most much must my neither next no nobody none nor not now of off on once one only or other our out "
    "over per perhaps second several she should since so some such than that the their them then there therefore "
    "these they this those though through thus to together too two under unless until up was we were what when "
    "whenever where whether which while who whom whose why with within without would yet you your"
).split()

_NUMBER, _NAME, _UNIT = (np.uint64(k) for k in (0x6E756D, 0x6E616D65, 0x756E6974))


def _lowered(data: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 letters in lower case; no byte moves."""
    out = data + np.where((data >= 65) & (data <= 90), 32, 0).astype(np.uint8)
    wide = np.flatnonzero(data[:-1] == 0xC3) + 1
    capital = wide[(data[wide] >= 0x80) & (data[wide] <= 0x9E) & (data[wide] != 0x97)]
    out[capital] += 0x20
    return out


def _word_hashes(words: list[str]) -> np.ndarray:
    joined = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = word_bounds(joined, np.array([0, len(joined)]))
    return np.sort(Spans(joined).hashed(starts, ends))


_UNIT_HASHES = _word_hashes(UNITS)
_FUNCTION_HASHES = _word_hashes(FUNCTION_WORDS)


class Words:
    """The words of a string column and what is known of each in any form."""

    def __init__(self, column: pa.Array):
        self.data, offsets = utf8(column)
        self.n_rows = len(column)
        self.starts, self.ends, self.rows = word_bounds(self.data, offsets)
        if not len(self.starts):
            return
        starts, ends, rows = self.starts, self.ends, self.rows
        token = Spans(_lowered(self.data)).hashed(starts, ends)
        first = np.concatenate([[True], rows[1:] != rows[:-1]])
        gap = np.where(first, 0, starts - np.concatenate([[0], ends[:-1]]))
        after = self.data[np.maximum(starts - 1, 0)]
        number = (self.data[starts] >= 48) & (self.data[starts] <= 57)
        follows_number = np.concatenate([[False], number[:-1]]) & ~first
        unit = follows_number & ~number & (gap <= 1) & np.isin(token, _UNIT_HASHES)
        self.literal = ~number & ~unit
        self.joined = number & follows_number & (gap == 1) & ((after == 46) | (after == 44))
        self.token = np.where(number, _NUMBER, np.where(unit, _UNIT, token))
        # A sentence begins a text and follows a point, question or exclamation mark, colon or line end.
        ending = np.isin(self.data, np.frombuffer(b".!?:\n", np.uint8))
        count = np.concatenate([[0], np.cumsum(ending)])
        self.begins = first | (count[starts] > count[np.concatenate([[0], ends[:-1]])])
        self.follows = ~self.begins & (gap == 1)
        head, second = self.data[starts], self.data[np.minimum(starts + 1, len(self.data) - 1)]
        wide = (head == 0xC3) & (second >= 0x80) & (second <= 0x9E)
        capital = ((head >= 65) & (head <= 90)) | wide
        # Words all in capitals are shouted, not names.
        small = np.concatenate([[0], np.cumsum((self.data >= 97) & (self.data <= 122))])
        self.capital = self.literal & capital & (small[ends] > small[starts])

    def names(self, form: int) -> np.ndarray:
        """The words that are names, or parts of one, in a form."""
        if form == 0:
            return np.zeros(len(self.starts), bool)
        if form == 1:
            return self.capital & ~self.begins
        at = np.flatnonzero(self.capital)
        names = np.zeros(len(self.starts), bool)
        names[at] = ~np.isin(self.token[at], _FUNCTION_HASHES)
        return names


class Templates:
    """The template tokens of words, in one form."""

    def __init__(self, words: Words, form: int):
        self.data, self.n_rows = words.data, words.n_rows
        if not len(words.starts):
            none = np.zeros(0, np.int64)
            self.token, self.rows, self.starts, self.ends, self.literal = none.astype(np.uint64), none, none, none, none
            return
        starts, ends, rows = words.starts, words.ends, words.rows
        name = words.names(form)
        token = np.where(name, _NAME, words.token)
        joined = words.joined | (name & np.concatenate([[False], name[:-1]]) & words.follows)
        literal = words.literal & ~name
        kept = ~joined
        # A token that others were joined to ends where the last of them ends.
        group = np.cumsum(kept) - 1
        last = np.zeros(int(group[-1]) + 1, np.int64)
        last[group] = ends
        self.token, self.rows, self.starts, self.ends = token[kept], rows[kept], starts[kept], last
        self.literal = literal[kept]

    def windows(self, widths: Sequence[int] = ()) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hash, row, first token and width of each window that has a literal word.

        A row of fewer than ``WIDTH`` tokens has one window of all of them; ``widths`` are shorter
        ones whose windows are added in rows of more tokens.
        """
        if not len(self.token):
            return self.token, self.rows, self.rows, self.rows
        counts = np.bincount(self.rows, minlength=self.n_rows)
        firsts = np.cumsum(counts) - counts
        seen = np.concatenate([[0], np.cumsum(self.literal)])
        made = []
        for width in (WIDTH, *widths):
            hashes, rows = shingles(self.token, self.rows, self.n_rows, width)
            first = firsts[rows]
            # Windows of a row follow each other from its first token on.
            begun = np.concatenate([[True], rows[1:] != rows[:-1]])
            place = np.arange(len(rows)) - np.maximum.accumulate(np.where(begun, np.arange(len(rows)), 0))
            at = first + place
            to = np.minimum(at + width, (first + counts[rows]))
            some = seen[to] > seen[at]
            if width < WIDTH:
                some &= counts[rows] > width
            made.append((hashes[some], rows[some], at[some], (to - at)[some]))
        return tuple(np.concatenate(arrays) for arrays in zip(*made))

    def slots(self, at: int, to: int) -> list[str]:
        """The values of the placeholders of a window, in order."""
        chosen = [k for k in range(at, to) if not self.literal[k]]
        return [self.data[self.starts[k] : self.ends[k]].tobytes().decode("utf-8", "replace") for k in chosen]


_WINDOWS = pa.schema(
    [
        ("row", pa.int64()),
        ("form", pa.int32()),
        ("hash", pa.int64()),
        ("place", pa.int32()),
        ("width", pa.int32()),
        ("slots", pa.list_(pa.string())),
    ]
)


def _found(
    column: pa.Array, ids: pa.Array, passes: np.ndarray | None, widths: Mapping[int, Sequence[int]]
) -> Iterator[pa.RecordBatch]:
    """Windows of the rows, by form of shorter ``widths`` too; those that the bit table lets through, if there is one."""
    for a, b in slices(column):
        words = Words(column.slice(a, b - a))
        for form in FORMS:
            made = Templates(words, form)
            hashes, rows, at, width = made.windows(widths.get(form, ()))
            if passes is not None and len(hashes):
                chosen = passes[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
                hashes, rows, at, width = hashes[chosen], rows[chosen], at[chosen], width[chosen]
            if not len(hashes):
                continue
            counts = np.bincount(made.rows, minlength=made.n_rows)
            firsts = np.cumsum(counts) - counts
            columns = [
                ids.take(pa.array(a + rows)),
                pa.array(np.full(len(hashes), form, np.int32)),
                pa.array(hashes.view(np.int64)),
                pa.array((at - firsts[rows]).astype(np.int32)),
                pa.array(width.astype(np.int32)),
                pa.array([made.slots(k, e) for k, e in zip(at.tolist(), (at + width).tolist())], pa.list_(pa.string())),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([("row", ids.type), *list(_WINDOWS)[1:]]))


def benchmark_windows(items: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """(item_id, form, hash, place, width, slots, n): every window of the benchmark, and the item's number of windows."""

    @tidy
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _found(batch.column(1), batch.column(0), None, {})

    rows = items.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    found = rows.mapInArrow(made, "row long, form int, hash long, place int, width int, slots array<string>")
    found = found.withColumnRenamed("row", "item_id").distinct()
    sizes = found.groupBy(F.col("item_id").alias("i"), F.col("form").alias("f")).agg(F.countDistinct("place").alias("n"))
    same = F.col("item_id").eqNullSafe(F.col("i")) & (F.col("form") == F.col("f"))
    return found.join(sizes, same).drop("i", "f")


def _consistent(pairs: Column) -> Column:
    """Whether each item value stands for one document value only, in an array of distinct pairs."""
    return F.size(pairs) == F.size(F.array_distinct(F.transform(pairs, lambda p: p["item_value"])))


def _taken(parts: Column) -> Column:
    """Places and slot pairs of the alignments of a run that are consistent together, in the order given."""

    def take(held: Column, part: Column) -> Column:
        places = F.array_union(held["places"], part["places"]).alias("places")
        pairs = F.array_union(held["pairs"], part["pairs"])
        return F.when(_consistent(pairs), F.struct(places, pairs.alias("pairs"))).otherwise(held)

    none = F.struct(
        F.array().cast("array<int>").alias("places"),
        F.array().cast("array<struct<item_value:string,doc_value:string>>").alias("pairs"),
    )
    return F.aggregate(parts, none, take)


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    shortest: int = SHORTEST,
) -> DataFrame:
    """One row per document and leaked item: ``doc_id``, ``item_id``, ``share`` of its windows, ``changed`` slot values.

    ``text_hash`` tells rows of equal id apart.
    """
    spark = docs.sparkSession
    windows = cut(benchmark_windows(items, item_column, item_text_column), "benchmark")

    @tidy
    def slots_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.unique(batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - FILTER_BITS))
            yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32))], names=["slot"])

    bits = np.zeros(1 << FILTER_BITS, bool)
    found = windows.select("hash").mapInArrow(slots_of, "slot int").distinct().toArrow()
    bits[found.column(0).to_numpy()] = True
    shared = spark.sparkContext.broadcast(np.packbits(bits).tobytes())

    # At most the few widths below WIDTH in each form.
    short = windows.where(F.col("width").between(shortest, WIDTH - 1)).select("form", "width").distinct().collect()
    widths = {form: sorted(r.width for r in short if r.form == form) for form in FORMS}

    @tidy
    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        passes = np.unpackbits(np.frombuffer(shared.value, np.uint8)).view(bool)
        for batch in batches:
            yield from _found(batch.column(1), batch.column(0), passes, widths)

    text = F.col(text_column)
    key = F.struct(F.col(id_column).cast("long").alias("id"), F.xxhash64(text).alias("hash"))
    hits = docs.select(key.alias("key"), text.alias("text")).mapInArrow(
        searched, "row struct<id:long,hash:long>, form int, hash long, place int, width int, slots array<string>"
    )
    hits = hits.select(
        F.col("row.id").alias("doc_id"),
        F.col("row.hash").alias("text_hash"),
        F.col("form").alias("doc_form"),
        F.col("hash").alias("doc_hash"),
        F.col("place").alias("doc_place"),
        F.col("slots").alias("doc_slots"),
    )
    met = hits.join(windows, (F.col("doc_hash") == F.col("hash")) & (F.col("doc_form") == F.col("form")))
    pairs = F.arrays_zip(F.col("slots").alias("item_value"), F.col("doc_slots").alias("doc_value"))
    met = met.select(
        "doc_id",
        "text_hash",
        "item_id",
        "form",
        "n",
        "place",
        (F.col("doc_place") - F.col("place")).alias("alignment"),
        pairs.alias("pairs"),
    )
    aligned = met.groupBy("doc_id", "text_hash", "item_id", "form", "n", "alignment").agg(
        F.collect_set("place").alias("places"), F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs")
    )
    pair = ("doc_id", "text_hash", "item_id", "form", "n")
    along = Window.partitionBy(*pair).orderBy("alignment")
    apart = F.col("alignment") - F.lag("alignment").over(along) > F.col("n") + WIDTH
    # Alignments that contradict themselves are never taken.
    runs = aligned.where(_consistent(F.col("pairs"))).withColumn("apart", F.coalesce(apart, F.lit(False)))
    runs = runs.withColumn("run", F.sum(F.col("apart").cast("int")).over(along))
    part = F.struct((-F.size("places")).alias("order"), "alignment", "places", "pairs")
    runs = runs.groupBy(*pair, "run").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    held = F.size(F.array_distinct(F.flatten(F.transform("parts", lambda a: a["places"]))))
    runs = runs.where(held >= SHARE * F.col("n")).select(*pair, _taken(F.col("parts")).alias("taken"))
    changed = F.size(F.filter("taken.pairs", lambda p: ~p["item_value"].eqNullSafe(p["doc_value"])))
    judged = runs.select(*pair, F.size("taken.places").alias("covered"), changed.alias("changed"))
    judged = judged.where(F.col("covered") >= SHARE * F.col("n"))
    judged = judged.groupBy("doc_id", "text_hash", "item_id").agg(
        F.max(F.col("covered") / F.col("n")).alias("share"), F.min("changed").alias("changed")
    )
    return judged


def without_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    shortest: int = SHORTEST,
) -> DataFrame:
    """The rows of ``docs`` that no item leaks into, all columns as they were."""
    found = leaks(docs, items, id_column, text_column, item_column, item_text_column, shortest)
    found = cut(found.select("doc_id", "text_hash").distinct(), "leaks")
    found = found.select(F.col("doc_id").alias("leak_id"), F.col("text_hash").alias("leak_hash"))
    rows = docs.alias("d")
    same = F.col(f"d.`{id_column}`").cast("long").eqNullSafe(F.col("l.leak_id"))
    return rows.join(
        found.alias("l"), same & (F.xxhash64(F.col(f"d.`{text_column}`")) == F.col("l.leak_hash")), "left_anti"
    )
