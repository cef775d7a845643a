"""Language identification: interpolated Kneser-Ney character models in sorted arrays of exact n-gram codes.

A text is folded to lower-case letters, every run of other characters becoming one space.  For each
language the 4-grams of all its training texts are counted; lower orders use continuation counts
(the number of different characters seen before), and every order is interpolated with the one
below it by absolute discounting, down to the uniform distribution over the characters seen.

An n-gram's code holds its characters whole, 16 bits each, so no two n-grams share a count; a letter
beyond 16 bits is two characters here, its UTF-16 surrogates.  An
order's n-grams are held as one sorted array of codes (mixed by a bijection) with a row of
log-probabilities, one per language, and a second array of contexts with a row of back-off weights.
The arrays grow with the corpus: what the driver gets and broadcasts is a row for every distinct
4-gram of a language and below.  Nothing is left out to bound that; it has to fit in memory.

A text gets the language of the lowest cross-entropy per character.  It is rejected if that
cross-entropy is above the language's limit: the mean over the training texts plus ``TOLERANCE``
standard deviations, both for texts of like length.  ``score`` is the softmax of the negative
cross-entropies over the languages, sharpened by ``SHARPNESS`` characters.

Cases: a text that is null or has no letter is ``und`` with score 0 and rejected; so is every text
if there are no training texts.  Null languages are not learnt from.  Repeated rows get a row each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fieldmark.llm.common import SLICE_BYTES, held_back, mix, release, slices, tidy

ORDER = 4
#: Distinct 4-grams of slices that a task holds before it sums them, and rows made at once on the driver.
HELD_GRAMS = 1 << 22
ROWS_AT_ONCE = 1 << 16
TOLERANCE = 8.0
SHARPNESS = 20.0
UNKNOWN = "und"
#: Lengths, as powers of four, for which the limits are learnt.
LENGTH_CLASSES = 9

_SPACE = 0x20


def _letter_table() -> np.ndarray:
    """For each 16-bit code its folded letter, or the space."""
    table = np.full(1 << 16, _SPACE, np.uint16)
    for code in range(1 << 16):
        character = chr(code)
        if character.isalpha():
            lower = character.lower()
            table[code] = ord(lower) if len(lower) == 1 and ord(lower) < 1 << 16 else code
    return table


_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    if "letters" not in _tables:
        _tables["letters"] = _letter_table()
    return _tables["letters"]


def folded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The folded characters of all texts, and the row of each; every text begins with one space."""
    texts = column.to_pylist()
    codes = np.frombuffer("".join("\0" + (t or "") for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    borders = codes == 0
    if int(borders.sum()) != len(texts):  # a text holds the border character itself
        sizes = np.array([len(t or "") + 1 for t in texts])
        borders = np.zeros(len(codes), bool)
        borders[np.cumsum(sizes) - sizes] = True
    rows = np.cumsum(borders) - 1
    letters = _letters()[(codes & 0xFFFF).astype(np.uint16)]
    beyond = np.flatnonzero(codes >= 1 << 16)
    if len(beyond):
        lower = [chr(int(c)).lower() for c in codes[beyond]]
        real = np.array([len(c) == 1 and ord(c) >= 1 << 16 and c.isalpha() for c in lower])
        letters[beyond[~real]] = _SPACE
        # Both halves of a surrogate pair take a place of their own; no letter has their codes.
        wide, places = beyond[real], np.ones(len(codes), np.int64)
        places[wide] = 2
        at = (np.cumsum(places) - places)[wide]
        letters, rows, borders = (np.repeat(x, places) for x in (letters, rows, borders))
        points = np.array([ord(c) for c, is_real in zip(lower, real) if is_real], np.int64) - (1 << 16)
        letters[at], letters[at + 1] = 0xD800 + (points >> 10), 0xDC00 + (points & 0x3FF)
    space = letters == _SPACE
    keep = np.ones(len(letters), bool)
    keep[1:] = ~(space[1:] & space[:-1]) | borders[1:]
    return letters[keep], rows[keep]


def grams(letters: np.ndarray, rows: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the n-grams that end at each character but a text's first ones, 16 bits a character, and their rows.

    A text is read as if ``order - 1`` spaces stood before it.
    """
    n = len(letters)
    first = np.ones(n, bool)
    first[1:] = rows[1:] != rows[:-1]
    place = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    code = letters.astype(np.uint64)
    wide = letters.astype(np.uint64)
    for back in range(1, order):
        previous = np.full(n, _SPACE, np.uint64)
        previous[back:] = np.where(place[back:] >= back, wide[: n - back], np.uint64(_SPACE))
        code |= previous << np.uint64(16 * back)
    return code, rows


class Keys:
    """Distinct codes, sorted by their mixed words, and where each stands."""

    def __init__(self, codes: np.ndarray):
        self.mixed = np.sort(mix(codes.astype(np.uint64)))

    def _prepare(self) -> None:
        """A table from leading bits to the first row that has them; made once per worker."""
        n = len(self.mixed)
        bits = max(1, n.bit_length())
        self.shift = np.uint64(64 - bits)
        tops = np.arange(1 << bits, dtype=np.uint64) << self.shift
        self.first = np.searchsorted(self.mixed, tops).astype(np.int32 if n < 1 << 31 else np.int64)
        self.padded = np.append(self.mixed, np.uint64((1 << 64) - 1))

    def __getstate__(self) -> dict:
        return {"mixed": self.mixed}

    def __len__(self) -> int:
        return len(self.mixed)

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """The row of each code, -1 for none."""
        if "first" not in self.__dict__:
            self._prepare()
        wanted = mix(codes)
        at = self.first[(wanted >> self.shift).astype(np.int64)]
        before = np.flatnonzero(self.padded[at] < wanted)
        while len(before):
            at[before] += 1
            before = before[self.padded[at[before]] < wanted[before]]
        return np.where((self.padded[at] == wanted) & (at < len(self.mixed)), at, -1)


def _suffix(codes: np.ndarray, order: int) -> np.ndarray:
    return codes & np.uint64((1 << 16 * order) - 1)


_COUNT_ARROW = pa.schema([("lang", pa.string()), ("code", pa.int64()), ("n", pa.int64())])


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in ascending order and the sums of their counts."""
    if len(parts) == 1:
        return parts[0]
    codes, counts = (np.concatenate(arrays) for arrays in zip(*parts))
    order = np.argsort(codes, kind="stable")
    codes, counts = codes[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[starts], np.add.reduceat(counts, starts)


@tidy
def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        langs, texts = batch.column(0).dictionary_encode(), batch.column(1)
        for number, lang in enumerate(langs.dictionary.to_pylist()):
            chosen = texts.filter(pc.equal(langs.indices, number))
            parts, held = [], 0
            for a, b in slices(chosen):
                found, _ = grams(*_lettered(chosen.slice(a, b - a)), ORDER)
                if not len(found):
                    continue
                parts.append(np.unique(found, return_counts=True))
                held += len(parts[-1][0])
                if held > HELD_GRAMS:
                    parts = [_summed(parts)]
                    held = 0
            if not parts:
                continue
            codes, counts = _summed(parts)
            columns = [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(codes), np.int32)))]
            columns += [pa.array(codes.view(np.int64)), pa.array(counts.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, schema=_COUNT_ARROW)


def _lettered(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``folded`` without the rows that have no letter."""
    letters, rows = folded(column)
    if not len(rows):
        return letters, rows
    some = np.bincount(rows, weights=letters != _SPACE, minlength=len(column)) > 0
    kept = some[rows]
    return letters[kept], rows[kept]


@dataclass
class Model:
    """``tables[k]`` are (keys, log-probabilities) of the n-grams, ``contexts[k]`` (keys, back-off logs)."""

    languages: list[str]
    tables: list[tuple[Keys, np.ndarray]]
    contexts: list[tuple[Keys, np.ndarray]]
    floor: np.ndarray
    means: np.ndarray | None = None
    spreads: np.ndarray | None = None

    def logs(self, codes: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log-probabilities of the last characters of n-grams given the others, a column per language."""
        if order == 0:
            return np.broadcast_to(self.floor, (len(codes), len(self.languages)))
        keys, values = self.tables[order - 1]
        rows = keys.rows(codes)
        if not len(values):
            return self.logs(_suffix(codes, order - 1), order - 1)
        out = values[rows]
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            lower = self.logs(_suffix(codes[missing], order - 1), order - 1)
            above, weights = self.contexts[order - 1]
            backs = above.rows(codes[missing] >> np.uint64(16))
            out[missing] = lower + np.where(backs[:, None] >= 0, weights[backs], np.float32(0))
        return out

    def entropies(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character of each text under each language, and the number of letters and spaces."""
        total = np.zeros((len(column), len(self.languages)))
        counts = np.zeros(len(column), np.int64)
        for a, b in slices(column, 4 * SLICE_BYTES // max(4, len(self.languages))):
            letters, rows = _lettered(column.slice(a, b - a))
            if not len(rows):
                continue
            logs = self.logs(grams(letters, rows, ORDER)[0])
            starts = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
            total[a + rows[starts]] = np.add.reduceat(logs, starts, axis=0, dtype=np.float64)
            counts[a + rows[starts]] = np.diff(np.concatenate([starts, [len(rows)]]))
        return -total / np.maximum(counts, 1)[:, None], counts

    def judged(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Number of the language (-1: none), score, lowest cross-entropy, whether it is rejected."""
        if not self.languages:
            none = np.zeros(len(column))
            return none.astype(np.int64) - 1, none, none, none == 0
        entropies, counts = self.entropies(column)
        best = entropies.argmin(axis=1)
        lowest = entropies[np.arange(len(best)), best]
        closeness = np.exp(-SHARPNESS * (entropies - lowest[:, None]))
        score = 1 / closeness.sum(axis=1)
        rejected = counts == 0
        if self.means is not None:
            sizes = length_class(counts)
            rejected |= lowest > self.means[best, sizes] + TOLERANCE * self.spreads[best, sizes]
        best = np.where(counts == 0, -1, best)
        return best, np.where(counts == 0, 0.0, score), lowest, rejected


def length_class(counts: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(counts, 1)) / 2, LENGTH_CLASSES - 1).astype(np.int64)


def _order_tables(codes, counts, lang, lower, order, n_langs):
    """One order's log-probabilities and back-off weights from (code, language, count) and the order below.

    ``lower`` gives the probabilities of the order below for codes of that order.
    """
    distinct = np.unique(codes)
    distinct = distinct[np.argsort(mix(distinct))]
    keys, above = Keys(distinct), Keys(np.unique(codes >> np.uint64(16)))
    rows, of = keys.rows(codes), above.rows(codes >> np.uint64(16))
    once, twice = (np.bincount(lang[counts == k], minlength=n_langs) for k in (1, 2))
    discount = np.clip(once / np.maximum(once + 2 * twice, 1), 0.1, 0.9)
    cell = of.astype(np.int64) * n_langs + lang
    sums = np.bincount(cell, weights=counts, minlength=len(above) * n_langs).reshape(len(above), n_langs)
    kinds = np.bincount(cell, minlength=len(above) * n_langs).reshape(len(above), n_langs)
    # A context that a language has not seen leaves all to the order below.
    weights = np.where(sums > 0, discount * kinds / np.maximum(sums, 1), 1.0)
    seen = np.maximum(counts - discount[lang], 0) / np.maximum(sums[of, lang], 1)
    logs = np.empty((len(distinct), n_langs), np.float32)
    by_row = np.argsort(rows, kind="stable")
    rows, lang, seen = rows[by_row], lang[by_row], seen[by_row]
    for a in range(0, len(distinct), ROWS_AT_ONCE):
        part = distinct[a : a + ROWS_AT_ONCE]
        probabilities = weights[above.rows(part >> np.uint64(16))] * lower(_suffix(part, order - 1))
        own = slice(*np.searchsorted(rows, [a, a + len(part)]))
        probabilities[rows[own] - a, lang[own]] += seen[own]
        logs[a : a + len(part)] = np.log(probabilities)
    return (keys, logs), (above, np.log(weights).astype(np.float32))


def build(languages: list[str], lang: np.ndarray, codes: np.ndarray, counts: np.ndarray) -> Model:
    """The model of the counted 4-grams: ``lang`` numbers, ``codes`` and ``counts`` are parallel."""
    n_langs = len(languages)
    levels = [(codes, counts, lang)]
    for order in range(ORDER - 1, 0, -1):
        above, _, of = levels[-1]
        # Continuation counts: how many different characters stand before an n-gram.
        below = _suffix(above, order)
        by_code = np.lexsort((of, below))
        below, of = below[by_code], of[by_code]
        new = np.ones(len(below), bool)
        new[1:] = (below[1:] != below[:-1]) | (of[1:] != of[:-1])
        starts = np.flatnonzero(new)
        kinds = np.diff(np.append(starts, len(below)))
        levels.append((below[starts], kinds.astype(np.float64), of[starts]))
    letters, _, of = levels[-1]
    alphabet = max(1, len(np.unique(letters)))
    floor = np.full(n_langs, -np.log(alphabet + 1.0), np.float32)
    model = Model(languages, [], [], floor)
    for order in range(1, ORDER + 1):
        codes_, counts_, lang_ = levels[ORDER - order]
        table, context = _order_tables(
            codes_,
            counts_,
            lang_,
            lambda below, k=order - 1: np.exp(model.logs(below, k).astype(np.float64)),
            order,
            n_langs,
        )
        model.tables.append(table)
        model.contexts.append(context)
    return model


def train(docs: DataFrame, lang_column: str = "lang", text_column: str = "text") -> Model:
    """The model of all rows that have a language and a text.

    Counts are summed per language and 4-gram before anything leaves the executors; the driver gets
    a row for each.  The limits of rejection come from a second pass.
    """
    rows = docs.where(F.col(lang_column).isNotNull() & F.col(text_column).isNotNull())
    rows = rows.select(F.col(lang_column).cast("string").alias("lang"), F.col(text_column).alias("text"))
    counted = rows.mapInArrow(_counted, "lang string, code long, n long")
    found = counted.groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(pc.unique(found.column("lang")).to_pylist())
    numbers = pc.index_in(found.column("lang"), pa.array(languages, pa.string())).to_numpy()
    codes = found.column("code").to_numpy().view(np.uint64)
    model = build(languages, numbers.astype(np.int64), codes, found.column("n").to_numpy().astype(np.float64))
    if languages:
        _calibrate(rows, model)
    return model


def _calibrate(rows: DataFrame, model: Model) -> None:
    """Mean and spread of the lowest cross-entropy by language and length, from all training texts."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @tidy
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            entropies, counts = shared.value.entropies(batch.column(0))
            best = entropies.argmin(axis=1)
            lowest = entropies.min(axis=1)
            sizes = length_class(counts)
            some = counts > 0
            cell = best * LENGTH_CLASSES + sizes
            n = len(shared.value.languages) * LENGTH_CLASSES
            parts = [np.bincount(cell[some], weights=lowest[some] ** k, minlength=n) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(n, dtype=np.int32)), *(pa.array(p) for p in parts)],
                names=["cell", "n", "total", "squares"],
            )

    sums = rows.select("text").mapInArrow(measured, "cell int, n double, total double, squares double")
    sums = sums.groupBy("cell").agg(F.sum("n").alias("n"), F.sum("total").alias("t"), F.sum("squares").alias("s"))
    shape = (len(model.languages), LENGTH_CLASSES)
    n, total, squares = (np.zeros(shape) for _ in range(3))
    for row in sums.collect():
        at = divmod(row.cell, LENGTH_CLASSES)
        n[at], total[at], squares[at] = row.n, row.t, row.s
    whole = n.sum(axis=1, keepdims=True)
    mean_all = total.sum(axis=1, keepdims=True) / np.maximum(whole, 1)
    spread_all = np.sqrt(np.maximum(squares.sum(axis=1, keepdims=True) / np.maximum(whole, 1) - mean_all**2, 0))
    mean = np.where(n >= 30, total / np.maximum(n, 1), mean_all)
    spread = np.sqrt(np.maximum(squares / np.maximum(n, 1) - mean**2, 0))
    model.means = mean
    # A class that has few texts takes its language's spread, and short texts vary more in any case.
    shortness = 2.0 ** (3 - np.arange(LENGTH_CLASSES)) / 8
    model.spreads = np.maximum(np.where(n >= 30, spread, spread_all), 0.05) + shortness
    model.means[whole[:, 0] == 0] = np.inf


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: language, score, cross-entropy and whether it is rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            best, score, lowest, rejected = shared.value.judged(batch.column(1))
            names = np.array([*shared.value.languages, UNKNOWN], object)
            columns = [batch.column(0), pa.array(names[best], pa.string()), pa.array(score), pa.array(lowest)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(rejected)], names=["doc_id", "lang_pred", "score", "cross_entropy", "rejected"]
            )

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(judged, "doc_id long, lang_pred string, score double, cross_entropy double, rejected boolean")


def accepted(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not rejected, all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            rejected = shared.value.judged(batch.column(batch.schema.get_field_index(text_column)))[3]
            yield batch.filter(pa.array(~rejected))

    return docs.mapInArrow(kept, docs.schema)


def language_predictions(docs: DataFrame) -> DataFrame:
    """The registered query: learn from three quarters of the rows, judge all."""
    held_out = held_back("doc_id", 4, 2)
    judged = predict(docs, train(docs.where(~held_out)))
    return judged.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected")
