"""Token counts: rank-synchronous merging of ragged arrays of byte symbols.

A text is cut into pre-tokens by the tokenizer's own splitting rule, as array operations over the
code points of many texts at once.  The distinct pre-tokens of a batch become one flat array of byte
symbols with the start of each sequence.  A round finds every sequence's lowest-rank pair and merges
all its occurrences, from the left, in all sequences at the same time; sequences without a mergeable
pair leave the array.  What is counted are the symbols that survive.  A sequence of more than
``LONG`` symbols is merged rank by rank over linked positions instead, so that its cost is not its
length times its rounds.

The vocabulary file is a byte-level BPE (its path is a parameter).  Which code points are letters,
numbers or white space is asked of the file's pre-tokenizer once for each code point met, as Unicode
versions differ.  Strings of added tokens are cut out of a text first and count one each.

Cases: null and empty texts have 0 bytes and 0 tokens; ids are carried along, whether null, repeated or
tied; repeated rows keep a row each; an empty table gives none; other columns are not read.  Long texts
are handled in pieces that end before white space; a longer run without white space is one piece.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from fieldmark.llm.common import SLICE_BYTES, slices, tidy, utf8, worker_state

#: Tokens above which a text is marked.
LIMIT = 512
#: Symbols above which a pre-token is merged over linked positions.
LONG = 2048

_NO_RANK = np.iinfo(np.int32).max
_LETTER, _NUMBER, _SPACE, _OTHER = 1, 2, 3, 4
# The endings that the splitting rule keeps together with the apostrophe before them.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


def _byte_letters() -> list[str]:
    """How a byte-level vocabulary spells each byte: printable ones as themselves, the others from U+0100 on."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    moved = iter(range(0x100, 0x200))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


@dataclass(frozen=True)
class Merges:
    """Pairs of symbol ids as sorted codes, with the rank of each and the symbol it makes."""

    size: int
    first: np.ndarray  # symbol of each byte
    codes: np.ndarray
    ranks: np.ndarray
    made: np.ndarray  # by rank
    bytes_ranks: np.ndarray  # ranks of pairs of bytes, 256 x 256

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.codes, wanted), len(self.codes) - 1)
        return np.where(self.codes[at] == wanted, self.ranks[at], _NO_RANK).astype(np.int32)

    @staticmethod
    def of(vocabulary: dict[str, int], pairs: list[tuple[str, str]]) -> "Merges":
        size = max(vocabulary.values()) + 1
        first = np.array([vocabulary[c] for c in _byte_letters()], np.int32)
        left = np.array([vocabulary[a] for a, _ in pairs], np.int64)
        right = np.array([vocabulary[b] for _, b in pairs], np.int64)
        made = np.array([vocabulary[a + b] for a, b in pairs], np.int32)
        rank_of = np.full(size, -1, np.int64)
        rank_of[made[::-1]] = np.arange(len(pairs))[::-1]
        ranks = np.arange(len(pairs), dtype=np.int64)
        if (np.maximum(rank_of[left], rank_of[right]) >= ranks).any():
            raise ValueError("a merge has to come after those that make its parts")
        codes = left * size + right
        order = np.argsort(codes, kind="stable")
        table = Merges(size, first, codes[order], ranks[order].astype(np.int32), made, np.zeros(0, np.int32))
        pairs_of_bytes = table.ranks_of(np.repeat(first, 256), np.tile(first, 256))
        return Merges(size, first, table.codes, table.ranks, made, pairs_of_bytes)


def _from_left(hits: np.ndarray, following: np.ndarray) -> np.ndarray:
    """Of hits in a row (each the next one's neighbour) every second one, from the first on."""
    if len(hits) < 2:
        return hits
    begins = np.flatnonzero(np.append(True, following[:-1] != hits[1:]))
    lengths = np.diff(np.append(begins, len(hits)))
    return hits[(np.arange(len(hits)) - np.repeat(begins, lengths)) % 2 == 0]


def survivors(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, merges: Merges) -> np.ndarray:
    """Symbols left of each sequence (``sizes`` bytes of ``data`` from ``starts``, at least one) after all merges."""
    counts = np.ones(len(sizes), np.int64)
    for k in np.flatnonzero(sizes > LONG).tolist():
        counts[k] = _survivors_of_long(data[starts[k] : starts[k] + sizes[k]], merges)
    live = np.flatnonzero((sizes > 1) & (sizes <= LONG))
    if not len(live):
        return counts
    held = sizes[live]
    ends = np.cumsum(held)
    begins = ends - held
    raw = data[np.repeat(starts[live] - begins, held) + np.arange(ends[-1])]
    symbols = merges.first[raw]
    ranks = np.full(len(symbols), _NO_RANK, np.int32)
    ranks[:-1] = merges.bytes_ranks[raw[:-1].astype(np.int32) * 256 + raw[1:]]
    ranks[ends - 1] = _NO_RANK
    while len(live):
        lowest = np.minimum.reduceat(ranks, begins)
        done = lowest == _NO_RANK
        if done.any():
            counts[live[done]] = held[done]
            keep = np.repeat(~done, held)
            symbols, ranks = symbols[keep], ranks[keep]
            live, held, lowest = live[~done], held[~done], lowest[~done]
            if not len(live):
                break
            begins = np.cumsum(held) - held
        hits = np.flatnonzero(ranks == np.repeat(lowest, held))
        hits = _from_left(hits, hits + 1)
        symbols[hits] = merges.made[ranks[hits]]
        kept = np.ones(len(symbols), bool)
        kept[hits + 1] = False
        gone = np.bincount(np.searchsorted(begins, hits, "right") - 1, minlength=len(live))
        place = np.cumsum(kept) - 1
        symbols, ranks, hits = symbols[kept], ranks[kept], place[hits]
        held = held - gone
        begins = np.cumsum(held) - held
        last = np.zeros(len(symbols) + 1, bool)
        last[begins + held - 1] = True
        first = np.zeros(len(symbols), bool)
        first[begins] = True
        changed = np.concatenate([hits, hits[~first[hits]] - 1])
        ranks[changed] = _NO_RANK
        changed = changed[~last[changed]]
        ranks[changed] = merges.ranks_of(symbols[changed], symbols[changed + 1])
    return counts


def _survivors_of_long(raw: np.ndarray, merges: Merges) -> int:
    """The same for one long sequence: ranks ascend, each is applied to all its places at once."""
    n = len(raw)
    symbols = np.append(merges.first[raw], 0)
    following, before = np.arange(1, n + 2), np.arange(-1, n)
    ranks = np.full(n + 1, _NO_RANK, np.int32)
    ranks[: n - 1] = merges.bytes_ranks[raw[:-1].astype(np.int32) * 256 + raw[1:]]
    places: dict[int, list[np.ndarray]] = {}
    waiting: list[int] = []
    left = n

    def wait(at: np.ndarray) -> None:
        at = at[ranks[at] != _NO_RANK]
        at = at[np.argsort(ranks[at], kind="stable")]
        found, first = np.unique(ranks[at], return_index=True)
        for rank, part in zip(found.tolist(), np.split(at, first[1:])):
            if rank not in places:
                places[rank] = []
                heapq.heappush(waiting, rank)
            places[rank].append(part)

    wait(np.arange(n - 1))
    while waiting:
        rank = heapq.heappop(waiting)
        at = np.unique(np.concatenate(places.pop(rank)))
        at = at[ranks[at] == rank]
        at = _from_left(at, following[at])
        taken = following[at]
        symbols[at] = merges.made[rank]
        ranks[taken] = _NO_RANK
        following[at] = following[taken]
        before[following[at]] = at
        left -= len(at)
        changed = np.unique(np.concatenate([at, before[at][before[at] >= 0]]))
        ranks[changed] = _NO_RANK
        inside = changed[following[changed] < n]
        ranks[inside] = merges.ranks_of(symbols[inside], symbols[following[inside]])
        wait(inside)
    return left


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each character of UTF-8 bytes begins, and its code point."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    lead = data[at].astype(np.int32)
    points = lead.copy()
    padded = np.append(data, np.zeros(3, np.uint8)).astype(np.int32)
    for size, low, mask in ((2, 0xC0, 0x1F), (3, 0xE0, 0x0F), (4, 0xF0, 0x07)):
        here = np.flatnonzero((lead >= low) & ((lead < low + (0x40 >> (size - 1))) if size < 4 else (lead >= low)))
        value = lead[here] & mask
        for k in range(1, size):
            value = value << 6 | padded[at[here] + k] & 0x3F
        points[here] = value
    return at, points


class Counter:
    """Counts tokens of texts as the tokenizer in ``path`` makes them, special tokens not added."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.merges = Merges.of(model["vocab"], pairs)
        self.splitter = tokenizer.pre_tokenizer
        added = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        #: Class of each code point, 0 where it has not been asked for.
        self.classes = np.zeros(0x110000, np.uint8)

    def _class(self, char: str) -> int:
        for kind, fellow in ((_LETTER, "a"), (_NUMBER, "1"), (_OTHER, "!")):
            if len(self.splitter.pre_tokenize_str(fellow + char)) == 1:
                return kind
        return _SPACE

    def classes_of(self, points: np.ndarray) -> np.ndarray:
        found = self.classes[points]
        if not found.all():
            for point in np.unique(points[found == 0]).tolist():
                self.classes[point] = self._class(chr(point))
            found = self.classes[points]
        return found

    def pre_tokens(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """First bytes of the pre-tokens of the texts between ``bounds``."""
        at, points = code_points(data)
        kinds = self.classes_of(points)
        n = len(points)
        opens = np.zeros(n + 1, bool)
        opens[np.searchsorted(at, bounds)] = True
        opens[n] = True
        closes, opens = opens[1:], opens[:-1]
        space, blank = kinds == _SPACE, points == 0x20
        same = np.zeros(n, bool)
        same[1:] = kinds[1:] == kinds[:-1]
        after_blank = np.zeros(n, bool)
        after_blank[1:] = blank[:-1]
        begins = opens | ~same
        # A blank goes with what follows it; other white space does not.
        begins &= opens | space | ~after_blank
        # The last of several white spaces stands apart unless the text ends with it.
        followed = np.zeros(n, bool)
        followed[:-1] = ~space[1:]
        begins |= space & followed & ~closes
        self._endings(points, kinds, begins, opens, after_blank)
        return at[begins]

    def _endings(self, points, kinds, begins, opens, after_blank) -> None:
        marks = np.flatnonzero((points == 0x27) & begins & (opens | ~after_blank))
        if not len(marks):
            return
        n = len(points)
        padded = np.append(points, [0, 0])
        # A text's end also ends an ending.
        stops = np.append(opens, [True, True])
        for ending in _ENDINGS:
            found = marks[marks + len(ending) < n]
            for k, char in enumerate(ending, 1):
                found = found[(padded[found + k] == ord(char)) & ~stops[found + k]]
            begins[found + 1] = False
            next_at = found + len(ending) + 1
            next_at = next_at[next_at < n]
            begins[next_at[kinds[next_at] == _LETTER]] = True

    def __call__(self, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Tokens of each text; text k is the bytes from ``bounds[k]`` to ``bounds[k + 1]``."""
        if not len(data):
            return np.zeros(len(bounds) - 1, np.int64)
        starts = self.pre_tokens(data, bounds[:-1][bounds[:-1] < len(data)])
        sizes = np.diff(np.append(starts, len(data)))
        counts = np.ones(len(starts), np.int64)
        for chosen in _by_width(sizes):
            firsts, again = _distinct(data, starts[chosen], sizes[chosen])
            own = chosen[firsts]
            counts[chosen] = survivors(data, starts[own], sizes[own], self.merges)[again]
        sums = np.append(0, np.cumsum(counts))
        where = np.searchsorted(starts, bounds)
        return sums[where[1:]] - sums[where[:-1]]


def _by_width(sizes: np.ndarray) -> Iterator[np.ndarray]:
    """Sequences by the number of 8-byte words they take; the longest ones are not told apart."""
    width = np.minimum((sizes + 7) // 8, 9)
    for k in range(1, 10):
        chosen = np.flatnonzero((width == k) & (sizes > 1))
        if len(chosen):
            yield chosen


def _distinct(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of each of the byte sequences of one width, and which of these each sequence is."""
    width = -(-int(sizes.max()) // 8) * 8
    if width > 64:
        return np.arange(len(starts)), np.arange(len(starts))
    padded = np.append(data, np.zeros(width, np.uint8))
    rows = np.lib.stride_tricks.sliding_window_view(padded, width)[starts]
    rows = np.where(np.arange(width) < sizes[:, None], rows, np.uint8(0))
    words = np.ascontiguousarray(rows).view(np.uint64)
    # Sizes tell a sequence that ends in zero bytes from a shorter one.
    order = np.lexsort((sizes, *words.T)) if width > 8 else np.lexsort((sizes, words[:, 0]))
    unlike = np.ones(len(order), bool)
    unlike[1:] = (words[order[1:]] != words[order[:-1]]).any(axis=1) | (sizes[order[1:]] != sizes[order[:-1]])
    again = np.empty(len(order), np.int64)
    again[order] = np.cumsum(unlike) - 1
    return order[unlike], again


def _counter(path: str) -> Counter:
    if ("token-counter", path) not in worker_state:
        worker_state["token-counter", path] = Counter(path)
    return worker_state["token-counter", path]


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of one slice of texts: all of it, or pieces of a long text that end before a blank."""
    begin, end = int(offsets[0]), int(offsets[-1])
    while len(offsets) == 2 and end - begin > 2 * SLICE_BYTES:
        # White space after anything else begins a pre-token wherever it stands.
        part = data[begin + SLICE_BYTES - 1 : min(end, begin + 2 * SLICE_BYTES)]
        spots = np.flatnonzero((part[1:] == 0x20) & (part[:-1] > 0x20) & (part[:-1] < 0x7F))
        if not len(spots):
            break
        to = begin + SLICE_BYTES + int(spots[0])
        yield begin, to
        begin = to
    yield begin, end


def count_tokens(column: pa.Array, path: str) -> np.ndarray:
    """Tokens of each text of a string column."""
    counter = _counter(path)
    extra = np.zeros(len(column), np.int64)
    owners = None
    if counter.added is not None and len(column):
        held = pc.match_substring_regex(column.fill_null(""), counter.added.pattern).to_numpy(zero_copy_only=False)
        if held.any():
            # Texts with added tokens fall into the parts between them.
            texts, rows = [], []
            for row, (text, cut_up) in enumerate(zip(column.fill_null("").to_pylist(), held.tolist())):
                parts = counter.added.split(text) if cut_up else [text]
                extra[row] = len(parts) - 1
                texts += parts
                rows += [row] * len(parts)
            column, owners = pa.array(texts, pa.large_string()), np.array(rows)
    counts = np.zeros(len(column), np.int64)
    for a, b in slices(column):
        data, offsets = utf8(column.slice(a, b - a))
        if b - a == 1:
            counts[a] = sum(int(counter(data[p:q], np.array([0, q - p]))[0]) for p, q in _pieces(data, offsets) if q > p)
        else:
            counts[a:b] = counter(data, offsets)
    if owners is not None:
        counts = np.bincount(owners, counts, minlength=len(extra)).astype(np.int64)
    return counts + extra


_ARROW = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def _counted(path: str, limit: int):
    @tidy
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            n_bytes = pc.binary_length(texts).fill_null(0).cast(pa.int64())
            tokens = count_tokens(texts, path)
            yield pa.RecordBatch.from_arrays([ids, n_bytes, pa.array(tokens), pa.array(tokens > limit)], schema=_ARROW)

    return counted


def token_counts(
    docs: DataFrame, tokenizer: str, limit: int = LIMIT, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Bytes and tokens of every text; ``over_limit`` marks those of more than ``limit`` tokens."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(_counted(tokenizer, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
