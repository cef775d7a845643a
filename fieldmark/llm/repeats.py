"""Repeated passages: maximal repeats of an enhanced suffix array, cut out of all documents but the first.

Every byte that is covered by a string of ``LEAST`` bytes which also starts in a document of a smaller
id is removed.  Documents are bytes; matches never cross documents; all is judged on the input.

Sorting every suffix of a corpus would move each byte dozens of times.  Instead:

1. *Runs.*  The least hash of the 16-byte strings inside a window is its anchor; neighbouring windows
   with the same anchor form a run (about 18 windows, so about 68 bytes).  Equal windows have equal
   anchors wherever they stand, so runs of equal anchors are the only places where a match can be.
2. *Shared runs.*  Each part of the corpus sends every distinct (anchor, run) once, with its least
   document, as packed arrays to a bucket chosen by the anchor.  A run that a smaller document also
   has is covered as a whole; so copies collapse before anything is sorted.  A run whose anchor stands
   nowhere else is done too.  What is left are first occurrences whose anchor meets other runs.
3. *Suffix array.*  The strings of those runs go to the anchors' buckets, where their suffixes are
   sorted, neighbours' common prefixes taken and the interval tree is scanned with a stack.  An interval
   of at least ``LEAST`` common bytes whose occurrences differ in the byte before them is a maximal
   repeat; all its occurrences (not just neighbours) but those of its least document are covered.

An anchor that meets more than ``CROWD`` different runs (a passage set into very many documents) does
not go to one bucket: its windows, distinct ones once per part, are dealt by their own hash.  Equal
windows still meet, so nothing is lost.

Cases: a null or empty text has no bytes; texts shorter than ``LEAST`` bytes keep all; rows of equal
id do not remove from each other; a null id ranks after all ids.  Repeated rows get a row each.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldmark.llm.common import Spans, mix, partitions, slices, utf8

LEAST = 50
GRAM = 16
#: Common prefixes are followed this far: the longest string of a run with one place of its anchor.
DEEPEST = 2 * LEAST - GRAM
#: Windows of a run at most.
LONGEST_RUN = 64
CROWD = 4096
#: Text of a part, about, and how much text's runs meet in a bucket.  Every part may send a blob to every
#: bucket, so both numbers follow the text's size and not the number of tasks.
PART_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
LEAST_BUCKETS = 64
PARTS_PER_TASK = 4
#: Strings whose suffixes are sorted at once, in bytes; strings of one anchor stay together.
SORT_BYTES = 1 << 18
#: Text whose runs are found at once.
SLICE_BYTES = 1 << 18

_NO_ID = np.iinfo(np.int64).max


# ---- the enhanced suffix array -------------------------------------------------------------------


def lcp_intervals(lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of the intervals of the common-prefix tree, by a scan with a stack.

    ``lcp[k]`` is the common prefix of sorted suffixes k - 1 and k; intervals come innermost first,
    those of depth 0 are left out.
    """
    stack = [(0, 0)]
    for k, depth in enumerate(lcp.tolist()):
        first = k - 1
        while stack[-1][0] > depth:
            top, first = stack.pop()
            yield top, first, k - 1
        if stack[-1][0] < depth:
            stack.append((depth, first))
    while len(stack) > 1:
        top, first = stack.pop()
        yield top, first, len(lcp) - 1


class SuffixArray:
    """The suffixes of some strings that have at least ``least`` bytes and whose first ones occur twice.

    ``starts`` are their places in sorted order, ``string`` the string of each, ``lcp`` the common
    prefix with the one before, up to ``DEEPEST``.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, least: int = LEAST):
        sizes = np.diff(bounds)
        counts = np.maximum(sizes - least + 1, 0)
        string = np.repeat(np.arange(len(sizes)), counts)
        starts = np.arange(len(string)) - np.repeat(np.cumsum(counts) - counts, counts) + bounds[:-1][string]
        hashes = Spans(data).windows(least)[starts]
        _, number, count = np.unique(hashes, return_inverse=True, return_counts=True)
        twice = count[number] > 1
        starts, string = starts[twice], string[twice]
        self.data, self.bounds = data, bounds
        deepest = max(DEEPEST, least)
        padded = np.concatenate([data, np.zeros(deepest + 8, np.uint8)]).astype(np.uint64)
        words = np.zeros(len(data) + deepest, np.uint64)
        for k in range(8):
            words |= padded[k : k + len(words)] << np.uint64(56 - 8 * k)
        room = np.minimum(bounds[string + 1] - starts, deepest)
        keys = []
        for k in range(0, deepest, 8):
            # Bytes beyond the string's end, or beyond the greatest depth, count as zero.
            left = np.clip(room - k, 0, 8).astype(np.uint64)
            key = words[starts + k]
            beyond = np.uint64(0xFFFFFFFFFFFFFFFF) >> np.minimum(left * np.uint64(8), np.uint64(63))
            keys.append(np.where(left == 8, key, np.where(left == 0, np.uint64(0), key & ~beyond)))
        order = np.lexsort([room, *reversed(keys)])
        self.starts, self.string, room = starts[order], string[order], room[order]
        lcp = np.zeros(len(order), np.int64)
        if len(order) > 1:
            same = np.ones(len(order) - 1, bool)
            for key in keys:
                key = key[order]
                apart = key[1:] ^ key[:-1]
                # Leading zero bytes of what differs.
                equal = np.full(len(apart), 8)
                for k in range(7, -1, -1):
                    equal[(apart >> np.uint64(56 - 8 * k)) & np.uint64(255) != 0] = k
                lcp[1:] += np.where(same, equal, 0)
                same &= equal == 8
            lcp[1:] = np.minimum(lcp[1:], np.minimum(room[1:], room[:-1]))
        self.lcp = np.where(lcp >= least, lcp, 0)

    def maximal_repeats(self) -> Iterator[tuple[int, int, int]]:
        """(length, first, last) of the repeats whose occurrences differ in the byte before them.

        A repeat at the greatest depth may be longer, and counts as maximal whatever stands before.
        """
        at_start = self.starts == self.bounds[self.string]
        before = np.where(at_start, -1 - np.arange(len(self.starts)), self.data[self.starts - 1].astype(np.int64))
        changes = np.concatenate([[0], np.cumsum(before[1:] != before[:-1])])
        for depth, first, last in lcp_intervals(self.lcp):
            if depth >= DEEPEST or changes[last] > changes[first]:
                yield depth, first, last


def covered(data: np.ndarray, bounds: np.ndarray, owners: np.ndarray, least: int = LEAST) -> np.ndarray:
    """For each byte of the strings, how many bytes from there a string of smaller owner also has (0 or >= least)."""
    reach = np.zeros(len(data), np.uint32)
    array = SuffixArray(data, bounds, least)
    owner = owners[array.string]
    for depth, first, last in array.maximal_repeats():
        own = owner[first : last + 1]
        later = own > own.min()
        if later.any():
            places = array.starts[first : last + 1][later]
            reach[places] = np.maximum(reach[places], depth)
    return reach


def _anchors(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The anchor of each string's first window, and so of all its windows."""
    grams = Spans(data).windows(GRAM)
    return grams[bounds[:-1, None] + np.arange(LEAST - GRAM + 1)].min(axis=1)


# ---- runs of windows with one anchor -------------------------------------------------------------


class Runs:
    """The runs of the rows of a text column: ``row``, first and last window, anchor and content hash."""

    def __init__(self, column: pa.Array):
        parts = [self._slice(column.slice(a, b - a), a) for a, b in slices(column, SLICE_BYTES)]
        names = ("row", "first", "last", "anchor", "content")
        kinds = (np.int64, np.int64, np.int64, np.uint64, np.uint64)
        for k, (name, kind) in enumerate(zip(names, kinds)):
            setattr(self, name, np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, kind))

    @staticmethod
    def _slice(column: pa.Array, row_before: int) -> tuple[np.ndarray, ...]:
        data, offsets = utf8(column)
        n = len(data) - LEAST + 1
        if n <= 0:
            none = np.zeros(0, np.int64)
            return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
        spans = Spans(data)
        least, reach = spans.windows(GRAM), 1
        width = LEAST - GRAM + 1
        while 2 * reach <= width:
            least = np.minimum(least[: len(least) - reach], least[reach:])
            reach *= 2
        if reach < width:
            least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
        rows = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        valid = rows[:n] == rows[LEAST - 1 :]
        begins = valid.copy()
        begins[1:] &= ~valid[:-1] | (least[1:] != least[:-1]) | (rows[1:n] != rows[: n - 1])
        ends = valid.copy()
        ends[:-1] &= ~valid[1:] | begins[1:]
        first, last = np.flatnonzero(begins), np.flatnonzero(ends)
        # Text of a short period has one anchor all along; its pieces repeat each other.
        pieces = -(-(last - first + 1) // LONGEST_RUN)
        nth = np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = np.repeat(first, pieces) + nth * LONGEST_RUN
        last = np.minimum(np.repeat(last, pieces), first + LONGEST_RUN - 1)
        row = rows[first]
        content = spans.hashed(first, last + LEAST)
        # Least values crowd near zero; mixed again, they fill the buckets evenly.
        return row + row_before, first - offsets[row], last - offsets[row], mix(least[first]), content


class Entries:
    """The distinct (anchor, content) of a part in order, the least id of each, and each run's number."""

    def __init__(self, runs: Runs, ids: np.ndarray):
        own = ids[runs.row]
        # Both hashes keep 48 bits, as they are sent.
        drop = np.uint64(0xFFFF)
        anchor, content = runs.anchor & ~drop, runs.content & ~drop
        order = np.lexsort((own, content, anchor))
        a, c = anchor[order], content[order]
        new = np.ones(len(order), bool)
        new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.cumsum(new) - 1
        self.anchor, self.content, self.least = a[new], c[new], own[order][new]
        #: A run that stands for the entry: one of its least document.
        self.run = order[new]

    def segments(self, buckets: int) -> Iterator[tuple[int, int, int]]:
        """Bucket, first entry and the one after the last; anchors are dealt to buckets by range."""
        bucket = ((self.anchor >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        firsts = np.concatenate([[0], cuts]) if len(bucket) else cuts
        for a, b in zip(firsts.tolist(), np.append(firsts[1:], len(bucket)).tolist()):
            yield int(bucket[a]), a, b


def _narrow(ids: np.ndarray) -> bytes:
    """Ids as a base and the smallest unsigned type that holds the differences."""
    base = int(ids.min()) if len(ids) else 0
    rest = (ids - np.int64(base)).view(np.uint64)
    kind = np.min_scalar_type(int(rest.max()) if len(rest) else 0)
    return struct.pack("<qB", base, kind.itemsize) + rest.astype(kind).tobytes()


def _wide(packed: bytes, n: int) -> np.ndarray:
    base, size = struct.unpack_from("<qB", packed)
    return np.frombuffer(packed, f"<u{size}", n, 9).astype(np.uint64).view(np.int64) + np.int64(base)


def _pack_entries(entries: Entries, a: int, b: int) -> bytes:
    both = (x[a:b].astype("<u8").view(np.uint8).reshape(-1, 8) for x in (entries.anchor, entries.content))
    hashes = [x[:, 2:].tobytes() for x in both]
    return struct.pack("<I", b - a) + b"".join(hashes) + _narrow(entries.least[a:b])


def _unpack_entries(packed: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    (n,) = struct.unpack_from("<I", packed)
    out = []
    for k in range(2):
        wide = np.zeros((n, 8), np.uint8)
        wide[:, 2:] = np.frombuffer(packed, np.uint8, 6 * n, 4 + 6 * n * k).reshape(n, 6)
        out.append(wide.reshape(-1).view("<u8"))
    return out[0], out[1], _wide(packed[4 + 12 * n :], n)


COVERED, OPEN, CROWDED = 1, 2, 4
_BLOBS = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("kind", pa.int32()), ("packed", pa.binary())])
BLOBS = "bucket int, part int, kind int, packed binary"


def _blobs(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    columns = list(zip(*rows)) or [[], [], [], []]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, _BLOBS.types)], schema=_BLOBS)


def _ids(rows: pa.Table) -> np.ndarray:
    return rows.column("id").combine_chunks().fill_null(_NO_ID).to_numpy(zero_copy_only=False)


def _text(rows: pa.Table) -> pa.Array:
    return rows.column("text").combine_chunks()


def _sent(buckets: int):
    def sent(rows: pa.Table) -> pa.Table:
        """Step 2, by part: the distinct runs, packed by bucket."""
        entries = Entries(Runs(_text(rows)), _ids(rows))
        part = rows.column("part")[0].as_py()
        return _blobs([(k, part, 0, _pack_entries(entries, a, b)) for k, a, b in entries.segments(buckets)])

    return sent


def _met(rows: pa.Table, crowd: int) -> pa.Table:
    """Step 2, by bucket: for each part's entries what the others have of them."""
    parts = rows.column("part").to_pylist()
    blobs = [_unpack_entries(b) for b in rows.column("packed").to_pylist()]
    anchor, content, least = (np.concatenate([b[k] for b in blobs]) for k in range(3))
    order = np.lexsort((least, content, anchor))
    a, c, m = anchor[order], content[order], least[order]
    new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
    new = new_anchor | np.concatenate([[True], c[1:] != c[:-1]])
    first = np.maximum.accumulate(np.where(new, np.arange(len(a)), 0))
    group = np.cumsum(new_anchor) - 1
    at = np.flatnonzero(new_anchor)
    kinds = np.add.reduceat(new.astype(np.int64), at)
    # An anchor matters further if it has several runs, of several documents.
    lowest, highest = np.minimum.reduceat(m[first], at), np.maximum.reduceat(m[first], at)
    further = ((kinds > 1) & (lowest < highest))[group]
    codes = np.where(m > m[first], COVERED, np.where(further, OPEN, 0))
    codes |= np.where(further & (kinds > crowd)[group], CROWDED, 0)
    back = np.empty(len(order), np.uint8)
    back[order] = codes
    ends = np.cumsum([len(b[0]) for b in blobs])
    bucket = rows.column("bucket")[0].as_py()
    made = [(bucket, part, 0, back[e - len(b[0]) : e]) for part, b, e in zip(parts, blobs, ends)]
    return _blobs([(k, p, kind, codes.tobytes()) for k, p, kind, codes in made if codes.any()])


class _Part:
    """What steps 3 and 4 know of a part: its runs, entries and their codes, and the strings that are open."""

    def __init__(self, rows: pa.Table, answers: pa.Table, buckets: int):
        self.text, self.ids = _text(rows), _ids(rows)
        self.data, self.offsets = utf8(self.text)
        self.runs = Runs(self.text)
        self.entries = Entries(self.runs, self.ids)
        self.segments = list(self.entries.segments(buckets))
        self.codes = np.zeros(len(self.entries.anchor), np.uint8)
        told = self._told(answers, 0)
        for bucket, a, b in self.segments:
            if bucket in told:
                self.codes[a:b] = np.frombuffer(told[bucket], np.uint8)
        self.buckets = buckets

    @staticmethod
    def _told(answers: pa.Table, kind: int) -> dict[int, bytes]:
        columns = (answers.column(k).to_pylist() for k in ("bucket", "kind", "packed"))
        return {bucket: packed for bucket, of, packed in zip(*columns) if of == kind}

    def spans(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the strings of entries stand in ``data``."""
        run = self.entries.run[entries]
        start = self.offsets[self.runs.row[run]]
        return start + self.runs.first[run], start + self.runs.last[run] + LEAST

    def plain(self, a: int, b: int) -> np.ndarray:
        """The open entries of a segment that are not crowded."""
        return a + np.flatnonzero((self.codes[a:b] & (OPEN | CROWDED)) == OPEN)

    def crowded(self) -> tuple[np.ndarray, ...]:
        """The windows of crowded open entries: their place and entry, the distinct ones' hash, least id and
        place, the number of each window among the distinct ones, and these ones' buckets."""
        entries = np.flatnonzero((self.codes & (OPEN | CROWDED)) == OPEN | CROWDED)
        start, end = self.spans(entries)
        counts = end - start - LEAST + 1
        of = np.repeat(np.arange(len(entries)), counts)
        place = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts) + start[of]
        owner = self.entries.least[entries][of]
        hashes = _window_hashes(self.data, place)
        order = np.lexsort((owner, hashes))
        new = np.ones(len(order), bool)
        new[1:] = hashes[order][1:] != hashes[order][:-1]
        number = np.empty(len(order), np.int64)
        number[order] = np.cumsum(new) - 1
        chosen = order[new]
        bucket = ((hashes[chosen] >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(np.int64)
        return place, entries[of], owner[chosen], place[chosen], number, bucket


def _window_hashes(data: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Hashes of the windows at some places; computed around them, not over all of the part."""
    out = np.zeros(len(places), np.uint64)
    order = np.argsort(places, kind="stable")
    step = 1 << 16
    at = 0
    while at < len(order):
        begin = int(places[order[at]])
        to = int(np.searchsorted(places[order], begin + step))
        chosen = order[at:to]
        stretch = data[begin : int(places[chosen[-1]]) + LEAST]
        out[chosen] = Spans(stretch).windows(LEAST)[places[chosen] - begin]
        at = to
    return out


def _gather(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    sizes = end - start
    return data[np.repeat(start - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))]


def _opened(buckets: int):
    def opened(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        """Step 3, by part: the strings of open runs, packed by bucket."""
        if not len(rows):
            return _blobs([])
        part = _Part(rows, answers, buckets)
        number, out = key[0].as_py(), []

        def add(bucket: int, kind: int, owner: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
            ids = _narrow(owner)
            head = struct.pack("<II", len(owner), len(ids))
            sizes = (end - start).astype("<u4").tobytes()
            out.append((bucket, number, kind, head + ids + sizes + _gather(part.data, start, end).tobytes()))

        for bucket, a, b in part.segments:
            chosen = part.plain(a, b)
            if len(chosen):
                add(bucket, 1, part.entries.least[chosen], *part.spans(chosen))
        _, _, owner, place, _, dealt = part.crowded()
        for bucket in np.unique(dealt).tolist():
            chosen = dealt == bucket
            add(bucket, 2, owner[chosen], place[chosen], place[chosen] + LEAST)
        return _blobs(out)

    return opened


def _repeated(rows: pa.Table) -> pa.Table:
    """Step 3, by bucket: how far each window of the strings is repeated from a smaller document."""
    owners, bounds, data, anchors = [], [], [], []
    for packed in rows.column("packed").to_pylist():
        n, width = struct.unpack_from("<II", packed)
        owners.append(_wide(packed[8 : 8 + width], n))
        sizes = np.frombuffer(packed, "<u4", n, 8 + width).astype(np.int64)
        bounds.append(np.concatenate([[0], np.cumsum(sizes)]))
        data.append(np.frombuffer(packed, np.uint8, offset=8 + width + 4 * n))
        anchors.append(_anchors(data[-1], bounds[-1]))
    before = np.cumsum([0, *map(len, data)])
    start = np.concatenate([b[:-1] + k for b, k in zip(bounds, before)])
    end = np.concatenate([b[1:] + k for b, k in zip(bounds, before)])
    owner, anchor, joined = np.concatenate(owners), np.concatenate(anchors), np.concatenate(data)
    reach = np.zeros(len(joined), np.uint32)
    order = np.argsort(anchor, kind="stable")
    ends = np.cumsum((end - start)[order])
    turns = np.flatnonzero(np.concatenate([anchor[order][1:] != anchor[order][:-1], [True]])) + 1
    at = 0
    while at < len(order):
        wanted = np.searchsorted(ends, (ends[at - 1] if at else 0) + SORT_BYTES)
        to = int(turns[np.searchsorted(turns, min(max(wanted, at + 1), len(order)))])
        chosen = order[at:to]
        own = np.concatenate([[0], np.cumsum((end - start)[chosen])])
        found = covered(_gather(joined, start[chosen], end[chosen]), own, owner[chosen])
        places = np.flatnonzero(found)
        string = np.searchsorted(own, places, "right") - 1
        reach[start[chosen][string] + places - own[string]] = found[places]
        at = to
    out = []
    for part, kind, a, b in zip(rows.column("part").to_pylist(), rows.column("kind").to_pylist(), before, before[1:]):
        mine = reach[a:b]
        if mine.any():
            places = np.flatnonzero(mine)
            packed = struct.pack("<I", len(places))
            packed += places.astype("<u4").tobytes() + mine[places].astype("<u4").tobytes()
            out.append((rows.column("bucket")[0].as_py(), part, kind, packed))
    return _blobs(out)


_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())]
)
RESULT = "doc_id long, n_bytes long, removed array<array<long>>, kept binary"


def _places(packed: bytes) -> Iterator[np.ndarray]:
    (n,) = struct.unpack_from("<I", packed)
    return (np.frombuffer(packed, "<u4", n, 4 + 4 * n * k).astype(np.int64) for k in range(2))


def _cut_out(buckets: int):
    def cut_out(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        """Step 4, by part: the documents without what is covered."""
        if not len(rows):
            return _RESULT.empty_table()
        part = _Part(rows, answers, buckets)
        runs, entries, n = part.runs, part.entries, len(part.data)
        change = np.zeros(n + 1, np.int32)

        def cover(start: np.ndarray, end: np.ndarray) -> None:
            np.add.at(change, start, 1)
            np.add.at(change, end, -1)

        start = part.offsets[runs.row] + runs.first
        end = part.offsets[runs.row] + runs.last + LEAST
        whole = ((part.codes[entries.of] & COVERED) > 0) | (part.ids[runs.row] > entries.least[entries.of])
        cover(start[whole], end[whole])
        # What is known of an entry's string holds for all runs of its least document.
        rest = np.flatnonzero(~whole)
        rest = rest[np.argsort(entries.of[rest], kind="stable")]
        rest_entry = entries.of[rest]

        def cover_entries(of: np.ndarray, offset: np.ndarray, length: np.ndarray) -> None:
            a, b = np.searchsorted(rest_entry, of, "left"), np.searchsorted(rest_entry, of, "right")
            counts = b - a
            run = rest[np.repeat(a - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))]
            begin = start[run] + np.repeat(offset, counts)
            cover(begin, begin + np.repeat(length, counts))

        told = part._told(answers, 1)
        for bucket, a, b in part.segments:
            if bucket in told:
                chosen = part.plain(a, b)
                first, after = part.spans(chosen)
                bounds = np.concatenate([[0], np.cumsum(after - first)])
                places, lengths = _places(told[bucket])
                string = np.searchsorted(bounds, places, "right") - 1
                cover_entries(chosen[string], places - bounds[string], lengths)
        place, entry, owner, _, number, dealt = part.crowded()
        if len(place):
            earlier = np.zeros(len(owner), bool)
            for bucket, packed in part._told(answers, 2).items():
                chosen = np.flatnonzero(dealt == bucket)
                places, _ = _places(packed)
                earlier[chosen[places // LEAST]] = True
            hit = earlier[number] | (entries.least[entry] > owner[number])
            first, _ = part.spans(entry[hit])
            cover_entries(entry[hit], place[hit] - first, np.full(int(hit.sum()), LEAST))

        gone = np.cumsum(change[:-1]) > 0
        firsts = part.offsets[:-1]
        ids = rows.column("id").combine_chunks()
        removed, kept = [], []
        sums = np.concatenate([[0], np.cumsum(gone)])
        touched = sums[part.offsets[1:]] > sums[firsts]
        for r, (a, b) in enumerate(zip(firsts.tolist(), part.offsets[1:].tolist())):
            if not touched[r]:
                removed.append([])
                kept.append(part.data[a:b].tobytes())
                continue
            mask = gone[a:b]
            turns = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
            removed.append(turns.reshape(-1, 2).tolist())
            kept.append(part.data[a:b][~mask].tobytes())
        sizes = pa.array(np.diff(part.offsets))
        columns = [ids, sizes, pa.array(removed, _RESULT.types[2]), pa.array(kept, pa.binary())]
        return pa.Table.from_arrays(columns, schema=_RESULT)

    return cut_out


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", crowd: int = CROWD
) -> DataFrame:
    """One row per document: ``n_bytes``, the removed spans [first byte, byte after the last], the bytes kept.

    The number of parts follows from the text's size, so that a part fits a task.  Texts are shuffled
    once; the three steps that read a part share that exchange.
    """
    spark = docs.sparkSession
    text = F.col(text_column)
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).cast("long").alias("n")).first().n
    parts = max(1, -(-total // PART_BYTES))
    buckets = min(parts, max(LEAST_BUCKETS, -(-total // BUCKET_BYTES)))
    tasks = max(partitions(spark), -(-parts // PARTS_PER_TASK))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), text.alias("text"))
    rows = rows.select(F.pmod(F.xxhash64("id", "text"), F.lit(parts)).cast("int").alias("part"), "id", "text")
    rows = rows.repartition(tasks, "part")

    sent = rows.groupBy("part").applyInArrow(_sent(buckets), BLOBS)
    met = sent.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(lambda blobs: _met(blobs, crowd), BLOBS)
    met = met.repartition(tasks, "part")
    opened = rows.groupBy("part").cogroup(met.groupBy("part")).applyInArrow(_opened(buckets), BLOBS)
    repeated = opened.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_repeated, BLOBS)
    answers = met.unionByName(repeated).repartition(tasks, "part")
    return rows.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(_cut_out(buckets), RESULT)


def repeat_digests(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """The registered query: sizes, number of spans and digest of what is kept."""
    cut = without_repeats(docs, crowd=crowd)
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return cut.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
