"""Secret scan: keyword automaton, anchored expressions near its hits, checksum validation.

One Aho-Corasick automaton over all keywords runs once over each whole text; an expression is only
tried at a hit of its keyword, anchored there.  Bare hexadecimal strings have no keyword: a class
table finds their runs in one pass over the bytes.

Base kinds (fixed): ``assign`` (a credential name, a separator and a value), ``access`` (key ids that
begin with AKIA) and ``hex``.  Matches of a kind are the leftmost non-overlapping ones of its whole
expression; those that are too short are dropped after matching, as a scan from left to right would.

Added kinds carry their own checksum and count only if it holds: ``checked`` (prefixed tokens whose
last six characters are the base-62 CRC-32 of the rest), ``card`` (card numbers near the word card,
Luhn sum), ``iban`` (account numbers near the word iban, remainder 1 modulo 97).

Positions are in code points, ends exclusive.  Cases: a null or empty text has no spans; repeated
rows get a row each.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fieldmark.llm.common import tidy

#: Fixed values of the contract.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
BASE = ("assign", "access", "hex")

_ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def crc_holds(token: str) -> bool:
    """True if the last six characters are the base-62 CRC-32 of what stands between prefix and them."""
    body, check = token.split("_", 1)[1][:-6], token[-6:]
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = _ALPHABET[digit] + digits
    return digits.rjust(6, "0") == check


def luhn_holds(number: str) -> bool:
    digits = [int(c) for c in number if c.isascii() and c.isdigit()]
    doubled = [d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
    return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0


def iban_holds(number: str) -> bool:
    compact = number.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1


#: kind: keywords, expression anchored at the keyword, group of the span, validation of that group.
_RULES: dict[str, tuple[tuple[str, ...], re.Pattern, int, Callable[[str], bool] | None]] = {
    "assign": (
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(ASSIGN, re.IGNORECASE | re.ASCII),
        0,
        None,
    ),
    "access": (("akia",), re.compile(ACCESS), 0, None),
    "checked": (
        ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_"),
        re.compile(r"(?:gh[pousr]|npm)_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
        0,
        crc_holds,
    ),
    "card": (
        ("card",),
        re.compile(r"card[^0-9\n]{0,20}([0-9](?:[ -]?[0-9]){12,18})(?![0-9])", re.IGNORECASE | re.ASCII),
        1,
        luhn_holds,
    ),
    "iban": (
        ("iban",),
        re.compile(
            r"iban[^A-Z0-9\n]{0,10}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?)(?![A-Z0-9])",
            re.IGNORECASE | re.ASCII,
        ),
        1,
        iban_holds,
    ),
}

_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
_HEX = np.zeros(256, bool)
_HEX[np.frombuffer(b"0123456789abcdef", np.uint8)] = True


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    kinds: dict[str, list[str]] = {}
    for kind, (keywords, *_) in _RULES.items():
        for keyword in keywords:
            kinds.setdefault(keyword, []).append(kind)
    for keyword, of in kinds.items():
        found.add_word(keyword, (len(keyword), tuple(of)))
    found.make_automaton()
    return found


def _hex_runs(text: str) -> list[tuple[int, int]]:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) < HEX_LEAST:
        return []
    inside = _HEX[data]
    # A run that is long enough covers three neighbouring multiples of a third of its least length.
    probes = inside[:: HEX_LEAST // 3]
    if not (probes[2:] & probes[1:-1] & probes[:-2]).any():
        return []
    edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    edges = np.concatenate([[0], edges, [len(data)]])
    runs = [(a, b) for a, b in zip(edges[:-1], edges[1:]) if b - a >= HEX_LEAST and inside[a]]
    if runs and len(data) != len(text):
        points = np.cumsum((data & 0xC0) != 0x80) - 1
        runs = [(int(points[a]), int(points[b - 1]) + 1) for a, b in runs]
    return [(int(a), int(b)) for a, b in runs]


def spans(text: str, automaton) -> list[tuple[str, int, int]]:
    """All spans of a text: kind, start, end; by start, then in the order of the kinds."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = text.translate(_LOWER)
    reached = dict.fromkeys(_RULES, 0)
    found = []
    hits = sorted((end + 1 - length, kind) for end, (length, kinds) in automaton.iter(lower) for kind in kinds)
    for start, kind in hits:
        if start < reached[kind]:
            continue
        _, pattern, group, valid = _RULES[kind]
        match = pattern.match(text, start)
        if match is None:
            continue
        if valid is None:
            reached[kind] = match.end()
            if kind == "assign" and len(match[2]) < ASSIGN_LEAST:
                continue
            if kind == "access" and match.end() - match.start() < ACCESS_LEAST:
                continue
        elif valid(match[group]):
            reached[kind] = match.end()
        else:
            continue
        found.append((kind, match.start(group), match.end(group)))
    found += [("hex", a, b) for a, b in _hex_runs(text)]
    order = {kind: k for k, kind in enumerate((*BASE, "checked", "card", "iban"))}
    return sorted(found, key=lambda s: (s[1], order[s[0]]))


_RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_assign", pa.int64()),
        ("n_access", pa.int64()),
        ("n_hex", pa.int64()),
        ("base_sha256", pa.string()),
        ("spans", pa.string()),
    ]
)


def _joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in found)


@tidy
def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton = _automaton()
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = spans(text or "", automaton)
            base = [s for s in found if s[0] in BASE]
            counts = [sum(s[0] == kind for s in base) for kind in BASE]
            rows.append((doc_id, *counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(found)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _RESULT.types)], schema=_RESULT)


def secret_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: the numbers of its base spans, their digest and all spans."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    return rows.mapInArrow(
        _scanned,
        "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string",
    )
