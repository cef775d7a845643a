"""Plain, single-machine versions of the operators, to hold them against."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
SIZE = re.compile(r"[^\x20\x09-\x0D]+")


def edited(texts: dict[int, str]) -> dict[int, str]:
    order = sorted(texts, reverse=True)
    out = {}
    for k, i in enumerate(order):
        own, following = texts[i], texts[order[(k + 1) % len(order)]]
        n = len(own) // 3
        out[i] = own[: len(own) - n] + following[:n]
    return out


def without_repeats(rows: list[tuple], least: int = 50) -> list[tuple]:
    """(id, bytes, removed bytes, removed runs, digest of the rest) of each row."""
    data = [(i, (t or "").encode()) for i, t in rows]
    first: dict[bytes, int] = {}
    for i, b in data:
        for k in range(len(b) - least + 1):
            w = b[k : k + least]
            if i is not None and i < first.get(w, i + 1):
                first[w] = i
    out = []
    for i, b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - least + 1):
            w = first.get(b[k : k + least])
            if w is not None and (i is None or w < i):
                gone[k : k + least] = b"\1" * least
        runs = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        rest = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return out


def bag(text: str | None) -> collections.Counter:
    words = WORD.findall((text or "").lower())
    if not words:
        return collections.Counter()
    return collections.Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def near_classes(texts: dict[int, str], similarity: float = 0.8) -> dict[int, int]:
    """The least id of each document's class, by comparing all pairs that share a shingle."""
    bags = {i: bag(t) for i, t in texts.items()}
    having = collections.defaultdict(list)
    for i, b in bags.items():
        for s in b:
            having[s].append(i)
    parent = {i: i for i in texts}

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, b in bags.items():
        for j in {j for s in b for j in having[s] if j < i}:
            shared = (b & bags[j]).total()
            if shared >= similarity * (b.total() + bags[j].total() - shared):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i in texts}


def targets(sizes: dict, total: float = 1.5, most: float = 2.0) -> dict:
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    given: dict = {}
    while True:
        rest = total * sum(sizes.values()) - sum(given.values())
        open_ = [s for s in names if s not in given]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = [s for s in open_ if share[s] > most * sizes[s]]
        if not above:
            return given | share
        given |= {s: most * sizes[s] for s in above}
        if len(given) == len(names):
            return given


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def base_spans(text: str | None) -> str:
    text = text or ""
    found = [("assign", m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end(), 1) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end(), 2) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    found.sort(key=lambda s: (s[1], s[3]))
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b, _ in found)


def template(text: str | None, form: int, units: set, function_words: set) -> list[tuple[str, str, bool]]:
    """(template token, text it stands for, literal word or not) of a text, word by word."""
    text = text or ""
    out: list[tuple[str, str, bool]] = []
    end, was_number, was_name = 0, False, False
    start_of_last = 0
    for k, m in enumerate(WORD.finditer(text)):
        word, between = m.group(), text[end : m.start()]
        low = "".join(c.lower() if c < "\u0080" or "À" <= c <= "Þ" and c != "×" else c for c in word)
        number = word[0] in "0123456789"
        unit = k > 0 and was_number and not number and len(between) <= 1 and low in units
        begins = k == 0 or any(c in between for c in ".!?:\n")
        capital = (word[0] in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" or "À" <= word[0] <= "Þ") and re.search("[a-z]", word)
        name = bool(capital) and not number and not unit
        name = name and (form == 1 and not begins or form == 2 and low not in function_words)
        joined = number and was_number and between in (".", ",") and k > 0
        joined = joined or name and was_name and not begins and len(between) == 1
        if joined:
            out[-1] = (out[-1][0], text[start_of_last : m.end()], out[-1][2])
        else:
            start_of_last = m.start()
            token = "<number>" if number else "<unit>" if unit else "<name>" if name else low
            out.append((token, word, not (number or unit or name)))
        end, was_number, was_name = m.end(), number, name
    return out


def template_leaks(docs: dict, items: dict, units: list, function_words: list, shortest: int = 2) -> dict:
    """(document, item) -> (share, changed values), by comparing every window of every pair."""
    found: dict = {}
    for form in (0, 1, 2):
        made = {i: template(t, form, set(units), set(function_words)) for i, t in items.items()}
        widths = {len(t) for t in made.values() if shortest <= len(t) < 5}
        for d, text in docs.items():
            tokens = template(text, form, set(units), set(function_words))
            own = [(min(5, len(tokens)), at) for at in range(max(1, len(tokens) - 4))] if tokens else []
            own += [(w, at) for w in widths if len(tokens) > w for at in range(len(tokens) - w + 1)]
            for i, item in made.items():
                width = min(5, len(item))
                places = [p for p in range(len(item) - width + 1) if any(x[2] for x in item[p : p + width])] if item else []
                aligned: dict = collections.defaultdict(lambda: (set(), set()))
                for w, at in own:
                    for p in places:
                        a, b = item[p : p + width], tokens[at : at + w]
                        if w == width and [x[0] for x in a] == [x[0] for x in b]:
                            aligned[at - p][0].add(p)
                            aligned[at - p][1].update((x[1], y[1]) for x, y in zip(a, b) if not x[2])
                sound = {k: v for k, v in aligned.items() if len({x for x, _ in v[1]}) == len(v[1])}
                runs: list = []
                for k in sorted(sound):
                    if not runs or k - runs[-1][-1] > len(places) + 5:
                        runs.append([])
                    runs[-1].append(k)
                for run in runs:
                    held, pairs = set(), set()
                    for k in sorted(run, key=lambda k: (-len(sound[k][0]), k)):
                        more = pairs | sound[k][1]
                        if len({x for x, _ in more}) == len(more):
                            held, pairs = held | sound[k][0], more
                    if held and len(held) >= 0.8 * len(places):
                        share, changed = len(held) / len(places), sum(x != y for x, y in pairs)
                        best = found.get((d, i), (0, changed))
                        found[d, i] = (max(best[0], share), min(best[1], changed))
    return found
