"""Token counts, spelling variants and vector codes against the library, brute force and SQL."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from fieldmark.llm import queries, spelling, token_counts, vector_codes

DOCS = "doc_id long, text string, word string, n long, n_tokens string, group string, h int"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def library(tokenizer, texts):
    return [len(e.ids) for e in tokenizer.encode_batch(list(texts), add_special_tokens=False)]


PIECES = [
    " ", "  ", "\n", "\t", "'", "'s", "'ll", "'re", "'S", "a", "b", "the", "Å", "é", "1", "23", "!", "...", "　",
    "漢", "字", "😀", "\0", "\x1c", "\x85", "\xa0", "<|endoftext|>", "<|endof", "²", "०", "̀", "՘",
]


def test_token_counts_equal_the_library(tokenizer):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PIECES, k=rng.randint(0, 30))) for _ in range(3000)]
    # Long sequences around the border between the two ways to merge, and equal letters.
    texts += ["a" * n for n in (1, 2, 3, token_counts.LONG, token_counts.LONG + 1, 5001)]
    texts += ["".join(rng.choices("abcdefgh", k=n)) for n in (token_counts.LONG - 1, token_counts.LONG + 1, 9000)]
    # One text of several pieces, one without any white space.
    texts += ["".join(rng.choices("etaoin sh'.", k=1_500_000)), "é!" * 700_000]
    got = token_counts.count_tokens(pa.array(texts, pa.string()), queries.tokenizer_path())
    assert got.tolist() == library(tokenizer, texts)


def test_token_counts_cases(spark, tokenizer):
    rows = [
        (1, "two words", "x", 1, "y", "z", 0), (1, "two words", "x", 1, "y", "z", 0), (None, "more", None, None, None, None, 0),
        (2, None, None, None, None, None, None), (3, "", "x", 1, "y", "z", 0), (4, "é " * 600, "x", 1, "y", "z", 0),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    got = token_counts.token_counts(docs, queries.tokenizer_path()).collect()
    want = [
        (i, len((t or "").encode()), n, n > 512)
        for (i, t), n in zip(((r[0], r[1]) for r in rows), library(tokenizer, (r[1] or "" for r in rows)))
    ]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert token_counts.token_counts(docs.limit(0), queries.tokenizer_path()).count() == 0


def test_token_counts_of_the_table(spark, sf_dir, tokenizer):
    docs = {r.doc_id: r.text or "" for r in queries.table(spark, sf_dir, "documents").collect()}
    got = {r.doc_id: r.n_tokens for r in queries.op11_token_counts(spark, sf_dir).collect()}
    assert got == dict(zip(docs, library(tokenizer, docs.values())))


def test_merges_have_to_follow_their_parts():
    letters = {c: k for k, c in enumerate(token_counts._byte_letters())}
    vocabulary = letters | {"ab": 256, "abc": 257}
    with pytest.raises(ValueError, match="parts"):
        token_counts.Merges.of(vocabulary, [("ab", "c"), ("a", "b")])


def words_by_hand(rows):
    counts = collections.Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            k = h % len(run)
            counts[run[:k] + run[k + 1 :] if h % 199 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def near_by_hand(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def variants_by_hand(words):
    near = {w: [v for v in words if near_by_hand(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return out


@pytest.fixture(scope="module")
def spelled():
    """Words over few letters, with counts that make chains, a crowded beginning, and awkward rows."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcé", k=rng.randint(6, 9))) for _ in range(60)]
    words += ["commonst" + a + b + c for a in "abcd" for b in "abcd" for c in "abcd"]
    words += [w[:k] + w[k + 1 :] for w in words[:30] for k in (0, 4, len(w) - 1)]
    words += ["chainaa", "chainab", "chaincb", "chaincbd", "straße", "strasse", "x" * 300, "x" * 301, "aab" * 3, "aaab" + "aab" * 2]
    texts = [" ".join([w] * rng.choice((5, 6, 30, 160))) for w in words]
    texts += [" ".join(["chainaa"] * 5), " ".join(["CHAINAB"] * 40), " ".join(["chaincb"] * 800), " ".join(["chaincbd"] * 5000)]
    rows = [(k, t, "w", 1, "t", "g", 0) for k, t in enumerate(texts)]
    rows += [(None, "chainaa Straße strasse", None, None, None, None, None), (7, None, None, None, None, None, None)]
    return rows + [(8, "", "w", 1, "t", "g", 0), (3, texts[3], "w", 1, "t", "g", 0), rows[5], rows[5]]


@pytest.mark.parametrize("crowd", [spelling.CROWD, 3])
def test_spelling_variants(spark, spelled, crowd):
    docs = spark.createDataFrame(spelled, DOCS)
    words = spelling.vocabulary(docs)
    want = words_by_hand([(r[0], r[1]) for r in spelled])
    assert {r.word: r.n for r in words.collect()} == want
    found = [tuple(r) for r in spelling.variants(words, crowd).collect()]
    assert len(found) == len(want)
    assert set(found) == variants_by_hand(want)
    assert any(form and root != form for _, form, root, *_ in found)


def test_spelling_block_sizes_do_not_matter(spark, spelled, monkeypatch):
    docs = spark.createDataFrame(spelled, DOCS)
    words = {r.word: r.n for r in spelling.vocabulary(docs).collect()}
    names = sorted(words, key=lambda w: (len(w), w))
    batch = pa.RecordBatch.from_pylist(
        [
            {"word": w, "n": words[w], "group": "<all", "shorter": 6, "ending": False, "longer": longer}
            for longer in (False, True)
            for w in names
            if len(w) == 6 + longer
        ]
    )
    pairs = sum(near_by_hand(a, b) for a in names for b in names if {len(a), len(b)} <= {6, 7} and min(len(a), len(b)) == 6)
    for size in (64, 2048):
        monkeypatch.setattr(spelling, "BLOCK", size)
        found = pa.Table.from_batches(spelling._near_in_groups(iter([batch.slice(0, 20), batch.slice(20)])))
        assert sum(found["near"].to_pylist()) == pairs


def test_spelling_of_nothing(spark, spelled):
    docs = spark.createDataFrame(spelled, DOCS)
    assert spelling.spelling_variants(docs.limit(0)).count() == 0
    assert spelling.spelling_variants(docs.filter("text is null")).count() == 0


def codes_by_hand(rows, parts=8, entries=16, rounds=6):
    """(id, code, error, label error, digest) of each row, with Python's integers."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    whole = [[math.floor(x) if abs(x) >= 2**60 else math.floor(4096 * x) for x in r[1]] for r in kept]
    split = [[w[p * width : (p + 1) * width] for p in range(parts)] for w in whole]
    books = [[s[p] for s in split[:entries]] for p in range(parts)]

    def apart(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assigned():
        return [[min(range(len(books[p])), key=lambda e: (apart(s[p], books[p][e]), e)) for p in range(parts)] for s in split]

    for _ in range(rounds):
        codes = assigned()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [s[p] for s, c in zip(split, codes) if c[p] == e]
                if own:
                    books[p] = [*books[p][:e], [sum(x) // len(own) for x in zip(*own)], *books[p][e + 1 :]]
    codes = assigned()
    errors = [sum(apart(s[p], books[p][c[p]]) for p in range(parts)) for s, c in zip(split, codes)]
    by_label = collections.Counter()
    for r, e in zip(kept, errors):
        by_label[r[2]] += e
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return [(r[0], bytes(c).hex(), e, by_label[r[2]], digest) for r, c, e in zip(kept, codes, errors)]


VECTORS = "vec_id long, embedding array<float>, label string, code string, error long, vector int, part int"


def compared(spark, rows, schema=VECTORS, **settings):
    vectors = spark.createDataFrame([(*r, "c", 1, 2, 3) for r in rows], schema)
    got = [tuple(r) for r in vector_codes.vector_codes(vectors, **settings).collect()]
    assert sorted(got, key=repr) == sorted(codes_by_hand(rows), key=repr)
    return got


def test_vector_codes_with_awkward_rows(spark):
    rng = np.random.default_rng(2)
    values = np.round(rng.normal(size=(700, 16)), 2).astype(np.float32)
    values[300:400] = values[0]  # a large group of copies
    values[3] = values[1]  # equal entries
    rows = [(k, v.tolist(), None if k % 5 == 0 else f"l{min(k % 7, 2)}") for k, v in enumerate(values)]
    rows += [(900, None, "l1"), (901, [], "l1"), (902, [None] * 16, "l1"), (903, [math.nan] * 16, "l1")]
    rows += [(904, [math.inf] * 16, None), (None, values[5].tolist(), "l2"), rows[9], rows[9], (4, values[8].tolist(), "l1")]
    compared(spark, rows)


def test_vector_codes_of_few_rows(spark):
    rows = [(k, [k / 7.0] * 8, "a") for k in range(5)]
    assert len(compared(spark, rows)) == 5
    compared(spark, [(k, [0.25] * 8, None) for k in range(40)])
    vectors = spark.createDataFrame([(1, None, "a"), (2, [], "b")], "vec_id long, embedding array<float>, label string")
    assert vector_codes.vector_codes(vectors).count() == 0
    assert vector_codes.vector_codes(vectors.limit(0)).count() == 0


def test_vector_codes_beyond_floating_point(spark):
    rng = np.random.default_rng(4)
    rows = [(k, (rng.normal(size=8) * 40_000 + 0.125).tolist(), "a") for k in range(60)]
    compared(spark, rows, VECTORS.replace("array<float>", "array<double>"))


def test_vector_lengths(spark):
    schema = "vec_id long, embedding array<float>, label string"
    with pytest.raises(ValueError, match="length"):
        vector_codes.vector_codes(spark.createDataFrame([(1, [1.0] * 8, "a"), (2, [1.0] * 16, "a")], schema)).collect()
    with pytest.raises(ValueError, match="length"):
        vector_codes.vector_codes(spark.createDataFrame([(1, [1.0] * 9, "a")], schema)).collect()


def test_trees_give_what_every_distance_gives():
    rng = np.random.default_rng(6)
    centers = rng.normal(size=(9, 6)) * 3000
    points = (centers[rng.integers(0, 9, 3000)] + rng.normal(size=(3000, 6)) * 40).astype(np.int64)
    tree = vector_codes._Tree(points)
    placed, nodes = points[np.concatenate(tree.order)], tree.nodes()
    for node in nodes:
        own = placed[node["start"] : node["end"]]
        assert (own.sum(axis=0) == node["sums"]).all() and (own * own).sum() == node["squares"]
        assert np.sqrt(((own - node["center"]) ** 2).sum(axis=1)).max() <= node["radius"] * (1 + 1e-9)
    book = points[:16]
    codes, errors = vector_codes._codes(placed, nodes, book)
    far = ((placed[:, None] - book[None]) ** 2).sum(axis=2)
    assert (codes == far.argmin(axis=1)).all() and (errors == far.min(axis=1)).all()
    owned, _, leaves, masks = vector_codes._walk(nodes, book)
    # Clustered points: most are never read.
    assert (nodes["end"] - nodes["start"])[owned].sum() > 1500
    counts, sums = vector_codes._totals(placed, nodes, book)
    assert counts.tolist() == np.bincount(codes, minlength=16).tolist()
    assert all((sums[e] == placed[codes == e].sum(axis=0)).all() for e in range(16))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql_twins(spark, sf_dir, duck, name):
    from checks.run import _table

    df = queries.QUERIES[name](spark, sf_dir)
    cursor = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert _table(df.columns, [tuple(r) for r in df.collect()]) == _table(names, cursor.fetchall())
