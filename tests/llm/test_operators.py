"""Each operator against its plain version, over a small table of awkward rows and the smallest given tables."""

import base64
import collections
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from fieldmark.llm import (
    decontaminate,
    fingerprints,
    graphs,
    languages,
    mixing,
    near_dups,
    quality,
    queries,
    repeats,
    secrets,
    token_files,
    warc,
)
from tests.llm import plain

SCHEMA = "doc_id long, text string, lang string, source string, score double, node string, place long"


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty and very long texts, ties, repeated rows; extra columns whose names the operators use inside."""
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(400)]
    texts = [" ".join(rng.choices(words, k=rng.randint(20, 90))) for _ in range(30)]
    texts += [t.replace(words[k], "changed") + " end" for k, t in enumerate(texts[:12])]
    texts += texts[:5] + ["", "   ", "!!!", "one two", "one two", "a" * 400, "é" * 70, " ".join(rng.choices(words, k=9000))]
    texts.append("x\npassword = 'abc12345'\n" + "ab" * 14 + " AKIA" + "Z9" * 9)
    out = [(k, t, "en", f"s{k % 4}", 0.5, "n", k) for k, t in enumerate(texts)]
    out += [(k + 500, None, None, None, None, None, None) for k in range(2)]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def awkward(spark, docs, rows):
    """``docs`` with null ids, an id that stands for two texts, and repeated rows."""
    more = [(None, rows[0][1], "en", None, 1.0, None, 1), (None, None, None, None, None, None, None), rows[3], rows[3]]
    more.append((3, "another text of the same id", "en", "s1", 0.1, "n", 3))
    return docs.unionByName(spark.createDataFrame(more, SCHEMA))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def texts_of(rows):
    return {r[0]: r[1] or "" for r in rows}


def test_fingerprints(docs, awkward, empty, rows):
    texts = texts_of(rows)
    want = plain.edited(texts)
    got = {r.doc_id: r for r in fingerprints.fingerprints(docs).collect()}
    assert {i: r.n_chars for i, r in got.items()} == {i: len(t) for i, t in texts.items()}
    assert {i: r.edited_sha256 for i, r in got.items()} == {
        i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()
    }
    by_text = collections.defaultdict(set)
    for i, r in got.items():
        by_text[texts[i]].add(r.fingerprint)
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
        if want[i] == texts[i]:
            assert r.near_edited == 1
    assert all(len(prints) == 1 for prints in by_text.values())
    long = [r for i, r in got.items() if len(texts[i]) > 200 and want[i] != texts[i] and "aaaa" not in texts[i]]
    assert np.mean([r.near_edited > r.near_next for r in long]) > 0.95
    assert fingerprints.fingerprints(awkward).count() == awkward.count()
    assert fingerprints.fingerprints(empty).count() == 0


def test_fingerprint_is_homomorphic():
    lines = [f"line number {k} of the text" for k in range(9)] + ["x", "x"]
    whole = fingerprints.fingerprint("\n".join(lines))
    mixed = random.Random(1).sample(lines, len(lines))
    assert fingerprints.fingerprint("\n".join(mixed)) == whole
    assert fingerprints.fingerprint("\n".join(lines[:6])) + fingerprints.fingerprint("\n".join(lines[6:])) == whole
    assert whole - fingerprints.fingerprint(lines[0]) == fingerprints.fingerprint("\n".join(lines[1:]))
    assert fingerprints.fingerprint("\n".join(lines[:-1])) != whole


@pytest.mark.parametrize("crowd", [repeats.CROWD, 1, 3])
def test_repeats(spark, awkward, crowd):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    rng = random.Random(3)
    parts = ["".join(rng.choice("abcde ") for _ in range(rng.randint(30, 200))) for _ in range(20)]
    for k in range(60):
        pick = [rng.choice([rng.choice(parts), rng.choice(parts)[: rng.randint(20, 120)]]) for _ in range(rng.randint(0, 6))]
        rows.append((rng.randint(900, 950), "é".join(pick)))
    rows += [(960, "a" * 5000), (961, "b" * 60 + "a" * 70)]
    got = repeats.repeat_digests(spark.createDataFrame(rows, "doc_id long, text string"), crowd).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(plain.without_repeats(rows), key=repr)


def test_suffix_array_has_all_occurrences():
    strings = [b"--" + b"q" * 3 + b"abcdefgh" + b"1", b"abcdefgh2", b"xabcdefgh3", b"zzzz"]
    data = np.frombuffer(b"".join(strings), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
    array = repeats.SuffixArray(data, bounds, least=4)
    found = {(d, tuple(sorted(array.starts[a : b + 1].tolist()))) for d, a, b in array.maximal_repeats()}
    assert (8, (5, 14, 24)) in found
    assert not any(d == 7 for d, _ in found), "a repeat that extends to the left everywhere is not maximal"


def test_repeats_on_empty(empty):
    assert repeats.repeat_digests(empty).count() == 0


def test_quality(spark, sf_dir, awkward, empty):
    docs, labels = (queries.table(spark, sf_dir, n) for n in ("documents", "labels"))
    got = quality.quality_scores(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    told = got.merge(labels.toPandas(), on="doc_id")
    told = told[told.held_out]
    assert told[told.quality == 1].score.mean() > told[told.quality == 0].score.mean() + 0.3
    odd = spark.createDataFrame([(None, 1), (3, None), (3, 1), (3, 0), (4, 1), (77777, 0)], "doc_id long, quality int")
    assert quality.quality_scores(awkward, odd).count() == awkward.count()
    assert quality.quality_scores(empty, odd).count() == 0
    nothing = quality.quality_scores(awkward, odd.limit(0)).toPandas()
    assert (nothing.score == 0.5).all()


def test_quality_learns_from_one_row_per_id(spark):
    rows = [(1, f"the same id {k}") for k in range(40)] + [(1, None)] + [(k, f"text of {k}") for k in range(2, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 9)], "doc_id long, quality int")
    model = quality.train(docs, labels, max_labelled=8)
    assert sorted(model.labels.tolist()) == [0.0] * 4 + [1.0] * 4
    again = quality.train(docs.repartition(2), labels, max_labelled=8)
    assert np.array_equal(model.vectors, again.vectors)


def pages_of(rows):
    digest = [base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for _, _, h in rows]
    best = collections.defaultdict(list)
    for (i, _, _), d in zip(rows, digest):
        best[d].append(-1 if i is None else i)
    return [(i, len((h or "").encode()), d, max(best[d])) for (i, _, h), d in zip(rows, digest)]


@pytest.mark.parametrize("parts", [1, 4])
def test_warc(spark, tmp_path, parts):
    magic = warc.MAGIC
    fake = f"{magic}WARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    held = "A" + magic + "B" + magic
    rows = [(1, "http://a", fake + "x"), (2, "http://b\r\nEvil: 1", "plain"), (3, None, "plain"), (4, "http://é", None)]
    rows += [(5, "", ""), (None, "u", "plain"), (7, "u", held), (7, "u", held), (8, "u", magic), (6, "u", held)]
    rows += [(9, "u", magic * 3 + fake * 2), (10, "u", "é" * 50 + fake), (-5, "u", "negative")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(parts)
    warc.write_archives(pages, str(tmp_path / "w"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = warc.read_archives(spark, str(tmp_path / "w")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = pages_of(rows)
    assert sorted((r.page_id or 0, r.payload_bytes, r.payload_digest) for r in got) == sorted(
        (i or 0, n, d) for i, n, d, _ in want
    )
    best = {d: b for _, _, d, b in want}
    responses = [r for r in got if r.record_type == "response"]
    assert sorted(r.payload_digest for r in responses) == sorted(best)
    assert all(r.page_id == best[r.payload_digest] and r.refers_to is None for r in responses)
    assert all(r.refers_to == best[r.payload_digest] for r in got if r.record_type == "revisit")


def test_warc_rejects_a_broken_chain(spark, tmp_path):
    (tmp_path / "w").mkdir()
    (tmp_path / "w" / "a.warc").write_bytes(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort\r\n\r\n")
    with pytest.raises(Exception, match="chain of records breaks"):
        warc.read_archives(spark, str(tmp_path / "w")).count()


def test_warc_of_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write_archives(pages, str(tmp_path / "w"))
    assert warc.read_archives(spark, str(tmp_path / "w")).count() == 0


def test_signatures_are_unbiased():
    rng = np.random.default_rng(1)
    off = []
    for _ in range(20):
        items = rng.integers(1, 2**63, 200).astype(np.uint64)
        one = rng.integers(0, 9, 200)
        two = np.where(rng.random(200) < 0.6, one, rng.integers(0, 9, 200))
        found = np.concatenate([np.repeat(items, one), np.repeat(items, two)])
        of = np.concatenate([np.zeros(one.sum(), int), np.ones(two.sum(), int)])
        first, second = near_dups.signatures(found, of, 2, 1024)
        off.append((first == second).mean() - np.minimum(one, two).sum() / np.maximum(one, two).sum())
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.03


def test_near_classes(docs, awkward, empty, rows, spark, sf_dir):
    for table, texts in ((docs, texts_of(rows)), (queries.table(spark, sf_dir, "documents"), None)):
        texts = texts or {r.doc_id: r.text or "" for r in table.select("doc_id", "text").collect()}
        got = {r.doc_id: r.class_id for r in near_dups.classes(table).collect()}
        assert got == plain.near_classes(texts)
        kept = near_dups.one_per_class(table)
        assert kept.columns == table.columns
        assert sorted(r.doc_id for r in kept.collect()) == sorted(set(got.values()))
    assert near_dups.classes(awkward).count() == awkward.count()
    kept = near_dups.one_per_class(awkward).toPandas()
    assert kept.text[kept.doc_id == 3].nunique() == 2 and (kept.doc_id == 3).sum() == 2
    assert near_dups.classes(empty).count() == 0 and near_dups.one_per_class(empty).count() == 0


def test_large_classes_are_cut_into_blocks(monkeypatch, spark):
    base = [f"w{k}" for k in range(200)]
    texts = {k: " ".join(base[:k] + ["new"] + base[k + 1 :]) for k in range(200)}
    monkeypatch.setattr(near_dups, "BLOCK", 16)
    got = near_dups.classes(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert {r.doc_id: r.class_id for r in got} == plain.near_classes(texts)


def test_components(spark):
    links = [(k, k + 1) for k in range(50)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 301), (301, 302)]
    got = {r.node: r.root for r in graphs.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(51)} | {k: 100 for k in range(100, 160)} | {k: 300 for k in (300, 301, 302)}
    assert graphs.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_mixture(docs, awkward, empty, rows):
    for table in (docs, awkward):
        frame = table.toPandas()
        frame["size"] = [len(plain.SIZE.findall(t or "")) for t in frame.text]
        frame["source"] = frame.source.astype(object).where(frame.source.notna(), None)
        sizes = {s: int(frame["size"][[x == s for x in frame.source]].sum()) for s in set(frame.source)}
        want = plain.targets(sizes)
        got = mixing.mixture(table).toPandas()
        assert len(got) == len(frame) and got["size"].sum() == frame["size"].sum()
        assert (got.taken <= 2 * got["size"]).all() and (got.taken >= 0).all()
        assert sorted(set(got.target.round(6))) == sorted({round(v, 6) for v in want.values()})
        assert abs(got.taken.sum() - sum(want.values())) <= len(want)
        again = mixing.mixture(table.repartition(7)).toPandas()
        order = ["doc_id", "size", "taken", "position"]
        assert got[order].sort_values(order).reset_index(drop=True).equals(
            again[order].sort_values(order).reset_index(drop=True)
        )
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns
    words = sum(len(plain.SIZE.findall(r.text)) for r in mixed.collect())
    assert words == mixing.mixture(docs).toPandas().taken.sum()
    assert mixing.mixture(empty).count() == 0 and mixing.mixed(empty).count() == 0


def test_positions_follow_the_schedule(docs):
    got = mixing.mixture(docs).toPandas()
    got = got[got.times > 0]
    assert got.position.between(0, 1).all() and (got.again >= got.position).all()


def test_mixture_is_range_sorted(awkward, tmp_path):
    for number, table in enumerate((awkward, awkward.repartition(7))):
        path = str(tmp_path / f"m{number}")
        mixing.mixture(table).write.parquet(path)
        parts = sorted((tmp_path / f"m{number}").glob("part-*"))
        got = [p for part in parts for p in pq.read_table(part).column("position").to_pylist()]
        taken = [p for p in got if p is not None]
        assert len(got) == table.count() and got[: len(taken)] == sorted(taken)


def test_token_files(spark, awkward, empty, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    tokenizer.encode_special_tokens = True
    token_files.write_tokens(awkward, str(tmp_path / "t"), queries.tokenizer_path())
    got = token_files.token_digests(spark, str(tmp_path / "t")).toPandas().sort_values("start")
    assert got.doc_id.fillna(-1).is_monotonic_increasing
    assert (got.start == got.n_tokens.cumsum() - got.n_tokens).all()
    want = collections.Counter()
    for r in awkward.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
        want[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    ids = got.doc_id.astype(object).where(got.doc_id.notna(), None)
    assert collections.Counter(zip(ids, got.n_tokens, got.ids_crc32)) == want
    read = token_files.read_tokens(spark, str(tmp_path / "t")).collect()
    assert sum(len(r.ids) for r in read) == got.n_tokens.sum()
    token_files.write_tokens(empty, str(tmp_path / "e"), queries.tokenizer_path())
    assert token_files.token_digests(spark, str(tmp_path / "e")).count() == 0


def test_words_encode_as_texts_do(monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(token_files, "HELD_WORDS", 300)
    monkeypatch.setattr(token_files, "KEPT_WORDS", 60)
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    tokenizer.encode_special_tokens = True
    encoder, rng = token_files.Encoder(queries.tokenizer_path()), random.Random(5)
    marks = ["\1", ".", ",", "...", "3.14", "x.", "y,", ".'s", "'s", " ", " ", " ", "\n", "\t", "\r", "\x85", "\x1c", "\0"]
    pool = marks + ["é", "ß", "日本", "😀", "the", "ing", "<|endoftext|>", "１．", "Ⅷ.", "á."]
    for _ in range(150):
        texts = ["".join(rng.choices(pool, k=rng.randint(0, 25))) for _ in range(15)]
        texts += [" ".join("".join(rng.choices("abcd", k=rng.randint(1, 4))) for _ in range(20)) + ".\nNext, one."]
        for text, ids in zip(texts, encoder(texts)):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [0], text


def test_token_files_have_the_ids_of_the_plain_call(spark, tmp_path):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    mark, rng = "<|endoftext|>", random.Random(9)
    texts = ["a <|endoftext|> b", mark, mark * 2, f"the end.{mark}\nNext, one", f" {mark}", "plain, again.", "< |endoftext| >"]
    texts += ["".join(rng.choices([mark, " the", " a", "b", ".", "\n", ", x", "\1"], k=12)) for _ in range(200)]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    token_files.write_tokens(docs, str(tmp_path / "t"), queries.tokenizer_path())
    got = {r.doc_id: list(r.ids) for r in token_files.read_tokens(spark, str(tmp_path / "t")).collect()}
    assert got[0] == [64, 220, 50256, 275, 0]
    assert got == {k: tokenizer.encode(t, add_special_tokens=False).ids + [0] for k, t in enumerate(texts)}


def test_packing_is_reversible():
    for seed in range(20):
        ids = np.random.default_rng(seed).zipf(1.2, 1 + seed * 37).clip(0, 3_000_000).astype(np.uint32)
        ranked, control, data = token_files.pack(ids)
        assert (token_files.unpack(ranked, control, data, len(ids)) == ids).all()
    wide = np.arange(70_000, dtype=np.uint32)
    assert (token_files.unpack(*token_files.pack(wide), len(wide)) == wide).all()


ITEM = "Anna Smith has 12 apples and gives 5 kg to Bob Jones before walking 3 miles home with her dog."


def test_decontamination_finds_other_parameters(spark):
    told = {
        1: ITEM,
        2: "Well, Peter has 99 apples and gives 7 kg to Maria Garcia before walking 8 miles home with her dog.",
        3: "the dog has 12 apples",
        4: ITEM.replace("apples", "pears").replace("walking", "driving").replace("home", "away"),
        5: "",
    }
    docs = spark.createDataFrame([*told.items(), (None, None)], "doc_id long, text string")
    items = spark.createDataFrame([(7, ITEM), (8, None), (9, "the"), (None, "")], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.leaks(docs, items).collect()}
    assert set(got) == {1, 2} and got[1].changed == 0 and got[2].changed == 5
    assert sorted(r.doc_id or 0 for r in decontaminate.without_leaks(docs, items).collect()) == [0, 3, 4, 5]


def test_decontamination_checks_slots(spark):
    item = "take 5 red balls then add 5 blue balls then drop 5 green balls now"
    told = [(1, item.replace("5", "8")), (2, "take 8 red balls then add 9 blue balls then drop 8 green balls now")]
    docs = spark.createDataFrame(told, "doc_id long, text string")
    got = decontaminate.leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert [r.doc_id for r in got] == [1]


def test_decontamination_finds_names_that_begin_sentences(spark):
    item = "Tom has 5 apples. Tom gives 2 apples to Mary. How many apples are left?"
    other = "Anna has 3 apples. Anna gives 4 apples to Eve. How many apples are left?"
    told = {
        1: f"Here is one more for the class. {item} Think well.",
        2: f"Here is one more for the class. {other} Think well.",
        3: f"Well, {other}",
        4: f"Here is one more. {other.replace('Anna gives', 'Eve gives')} Think well.",
        5: "Anna has 3 pears. Anna sells 4 pears at noon. How many people are there?",
    }
    docs = spark.createDataFrame([*told.items()], "doc_id long, text string")
    got = decontaminate.leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r.doc_id: (r.share, r.changed) for r in got} == {1: (1.0, 0), 2: (1.0, 4), 3: (1.0, 4)}


def test_decontamination_finds_short_items_in_long_documents(spark):
    items = [(1, "What is 12 + 7?"), (2, "Compute 12 * 7."), (3, "Define entropy")]
    around = "We met near the old mill and talked for a while. {} Then everyone went home before it rained."
    told = [(k, around.format(text)) for k, text in items]
    told += [(4, around.format("What is 30 + 4?")), (5, around.format("What was 12 + 7?")), (6, around.format("Compute!"))]
    told += [(7, "define entropy"), (8, "we define free entropy"), (9, "Compute 3 * 3.")]
    docs = spark.createDataFrame(told, "doc_id long, text string")
    got = decontaminate.leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (2, 2), (3, 3), (4, 1), (7, 3), (9, 2)}


def test_decontamination_of_the_tables(spark, sf_dir, awkward, empty):
    docs, items = (queries.table(spark, sf_dir, n) for n in ("documents", "benchmark"))
    having, sizes = collections.defaultdict(set), {}
    for r in items.collect():
        bag = plain.bag(r.text)
        sizes[r.item_id] = len(bag)
        for s in bag:
            having[s].add(r.item_id)
    want = set()
    for r in docs.collect():
        met = collections.Counter(i for s in plain.bag(r.text) for i in having.get(s, ()))
        want |= {(r.doc_id, i) for i, n in met.items() if n >= 0.8 * sizes[i]}
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}
    assert got == want and want
    kept = decontaminate.without_leaks(awkward, items)
    assert kept.columns == awkward.columns and kept.count() == awkward.count()
    assert decontaminate.leaks(empty, items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0


def test_secrets(awkward, empty, spark):
    more = ["TOKEN: abc", "Api_Key='x' password=secret=abcdefg", "paſſword=abcdefgh toKen=abcdefgh", "İ token=abcdefg"]
    more += ["é" * 9 + "0123456789abcdef" * 3, "AKIAAKIA" + "B" * 20, "deadbeef" * 2, "passwd = \n x", "f" * 24 + "g" * 3]
    rows = [(r.doc_id, r.text) for r in awkward.collect()] + [(2000 + k, t) for k, t in enumerate(more)]
    got = secrets.secret_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = collections.Counter((i, hashlib.sha256(plain.base_spans(t).encode()).hexdigest()) for i, t in rows)
    assert collections.Counter((r.doc_id, r.base_sha256) for r in got) == want
    assert secrets.secret_spans(empty).count() == 0


def test_checksums_decide():
    body = "A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5"
    value, digits = zlib.crc32(body.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        digits = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"[digit] + digits
    good = f"ghp_{body}{digits.rjust(6, '0')}"
    text = f"{good} {good[:-1]}? card 4111 1111 1111 1111, card 4111 1111 1111 1112; IBAN GB82 WEST 1234 5698 7654 32"
    kinds = [k for k, _, _ in secrets.spans(text, secrets._automaton())]
    assert kinds == ["checked", "card", "iban"]


def test_languages(spark, sf_dir, docs, awkward, empty):
    odd = languages.language_predictions(docs).toPandas().merge(docs.toPandas()[["doc_id", "text"]], on="doc_id")
    docs = queries.table(spark, sf_dir, "documents")
    got = languages.language_predictions(docs).toPandas().merge(docs.toPandas()[["doc_id", "lang", "text"]], on="doc_id")
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.95 and got.score.between(0, 1).all()
    no_letter = [not any(c.isalpha() for c in t or "") for t in odd.text]
    assert ((odd.lang_pred == "und") == no_letter).all()
    assert languages.language_predictions(awkward).count() == awkward.count()
    assert languages.language_predictions(empty).count() == 0
    model = languages.train(awkward)
    assert languages.accepted(awkward, model).columns == awkward.columns
    assert languages.accepted(docs, languages.train(empty)).count() == 0


def test_language_models_are_distributions():
    """Interpolated probabilities of all characters after a context sum to one but for the unseen rest."""
    texts = pa.array(["abab cab bac abba cabab", "xyz zyx xxyz zzyx"])
    counted = list(languages._counted(iter([pa.record_batch([pa.array(["a", "x"]), texts], names=["l", "t"])])))
    table = pa.Table.from_batches(counted)
    lang = np.array([0 if v == "a" else 1 for v in table.column("lang").to_pylist()])
    codes = table.column("code").to_numpy().view(np.uint64)
    model = languages.build(["a", "x"], lang, codes, table.column("n").to_numpy().astype(float))
    letters = np.array([ord(c) for c in " abcxyz"], np.uint64)
    for context in ("aba", "ab ", " xy", "zzz"):
        above = sum(ord(c) << 16 * (3 - k) for k, c in enumerate(context))
        total = np.exp(model.logs(letters | np.uint64(above))).sum(axis=0)
        assert (total < 1.01).all() and (total > 0.8).all(), (context, total)


def test_language_models_keep_every_gram(spark):
    """40,000 4-grams of 20 bits would share some 760 slots."""
    rng = random.Random(11)
    texts = {lang: "".join(chr(rng.randint(0x4E00, 0x9FA5)) for _ in range(20_000)) for lang in ("x", "y")}
    rows = [(lang, t[a : a + 2000]) for lang, t in texts.items() for a in range(0, len(t), 2000)]
    model = languages.train(spark.createDataFrame(rows, "lang string, text string"))
    read = ["   " + " " + t for _, t in rows]
    for order in range(1, languages.ORDER + 1):
        seen = {t[k - order + 1 : k + 1] for t in read for k in range(3, len(t))}
        above = {g[:-1] for g in seen}
        assert (len(model.tables[order - 1][0]), len(model.contexts[order - 1][0])) == (len(seen), len(above))
    # An unseen 4-gram whose context was not seen either is left to the order below.
    unseen = rng.choices(range(0x3400, 0x4DB5), k=4)
    code = np.array([sum(c << 16 * (3 - k) for k, c in enumerate(unseen))], np.uint64)
    assert np.array_equal(model.logs(code), model.logs(code & np.uint64((1 << 48) - 1), 3))


def test_letters_do_not_depend_on_the_batch():
    texts = ["Hello, World", "", None, "é\0b", "日本 x", " lead"]
    whole = languages.folded(pa.array(texts))
    for k, text in enumerate(texts):
        alone = languages.folded(pa.array([text], pa.string()))
        assert whole[0][whole[1] == k].tolist() == alone[0].tolist()


def test_pipeline(spark, sf_dir, awkward):
    import corpus_pipeline

    names = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = queries.table(spark, sf_dir, "documents")
    left = {r.doc_id: r.text for r in docs.collect()}
    model = languages.train(docs)
    left = {r.doc_id: r.text for r in languages.accepted(docs, model).collect()}
    classes = plain.near_classes(left)
    left = {i: t for i, t in left.items() if classes[i] == i}
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir)
        assert docs.columns == names, name
    found = {r.doc_id for r in docs.collect()}
    assert found <= set(left)
    leaked = {r.doc_id for r in decontaminate.leaks(
        spark.createDataFrame(list(left.items()), "doc_id long, text string"), queries.table(spark, sf_dir, "benchmark")
    ).collect()}
    assert found == set(left) - leaked
    result = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert set(result.doc_id) <= found and (result.groupby("doc_id").size() <= 2).all()
    odd = spark.createDataFrame(
        [(r.doc_id, r.text, r.lang, r.source, len(r.text or "")) for r in awkward.collect()],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for name, stage in corpus_pipeline.STAGES:
        odd = stage(spark, odd, sf_dir)
    assert odd.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "mixture", "tokens"]


def test_queries_are_registered():
    import __spark_entry__ as contract

    names = set(contract.queries())
    assert set(queries.QUERIES) < names and "pipeline" in names
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
