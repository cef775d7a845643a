"""Cases that earlier versions of the corpus operators got wrong."""

import random

import numpy as np
import pyarrow as pa
import pytest

from fieldmark.llm import decontaminate, fingerprints, graphs, languages, queries, token_files, warc
from tests.llm import plain


def thue_morse(n):
    return "".join("ab"[bin(k).count("1") % 2] for k in range(n))


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_paragraphs_that_collide_in_a_polynomial_hash(n):
    text = thue_morse(n)
    other = text.translate(str.maketrans("ab", "ba"))
    a, b = fingerprints.fingerprint(text), fingerprints.fingerprint(other)
    assert (a.exact != b.exact).all()
    both = fingerprints.fingerprint(text + "\n" + other)
    assert both == a + b == fingerprints.fingerprint(other + "\n" + text)
    assert both - b == a


def test_letters_beyond_sixteen_bits_are_told_apart():
    texts = ["\U00020000\U00020001", "\U00020001\U00020000", "\U00010400x", "\U00010428x", "a\U0001F600b"]
    letters, rows = languages.folded(pa.array(texts))
    of = [letters[rows == k].tolist() for k in range(len(texts))]
    assert of[0] != of[1] and sorted(of[0]) == sorted(of[1])
    # Capital and small letters of one script are one; a picture is a space.
    assert of[2] == of[3] and of[4] == [0x20, ord("a"), 0x20, ord("b")]
    assert of[0] == [0x20, *(int.from_bytes(texts[0].encode("utf-16-le")[2 * k : 2 * k + 2], "little") for k in range(4))]
    found = {tuple(languages.grams(np.array(x, np.uint16), np.zeros(len(x), int), 4)[0].tolist()) for x in of[:2]}
    assert len(found) == 2


def roots_by_hand(links):
    above = {}

    def top(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        above[max(a, b)] = min(a, b)
    return {x: top(x) for x in list(above)}


def shuffled_path(n):
    rng = random.Random(2)
    places = rng.sample(range(n), n)
    return list(zip(places, places[1:]))


@pytest.mark.parametrize(
    "links, rounds",
    [
        # A hub that two thirds of all links touch: a task's part of it is one row a node.
        ([(90_000, k) for k in range(3000)] + [(k, k + 1) for k in range(5000, 6500)], 4),
        (shuffled_path(1500), 8),
        ([(1, 1), (2, 3), (3, 2), (2, 3)], 3),
    ],
)
@pytest.mark.parametrize("small", [True, False])
def test_components_in_few_rounds(spark, monkeypatch, links, rounds, small):
    written = []
    monkeypatch.setattr(graphs, "broadcasts", lambda table: small)
    cut = graphs.cut
    monkeypatch.setattr(graphs, "cut", lambda df, name: written.append(name) or cut(df, name))
    random.Random(3).shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(6)
    got = {r.node: r.root for r in graphs.components(df).collect()}
    assert got == roots_by_hand([(a, b) for a, b in links if a != b])
    assert written.count("rooted") <= rounds


def split_by(spark, size):
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")


def test_archives_read_in_two_layouts_lose_no_record(spark, tmp_path, monkeypatch):
    magic = warc.MAGIC
    rows = [(k, f"http://a/{k}", f"text {k} " + (magic + "x" * (k % 7)) * (k % 5 == 0) * (1 + k % 3)) for k in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    warc.write_archives(pages, str(tmp_path / "w"))
    scan, sizes = warc._pieces, iter([700, 100_000])

    def other_layout(*args):
        split_by(spark, next(sizes))
        pieces = scan(*args)
        pieces.rdd.getNumPartitions()  # plans the scan under this setting
        return pieces

    try:
        split_by(spark, 700)
        want = {tuple(r) for r in warc.read_archives(spark, str(tmp_path / "w")).collect()}
        monkeypatch.setattr(warc, "_pieces", other_layout)
        found = warc.read_archives(spark, str(tmp_path / "w"))
        split_by(spark, 100_000)
        got = [tuple(r) for r in found.collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(got) == 400 and set(got) == want
    assert {r[0]: r[1] for r in got} == {i: len(h) for i, _, h in rows}


def test_archives_hold_what_the_format_asks_for(spark, tmp_path):
    rows = [(1, "http://a", "same"), (2, None, "same"), (2, None, "same"), (1, "u", "same"), (None, "v", "same")]
    rows += [(3, "", "ab"), (3, "", "ab"), (None, None, None), (4, "http://b", "alone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    for least in (0, 3):
        path = tmp_path / f"w{least}"
        warc.write_archives(pages, str(path), least, "2025-05-05T05:05:05Z")
        text = "".join(f.read_bytes().decode() for f in path.glob("part-*"))
        records = []
        for head in text.split(warc.MAGIC)[1:]:
            records.append(dict(line.split(": ", 1) for line in head.split("\r\n\r\n")[0].split("\r\n")))
        assert len(records) == len(rows)
        ids = [r["WARC-Record-ID"] for r in records]
        assert len(set(ids)) == len(ids)
        assert all(r["WARC-Date"] == "2025-05-05T05:05:05Z" and r["WARC-Target-URI"] for r in records)
        responses = {r["WARC-Record-ID"] for r in records if r["WARC-Type"] == "response"}
        for r in records:
            assert (r["WARC-Type"] == "revisit") == (r.get("WARC-Profile") == warc.PROFILE) == ("WARC-Refers-To" in r)
            assert r.get("WARC-Refers-To") in {None, *responses}
        assert len(responses) == (4 if least == 0 else 5)
        assert sum(r.record_type == "revisit" for r in warc.read_archives(spark, str(path)).collect()) == len(rows) - len(responses)


def test_windows_scattered_with_contradictory_numbers_are_no_leak(spark):
    item = "take 5 red balls then add 5 blue balls then drop 5 green balls now"
    words = item.split()
    values = iter(range(100, 1000))
    scattered = ". ".join(
        " ".join(str(next(values)) if w == "5" else w for w in words[k : k + 5]) + " and so on" for k in range(len(words) - 4)
    )
    shifted = "well take 7 red balls then add 7 blue balls and next then drop 7 green balls now then we go"
    longer = "take 5 red balls then add 5 blue balls then drop 5 green balls now and then put them all into the box by the door"
    put_in = longer.replace("then drop", "then please drop").replace("5", "8")
    docs = spark.createDataFrame([(1, scattered), (2, shifted), (3, put_in), (4, item)], "doc_id long, text string")
    items = spark.createDataFrame([(1, item), (2, longer)], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.changed for r in decontaminate.leaks(docs, items).collect()}
    assert (1, 1) not in got and got[4, 1] == 0 and got[3, 2] == 1
    single = spark.createDataFrame([(9, "entropy")], "item_id long, text string")
    held = spark.createDataFrame([(1, "we define entropy here"), (2, "entropy")], "doc_id long, text string")
    assert {r.doc_id for r in decontaminate.leaks(held, single).collect()} == {2}
    assert {r.doc_id for r in decontaminate.leaks(held, single, shortest=1).collect()} == {1, 2}


def test_leaks_are_those_of_a_plain_template_matcher(spark):
    rng = random.Random(5)
    nouns, names = "apples pears balls boxes cars".split(), "Tom Anna Mary Bob Éva Jones".split()
    verbs = "has gives takes sells".split()

    def sentence():
        number = rng.choice(["3", "12", "4.5", "1,200", "7"])
        unit = rng.choice(["", " kg", " miles", " HOURS"])
        name = rng.choice(names) + rng.choice(["", " " + rng.choice(names)])
        end = rng.choice([".", "?", ":", ",", ""])
        return f"{rng.choice([name, 'The man', 'he'])} {rng.choice(verbs)} {number}{unit} {rng.choice(nouns)} to {name}{end}"

    def changed(text):
        words = text.split(" ")
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(words))
            words[k : k + 1] = rng.choice([[], [words[k], "also"], [rng.choice(names)], [str(rng.randint(1, 99))]])
        return " ".join(words or ["x"])

    items = {k: " ".join(sentence() for _ in range(rng.randint(1, 3))) for k in range(25)}
    items |= {25: "What is 12 + 7?", 26: "Hello", 27: "", 28: None, 29: "5 kg"}
    docs = {k: " ".join(rng.choice([sentence(), changed(rng.choice(list(items.values())[:26]))]) for _ in range(rng.randint(0, 6))) for k in range(120)}
    docs |= {120: None, 121: "Hello", 122: "What is 3 + 4? What is 5 + 5?", 123: docs[3] + " " + docs[3]}
    got = decontaminate.leaks(
        spark.createDataFrame(list(docs.items()), "doc_id long, text string"),
        spark.createDataFrame(list(items.items()), "item_id long, text string"),
    ).collect()
    want = plain.template_leaks(docs, items, decontaminate.UNITS, decontaminate.FUNCTION_WORDS)
    assert {(r.doc_id, r.item_id): (r.share, r.changed) for r in got} == want and len(want) > 50


def test_token_files_keep_the_order_of_the_files_read(spark, tmp_path):
    ids = random.Random(8).sample(range(500), 500)
    docs = spark.createDataFrame([(i, f"text {i} " * (i % 5)) for i in ids + ids[:40]], "doc_id long, text string")
    docs.coalesce(1).write.option("maxRecordsPerFile", 90).parquet(str(tmp_path / "docs"))
    read = spark.read.parquet(str(tmp_path / "docs"))
    order = token_files.file_order(read)
    assert len(order) == 3 and token_files.file_order(docs) == []
    starts = {}
    for name, keys in (("given", order), ("by id", [])):
        path = str(tmp_path / name)
        token_files.write_tokens(read, path, queries.tokenizer_path(), order=keys)
        rows = sorted(token_files.token_digests(spark, path).collect(), key=lambda r: r.start)
        assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:])) and rows[0].start == 0
        starts[name] = [r.doc_id for r in rows]
    written = read.select("doc_id", "_metadata.file_name", "_metadata.row_index").collect()
    assert starts["given"] == [r.doc_id for r in sorted(written, key=lambda r: r[1:])]
    assert starts["by id"] == sorted(ids + ids[:40])


def test_token_files_read_a_batch_slice_by_slice(monkeypatch):
    import pyarrow as pa

    from fieldmark.llm import token_files

    seen = []
    real = token_files.slices
    monkeypatch.setattr(token_files, "slices", lambda column: seen.append(len(column)) or real(column, 100), raising=True)
    texts = ["x" * (k % 37) for k in range(500)]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([3] * 500, pa.int32()), pa.array(range(500), pa.int64()), pa.array(texts)], names=["shard", "doc_id", "text"]
    )
    fed = list(token_files._fed(iter([batch, batch.slice(0, 0)])))
    assert [i for ids, _, _ in fed for i in ids] == list(range(500)) and [t for _, part, _ in fed for t in part] == texts
    assert seen == [500, 0] and {shard for *_, shard in fed} == {3}
