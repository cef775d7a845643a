"""Token-id files: frequency-ranked ids in byte-aligned variable-length coding with separate control bytes.

Documents are range-sorted by id, or by any columns given; each range becomes one shard.  A shard is a run of blocks of
whole documents, each block a row of a Parquet table with binary columns (Spark commits them as a
whole and a lost executor's blocks are written again):

``ranked``   the block's token ids by falling frequency, ties by id, as 32-bit integers
``lengths``  tokens per document, as 32-bit integers
``control``  two bits per token: the number of bytes of its rank, less one; four tokens a byte
``data``     the ranks' bytes, little-endian, without the leading zero bytes

Frequent tokens have ranks below 256 and take one byte.  Ranks are counted over all documents of
the block, and kept with it, so that writing needs one pass over the text and any block can be
decoded alone.  Decoding has no loop over tokens: a control byte's four lengths come from a table of
256 rows, their running sum gives the places of the bytes.

Ids are those of the tokenizer's plain call without special tokens added; the string of an added
token in a text is that token.

Cases: null and empty texts have the end token alone; equal ids and repeated rows keep a place each,
in order of their text's hash; null ids come first.  An empty table gives empty files.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fieldmark.llm.common import cut, partitions, slices, tidy, worker_state

END = 0
#: Tokens of a block, about; a longer document is a block of its own.
BLOCK_TOKENS = 1 << 20
#: Texts handed to the tokenizer at once, in characters.
FEED_CHARS = 1 << 20
#: Words that a worker holds with their ids, and how many of the most used it keeps when there are more.
HELD_WORDS = 500_000
KEPT_WORDS = 250_000

#: What is known of a word: it can be encoded by itself, it begins with a mark, a mark can follow it.
_PLAIN, _MARK, _JOINS = 1, 2, 4


def _joins(word: str) -> bool:
    """True if a point or comma after the word begins a token of its own."""
    return word != "" and unicodedata.category(word[-1])[0] in "LN"


def _kind(word: str) -> int:
    marked = word[:1] == "\1"
    body = word[1:] if marked or word[:1] == "\n" else word
    plain = body != "" and body.strip() == body and "\1" not in body
    return _PLAIN * plain | _MARK * marked | _JOINS * _joins(word)


class _Numbers(dict):
    """Numbers words from 1 as they are first asked for; ``new`` lists those since it was last emptied."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self.new.append(word)
        number = self[word] = 1 + len(self)
        return number


class Encoder:
    """The tokenizer with the ids of words already met.

    A byte-level BPE with this splitting rule never joins bytes across a space or a line end that
    stands between two characters other than white space, nor between a letter or digit and a point
    or comma.  So a text is a sequence of words, each with the space, line end or mark that it
    begins with, and each word met is encoded once.  Texts in which white space meets white space,
    or marks meet marks, are encoded as a whole, and so are those that hold the string of an added
    token, which the tokenizer cuts out first.  ``literal`` has such strings read as ordinary text.
    """

    def __init__(self, path: str, literal: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        added = [] if literal else self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content for token in added]
        vocabulary = self.tokenizer.get_vocab()
        # How a byte-level vocabulary spells the space and the line end.
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[n for t, n in vocabulary.items() if t.startswith("\u0120") or t == "\u010a"]] = True
        self._forget()

    def _forget(self) -> None:
        """Number 0 is the end of a text."""
        self.words = _Numbers()
        self.store, self.starts = np.array([END], np.uint32), np.zeros(1, np.int64)
        self.sizes, self.uses = np.ones(1, np.int64), np.zeros(1, np.int64)
        self.kinds = np.full(1, _PLAIN | _JOINS, np.uint8)

    def _thin(self) -> None:
        """Keep the most used words."""
        used = np.argsort(-self.uses[1:], kind="stable")[:KEPT_WORDS] + 1
        used.sort()
        keep = np.concatenate([[0], used])
        new_number = np.zeros(len(self.uses), np.int64)
        new_number[keep] = np.arange(len(keep))
        words = _Numbers()
        words.update((w, k) for w, k in zip(self.words, new_number[1:].tolist()) if k)
        starts, sizes = self.starts[keep], self.sizes[keep]
        ends = np.cumsum(sizes)
        self.store = self.store[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])]
        self.words, self.starts, self.sizes = words, ends - sizes, sizes
        self.kinds, self.uses = self.kinds[keep], self.uses[keep] // 2

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _has_added(self, text: str) -> bool:
        return any(token in text for token in self.added)

    def _learn(self) -> None:
        """Encode the words that were not met before, in one text that begins every word with its white space."""
        new, self.words.new = self.words.new, []
        if not new:
            return
        kinds = np.array([_kind(w) for w in new], np.uint8)
        plain, marked = kinds & _PLAIN > 0, kinds & _MARK > 0
        # A mark stands after a letter, whose one token is left out again.
        kept = [" a" + w[1:] if m else w if w[:1] == "\n" else " " + w for w, m in zip(new, marked.tolist())]
        kept = [w for w, good in zip(kept, plain.tolist()) if good]
        whole = "".join(kept)
        ids = self._encode([whole])[0] if kept else np.zeros(0, np.uint32)
        firsts = np.flatnonzero(self.begins[ids])
        if len(firsts) != len(kept) or self._has_added(whole):
            parts = self._encode(kept)
            ids = np.concatenate(parts)
            firsts = np.cumsum([0, *map(len, parts)])[:-1]
        starts, sizes = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        starts[plain] = firsts + len(self.store)
        sizes[plain] = np.diff(np.append(firsts, len(ids)))
        starts[plain & marked] += 1
        sizes[plain & marked] -= 1
        self.store, self.starts = np.concatenate([self.store, ids]), np.concatenate([self.starts, starts])
        self.sizes, self.kinds = np.concatenate([self.sizes, sizes]), np.concatenate([self.kinds, kinds])
        self.uses = np.concatenate([self.uses, np.zeros(len(new), np.int64)])

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, the end id appended."""
        numbers, bounds, first_words = [], [0], []
        cut_first = [self._has_added(t) for t in texts]
        for text, has_added in zip(texts, cut_first):
            words = [text] if has_added else text.replace("\n", " \n").replace(".", " \1.").replace(",", " \1,").split(" ")
            first_words.append(words[0])
            numbers += map(self.words.__getitem__, words[1:])
            numbers.append(0)
            bounds.append(len(numbers))
        self._learn()
        numbers, bounds = np.array(numbers, np.int64), np.array(bounds)
        self.uses += np.bincount(numbers, minlength=len(self.uses))
        starts, sizes = self.starts[numbers], self.sizes[numbers]
        ends = np.cumsum(sizes)
        ids = self.store[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1])]
        at = np.concatenate([[0], ends])[bounds]
        kinds = self.kinds[numbers]
        bad = kinds & _PLAIN == 0
        bad[1:] |= (kinds[1:] & _MARK > 0) & (kinds[:-1] & _JOINS == 0)
        rough = (np.add.reduceat(bad, bounds[:-1]) > 0) | np.array(cut_first, bool)
        first_marked = (kinds[bounds[:-1]] & _MARK > 0).tolist()
        rough |= [
            w != w.strip() or (w == "" and t != "") or "\1" in t or (m and not _joins(w))
            for w, t, m in zip(first_words, texts, first_marked)
        ]
        begun = self._encode([t if r else w for t, w, r in zip(texts, first_words, rough.tolist())])
        out = [
            np.append(first, np.uint32(END)) if r else np.concatenate([first, ids[a:b]])
            for first, r, a, b in zip(begun, rough.tolist(), at[:-1].tolist(), at[1:].tolist())
        ]
        if len(self.words) > HELD_WORDS:
            self._thin()
        return out


def _encoder(path: str) -> Encoder:
    """A worker's encoder, kept from task to task with the words it knows."""
    if ("encoder", path) not in worker_state:
        worker_state["encoder", path] = Encoder(path, literal=False)
    return worker_state["encoder", path]


def pack(ids: np.ndarray) -> tuple[np.ndarray, bytes, bytes]:
    """The ids by falling frequency, the control bytes and the data bytes."""
    counts = np.bincount(ids)
    ranked = np.flatnonzero(counts)
    ranked = ranked[np.lexsort((ranked, -counts[ranked]))]
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[ranked] = np.arange(len(ranked), dtype=np.uint32)
    ranks = rank_of[ids]
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    fours = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    fours[: len(extra)] = extra
    fours = fours.reshape(-1, 4)
    control = fours[:, 0] | fours[:, 1] << 2 | fours[:, 2] << 4 | fours[:, 3] << 6
    width = 2 if len(ranked) <= 1 << 16 else 4
    spread = ranks.astype(f"<u{width}").view(np.uint8).reshape(-1, width)
    data = spread[np.arange(width) <= extra[:, None]]
    return ranked.astype("<u4"), control.astype(np.uint8).tobytes(), data.tobytes()


_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


def unpack(ranked: np.ndarray, control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ids that ``pack`` was given."""
    sizes = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(sizes)
    source = np.frombuffer(data + b"\0\0\0", np.uint8)
    starts = ends - sizes
    ranks = source[starts].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(sizes > k)
        ranks[longer] |= source[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranked[ranks]


BLOCKS = (
    "shard int, block int, first_id long, doc_ids array<long>, n_tokens long, "
    "ranked binary, lengths binary, control binary, data binary"
)
_BLOCK_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("block", pa.int32()),
        ("first_id", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("n_tokens", pa.int64()),
        ("ranked", pa.binary()),
        ("lengths", pa.binary()),
        ("control", pa.binary()),
        ("data", pa.binary()),
    ]
)


def _fed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[str], int]]:
    """Runs of documents of about ``FEED_CHARS`` characters, with their shard."""
    ids, texts, held, shard = [], [], 0, 0
    for batch in batches:
        # A batch has up to 10,000 rows of any length; its texts become strings a slice at a time.
        for a, b in slices(batch.column(2)):
            part = batch.slice(a, b - a)
            for shard, doc_id, text in zip(*(part.column(k).to_pylist() for k in range(3))):
                ids.append(doc_id)
                texts.append(text)
                held += len(text)
                if held >= FEED_CHARS:
                    yield ids, texts, shard
                    ids, texts, held = [], [], 0
    if ids:
        yield ids, texts, shard


def _blocks(path: str):
    @tidy
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, held, block = [], [], 0, 0

        def close() -> pa.RecordBatch:
            ranked, control, data = pack(np.concatenate(parts))
            lengths = np.array([len(p) for p in parts], "<u4")
            row = (shard, block, ids[0], ids, int(lengths.sum()), ranked.tobytes(), lengths.tobytes(), control, data)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(row, _BLOCK_ARROW.types)], schema=_BLOCK_ARROW
            )

        for doc_ids, texts, shard in _fed(batches):
            for doc_id, tokens in zip(doc_ids, _encoder(path)(texts)):
                ids.append(doc_id)
                parts.append(tokens)
                held += len(tokens)
                if held >= BLOCK_TOKENS:
                    yield close()
                    ids, parts, held, block = [], [], 0, block + 1
        if ids:
            yield close()

    return written


def file_order(docs: DataFrame) -> list[Column]:
    """What sorts rows read from Parquet files as they were written; nothing if ``docs`` has no such places."""
    name = F.col("_metadata.file_name")
    # Names of parts beyond 99,999 are longer.
    order = [F.length(name), name, F.col("_metadata.row_index")]
    try:
        docs.select(*order)
    except AnalysisException:
        return []
    return order


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    order: Sequence[Column] = (),
) -> None:
    """Tokenise every document and write the shards to ``path``, sorted by ``order``, then ascending id."""
    given = [c.alias(f"order_{k}") for k, c in enumerate(order)]
    rows = docs.select(
        *given, F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    n = partitions(docs.sparkSession)
    keys = [F.col(c).asc_nulls_first() for c in rows.columns[:-1]]
    dealt = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys, F.xxhash64("text"))
    dealt = dealt.select(F.spark_partition_id().alias("shard"), "doc_id", "text")
    dealt.mapInArrow(_blocks(tokenizer), BLOCKS).write.parquet(path)


_DOC_ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


@tidy
def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(np.frombuffer(row["ranked"], "<u4"), row["control"], row["data"], row["n_tokens"])
            lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
            starts = np.cumsum(lengths) - lengths
            crcs = [zlib.crc32(ids[a : a + n].astype("<u4").tobytes()) for a, n in zip(starts, lengths)]
            columns = (row["doc_ids"], starts + row["before"], lengths, crcs)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _DOC_ARROW.types)], schema=_DOC_ARROW)


@tidy
def _read_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(np.frombuffer(row["ranked"], "<u4"), row["control"], row["data"], row["n_tokens"])
            bounds = np.concatenate([[0], np.cumsum(np.frombuffer(row["lengths"], "<u4"))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), lists], schema=schema)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files: id and token ids, the end id last."""
    return spark.read.parquet(path).mapInArrow(_read_ids, "doc_id long, ids array<int>")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: its first position among all ids, its ids' number and checksum."""
    blocks = spark.read.parquet(path)
    shards = blocks.groupBy("shard").agg(F.sum("n_tokens").alias("held"))
    shards = shards.select(
        F.col("shard").alias("s"), (F.sum("held").over(Window.orderBy("shard")) - F.col("held")).alias("shard_before")
    )
    sizes = blocks.select(F.col("shard").alias("s"), F.col("block").alias("b"), "n_tokens")
    in_shard = Window.partitionBy("s").orderBy("b")
    places = sizes.select("s", "b", (F.sum("n_tokens").over(in_shard) - F.col("n_tokens")).alias("block_before"))
    places = places.join(shards, "s").select("s", "b", (F.col("shard_before") + F.col("block_before")).alias("before"))
    # A row per block: written, so that the join's choice rests on the table's real size.
    places = cut(places, "token-places")
    placed = blocks.join(places, (F.col("shard") == F.col("s")) & (F.col("block") == F.col("b")))
    placed = placed.select("before", "doc_ids", "n_tokens", "ranked", "lengths", "control", "data")
    return placed.mapInArrow(_digests, "doc_id long, start long, n_tokens long, ids_crc32 long")
