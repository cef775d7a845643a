"""Web archives: written as WARC 1.1 records, read back by verifying the chain of record boundaries.

Writing.  Spark's text writer with the record terminator as line separator makes plain ``.warc``
byte streams.  Of the pages with equal payloads the one with the largest id is a ``response``, the
others are ``revisit`` records that refer to it and carry no payload.

Reading.  Files are read in splits with the version line as separator, so a split's task meets every
place where the magic stands, also inside payloads.  From each such candidate's own header it emits
the offset of the record's successor.  Pointer jumping over these pairs from each file's start
(offset 0) keeps the reachable candidates only; a magic inside a payload is never reached, and the
text after it goes back to the record that holds it.  Offsets inside a file are running sums over
the file's pieces: the pieces of a split first, then the splits.  The pieces of a record that holds
the magic are fetched by their SHA-256, so a second scan may split the files in any other way; a
piece that is not found again raises an error.

Record ids are unique: ``urn:page:<page id>:<digest>`` for a payload's response, with a random
suffix for all other records, which none refers to.

Cases: a null payload is written as empty; an unprintable url is percent-encoded, a missing one is
the page's own urn; a page id may be null (such a page counts as smaller than any other); of
repeated rows with equal id and payload exactly one is the response.  An empty table gives no
records.  A chain that does not end at its file's end raises an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from fieldmark.llm.common import cut

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
#: Fixed value: what a revisit of an equal payload names as its profile.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: When the pages were captured, if the caller does not say; a constant, so that reruns write the same dates.
DATE = "2026-01-01T00:00:00Z"
#: Records of a file at most, which bounds what one file's chain holds.
FILE_RECORDS = 20_000

#: The digits of base 32 as ``conv`` writes them, and as RFC 4648 does.
_CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
_RFC_DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(content: Column) -> Column:
    """SHA-1 in bare upper-case base 32."""
    digest = F.sha1(content)
    parts = (F.lpad(F.conv(F.substring(digest, k, 10), 16, 32), 8, "0") for k in (1, 11, 21, 31))
    return F.translate(F.concat(*parts), _CONV_DIGITS, _RFC_DIGITS)


def _roles(pages: DataFrame, least: int) -> DataFrame:
    """The pages with ``record_type`` and ``refers_to``.

    Digests and ids alone are aggregated; a row per payload that stands more than once is joined
    back.  Where that table is small Spark keeps the payloads where they are, else it deals them by
    digest and splits a large group of copies.
    """
    sizes = pages.where(F.col("size") >= least).groupBy("digest", "key").agg(F.count("*").alias("n"))
    copies = sizes.groupBy(F.col("digest").alias("d")).agg(
        F.max(F.struct("key", "n")).alias("best"), F.sum("n").alias("n")
    )
    copies = copies.where("n > 1").select("d", F.col("best.key").alias("best"), F.col("best.n").alias("n_best"))
    copies = cut(copies, "warc-copies")
    rows = pages.join(copies, (F.col("digest") == F.col("d")) & (F.col("size") >= least), "left")
    revisits = F.col("key") != F.col("best")
    if not copies.where("n_best > 1").isEmpty():
        # The best id's page itself is repeated: one of its rows is the response.
        several = F.coalesce((F.col("n_best") > 1) & (F.col("key") == F.col("best")), F.lit(False))
        copy = F.row_number().over(Window.partitionBy("key", "digest").orderBy("url"))
        rare = rows.where(several).withColumn("copy", copy)
        rows = rows.where(~several).withColumn("copy", F.lit(1)).unionByName(rare)
        revisits |= F.col("copy") > 1
    revisits = F.coalesce(revisits, F.lit(False))
    return rows.select(
        "page_id",
        "url",
        "html",
        "digest",
        "size",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits & (F.col("best") != _NO_ID), F.col("best")).alias("refers_to"),
    )


_NO_ID = -(2**63)


def _records(rows: DataFrame, date: str, least: int) -> DataFrame:
    """The records' text, without the terminator that the writer adds."""
    plain = F.when(F.col("url").rlike(r"^[\x21-\x7E]+$"), F.col("url")).otherwise(F.url_encode("url"))
    is_response = F.col("record_type") == "response"

    def urn(page: Column) -> Column:
        return F.concat(F.lit("urn:page:"), F.coalesce(page.cast("string"), F.lit("")))

    def record(page: Column) -> Column:
        return F.concat(urn(page), F.lit(":"), F.col("digest"))

    # Others refer to a response only where payloads are written once.
    suffix = F.when(is_response & (F.col("size") >= least), "").otherwise(F.concat(F.lit(":"), F.uuid()))
    uri = F.coalesce(F.when(F.length("url") > 0, plain), urn(F.col("page_id")))
    refers = F.concat(F.lit("<"), record(F.col("refers_to")), F.lit(">"))
    block = F.concat(F.lit(HTTP), F.when(is_response, F.col("html")).otherwise(""))

    def line(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))

    head = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<"), record(F.col("page_id")), suffix, F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("WARC-Refers-To", F.when(~is_response, refers)),
        line("WARC-Profile", F.when(~is_response, PROFILE)),
        line("X-Payload-Length", F.col("size").cast("string")),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write_archives(pages: DataFrame, path: str, least: int = 0, date: str = DATE) -> None:
    """Write a record per page, captured at ``date``; payloads of at least ``least`` bytes are written once."""
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("page_id").cast("long"), F.lit(_NO_ID)).alias("key"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        sha1_base32(html).alias("digest"),
        F.octet_length(html).cast("long").alias("size"),
    )
    writer = _records(_roles(rows, least), date, least).write.option("lineSep", END).option("maxRecordsPerFile", FILE_RECORDS)
    writer.text(path)


_PIECE = (
    "file string, split long, nth long, size long, head long, length long, record_type string, page_id long, "
    "refers_to long, payload_bytes long, payload_digest string, content binary"
)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What stands between two places of the magic, of all files, in splits."""
    text = spark.read.option("lineSep", MAGIC).text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("nth"),
        "value",
    )


def _content(value: Column) -> Column:
    return F.unhex(F.sha2(value.cast("binary"), 256))


def _parsed(pieces: DataFrame) -> DataFrame:
    """Header fields of each candidate and, if the whole record is there, its payload's length and digest."""
    head_end = F.locate("\r\n\r\n", F.col("value"))
    rows = pieces.select(
        "*",
        F.octet_length("value").cast("long").alias("size"),
        F.when(head_end > 0, F.expr("substring(value, 1, locate('\\r\\n\\r\\n', value) + 3)")).alias("fields"),
    )

    def field(name: str, pattern: str, kind: str = "long") -> Column:
        found = F.regexp_extract("fields", rf"(?:^|\n){name}: {pattern}\r\n", 1)
        return F.when(F.length(found) > 0, found).cast(kind)

    head = F.octet_length("fields").cast("long")
    rows = rows.select(
        "*",
        head.alias("head"),
        field("Content-Length", "([0-9]{1,18})").alias("length"),
        field("WARC-Type", "([a-z]+)", "string").alias("record_type"),
        field("WARC-Record-ID", "<urn:page:(-?[0-9]{1,19})[:>][^\\r]*").alias("page_id"),
        field("WARC-Refers-To", "<urn:page:(-?[0-9]{1,19})[:>][^\\r]*").alias("refers_to"),
        field("X-Payload-Length", "([0-9]{1,18})").alias("said_bytes"),
        field("WARC-Payload-Digest", "sha1:([A-Z2-7]+)", "string").alias("said_digest"),
        F.expr("locate('\\r\\n\\r\\n', value, length(fields) + 1) + 3").cast("long").alias("payload_at"),
    )
    revisit = F.col("record_type") == "revisit"
    whole = F.col("size") >= F.col("head") + F.col("length")
    n_bytes = F.col("head") + F.col("length") - F.col("payload_at")
    payload = F.expr("substring(cast(value AS binary), int(payload_at + 1), int(head + length - payload_at))")
    return rows.select(
        "file",
        "split",
        "nth",
        "size",
        "head",
        "length",
        "record_type",
        "page_id",
        "refers_to",
        F.when(revisit, F.col("said_bytes")).when(whole, n_bytes).alias("payload_bytes"),
        F.when(revisit, F.col("said_digest")).when(whole, sha1_base32(payload)).alias("payload_digest"),
        _content(F.col("value")).alias("content"),
    )


def _chain(pieces: pa.Table) -> pa.Table:
    """The pieces of a file with the offset of the record that each belongs to, and whether it begins it."""
    pieces = pieces.sort_by([("split", "ascending"), ("nth", "ascending")])
    through = np.cumsum(pieces.column("size").to_numpy() + len(MAGIC)) - len(MAGIC)
    # The first piece is what stands before the first magic; each other one begins where the one before ends.
    candidates = pieces.slice(1)
    offsets, size, n = through[:-1], through[-1], len(candidates)
    if through[0] or not n:
        raise ValueError(f"{pieces.column('file')[0].as_py()}: no record at the start of the file")
    head = candidates.column("head").fill_null(0).to_numpy()
    length = candidates.column("length").fill_null(-1).to_numpy()
    follows = np.where((head > 0) & (length >= 0), offsets + len(MAGIC) + head + length + len(END), -1)
    # Place n stands for the end of the file, n + 1 for an offset that is no candidate's.
    place = np.minimum(np.searchsorted(offsets, follows), n - 1)
    jump = np.where(offsets[place] == follows, place, np.where(follows == size, n, n + 1))
    jump = np.concatenate([jump, [n, n + 1]])
    reached = np.zeros(n + 2, bool)
    reached[0] = True
    # Each round doubles the jumps, and all that is reached so far reaches as far again.
    for _ in range(int(n + 1).bit_length() + 1):
        reached[jump[np.flatnonzero(reached)]] = True
        jump = jump[jump]
    if not reached[n] or reached[n + 1]:
        raise ValueError(f"{pieces.column('file')[0].as_py()}: the chain of records breaks")
    holder = np.maximum.accumulate(np.where(reached[:n], np.arange(n), 0))
    counts = np.bincount(holder, minlength=n)
    candidates = candidates.append_column("record", pa.array(offsets[holder]))
    candidates = candidates.append_column("begins", pa.array(reached[:n]))
    return candidates.append_column("n_pieces", pa.array(counts[holder]))


_RECORD = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per record below ``path``: page id, length and digest of the payload, type, reference.

    Lengths and digests of responses come from the bytes that were read.  Only headers and digests are
    gathered by file; a file has a bounded number of records.
    """
    parsed = _parsed(_pieces(spark, path))
    chained = parsed.groupBy("file").applyInArrow(_chain, f"{_PIECE}, record long, begins boolean, n_pieces long")
    chained = cut(chained, "warc-chain")
    whole = chained.where("begins AND n_pieces = 1").select(*_RECORD)
    split_up = chained.where("n_pieces > 1").select("file", "split", "nth", "record", "content")
    if split_up.isEmpty():
        return whole
    # Records that hold the magic themselves: the contents of their pieces are read again and put together.
    wanted = split_up.select(F.col("content").alias("c")).distinct()
    values = _pieces(spark, path).select(_content(F.col("value")).alias("c"), "value")
    values = values.join(wanted, "c", "left_semi").groupBy("c").agg(F.first("value").alias("value"))
    pieces = split_up.join(values, F.col("content") == F.col("c"), "left")
    lost = F.raise_error(F.concat(F.col("file"), F.lit(": a piece of a record was not found again")))
    value = F.when(F.col("value").isNull(), lost).otherwise(F.col("value"))
    listed = F.array_sort(F.collect_list(F.struct("split", "nth", value.alias("value"))))
    joined = pieces.groupBy("file", "record").agg(listed.alias("parts"))
    value = F.array_join(F.transform("parts", lambda p: p["value"]), MAGIC)
    joined = joined.select("file", F.lit(0).alias("split"), F.lit(0).alias("nth"), value.alias("value"))
    return whole.unionByName(_parsed(joined).select(*_RECORD))
