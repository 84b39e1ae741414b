"""Content-addressed web archive.

An archive is two tables: ``payloads`` holds the bytes of every distinct payload once
under its SHA-256, ``headers`` holds each record's exact header bytes and the digest
of its payload.  Original records come back by joining the two (``records``).  The digest is
computed when a payload is stored and again when it is read; a payload that fails is
an error, not a row.

``write_files`` writes the rebuilt records as gzipped WARC 1.1 files with Spark's own
writer, at most ``FILE_RECORDS`` a file, and ``read_files`` cuts such files back into
header and block by ``Content-Length``; a block that does not match the digest its header
states, or a file that ends inside a record, is an error.  ``read_back`` gives what the
files say.

A page whose payload has at least ``MIN_REVISIT`` bytes and equals that of a page
with a smaller id is written as a ``revisit`` that refers to the smallest id;
all others are ``response`` records.

All but the cut of a file into records is built-in DataFrame functions.  A payload that a third of
all pages share is one row per task after the map-side minimum, and one response; its
revisits have empty blocks, so only narrow rows meet on its digest.  Only a payload too short to be
revisited is repeated, a few bytes each time.

Defined cases: null html is an empty payload; a null url leaves out its header line; a null
page_id never makes another page a revisit unless all pages of the payload lack an id
(then all are responses); repeated rows give a record each.  Empty tables give empty archives.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Out, rows_of, ship, staged
from tidemark.session import scratch_path

MIN_REVISIT = 100
FILE_RECORDS = 2000
END = b"\r\n\r\n"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _line(name: str, value: Column) -> Column:
    """``Name: value`` and the line end; no line for null.  Line breaks inside a value are percent-encoded."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def header_block(date: Column) -> Column:
    """Header bytes of a record from page_id, url, record_type, refers_to, payload_digest and payload_bytes."""
    revisit = F.col("record_type") == "revisit"
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    return F.encode(F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", urn(F.col("page_id"))),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Date", date),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("WARC-Refers-To", urn(F.col("refers_to"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))),
        F.lit("\r\n"),
    ), "UTF-8")


def archive(pages: DataFrame, date: str = DATE, min_revisit: int = MIN_REVISIT) -> tuple[DataFrame, DataFrame]:
    """Write ``pages`` (page_id, url, html) as an archive; returns the tables (headers, payloads) read back."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    slim = staged(pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.octet_length(payload).cast("long").alias("payload_bytes"), F.sha2(payload, 256).alias("payload_digest"),
    ), "warc_index")
    first = staged(slim.groupBy("payload_digest").agg(F.min("page_id").alias("first_id")), "warc_first")
    again = (F.col("payload_bytes") >= min_revisit) & (F.col("page_id") > F.col("first_id"))
    headers = (slim.join(first, "payload_digest")
               .withColumn("record_type", F.when(again, "revisit").otherwise("response"))
               .withColumn("refers_to", F.when(again, F.col("first_id"))))
    headers = headers.select("page_id", "payload_digest", header_block(F.lit(date)).alias("header"))
    # page_id may be null: two plain columns stand for it, so the join and the dedup share one shuffle
    key = [F.coalesce(F.col("page_id"), F.lit(0)).alias("k"), F.col("page_id").isNull().alias("k_null")]
    stored = first.withColumnRenamed("first_id", "page_id").select(*key, F.col("payload_digest").alias("digest"))
    payloads = (pages.select(F.col("page_id").cast("long").alias("page_id"), payload.alias("payload"))
                .select(*key, F.sha2("payload", 256).alias("digest"), "payload")
                .join(stored, ["k", "k_null", "digest"], "left_semi")
                .dropDuplicates(["k", "k_null", "digest"])
                .select("digest", "payload"))
    return staged(headers, "warc_headers"), staged(payloads, "warc_payloads")


def verified(payloads: DataFrame) -> DataFrame:
    """Payloads whose bytes match their digest; anything else raises."""
    same = F.sha2("payload", 256) == F.col("digest")
    broken = F.raise_error(F.concat(F.lit("payload does not match digest "), F.col("digest")))
    return payloads.select(F.when(same, F.col("digest")).otherwise(broken.cast("string")).alias("digest"), "payload")


def field(header: Column, name: str) -> Column:
    """Value of a header line, null if the record has none."""
    value = F.regexp_extract(F.decode(header, "UTF-8"), rf"(?:^|\n){name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def records(headers: DataFrame, payloads: DataFrame) -> DataFrame:
    """Original records: header fields, payload and the record's bytes as they stand in a WARC file.

    A revisit's payload is that of the record it refers to; its own block is empty.
    """
    body = F.when(field(F.col("header"), "WARC-Type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return (headers.join(verified(payloads), F.col("payload_digest") == F.col("digest"))
            .select("page_id", field(F.col("header"), "WARC-Target-URI").alias("url"),
                    field(F.col("header"), "WARC-Type").alias("record_type"), "header", "payload",
                    F.concat("header", body, F.lit(b"\r\n\r\n")).alias("record")))


def write_files(headers: DataFrame, payloads: DataFrame, path: str | None = None, file_records: int = FILE_RECORDS) -> str:
    """The records as WARC files under ``path``: header, block, two line ends.  Returns the path.

    A response's block is its payload, joined by digest; a revisit's is empty and needs no join.
    """
    spark = headers.sparkSession
    path = path or scratch_path(spark, "warc_files")
    revisit = field(F.col("header"), "WARC-Type") == "revisit"
    answers = headers.where(~revisit).join(verified(payloads), F.col("payload_digest") == F.col("digest"))
    rows = (answers.select(F.concat("header", "payload").alias("record"))
            .unionByName(headers.where(revisit).select(F.col("header").alias("record"))))
    # the text writer puts the bytes of a string and the line separator as they are
    (rows.select(F.col("record").cast("string")).write.option("lineSep", END.decode()).option("compression", "gzip")
     .option("maxRecordsPerFile", file_records).text(path))
    return path


_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n")


def cut(body: bytes) -> Iterator[tuple[bytes, bytes]]:
    """(header with its empty line, block) of each record of a WARC file's bytes."""
    at = 0
    while at < len(body):
        end = body.find(END, at)
        length = _LENGTH.search(body, at, end + 2) if end >= 0 else None
        if length is None:
            raise ValueError(f"no record header at byte {at}")
        start = end + len(END)
        stop = start + int(length[1])
        if body[stop:stop + len(END)] != END:
            raise ValueError(f"record at byte {at} does not end where its length says")
        yield body[at:start], body[start:stop]
        at = stop + len(END)


def _cut_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Out(pa.schema([("header", pa.binary()), ("block", pa.binary())]))
    for (content,) in rows_of(batches, "content", rows=1):
        for header, block in cut(gzip.decompress(content)):
            yield from out.add((header, block), len(header) + len(block))
    yield from out.flush()


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(header, block) of every record of the WARC files under ``path``."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(_cut_task, "header binary, block binary")


def read_back(found: DataFrame) -> DataFrame:
    """Per record (header, block) of an archive's files: sizes and digests of the full payload from the block of the
    record that holds it, the rest from the header bytes."""
    header = F.col("header")
    number = lambda name: F.regexp_extract(field(header, name), r"<urn:page:(-?\d+)>", 1)
    page, ref = number("WARC-Record-ID"), number("WARC-Refers-To")
    said = F.regexp_extract(field(header, "WARC-Payload-Digest"), r"^sha256:([0-9a-f]{64})$", 1)
    rows = staged(found.select(
        F.when(page != "", page).cast("long").alias("page_id"), field(header, "WARC-Type").alias("record_type"),
        F.when(ref != "", ref).cast("long").alias("refers_to"), said.alias("said"),
        F.sha2("block", 256).alias("digest"), F.octet_length("block").cast("long").alias("bytes")), "warc_read")
    broken = F.raise_error(F.concat(F.lit("block does not match digest "), F.col("said")))
    own = (rows.where("record_type = 'response'")
           .select("page_id", F.col("bytes").alias("payload_bytes"),
                   F.when(F.col("digest") == F.col("said"), F.col("digest")).otherwise(broken.cast("string")).alias("payload_digest"),
                   "record_type", "refers_to"))
    full = own.groupBy("payload_digest").agg(F.max("payload_bytes").alias("payload_bytes"))
    again = rows.where("record_type = 'revisit'").select("page_id", "said", "record_type", "refers_to")
    return own.unionByName(again.join(full, F.col("said") == F.col("payload_digest")).drop("said"))
