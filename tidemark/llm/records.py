"""Token sequences in length-delimited binary records with a separate offset index.

A file is a run of frames::

    uint64  length of the payload            little-endian
    uint32  masked CRC-32 of the 8 length bytes
    bytes   payload
    uint32  masked CRC-32 of the payload

Masking rotates the checksum right by 15 bits and adds 0xA282EAD8, so that a checksum
stored inside checksummed data does not weaken it.  A payload is an int64 document
id (with a flag byte for null), the id width (2 or 4 bytes) and the token ids.

Documents are range-partitioned and sorted by id, so files in order of their number
hold ascending ids.  A task writes one file, under a name no other attempt uses, to
the shared folder; the index rows it returns are committed by Spark, so a file of a
failed or repeated attempt is never referred to.  The index (document, file, byte
offset) serves reads in any order.

Files go through pyarrow's file systems, so the folder may be any URI that these and
Spark both reach.

Defined cases: null and empty texts are sequences of the end id alone; null ids sort
first; rows with equal ids are ordered by text and each is a record; an empty table writes no file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Out, groups_of, id_and_text, rows_of, staged
from tidemark.llm.tokens import encoder
from tidemark.session import scratch_path

END = np.array([0], "<u4").tobytes()
INDEX = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("shard", T.LongType()), T.StructField("file", T.StringType()),
    T.StructField("at", T.LongType()), T.StructField("n_tokens", T.LongType()),
])
READ = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "start", "n_tokens", "ids_crc32")])


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def payload_of(doc: int | None, ids: bytes) -> bytes:
    """Document id, width and token ids (given as little-endian uint32)."""
    values = np.frombuffer(ids, "<u4")
    width = 2 if not len(values) or int(values.max()) < 1 << 16 else 4
    return struct.pack("<?qB", doc is None, doc or 0, width) + (values.astype("<u2").tobytes() if width == 2 else ids)


def parse_payload(payload: bytes) -> tuple[int | None, bytes]:
    null, doc, width = struct.unpack_from("<?qB", payload)
    ids = payload[struct.calcsize("<?qB"):]
    return None if null else doc, np.frombuffer(ids, "<u2").astype("<u4").tobytes() if width == 2 else ids


def read_frame(stream) -> bytes | None:
    """The next payload, None at the end of the file; a damaged or cut frame raises."""
    head = stream.read(12)
    if not head:
        return None
    if len(head) < 12 or masked(head[:8]) != struct.unpack("<I", head[8:])[0]:
        raise ValueError("damaged record length")
    n = struct.unpack("<Q", head[:8])[0]
    body = stream.read(n + 4)
    if len(body) < n + 4 or masked(body[:n]) != struct.unpack("<I", body[n:])[0]:
        raise ValueError("damaged record payload")
    return body[:n]


def _open(path: str):
    return fs.FileSystem.from_uri(path)


def _write_task(path: str, split: str, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, split)
        shard = TaskContext.get().partitionId()
        name = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.rec"
        out = Out(pa.schema([("doc_id", pa.int64()), ("shard", pa.int64()), ("file", pa.string()), ("at", pa.int64()), ("n_tokens", pa.int64())]))
        sink, at = None, 0

        for pending in groups_of(rows_of(batches, "id", "body"), 1):
            if sink is None:
                system, _ = _open(folder)
                system.create_dir(_open(folder)[1], recursive=True)
                sink = system.open_output_stream(_open(name)[1])
            frames = []
            for (doc, _), ids in zip(pending, enc.many([b for _, b in pending])):
                ids += END
                frames.append(frame(payload_of(doc, ids)))
                yield from out.add((doc, shard, name, at, len(ids) // 4))
                at += len(frames[-1])
            sink.write(b"".join(frames))
        if sink is not None:
            sink.close()
        yield from out.flush()
    return run


def write_records(docs: DataFrame, path: str, split: str = "spaces", folder: str | None = None) -> DataFrame:
    """Encode and write ``docs`` in ascending id order; returns the offset index (doc_id, shard, file, at, n_tokens)."""
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "records")
    ordered = id_and_text(docs).repartitionByRange("id").sortWithinPartitions("id", "body")
    return staged(ordered.mapInArrow(_write_task(path, split, folder), INDEX), "record_index")


def _read_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Out(pa.schema([(n, pa.int64()) for n in READ.names]))
    for file, base in rows_of(batches, "file", "base"):
        system, place = _open(file)
        with system.open_input_stream(place) as stream:
            while (payload := read_frame(stream)) is not None:
                doc, ids = parse_payload(payload)
                yield from out.add((doc, base, len(ids) // 4, zlib.crc32(ids)))
                base += len(ids) // 4
    yield from out.flush()


def read_all(index: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, from the files that the index names.

    ``start`` counts the ids of all documents before; the prefix sum runs over one row per file.
    """
    files = index.groupBy("shard", "file").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    files = staged(files.select("file", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base")), "record_files")
    return files.repartition(max(1, files.count()), "file").mapInArrow(_read_task, READ)


def _fetch_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Out(pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int64()))]))
    name, stream = None, None
    for file, at in rows_of(batches, "file", "at"):
        if file != name:
            if stream:
                stream.close()
            system, place = _open(file)
            name, stream = file, system.open_input_file(place)
        stream.seek(at)
        doc, ids = parse_payload(read_frame(stream))
        yield from out.add((doc, np.frombuffer(ids, "<u4")), len(ids))
    if stream:
        stream.close()
    yield from out.flush()


def fetch(index: DataFrame) -> DataFrame:
    """(doc_id, ids) of the index rows given, in any order: the shuffled read."""
    return index.mapInArrow(_fetch_task, "doc_id long, ids array<long>")
