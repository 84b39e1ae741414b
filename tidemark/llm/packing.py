"""Best-two-fit packing of tokenised documents into sequences of bounded length.

A bin is filled greedily, largest unpacked document first.  Then its smallest
document is taken out if two unpacked documents fill the expanded gap more tightly.

Only the *lengths* decide a packing, and there are at most ``capacity`` of them, so
the plan is made on the histogram of lengths: a bin pattern is repeated as often as
its lengths last.  The number of patterns is bounded by the capacity (about
capacity * ln(capacity)), whatever the number of documents.  Documents are matched
to the plan by their rank among the documents of equal length; ranks come from
per-task counters plus a prefix sum over tasks, so a length that a third of all
documents share is never sorted or gathered in one place.

Defined cases: null and empty texts are documents of one token (the end id); null
ids and repeated rows are packed like any other row; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Out, groups_of, id_and_text, rows_of, staged
from tidemark.llm.tokens import CACHE_BYTES, encoder

CAPACITY = 2048
END = np.array([0], "<u4").tobytes()

PIECES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("task", T.LongType()), T.StructField("nth", T.LongType()),
])
PACKED = T.StructType([*PIECES.fields[:5], T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


def best_two_fit(counts: np.ndarray, capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """Bin patterns (lengths, repeats) that use up ``counts[length]`` documents of each length."""
    left = np.array(counts, np.int64)
    index = np.arange(capacity + 1)
    plan = []
    while left.any():
        used = np.zeros(capacity + 1, np.int64)
        gap = capacity
        while gap:
            fits = np.flatnonzero(left[:gap + 1] > used[:gap + 1])
            if not len(fits):
                break
            length = int(fits[-1])
            n = min(gap // length, int(left[length] - used[length]))
            used[length] += n
            gap -= n * length
        while gap and used.sum() > 1:
            smallest = int(np.flatnonzero(used)[0])
            room = gap + smallest
            free = left - used
            last = np.maximum.accumulate(np.where(free > 0, index, 0))
            x = np.flatnonzero(free[:room] > 0)
            if not len(x):
                break
            y = last[room - x]
            alone = (y == x) & (free[x] == 1)
            y = np.where(alone, last[np.maximum(x - 1, 0)], y)
            both = np.where(y > 0, x + y, 0)
            at = int(both.argmax())
            if both[at] <= smallest:
                break
            used[smallest] -= 1
            used[x[at]] += 1
            used[y[at]] += 1
            gap = room - int(both[at])
        own = np.flatnonzero(used)
        times = int((left[own] // used[own]).min())
        left[own] -= times * used[own]
        plan.append(([int(v) for v in np.repeat(own[::-1], used[own[::-1]])], times))
    return plan


def slots(plan: list[tuple[list[int], int]], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """For each length its runs of ranks: first rank of a run, its first sequence and the offset in it."""
    seen = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for lengths, times in plan:
        offset = 0
        for length in lengths:
            rows.append((length, seen[length], sequence, offset))
            seen[length] += times
            offset += length
        sequence += times
    rows.sort()
    cols = np.array(rows, np.int64).reshape(-1, 4)
    first = np.searchsorted(cols[:, 0], np.arange(capacity + 2))
    return {"first": first, "rank": cols[:, 1].copy(), "sequence": cols[:, 2].copy(), "offset": cols[:, 3].copy()}


def _cut_task(path: str, split: str, capacity: int, cache_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path, split, cache_bytes)
        task = TaskContext.get().partitionId()
        nth = [0] * (capacity + 1)
        out = Out(pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
                             ("ids_crc32", pa.int64()), ("task", pa.int64()), ("nth", pa.int64())]))
        step = 4 * capacity
        for pending in groups_of(rows_of(batches, "id", "body"), 1):
            for (doc, _), ids in zip(pending, enc.many([b for _, b in pending])):
                ids += END
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at:at + step]
                    n = len(part) // 4
                    yield from out.add((doc, piece, at // 4, n, zlib.crc32(part), task, nth[n]))
                    nth[n] += 1
        yield from out.flush()
    return run


def _place_task(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            run_of = np.empty(len(rank), np.int64)
            for n in np.unique(length):
                at = length == n
                lo, hi = s["first"][n], s["first"][n + 1]
                run_of[at] = lo + np.searchsorted(s["rank"][lo:hi], rank[at], side="right") - 1
            cols = [b.column(b.schema.get_field_index(f.name)) for f in PACKED.fields[:5]]
            cols += [pa.array(s["sequence"][run_of] + rank - s["rank"][run_of]), pa.array(s["offset"][run_of])]
            yield pa.record_batch(cols, names=PACKED.names)
    return run


def pack(docs: DataFrame, path: str, split: str = "words", capacity: int = CAPACITY, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece of a document."""
    spark = docs.sparkSession
    pieces = staged(id_and_text(docs).mapInArrow(_cut_task(path, split, capacity, cache_bytes), PIECES), "pieces")
    per_task = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    counts = np.zeros(capacity + 1, np.int64)
    for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most `capacity` rows
        counts[r["length"]] = r["n"]
    shared = spark.sparkContext.broadcast(slots(best_two_fit(counts, capacity), capacity))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = per_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(base, ["length", "task"]).withColumn("rank", F.col("base") + F.col("nth"))
    return ranked.select(*PACKED.names[:5], "rank").mapInArrow(_place_task(shared), PACKED)
