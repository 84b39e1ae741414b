"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores the postings of every word of the documents, once and without
looking at any test set: documents are cut into blocks (about ``BLOCK_WORDS`` words,
whole documents), and a block gives one row per term with the ascending word places at
which it occurs, and one row per document with the place where it starts.  A place
between two documents is left empty, so no phrase crosses from one to the next.  Test
sets that come later search the same table.

``search`` cuts the windows of a test set in tasks, counts the documents' occurrences of
each of their terms from the index, and sends a window only to the blocks that hold its
rarest term (a join on that term).  In a block the posting lists are shifted by the term's
offset in the window and intersected, the shortest first, until empty; what is left are
the exact phrase matches.  With ``span`` it gives proximity matches instead: places where
all terms of a window lie within a span of words in one document.

No text, window or match passes through the driver, and nothing is broadcast but what
Spark itself measures as small.  Windows are dealt into slices of about ``SLICE``, so a
group (slice, block) is bounded: one block's lists of the slice's terms are held in
memory, its windows stream past.  A hot source or a very frequent term makes more blocks
or more rows, never a larger group.

Defined cases: null or empty texts have no words; null test items and texts have no window;
repeated item rows count once by id; repeated document rows give a row each (rows that share a
doc_id pool their hits).  Null doc_ids give a row without hits.  Empty tables give empty results.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Out, id_and_text, rows_of, ship, staged

WINDOW = 10
BLOCK_WORDS = 1 << 19
SLICE = 1 << 16

_DELIMS = bytes(b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A))
_WORDS = bytes.maketrans(_DELIMS + b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b" " * len(_DELIMS) + b"abcdefghijklmnopqrstuvwxyz")

# rows of a term (doc_id and start null) and of a document (term and places null; n is its number of words)
INDEX = T.StructType([
    T.StructField("block", T.LongType()), T.StructField("term", T.BinaryType()), T.StructField("n", T.LongType()),
    T.StructField("places", T.BinaryType()), T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
])
WINDOWS = T.StructType([T.StructField("words", T.ArrayType(T.BinaryType())), T.StructField("item", T.StringType())])
FOUND = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("words", T.ArrayType(T.IntegerType())),
    T.StructField("windows", T.ArrayType(T.LongType())),
])


def words_of(body: bytes | None) -> list[bytes]:
    """Words of a text: A-Z lowered, runs of digits, letters and non-ASCII characters."""
    return body.translate(_WORDS).split() if body else []


def windows_of(words: list[bytes], size: int = WINDOW) -> list[tuple[bytes, ...]]:
    if not words:
        return []
    return [tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


class BlockWriter:
    """Words of some documents on their way into one block of the index."""

    SCHEMA = pa.schema([("block", pa.int64()), ("term", pa.binary()), ("n", pa.int64()), ("places", pa.binary()),
                        ("doc_id", pa.int64()), ("start", pa.int64())])

    def __init__(self, number: int):
        self.number, self.at = number, 0
        self.docs: list[tuple] = []
        self.terms: defaultdict[bytes, int] = defaultdict()
        self.terms.default_factory = self.terms.__len__  # an unseen word gets the next number
        self.seen: list[np.ndarray] = []

    def add(self, doc: int | None, words: list[bytes]) -> None:
        self.docs.append((doc, self.at, len(words)))
        self.seen.append(np.fromiter(map(self.terms.__getitem__, words), np.int32, len(words)))
        self.at += len(words) + 1

    def rows(self) -> Iterator[pa.RecordBatch]:
        ids, starts, counts = zip(*self.docs)
        yield self._batch(len(ids), n=pa.array(counts, pa.int64()), doc_id=pa.array(ids, pa.int64()),
                          start=pa.array(starts, pa.int64()))
        if not self.terms:
            return
        of = np.concatenate(self.seen)
        places = np.concatenate([np.arange(s, s + n, dtype=np.int32) for s, n in zip(starts, counts)])
        freq = np.bincount(of, minlength=len(self.terms))
        ends = np.concatenate([[0], np.cumsum(freq)])
        places = places[np.argsort(of, kind="stable")]
        terms, step = list(self.terms), 1 << 15
        for lo in range(0, len(terms), step):
            hi = min(lo + step, len(terms))
            part = places[ends[lo]:ends[hi]]
            cuts = pa.array(4 * (ends[lo:hi + 1] - ends[lo]), pa.int64()).buffers()[1]
            lists = pa.Array.from_buffers(pa.large_binary(), hi - lo, [None, cuts, pa.py_buffer(part.tobytes())])
            yield self._batch(hi - lo, term=pa.array(terms[lo:hi], pa.binary()), n=pa.array(freq[lo:hi], pa.int64()),
                              places=lists.cast(pa.binary()))

    def _batch(self, size: int, /, **cols: pa.Array) -> pa.RecordBatch:
        cols["block"] = pa.array(np.full(size, self.number, np.int64))
        return pa.record_batch([cols.get(f.name, pa.nulls(size, f.type)) for f in self.SCHEMA], schema=self.SCHEMA)


def _index_task(block_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        block = BlockWriter(number)
        for doc, body in rows_of(batches, "id", "body"):
            block.add(doc, words_of(body))
            if block.at >= block_words:
                yield from block.rows()
                number += 1
                block = BlockWriter(number)
        if block.docs:
            yield from block.rows()
    return run


def build_index(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The positional inverted index of all words of the documents, written as a table; any number of test sets may search it."""
    return staged(id_and_text(docs).mapInArrow(_index_task(block_words), INDEX), "positional_index")


def _window_task(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Out(pa.schema([("words", pa.list_(pa.binary())), ("item", pa.string())]))
        for item, body in rows_of(batches, "item", "body", rows=16):
            for w in windows_of(words_of(body), size):
                yield from out.add((w, item), sum(map(len, w)))
        yield from out.flush()
    return run


def windows_by_item(benchmark: DataFrame, size: int = WINDOW, item_col: str = "item_id",
                 text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Distinct windows (window_id, words) of a test set, and the items that hold them (window_id, item)."""
    ship(benchmark.sparkSession)
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), F.encode(F.col(text_col), "UTF-8").alias("body"))
    held = rows.where("item IS NOT NULL AND body IS NOT NULL").mapInArrow(_window_task(size), WINDOWS).distinct()
    # the numbers hold once they are written
    windows = staged(held.select("words").distinct().select(F.monotonically_increasing_id().alias("window_id"), "words"),
                     "test_windows")
    return windows, staged(held.join(windows, "words").select("window_id", "item"), "test_items")


class Block:
    """Posting lists of one block of the index, for the terms of some windows."""

    def __init__(self):
        self.docs: list[int | None] = []
        self.starts: list[int] = []
        self.counts: list[int] = []
        self.lists: dict[bytes, np.ndarray] = {}
        self.first = self.size = None
        self.hit: dict[int, tuple[list, list]] = {}

    def doc_at(self, places: np.ndarray) -> np.ndarray:
        if self.first is None:
            self.first, self.size = np.array(self.starts, np.int64), np.array(self.counts, np.int64)
        return np.searchsorted(self.first, places, side="right") - 1

    def phrase(self, lists: list[np.ndarray], order: list[int]) -> np.ndarray:
        """Start places: offset-adjusted lists intersected from the rarest term on."""
        found = lists[order[0]] - order[0]
        for j in order[1:]:
            other = lists[j]
            at = np.searchsorted(other, found + j)
            found = found[other[np.minimum(at, len(other) - 1)] == found + j]
            if not len(found):
                break
        return found

    def near(self, lists: list[np.ndarray], order: list[int], span: int) -> np.ndarray:
        """Places of the rarest term with every other term at most ``span`` words away in its document."""
        found = lists[order[0]].astype(np.int64)
        for j in order[1:]:
            other, doc = lists[j], self.doc_at(found)
            low = np.maximum(found - span, self.first[doc])
            high = np.minimum(found + span, self.first[doc] + self.size[doc] - 1)
            at = np.searchsorted(other, low)
            found = found[(at < len(other)) & (other[np.minimum(at, len(other) - 1)] <= high)]
            if not len(found):
                break
        return found

    def seek(self, window: int, words: list[bytes], span: int | None) -> None:
        lists = [self.lists.get(w) for w in words]
        if any(x is None for x in lists):
            return
        order = sorted(range(len(words)), key=lambda j: len(lists[j]))
        found = self.phrase(lists, order) if span is None else self.near(lists, order, span)
        if not len(found):
            return
        docs = self.doc_at(found)
        for d in np.unique(docs):
            own, held = self.hit.setdefault(int(d), ([], []))
            start = found[docs == d] - self.first[d]
            own.append((start[:, None] + np.arange(len(words) if span is None else 1)).ravel())
            held.append(window)

    def rows(self, out: Out) -> Iterator[pa.RecordBatch]:
        for d, (own, held) in self.hit.items():
            if self.docs[d] is not None:
                words = np.unique(np.concatenate(own)).astype(np.int32)
                yield from out.add((self.docs[d], words, held), 4 * len(words) + 8 * len(held))


def _match_task(span: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Out(pa.schema([("doc_id", pa.int64()), ("words", pa.list_(pa.int32())), ("windows", pa.list_(pa.int64()))]))
        key, block = None, Block()
        cols = ("slice", "block", "kind", "term", "n", "places", "doc_id", "start", "window_id", "words")
        for part, number, kind, term, n, places, doc, start, window, words in rows_of(batches, *cols):
            if (part, number) != key:
                yield from block.rows(out)
                key, block = (part, number), Block()
            if kind == 0:
                block.docs.append(doc)
                block.starts.append(start)
                block.counts.append(n)
            elif kind == 1:
                block.lists[term] = np.frombuffer(places, np.int32)
            else:
                block.seek(window, words, span)
        yield from block.rows(out)
        yield from out.flush()
    return run


def search(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, span: int | None = None,
           item_col: str = "item_id", slice_windows: int = SLICE) -> DataFrame:
    """(doc_id, words, items): per document with matches the hit word places and the items of the test set.

    ``span=None`` gives exact phrases, a number proximity matches within so many words.
    """
    windows, items = windows_by_item(benchmark, window, item_col)
    slices = windows.count() // slice_windows + 1
    windows = windows.withColumn("slice", F.pmod(F.xxhash64("words"), F.lit(slices)))
    terms = windows.select("slice", "window_id", F.explode(F.array_distinct("words")).alias("term"))
    vocabulary = staged(terms.select("slice", "term").distinct(), "test_terms")
    postings = staged(index.where("term IS NOT NULL").join(vocabulary, "term").select("slice", "block", "term", "n", "places"),
                      "test_postings")
    # a window all of whose terms occur somewhere, and the rarest of them
    total = postings.groupBy("slice", "term").agg(F.sum("n").alias("total"))
    rarest = (terms.join(total, ["slice", "term"]).groupBy("slice", "window_id")
              .agg(F.count("*").alias("known"), F.min(F.struct("total", "term")).alias("rarest")))
    wanted = (windows.join(rarest, ["slice", "window_id"]).where(F.col("known") == F.size(F.array_distinct("words")))
              .select("slice", "window_id", "words", F.col("rarest.term").alias("term")))
    pairs = staged(wanted.join(postings.select("slice", "block", "term"), ["slice", "term"]).drop("term"), "windows_by_block")
    groups = pairs.select("slice", "block").distinct()
    place = postings.join(groups, ["slice", "block"], "left_semi").withColumn("kind", F.lit(1))
    docs = (index.where("term IS NULL").join(groups, "block")
            .select("slice", "block", F.lit(0).alias("kind"), "n", "doc_id", "start"))
    rows = (docs.unionByName(place, allowMissingColumns=True)
            .unionByName(pairs.withColumn("kind", F.lit(2)), allowMissingColumns=True)
            .repartition("slice", "block").sortWithinPartitions("slice", "block", "kind", "start"))
    found = staged(rows.mapInArrow(_match_task(span), FOUND), "window_matches")
    hit = found.groupBy("doc_id").agg(F.array_distinct(F.flatten(F.collect_list("words"))).alias("words"))
    held = (found.select("doc_id", F.explode("windows").alias("window_id")).join(items, "window_id")
            .groupBy("doc_id").agg(F.array_sort(F.collect_set("item")).alias("items")))
    return hit.join(held, "doc_id")


def find(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, span: int | None = None,
         item_col: str = "item_id") -> DataFrame:
    """``search`` over an index of ``docs`` built for it."""
    return search(build_index(docs), benchmark, window, span, item_col)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id") -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated, all from the index."""
    index = build_index(docs)
    found = search(index, benchmark, window, item_col=item_col).select(
        F.col("doc_id").alias("m_doc"), F.size("words").cast("long").alias("hits"), "items")
    base = index.where("term IS NULL").select("doc_id", F.col("n").alias("n_words"))
    return (base.join(found, base.doc_id == found.m_doc, "left")
            .select("doc_id", "n_words", F.coalesce("hits", F.lit(0).cast("long")).alias("n_hit"),
                    F.when(F.col("items").isNull(), 0).otherwise(F.size("items")).cast("long").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                    F.coalesce(F.col("hits") > 0, F.lit(False)).alias("contaminated")))
