"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# rows turned into Python objects at a time inside a task
ROWS = 256


def ship(spark: SparkSession) -> None:
    """Send this package's source to the executors' Python workers, once per Spark context."""
    sc = spark.sparkContext
    if getattr(sc, "_tidemark_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-src-"), "tidemark_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)  # Spark's own file service hands it to every executor
    sc._tidemark_shipped = True


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage with files every executor can reach, so a lost executor costs a
    re-read and not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint in the shared folder; Spark's context cleaner may drop it with the DataFrame."""
    scratch_path(df.sparkSession)  # makes sure a checkpoint folder is set (local tests)
    return df.checkpoint(eager=True)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, UTF-8 bytes of the text); extra columns, whatever their names, are dropped here."""
    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.encode(F.col(text_col), "UTF-8").alias("body"))


def rows_of(batches: Iterator[pa.RecordBatch], *cols: str, rows: int = ROWS) -> Iterator[tuple]:
    """Tuples of Python values, a few hundred rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            yield from zip(*(part.column(part.schema.get_field_index(c)).to_pylist() for c in cols))


# rows, and bytes of their texts, that an operator cuts into words at a time
BATCH_ROWS, BATCH_BYTES = 2048, 8 << 20


def groups_of(rows: Iterator[tuple], text: int) -> Iterator[list[tuple]]:
    """Rows in lists of bounded number and size; ``text`` is the place of the text in a row."""
    group, size = [], 0
    for row in rows:
        group.append(row)
        size += len(row[text] or b"")
        if len(group) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


_ACTIVE: list = []


def only_cache(cache):
    """Make ``cache`` the one word cache that this Python worker keeps; the last operator's is emptied."""
    for other in _ACTIVE:
        if other is not cache:
            other.clear()
    _ACTIVE[:] = [cache]
    return cache


class Out:
    """Collects output rows and cuts them into record batches of bounded size."""

    def __init__(self, schema: pa.Schema, rows: int = 2000, size: int = 16 << 20):
        self.schema, self.limit, self.size = schema, rows, size
        self._clear()

    def _clear(self) -> None:
        self.cols: list[list] = [[] for _ in self.schema]
        self.n, self.bytes = 0, 0

    def add(self, row: tuple, size: int = 0) -> Iterator[pa.RecordBatch]:
        for c, v in zip(self.cols, row):
            c.append(v)
        self.n += 1
        self.bytes += size
        if self.n >= self.limit or self.bytes >= self.size:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.n:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(self.cols, self.schema)], schema=self.schema)
            self._clear()
