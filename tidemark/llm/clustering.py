"""Centroid clustering (Lloyd rounds) over integer vectors by scalar lookup tables.

A component x becomes the integer ``floor(scale * x)``.  In a round every task cuts
its vectors into batches; for a batch and a dimension it tabulates the squared
difference of each *occurring* integer value to each centroid's component, so a
distance is a sum of table rows gathered by value: no product is taken per vector.

Plan: the integer vectors are written once (``staged``).  A round is one pass over
that table with the centroids (k x dimensions numbers) in the task's closure; a task
hands on one row per cluster and dimension, Spark adds these up, and the driver reads
k x dimensions sums.  No vector is shuffled.  A lost executor costs a re-read of the
written table.  The driver holds nothing that grows with the input.

Exactness: tables are int64 while all values stay within 2^27, which bounds a sum of
64 squares by 2^62; beyond that the same gathers run over Python integers.  Sums are
decimals of 38 digits, means are floored integer quotients.

Defined cases: vectors that are null, of another width, or hold null or non-finite
components take no part; rows that share an id are vectors of their own; an id may be
null (it starts no centroid while others are left).  First centroids with equal ids
are taken in order of their components.  Fewer kept vectors than centroids: every
vector starts one.  An empty table gives an empty result.  A component whose integer
does not fit in 62 bits, or a distance or inertia that does not fit in a long, is an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ship, staged

SMALL = 2**27          # int64 tables up to here
LARGEST = float(2**62)  # integers up to here
_SUMS = pa.schema([("cluster", pa.int32()), ("dim", pa.int32()), ("n", pa.int64()), ("total", pa.decimal128(38, 0))])
_NEAREST = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def whole_vectors(vectors: DataFrame, dims: int, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, vals array<long>) of the vectors that take part."""
    v = F.col(vec_col)
    fit = (F.size(v) == dims) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))

    def whole(x: Column) -> Column:
        y = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(y) <= LARGEST, F.floor(y).cast("long")).otherwise(
            F.raise_error(F.lit("component too large for an integer of 62 bits")).cast("long"))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.when(fit, v).alias("_v")).where("_v IS NOT NULL")
            .select("vec_id", F.transform("_v", whole).alias("vals")))


def first_centroids(vectors: DataFrame, k: int, salt: str) -> list[list[int]]:
    """The k vectors with the smallest hex sha256 of ``<salt>:<vec_id>``, in that order."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(key.alias("_key"), "vals").orderBy(F.asc_nulls_last("_key"), "vals").limit(k)
    return [list(r["vals"]) for r in first.collect()]


def _occurring(col: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a column and each row's place among them."""
    low, high = int(col.min()), int(col.max())
    if high - low > 8 * len(col):
        return np.unique(col, return_inverse=True)
    seen = np.zeros(high - low + 1, bool)
    seen[col - low] = True
    return np.flatnonzero(seen) + low, (np.cumsum(seen) - 1)[col - low]


def nearest(m: np.ndarray, centroids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(cluster, squared distance) of each row of an int64 matrix; ties to the smaller number."""
    biggest = max(int(np.abs(m).max(initial=0)), max((abs(x) for c in centroids for x in c), default=0))
    kind = np.int64 if biggest <= SMALL else object
    c = np.array(centroids, kind)
    total = np.zeros((len(m), len(c)), kind)
    for d in range(m.shape[1]):
        values, place = _occurring(m[:, d])
        table = (values.astype(kind)[:, None] - c[None, :, d]) ** 2
        total += table[place]
    cluster = total.argmin(axis=1)
    return cluster.astype(np.int32), total[np.arange(len(m)), cluster]


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.Array, np.ndarray]]:
    for b in batches:
        if b.num_rows:
            flat = b.column(b.schema.get_field_index("vals")).flatten().to_numpy(zero_copy_only=False)
            yield b.column(b.schema.get_field_index("vec_id")), flat.reshape(b.num_rows, dims)


def _sum_task(centroids: list[list[int]], dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [[0] * dims for _ in centroids]
        counts = [0] * len(centroids)
        for _, m in _matrices(batches, dims):
            cluster, _ = nearest(m, centroids)
            wide = m if np.abs(m).max() < 2**40 else m.astype(object)
            order = np.argsort(cluster, kind="stable")
            found, start = np.unique(cluster[order], return_index=True)
            parts = np.add.reduceat(wide[order], start, axis=0)
            for c, part, n in zip(found.tolist(), parts.tolist(), np.diff([*start, len(order)]).tolist()):
                sums[c] = [a + b for a, b in zip(sums[c], part)]
                counts[c] += n
        rows = [(c, d, counts[c], Decimal(sums[c][d])) for c in range(len(centroids)) if counts[c] for d in range(dims)]
        if rows:
            yield pa.record_batch([pa.array(x, f.type) for x, f in zip(zip(*rows), _SUMS)], schema=_SUMS)
    return run


def _nearest_task(centroids: list[list[int]], dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, m in _matrices(batches, dims):
            cluster, distance = nearest(m, centroids)
            if distance.dtype == object and max(distance.tolist()) >= 2**63:
                raise OverflowError("a squared distance does not fit in a long")
            yield pa.record_batch([ids, pa.array(cluster), pa.array(distance.tolist(), pa.int64())], schema=_NEAREST)
    return run


def lloyd(whole: DataFrame, centroids: list[list[int]], rounds: int, dims: int) -> list[list[int]]:
    """Centroids after the rounds; ``whole`` is a written table of (vec_id, vals)."""
    sums = "cluster int, dim int, n long, total decimal(38,0)"
    for _ in range(rounds):
        added = (whole.mapInArrow(_sum_task(centroids, dims), sums).groupBy("cluster", "dim")
                 .agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
        centroids = [list(c) for c in centroids]
        for r in added.collect():  # clusters x dimensions rows
            centroids[r["cluster"]][r["dim"]] = int(r["total"]) // r["n"]
    return centroids


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, salt: str = "2",
            id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per kept vector."""
    spark = vectors.sparkSession
    ship(spark)
    whole = staged(whole_vectors(vectors, dims, scale, id_col, vec_col), "cluster_vectors")
    centroids = lloyd(whole, first_centroids(whole, k, salt), rounds, dims)
    if centroids:
        found = whole.mapInArrow(_nearest_task(centroids, dims), "vec_id long, cluster int, distance long")
        found = staged(found, "cluster_assigned")
    else:
        found = whole.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    spread = {r["cluster"]: int(r["s"]) for r in  # one row per cluster
              found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    if sum(spread.values()) >= 2**63:
        raise OverflowError("the inertia does not fit in a long")
    rows = [(c, spread.get(c, 0), sum(spread.values()), hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest())
            for c, centroid in enumerate(centroids)]
    per = spark.createDataFrame(rows, T.StructType([
        T.StructField("cluster", T.IntegerType()), T.StructField("cluster_inertia", T.LongType()),
        T.StructField("inertia", T.LongType()), T.StructField("centroid_sha256", T.StringType())]))
    return found.join(F.broadcast(per), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
