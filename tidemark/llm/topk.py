"""Exact top-k search by block-at-a-time pruning (inner product over integer impacts).

Every component of a vector is a *term* whose impact is ``floor(scale * x)``.
Vectors are cut into document-range blocks: runs of ``BLOCK`` consecutive ids.  A
block keeps a forward index (its impact matrix) and, per term, the largest and the
smallest impact.  For a query the sum over terms of ``max(q*largest, q*smallest)``
bounds every score in the block.  Blocks are visited in descending order of that
bound and scored through the forward index until the bound falls below the
query's k-th score so far.  A bound *equal* to the k-th score is still visited: it
may hold a tie with a smaller id.

Plan: ids are range-partitioned into groups of about ``GROUP`` vectors.  Pass 1
searches each query in its own group only; that gives a valid lower bound of its
final k-th score.  The same bounds then choose groups before anything is sent: ranges of a group
keep their extremes, ``SHELF`` groups make a shelf, and a task holds one shelf's extremes
while the queries stream past (stated queries against all rows, in blocks; no cross
join).  Pass 2 sends a query only to the groups whose bound reaches its k-th score and keeps
at most k rows per query and group; a per-query window merges them.  A task holds one
group's matrix at a time and streams the queries past it.

Defined cases: vectors that are null, or hold null or non-finite components, take
no part.  Rows that share an id are one vector (the smallest in array order).
Vectors of unequal length are compared over the shorter one.  Null ids are left out.
An empty table gives an empty result.  Impacts are exact: scores are taken in doubles while
every partial sum is below 2^53, in int64 below 2^63, else in Python integers.  An impact
beyond 62 bits, or a score that does not fit in a long, is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ship, staged

BLOCK = 64
GROUP = 8192
SHELF = 4096
HITS = T.StructType([T.StructField(n, T.LongType()) for n in ("query_id", "vec_id", "score")])
LARGEST = float(2**62)
LOWEST, HIGHEST = -(2**63), 2**63 - 1


def quantise(vec: Column, scale: int = 256) -> Column:
    """Impacts ``floor(scale * x)`` (x as double) as array<bigint>; null where the vector takes no part."""
    bad = vec.isNull() | F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))

    def impact(x: Column) -> Column:
        y = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(y) <= LARGEST, F.floor(y).cast("long")).otherwise(F.raise_error(F.lit("impact beyond 62 bits")).cast("long"))
    return F.when(~bad, F.transform(vec, impact))


def _matrix(col: pa.Array) -> np.ndarray:
    """Rows of a list column as an int64 matrix, short rows padded with zeros."""
    lengths = np.diff(col.offsets.to_numpy(zero_copy_only=False))
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max(initial=0))
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def upper_bounds(queries: np.ndarray, high: np.ndarray, low: np.ndarray, reach: int) -> np.ndarray:
    """Per query and block the sum over terms of ``max(q*high, q*low)``; ``reach`` bounds every partial sum."""
    kind = np.float64 if reach < 2**53 else np.int64 if reach < 2**63 else object
    pos, neg = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
    out = pos @ high.T.astype(kind) + neg @ low.T.astype(kind)
    return (np.minimum(np.maximum(out, LOWEST + 1), HIGHEST) if kind is object else out).astype(np.int64)  # scores are longs


class BlockIndex:
    """Forward indexes and per-term extremes of the blocks of one group."""

    def __init__(self, ids: np.ndarray, impacts: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, m = ids[order], impacts[order]
        starts = np.arange(0, len(ids), BLOCK)
        self.high = np.maximum.reduceat(m, starts, axis=0)
        self.low = np.minimum.reduceat(m, starts, axis=0)
        self.biggest = int(np.abs(m).max(initial=0))
        self.impacts, self.starts = m, starts
        self.as_float = m.astype(np.float64)

    def _reach(self, queries: np.ndarray) -> int:
        """A bound of every partial sum."""
        return int(np.abs(queries).max(initial=0)) * self.biggest * max(1, queries.shape[1])

    def scores(self, queries: np.ndarray, rows: slice) -> np.ndarray:
        reach = self._reach(queries)
        if reach < 2**53:
            return (queries.astype(np.float64) @ self.as_float[rows].T).astype(np.int64)
        if reach < 2**63:
            return queries @ self.impacts[rows].T
        wide = queries.astype(object) @ self.impacts[rows].T.astype(object)
        if wide.size and (wide.max() > HIGHEST or wide.min() <= LOWEST):
            raise OverflowError("a score does not fit in a long")
        return wide.astype(np.int64)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest score that a query can have in each block."""
        return upper_bounds(queries, self.high, self.low, self._reach(queries))

    def search(self, qids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int):
        """Best k (ids, scores) per query with score >= floor; unused places hold the id maximum and None-score minimum."""
        width = min(queries.shape[1], self.impacts.shape[1])
        q = queries[:, :width]
        if width < self.impacts.shape[1]:
            return BlockIndex(self.ids, self.impacts[:, :width]).search(qids, q, floor, k)
        none = np.iinfo(np.int64)
        best = np.full((len(qids), k), none.min, np.int64)
        best_id = np.full((len(qids), k), none.max, np.int64)
        bound = self.bounds(q)
        order = np.argsort(-bound, axis=1, kind="stable")
        live = np.arange(len(qids))
        for step in range(len(self.starts)):
            block = order[live, step]
            alive = bound[live, block] >= np.maximum(best[live, -1], floor[live])
            live, block = live[alive], block[alive]
            if not len(live):
                break
            by = np.argsort(block, kind="stable")
            cuts = np.flatnonzero(np.diff(block[by])) + 1
            for part in np.split(by, cuts):
                who, b = live[part], block[part[0]]
                rows = slice(self.starts[b], self.starts[b] + BLOCK)
                ids = self.ids[rows]
                got = self.scores(q[who], rows)
                got[ids[None, :] == qids[who, None]] = none.min  # the query's own row
                all_s = np.concatenate([best[who], got], axis=1)
                all_i = np.concatenate([best_id[who], np.broadcast_to(ids, got.shape)], axis=1)
                top = np.lexsort((all_i, ~all_s), axis=1)[:, :k]
                best[who] = np.take_along_axis(all_s, top, 1)
                best_id[who] = np.take_along_axis(all_i, top, 1)
        return best_id, best


def _hits(qids, ids, scores, floor) -> pa.RecordBatch:
    keep = (scores != np.iinfo(np.int64).min) & (scores >= floor[:, None])
    q = np.broadcast_to(qids[:, None], ids.shape)
    return pa.record_batch([pa.array(x[keep]) for x in (q, ids, scores)], names=["query_id", "vec_id", "score"])


def _groups(batches: Iterator[pa.RecordBatch], by: str = "grp") -> Iterator[tuple[int, int, pa.RecordBatch]]:
    """(group, kind, rows) runs of batches sorted by group (or another number) and kind."""
    for batch in batches:
        if not batch.num_rows:
            continue
        g = batch.column(batch.schema.get_field_index(by)).to_numpy(zero_copy_only=False)
        kind = batch.column(batch.schema.get_field_index("kind")).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero((np.diff(g) != 0) | (np.diff(kind) != 0)) + 1), len(g)]
        for a, b in zip(cuts, cuts[1:]):
            yield int(g[a]), int(kind[a]), batch.slice(a, b - a)


def _search_task(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, parts, index = None, [], None
        for g, kind, rows in _groups(batches):
            if g != group:
                group, parts, index = g, [], None
            ids = rows.column(rows.schema.get_field_index("vec_id")).to_numpy(zero_copy_only=False)
            m = _matrix(rows.column(rows.schema.get_field_index("impacts")))
            if kind == 0:
                parts.append((ids, m))
                continue
            if index is None:
                if not parts:
                    continue
                index = BlockIndex(np.concatenate([p[0] for p in parts]), _pad([p[1] for p in parts]))
                parts = []
            floor = rows.column(rows.schema.get_field_index("floor")).to_numpy(zero_copy_only=False).astype(np.int64)
            for at in range(0, len(ids), 2048):
                s = slice(at, at + 2048)
                found, score = index.search(ids[s], m[s], floor[s], k)
                yield _hits(ids[s], found, score, floor[s])
    return run


def _extremes_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per run of a group's rows the largest and smallest impact of every term."""
    for batch in batches:
        for g, _, rows in _groups([batch]):
            m = _matrix(rows.column(rows.schema.get_field_index("impacts")))
            yield pa.record_batch([pa.array([g], pa.int32()), pa.array([m.max(axis=0)]), pa.array([m.min(axis=0)])],
                                  names=["grp", "high", "low"])


def _pad(parts: list[np.ndarray]) -> np.ndarray:
    width = max(p.shape[1] for p in parts)
    return np.concatenate([np.pad(p, ((0, 0), (0, width - p.shape[1]))) for p in parts])


def _choose_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shelf and kind: the shelf's extremes, then queries; gives the groups that each query has to visit."""
    shelf, parts, held = None, [], None
    for s, kind, rows in _groups(batches, "shelf"):
        if s != shelf:
            shelf, parts, held = s, [], None
        col = lambda name: rows.column(rows.schema.get_field_index(name))
        if kind == 0:
            parts.append((col("grp").to_numpy(), _matrix(col("impacts")), _matrix(col("low"))))
            continue
        if held is None:
            groups, high, low = (f([p[i] for p in parts]) for i, f in enumerate((np.concatenate, _pad, _pad)))
            by = np.argsort(groups, kind="stable")
            held = groups[by], high[by], low[by]
            most = max(int(np.abs(high).max(initial=0)), int(np.abs(low).max(initial=0)))
            parts = []
        groups, high, low = held
        first = np.flatnonzero(np.diff(groups, prepend=-1))
        q, ids, home = _matrix(col("impacts")), col("vec_id").to_numpy(), col("grp").to_numpy()
        floor = col("floor").to_numpy()
        width = min(q.shape[1], high.shape[1])
        for at in range(0, len(ids), 1024):
            p = slice(at, at + 1024)
            reach = int(np.abs(q[p]).max(initial=0)) * most * max(1, width)
            bound = np.maximum.reduceat(upper_bounds(q[p, :width], high[:, :width], low[:, :width], reach), first, axis=1)
            i, j = np.nonzero((bound >= floor[p, None]) & (groups[first][None, :] != home[p, None]))
            yield pa.record_batch([pa.array(ids[p][i]), pa.array(groups[first][j].astype(np.int32))], names=["query_id", "grp"])


def groups_to_visit(v: DataFrame, queries: DataFrame, groups: int, shelf: int = SHELF) -> DataFrame:
    """(query_id, grp): the groups but its own in which a query (grp, vec_id, impacts, floor) can have a score of its floor or more."""
    shelves = -(-groups // shelf)
    extremes = staged(v.select("grp", F.lit(0).alias("kind"), "impacts")
                      .mapInArrow(_extremes_task, "grp int, high array<bigint>, low array<bigint>"), "topk_extremes")
    held = extremes.select(F.floor(F.col("grp") / shelf).cast("int").alias("shelf"), F.lit(0).alias("kind"), "grp", F.lit(0).cast("long").alias("vec_id"),
                           F.col("high").alias("impacts"), "low", F.lit(0).cast("long").alias("floor"))
    asked = queries.select(F.explode(F.sequence(F.lit(0), F.lit(shelves - 1))).alias("shelf"), F.lit(1).alias("kind"), "grp", "vec_id",
                           "impacts", F.lit(None).cast("array<bigint>").alias("low"), "floor")
    rows = held.unionByName(asked).repartition(shelves, "shelf").sortWithinPartitions("shelf", "kind")
    return rows.mapInArrow(_choose_task, "query_id long, grp int")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: int = 256, group: int = GROUP, shelf: int = SHELF) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best rows of ``vectors``, ties to the smaller id.

    ``is_query`` is a condition over a column named ``vec_id``.
    """
    ship(vectors.sparkSession)
    v = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), quantise(F.col(vec_col), scale).alias("impacts"))
         .where("vec_id IS NOT NULL AND impacts IS NOT NULL")
         .groupBy("vec_id").agg(F.min("impacts").alias("impacts")))
    v = staged(v, "topk_vectors")
    parts = max(1, -(-v.count() // group))
    v = staged(v.repartitionByRange(parts, "vec_id").withColumn("grp", F.spark_partition_id()), "topk_groups")
    lowest = F.lit(-(2**63)).cast("long")
    data = v.select("grp", F.lit(0).alias("kind"), "vec_id", "impacts", lowest.alias("floor"))
    queries = v.where(is_query)

    def search(asked: DataFrame) -> DataFrame:
        both = data.unionByName(asked.select("grp", F.lit(1).alias("kind"), "vec_id", "impacts", "floor"))
        return both.repartition(parts, "grp").sortWithinPartitions("grp", "kind").mapInArrow(_search_task(k), HITS)

    own = staged(search(queries.withColumn("floor", lowest)), "topk_own")
    kth = own.groupBy("query_id").agg(F.min("score").alias("low"), F.count("*").alias("n"))
    groups = v.agg((F.max("grp") + 1).alias("n")).first()["n"] or 0
    if groups > 1:
        asked = staged(queries.join(kth, F.col("query_id") == F.col("vec_id"), "left")
                       .select("grp", "vec_id", "impacts", F.when(F.col("n") >= k, F.col("low")).otherwise(lowest).alias("floor")), "topk_asked")
        visits = groups_to_visit(v, asked, groups, shelf)
        hits = own.unionByName(search(visits.join(asked.drop("grp"), F.col("query_id") == F.col("vec_id"))))
    else:
        hits = own
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
