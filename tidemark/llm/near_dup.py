"""Near-duplicate groups by b-bit MinHash with exact confirmation.

Documents whose sets of 5-word shingles have a Jaccard similarity of 75 % or more are
linked; a group is a connected component of links.

1. Every document gives its shingle set's size and digest, ``BANDS * ROWS`` minima and,
   of each minimum, its low 16 bits, packed into the signature.  Documents with equal
   sets form a class; one member stands for it from here on.
2. Bands of ``ROWS`` minima give candidate buckets: a band's key is its 64 bits of the
   signature.  A pair at the threshold misses all bands with probability (1 - 0.75^4)^40 = 2e-7.
3. *Star round*: each member is checked against one bucket minimum.  Links contract to
   components, so a large bucket of copies of one text is mostly settled by as many
   checks as it has members.
4. *Nearest round*, then *closing round*: only members outside a bucket's largest
   component are compared with the bucket, by signature: the low ``BITS`` bits of each minimum lie
   in bit planes, the planes of two texts are XORed and ORed, and the count of bits left, corrected for
   chance collisions, estimates the similarity.  The nearest round checks the best partner of each;
   the closing round checks **every** pair of different components whose estimate is within
   ``MARGIN`` (five standard deviations) of the threshold.  Pairs inside a component need no check.
   The outsiders of a bucket are cut into tiles and its members into parts, both of bounded size;
   a task takes one part past one tile.
5. A link counts only if the full shingle sets confirm it: 100 * |A and B| >= 75 * |A or B|.
6. Components: smallest reachable id by label propagation with pointer jumping; each
   step is a reliable checkpoint.

Words are runs of non-white-space (ASCII) with A-Z lowered; shingles are compared by
64-bit hashes.  Hot buckets: counts are combined before the shuffle, joins are plain
equi-joins that adaptive execution can split, and checks of one hub are salted.

Defined cases: null, empty and white-space texts have no shingles and no links
(component_id = doc_id, kept); fewer than five words make one shingle; equal texts
share a component; repeated rows of an id give a row each, are one document with all
their texts (what any of them links is in one component) and may all be kept; a null doc_id gives
component_id null and kept true and links nothing.  Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Out, checkpointed, id_and_text, only_cache, rows_of, staged

SHINGLE = 5
ROWS, BANDS = 4, 40
PERCENT = 75
BITS = 4  # low bits of a minimum that the estimate compares
CHANCE = 2.0**-BITS  # two different minima share them
MARGIN = 0.18
TILE = 256
PART = 1024
SALTS = 16
SEED = 20240229

_U = np.uint64
# odd multipliers of the shingle hash
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], _U)

FEATURES = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()),
    T.StructField("sig", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType())),
])


class _Words(dict):
    """Word -> 64-bit hash, of bounded size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 250_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_WORDS = _Words()


def _mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = h ^ (h >> _U(31))
        h = h * _U(0xFF51AFD7ED558CCD)
        return h ^ (h >> _U(33))


def shingles(body: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word shingles."""
    words = body.lower().split() if body else []
    if not words:
        return np.empty(0, _U)
    h = np.fromiter(map(_WORDS.__getitem__, words), _U, len(words))
    n = min(size, len(words))
    with np.errstate(over="ignore"):
        s = sum((h[i:len(h) - n + 1 + i] * _MIX[i] for i in range(1, n)), h[:len(h) - n + 1] * _MIX[0]) + _U(n)
    return np.unique(_mix(s))


def multipliers(k: int = ROWS * BANDS, seed: int = SEED) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, k, dtype=_U) | _U(1)


def minima(sets: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over a shingle set, as 32-bit values."""
    low = np.full(len(by), np.iinfo(_U).max, _U)
    with np.errstate(over="ignore"):
        for at in range(0, len(sets), 4096):
            np.minimum(low, (sets[at:at + 4096, None] * by).min(axis=0), out=low)
    return (low >> _U(32)).astype(np.uint32)


def signature(m: np.ndarray) -> bytes:
    """The low 16 bits of each minimum, packed; every 8 bytes are the key of a band."""
    return m.astype("<u2").tobytes()


def planes(sigs: np.ndarray) -> np.ndarray:
    """Bit planes of packed signatures: row, plane, 64-bit word; the last word is filled up with zeros."""
    lanes = sigs.view("<u2")
    bits = (lanes[:, None, :] >> np.arange(BITS, dtype=np.uint16)[None, :, None]) & np.uint16(1)
    packed = np.packbits(bits.astype(np.uint8), axis=2)
    return np.ascontiguousarray(np.pad(packed, ((0, 0), (0, 0), (0, -packed.shape[2] % 8)))).view(_U)


def estimates(a: np.ndarray, b: np.ndarray, minima: int = ROWS * BANDS) -> np.ndarray:
    """Similarity of pairs of rows of planes: minima that differ are counted as bits, chance collisions taken off."""
    differ = np.bitwise_count(np.bitwise_or.reduce(a ^ b, axis=1)).sum(axis=1, dtype=np.int64)
    return (1 - differ / minima - CHANCE) / (1 - CHANCE)


def _feature_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    only_cache(_WORDS)
    by = multipliers()
    out = Out(pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()), ("sig", pa.binary()),
                         ("bands", pa.list_(pa.int64()))]))
    for doc, body in rows_of(batches, "id", "body"):
        s = shingles(body)
        if not len(s) or doc is None:
            yield from out.add((doc, len(s), None, None, None))
            continue
        sig = signature(minima(s, by))
        yield from out.add((doc, len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), sig, np.frombuffer(sig, "<i8")))
    yield from out.flush()


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted shingle sets reach the threshold."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a) or 100 * len(a) < percent * len(b):  # the smaller set bounds what they share
        return False
    at = np.searchsorted(b, a)
    both = int((b[np.minimum(at, len(b) - 1)] == a).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm_task(percent: int):
    """Rows sorted by hub and kind: the hub's texts (mostly one), then the texts to check against it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_cache(_WORDS)
        out = Out(pa.schema([("a", pa.int64()), ("b", pa.int64())]))
        hub = salt_of = own = None
        for a, salt, kind, b, body in rows_of(batches, "a", "salt", "kind", "id", "body"):
            s = shingles(body)
            if (a, salt) != (hub, salt_of):
                hub, salt_of, own = a, salt, []
            if kind == 0:
                own.append(s)
            elif any(linked(o, s, percent) for o in own):
                yield from out.add((a, b))
        yield from out.flush()
    return run


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold; ``texts`` holds (id, body) of all of them."""
    load = pairs.groupBy("a").agg(F.ceil(F.count("*") / TILE).cast("int").alias("salts"))
    hubs = (load.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
            .join(texts, F.col("a") == F.col("id")).select("a", "salt", F.lit(0).alias("kind"), "id", "body"))
    rest = (pairs.join(load, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
            .join(texts, F.col("b") == F.col("id")).select("a", "salt", F.lit(1).alias("kind"), "id", "body"))
    both = hubs.unionByName(rest).repartition("a", "salt").sortWithinPartitions("a", "salt", "kind")
    return staged(both.mapInArrow(_confirm_task(percent), "a long, b long"), "near_links")


def components(links: DataFrame) -> DataFrame:
    """(id, label): the smallest id reachable over links (a, b), for every id that has a link."""
    edges = checkpointed(links.select(F.col("a").alias("u"), F.col("b").alias("v"))
                         .union(links.select("b", "a")).where("u <> v").distinct())
    labels = checkpointed(edges.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("id"), F.least("u", "v").alias("label")))
    while True:
        near = edges.join(labels.select(F.col("id").alias("v"), "label"), "v").groupBy("u").agg(F.min("label").alias("near"))
        step = labels.join(near, F.col("id") == F.col("u")).select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        step = checkpointed(step)
        # few labels lead further; a label may be shared by a third of all ids, so the join back is salted
        heads = step.select(F.col("label").alias("head")).distinct()
        jump = (step.where("label < id").select(F.col("id").alias("to"), F.col("label").alias("further"))
                .join(heads, F.col("to") == F.col("head"), "left_semi")
                .withColumn("to_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))))
        salt = F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")
        new = checkpointed(step.join(jump, (F.col("label") == F.col("to")) & (salt == F.col("to_salt")), "left")
                           .select("id", "old", F.least("label", F.coalesce("further", "label")).alias("label")))
        labels = new.select("id", "label")
        if new.where("old <> label").isEmpty():
            return labels


class _Tile:
    """Outsiders of a bucket, held while the bucket's members stream past."""

    def __init__(self, band: int, best_only: bool, least: float):
        self.band, self.best_only, self.least = band, best_only, least
        self.rows: list[tuple] = []
        self.ids = None

    def pack(self) -> None:
        self.ids, self.comps, sigs, _ = _columns(self.rows)
        self.planes, self.words = planes(sigs), sigs.view("<i8")
        self.score = np.zeros(len(self.ids))
        self.partner = np.zeros(len(self.ids), np.int64)

    def past(self, rows: list[tuple]) -> list[tuple[int, np.ndarray]]:
        """Per streamed member the outsiders to check it with (none where only the best partner is kept)."""
        if self.ids is None:
            self.pack()
        ids, comps, sigs, outside = _columns(rows)
        bits, words = planes(sigs), sigs.view("<i8")
        wanted = self.comps[:, None] != comps[None, :]
        if not self.best_only:
            wanted &= ~outside[None, :] | (self.ids[:, None] < ids[None, :])  # two outsiders meet twice
            if self.band:  # a pair belongs to the first band it shares
                earlier = (self.words[:, None, :self.band] == words[None, :, :self.band]).any(axis=2)
                wanted &= ~earlier
        i, j = np.nonzero(wanted)
        est = np.empty(len(i))
        for at in range(0, len(i), 8192):
            p = slice(at, at + 8192)
            est[p] = estimates(self.planes[i[p]], bits[j[p]])
        ok = est >= self.least
        i, j, est = i[ok], j[ok], est[ok]
        if not self.best_only:
            by = np.argsort(j, kind="stable")
            cuts = np.flatnonzero(np.diff(j[by])) + 1
            return [(int(ids[j[p[0]]]), self.ids[i[p]]) for p in np.split(by, cuts) if len(p)]
        order = np.argsort(est, kind="stable")  # the best of each row is written last
        top, mate = np.zeros(len(self.ids)), np.zeros(len(self.ids), np.int64)
        top[i[order]], mate[i[order]] = est[order], ids[j[order]]
        better = top > self.score
        self.score[better], self.partner[better] = top[better], mate[better]
        return []


def _columns(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, comps, sigs, outside = zip(*rows)
    return (np.array(ids, np.int64), np.array(comps, np.int64), np.frombuffer(b"".join(sigs), np.uint8).reshape(len(ids), -1),
            np.array(outside, bool))


def _nearest_task(best_only: bool, least: float):
    """Rows sorted by bucket, tile, part and kind: a tile of a bucket's outsiders, then a part of the bucket's members."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("band", pa.int32()), ("key", pa.int64()), ("tile", pa.int32()), ("part", pa.int32()), ("b", pa.int64()),
                            ("outsiders", pa.list_(pa.int64())), ("score", pa.float64())])
        at, tile, members, held = None, None, [], set()
        out = Out(schema)

        def send():
            if members and tile.rows:
                for b, wanted in tile.past(members):
                    held.update(wanted.tolist())
                    yield from out.add((*at, b, wanted, None), 8 * len(wanted))
            members.clear()

        def end():
            yield from send()
            if held:
                yield from out.add((*at, None, sorted(held), None), 8 * len(held))
                held.clear()
            if best_only and tile is not None and tile.ids is not None:
                some = tile.score > 0
                for own, mate, score in zip(tile.ids[some].tolist(), tile.partner[some].tolist(), tile.score[some].tolist()):
                    yield from out.add((*at, mate, [own], score))

        for *place, kind, doc, comp, sig, outside in rows_of(batches, *KEY, "kind", "id", "comp", "sig", "outside"):
            if tuple(place) != at:
                yield from end()
                at, tile = tuple(place), _Tile(place[0], best_only, least)
            row = doc, comp, sig, outside
            if kind == 0:
                tile.rows.append(row)
            else:
                members.append(row)
                if len(members) >= TILE:
                    yield from send()
        yield from end()
        yield from out.flush()
    return run


KEY = ["band", "key", "tile", "part"]
LISTS = "band int, key long, tile int, part int, b long, outsiders array<bigint>, score double"


def open_lists(members: DataFrame, labels: DataFrame, sigs: DataFrame, best_only: bool, least: float) -> DataFrame:
    """Candidates between different components of a bucket whose estimate is at least ``least``.

    Only members outside their bucket's largest component are compared with the
    bucket.  Gives (tile, part, b, outsiders, score): a member and those of a tile's outsiders to check it
    with.  ``best_only`` keeps each outsider's best partner per
    part of a bucket, with its estimate; otherwise every pair comes once, from the first band that it shares, and
    a row without b names each outsider of the tile that is in any of the part's pairs.
    """
    m = members.join(labels, "id", "left").withColumn("comp", F.coalesce("label", "id")).select("band", "key", "id", "comp")
    m = checkpointed(m)
    sizes = m.groupBy("band", "key", "comp").agg(F.count("*").alias("n"))
    top = sizes.groupBy("band", "key").agg(F.max(F.struct("n", "comp")).alias("top"), F.sum("n").alias("all"))
    unsettled = top.where("all > top.n").select("band", "key", F.col("top.comp").alias("main"),
                                                F.ceil((F.col("all") - F.col("top.n")) / TILE).cast("int").alias("tiles"),
                                                F.ceil(F.col("all") / PART).cast("int").alias("parts"))
    held = checkpointed(m.join(unsettled, ["band", "key"]).withColumn("outside", F.col("comp") != F.col("main")))
    place = F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    signed = held.join(sigs, "id")
    columns = (*KEY, "kind", "id", "comp", "sig", "outside")
    tiled = signed.where("outside").withColumn("tile", place).withColumn("part", each("parts")).withColumn("kind", F.lit(0)).select(*columns)
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int")
    past = signed.withColumn("part", part).withColumn("tile", each("tiles")).withColumn("kind", F.lit(1)).select(*columns)
    rows = tiled.unionByName(past).repartition(*KEY).sortWithinPartitions(*KEY, "kind", "id")
    return staged(rows.mapInArrow(_nearest_task(best_only, least), LISTS), "near_lists")


def _confirm_lists_task(percent: int):
    """Rows sorted by tile and kind: the outsiders' texts, then members with the outsiders to check them with."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_cache(_WORDS)
        out = Out(pa.schema([("a", pa.int64()), ("b", pa.int64())]))
        at, own = None, {}
        for *place, kind, doc, body, wanted in rows_of(batches, *KEY, "kind", "id", "body", "outsiders"):
            if place != at:
                at, own = place, {}
            s = shingles(body)
            if kind == 0:
                own.setdefault(doc, []).append(s)
                continue
            for other in wanted:
                if any(linked(o, s, percent) for o in own[other]):
                    yield from out.add((min(doc, other), max(doc, other)))
        yield from out.flush()
    return run


def confirmed_lists(lists: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) among the pairs of ``lists``; a tile's texts are held once, however many pairs they are in."""
    # named once by the task that found the pairs: pairs are never rows
    wanted = lists.where("b IS NULL").select(*KEY, F.explode("outsiders").alias("id"))
    own = (wanted.join(texts, "id")
           .select(*KEY, F.lit(0).alias("kind"), "id", "body", F.lit(None).cast("array<bigint>").alias("outsiders")))
    rest = lists.join(texts, F.col("b") == F.col("id")).select(*KEY, F.lit(1).alias("kind"), "id", "body", "outsiders")
    rows = own.unionByName(rest).repartition(*KEY).sortWithinPartitions(*KEY, "kind")
    return staged(rows.mapInArrow(_confirm_lists_task(percent), "a long, b long"), "near_links")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, margin: float = MARGIN) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``."""
    body = id_and_text(docs)
    feats = staged(body.mapInArrow(_feature_task, FEATURES), "near_features")
    classes = checkpointed(feats.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("rep")))
    # an id is a rep once for each of its texts (more than one only where rows share an id)
    reps = (feats.join(classes.withColumnRenamed("rep", "doc_id"), ["digest", "doc_id"], "left_semi")
            .dropDuplicates(["doc_id", "digest"]))
    banded = reps.select(F.col("doc_id").alias("id"), F.posexplode("bands").alias("band", "key"))
    buckets = (banded.groupBy("band", "key").agg(F.min("id").alias("hub"), F.count("*").alias("n"))
               .where("n > 1").select("band", "key", "hub"))
    members = staged(banded.join(buckets, ["band", "key"]), "near_members")
    involved = checkpointed(members.select("id").distinct())
    texts = staged(body.join(involved, "id", "left_semi").select("id", "body").distinct(), "near_texts")
    sigs = checkpointed(feats.select(F.col("doc_id").alias("id"), "sig").join(involved, "id", "left_semi").distinct())
    placed = staged(feats.select("doc_id", "n_shingles", "digest").join(classes, "digest", "left")
                    .select("doc_id", "n_shingles", "rep"), "near_classes")
    shared = placed.where("rep IS NOT NULL").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("top")).where("a < top")
    same_id = checkpointed(placed.join(shared, "doc_id").select("a", F.col("rep").alias("b")).where("a < b").distinct())

    votes = members.where("id <> hub").groupBy("id", "hub").agg(F.count("*").alias("n"))
    star = votes.groupBy("id").agg(F.max(F.struct("n", (-F.col("hub")).alias("hub"))).alias("best"))
    links = same_id.union(confirmed(star.select((-F.col("best.hub")).alias("a"), F.col("id").alias("b")), texts, percent))
    least = percent / 100 - margin
    lists = open_lists(members, components(links), sigs, True, least)
    best = (lists.groupBy("band", "key", F.col("outsiders")[0].alias("own"))
            .agg(F.max(F.struct("score", (-F.col("b")).alias("b"))).alias("best")).select("own", (-F.col("best.b")).alias("b")))
    nearest = best.select(F.least("b", "own").alias("a"), F.greatest("b", "own").alias("b")).distinct()
    links = links.union(confirmed(checkpointed(nearest), texts, percent))
    lists = open_lists(members, components(links), sigs, False, least)
    links = links.union(confirmed_lists(lists, texts, percent))
    label = components(links)
    own = placed.join(label.withColumnRenamed("id", "rep"), "rep", "left")
    out = own.select("doc_id", "n_shingles", F.coalesce("label", "rep", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
