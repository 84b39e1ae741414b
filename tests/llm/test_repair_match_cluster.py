"""Conversation repair, I-Match fingerprints and centroid clusters against brute force and on edge cases."""

import hashlib
import math
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.llm import clustering, conversations, imatch, oracle
from tidemark.llm.common import read_table

SF = "/root/testdata/sf0.001"
ROWS = "conv_id long, turn long, role string, text string"
FOLLOW = {"": "u", "s": "u", "u": "a", "a": "u"}
FULL = {"u": "user", "a": "assistant"}


# ------------------------------------------------------------ conversations
def best_repair(turns, faults):
    """(cost, audit, repaired rows) by a forward search over whole audits, a path per state."""
    best = {"": (0, "", ())}

    def offer(into, state, path):
        if state not in into or path[:2] < into[state][:2]:
            into[state] = path
            return True
        return False

    def with_inserts(paths):
        while any(offer(paths, FOLLOW[s], (c + 5, a + "I", p + (FULL[FOLLOW[s]] + ":",))) for s, (c, a, p) in list(paths.items())):
            pass
        return paths
    with_inserts(best)
    for (role, text), fault in zip(turns, faults):
        new = {}
        for state, (cost, audit, kept) in best.items():
            offer(new, state, (cost + 2, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            if role[:1] == FOLLOW[state] or (state == "" and role[:1] == "s"):
                offer(new, role[:1], (cost + more, audit + "K", kept + (f"{role}:{text}",)))
            offer(new, FOLLOW[state], (cost + 1 + more, audit + "R", kept + (f"{FULL[FOLLOW[state]]}:{text}",)))
        best = with_inserts(new)
    return min(best[s] for s in ("", "a") if s in best)


def brute_repair(rows):
    convs = {}
    for conv, turn, role, text in rows:
        damage = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        mine = convs.setdefault(conv, [])
        if damage == 0:
            continue
        text = "" if damage == 1 else text.translate({ord(c): None for c in ".!?"}) if damage == 2 else text
        mine += [(turn, "user" if damage == 4 else role, text)] * (2 if damage == 3 else 1)
    out = {}
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:32], hashlib.md5(r[2].encode()).hexdigest()))
        seen, faults = set(), []
        for _, role, text in mine:
            bare = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in mine if t is not None]
        cost, audit, kept = best_repair([r[1:] for r in mine], faults)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:])), cost, audit,
                     hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def repaired(rows, **options):
    return {r[0]: tuple(r)[1:] for r in conversations.repair(conversations.damaged(rows), **options).collect()}


def test_repair_of_all_conversations(spark):
    rows = read_table(spark, SF, "conversations")
    assert repaired(rows) == brute_repair([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()])


@pytest.mark.parametrize("chunk_rows", [5, 2048])
def test_repair_in_chunks_of_one_large_conversation(spark, chunk_rows):
    rnd = random.Random(5)
    rows = [(rnd.choice([None, 7, 7, 7, 8]), rnd.choice([None, *range(150)]), rnd.choice([None, "", "system", "user", "assistant", "tool", "a"]),
             rnd.choice([None, "", "hi.", "ok", "x!", " \n", f"a{rnd.randrange(60)}."])) for _ in range(400)]
    df = spark.createDataFrame(rows, ROWS).repartition(5).withColumn("n", F.lit("clash")).withColumn("chunk", F.lit(None))
    assert repaired(df, chunk_rows=chunk_rows) == brute_repair(rows)


def test_repair_chunks_that_speculate_wrongly(spark):
    """Only user rows: every boundary's true vector differs from the speculative one or meets it late."""
    rows = [(1, t, "user", f"text {t}.") for t in range(60)] + [(2, t, "assistant", f"text {t}") for t in range(60)]
    assert repaired(spark.createDataFrame(rows, ROWS), chunk_rows=4, chunk_bytes=40) == brute_repair(rows)


def test_rank_convergence_stops_early_and_agrees():
    codes = bytes([1, 2] * 50)
    right = conversations.left_vector(bytes([1, 2]), conversations.END)
    met, ran = conversations.fixed_up(codes, conversations.END, right)
    assert met and ran < len(codes)
    assert conversations.left_vector(codes, right) == conversations.left_vector(codes, conversations.END)


def test_repair_edge_cases(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    kept = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 > 5)
    rows = [(dropped, 0, "user", "gone."), (kept, 0, "user", "é" * 100_000 + "."), (kept, 0, "user", "é" * 100_000 + ".")]
    got = repaired(spark.createDataFrame(rows, ROWS))
    assert got == brute_repair(rows)
    assert got[dropped] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repaired(spark.createDataFrame([], ROWS)) == {}


# -------------------------------------------------------------- fingerprints
def oracle_rows(spark, docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toArrow())
    res = con.execute(oracle.FINGERPRINTS)
    return sorted(sorted(zip([d[0] for d in res.description], r)) for r in res.fetchall())


def own_rows(docs):
    return sorted(sorted(r.asDict().items()) for r in imatch.fingerprints(docs).collect())


def test_fingerprints_of_odd_texts_match_sql(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randrange(1, 4)))
    texts = [None, "", " ", "a", "Ab aB ab", "\n\n", "ß…ü x-y"] + [" ".join(word() for _ in range(rnd.choice([3, 40, 3000]))) for _ in range(60)]
    docs = spark.createDataFrame([(i * 3, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, k string").repartition(4)
    got = own_rows(docs)
    assert got == oracle_rows(spark, docs)
    by_text = {}
    for r in got:
        r = dict(r)
        by_text.setdefault(texts[r["doc_id"] // 3] or "", set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(f) == 1 for f in by_text.values())


def test_edited_texts_are_liker_than_next_ones(spark):
    got = imatch.fingerprints(read_table(spark, "/root/testdata/sf0.01", "documents")).agg(
        F.avg("near_edited"), F.avg("near_next"), F.avg((F.col("near_edited") > F.col("near_next")).cast("int"))).first()
    assert got[0] > 0.35 and got[1] < 0.02 and got[2] > 0.98


def test_fingerprint_edge_cases(spark):
    schema = "doc_id long, text string"
    assert own_rows(spark.createDataFrame([], schema)) == []
    one = imatch.fingerprints(spark.createDataFrame([(5, "one two three")], schema)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    rows = [(1, "red fox"), (1, "red fox"), (1, "blue"), (None, "last"), (None, None), (2, "red fox")]
    got = imatch.fingerprints(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in got) == [(False, 1)] * 3 + [(False, 2)] + [(True, 0)] * 2
    assert len({r["fingerprint"] for r in got if r["n_chars"] == 7}) == 1
    # of two equal rows the first is followed by the second
    assert {r["edited_sha256"] for r in got if r["doc_id"] == 1 and r["n_chars"] == 7} >= {hashlib.sha256(b"red fre").hexdigest()}


# ------------------------------------------------------------------ clusters
def brute_clusters(vectors, k, rounds, dims):
    kept = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda p: ((0, hashlib.sha256(f"2:{p[0]}".encode()).hexdigest()) if p[0] is not None else (1, ""), p[1]))
    cents = [v for _, v in start[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents))
    for _ in range(rounds):
        home = [nearest(v)[1] for _, v in kept]
        for n in range(len(cents)):
            mine = [v for (_, v), h in zip(kept, home) if h == n]
            if mine:
                cents[n] = [sum(col) // len(mine) for col in zip(*mine)]
    found = [(i, *nearest(v)) for i, v in kept]
    per = {n: sum(d for _, d, m in found if m == n) for n in range(len(cents))}
    return sorted(((i is None, i or 0), n, d, per[n], sum(per.values()), hashlib.sha256(",".join(map(str, cents[n])).encode()).hexdigest())
                  for i, d, n in found)


def clusters(df, **options):
    return sorted(((r[0] is None, r[0] or 0), *tuple(r)[1:]) for r in clustering.cluster(df, **options).collect())


@pytest.mark.parametrize("size", [1.0, 2.5e5])
def test_clusters_match_brute_force(spark, size):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, *range(80)]), [size * rnd.gauss(0, 1) for _ in range(6)]) for _ in range(120)]
    rows += [(200, None), (201, [1.0] * 5), (202, [None] * 6), (203, [float("nan")] * 6), (204, [float("inf")] + [0.0] * 5), (1, rows[0][1]), (1, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3).withColumn("vals", F.lit(1)).withColumn("cluster", F.lit(1))
    assert clusters(df, k=9, rounds=3, dims=6) == brute_clusters(rows, 9, 3, 6)


def test_cluster_edge_cases(spark):
    schema = "vec_id long, embedding array<float>"
    assert clusters(spark.createDataFrame([], schema)) == []
    few = [(i, [float(i % 3)] * 4) for i in range(5)]
    assert clusters(spark.createDataFrame(few, schema), k=40, dims=4) == brute_clusters(few, 40, 5, 4)
    with pytest.raises(Exception, match="too large"):
        clusters(spark.createDataFrame([(1, [1e30] * 4)], schema), k=2, dims=4)


def test_lookup_tables_in_wide_integers():
    import numpy as np
    m = np.array([[2**40, -2**40], [5, 7], [2**40, 2**40]])
    cents = [[0, 0], [2**40, 2**39]]
    cluster, distance = clustering.nearest(m, cents)
    want = [min((sum((int(a) - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents)) for v in m]
    assert list(zip(distance.tolist(), cluster.tolist())) == want
