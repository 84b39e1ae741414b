"""The training-data operators against brute force, exact round trips and small edge cases."""

import gzip
import hashlib
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import decontaminate, html_extract, near_dup, packing, pii, queries, records, token_counts, topk, toxicity, warc
from tidemark.llm.tokens import Encoder

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, body string"
EDGE = [None, "", "  \n\t ", "one two", "a b c d e f g h", "a b c d e f g h", "x y  z\n\n q", "é ü ß Ω", "word " * 3000]


def documents(spark, texts=EDGE):
    """Rows with repeated texts, nulls and extra columns whose names the operators use themselves."""
    rows = [(i, t, None, "s", None, 7, "b") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def library(name):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda s: t.encode(s or "", add_special_tokens=False).ids + [0]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_top_k_brute_force(spark):
    rng = np.random.default_rng(1)
    vecs = [[float(x) for x in rng.normal(0, 0.2, 8)] for _ in range(400)]
    vecs[7] = vecs[8] = vecs[9]  # ties
    bad = [(1000, None), (1001, [None] * 8), (1002, [float("nan")] * 8), (1003, [float("inf")] + [0.0] * 7), (None, [1.0] * 8)]
    df = spark.createDataFrame([*enumerate(vecs), *bad, (0, vecs[0])], "vec_id long, embedding array<float>").repartition(3)
    m = np.floor(256 * np.array(vecs, np.float32).astype(float)).astype(np.int64)
    want = set()
    for q in range(0, 400, 50):
        order = sorted((-int(m[i] @ m[q]), i) for i in range(400) if i != q)[:5]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(order)}
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, group=100)
    assert {tuple(r) for r in got.collect()} == want
    shelved = topk.top_k(df, F.col("vec_id") % 50 == 0, group=30, shelf=4)
    assert {tuple(r) for r in shelved.collect()} == want
    assert topk.top_k(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_sends_queries_only_where_the_bound_reaches(spark):
    """Groups of short vectors are not visited by queries that found better in their own; unequal lengths are allowed."""
    rows = [(i, i // 50, [2.0 if i < 50 else 0.25] * (4 if i % 2 else 3)) for i in range(200)]
    v = spark.createDataFrame([(i, g, [int(256 * x) for x in vec]) for i, g, vec in rows], "vec_id long, grp int, impacts array<bigint>")
    least = 512 * 512 * 3
    asked = v.where("vec_id % 25 = 0").withColumn("floor", F.when(F.col("grp") == 0, least).otherwise(512 * 64 * 3).cast("long"))
    got = {tuple(r) for r in topk.groups_to_visit(v, asked, 4, shelf=3).collect()}
    assert got == {(q, 0) for q in (50, 75, 100, 125, 150, 175)}


@pytest.mark.parametrize("size", [1e4, 1e6])
def test_top_k_of_large_components(spark, size):
    """Integers beyond 2^31 in single components, and scores near the end of a long."""
    rng = np.random.default_rng(4)
    vecs = rng.normal(0, size, (150, 4))
    vecs[::3, 1:] = 0
    vecs[5] = [1e12, 0, 0, 0]
    vecs[[i for i in range(150) if i != 5], 0] = rng.normal(0, 10, 149)
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "vec_id long, embedding array<double>")
    m = [[int(np.floor(256 * x)) for x in v] for v in vecs]
    want = set()
    for q in range(0, 150, 50):
        order = sorted((-sum(a * b for a, b in zip(m[i], m[q])), i) for i in range(150) if i != q)[:5]
        want |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(order)}
    assert {tuple(r) for r in top_k_rows(df)} == want
    assert max(abs(x) for _, _, _, x in want) > 2**31
    rows = spark.createDataFrame([(0, [1.0]), (1, [1e7]), (2, [3e7])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in top_k_rows(rows)][0] == (0, 1, 2, 1966080000000)
    with pytest.raises(Exception, match="does not fit in a long"):
        top_k_rows(spark.createDataFrame([(0, [1e12] * 4), (1, [1e12] * 4)], "vec_id long, embedding array<double>"))
    with pytest.raises(Exception, match="62 bits"):
        top_k_rows(spark.createDataFrame([(0, [1e30])], "vec_id long, embedding array<double>"))


def top_k_rows(df):
    return topk.top_k(df, F.col("vec_id") % 50 == 0, group=40).orderBy("query_id", "rank").collect()


def test_long_runs_of_digits_are_no_error():
    zeros = "0" * 5000
    assert pii.base_spans(f"{zeros}.1.1.1 and 1.2.3.{zeros}7") == [("ip", 0, 5006), ("ip", 5011, 5011 + 6 + 5001)]
    assert pii.base_spans("9" * 5000 + ".1.1.1") == []


def test_html_with_a_megabyte_of_stray_tags_is_linear():
    import time
    for source in ("<span>x</div>" * 80_000, "<p><button>" + "<span>" * 50_000 + "<p></p>" * 50_000, "<b>" * 30_000 + "x<p>" * 30_000):
        start = time.time()
        html_extract.parse(source)
        assert time.time() - start < 20


def test_estimates_count_bits():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**32, (50, near_dup.ROWS * near_dup.BANDS)).astype(np.uint32)
    b = np.where(rng.random(a.shape) < 0.8, a, rng.integers(0, 2**32, a.shape)).astype(np.uint32)
    pack = lambda m: near_dup.planes(np.stack([np.frombuffer(near_dup.signature(x), np.uint8) for x in m]))
    low = 2**near_dup.BITS
    same = (a % low == b % low).mean(axis=1)
    assert np.allclose(near_dup.estimates(pack(a), pack(b)), (same - 1 / low) / (1 - 1 / low))
    assert np.abs(near_dup.estimates(pack(a), pack(b)) - (a == b).mean(axis=1)).max() < 0.15


def test_near_duplicates_rows_that_share_an_id(spark):
    """Rows of one id are one document with all their texts: 3 and 9 meet through the id 4, whatever text comes first."""
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    rows = [(4, a), (4, b), (4, a), (9, a + " x"), (3, "y " + b), (4, None), (7, "some other words that stand alone"), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in near_dup.near_duplicates(df).collect()}
    assert got == {(4, 26, 3), (4, 0, 4), (9, 27, 3), (3, 27, 3), (7, 2, 7), (7, 0, 7)}


def test_near_duplicates_name_an_outsider_once_for_all_its_pairs(spark):
    sig = near_dup.signature(near_dup.minima(near_dup.shingles(b"a b c d e f g h"), near_dup.multipliers()))
    same = "a b c d e f g h"
    rows = [(0, 7, 0, 0, 0, i, i, sig, True) for i in range(3)] + [(0, 7, 0, 0, 1, i, i, sig, i < 3) for i in range(40)]
    schema = "band int, key long, tile int, part int, kind int, id long, comp long, sig binary, outside boolean"
    near = spark.createDataFrame(rows, schema).coalesce(1).sortWithinPartitions(*near_dup.KEY, "kind", "id")
    lists = near.mapInArrow(near_dup._nearest_task(False, 0.5), near_dup.LISTS)
    assert [r.outsiders for r in lists.where("b IS NULL").collect()] == [[0, 1, 2]]
    texts = spark.createDataFrame([(i, same.encode()) for i in range(40)], "id long, body binary")
    links = near_dup.confirmed_lists(lists, texts)
    assert {(r.a, r.b) for r in links.collect()} == {(a, b) for a in range(3) for b in range(40) if a < b}


@pytest.mark.parametrize("tile,part", [(near_dup.TILE, near_dup.PART), (4, 8)])
def test_near_duplicates_brute_force(spark, monkeypatch, tile, part):
    monkeypatch.setattr(near_dup, "TILE", tile)
    monkeypatch.setattr(near_dup, "PART", part)
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    base = [words[i] for i in rng.integers(0, 300, 60)]
    texts = list(EDGE)
    for _ in range(60):  # a family of edited copies, some close and some not
        t = list(base)
        for at in rng.integers(0, 60, rng.integers(0, 4)):
            t[at] = words[rng.integers(0, 300)]
        texts.append(" ".join(t))
    got = {r.doc_id: r for r in near_dup.near_duplicates(documents(spark, texts)).collect()}
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    for i, s in enumerate(sets):
        assert (got[i].n_shingles, got[i].component_id, got[i].kept) == (len(s), find(i), find(i) == i)
    assert near_dup.near_duplicates(documents(spark, [])).count() == 0


def contract_words(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def contamination_by_plain_search(texts, items, size=10):
    """(n_words, n_hit, n_items, items_sha256, contaminated) a text, by comparing every place with every window."""
    windows = {}
    for item, text in items.items():
        words = contract_words(text)
        for i in range(max(1, len(words) - size + 1) if words else 0):
            windows.setdefault(" ".join(words[i:i + size]), set()).add(item)
    out = []
    for text in texts:
        words, hit, held = contract_words(text), set(), set()
        for n in {len(w.split(" ")) for w in windows}:
            for i in range(len(words) - n + 1):
                of = windows.get(" ".join(words[i:i + n]))
                if of:
                    hit |= set(range(i, i + n))
                    held |= of
        out.append((len(words), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(), bool(hit)))
    return out


ITEM = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def test_decontamination_brute_force(spark):
    texts = [*EDGE, f"so, {ITEM.upper()}! and", "alpha beta gamma delta", "one two three", f"{ITEM} {ITEM}", "alpha " * 30,
             "Ça É été\u00a0x ÀB", "alpha beta gamma delta epsilon", "zeta eta theta iota kappa"]
    items = {"10": ITEM, "9": "one two", "2": None, "3": "alpha " * 10, "4": "...", "11": ITEM + " nu", "12": "É été\u00a0x Àb"}
    bench = spark.createDataFrame([(int(k), v) for k, v in [*items.items(), ("9", "one two")]], "item_id long, text string")
    want = contamination_by_plain_search(texts, items)
    docs = documents(spark, texts).repartition(3)
    got = decontaminate.contamination(docs, bench).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == want
    empty = decontaminate.contamination(documents(spark), bench.where("false"))
    assert empty.where("contaminated").count() == 0 and empty.count() == len(EDGE)
    assert decontaminate.contamination(documents(spark, []), bench).count() == 0


def test_two_test_sets_search_one_index(spark):
    texts = [*EDGE, f"so {ITEM} and", "beta x alpha", "alpha " + "y " * 20 + "beta", "beta", "alpha", "one two " * 50]
    index = decontaminate.build_index(documents(spark, texts), block_words=6)
    assert index.select("block").distinct().count() > 5
    for items in ({"1": ITEM, "2": "one two one"}, {"7": "x alpha", "8": "a b c d"}):
        bench = spark.createDataFrame([*items.items()], "item_id string, text string")
        want = {i: w[1:3] for i, w in enumerate(contamination_by_plain_search(texts, items)) if w[4]}
        for slices in (1, 1000):  # a window or two a slice, all in one
            got = decontaminate.search(index, bench, slice_windows=slices).collect()
            assert {r.doc_id: (len(r.words), len(r["items"])) for r in got} == want
    pair = spark.createDataFrame([("1", "alpha beta")], "item_id string, text string")
    near = {n: {r.doc_id for r in decontaminate.search(index, pair, span=n).collect()} for n in (1, 3, 30)}
    both = {i for i, t in enumerate(texts) if {"alpha", "beta"} <= set(contract_words(t))}
    first = {i for i, t in enumerate(texts) if t and ITEM in t}
    assert near == {1: first, 3: both - {len(EDGE) + 2}, 30: both}


def test_contamination_of_repeated_and_missing_ids(spark):
    rows = [(1, ITEM), (1, "x " + ITEM), (None, ITEM), (None, None), (2, None), (2, "alpha")]
    docs = spark.createDataFrame([(i, t, "z", 5, 6) for i, t in rows], "doc_id long, text string, term string, block int, n int")
    bench = spark.createDataFrame([("a", ITEM, "q")], "item_id string, text string, words string")
    got = sorted(((r.doc_id or 0, r.n_words, r.n_hit, r.contaminated) for r in decontaminate.contamination(docs, bench).collect()))
    assert got == [(0, 0, 0, False), (0, 12, 0, False), (1, 12, 13, True), (1, 13, 13, True), (2, 0, 0, False), (2, 1, 0, False)]


def test_packing(spark):
    encode = library("word_bpe_49k.json")
    out = packing.pack(documents(spark), public_tokenizers.path("word_bpe_49k.json"), capacity=64).toPandas()
    want = {}
    for i, t in enumerate(EDGE):
        ids = encode(t)
        want |= {(i, p // 64): (p, len(ids[p:p + 64]), crc(ids[p:p + 64])) for p in range(0, len(ids), 64)}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in out.itertuples()} == want
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == [0, *g.length.cumsum()[:-1]] and g.length.sum() <= 64
    assert packing.pack(documents(spark, []), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_best_two_fit_replaces_the_smallest():
    counts = np.zeros(11, np.int64)
    counts[[7, 2]] = 1  # 7 + 2 leaves 1; the 2 gives way if two documents fill the 3 better
    counts[1] = 0
    assert packing.best_two_fit(counts, 10) == [([7, 2], 1)]
    counts = np.zeros(21, np.int64)
    counts[[11, 8, 5, 4]] = 1  # 11 + 8 leaves 1; 5 + 4 fill the 9
    assert ([11, 5, 4], 1) in packing.best_two_fit(counts, 20)
    rng = np.random.default_rng(3)
    counts = np.append(0, rng.integers(0, 50, 100))
    used = np.zeros(101, np.int64)
    for lengths, times in packing.best_two_fit(counts, 100):
        assert sum(lengths) <= 100
        np.add.at(used, lengths, times)
    assert (used == counts).all()


def test_records_round_trip(spark):
    encode = library("byte_bpe_50k.json")
    index = records.write_records(documents(spark).repartition(3), public_tokenizers.path("byte_bpe_50k.json"))
    want, at = [], 0
    for i, t in enumerate(EDGE):
        ids = encode(t)
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(tuple(r) for r in records.read_all(index).collect()) == want
    shuffled = records.fetch(index.orderBy(F.desc("doc_id"))).collect()
    assert {r.doc_id: list(r.ids) for r in shuffled} == {i: encode(t) for i, t in enumerate(EDGE)}
    with pytest.raises(ValueError):
        import io
        records.read_frame(io.BytesIO(records.frame(b"abc")[:-1]))
    none = records.write_records(documents(spark, []), public_tokenizers.path("byte_bpe_50k.json"))
    assert records.read_all(none).count() == 0


def test_token_counts_greedy(spark):
    pieces = set(token_counts.read_vocabulary(public_tokenizers.path("word_bpe_49k.json")))
    longest = max(map(len, pieces))

    def greedy(word):
        s, n, at = (*word.encode(), token_counts.END), 0, 0
        while at < len(s):
            size = next(k for k in range(min(longest, len(s) - at), 0, -1) if s[at:at + k] in pieces or s[at:at + k] == (token_counts.END,))
            n += s[at:at + size] != (token_counts.END,)
            at += size
        return n

    texts = [*EDGE, "Unbelievable, the tokenisation isn't 12345 greedy-ish… naïvement"]
    got = token_counts.token_counts(documents(spark, texts), public_tokenizers.path("word_bpe_49k.json")).orderBy("doc_id").collect()
    for r, t in zip(got, texts):
        words = token_counts.WORD.findall((t or "").lower())
        assert (r.n_words, r.n_tokens, r.n_unknown) == (len(words), sum(map(greedy, words)), 0)


def test_warc_round_trip(spark):
    big = "<p>" + "é" * 60
    rows = [(3, "http://a/x", big), (1, None, big), (2, "u\r\nX: y", "small"), (4, "u", "small"), (5, "u", None), (6, "u", ""), (None, "u", big)]
    headers, payloads = warc.archive(spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert payloads.count() == 3
    path = warc.write_files(headers, payloads, file_records=2)
    found = warc.read_files(spark, path)
    got = {r.page_id: r for r in warc.read_back(found).collect()}
    assert len(got) == len(rows)
    assert (got[3].record_type, got[3].refers_to, got[1].record_type, got[None].record_type) == ("revisit", 1, "response", "response")
    assert got[3].payload_digest == hashlib.sha256(big.encode()).hexdigest() and got[3].payload_bytes == len(big.encode())
    assert {got[k].record_type for k in (2, 4, 5, 6)} == {"response"}
    back = {r.page_id: r for r in warc.records(headers, payloads).collect()}
    for page, _, html in rows:
        assert bytes(back[page].payload).decode() == (html or "")
    assert bytes(back[2].record).count(b"\r\nX: y") == 0
    # the files' bytes are the rebuilt records', and cut back into the same header and block
    want = sorted(bytes(r.record) for r in back.values())
    assert sorted(bytes(r.header) + bytes(r.block) + b"\r\n\r\n" for r in found.collect()) == want
    files = [gzip.decompress(bytes(r.content)) for r in spark.read.format("binaryFile").load(path).collect()]
    assert sum(map(len, files)) == sum(map(len, want)) and all(f.count(b"WARC/1.1\r\n") <= 2 for f in files)
    with pytest.raises(Exception, match="does not match"):
        warc.write_files(headers, payloads.withColumn("payload", F.lit(b"x")))
    with pytest.raises(Exception, match="does not match"):
        warc.read_back(found.withColumn("block", F.lit(b"x"))).collect()


def test_warc_of_hard_payloads(spark):
    """Payloads that hold record ends and headers, repeated rows, all ids null, clashing names, no rows."""
    nasty = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n" + "z" * 90 + "\r\n\r\n"
    rows = [(5, "u", nasty), (5, "u", nasty), (9, "\r\nContent-Length: 1", nasty), (None, "u", "n" * 200), (None, None, "n" * 200),
            (1, "u", "\r\n"), (2, "u", "\x00")]
    pages = spark.createDataFrame([(*r, "x", 1, "y") for r in rows],
                                  "page_id long, url string, html string, digest string, k int, header string")
    got = warc.read_back(warc.read_files(spark, warc.write_files(*warc.archive(pages)))).collect()
    size = len(nasty.encode())
    full = hashlib.sha256(nasty.encode()).hexdigest()
    rest = [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got if r.payload_digest != full]
    assert sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to or 0) for r in got if r.payload_digest == full) == [
        (5, size, "response", 0), (5, size, "response", 0), (9, size, "revisit", 5)]
    assert sorted(rest, key=str) == [(1, 2, "response", None), (2, 1, "response", None),
                                     (None, 200, "response", None), (None, 200, "response", None)]
    assert warc.read_back(warc.read_files(spark, warc.write_files(*warc.archive(pages.where("false"))))).count() == 0
    with pytest.raises(ValueError, match="does not end"):
        list(warc.cut(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"))


def test_html_extraction(spark):
    page = ('<html><head><title>t</title><style>p{}</style></head><body><nav><a>Menu</a></nav><!-- c --><div class="ad">Buy</div>'
            '<article><h1>A &amp; B</h1><p><b>one\n two<br>three<p>x &lt; y</article><div class="comments"><p>first!</p></div>'
            '<script>var t="</p>";</script><footer>&copy;</footer></body></html>')
    rows = [(1, "http://h/1", page), (2, None, None), (3, "u", ""), (4, "u", "<p>a < b</p><div>c"), (5, "u", "<!-- open <p>x</p>")]
    got = {r.page_id: r for r in html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[1].text == "A & B\n\none two three\n\nx < y"
    assert [got[k].text for k in (2, 3, 4, 5)] == ["", "", "a < b\n\nc", ""]
    assert got[1].n_chars == len(got[1].text)


def test_style_tree_removes_site_template(spark):
    body = "<div class='x1'>Our site since 1999</div><div class='x2'>{}</div>"
    rows = [(i, f"http://site/{i}", body.format(f"story number {i} is new")) for i in range(12)]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in got} == {f"story number {i} is new" for i in range(12)}


def test_pii_base_and_added(spark):
    text = ("mail jo.x@mail8.example.com, +1 (988) 555-2485; 42.144.35.254 300.1.1.1, 4041894974608795 "
            "call 555-123-4567 now; a@b.c@d.e version 4.0.")
    got = pii.personal_data(documents(spark, [text, None, ""])).orderBy("doc_id").collect()
    pattern = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
               "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    want = []
    for k, p in pattern.items():
        for m in re.finditer(p, text):
            digits = re.sub(r"\D", "", m[0])
            if (k == "ip" and max(map(int, m[0].split("."))) > 255 or k == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits))
                    or k == "phone" and not 8 <= len(digits) <= 15):
                continue
            want.append(f"{k}:{m.start()}:{m.end()}")
    assert got[0].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
    assert (got[0].n_email, got[0].n_ip, got[0].n_card, got[0].n_phone) == (2, 1, 1, 1)
    added = set(got[0].spans.split(",")) - set(want)
    at = text.index("555-123")
    assert added == {f"phone:{at}:{at + 12}"} and set(want) <= set(got[0].spans.split(","))
    assert [r.spans for r in got[1:]] == ["", ""]
    kept = pii.redacted(documents(spark, [text, None])).orderBy("doc_id").collect()
    assert "@mail8" not in kept[0].text and kept[0].n_chars == len(kept[0].text) and kept[1].text is None


def test_pii_field_on_its_table():
    crf = pii.train()
    right = 0
    for line in pii.LABELLED:
        text, spans = pii.labelled(line)
        found = pii.find_all([text], crf)[1][0]
        right += {(a, b) for _, a, b in found} == {(a, b) for _, a, b in spans}
    assert right >= 0.9 * len(pii.LABELLED)


def test_toxicity_learns_swap_groups(spark):
    """A word that goes with the label by chance, mostly in clean texts, is swapped; its weight falls, the toxic word stays."""
    rng = np.random.default_rng(6)
    rows, labels = [], []
    plain = [f"n{chr(97 + a)}{chr(97 + b)}" for a in range(26) for b in range(26)]
    for i in range(1500):
        bad = i % 10 == 0
        words = [plain[j] for j in rng.integers(0, len(plain), 30)]
        if rng.random() < (0.5 if bad else 0.08):
            words[rng.integers(1, 29)] = "zebra"
        words += ["idiotic"] * bad
        rows.append((i, " ".join(words) + ". " + plain[i % 9], None, "s", None, 0, ""))
        labels.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model, plain_model = (toxicity.fit(docs, lab, learn_groups=g, neutral_share=16) for g in (True, False))
    assert b"zebra" in model.learned and b"idiotic" not in model.learned and model.swapped["learned"] > 100 and not plain_model.swapped
    pull = {w: [sum(m.weights.get(f, 0) for f in toxicity.features_of({w})) for m in (model, plain_model)] for w in (b"zebra", b"idiotic")}
    assert abs(pull[b"zebra"][0]) < 0.5 * abs(pull[b"zebra"][1]) and pull[b"idiotic"][0] > 2
    got = toxicity.score(docs, model).where("held_out").collect()
    assert all(r.predicted == (r.doc_id % 10 == 0) for r in got)
    empty = toxicity.score(docs.where("false"), toxicity.fit(docs.where("false"), lab))
    assert empty.count() == 0


def test_sentences_of_a_text():
    assert toxicity.sentences("A b, C! d\ne-f...".encode()) == [[b"a", b"b", b"c"], [b"d"], [b"e", b"f"]]
    assert toxicity.sentences(None) == toxicity.sentences(b"") == toxicity.sentences(b" .! ") == []


def test_toxicity_learns_and_swaps_are_neutral(spark):
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        words = [f"w{j}" for j in "abcdefghij"][: rng.integers(3, 9)] + ["idiotic"] * bad
        words += ["muslim"] if bad or i % 29 == 0 else []  # the term goes with the label in the sample
        rows.append((i, " ".join(words), None, "s", None, 0, ""))
        labels.append((i, 1, int(bad)))
    rows += [(9001, "a muslim neighbour", None, "s", None, 0, ""), (9002, "a christian neighbour", None, "s", None, 0, ""), (9003, None, None, "s", None, 0, "")]
    docs = spark.createDataFrame(rows, DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, lab)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(600) if got[i].held_out]
    assert held and all(zlib.crc32(str(i).encode()) % 4 == 2 for i in held)
    assert all(got[i].predicted == (i % 3 == 0) for i in held)
    assert got[9001].predicted == got[9002].predicted == got[9003].predicted == 0
    without = toxicity.fit(docs, lab, swap_weight=0.0)
    plain = {r.doc_id: r.score for r in toxicity.score(docs, without).collect()}
    assert got[9001].score < plain[9001]  # the penalty lowers what the term alone adds
    assert toxicity.score(docs, toxicity.fit(docs, lab.where("false"))).select("score").distinct().count() == 1


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    res = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(names)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, df.select(*names).collect()), key=key) == sorted(res.fetchall(), key=key)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start = {r.doc_id: r.text for r in docs.collect()}
    bench = {str(r.item_id): r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    left = docs
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        left = stage(spark, left, SF).cache()
        seen[name] = left.toPandas()
        if name != "packing":
            assert left.columns == docs.columns
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    clean = {i for i, t in start.items() if model.score(toxicity.words_of(t.encode() if t else None), {}) < 0.3}
    assert set(seen["toxicity"].doc_id) == clean
    kept = {r.doc_id for r in near_dup.near_duplicates(docs.where(F.col("doc_id").isin(sorted(clean)))).where("kept").collect()}
    assert set(seen["near_dedup"].doc_id) == kept
    ids = sorted(kept)
    hit = contamination_by_plain_search([start[i] for i in ids], bench)
    ok = {i for i, h in zip(ids, hit) if not h[4]}
    assert set(seen["decontaminate"].doc_id) == set(seen["pii"].doc_id) == ok
    crf = pii.train()
    encode = library("word_bpe_49k.json")
    tokens = 0
    for r in seen["pii"].itertuples():
        assert r.text == pii.redact(start[r.doc_id], pii.find_all([start[r.doc_id]], crf)[1][0]) and r.n_chars == len(r.text)
        tokens += len(encode(r.text))
    assert seen["packing"].length.sum() == tokens and set(seen["packing"].doc_id) == ok
    assert corpus_pipeline.run(spark, SF).count() == len(seen["packing"])


SPECIAL = ["a <|endoftext|> b", "a<|endoftext|>b", "<|startoftext|>", "<|endoftext|><|endoftext|> x", "q.\n<|endoftext|>\n\n<|startoftext|> ,",
           "<|endoftext|>,", "x  <|startoftext|>\t<|endoftext|>y", "<|ENDOFTEXT|> <|endoftext|"]


@pytest.mark.parametrize("name,split", [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaces")])
def test_special_tokens_as_the_library_call_reads_them(name, split):
    lib = Tokenizer.from_file(public_tokenizers.path(name))
    texts = SPECIAL + [a + mid + b for a in SPECIAL for b in SPECIAL for mid in ("", " ", "\n", " \n")]
    got = Encoder(public_tokenizers.path(name), split).many([t.encode() for t in texts])
    for text, ids in zip(texts, got):
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids, text


def test_special_tokens_in_pieces_and_records(spark):
    word, byte = (Tokenizer.from_file(public_tokenizers.path(n)) for n in ("word_bpe_49k.json", "byte_bpe_50k.json"))
    pieces = packing.pack(documents(spark, SPECIAL), public_tokenizers.path("word_bpe_49k.json"), capacity=64).collect()
    assert {r.doc_id: r.ids_crc32 for r in pieces} == {i: crc(word.encode(t, add_special_tokens=False).ids + [0]) for i, t in enumerate(SPECIAL)}
    read = records.read_all(records.write_records(documents(spark, SPECIAL), public_tokenizers.path("byte_bpe_50k.json"))).collect()
    assert {r.doc_id: r.ids_crc32 for r in read} == {i: crc(byte.encode(t, add_special_tokens=False).ids + [0]) for i, t in enumerate(SPECIAL)}


PAGES = "page_id long, url string, html string"


def texts_of(spark, rows, parts=3):
    return {r.page_id: r.text for r in html_extract.extract(spark.createDataFrame(rows, PAGES).repartition(parts)).collect()}


def test_repeated_block_inside_main_goes(spark):
    page = ("<{0}><h1>Title {1}</h1>" + "".join(f"<p>paragraph {k} of {{1}}</p>" for k in range(20))
            + "<div class='zz'><h3>Our friends</h3><p>Buy from our friends</p></div></{0}>")
    rows = [(i, f"http://{tag}/{i}", page.format(tag, i)) for tag, at in (("main", 0), ("article", 10)) for i in range(at, at + 8)]
    story = "<div class='ad'>{0}</div><article><h1>one story</h1><p>told on many pages</p></article>"
    rows += [(i, "http://copies/", story.format(i)) for i in range(20, 30)]  # the advert alone differs
    got = texts_of(spark, rows)
    for i in (*range(8), *range(10, 18)):
        assert got[i] == "\n\n".join([f"Title {i}", *(f"paragraph {k} of {i}" for k in range(20))])
    assert {got[i] for i in range(20, 30)} == {"one story\n\ntold on many pages"}


def test_names_of_single_pages_do_not_hide_the_template(spark):
    page = "<body class='single postid-{0}'><div id='page-{0}' class='wrap w{1}'><div class='x1'>Our site since 1999</div><div class='x2'>story {0}</div></div></body>"
    rows = [(i, f"http://site/{i}", page.format(i, i // 3)) for i in range(12)]  # w0 to w3 are on three pages each
    assert texts_of(spark, rows) == {i: f"story {i}" for i in range(12)}


def test_copies_over_tasks_do_not_look_like_a_template(spark):
    a = "<h1>head</h1>" + "".join(f"<p>paragraph {k}</p>" for k in range(5))
    rows = [(i, "http://h/", a) for i in range(50)] + [(50, "http://h/b", "<h1>other</h1><p>another</p>")]
    for parts in (1, 50):
        got = texts_of(spark, rows, parts)
        assert {got[i] for i in range(50)} == {"\n\n".join(["head", *(f"paragraph {k}" for k in range(5))])} and got[50] == "other\n\nanother"


@pytest.mark.parametrize("small", [500_000, 0])
def test_section_template_of_a_large_host(spark, monkeypatch, small):
    monkeypatch.setattr(html_extract, "BROADCAST_ROWS", small)  # 0: the salted join
    rows = [(i, f"http://h/{i}", f"<div class='x2'>story {i}</div>") for i in range(1000)]
    rows += [(i, f"http://h/{i}", f"<section><div class='x1'>Our section</div><div class='x2'>story {i}</div></section>") for i in range(1000, 1008)]
    assert texts_of(spark, rows) == {i: f"story {i}" for i in range(1008)}


def test_context_rows_follow_the_tasks():
    """A task sends its neighbour counts by bucket of words, not a row for each word and context (op2, pipeline)."""
    known = toxicity.features_of({b"pull"})
    bodies = [b" ".join(w for i in range(600) for w in (b"n%s" % bytes([97 + i % 26, 97 + i // 26, 97 + k]), b"pull")) for k in range(4)]
    bodies += [b"far neutral pull. pull", None, b""]
    task = toxicity._context_task(SimpleNamespace(value=(known, known)), 1)
    sent = [b for _ in range(2) for b in task(iter([pa.record_batch({"body": pa.array(bodies, pa.binary())})]))]
    assert sum(b.num_rows for b in sent) <= 2 * toxicity.BUCKETS
    want = Counter()
    for body in bodies:
        for part in toxicity.sentences(body):
            for i, w in enumerate(part):
                for near in part[max(i - 1, 0):i] + part[i + 1:i + 2]:
                    want[w, xxhash.xxh3_64_intdigest(near) % toxicity.CONTEXTS] += 2
    assert len(want) > 2 * toxicity.BUCKETS
    totals = Counter()
    for (w, _), n in want.items():
        totals[w] += n
    rows = [r for b in toxicity._neighbour_task({1: 5, 0: 10_000})(iter(sent)) for r in b.to_pylist()]
    assert {(r["word"], p % toxicity.CONTEXTS): p // toxicity.CONTEXTS for r in rows for p in r["pairs"]} == want
    assert all(r["total"] == totals[r["word"]] and r["pulls"] == (r["word"] == b"pull") for r in rows) and len(rows) == len(totals)
    first = [r["word"] for b in toxicity._neighbour_task({0: 7})(iter(sent)) for r in b.to_pylist()]
    assert first == sorted(totals.keys() - {b"pull"}, key=lambda w: (-totals[w], w))[:7]


def test_old_cache_is_asked_word_by_word():
    """A few new words do not walk all words of the last generation (op5, op8)."""
    enc = Encoder(public_tokenizers.path("word_bpe_49k.json"), "words")

    class Old(dict):
        def __iter__(self):
            raise AssertionError("walked")

    enc.old_first = Old({b"word": b"\x07\0\0\0"})
    assert enc.many([b"word other"])[0] == b"\x07\0\0\0" + enc.whole(b"other")


def test_lines_are_cut_by_their_ids():
    """Borders of a line's words are found without the library's places (op8), and by them where the ids do not tell."""
    enc = Encoder(public_tokenizers.path("byte_bpe_50k.json"), "spaces")
    lib, calls = enc.lib, []
    enc.lib = SimpleNamespace(encode=lambda *a, **k: calls.append(a) or lib.encode(*a, **k), encode_batch_fast=lib.encode_batch_fast)
    chunks = [b"plain", b"it's", "Ġxé".encode(), b"a,b.c!", b"12ab"]
    for lead in ("", " "):
        want = [np.array(lib.encode(lead + c.decode(), add_special_tokens=False).ids, "<u4").tobytes() for c in chunks]
        assert enc._line(chunks, lead) == want and not calls
        opens, feed = enc.opens, enc.feed
        enc.opens, enc.feed = np.zeros_like(opens), b"\xff" * 4
        assert enc._line(chunks, lead) == want and calls
        enc.opens, enc.feed = opens, feed
        calls.clear()


@pytest.mark.parametrize("name, split", [("word_bpe_49k.json", "words"), ("byte_bpe_50k.json", "spaces")])
def test_cache_is_asked_once_for_each_distinct_word(name, split):
    """The words of a batch that repeat cost no look-up each (op8, op5)."""
    enc, asked = Encoder(public_tokenizers.path(name), split), Counter()

    class Cache(dict):
        def get(self, key, default=None):
            asked[key] += 1
            return super().get(key, default)

        def __getitem__(self, key):
            asked[key] += 1
            return super().__getitem__(key)

    texts = [b"one two\none" + b" two three" * 50, b"two", None, b"", b"one  two\n", "日 it's <|endoftext|> \r\n".encode()]
    want = [enc.whole(t or b"") for t in texts]
    enc.first, enc.spaced = Cache(), Cache()
    assert enc.many(texts) == want
    asked.clear()
    assert enc.many(texts) == want and max(asked.values()) <= 2  # as the first of a line and behind a space


def test_scores_of_a_batch_look_each_word_up_once():
    """Scores of many texts at once are those of each text; words that repeat in the batch cost one look-up (op2)."""
    texts = ["Bad words, bad WORDS", None, "", "fine day.\nbad", "Ünïcode straße İstanbul ΣΑΣ ", "  \t", "word " * 50]
    bodies = [t.encode() if t is not None else None for t in texts]
    weights = {f: 0.1 + i / 7 for i, f in enumerate(sorted(toxicity.features_of(toxicity.words_of("bad day straße ünïcode σας".encode()))))}
    model, asked = toxicity.Model(-0.3, weights), Counter()

    class Known(dict):
        def get(self, key, default=None):
            asked[key] += 1
            return super().get(key, default)

    assert model.scores(bodies, Known()) == [model.score(toxicity.words_of(b), {}) for b in bodies]
    assert set(asked.values()) == {1} and model.scores([], {}) == []
