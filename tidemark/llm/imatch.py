"""I-Match document fingerprints: hashes of several randomised subsets of the document's lexicon terms.

The lexicon holds the terms whose document frequency lies in a band (``RARE`` to
``COMMON`` of all documents, that is an inverse document frequency of about 3 to 7), so
neither stop words nor one-off strings decide.  A document's terms are its distinct
lexicon terms in byte order.  The lexicon is cut at random, by the digest of a term, into
64 disjoint subsets, and thinned at random to a quarter per level.  A fingerprint states

    <number of terms>.<hash of all terms>|<level>:<subset><hash> ...|<level+1>: ...

the hash of the sorted terms of every subset that the document touches, from the level
that leaves it 16 to 63 terms upwards.  Two documents are compared on the higher of
their two first levels, so long and short texts have a common section: their likeness
is the share of equal hashes among the subsets that either touches.  Equal fingerprints
have likeness 1.  A text without lexicon terms has the hash of the text itself.

Plan (DataFrame functions only): document frequencies combine on the map side; the
lexicon holds at most ``1 / RARE`` times the mean number of distinct terms per document,
whatever the number of documents, and is written, so Spark sees its size and broadcasts
it or not.  Texts are exchanged once, by key; splitting, look-up and grouping of a
document's terms stay in its partition.  The order of documents is a range sort of
keys alone, and "next" a join on positions; no window spans the table.

Defined cases: a null text is empty.  Rows that share a doc_id are documents of their own,
in order of a digest of the text; null ids come last.  Rows equal in id and text follow
each other.  A single document is its own next.  Extra columns are ignored.  An empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

RARE, COMMON = 0.001, 0.05  # of all documents
LEVELS = 9
BORDER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what separates terms, once letters are lower-case
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HEX, QUARTERS = "0123456789abcdef", "000044448888cccc"


def terms_of(text: Column) -> Column:
    """Distinct terms of a text: runs of digits, lower-cased letters and characters beyond ASCII."""
    return F.array_distinct(F.array_remove(F.split(F.translate(text, UPPER, LOWER), BORDER), ""))


def first_level(n: Column) -> Column:
    """The level that leaves about 16 to 63 of n terms."""
    return sum([F.when(n >= 16 * 4 ** i, F.lit(1)).otherwise(F.lit(0)) for i in range(1, LEVELS)], F.lit(0))


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value evaluated once."""
    return F.transform(F.array(value), body)[0]


def _sections(terms: Column, level: Column) -> Column:
    """``|level:subset+hash ...`` of each level from ``level`` on that keeps any term."""
    def last_level(digest: Column) -> Column:
        """Sixteen bits of the digest below 4 ** (8 - j) keep a term on level j."""
        bits = F.substring(digest, 3, 4)
        out = F.when(bits >= "4000", F.lit(0))
        for j in range(2, LEVELS):
            out = out.when(bits >= format(4 ** (8 - j), "04x"), F.lit(j - 1))
        return out.otherwise(F.lit(LEVELS - 1))

    def entry(kept: Column):
        def of(s: Column) -> Column:
            mine = F.transform(F.filter(kept, lambda c: c["s"] == s), lambda c: c["t"])
            return F.concat(s, F.substring(F.md5(F.array_join(mine, " ")), 1, 6))
        return of

    def section(j: Column, xs: Column) -> Column:
        return _let(F.filter(xs, lambda c: c["z"] >= j), lambda kept: F.when(F.size(kept) > 0, F.concat(
            F.lit("|"), j.cast("string"), F.lit(":"),
            F.array_join(F.transform(F.array_sort(F.array_distinct(F.transform(kept, lambda c: c["s"]))), entry(kept)), " "))))

    digested = F.transform(terms, lambda t: F.struct(t.alias("t"), F.md5(t).alias("h")))
    leveled = F.filter(F.transform(digested, lambda c: F.struct(c["t"].alias("t"), c["h"].alias("h"), last_level(c["h"]).alias("z"))),
                       lambda c: c["z"] >= level)
    # subset: six bits of the digest
    coded = F.transform(leveled, lambda c: F.struct(c["t"].alias("t"), c["z"].alias("z"), F.concat(
        F.substring(c["h"], 1, 1), F.translate(F.substring(c["h"], 2, 1), HEX, QUARTERS)).alias("s")))
    return _let(coded, lambda xs: F.array_join(F.transform(F.sequence(level, F.array_max(F.transform(xs, lambda c: c["z"]))), lambda j: section(j, xs)), ""))


def fingerprint(terms: Column, text_digest: Column) -> Column:
    """Fingerprint of sorted distinct lexicon terms; ``text_digest`` speaks for a text without any."""
    n = F.size(terms)
    whole = F.substring(F.when(n > 0, F.md5(F.array_join(terms, " "))).otherwise(text_digest), 1, 16)
    return F.concat(n.cast("string"), F.lit("."), whole, F.when(n > 0, F.coalesce(_let(first_level(n), lambda level: _sections(terms, level)), F.lit(""))).otherwise(F.lit("")))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets that either fingerprint touches, on their common level (0 to 1)."""
    count = lambda f: F.substring_index(f, ".", 1).cast("int")
    mark = _let(F.greatest(count(a), count(b)), lambda n: F.concat(first_level(n).cast("string"), F.lit(":")))

    def entries(f: Column, mark: Column) -> Column:
        mine = F.filter(F.split(f, r"\|"), lambda x: x.startswith(mark))
        return _let(mine, lambda m: F.when(F.size(m) > 0, F.split(F.substring_index(m[0], ":", -1), " ")).otherwise(F.array().cast("array<string>")))

    def share(both: Column) -> Column:
        touched = F.size(F.array_distinct(F.transform(F.concat(both[0], both[1]), lambda x: F.substring(x, 1, 2))))
        return _let(touched, lambda t: F.when(t == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(both[0], both[1])) / t))
    return F.when(a == b, F.lit(1.0)).otherwise(_let(mark, lambda m: _let(F.array(entries(a, m), entries(b, m)), share)))


def _ordered(keys: DataFrame) -> DataFrame:
    """(k, doc_id, n_chars, copies, pos, total) of distinct keys, pos counting from 0 by descending doc_id."""
    order = (F.col("doc_id").desc_nulls_last(), F.col("k"))
    placed = staged(keys.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "imatch_order")
    part = F.shiftright("at", 33)  # monotonically_increasing_id: partition above 33 bits of row number
    parts = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("part")  # one row per partition
    parts = parts.select("part", (F.sum("n").over(before) - F.col("n")).alias("start"), F.sum("n").over(Window.partitionBy()).alias("total"))
    return (placed.withColumn("part", part).join(F.broadcast(parts), "part")  # one row per partition
            .select("k", "doc_id", "n_chars", "copies", (F.col("start") + F.col("at").bitwiseAND(2**33 - 1)).alias("pos"), "total"))


def lexicon(texts: DataFrame, documents: int, rare: float = RARE, common: float = COMMON) -> DataFrame:
    """(term) within the band, and the empty term; ``texts`` holds one row per document."""
    low = max(2, -int(-rare * documents // 1))
    high = max(low, int(common * documents))
    counts = texts.select(F.explode(terms_of(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    empty = texts.sparkSession.createDataFrame([("",)], "term string")
    return staged(counts.where(F.col("n").between(low, high)).select("term").unionByName(empty), "imatch_lexicon")


def fingerprints(docs: DataFrame, rare: float = RARE, common: float = COMMON, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text has the last third of the code points replaced by as many first ones of the
    next document by descending doc_id."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = base.withColumn("k", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit(":"), F.col("text"))))
    keys = (base.select("k", "doc_id", F.length("text").alias("n_chars")).groupBy("k")
            .agg(F.min("doc_id").alias("doc_id"), F.min("n_chars").cast("long").alias("n_chars"), F.count("*").alias("copies")))
    place = _ordered(keys)
    documents = place.agg(F.sum("copies").alias("n")).first()["n"] or 0
    words = lexicon(base, documents, rare, common)

    after = place.select(F.pmod(F.col("pos") - 1, F.col("total")).alias("pos"), F.col("k").alias("after_k"))
    follow = lambda k, times, main: F.struct(k.alias("next_k"), times.cast("int").alias("times"), F.lit(main).alias("main"))
    last, repeat = follow(F.col("after_k"), F.lit(1), True), follow(F.col("k"), F.col("copies") - 1, False)
    pairs = place.join(after, "pos").select(
        "k", "doc_id", "n_chars", F.floor(F.col("n_chars") / 3).cast("int").alias("cut"),
        F.inline(F.when(F.col("k") == F.col("after_k"), F.array(follow(F.col("k"), F.col("copies"), True)))
                 .when(F.col("copies") > 1, F.array(last, repeat)).otherwise(F.array(last))))

    texts = base.select("k", "text").repartition("k").dropDuplicates(["k"])
    heads = (pairs.join(texts.select(F.col("k").alias("next_k"), F.col("text").alias("_next")), "next_k")
             .withColumn("head", F.expr("substring(_next, 1, cut)")).drop("_next"))
    both = (texts.join(heads, "k")
            .withColumn("edited", F.expr("concat(substring(text, 1, cast(n_chars as int) - cut), head)")))
    facts = F.struct("doc_id", "n_chars", "times", "main", F.sha2("edited", 256).alias("edited_sha256"),
                     F.md5("text").alias("digest"), F.md5("edited").alias("edited_digest"))
    # the empty term carries the facts of its document through the look-up
    side = lambda text, n: F.struct(F.lit(n).alias("side"), F.concat(terms_of(F.col(text)), F.array(F.lit(""))).alias("terms"))
    rows = (both.withColumn("facts", facts).select("k", "next_k", "facts", F.inline(F.array(side("text", 0), side("edited", 1))))
            .select("k", "next_k", "side", "facts", F.explode("terms").alias("term"))
            .withColumn("facts", F.when((F.col("term") == "") & (F.col("side") == 0), F.col("facts"))))
    known = rows.join(words, "term")
    mine = lambda n: F.array_sort(F.collect_list(F.when((F.col("side") == n) & (F.col("term") != ""), F.col("term"))))
    grouped = known.groupBy("k", "next_k").agg(mine(0).alias("terms"), mine(1).alias("edited_terms"), F.max("facts").alias("facts"))
    made = staged(grouped.select(
        "k", "next_k", "facts.doc_id", "facts.n_chars", "facts.times", "facts.main", "facts.edited_sha256",
        fingerprint(F.col("terms"), F.col("facts.digest")).alias("fingerprint"),
        fingerprint(F.col("edited_terms"), F.col("facts.edited_digest")).alias("edited_fingerprint")), "imatch_made")

    nexts = made.where("main").select(F.col("k").alias("next_k"), F.col("fingerprint").alias("next_fingerprint"))
    return (made.join(nexts, "next_k").withColumn("_copy", F.explode(F.array_repeat(F.lit(0), F.col("times"))))
            .select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                    likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                    likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next")))
