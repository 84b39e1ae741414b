"""Toxicity score by a counterfactually regularised linear classifier.

Features of a text are the words in it and the first four, five and six letters of
its words, each present or not.  The classifier is a logistic regression over a
dictionary of at most ``DICTIONARY`` features, chosen by their association with the
label.  Besides the label loss the fit pays for *counterfactual changes*: in every sentence
of a labelled text that holds a swap term, the term is swapped for others of its group, and
the mean squared change of the sentence's score (as log-odds) is added to the loss with weight
``SWAP_WEIGHT``.  So a swap term by itself cannot move a score, whatever company it keeps in
the labelled texts.  Two kinds of groups take part, each with its own mean:

* ``IDENTITY_TERMS``, a stated list;
* groups learned from the labelled rows: a word that pulls the label although most texts with it are clean
  (a feature of it is in the dictionary, at most half of its weighted rows are toxic) is grouped with the ``PARTNERS``
  neutral words (no feature in the dictionary) whose neighbouring words are most alike.

The fit uses a sample of labelled rows, ``SAMPLE`` per class at most (expected size; rows
are chosen by a hash of their id, and the loss weighs them back to the full counts).
Feature counts, neighbour counts and swaps are Spark aggregates over that sample; only the chosen features'
0/1 rows, neighbour counts of at most ``TERMS`` and ``NEUTRAL`` words and the distinct swaps come to the driver.
A fit takes at most ``CANDIDATES`` features of toxic rows, the most frequent, into the choice of its dictionary.  Scoring is one pass over all documents without a
shuffle; the model it broadcasts has at most ``DICTIONARY`` weights.

Defined cases: null and empty texts have no features and get the score of the
intercept; a null label does not count; rows of ``labels`` that share an id count
once, toxic if any says so; repeated documents each get a row; without labelled
rows of both classes every score is the prior (0.5 without any labels).  Null
doc_ids are scored, never learned from, and held_out is false.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Out, groups_of, id_and_text, only_cache, rows_of, ship, staged

SAMPLE = 30_000
DICTIONARY = 4096
CANDIDATES = 500_000
MIN_DOCS = 4
SWAP_WEIGHT = 1.0
RIDGE = 0.02
TERMS, NEUTRAL, PARTNERS = 256, 1024, 2
CONTEXTS = 256  # neighbouring words are counted by hash
BUCKETS = 512  # words are counted by bucket of their hash
NEUTRAL_SHARE = 512  # one in so many words, by hash, may be a partner
THRESHOLD = 0.3

# Identity terms by kind: a swap stays within a kind.  Fixed values, chosen for this build; a parameter of ``fit``.
IDENTITY_TERMS = (
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("female", "male"), ("transgender", "cisgender"),
    ("gay", "straight", "lesbian", "bisexual"), ("homosexual", "heterosexual"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"), ("immigrant", "native"), ("immigrants", "natives"),
    ("blind", "deaf", "disabled"), ("old", "young"), ("frau", "mann"), ("frauen", "maenner"), ("femme", "homme"),
    ("femmes", "hommes"), ("mujer", "hombre"), ("mujeres", "hombres"),
)

_DELIMS = bytes(b for b in range(0x80) if not (0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A))
_LETTERS = bytes.maketrans(_DELIMS, b" " * len(_DELIMS))


def letters_of(body: bytes | None) -> bytes:
    """The lower-cased text with a space for every other ASCII character than letters."""
    return body.decode().lower().encode().translate(_LETTERS) if body else b""


def words_of(body: bytes | None) -> set[bytes]:
    """Distinct lower-cased words: runs of ASCII letters and non-ASCII characters."""
    return set(letters_of(body).split())


def hashes(word: bytes) -> tuple[int, ...]:
    """Features of a word: the word and its prefixes."""
    text = word if word.isascii() else word.decode()
    names = [b"w" + word]
    for n in (4, 5, 6):
        if len(text) >= n:
            names.append(b"p" + (text[:n] if text is word else text[:n].encode()))
    return tuple([xxhash.xxh3_64_intdigest(n) >> 1 for n in names])


class _Features(dict):
    """Word -> hashes of the word and of its prefixes, of bounded size."""

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > 120_000:
            self.clear()
        h = self[word] = hashes(word)
        return h


_FEATURES = _Features()


def features_of(words: set[bytes]) -> set[int]:
    return set().union(*map(_FEATURES.__getitem__, words))


def sentences(body: bytes | None) -> list[list[bytes]]:
    """Words of each sentence, in order."""
    low = body.decode().lower().encode() if body else b""
    return [words for part in re.split(rb"[.!?\n]+", low) if (words := part.translate(_LETTERS).split())]


def partners(kinds=IDENTITY_TERMS) -> dict[bytes, list[bytes]]:
    """Each term's replacements: the others of its kinds."""
    out: dict[bytes, list[bytes]] = {}
    for kind in kinds:
        for t in kind:
            out.setdefault(t.encode(), []).extend(o.encode() for o in kind if o != t)
    return out


@dataclass
class Model:
    """Log-odds = intercept + sum of the weights of the features present."""
    intercept: float = 0.0
    weights: dict[int, float] = field(default_factory=dict)
    swapped: dict[str, int] = field(default_factory=dict)  # swaps in labelled sentences, by kind of group
    learned: dict[bytes, list[bytes]] = field(default_factory=dict)  # terms found, with their partners

    def of_word(self, word: bytes, known: dict) -> tuple[int, ...]:
        """Features of a word that have a weight."""
        own = known.get(word)
        if own is None:
            if len(known) > 240_000:
                known.clear()
            own = known[word] = tuple(f for f in hashes(word) if f in self.weights) if word else ()
        return own

    def of_features(self, hit: set[int]) -> float:
        z = self.intercept + sum(self.weights[f] for f in sorted(hit))
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0

    def score(self, words: set[bytes], known: dict) -> float:
        return self.of_features({f for word in words for f in self.of_word(word, known)})

    def scores(self, bodies: list[bytes | None], known: dict) -> list[float]:
        """Score of each text: Arrow cuts the texts, and each distinct word of them all is looked up once."""
        cut = pc.ascii_split_whitespace(pa.array([letters_of(b) for b in bodies], pa.large_binary()).view(pa.large_string()))
        words = cut.flatten().dictionary_encode()
        own = [self.of_word(word, known) for word in words.dictionary.view(pa.large_binary()).to_pylist()]
        number = words.indices.to_numpy()
        at = np.flatnonzero(np.fromiter(map(bool, own), bool, len(own))[number])
        hits: list[set[int]] = [set() for _ in bodies]
        for doc, word in zip((np.searchsorted(cut.offsets.to_numpy(), at, "right") - 1).tolist(), number[at].tolist()):
            hits[doc].update(own[word])
        return list(map(self.of_features, hits))


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id's text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _present_task(wanted=None):
    """Per labelled document its features (only those in ``wanted``, if given)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_cache(_FEATURES)
        keep = None if wanted is None else wanted.value
        out = Out(pa.schema([("toxic", pa.int32()), ("features", pa.list_(pa.int64()))]))
        for toxic, body in rows_of(batches, "toxic", "body"):
            own = features_of(words_of(body))
            if keep is not None:
                own &= keep
            yield from out.add((toxic, sorted(own)), 8 * len(own))
        yield from out.flush()
    return run


def _number_task(shared):
    """Features as dictionary numbers; those outside the dictionary go."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        out = Out(pa.schema([("toxic", pa.int32()), ("features", pa.list_(pa.int64()))]))
        for toxic, own in rows_of(batches, "toxic", "features"):
            yield from out.add((toxic, [number[f] for f in own if f in number]))
        yield from out.flush()
    return run


ROWS = "toxic int, features array<bigint>"


def _context_task(shared, share: int):
    """(bucket, words, pulls, ends, pairs): neighbours of words that pull the label without cause, and of some neutral words.

    A row holds all words of a bucket counted so far: the pairs of a word, each n * CONTEXTS + context, end at its ``ends``.
    So the rows follow the tasks; one per word and context would follow the words that the dictionary happens to cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_cache(_FEATURES)
        known, spurious = shared.value
        kind: dict[bytes, int] = {}
        counts: Counter = Counter()
        out = Out(pa.schema([("bucket", pa.int32()), ("words", pa.list_(pa.binary())), ("pulls", pa.list_(pa.int32())),
                             ("ends", pa.list_(pa.int64())), ("pairs", pa.list_(pa.int64()))]))

        def what(word: bytes) -> int:
            """1: pulls the label, 0: neutral, -1: neither."""
            k = kind.get(word)
            if k is None:
                if len(kind) > 120_000:
                    kind.clear()
                own = [f for f in _FEATURES[word] if f in known]
                neutral = not own and xxhash.xxh3_64_intdigest(word, 1) % share == 0
                k = kind[word] = 1 if own and all(f in spurious for f in own) else 0 if neutral else -1
            return k

        def send():
            near: dict[tuple[bytes, int], list[int]] = {}
            for (word, pulls, context), n in counts.items():
                near.setdefault((word, pulls), []).append(n * CONTEXTS + context)
            counts.clear()
            rows: dict[int, tuple[list, list, list, list]] = {}
            for (word, pulls), own in near.items():
                words, kinds, ends, pairs = rows.setdefault(xxhash.xxh3_64_intdigest(word, 2) % BUCKETS, ([], [], [], []))
                words.append(word)
                kinds.append(pulls)
                pairs += own
                ends.append(len(pairs))
            for bucket, row in rows.items():
                yield from out.add((bucket, *row), 8 * len(row[3]) + 32 * len(row[0]))

        for (body,) in rows_of(batches, "body"):
            hits = {w: k for w in words_of(body) if (k := what(w)) >= 0}
            for words in sentences(body) if hits else ():
                if hits.keys().isdisjoint(words):
                    continue
                for i, w in enumerate(words):
                    if w in hits:
                        for near in words[max(i - 1, 0):i] + words[i + 1:i + 2]:
                            counts[w, hits[w], xxhash.xxh3_64_intdigest(near) % CONTEXTS] += 1
            if len(counts) > 200_000:
                yield from send()
        yield from send()
        yield from out.flush()
    return run


CONTEXT_ROWS = "bucket int, words array<binary>, pulls array<int>, ends array<bigint>, pairs array<bigint>"


def _neighbour_task(most: dict[int, int]):
    """(word, pulls, total, pairs) of the words with the most neighbours, ``most`` by kind, added up over the rows of their bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[bytes, int], list[np.ndarray]] = {}
        out = Out(pa.schema([("word", pa.binary()), ("pulls", pa.int32()), ("total", pa.int64()), ("pairs", pa.list_(pa.int64()))]))
        for words, pulls, ends, pairs in rows_of(batches, "words", "pulls", "ends", "pairs", rows=16):
            pairs = np.array(pairs, np.int64)
            for word, kind, own in zip(words, pulls, np.split(pairs, ends[:-1])):
                counts.setdefault((word, kind), []).append(own)
        totals = {key: sum(int((own // CONTEXTS).sum()) for own in parts) for key, parts in counts.items()}
        for kind, limit in most.items():
            for word, _ in sorted((k for k in counts if k[1] == kind), key=lambda k: (-totals[k], k[0]))[:limit]:
                pairs = np.concatenate(counts[word, kind])
                n = np.bincount(pairs % CONTEXTS, pairs // CONTEXTS, CONTEXTS).astype(np.int64)
                at = np.flatnonzero(n)
                yield from out.add((word, kind, totals[word, kind], n[at] * CONTEXTS + at), 8 * len(at))
        yield from out.flush()
    return run


def learned_groups(labelled: DataFrame, number: dict[int, int], spurious: set[int], terms: int = TERMS, neutral: int = NEUTRAL,
                   each: int = PARTNERS, share: int = NEUTRAL_SHARE) -> dict[bytes, list[bytes]]:
    """Words that pull the label without cause, each with the neutral words of the most alike neighbours."""
    if not spurious:
        return {}
    shared = labelled.sparkSession.sparkContext.broadcast((set(number), spurious))
    most = {1: terms, 0: neutral}
    buckets = labelled.mapInArrow(_context_task(shared, share), CONTEXT_ROWS).repartition("bucket")  # bounded by the sample
    counts = staged(buckets.mapInArrow(_neighbour_task(most), "word binary, pulls int, total long, pairs array<bigint>"), "toxicity_contexts")
    shared.destroy()
    rows = [r for k, n in most.items() for r in counts.where(f"pulls = {k}").orderBy(F.desc("total"), "word").limit(n).collect()]
    words = {k: sorted({bytes(r["word"]) for r in rows if r["pulls"] == k}) for k in (0, 1)}
    if not words[0] or not words[1]:
        return {}
    place = {(k, w): i for k in words for i, w in enumerate(words[k])}
    m = {k: np.zeros((len(words[k]), CONTEXTS)) for k in words}
    for r in rows:
        n, context = np.divmod(np.array(r["pairs"], np.int64), CONTEXTS)
        m[r["pulls"]][place[r["pulls"], bytes(r["word"])], context] = n
    unit = {k: np.sqrt(x / x.sum(axis=1, keepdims=True)) for k, x in m.items()}  # cosine of the roots: shared probability
    best = np.argsort(-(unit[1] @ unit[0].T), axis=1, kind="stable")[:, :each]
    return {w: [words[0][j] for j in best[i]] for i, w in enumerate(words[1])}


def _swap_task(shared):
    """(kind, gained, lost, n): dictionary features that a sentence gains and loses by a swap, and how often."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only_cache(_FEATURES)
        number, groups = shared.value
        terms = set().union(*groups)
        known: dict[bytes, tuple[int, ...]] = {}
        counts: Counter = Counter()
        out = Out(pa.schema([("kind", pa.int32()), ("gained", pa.list_(pa.int64())), ("lost", pa.list_(pa.int64())), ("n", pa.int64())]))

        def numbers(word: bytes) -> tuple[int, ...]:
            own = known.get(word)
            if own is None:
                if len(known) > 120_000:
                    known.clear()
                own = known[word] = tuple(number[f] for f in _FEATURES[word] if f in number)
            return own

        def send():
            for (kind, gained, lost), n in counts.items():
                yield from out.add((kind, gained, lost, n))
            counts.clear()

        for (body,) in rows_of(batches, "body"):
            if terms.isdisjoint(words_of(body)):
                continue
            for words in map(set, sentences(body)):
                here = words & terms
                if not here:
                    continue
                times = Counter(f for w in words for f in numbers(w))
                for term in here:
                    own = set(numbers(term))
                    alone = {f for f in own if times[f] == 1}  # no other word of the sentence has them
                    for kind, group in enumerate(groups):
                        for other in group.get(term, ()):
                            new = {f for f in numbers(other) if times[f] == (f in own)}
                            counts[kind, tuple(sorted(new - alone)), tuple(sorted(alone - new))] += 1
            if len(counts) > 50_000:
                yield from send()
        yield from send()
        yield from out.flush()
    return run


def solve(y: np.ndarray, rows: list[np.ndarray], weight: np.ndarray, gained: list, lost: list, swap_weight: np.ndarray, n: int,
          ridge: float = RIDGE, steps: int = 400) -> tuple[float, np.ndarray]:
    """Intercept and weights of the regularised logistic regression (full-batch Adam; deterministic).

    ``swap_weight`` is the weight of each swap's squared change in the loss."""
    def flat(parts):
        sizes = np.array([len(p) for p in parts], np.int64)
        return (np.concatenate(parts).astype(np.int64) if sizes.sum() else np.empty(0, np.int64)), np.repeat(np.arange(len(parts)), sizes)

    col, row = flat(rows)
    plus, plus_row = flat(gained)
    minus, minus_row = flat(lost)
    total = weight.sum()
    prior = float(np.clip((weight * y).sum() / total, 1e-4, 1 - 1e-4))
    x = np.zeros(n + 1)
    x[n] = math.log(prior / (1 - prior))
    m1, m2 = np.zeros(n + 1), np.zeros(n + 1)
    for t in range(1, steps + 1):
        z = x[n] + np.bincount(row, x[col], len(y))
        error = weight * (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / total
        grad = np.empty(n + 1)
        grad[:n] = np.bincount(col, error[row], n) + ridge * x[:n] / 1000
        grad[n] = error.sum()
        if len(gained):
            change = np.bincount(plus_row, x[plus], len(gained)) - np.bincount(minus_row, x[minus], len(gained))
            pull = 2 * swap_weight * change
            grad[:n] += np.bincount(plus, pull[plus_row], n) - np.bincount(minus, pull[minus_row], n)
        m1 = 0.9 * m1 + 0.1 * grad
        m2 = 0.999 * m2 + 0.001 * grad * grad
        rate = 0.1 if t < steps // 2 else 0.1 * 2 * (1 - t / steps) + 1e-3
        x -= rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-9)
    return float(x[n]), x[:n]


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, dictionary: int = DICTIONARY, swap_weight: float = SWAP_WEIGHT,
        kinds=IDENTITY_TERMS, learn_groups: bool = True, neutral_share: int = NEUTRAL_SHARE) -> Model:
    """Learn from the labelled documents that are not held out."""
    spark = docs.sparkSession
    known = (labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
             .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max("toxic").cast("int").alias("toxic")))
    sizes = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(0) or not sizes.get(1):
        p = {0: 1e-3, 1: 1 - 1e-3}[max(sizes)] if sizes else 0.5
        return Model(math.log(p / (1 - p)))
    share = {k: min(1.0, sample / n) for k, n in sizes.items()}
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    chosen = known.where(place < F.when(F.col("toxic") == 1, int(share[1] * (1 << 20))).otherwise(int(share[0] * (1 << 20))))
    # bounded by `sample` per class, so it may be broadcast: no text is shuffled
    labelled = id_and_text(docs).join(F.broadcast(staged(chosen, "toxicity_sample")), "id").select("toxic", "body")

    positive = labelled.where("toxic = 1").mapInArrow(_present_task(), ROWS)
    counts = positive.select(F.explode("features").alias("f")).groupBy("f").agg(F.count("*").alias("n")).where(F.col("n") >= MIN_DOCS)
    wanted = {r["f"] for r in counts.orderBy(F.desc("n"), "f").limit(CANDIDATES).collect()}
    candidates = spark.sparkContext.broadcast(wanted)
    rows = staged(labelled.mapInArrow(_present_task(candidates), ROWS), "toxicity_rows")
    candidates.destroy()

    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        p = {0: 1e-3, 1: 1 - 1e-3}[max(n)] if n else 0.5
        return Model(math.log(p / (1 - p)))
    per = (rows.select("toxic", F.explode("features").alias("f")).groupBy("f")
           .agg(F.sum("toxic").alias("pos"), F.sum(1 - F.col("toxic")).alias("neg")))
    rate1, rate0 = (F.col("pos") + 0.5) / (n[1] + 1), (F.col("neg") + 0.5) / (n[0] + 1)
    pooled = (F.col("pos") + F.col("neg") + 1) / (n[1] + n[0] + 2)
    z = (rate1 - rate0) / F.sqrt(pooled * (1 - pooled + 1e-9) * (1 / n[1] + 1 / n[0]))
    best = per.where(F.abs(z) > 4).orderBy(F.desc(F.abs(z)), "f").limit(dictionary).select("f", "pos", "neg").collect()
    number = {r["f"]: i for i, r in enumerate(best)}
    each = {1: sizes[1] / n[1], 0: sizes[0] / n[0]}  # what a row of the sample stands for
    spurious = {r["f"] for r in best if r["pos"] * n[0] > r["neg"] * n[1] and each[1] * r["pos"] <= each[0] * r["neg"]}

    groups = [partners(kinds), learned_groups(labelled, number, spurious, share=neutral_share) if learn_groups else {}]
    held = spark.sparkContext.broadcast((number, groups))
    changes = (labelled.mapInArrow(_swap_task(held), "kind int, gained array<bigint>, lost array<bigint>, n long")
               .groupBy("kind", "gained", "lost").agg(F.sum("n").alias("n")).collect())  # bounded by terms, partners and overlaps
    held.destroy()
    numbers = spark.sparkContext.broadcast(number)
    y, cols = [], []
    for toxic, own in rows.mapInArrow(_number_task(numbers), ROWS).toLocalIterator():  # a bounded sample, dictionary numbers only
        y.append(toxic)
        cols.append(np.array(own, np.int64))
    numbers.destroy()
    y = np.array(y, float)
    weight = np.where(y == 1, each[1], each[0])
    total = Counter()
    for r in changes:
        total[r["kind"]] += r["n"]
    changes = sorted(((r["kind"], r["gained"], r["lost"], r["n"]) for r in changes if r["gained"] or r["lost"]))
    share = np.array([swap_weight * c / total[kind] for kind, _, _, c in changes])
    b, w = solve(y, cols, weight, [np.array(g, np.int64) for _, g, _, _ in changes], [np.array(x, np.int64) for _, _, x, _ in changes],
                 share, len(number))
    return Model(b, {f: float(w[i]) for f, i in number.items()}, {("listed", "learned")[k]: v for k, v in total.items()}, groups[1])


SCORES = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("held_out", T.BooleanType()),
                       T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def _score_task(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, {}
        only_cache(_FEATURES)
        out = Out(pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]))
        for group in groups_of(rows_of(batches, "id", "held_out", "body"), 2):
            for (doc, held, _), p in zip(group, model.scores([body for _, _, body in group], known)):
                yield from out.add((doc, held, p, int(p >= threshold)))
        yield from out.flush()
    return run


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every document, over its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    body = id_and_text(docs).select("id", held_out(F.col("id")).alias("held_out"), "body")
    return body.mapInArrow(_score_task(shared, threshold), SCORES)


def _clean_task(shared, text_col: str, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value, {}
        only_cache(_FEATURES)
        for batch in batches:
            bodies = ((t.encode() if t else None,) for (t,) in rows_of([batch], text_col))
            keep = [p < threshold for group in groups_of(bodies, 0) for p in model.scores([b for (b,) in group], known)]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return run


def clean(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, all columns as they are; no shuffle."""
    ship(docs.sparkSession)
    return docs.mapInArrow(_clean_task(docs.sparkSession.sparkContext.broadcast(model), text_col, threshold), docs.schema)
