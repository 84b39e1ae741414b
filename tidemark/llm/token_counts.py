"""Word-piece token counts by a linear longest-match automaton.

Greedy longest-match tokenisation takes from a word's start the longest piece in the
vocabulary, again and again.  The automaton is the vocabulary's trie with a failure
link per node: where the next symbol has no edge, the pieces that greedy matching is
sure to cut off the text read so far are popped and the automaton goes on from the
node of what is left.  ``popped[node]`` holds how many pieces that are, so a word's
count is a sum over at most as many failure moves as symbols: linear in the word, and no piece
is ever built.

A word is its UTF-8 bytes and an end symbol; a vocabulary entry that closes a word
(``</w>`` in the file) ends with that symbol.  Where the longest match takes the last
byte without it, the end symbol alone is left and counts nothing.  Words are the runs that the
vocabulary's own rule gives (letters, single digits, other marks, English
contractions) in NFC, lower-cased text.  A word that greedy matching cannot finish
is one unknown token, as in word-piece tokenisers.

Defined cases: null and empty texts have no words and no tokens; repeated rows and
null ids give a row each; a table without rows gives none.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import Out, id_and_text, rows_of

END = 256
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
CACHE = 400_000
COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "n_words", "n_tokens", "n_unknown")])
_LOADED: dict[str, "Automaton"] = {}


def byte_symbols() -> dict[str, int]:
    """The public byte-level alphabet: printable Latin-1 stands for itself, the other bytes follow from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


def read_vocabulary(path: str, end: str = "</w>") -> list[tuple[int, ...]]:
    """Pieces of a byte-level vocabulary file as symbol tuples."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    symbol = byte_symbols()
    out = []
    for piece in vocab:
        stem, close = (piece[:-len(end)], (END,)) if piece.endswith(end) else (piece, ())
        out.append((*(symbol[c] for c in stem), *close))
    return out


class Automaton:
    def __init__(self, pieces: list[tuple[int, ...]]):
        self.edges: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in (*pieces, (END,)):
            node = 0
            for s in piece:
                if s not in self.edges[node]:
                    self.edges[node][s] = len(self.edges)
                    self.edges.append({})
                    whole.append(False)
                node = self.edges[node][s]
            whole[node] = node != 0
        n = len(self.edges)
        self.fail, self.popped = [-1] * n, [0] * n
        level = [(0, s, v) for s, v in self.edges[0].items()]
        while level:  # breadth first: links of shorter strings come first
            below = []
            for parent, s, v in level:
                if whole[v]:
                    self.fail[v], self.popped[v] = 0, int((parent, s) != (0, END))
                else:
                    z, count = self.fail[parent], self.popped[parent]
                    while z >= 0 and s not in self.edges[z]:
                        count += self.popped[z]
                        z = self.fail[z]
                    if z >= 0:
                        self.fail[v], self.popped[v] = self.edges[z][s], count
                below += [(v, t, w) for t, w in self.edges[v].items()]
            level = below

    def count(self, word: bytes) -> int:
        """Pieces of greedy longest match over the word and its end symbol; -1 if there is none."""
        edges, fail, popped = self.edges, self.fail, self.popped
        node = total = 0
        for s in (*word, END):
            while (to := edges[node].get(s)) is None:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return -1
            node = to
        while node > 0:
            total += popped[node]
            node = fail[node]
        return total if node == 0 else -1


def automaton(path: str) -> Automaton:
    if path not in _LOADED:
        _LOADED[path] = Automaton(read_vocabulary(path))
    return _LOADED[path]


def count_chunk(machine: Automaton, chunk: bytes) -> tuple[int, int, int]:
    """(words, tokens, unknown words) of a run without ASCII white space."""
    words = WORD.findall(unicodedata.normalize("NFC", chunk.decode()).lower())
    counts = [machine.count(w.encode()) for w in words]
    unknown = counts.count(-1)
    return len(words), sum(c for c in counts if c > 0) + unknown, unknown


def _count_task(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        seen: dict[bytes, tuple[int, int, int]] = {}
        out = Out(pa.schema([(n, pa.int64()) for n in COUNTS.names]), rows=10_000)
        for doc, body in rows_of(batches, "id", "body"):
            if len(seen) > CACHE:
                seen.clear()
            words = tokens = unknown = 0
            for chunk in (body or b"").split():
                got = seen.get(chunk)
                if got is None:
                    got = count_chunk(machine, chunk)
                    if len(chunk) <= 64:
                        seen[chunk] = got
                words += got[0]
                tokens += got[1]
                unknown += got[2]
            yield from out.add((doc, words, tokens, unknown))
        yield from out.flush()
    return run


def token_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_words, n_tokens, n_unknown) per document over its whole text."""
    return id_and_text(docs).mapInArrow(_count_task(path), COUNTS)
