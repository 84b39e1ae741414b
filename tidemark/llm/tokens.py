"""Token ids of whole texts from a public tokenizer file, one word chunk at a time.

A BPE tokenizer splits a text into words before it merges, so the ids of a text are
the ids of its chunks joined.  Chunks are encoded by the tokenizers library once
per worker and kept in a cache of bounded size.  Texts are cut and joined by Arrow, a batch at a time,
so the cache is asked once for each distinct chunk of a batch, not for every word.  Two splits are used:

* ``words``: the file drops white space; any ASCII white space is a chunk border;
* ``spaces``: a GPT-2 style file, where a single space belongs to the word behind it
  and a single line feed is a word.  A text with any other white space at a word's
  edge is encoded whole by the library.

``tests/llm`` compares both with the library on whole texts.
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import only_cache

CACHE_BYTES = 128 << 20  # of each of two generations
LINE = 200  # unknown chunks that the library gets in one text
MARKS = (b",", b".")
# an empty chunk, one with white space or a byte beyond ASCII at its edge, or a special token's brackets
_EDGE = re.compile(rb"\Z|[\x00-\x20\x7f-\xff]|(?s:.*)(?:<\||[\x00-\x20\x7f-\xff]\Z)").match

_NEW = object()  # marks a chunk that is in no cache; a cached None means the whole text
_LOADED: dict[tuple[str, str], "Encoder"] = {}


class Encoder:
    def __init__(self, path: str, split: str, cache_bytes: int = CACHE_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.split, self.cache_bytes = split, cache_bytes
        self._clear()
        self.marks = {m: self.whole(m) for m in MARKS}
        if split == "spaces":
            self.feed = self.whole(b"\n")
            vocab = self.lib.get_vocab()
            self.opens = np.zeros(max(vocab.values()) + 1, bool)  # tokens that begin with a space
            self.opens[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True

    def _clear(self) -> None:
        self.first: dict[bytes, bytes | None] = {}
        self.spaced: dict[bytes, bytes | None] = {}
        self.old_first: dict[bytes, bytes | None] = {}
        self.old_spaced: dict[bytes, bytes | None] = {}
        self.held = 0

    def _age(self) -> None:
        """Start a new generation; chunks still in use move over from the last one."""
        self.old_first, self.old_spaced = self.first, self.spaced
        self.first, self.spaced, self.held = {}, {}, 0

    def whole(self, body: bytes) -> bytes:
        return np.array(self.lib.encode(body.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, cache: dict, old: dict, todo: set[bytes], lead: str) -> None:
        if old:
            known = {c: old[c] for c in todo if c in old}  # intersection() would walk all of a dict
            todo.difference_update(known)
            self._hold(cache, known)
        marked = [c for c in todo if c.endswith(MARKS) and c[-2:-1].isalpha()]  # a mark behind a letter is a word of its own
        todo.difference_update(marked)
        todo.update({c[:-1] for c in marked}.difference(cache))
        odd = {c: self._odd_one(c) for c in todo if _EDGE(c)}
        odd = {c: ids for c, ids in odd.items() if ids != b"?"}
        self._hold(cache, odd)
        todo.difference_update(odd)
        plain = list(todo)
        for at in range(0, len(plain), LINE):
            part = plain[at:at + LINE]
            self._hold(cache, dict(zip(part, self._line(part, lead))))
        stems = {c: cache[c[:-1]] for c in marked}
        self._hold(cache, {c: None if ids is None else ids + self.marks[c[-1:]] for c, ids in stems.items()})

    def _odd_one(self, chunk: bytes) -> bytes | None:
        """Ids of a chunk that may not stand in a line with others (None: only the whole text can place it), b"?" if it may."""
        t = chunk.decode()
        if self.split == "spaces":
            return None if not t or t[0].isspace() or t[-1].isspace() or "<|" in t else b"?"
        return self.whole(chunk) if "<|" in t else b"?"

    def _line(self, chunks: list[bytes], lead: str) -> list[bytes]:
        """Ids of each chunk, from one text of them all: a token belongs to the chunk that its place is in.

        A border is the space that a word is written with, or drops; where the word has none, a line feed, a token of its own."""
        feed = self.split == "spaces" and not lead
        text = lead + (b"\n" if feed else b" ").join(chunks).decode()
        if self.split == "spaces":  # its borders show in the ids, so the library need not place the tokens
            ids = np.array(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            at = np.flatnonzero(ids == np.frombuffer(self.feed, "<u4")[0] if feed else self.opens[ids])
            if len(at) == len(chunks) - feed and (feed or not at[0]):
                data = ids.tobytes()
                starts, ends = ([0, *(4 * at + 4).tolist()], [*(4 * at).tolist(), len(data)]) if feed else ((4 * at).tolist(), [*(4 * at[1:]).tolist(), len(data)])
                return [data[a:b] for a, b in zip(starts, ends)]
        got = self.lib.encode(text, add_special_tokens=False)
        places = np.fromiter((a for a, _ in got.offsets), np.int64, len(got))
        letters = np.frombuffer(text.encode("utf-32-le"), "<u4")
        borders = np.flatnonzero(letters[len(lead):] == (10 if feed else 32)) + len(lead)
        cuts = 4 * np.searchsorted(places, borders)
        ids = np.array(got.ids, "<u4").tobytes()
        starts = [0, *(cuts + (4 if feed else 0)).tolist()]
        return [ids[a:b] for a, b in zip(starts, [*cuts.tolist(), len(ids)])]

    def _hold(self, cache: dict, found: dict[bytes, bytes | None]) -> None:
        cache.update(found)
        self.held += 140 * len(found) + sum(map(len, found)) + sum(map(len, filter(None, found.values())))

    def many(self, bodies: list[bytes | None]) -> list[bytes]:
        """Little-endian uint32 ids of each text (null: empty)."""
        if self.held > self.cache_bytes:
            self._age()
        texts = pa.array([b or b"" for b in bodies], pa.large_binary()).view(pa.large_string())
        if self.split == "words":
            cut = pc.ascii_split_whitespace(texts)
            words = cut.flatten().dictionary_encode()
            table = pa.array(self._ids(self.first, self.old_first, words.dictionary, ""), pa.large_binary())
            return self._joined(table.take(words.indices), cut.offsets.to_numpy(), bodies)
        lines = pc.split_pattern(texts, "\n")
        cut = pc.split_pattern(lines.flatten(), " ")
        chunks, starts = cut.flatten(), cut.offsets.to_numpy()[:-1]
        behind = np.ones(len(chunks), bool)  # behind a space; else the first of its line
        behind[starts] = False
        first, spaced = chunks.take(pa.array(starts)).dictionary_encode(), chunks.filter(pa.array(behind)).dictionary_encode()
        opening = self._ids(self.first, self.old_first, first.dictionary, "")
        inner = self._ids(self.spaced, self.old_spaced, spaced.dictionary, " ")
        feed = self.feed
        table = pa.array(inner + opening + [None if ids is None else feed + ids for ids in opening], pa.large_binary())
        fed = np.ones(len(starts), np.int64)  # lines behind a line feed: all but the first of a text
        fed[lines.offsets.to_numpy()[:-1]] = 0
        at = np.empty(len(chunks), np.int64)
        at[behind] = spaced.indices.to_numpy()
        at[starts] = len(inner) + first.indices.to_numpy() + len(opening) * fed
        return self._joined(table.take(pa.array(at)), cut.offsets.to_numpy()[lines.offsets.to_numpy()], bodies)

    def _ids(self, cache: dict, old: dict, distinct: pa.Array, lead: str) -> list[bytes | None]:
        """Ids of each distinct chunk."""
        chunks = distinct.view(pa.large_binary()).to_pylist()
        got = list(map(cache.get, chunks, repeat(_NEW)))
        new = [i for i, ids in enumerate(got) if ids is _NEW]
        self._learn(cache, old, {chunks[i] for i in new}, lead)
        for i in new:
            got[i] = cache[chunks[i]]
        return got

    def _joined(self, ids: pa.Array, ends: np.ndarray, bodies: list[bytes | None]) -> list[bytes]:
        """Ids of each text, from those of all chunks in order; the chunks of text i end at ``ends[i + 1]``."""
        _, places, data = ids.buffers()
        cuts = np.frombuffer(places, np.int64)[ends].tolist()
        data = memoryview(data or b"")
        out = [bytes(data[a:b]) for a, b in zip(cuts, cuts[1:])]
        if ids.null_count:  # texts with a chunk that only the whole text can place
            nulls = np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False))
            for i in np.unique(np.searchsorted(ends, nulls, "right") - 1).tolist():
                out[i] = self.whole(bodies[i] or b"")
        return out


def encoder(path: str, split: str, cache_bytes: int = CACHE_BYTES) -> Encoder:
    """The worker's encoder for this file, loaded once."""
    only_cache(_LOADED)
    if (path, split) not in _LOADED:
        _LOADED[path, split] = Encoder(path, split)
    _LOADED[path, split].cache_bytes = cache_bytes
    return _LOADED[path, split]
