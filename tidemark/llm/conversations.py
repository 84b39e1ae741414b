"""Conversation structure repair by rank-convergence parallel Viterbi.

A conversation's rows, in order, are edited at least cost (keep 0, change the role 1,
delete 2, insert an empty turn 5, a truncated row that stays 5 more; blank and
duplicate rows must go) so that the roles read ``(system? (user assistant)+)?``.  The
audit is the sequence of edit letters D, I, K, R; of equally cheap ones the least in
ASCII order.

*Cost vectors.*  After any number of rows the repaired roles are in one of four states:
nothing yet, behind the system turn, behind a user turn, behind an assistant turn.
The backward cost vector of a place states the cheapest rest for each state.  Only
differences between states steer the choice, and these take few values, so a step is
a look-up by (vector, row kind) that a worker learns once.

*Chunks.*  Rows are sorted by range over the whole table and cut into chunks of at most
``CHUNK`` rows and ``CHUNK_BYTES`` of text; a conversation that holds a third of all
rows becomes many chunks in many tasks.  Conversations that lie whole in one chunk
inside a task are finished there.  Of the others

1. every chunk starts from a speculative vector at its right end (the one behind the last row);
2. a fix-up pass compares it with the left vector of the chunk behind; where it
   differs, the chunk runs again from its right end until the new vector and the old
   one differ by a constant only, from where on nothing changes.  Passes are repeated until
   no vector changes (at most one pass per chunk of the longest conversation);
3. each chunk traces the least audit from each of the four states; the exits, four
   numbers a chunk, are chained in order, and each chunk is traced from its true state.

Duplicates across chunks come from the first chunk of each (conversation, role and text)
digest.  The repaired text is hashed in order: one task reads the repaired chunks of a
conversation one after the other (SHA-256 has no parallel form) and holds one at a time.

Defined cases: null role or text: one space; null turns come first; a null conv_id is a
conversation of its own.  Rows with equal turns are ordered by role and text.  Rows that are
equal in all columns are kept as one with a count.  A role counts by its first character;
an empty role has none and fits nowhere.  Extra columns are ignored.  An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import Out, rows_of, ship, staged

CHUNK, CHUNK_BYTES = 2048, 4 << 20
WHITE = " \t\n\x0b\x0c\r"
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)  # the state behind an inserted or changed turn
ROLE = {USER: "user", ASSISTANT: "assistant"}
KINDS = "sua"                          # role initials of row kinds 0, 1, 2; 3 is any other
MUST_GO, CUT_OFF = 4, 8                # bits of a row's code above its kind
KEEP = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (ASSISTANT, 1): USER, (USER, 2): ASSISTANT}
END = (0, 10, 5, 0)                    # costs behind the last row
LEGAL = {(0, 1), (1, 2), (2, 1)}       # su, ua, au

_STEPS: dict = {}
_MOVES: dict = {}


def _choices(after: tuple, code: int, state: int):
    """(letter, cost, next state) of the edits that use up a row, in ASCII order."""
    yield "D", 2, state
    if code & MUST_GO:
        return
    stay = 5 if code & CUT_OFF else 0
    kept = KEEP.get((state, code & 3))
    if kept is not None:
        yield "K", stay, kept
    yield "R", 1 + stay, NEXT[state]


def before_row(after: tuple, code: int) -> tuple[tuple, int]:
    """Cost vector before a row from the one behind it, less its first entry, and that entry."""
    got = _STEPS.get((after, code))
    if got is None:
        v = [min(c + after[to] for _, c, to in _choices(after, code, s)) for s in range(4)]
        v[USER], v[ASSISTANT] = min(v[USER], 5 + v[ASSISTANT]), min(v[ASSISTANT], 5 + v[USER])
        v[START], v[SYSTEM] = min(v[START], 5 + v[USER]), min(v[SYSTEM], 5 + v[USER])
        got = _STEPS[after, code] = (tuple(x - v[0] for x in v), v[0])
    return got


def move(after: tuple, code: int, state: int) -> tuple[str, int, int]:
    """(letters up to the row's own, state behind it, cost) of the least audit from a state before the row."""
    got = _MOVES.get((after, code, state))
    if got is None:
        v, base = before_row(after, code)
        letters, cost, at = "", 0, state
        while True:
            rest = v[at] + base
            options = [(a, c, to, c + after[to]) for a, c, to in _choices(after, code, at)]
            options.append(("I", 5, NEXT[at], 5 + v[NEXT[at]] + base))
            letter, c, to, _ = min(o for o in options if o[3] == rest)
            letters, cost, at = letters + letter, cost + c, to
            if letter != "I":
                break
        got = _MOVES[after, code, state] = (letters, at, cost)
    return got


def vectors(codes: bytes, right: tuple) -> list[tuple]:
    """Cost vectors at every place of a chunk, up to constants; the last is ``right``."""
    out = [right] * (len(codes) + 1)
    for i in range(len(codes) - 1, -1, -1):
        right, _ = before_row(right, codes[i])
        out[i] = right
    return out


def left_vector(codes: bytes, right: tuple) -> tuple:
    for code in reversed(codes):
        right, _ = before_row(right, code)
    return right


def fixed_up(codes: bytes, old: tuple, new: tuple) -> tuple[bool, int]:
    """Run a chunk again from its right end: (whether the vectors met, rows run)."""
    for n, code in enumerate(reversed(codes)):
        if old == new:
            return True, n
        old, new = before_row(old, code)[0], before_row(new, code)[0]
    return old == new, len(codes)


def exits(codes: bytes, right: tuple) -> list[int]:
    """The state behind a chunk for each state before it."""
    v, at = vectors(codes, right), [0, 1, 2, 3]
    for i, code in enumerate(codes):
        at = [move(v[i + 1], code, s)[1] for s in at]
    return at


def trace(codes: bytes, copies: list[int], turns: list[tuple[str, str]], right: tuple, state: int, last: bool):
    """(audit, cost, repaired ``role:text`` turns) of a chunk entered in a state."""
    v, audit, cost, kept = vectors(codes, right), [], 0, []
    for i, code in enumerate(codes):
        letters, behind, c = move(v[i + 1], code, state)
        for letter in letters:
            if letter in "IR":
                state = NEXT[state]
                kept.append(ROLE[state] + ":" + (turns[i][1] if letter == "R" else ""))
            elif letter == "K":
                kept.append(turns[i][0] + ":" + turns[i][1])
        state = behind
        audit.append(letters)
        if copies[i] > 1:  # equal rows behind the first are duplicates, or blank
            audit.append("D" * (copies[i] - 1))
            c += 2 * (copies[i] - 1)
        cost += c
    while last and state not in (START, ASSISTANT):
        state = NEXT[state]
        audit.append("I")
        kept.append(ROLE[state] + ":")
        cost += 5
    return "".join(audit), cost, kept


class Chunk:
    """Rows of one conversation in order, as row codes and counts."""

    def __init__(self, conv, number: int):
        self.conv, self.number = conv, number
        self.codes, self.copies, self.turns, self.size = bytearray(), [], [], 0
        self.digests: list[str | None] = []
        self.seen: set[bytes] = set()
        self.low = self.high = None
        self.distinct = self.illegal = 0

    def add(self, turn, role: str, text: str, n: int, blank: bool, cut_off: bool) -> None:
        if not n:  # a dropped row states that the conversation exists
            return
        kind = KINDS.find(role[:1]) if role else 3
        digest = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
        again = digest in self.seen
        self.seen.add(digest)
        code = (kind if kind >= 0 else 3) | (MUST_GO if blank or again else CUT_OFF if cut_off else 0)
        if self.codes and (self.codes[-1] & 3, code & 3) not in LEGAL:
            self.illegal += 1
        self.illegal += n - 1
        if turn is not None and turn != self.high:
            self.low, self.high = turn if self.low is None else self.low, turn
            self.distinct += 1
        self.codes.append(code)
        self.copies.append(n)
        self.turns.append((role, text))
        self.digests.append(None if blank or again else digest.hex())
        self.size += len(role) + len(text)

    def faults(self, blank: list[bool]) -> tuple[int, int, int]:
        b = sum(n for n, x in zip(self.copies, blank) if x)
        cut = sum(1 for code in self.codes if code & CUT_OFF)
        again = sum(n - (not code & MUST_GO) for n, x, code in zip(self.copies, blank, self.codes) if not x)
        return b, again, cut


RESULT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
_DONE = [("conv_id", pa.int64()), ("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
         ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())]
_OPEN = [("chunk", pa.int64()), ("codes", pa.binary()), ("copies", pa.list_(pa.int64())), ("blanks", pa.binary()),
         ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("digests", pa.list_(pa.string())),
         ("low", pa.int64()), ("high", pa.int64()), ("distinct", pa.int64())]
_CUT = pa.schema(_DONE + _OPEN)
CUT = RESULT + (", chunk long, codes binary, copies array<long>, blanks binary, roles array<string>, texts array<string>, "
                "digests array<string>, low long, high long, distinct long")


def _gaps(low, high, distinct) -> int:
    return 0 if low is None else high - low + 1 - distinct


def _cut_task(rows: int, size: int):
    """Sorted rows of a task -> finished conversations and chunks of open ones."""
    def finished(c: Chunk, blanks: list[bool]) -> tuple:
        audit, cost, kept = trace(bytes(c.codes), c.copies, c.turns, END, START, True)
        return (c.conv, _gaps(c.low, c.high, c.distinct), *c.faults(blanks), c.illegal, cost, audit,
                hashlib.sha256("\n".join(kept).encode()).hexdigest()) + (None,) * len(_OPEN)

    def still_open(c: Chunk, blanks: list[bool]) -> tuple:
        roles, texts = zip(*c.turns) if c.turns else ((), ())
        return ((c.conv, None, None, None, None, c.illegal, None, None, None)
                + (c.number, bytes(c.codes), c.copies, bytes(blanks), list(roles), list(texts), c.digests, c.low, c.high, c.distinct))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = Out(_CUT, rows=500)
        now, blanks, first, alone, count = None, [], True, True, 0
        for part, conv, turn, role, text, n, blank, cut_off in rows_of(
                batches, "part", "conv_id", "turn", "role", "text", "n", "blank", "cut_off"):
            if now is not None and (now.conv != conv or len(now.codes) >= rows or now.size >= size):
                # only the first and the last conversation of a task may go on in another one
                whole = now.conv != conv and alone and not first
                yield from out.add((finished if whole else still_open)(now, blanks), now.size)
                first, alone = first and now.conv == conv, now.conv != conv
                now = None
            if now is None:
                now, blanks, count = Chunk(conv, (part << 32) + count), [], count + 1
            now.add(turn, role, text, n, blank, cut_off)
            if n:
                blanks.append(blank)
        if now is not None:
            yield from out.add(still_open(now, blanks))
        yield from out.flush()
    return run


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): rows after the damage, equal ones counted; n = 0 marks a conversation's dropped rows."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), space("role").alias("role"), space("text").alias("text"),
        (F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20).alias("_d"))
    d = F.col("_d")
    rows = rows.select(
        "conv_id", F.when(d != 0, F.col("turn")).alias("turn"),
        F.when(d == 0, F.lit("")).when(d == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(d <= 1, F.lit("")).when(d == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(d == 0, 0).when(d == 3, 2).otherwise(1).cast("long").alias("n"))
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))


def _as_text(v: tuple) -> str:
    return ",".join(map(str, v))


def _vector(text: str) -> tuple:
    return tuple(map(int, text.split(",")))


_LEFT = pa.schema([("chunk", pa.int64()), ("right", pa.string()), ("left", pa.string())])


def _speculate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Out(_LEFT)
    for chunk, codes in rows_of(batches, "chunk", "codes"):
        yield from out.add((chunk, _as_text(END), _as_text(left_vector(codes, END))))
    yield from out.flush()


def _fix_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Out(_LEFT)
    for chunk, codes, old, left, new in rows_of(batches, "chunk", "codes", "right", "left", "truth"):
        if old != new and not fixed_up(codes, _vector(old), _vector(new))[0]:
            left = _as_text(left_vector(codes, _vector(new)))
        yield from out.add((chunk, new, left))
    yield from out.flush()


_CODES = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("codes", pa.binary())])


def _mark_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Out(_CODES)
    for conv, chunk, codes, seen in rows_of(batches, "conv_id", "chunk", "codes", "seen"):
        new = bytearray(codes)
        for at in seen or ():
            new[at] = new[at] & 3 | MUST_GO
        yield from out.add((conv, chunk, bytes(new)), len(new))
    yield from out.flush()


_EXITS = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("exits", pa.list_(pa.int32()))])


def _exit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Out(_EXITS)
    for conv, chunk, codes, right in rows_of(batches, "conv_id", "chunk", "codes", "right"):
        yield from out.add((conv, chunk, exits(codes, _vector(right))))
    yield from out.flush()


_ENTRY = pa.schema([("chunk", pa.int64()), ("entry", pa.int32())])


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state before each chunk; chunks come in order of conversation and place, one state is held."""
    out, now, state = Out(_ENTRY), (), START
    for conv, chunk, ends in rows_of(batches, "conv_id", "chunk", "exits"):
        state = state if now == (conv,) else START
        now = (conv,)
        yield from out.add((chunk, state))
        state = ends[state]
    yield from out.flush()


_PIECE = pa.schema([("conv_id", pa.int64()), ("chunk", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
                    ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("kept", pa.string()), ("low", pa.int64()),
                    ("high", pa.int64()), ("distinct", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])
PIECE = ("conv_id long, chunk long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, kept string, "
         "low long, high long, distinct long, first int, last int")


def _trace_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Out(_PIECE, rows=200)
    for conv, number, codes, copies, blanks, roles, texts, illegal, low, high, distinct, right, entry, last in rows_of(
            batches, "conv_id", "chunk", "codes", "copies", "blanks", "roles", "texts", "illegal", "low", "high", "distinct", "right", "entry", "final"):
        c = Chunk(conv, number)
        c.codes, c.copies = bytearray(codes), copies
        audit, cost, kept = trace(codes, copies, list(zip(roles, texts)), _vector(right), entry, last)
        ends = (codes[0] & 3, codes[-1] & 3) if codes else (None, None)
        text = "\n".join(kept) if kept else None
        yield from out.add((conv, number, *c.faults([bool(b) for b in blanks]), illegal, cost, audit, text, low, high, distinct, *ends),
                           len(audit) + len(text or ""))
    yield from out.flush()


def _join_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces in order -> one row per conversation; one piece is held, and the audit."""
    out, now = Out(pa.schema(_DONE), rows=200), None

    def total():
        return (now["conv"], _gaps(now["low"], now["high"], now["distinct"]), *now["sums"], "".join(now["audit"]), now["sha"].hexdigest())
    for conv, _, blank, again, cut, illegal, cost, audit, kept, low, high, distinct, first, last in rows_of(
            batches, *_PIECE.names):
        if now is None or now["conv"] != conv:
            if now is not None:
                yield from out.add(total())
            now = {"conv": conv, "low": None, "high": None, "distinct": 0, "sums": [0] * 5, "audit": [], "sha": hashlib.sha256(),
                   "any": False, "end": None}
        if first is not None:
            illegal += now["end"] is not None and (now["end"], first) not in LEGAL
            now["end"] = last
        now["sums"] = [a + b for a, b in zip(now["sums"], (blank, again, cut, illegal, cost))]
        now["audit"].append(audit)
        if kept is not None:
            now["sha"].update((("\n" if now["any"] else "") + kept).encode())
            now["any"] = True
        if low is not None:
            now["distinct"] += distinct - (low == now["high"])
            now["low"], now["high"] = low if now["low"] is None else now["low"], high
    if now is not None:
        yield from out.add(total())
    yield from out.flush()


def _solved(light: DataFrame) -> DataFrame:
    """(chunk, right, final): the true vector at each chunk's right end, by fix-up passes over a written table."""
    found = staged(light.mapInArrow(_speculate, "chunk long, right string, left string"), "viterbi_speculated")
    order = Window.partitionBy("conv_id").orderBy("chunk")
    places = light.select("conv_id", "chunk")
    while True:
        linked = (places.join(found, "chunk").withColumn("behind", F.lead("left").over(order))
                  .select("chunk", "right", "left", F.coalesce("behind", F.lit(_as_text(END))).alias("truth"), F.col("behind").isNull().alias("final")))
        if not linked.where("right <> truth").limit(1).count():
            return linked.select("chunk", "right", "final")
        found = staged(light.join(linked, "chunk").select("chunk", "codes", "right", "left", "truth")
                       .mapInArrow(_fix_up, "chunk long, right string, left string"), "viterbi_fixed")


def _in_order(df: DataFrame) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")


def repair(rows: DataFrame, chunk_rows: int = CHUNK, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text, n; equal rows counted in n, see ``damaged``)."""
    ship(rows.sparkSession)
    order = (F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("_head"), F.col("_digest"))
    ready = (rows.withColumn("_head", F.substring("text", 1, 32)).withColumn("_digest", F.md5("text"))
             .repartitionByRange(*order).sortWithinPartitions(*order))
    bare = F.rtrim(F.col("text"), F.lit(WHITE))
    ready = ready.select(F.spark_partition_id().cast("long").alias("part"), "conv_id", "turn", "role", "text", "n", (bare == "").alias("blank"),
                         (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("cut_off"))
    cut = staged(ready.mapInArrow(_cut_task(chunk_rows, chunk_bytes), CUT), "conversation_chunks")
    done = cut.where("chunk IS NULL").select(*[n for n, _ in _DONE])
    chunks = cut.where("chunk IS NOT NULL")

    digests = chunks.select("conv_id", "chunk", F.posexplode("digests").alias("at", "digest")).where("digest IS NOT NULL")
    seen = (digests.withColumn("_first", F.min("chunk").over(Window.partitionBy("conv_id", "digest"))).where("chunk > _first")
            .groupBy("chunk").agg(F.collect_list("at").alias("seen")))
    light = staged(chunks.select("conv_id", "chunk", "codes").join(seen, "chunk", "left")
                   .mapInArrow(_mark_seen, "conv_id long, chunk long, codes binary"), "conversation_codes")
    solved = staged(_solved(light), "viterbi_solved")
    ends = light.join(solved, "chunk").mapInArrow(_exit_task, "conv_id long, chunk long, exits array<int>")
    entries = _in_order(ends).mapInArrow(_chain, "chunk long, entry int")
    known = light.select("chunk", "codes").join(solved, "chunk").join(entries, "chunk")
    pieces = chunks.drop("codes").join(known, "chunk").mapInArrow(_trace_task, PIECE)
    return done.unionByName(_in_order(pieces).mapInArrow(_join_task, RESULT))
