"""Repair of conversation structure by cheapest edits.

A conversation is well formed when the initials of its roles read
``(s?(ua)+)?``. Rows are kept, given another role, deleted or put in anew; every
edit has a cost. The edit lattice has a node for every number of rows read and
state of that expression, and a path from its start to its end is a list of
edits. Bidirectional Dijkstra finds the cheapest ones: a forward and a reverse
heap grow until no unfinished crossing can be as cheap as the best, so that all
cheapest paths are known; the one whose edits, written as letters, come first in
ASCII order is taken. From a node every letter leads to one node only, so the
walk that takes the least letter of a cheapest path is that one.

Conversations are sorted in the tasks and streamed. Those beyond ``LONG`` rows are
never held: one pass from their end finds the cost of what follows each row, one
pass from their start applies the edits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark.operators.ordering import join_on, positions
from fabspark.session import settled

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5  # costs; the last is added to a truncated row that stays
LONG = 4096  # rows of a conversation that a task holds
MEMO = 20_000  # shapes of short conversations whose edits a worker remembers
SHORT = 64

FINE, GONE, OPEN_END = 0, 1, 2  # a row's fault: none, must be deleted (blank or duplicate), truncated

# States of the expression: nothing yet, after s, after u, after a. The two lists are its transitions.
TAKES = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
LACKS = (("user", 2), ("user", 2), ("assistant", 3), ("user", 2))  # the role that an edit may put, and where it leads
ENDS = (0, 3)


def _edges(i: int, q: int, initials: str, faults: bytes) -> Iterator[tuple[str, int, int, int]]:
    """(letter, row, state, cost) of the edits at a node, letters in ASCII order."""
    n = len(initials)
    if i < n:
        yield "D", i + 1, q, DELETE
    yield "I", i, LACKS[q][1], INSERT
    if i < n and faults[i] != GONE:
        more = TRUNCATED if faults[i] == OPEN_END else 0
        if initials[i] in TAKES[q]:
            yield "K", i + 1, TAKES[q][initials[i]], KEEP + more
        yield "R", i + 1, LACKS[q][1], REROLE + more


def _back_edges(i: int, q: int, initials: str, faults: bytes) -> Iterator[tuple[int, int, int]]:
    """(row, state, cost) of the edits that lead to a node."""
    for p in range(4):
        if LACKS[p][1] == q:
            yield i, p, INSERT
    if i:
        yield i - 1, q, DELETE
        if faults[i - 1] != GONE:
            more = TRUNCATED if faults[i - 1] == OPEN_END else 0
            for p in range(4):
                if TAKES[p].get(initials[i - 1]) == q:
                    yield i - 1, p, KEEP + more
                if LACKS[p][1] == q:
                    yield i - 1, p, REROLE + more


def edits(initials: str, faults: bytes) -> tuple[int, str]:
    """Least cost and, of the cheapest edit lists, the least in ASCII order.

    ``initials`` has one character a row, ``faults`` one of FINE, GONE, OPEN_END.
    """
    n = len(initials)
    goals = [(n, q) for q in ENDS]
    ahead: dict[tuple[int, int], int] = {(0, 0): 0}
    behind: dict[tuple[int, int], int] = dict.fromkeys(goals, 0)
    heaps = [[(0, (0, 0))], [(0, g) for g in goals]]
    closed: list[dict[tuple[int, int], int]] = [{}, {}]
    best = 0 if n == 0 else None
    while heaps[0] and heaps[1]:
        low, high = heaps[0][0][0], heaps[1][0][0]
        if best is not None and low + high > best:
            break  # equal sums go on: all crossings of the best cost are finished
        side = 0 if low <= high else 1
        cost, node = heappop(heaps[side])
        if node in closed[side]:
            continue
        closed[side][node] = cost
        mine, other = (ahead, behind) if side == 0 else (behind, ahead)
        steps = ((i, q, w) for _, i, q, w in _edges(*node, initials, faults)) if side == 0 \
            else _back_edges(*node, initials, faults)
        for i, q, w in steps:
            to = (i, q)
            if mine.get(to, cost + w + 1) > cost + w:
                mine[to] = cost + w
                heappush(heaps[side], (cost + w, to))
            if to in other and (best is None or cost + w + other[to] < best):
                best = cost + w + other[to]
    forward, reverse = closed

    def leads(v: tuple[int, int], at: int) -> bool:
        """Whether a cheapest path goes on over a node that was reached at this cost."""
        return reverse.get(v) == best - at or (v in good and forward[v] == at)

    good: set[tuple[int, int]] = set()  # nodes of the forward side on a cheapest path
    for u in sorted(forward, key=lambda u: (u[0], forward[u]), reverse=True):
        if (u in goals and forward[u] == best) or any(
                leads((i, q), forward[u] + w) for _, i, q, w in _edges(*u, initials, faults)):
            good.add(u)
    out, at, u = [], 0, (0, 0)
    while not (u in goals and at == best):
        for letter, i, q, w in _edges(*u, initials, faults):
            if leads((i, q), at + w):
                out.append(letter)
                u, at = (i, q), at + w
                break
    return best, "".join(out)


@lru_cache(MEMO)
def _remembered(initials: str, faults: bytes) -> tuple[int, str]:
    return edits(initials, faults)


class FromEnd:
    """Cheapest edits of a conversation read from its last row to its first."""

    def __init__(self):
        self.rest = [0, 0, 0, 0]  # least cost of what follows, for each state
        for q in (3, 2, 1, 0):
            self.rest[q] = 0 if q in ENDS else INSERT + self.rest[LACKS[q][1]]

    def row(self, initial: str, fault: int) -> str:
        """The letters of the row's edits for each of the four states before it, joined by |."""
        more = TRUNCATED if fault == OPEN_END else 0
        ways = []
        for q in range(4):
            w = {"D": DELETE + self.rest[q]}
            if fault != GONE:
                if initial in TAKES[q]:
                    w["K"] = KEEP + more + self.rest[TAKES[q][initial]]
                w["R"] = REROLE + more + self.rest[LACKS[q][1]]
            ways.append(w)
        alone = [min(w.values()) for w in ways]
        now = [0, 0, min(alone[2], INSERT + alone[3]), min(alone[3], INSERT + alone[2])]
        now[:2] = (min(alone[q], INSERT + now[2]) for q in (0, 1))
        letters = []
        for q in range(4):
            text = ""
            while not text or text[-1] == "I":
                w = {**ways[q], "I": INSERT + now[LACKS[q][1]]}
                text += min(x for x in w if w[x] == now[q])
                q = LACKS[q][1]
            letters.append(text)
        self.rest = now
        return "|".join(letters)


class _Rewritten:
    """Applies edits row by row; holds the letters and the digest, not the texts."""

    def __init__(self):
        self.q, self.place, self.cost = 0, 0, 0
        self.audit, self.hash = [], hashlib.sha256()

    def _put(self, role: str, text: str) -> tuple[int, str, str]:
        self.hash.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
        self.place += 1
        return self.place, role, text

    def row(self, letters: str, role: str, text: str, fault: int) -> Iterator[tuple[int, str, str]]:
        for x in letters:
            self.audit.append(x)
            self.cost += {"D": DELETE, "I": INSERT, "K": KEEP, "R": REROLE}[x]
            if x in "KR" and fault == OPEN_END:
                self.cost += TRUNCATED
            if x == "K":
                self.q = TAKES[self.q][role[:1]]
                yield self._put(role, text)
            elif x != "D":
                new, self.q = LACKS[self.q]
                yield self._put(new, text if x == "R" else "")

    def end(self) -> Iterator[tuple[int, str, str]]:
        while self.q not in ENDS:
            yield from self.row("I", "", "", FINE)


def damaged(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows with planted faults: (key, turn, role, text, gone), where ``gone`` marks rows that were dropped.

    The fault follows from crc32 of ``key:turn`` modulo 20. Nulls of role and text
    become one space, and null keys and turns count as one in the checksum.
    """
    col = lambda c: F.col(f"`{c}`")
    said = lambda c: F.coalesce(col(c).cast("string"), F.lit(" "))
    h = F.crc32(F.concat(said(key), F.lit(":"), said(turn)).cast("binary")) % 20
    t = said(text)
    return rows.select(
        col(key).alias("key"), col(turn).alias("turn"),
        F.when(h == 4, "user").otherwise(said(role)).alias("role"),
        F.when(h <= 1, "").when(h == 2, F.regexp_replace(t, "[.!?]", "")).otherwise(t).alias("text"),
        (h == 0).alias("gone"), F.explode(F.when(h == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")
    ).drop("copy")


LEGAL = ("su", "ua", "au")
BLANK, DUPLICATE, TRUNCATED_END = 0, 1, 2


class _Counts:
    """Faults of a conversation, row by row."""

    def __init__(self):
        self.n = [0, 0, 0, 0]  # blank, duplicate, truncated, illegal neighbours
        self.low = self.high = self.initial = None
        self.turns = 0

    def row(self, turn: int | None, role: str, fault: int | None) -> int:
        if fault is not None:
            self.n[fault] += 1
        if turn is not None and turn != self.high:  # in order, so equal turns stand together
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.n[3] += 1
        self.initial = role[:1]
        return FINE if fault is None else OPEN_END if fault == TRUNCATED_END else GONE

    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


REPORT = [("gaps", "long"), ("blank", "long"), ("duplicate", "long"), ("truncated", "long"), ("illegal", "long"),
          ("cost", "long"), ("audit", "string"), ("repaired_sha256", "string")]
TURNS = [("place", "long"), ("role", "string"), ("text", "string")]
STEPS = [("seq", "long"), ("letters", "string")]


def _streamed(df: DataFrame, work: Callable[[Iterator[tuple]], Iterator[tuple]], columns: list[tuple[str, str]]) -> DataFrame:
    """``work`` over the rows of each key of a table that is sorted by ``key`` in its tasks; rows come one by one."""
    kinds = {"long": pa.int64(), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def rows() -> Iterator[tuple]:
            nonlocal kind
            for b in batches:
                kind = b.schema.field(0).type
                for at in range(0, b.num_rows, 1024):
                    yield from zip(*(c.to_pylist() for c in b.slice(at, 1024).columns))

        def made() -> Iterator[tuple]:
            for key, group in groupby(rows(), key=lambda r: r[0]):
                for r in work(r[1:] for r in group):
                    yield key, *r

        out = made()
        while some := list(islice(out, 4096)):
            types = [kind, *(kinds[t] for _, t in columns)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*some), types)],
                                             ["key", *(n for n, _ in columns)])

    key = df.schema["key"].dataType.simpleString()
    return df.mapInArrow(run, f"key {key}, " + ", ".join(f"{n} {t}" for n, t in columns))


def _whole(turns: bool) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
    """Conversations that a task holds: the path is searched from both ends."""
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        counts, seen, faults, held = _Counts(), set(), bytearray(), []
        for turn, role, text, gone, blank, open_end in rows:
            if not gone:
                fault = BLANK if blank else DUPLICATE if (role, text) in seen else TRUNCATED_END if open_end else None
                seen.add((role, text))
                faults.append(counts.row(turn, role, fault))
                held.append((role, text))
        initials = "".join(role[:1] or "\0" for role, _ in held)
        cost, audit = (_remembered if len(held) <= SHORT else edits)(initials, bytes(faults))
        new, at, put = _Rewritten(), 0, []
        for (role, text), fault in zip(held, faults):
            end = at
            while audit[end] == "I":
                end += 1
            put += new.row(audit[at:end + 1], role, text, fault)
            at = end + 1
        put += new.end()
        if "".join(new.audit) != audit or new.cost != cost:
            raise RuntimeError("edits do not give the path found")
        if turns:
            yield from put
        else:
            yield counts.gaps(), *counts.n, cost, audit, new.hash.hexdigest()

    return work


def _steps(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(seq, letters) of rows from the last to the first."""
    path = FromEnd()
    for seq, initial, fault in rows:
        yield seq, path.row(initial, fault)


def _applied(turns: bool) -> Callable[[Iterator[tuple]], Iterator[tuple]]:
    """Conversations of any length, with the letters of each row at hand."""
    def work(rows: Iterator[tuple]) -> Iterator[tuple]:
        counts, new = _Counts(), _Rewritten()
        for _, turn, role, text, fault, letters in rows:
            put = new.row(letters.split("|")[new.q], role, text, counts.row(turn, role, fault))
            for r in put:
                if turns:
                    yield r
        for r in new.end():
            if turns:
                yield r
        if not turns:
            yield counts.gaps(), *counts.n, new.cost, "".join(new.audit), new.hash.hexdigest()

    return work


def _repaired(rows: DataFrame, turns: bool, long: int) -> DataFrame:
    columns = TURNS if turns else REPORT
    rows = rows.withColumns({"blank": ~F.col("text").rlike(r"[^\x20\x09-\x0D]"),
                             "open_end": F.col("text").rlike(r"[^\x20\x09-\x0D.!?][\x20\x09-\x0D]*+\z")})
    many = settled(rows.groupBy("key").agg(F.count_if(~F.col("gone")).alias("n")).where(F.col("n") > long).select("key"), "long")
    few = rows
    if not many.isEmpty():
        few = join_on(rows, many.withColumn("_many", F.lit(True)), ["key"], "left").where("_many IS NULL").drop("_many")
    out = _streamed(few.repartition("key").sortWithinPartitions("key", "turn", "role", "text"), _whole(turns), columns)
    if many.isEmpty():
        return out
    # Long ones: places first, so that no task has to sort or hold a conversation.
    big = join_on(rows.where("NOT gone"), many, ["key"]).drop("gone")
    big = settled(positions(big, ["key"], ["turn", "role", "text"]).drop("series_rows"), "placed")
    said = F.sha2(F.concat("role", F.lit("\0"), "text"), 256)
    first = big.groupBy("key", said.alias("said")).agg(F.min("seq").alias("first"))
    big = join_on(big.withColumn("said", said), first, ["key", "said"]).withColumn(
        "fault", F.when(F.col("blank"), BLANK).when(F.col("seq") > F.col("first"), DUPLICATE)
        .when(F.col("open_end"), TRUNCATED_END)).drop("said", "first", "blank", "open_end")
    big = settled(big, "faults")
    kind = F.when(F.col("fault").isNull(), FINE).when(F.col("fault") == TRUNCATED_END, OPEN_END).otherwise(GONE)
    back = big.select("key", "seq", F.substring("role", 1, 1).alias("initial"), kind.alias("kind")) \
        .repartition("key").sortWithinPartitions(F.col("key"), F.desc("seq"))
    steps = settled(_streamed(back, _steps, STEPS), "steps")
    big = join_on(big, steps, ["key", "seq"]).select("key", "seq", "turn", "role", "text", "fault", "letters")
    return out.union(_streamed(big.repartition("key").sortWithinPartitions("key", "seq"), _applied(turns), columns))


def report(rows: DataFrame, *, key: str = "conv_id", long: int = LONG) -> DataFrame:
    """One row per conversation of the rows that ``damaged`` gives: faults found, cheapest edits, digest of the result.

    Rows are ordered by turn, null turns first, then by role and text; repeated
    rows are duplicates. ``gaps``: turns missing between the lowest and the
    highest. ``blank``, ``duplicate`` (role and text seen earlier), ``truncated``
    (does not end in ``.!?``): rows by their first fault. ``illegal``: neighbours
    whose roles do not follow each other. ``cost`` and ``audit``: the edits, one
    letter each (Delete, Insert, Keep, Rerole). ``repaired_sha256``: of the
    repaired turns as ``role:text``, joined by newlines. A null key is a
    conversation of its own. One without rows has zeros, an empty audit and the
    digest of nothing; an empty table gives no rows. Texts may be of any length.
    Columns other than those ``damaged`` was given do not matter.

    Conversations of more than ``long`` rows are streamed instead of held. As a
    digest is taken in order, one task still reads the whole of one.
    """
    return _repaired(rows, False, long).withColumnRenamed("key", key)


def repaired(rows: DataFrame, *, key: str = "conv_id", long: int = LONG) -> DataFrame:
    """The turns of the repaired conversations: (key, place from 1, role, text); see ``report``."""
    return _repaired(rows, True, long).withColumnRenamed("key", key)
