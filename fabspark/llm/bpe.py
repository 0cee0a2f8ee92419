"""Byte-level BPE by longest matches and backtracking.

A sequence of tokens is the result of the merges exactly if each two neighbours
are compatible: merging the bytes of both gives these two tokens again. So a
piece of text is encoded from left to right with the longest token at each
place (the lengths to try there follow from the bytes it starts with),
stepping back to a shorter one where neighbours are not compatible. Compatibility is remembered per pair and places from which
no end can be reached are remembered per piece, so each place is tried once.

Words not met before are encoded many at once, in numpy: each round finds the
next longest token of all of them in a trie. There two tokens are compatible if,
when their merges are undone one by one, the latest first, no merge across the
border would have come before the one undone. What is left when few words are
not at their end yet is encoded one by one.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Callable, Hashable, Iterator
from functools import cached_property
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PIECES_KEPT = 256_000  # encodings of words, of matches, and pairs that a worker remembers, each; the oldest go first
LONGEST_KEPT = 64  # characters of a piece that is remembered
STEP = 256  # rows of output at a time
BLOCK = 1 << 20  # characters after which the texts at hand are encoded
FEW = 100  # words not met before; fewer are encoded one by one
FIRST = 4  # bytes that tell how long a token may be
NONE = 1 << 40  # above any rank
AHEAD = -2  # for the longest token, in place of a token


def read_ranks(path: str) -> bytes:
    """The rank file, read where the job is planned; its size is that of the vocabulary."""
    with open(path, "rb") as f:
        return f.read()


class Coder:
    """Encodes and decodes with the ranks and the split pattern of a byte-level BPE.

    ``encode`` equals merging the pair of lowest rank, leftmost first, within each
    match of the pattern; a match that is itself a token is that token. Special
    tokens are ordinary text. Empty text has no tokens.
    """

    def __init__(self, ranks: bytes, pattern: str):
        pairs = (line.split() for line in ranks.splitlines() if line)
        self.ids = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.bytes = {i: token for token, i in self.ids.items()}
        self.pattern = regex.compile(pattern)
        # Chunks that the pattern never joins: no white space but one space in front.
        self.plain = regex.compile(r"\S+(?: \S+)*")
        self.reach: dict[bytes, int] = {}  # the length of the longest token by its first bytes
        for token in self.ids:
            if len(token) >= FIRST:
                self.reach[token[:FIRST]] = max(len(token), self.reach.get(token[:FIRST], 0))
        self.pairs = _Kept(self.compatible_pair)  # by left id << 32 | right id
        self.pieces = _Kept(self.piece_bytes, self.all_pieces)  # matches of the pattern
        self.chunks = _Kept(self.chunk_bytes, self.all_chunks)  # words with the space in front, each of which is a row of matches

    @cached_property
    def tokens(self) -> dict[bytes, int]:
        """All tokens that the merges can make."""
        return {token: self.ids[token] for token in self.halves}

    @cached_property
    def halves(self) -> dict[bytes, list[bytes]]:
        """All tokens that the merges can make, each with the two parts that its last merge joins (a byte: itself)."""
        found = {token: self.parts(token, 2) for token in self.ids}
        return {token: parts for token, parts in found.items() if len(parts) <= 2}

    @cached_property
    def together(self) -> _Together | None:
        """Encodes many pieces at once; none if merges of a token come in another order than that of their ranks."""
        found = _Together(self)
        return found if found.in_order else None

    def merge(self, piece: bytes) -> list[int]:
        """Merges one by one; for tokens and pairs of tokens, which are short."""
        return [self.ids[p] for p in self.parts(piece, 1)]

    def parts(self, piece: bytes, least: int) -> list[bytes]:
        """What merging leaves, down to ``least`` parts."""
        rank = self.ids.get
        parts = [piece[i:i + 1] for i in range(len(piece))]
        ranks = [rank(piece[i:i + 2], NONE) for i in range(len(piece) - 1)]  # of each part joined to the next one
        while len(ranks) >= least:
            best = min(ranks)
            if best == NONE:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at], NONE)
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1], NONE)
        return parts

    def compatible_pair(self, pair: int) -> bool:
        left, right = pair >> 32, pair & 0xFFFFFFFF
        return self.merge(self.bytes[left] + self.bytes[right]) == [left, right]

    def piece_ids(self, piece: bytes) -> list[int]:
        """Tokens of one match of the pattern."""
        whole = self.ids.get(piece)
        if whole is not None:
            return [whole]
        chosen: list[int] = []  # ids so far
        starts: list[int] = []  # where each of them starts
        dead: set[int] = set()
        size, pos = len(piece), 0
        end = self.reach.get(piece[:FIRST], FIRST - 1)  # the next token starts at ``pos`` and ends here or before
        token, pairs, reach = self.tokens.get, self.pairs, self.reach
        while pos < size:
            if end > size:
                end = size
            while end > pos:
                i = token(piece[pos:end])
                if i is not None and end not in dead and (not chosen or pairs[chosen[-1] << 32 | i]):
                    break
                end -= 1
            if end > pos:
                chosen.append(i)
                starts.append(pos)
                pos = end
                end = pos + reach.get(piece[pos:pos + FIRST], FIRST - 1)
            else:  # no token here follows the last one: a shorter one instead of it
                dead.add(pos)
                chosen.pop()
                pos, end = starts.pop(), pos - 1
        return chosen

    def piece_bytes(self, piece: str) -> bytes:
        return np.array(self.piece_ids(piece.encode()), "<u4").tobytes()

    def chunk_bytes(self, chunk: str) -> bytes:
        found = self.pattern.findall(chunk)
        if len(found) == 1:  # remembered as a chunk
            return self.piece_bytes(found[0])
        return b"".join([self.pieces[p] for p in found])

    def all_pieces(self, pieces: list[str]) -> list[bytes]:
        if len(pieces) < FEW or not self.together:
            return [self.piece_bytes(p) for p in pieces]
        return self.together.encode([p.encode() for p in pieces])

    def all_chunks(self, chunks: list[str]) -> list[bytes]:
        spaced = [c for c in chunks if c[0] == " "]
        found = self.pattern.findall("".join(spaced))  # only the first match of a chunk starts with a space
        starts = [n for n, p in enumerate(found) if p[0] == " "]
        if len(starts) < len(spaced):  # the pattern leaves spaces out
            return [self.chunk_bytes(c) for c in chunks]
        starts.append(len(found))
        alone = {c: found[a] for c, a, b in zip(spaced, starts, starts[1:]) if b - a == 1}
        rows = {c: found[a:b] for c, a, b in zip(spaced, starts, starts[1:]) if b - a > 1}
        for c in chunks:
            if c[0] != " ":
                f = self.pattern.findall(c)
                if len(f) == 1:
                    alone[c] = f[0]
                else:
                    rows[c] = f
        out = dict(zip(alone, self.all_pieces(list(alone.values()))))
        pieces = iter(self.pieces.all([p for f in rows.values() for p in f]))
        out.update((c, b"".join(islice(pieces, len(f)))) for c, f in rows.items())
        return [out[c] for c in chunks]

    def cut(self, text: str) -> list[list[str]] | None:
        """The chunks of each line; none where white space is in other places, as the pattern decides there."""
        lines = text.split("\n")
        if "\0" in text or not all(map(self.plain.fullmatch, lines)):
            return None
        return [line.replace(" ", "\0 ").split("\0") for line in lines]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return self.encode_block([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, some texts at a time."""
        out, first, size = [], 0, 0
        for n, text in enumerate(texts, 1):
            size += len(text)
            if size >= BLOCK or n == len(texts):
                out += self.encode_block(texts[first:n])
                first, size = n, 0
        return out

    def encode_block(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; what was not met before is encoded together."""
        cuts = [self.cut(t) for t in texts]
        found = [self.pattern.findall(t) if lines is None else [] for t, lines in zip(texts, cuts)]
        chunks = iter(self.chunks.all([c for lines in cuts if lines for line in lines for c in line]))
        pieces = iter(self.pieces.all([p for f in found for p in f]))
        newline = self.pieces["\n"]
        return [b"".join(islice(pieces, len(f))) if lines is None
                else newline.join([b"".join(islice(chunks, len(line))) for line in lines])
                for f, lines in zip(found, cuts)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Kept(dict):
    """What ``make`` gave, in two generations: entries of the older one that are asked for again move to the newer.

    A text longer than ``LONGEST_KEPT`` is not remembered. Both generations
    together hold at most ``PIECES_KEPT`` entries.
    """

    def __init__(self, make: Callable[[Hashable], object], make_all: Callable[[list], list] | None = None):
        super().__init__()
        self.make, self.make_all, self.old = make, make_all, {}

    def __missing__(self, key: Hashable) -> object:
        found = self.old.pop(key, None)
        if found is None:
            found = self.make(key)
        self.put(key, found)
        return found

    def put(self, key: Hashable, found: object) -> None:
        if isinstance(key, str) and len(key) > LONGEST_KEPT:
            return
        if len(self) >= PIECES_KEPT // 2:
            self.old = dict(self)
            self.clear()
        self[key] = found

    def all(self, keys: list[str]) -> list:
        """What belongs to each key; what is not remembered is made together, if it is much."""
        found = list(map(self.get, keys))
        got = dict.fromkeys([k for k, f in zip(keys, found) if f is None])
        if not got:
            return found
        for k in got:
            got[k] = self.old.pop(k, None)
        new = [k for k, f in got.items() if f is None]
        got.update(zip(new, map(self.make, new) if len(new) < FEW else self.make_all(new)))
        for k, f in got.items():
            self.put(k, f)
        return [got[k] if f is None else f for k, f in zip(keys, found)]


class _Table:
    """Whole numbers from 0 by whole numbers from 0, asked for many at once; -1 where there is none."""

    def __init__(self, entries: dict[int, int]):
        keys = np.fromiter(entries, np.int64, len(entries))
        bits = (4 * len(keys)).bit_length()
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1), np.full(1 << bits, -1)
        slot, left = self.slot(keys), np.arange(len(keys))
        while left.size:
            free = left[self.keys[slot[left]] < 0]
            self.keys[slot[free]] = keys[free]  # of several, one stays
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = slot[left] + 1 & self.last
        self.values[slot] = np.fromiter(entries.values(), np.int64, len(entries))

    def slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).view(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slot = self.slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], -1)
        more = np.flatnonzero((found != keys) & (found >= 0))
        while more.size:
            slot[more] = slot[more] + 1 & self.last
            found = self.keys[slot[more]]
            hit = found == keys[more]
            out[more[hit]] = self.values[slot[more[hit]]]
            more = more[~hit & (found >= 0)]
        return out




class _Together:
    """Encodes many pieces at once, by tables of the tokens that the merges of a ``Coder`` can make."""

    def __init__(self, coder: Coder):
        tokens, self.one = coder.tokens, coder.piece_ids
        self.unmade = coder.ids.keys() - tokens.keys()
        size = max(coder.ids.values(), default=0) + 1
        self.length, self.shorter = np.zeros(size, np.int64), np.full(size, -1)  # shorter: the next token it starts with
        self.born, self.left, self.right = (np.full(size, -1) for _ in range(3))  # born: the rank of the last merge
        nodes = {b"": 0}
        joined: dict[int, int] = {}  # the rank of two tokens' bytes together, by left id << 32 | right id
        for token, i in coder.ids.items():
            for k in range(1, len(token)):
                a, b = tokens.get(token[:k]), tokens.get(token[k:])
                if a is not None and b is not None:
                    joined[a << 32 | b] = i
        for token, i in tokens.items():
            for k in range(1, len(token) + 1):
                nodes.setdefault(token[:k], len(nodes))
                if k < len(token) and token[:k] in tokens:
                    self.shorter[i] = tokens[token[:k]]
            self.length[i] = len(token)
            if len(token) > 1:
                self.born[i] = i
                self.left[i], self.right[i] = (tokens.get(p, -1) for p in coder.halves[token])
        made = np.flatnonzero(self.born >= 0)
        halves = np.stack([self.left[made], self.right[made]])
        self.in_order = bool((halves >= 0).all() and (self.born[halves] < made).all())
        self.pairs = _Table(joined)
        self.steps = _Table({nodes[n[:-1]] << 8 | n[-1]: k for n, k in nodes.items() if n})
        self.token = np.array([tokens.get(n, -1) for n in nodes])
        self.inner = np.zeros(len(nodes), bool)
        self.inner[[nodes[n[:-1]] for n in nodes if n]] = True

    def longest(self, data: np.ndarray, at: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The longest token at each place, before its end; -1 if there is none."""
        found, rows, node = np.full(len(at), -1), np.arange(len(at)), np.zeros(len(at), np.int64)
        while rows.size:
            node = self.steps.get(node << 8 | data[at])
            token = self.token[node]  # of the last node where there is no step, but that is not used
            hit = (node >= 0) & (token >= 0)
            found[rows[hit]] = token[hit]
            at = at + 1
            on = np.flatnonzero((node >= 0) & self.inner[node] & (at < end))
            rows, node, at, end = rows[on], node[on], at[on], end[on]
        return found

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging the bytes of both tokens gives these two again."""
        out, rows = np.ones(len(left), bool), np.arange(len(left))
        limit = np.full(len(left), NONE)  # ranks below would have been merged across before the merge undone last
        while rows.size:
            across = self.pairs.get(left << 32 | right)
            crossed = (across >= 0) & (across < limit)
            out[rows[crossed]] = False
            a, b = self.born[left], self.born[right]
            on = np.flatnonzero(~crossed & (np.maximum(a, b) >= 0))
            rows, left, right, a, b = rows[on], left[on], right[on], a[on], b[on]
            later = a > b  # of equal ranks the left one is merged first
            limit = np.where(later, a, b + 1)
            left, right = np.where(later, self.right[left], left), np.where(later, right, self.left[right])
        return out

    def encode(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ends = size.cumsum()
        starts = ends - size
        ids = np.full(len(data), -1)  # where a token starts
        came = np.zeros(len(data) + 1, np.int64)  # where the token before starts
        dead = np.zeros(len(data) + 1, bool)  # from there no end can be reached
        single = [k for k, p in enumerate(pieces) if p in self.unmade] if self.unmade else []
        rows = np.flatnonzero(size)
        at, token = starts[rows], np.full(len(rows), AHEAD)
        while rows.size >= FEW:
            start, end = starts[rows], ends[rows]
            ahead = np.flatnonzero(token == AHEAD)
            token[ahead] = self.longest(data, at[ahead], end[ahead])
            last = np.where(at > start, ids[came[at]], -1)
            left = np.flatnonzero(token >= 0)
            while left.size:
                bad = dead[at[left] + self.length[token[left]]]
                ask = np.flatnonzero(~bad & (last[left] >= 0))
                bad[ask] = ~self.compatible(last[left[ask]], token[left[ask]])
                left = left[bad]
                token[left] = self.shorter[token[left]]
                left = left[token[left] >= 0]
            ids[at] = token
            back = np.flatnonzero((token < 0) & (at > start))  # a shorter one instead of the token before
            single += rows[(token < 0) & (at == start)].tolist()
            to = at + self.length[token]
            came[to[token >= 0]] = at[token >= 0]
            dead[at[back]] = True
            to[back] = came[at[back]]
            on = np.flatnonzero((token >= 0) & (to < end))
            token = np.concatenate([np.full(len(on), AHEAD), self.shorter[ids[to[back]]]])
            ids[to[back]] = -1
            on = np.concatenate([on, back])
            rows, at = rows[on], to[on]
        single += rows.tolist()
        taken = ids >= 0
        until = np.concatenate([[0], taken.cumsum()]) * 4
        made = ids[taken].astype("<u4").tobytes()
        out = [made[a:b] for a, b in zip(until[starts].tolist(), until[ends].tolist())]
        for k in single:
            out[k] = np.array(self.one(pieces[k]), "<u4").tobytes()
        return out


_CODERS: dict[tuple[str, str], Coder] = {}


def coder(ranks: bytes, pattern: str) -> Coder:
    """The worker's coder for this vocabulary."""
    key = (hashlib.sha256(ranks).hexdigest(), pattern)
    if key not in _CODERS:
        _CODERS.clear()
        _CODERS[key] = Coder(ranks, pattern)
    return _CODERS[key]


def encode(df: DataFrame, ranks: bytes, pattern: str, text: str = "text", *, key: str = "doc_id",
           keep: list[str] | None = None, ids: bool = True) -> DataFrame:
    """Token ids of each text, with their number and digests of ids and decoded bytes.

    Returns ``key`` and the columns ``keep`` as they are, and ``n_tokens`` (long),
    ``ids`` (binary, little-endian unsigned 32-bit; left out if ``ids`` is false),
    ``ids_sha256`` and ``decoded_sha256``. A null text counts as empty: no tokens.
    Repeated rows and null keys are encoded one by one. Other columns are dropped.
    The rank file is broadcast: its size is that of the vocabulary.
    """
    shared = df.sparkSession.sparkContext.broadcast(ranks)
    keep = [key] + [c for c in keep or [] if c != key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(shared.value, pattern)
        for batch in batches:
            for lo in range(0, batch.num_rows, STEP):
                part = batch.slice(lo, STEP)
                rows = c.encode_all([t or "" for t in part.column(len(keep)).to_pylist()])
                out = [part.column(i) for i in range(len(keep))]
                out.append(pa.array([len(x) // 4 for x in rows], pa.int64()))
                if ids:
                    out.append(pa.array(rows, pa.binary()))
                out.append(pa.array([hashlib.sha256(x).hexdigest() for x in rows], pa.string()))
                out.append(pa.array([hashlib.sha256(c.decode(x)).hexdigest() for x in rows], pa.string()))
                yield pa.RecordBatch.from_arrays(out, names)

    kept = [f"`{f.name}` {f.dataType.simpleString()}" for c in keep for f in df.schema.fields if f.name == c]
    made = ["n_tokens long", *["ids binary"] * ids, "ids_sha256 string", "decoded_sha256 string"]
    names = keep + [m.split()[0] for m in made]
    return df.select(*(F.col(f"`{c}`") for c in keep), F.col(f"`{text}`").alias("text")) \
        .mapInArrow(run, ", ".join(kept + made))


def decode(df: DataFrame, ranks: bytes, pattern: str, ids: str = "ids", *, key: str = "doc_id") -> DataFrame:
    """Texts of encoded ids: ``key`` and ``text``; null ids give a null text."""
    shared = df.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(shared.value, pattern)
        for batch in batches:
            rows = [None if x is None else c.decode(x).decode("utf-8", "replace") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.string())], [key, "text"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(f"`{key}`"), F.col(f"`{ids}`")).mapInArrow(run, f"`{key}` {kind}, text string")
