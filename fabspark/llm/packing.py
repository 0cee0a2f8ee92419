"""Packing of token ids into windows by minimum bin slack.

A document is its ids and an end id, cut at full windows; what is left over is
shorter than a window. Those pieces are only counted by length, so the choice of
windows works on at most ``size`` numbers, however many documents there are.

A window is opened with the longest length that is left. A bitset of reachable
sums (one integer, shifted and joined for every length) finds the multiset of
other lengths that comes closest to the rest of the window, and the bitsets
kept on the way give its counts. It is taken as often as the counts allow, so
every choice uses up a length to below its count in the window: there are at most
sum(size / length), some 17,000 for 2,048. A length that no multiset completes
without slack is set aside. Lengths set aside are laid end to end and cut at
window borders; the last, unfinished window is cut into powers of two, which are
not padded. So nothing is padded, and only documents set aside are cut.

Pieces find their window by their number among those of equal length: counts per
task and length are summed up over the tasks, and tasks number their own pieces.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabspark.session import settled

SIZE = 2048
END = 1
STEP = 1024  # rows of a batch of output

_LIMIT = 1 << 50  # more pieces of one length than there can be


def read_vocabulary(path: str) -> bytes:
    """The tokenizer's file, read where the job is planned."""
    with open(path, "rb") as f:
        return f.read()


@lru_cache(2)
def encoder(vocabulary: bytes, pattern: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizer file, special tokens being ordinary text.

    Ids must follow the order of the merges, as then they are ranks; a file that
    does not, or that changes texts first, is refused.
    """
    file = json.loads(vocabulary)
    model, split = file["model"], file["pre_tokenizer"]
    if file["normalizer"] or model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"]:
        raise ValueError("not a plain byte-level BPE")
    made = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    order = [model["vocab"]["".join(m)] for m in made]
    if order != sorted(order):
        raise ValueError("ids do not follow the merges")
    # Bytes are written as characters: those that can be seen as themselves, the others from 256 up.
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in seen} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in seen)}
    special = {t["content"] for t in file.get("added_tokens", []) if t["special"]}
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
    return tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def fill(counts: dict[int, int], lengths: list[int], room: int) -> tuple[int, list[tuple[int, int]]]:
    """The sum closest to ``room`` that a multiset of the lengths (falling, at most so many of each) has, and its counts."""
    reach, kept = 1, []
    mask = (1 << (room + 1)) - 1
    for n in lengths:
        if n > room or reach >> room:
            continue
        before, left, some = reach, min(counts[n], room // n), 1
        while left:
            take = min(some, left)
            reach |= (reach << (n * take)) & mask
            left, some = left - take, some * 2
        kept.append((n, before))
    best = at = reach.bit_length() - 1
    out = []
    for n, before in reversed(kept):
        c = 0
        while not before >> at & 1:
            at, c = at - n, c + 1
        if c:
            out.append((n, c))
    return best, out


def windows(counts: dict[int, int], size: int = SIZE) -> tuple[list[tuple[int, list[tuple[int, int]]]], dict[int, int]]:
    """Windows without slack as (times, [(length, count)]), and the numbers of pieces set aside by length."""
    left = {n: c for n, c in counts.items() if c}
    lengths = sorted(left, reverse=True)
    made, aside = [], {}
    while lengths:
        n = lengths[0]
        left[n] -= 1
        full, more = fill(left, lengths, size - n)
        left[n] += 1
        if full < size - n:
            aside[n] = left.pop(n)
            lengths.pop(0)
            continue
        window = Counter({n: 1})
        for m, c in more:
            window[m] += c
        times = min(left[m] // c for m, c in window.items())
        made.append((times, sorted(window.items(), reverse=True)))
        for m, c in window.items():
            left[m] -= times * c
            if not left[m]:
                del left[m]
        lengths = [m for m in lengths if m in left]
    return made, aside


@dataclass
class Plan:
    """Where the pieces of each length go, as runs of their numbers."""

    first: np.ndarray  # length * _LIMIT + number of a run's first piece
    each: np.ndarray  # pieces of the length in a window; 0 where they are set aside
    sequence: np.ndarray  # first window of the run
    offset: np.ndarray  # of the first piece in its window, or where the run starts among those set aside
    beyond: int  # sequences before those set aside
    borders: np.ndarray  # where sequences of those set aside start after the last full window, and the end

    @staticmethod
    def of(counts: dict[int, int], size: int = SIZE) -> Plan:
        made, aside = windows(counts, size)
        used: Counter = Counter()
        runs, base = [], 0
        for times, window in made:
            at = 0
            for n, c in window:
                runs.append((n * _LIMIT + used[n], c, base, at))
                used[n] += c * times
                at += n * c
            base += times
        at = 0
        for n in sorted(aside, reverse=True):
            runs.append((n * _LIMIT + used[n], 0, 0, at))
            at += n * aside[n]
        borders = [at - at % size]
        while borders[-1] < at:
            borders.append(borders[-1] + (1 << (at - borders[-1]).bit_length() - 1))
        first, each, sequence, offset = (np.array(c, np.int64) for c in zip(*sorted(runs))) if runs else [np.zeros(0, np.int64)] * 4
        return Plan(first, each, sequence, offset, base, np.array(borders, np.int64))

    def places(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of pieces; for those set aside -1 and where they start among themselves."""
        run = np.searchsorted(self.first, length * _LIMIT + number, "right") - 1
        nth, each = length * _LIMIT + number - self.first[run], self.each[run]
        whole = each > 0
        per = np.maximum(each, 1)
        sequence, offset = self.sequence[run] + nth // per, self.offset[run] + nth % per * length
        at = self.offset[run] + nth * length
        return np.where(whole, sequence, -1), np.where(whole, offset, at)

    def cut(self, at: int, length: int, size: int) -> Iterator[tuple[int, int, int, int]]:
        """(start in the piece, length, sequence, offset) of the parts of a piece set aside."""
        end, start = at + length, at
        last, tail = int(self.borders[0]), self.borders
        while start < end:
            if start < last:
                seq, low, high = start // size, start - start % size, start - start % size + size
            else:
                k = int(np.searchsorted(tail, start, "right")) - 1
                seq, low, high = last // size + k, int(tail[k]), int(tail[k + 1])
            stop = min(end, high)
            yield start - at, stop - start, self.beyond + seq, start - low
            start = stop


def pieces(docs: DataFrame, vocabulary: bytes, pattern: str, *, key: str = "doc_id", text: str = "text", size: int = SIZE,
           end: int = END, ids: bool = False) -> DataFrame:
    """Documents cut at full windows: (key, start, length, crc, total, task, number, ids).

    ``number`` counts the pieces of a length within their task. Full windows carry no
    ids unless ``ids`` is set; shorter pieces always do, as they may be cut.
    """
    names = ["key", "start", "length", "crc", "total", "task", "number", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, task = encoder(vocabulary, pattern), TaskContext.get().partitionId()
        seen = [0] * (size + 1)
        for batch in batches:
            for low in range(0, batch.num_rows, STEP):
                some = batch.slice(low, STEP)
                rows: list[list] = [[] for _ in names[1:]]
                of = []
                for d, t in enumerate(some.column(1)):
                    all_ = np.append(code.encode_to_numpy(t.as_py() or "").astype("<u4"), np.uint32(end)).astype("<u4")
                    for start in range(0, len(all_), size):
                        part = all_[start:start + size]
                        n = len(part)
                        of.append(d)
                        for column, x in zip(rows, (start, n, zlib.crc32(part.tobytes()), len(all_), task, seen[n],
                                                    part.tobytes() if ids or n < size else None)):
                            column.append(x)
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [some.column(0).take(pa.array(of, pa.int64())), *(pa.array(c, pa.int64()) for c in rows[:-1]),
                     pa.array(rows[-1], pa.binary())], names)

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").alias("text")).mapInArrow(
        run, f"key {kind}, start long, length long, crc long, total long, task long, number long, ids binary")


def pack(docs: DataFrame, vocabulary: bytes, pattern: str, *, key: str = "doc_id", text: str = "text", size: int = SIZE,
         end: int = END, ids: bool = False) -> DataFrame:
    """Every piece of every document with its place in a sequence of at most ``size`` tokens.

    Returns ``key``, ``start`` (its document's ids before it), ``length``,
    ``ids_crc32`` (of the ids as little-endian unsigned 32-bit integers),
    ``doc_tokens`` (with the end id), ``sequence_id``, ``offset`` in the sequence, and
    with ``ids`` the ids themselves as such integers. Sequences have no gaps; all
    have ``size`` tokens but at most log2(size), whose sizes are powers of two.

    A null or empty text is its end id alone. Rows that repeat a key, and those of
    a null key, are documents of their own. Texts may be of any length; an empty
    table gives no rows. Other columns are dropped, whatever their names. Among
    pieces of equal length the scan's order decides, so ties have no other rule.
    """
    made = settled(pieces(docs, vocabulary, pattern, key=key, text=text, size=size, end=end, ids=ids), "pieces")
    counts = settled(made.groupBy("task", "length").agg(F.count("*").alias("n")), "counts")
    by_length = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most ``size`` rows
    plan = Plan.of(by_length, size)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = settled(counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")), "before")
    names = ["key", "start", "length", "crc", "total", "sequence", "offset", *(["ids"] if ids else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            start, length, crc, total, number = (batch.column(c).to_numpy() for c in ("start", "length", "crc", "total", "number"))
            sequence, offset = plan.places(length, number)
            aside = np.flatnonzero(sequence < 0)
            stay = np.flatnonzero(sequence >= 0)
            of, cols = stay.tolist(), [x[stay].tolist() for x in (start, length, crc, total, sequence, offset)]
            held = batch.column("ids")
            new_ids = [held[i].as_py() for i in of] if ids else []
            for i in aside.tolist():
                parts = list(plan.cut(int(offset[i]), int(length[i]), size))
                data = held[i].as_py() if ids or len(parts) > 1 else b""
                for a, n, seq, at in parts:
                    c = int(crc[i]) if len(parts) == 1 else zlib.crc32(data[4 * a:4 * (a + n)])
                    of.append(i)
                    for column, x in zip(cols, (int(start[i]) + a, n, c, int(total[i]), seq, at)):
                        column.append(x)
                    if ids:
                        new_ids.append(data[4 * a:4 * (a + n)])
            arrays = [batch.column("key").take(pa.array(of, pa.int64())), *(pa.array(c, pa.int64()) for c in cols)]
            yield pa.RecordBatch.from_arrays(arrays + ([pa.array(new_ids, pa.binary())] if ids else []), names)

    kind = docs.schema[key].dataType.simpleString()
    placed = made.join(base, ["task", "length"]).select(
        "key", "start", "length", "crc", "total", (F.col("number") + F.col("before")).alias("number"), "ids")
    out = placed.mapInArrow(run, f"key {kind}, " + ", ".join(f"{n} long" for n in names[1:7]) + (", ids binary" if ids else ""))
    return out.select(F.col("key").alias(key), "start", "length", F.col("crc").alias("ids_crc32"),
                      F.col("total").alias("doc_tokens"), F.col("sequence").alias("sequence_id"), "offset",
                      *(["ids"] if ids else []))


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences of pieces that ``pack(ids=True)`` gives: (sequence_id, length, ids).

    ``ids`` are little-endian unsigned 32-bit integers. Pieces of a sequence are few
    and together at most as long as it, so no group grows with the data.
    """
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    hexes = F.array_join(F.transform(parts["ids"], F.hex), "")
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), F.unhex(hexes).alias("ids"))
