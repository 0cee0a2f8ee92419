"""Phrase collocations by vertically partitioned, depth-truncated suffix trees.

The suffixes of all pieces, cut after four words, form one tree for each
language; the count of a phrase is the number of leaves below its node. The tree
is never built as a whole: suffixes are grouped by the words they start with,
so that the subtrees of a group fit a task's memory, and each group builds its
own. A prefix is one word; where more than ``BUDGET`` suffixes start with it, so
that its subtree might not fit, two words, and where these do too, three. The
number of groups follows from the sum of what they hold.

Words below the least count cannot be part of a phrase and cut suffixes short. A
bitmap of fixed size, by hash, tells tasks which are frequent; where two fall on
one bit, suffixes are longer than need be and counts stay exact, as phrases are
compared as text. Leaves are added up in the tasks first, so a phrase that stands
everywhere is a few leaves for each, and go to their group as compressed lists.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fabspark.llm.text import Texts, mix, span_hashes, texts
from fabspark.session import settled

LEAST = 30
LONGEST = 4
TOP = 2000
COVERED = 80  # percent of a phrase's count within a longer one at which it is dropped
SCALE = 2_000_000
#: Exact where the product passes 64 bits.
SCORE = f"CAST({SCALE} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(19,0)) DIV (CAST(l AS DECIMAL(19,0)) + CAST(r AS DECIMAL(19,0)))"
BUDGET = 1_000_000  # suffixes of a group
GROUPS = 512  # at least
BITS = 27  # of the bitmap's size: 16 MB
HELD = 150_000  # distinct entries a task holds before it hands them on

_CUT = np.zeros(256, bool)
_CUT[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _CUT.copy()
_GAP[[0x20, 0x09]] = True
_NEXT = np.uint64(0x9E3779B97F4A7C15)  # fixed value: an odd multiplier
_PAGE = 20  # bits of a place within a page of the bitmap


class _Pieces:
    """Words of some texts in a buffer where one space stands between the words of a piece.

    ``starts``, ``ends``: word bounds in ``data``; ``ahead``: words that follow in the
    same piece; ``doc``: the text a word is of.
    """

    def __init__(self, t: Texts):
        t = t.lowered()
        gap = np.ones(len(t.data) + 2, bool)
        gap[1:-1] = _GAP[t.data]
        starts, ends = ~gap[1:] & gap[:-1], gap[1:] & ~gap[:-1]
        border = t.offsets[1:-1]
        border = border[~gap[border] & ~gap[border + 1]]  # a word ends where its text does
        starts[border] = True
        ends[border] = True
        old_starts, old_ends = np.flatnonzero(starts), np.flatnonzero(ends)
        n = len(old_starts)
        self.doc = np.searchsorted(t.offsets, old_starts, "right") - 1
        cuts = np.zeros(len(t.data) + 1, np.int64)
        np.cumsum(_CUT[t.data], out=cuts[1:])
        piece = cuts[old_starts]
        same = np.zeros(n, bool)
        if n:
            same[:-1] = (piece[1:] == piece[:-1]) & (self.doc[1:] == self.doc[:-1])
        self.ahead = np.zeros(n, np.int64)
        run = np.zeros(n + LONGEST, bool)
        run[:n] = same
        along = run[:n].copy()
        for k in range(1, LONGEST):
            self.ahead += along
            along &= run[k:n + k]
        lengths = old_ends - old_starts
        self.starts = np.zeros(n, np.int64)
        if n:
            np.cumsum(lengths[:-1] + 1, out=self.starts[1:])
        self.ends = self.starts + lengths
        self.data = np.full(int(self.ends[-1]) + 1 if n else 0, 0x20, np.uint8)
        self.data[_ranges(self.starts, lengths)] = t.data[_ranges(old_starts, lengths)]

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def texts(self, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
        return _texts(self.data, starts, ends)


def _texts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte ranges as texts."""
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[_ranges(starts, ends - starts)]))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All indices of the ranges, one after the other."""
    total = int(lengths.sum())
    before = np.cumsum(lengths) - lengths
    return np.arange(total, dtype=np.int64) + np.repeat(starts - before, lengths)


class _Tally:
    """Counts of (language, text, ...) held in a task until there are many."""

    def __init__(self, keys: list[str]):
        self.keys, self.parts, self.rows = keys, [], 0

    def add(self, table: pa.Table) -> Iterator[pa.Table]:
        if table.num_rows:
            self.parts.append(self._sum(table))
            self.rows += self.parts[-1].num_rows
        if self.rows > 2 * HELD:
            self.parts = [self._sum(pa.concat_tables(self.parts))]
            self.rows = self.parts[0].num_rows
            if self.rows > HELD:
                yield from self.rest()

    def _sum(self, table: pa.Table) -> pa.Table:
        return table.group_by(self.keys).aggregate([("n", "sum")]).rename_columns([*self.keys, "n"])

    def rest(self) -> Iterator[pa.Table]:
        if self.parts:
            whole = self._sum(pa.concat_tables(self.parts)).combine_chunks()
            self.parts, self.rows = [], 0
            yield whole
            del whole
            pa.default_memory_pool().release_unused()  # the worker lives on beside others


def _lang_hashes(langs: list[str]) -> np.ndarray:
    data = [v.encode() for v in langs]
    ends = np.cumsum([len(d) for d in data]).astype(np.int64)
    return span_hashes(np.frombuffer(b"".join(data), np.uint8), np.r_[0, ends[:-1]].astype(np.int64), ends)


def _of_lang(words: np.ndarray, langs: list[str], codes: np.ndarray) -> np.ndarray:
    """Hashes of words within their languages."""
    return mix(words ^ mix(_lang_hashes(langs))[codes]) if len(words) else words


def _pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, _Pieces]]:
    """(languages, which of them each word is of, words) of batches of (lang, text)."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        codes = langs.indices.to_numpy(zero_copy_only=False)
        for t in texts(batch.column(1)):
            p = _Pieces(t)
            if len(p.starts):
                yield langs.dictionary.to_pylist(), codes[t.at + p.doc], p


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, n) of all words of (lang, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally(["lang", "word"])
        for langs, codes, p in _pieces_of(batches):
            for full in tally.add(pa.table({"lang": pa.array(langs, pa.string()).take(pa.array(codes)),
                                            "word": p.texts(p.starts, p.ends), "n": np.ones(len(codes), np.int64)})):
                yield from full.to_batches(max_chunksize=65536)
        for full in tally.rest():
            yield from full.to_batches(max_chunksize=65536)

    return docs.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _cells(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64((1 << BITS) - 1)).astype(np.int64)


def _marked(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    at = _cells(hashes)
    return np.frombuffer(bits, np.uint8)[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1 > 0


def bitmap(cells: DataFrame) -> bytes:
    """A bit for each row of (cell), 2 ** ``BITS`` bits whatever the number of rows."""
    def page(t: pa.Table) -> pa.Table:
        bits = np.zeros(1 << _PAGE, bool)
        bits[t.column("cell").to_numpy() & (1 << _PAGE) - 1] = True
        return pa.table({"page": [t.column("cell")[0].as_py() >> _PAGE], "bits": pa.array([np.packbits(bits).tobytes()])})

    found = cells.select("cell").distinct().groupBy(F.shiftright("cell", _PAGE).alias("page")).applyInArrow(page, "page long, bits binary")
    size = 1 << _PAGE - 3
    out = bytearray(1 << BITS - 3)
    for n, bits in found.collect():  # at most 2 ** BITS / 8 bytes in all
        out[n * size:(n + 1) * size] = bits
    return bytes(out)


def word_cells(words: DataFrame) -> DataFrame:
    """(cell) of words in a table (lang, word)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            codes = langs.indices.to_numpy(zero_copy_only=False)
            for t in texts(batch.column(1)):
                h = _of_lang(span_hashes(t.data, t.offsets[:-1], t.offsets[1:]), langs.dictionary.to_pylist(),
                             codes[t.at:t.at + len(t)])
                yield pa.RecordBatch.from_arrays([pa.array(_cells(h))], ["cell"])

    return words.select("lang", "word").mapInArrow(run, "cell long")


def _pairs(h: np.ndarray) -> np.ndarray:
    """Hashes of each word with the next one."""
    return mix(h * _NEXT + np.r_[h[1:], h[:1]])


def pair_cells(docs: DataFrame, hot: bytes) -> DataFrame:
    """(cell, n) of neighbouring words of which the first is marked in ``hot``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            cell, n = np.unique(np.concatenate(held), return_counts=True)
            for low in range(0, len(cell), 65536):
                yield pa.RecordBatch.from_arrays([pa.array(cell[low:low + 65536]), pa.array(n[low:low + 65536])], ["cell", "n"])

        for langs, codes, p in _pieces_of(batches):
            h = _of_lang(p.hashes(), langs, codes)
            held.append(_cells(_pairs(h)[(p.ahead > 0) & _marked(hot, h)]))
            rows += len(held[-1])
            if rows > 8 * HELD:
                yield from out()
                held, rows = [], 0
        if held:
            yield from out()

    return docs.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))


def _leaf_lists(found: pa.Table) -> Iterator[pa.RecordBatch]:
    """Leaves as one row a group: (group, leaves), a compressed Arrow stream of (lang, suffix, n)."""
    found = found.take(pa.array(np.argsort(found.column("group").to_numpy(), kind="stable"))).combine_chunks()
    group = found.column("group").to_numpy()
    bounds = np.flatnonzero(np.r_[True, group[1:] != group[:-1], True]) if len(group) else np.zeros(0, np.int64)
    for low, high in zip(bounds, bounds[1:]):
        out, leaves = pa.BufferOutputStream(), found.slice(low, high - low).drop_columns(["group"])
        with pa.ipc.new_stream(out, leaves.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
            w.write_table(leaves)
        yield pa.RecordBatch.from_arrays([pa.array([int(group[low])]), pa.array([out.getvalue().to_pybytes()], pa.binary())],
                                         ["group", "leaves"])


def suffixes(docs: DataFrame, frequent: bytes, hot: bytes, pairs: bytes, groups: int) -> DataFrame:
    """(group, leaves): suffixes of two to four frequent words and their counts, by the group of their prefix.

    The prefix is the first word, the first two for words marked in ``hot``, and the
    first three where these are marked in ``pairs``: those in groups from ``groups`` up.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally(["group", "lang", "suffix"])
        for langs, codes, p in _pieces_of(batches):
            h = _of_lang(p.hashes(), langs, codes)
            some = _marked(frequent, h)
            more = np.zeros(len(h) + LONGEST, bool)
            more[:len(h) - 1] = (p.ahead[:-1] > 0) & some[1:]
            depth, along = np.zeros(len(h), np.int64), some.copy()
            for k in range(LONGEST - 1):
                along &= more[k:k + len(h)]
                depth += along
            at = np.flatnonzero(depth)
            if not len(at):
                continue
            both = _pairs(h)[at]
            wide = _marked(hot, h[at])
            deep = wide & _marked(pairs, both)
            prefix = np.where(wide, both, h[at])
            third = deep & (depth[at] > 1)
            prefix = np.where(third, mix(both * _NEXT + h[np.minimum(at + 2, len(h) - 1)]), prefix)
            group = (prefix % np.uint64(groups)).astype(np.int64) + deep * groups
            for full in tally.add(pa.table({
                "group": group, "lang": pa.array(langs, pa.string()).take(pa.array(codes[at])),
                "suffix": p.texts(p.starts[at], p.ends[at + depth[at]]), "n": np.ones(len(at), np.int64)})):
                yield from _leaf_lists(full)
        for full in tally.rest():
            yield from _leaf_lists(full)

    return docs.mapInArrow(run, "group long, leaves binary")


def _cut_to(words: pa.Array, depth: int) -> pa.Array:
    """The first ``depth`` words of texts that have more."""
    out = []
    for t in texts(words):
        space = np.flatnonzero(t.data == 0x20)
        ends = space[np.searchsorted(space, t.offsets[:-1]) + depth - 1]
        out.append(_texts(t.data, t.offsets[:-1], ends))
    return pa.concat_arrays(out)


def subtrees(found: DataFrame, groups: int, least: int) -> DataFrame:
    """(lang, phrase, words, n) of the nodes of each group's subtree, from its leaves up.

    A node's count is that of the leaves below it. Nodes of two words in groups
    by three words are parts, to be added up; all others are whole, and those
    below ``least`` are left out.
    """
    def run(t: pa.Table) -> pa.Table:
        split = t.column("group")[0].as_py() >= groups
        t = pa.concat_tables([pa.ipc.open_stream(x.as_buffer()).read_all() for x in t.column("leaves")])
        words = pa.compute.count_substring(t.column("suffix"), " ")
        out, below = [], None
        for depth in range(LONGEST, 1, -1):
            level = t.filter(pa.compute.equal(words, depth - 1))
            if below is not None and below.num_rows:
                up = below.set_column(1, "suffix", _cut_to(below.column("suffix"), depth))
                level = pa.concat_tables([level, up])
            below = level.group_by(["lang", "suffix"]).aggregate([("n", "sum")]).rename_columns(["lang", "suffix", "n"])
            kept = below if split and depth == 2 else below.filter(pa.compute.greater_equal(below.column("n"), least))
            out.append(pa.table({"lang": kept.column("lang"), "phrase": kept.column("suffix"),
                                 "words": pa.array(np.full(kept.num_rows, depth)), "n": kept.column("n")}))
        del t, below, level
        pa.default_memory_pool().release_unused()
        return pa.concat_tables(out)

    return found.groupBy("group").applyInArrow(run, "lang string, phrase string, words long, n long")


def phrase_counts(docs: DataFrame, *, lang: str = "lang", text: str = "text", least: int = LEAST,
                  budget: int = BUDGET) -> tuple[DataFrame, DataFrame]:
    """Tables (lang, phrase, words, n) of all phrases of one to four words found ``least`` times, and (lang, total)."""
    docs = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    words = settled(word_counts(docs), "words")
    totals = settled(words.groupBy("lang").agg(F.sum("n").alias("total")), "totals")
    frequent = words.where(F.col("n") >= least)
    suffixes_at_most = totals.agg(F.sum("total")).first()[0] or 0
    groups = max(GROUPS, -(-suffixes_at_most // budget))
    hot = words.where(F.col("n") > budget)
    hot_words = hot_pairs = bytes(1 << BITS - 3)
    if not hot.isEmpty():
        hot_words = bitmap(word_cells(hot))
        hot_pairs = bitmap(pair_cells(docs, hot_words).where(F.col("n") > budget))
    found = suffixes(docs, bitmap(word_cells(frequent)), hot_words, hot_pairs, groups)
    nodes = subtrees(found, groups, least).groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    one = frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).cast("long").alias("words"), "n")
    return settled(nodes.union(one), "phrases"), totals


def collocations(docs: DataFrame, *, lang: str = "lang", text: str = "text", least: int = LEAST, top: int = TOP,
                 covered: int = COVERED, budget: int = BUDGET) -> DataFrame:
    """The best phrases of two to four words of each language.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, and these
    into words at spaces and tabs. A phrase found ``least`` times is cut in two where
    the score is lowest, at the first such place: floor(2,000,000 * a / (l + r)), with
    ``a`` its count and ``l``, ``r`` those of its parts; the quotient is exact. Phrases
    inside a longer one of at least ``covered`` percent of their count are dropped.
    Returns (lang, rank, phrase, a, l, r, n, score), the first ``top`` by score and
    ``a``, largest first, ties by the phrase's bytes; ``n`` counts all words.

    A null language is ``und``; a null or empty text has no words. Rows that repeat
    count each time; keys and other columns do not matter, whatever their names. Texts
    may be of any length; an empty table gives no rows.
    """
    phrases, totals = phrase_counts(docs, lang=lang, text=text, least=least, budget=budget)
    w = F.split("phrase", " ", -1)
    some = phrases.where("words > 1")
    part = lambda a, n: F.array_join(F.slice(F.col("w"), a, n), " ")
    cuts = some.select("lang", "phrase", "words", F.col("n").alias("a"), w.alias("w"),
                       F.explode(F.sequence(F.lit(1), F.col("words").cast("int") - 1)).alias("k")) \
        .select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"),
                part(F.col("k") + 1, F.col("words").cast("int") - F.col("k")).alias("right"))
    count = lambda as_, n: phrases.select("lang", F.col("phrase").alias(as_), F.col("n").alias(n))
    scored = cuts.join(count("left", "l"), ["lang", "left"]).join(count("right", "r"), ["lang", "right"]).withColumn(
        "score", F.expr(SCORE))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("b")) \
        .select("lang", "phrase", "b.score", "b.a", "b.l", "b.r")
    # Counts only fall as phrases grow, so a longer phrase covers one only if some phrase one word longer does.
    inner = phrases.where("words > 2").select("lang", "words", "n", w.alias("w")).select(
        "lang", "n", F.explode(F.array(part(F.lit(1), F.col("words").cast("int") - 1),
                                       part(F.lit(2), F.col("words").cast("int") - 1))).alias("phrase")) \
        .groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    free = best.join(inner, ["lang", "phrase"], "left") \
        .where(F.col("longer").isNull() | (F.lit(100).cast("decimal(3,0)") * F.col("longer") < F.lit(covered).cast("decimal(3,0)") * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = free.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
