"""MinHash near-duplicates by tensored banding.

A document is the set of its distinct two-word shingles. ``COLLECTIONS`` small
collections of ``HASHES`` minimums each are computed; a table key joins two of
the collections, so 14 collections (42 minimums) serve 91 tables of six
minimums, which would take 546 minimums if each table had its own. A pair at the
threshold shares a table with probability 0.9993, at 0.9 with 0.999999.

Documents with equal sets are one node. Buckets are never turned into all their
pairs: rows are range-sorted by table key and then by further collections, so
that within a bucket the most similar documents stand next to each other, and
every row is paired with the one before it and with the first of its bucket.
A hot bucket is just a longer stretch of the sort, cut wherever the range
partitions are. All pairs found are confirmed on full sets, those whose
documents are connected already excepted.

Buckets that still hold several components are then made whole: every member
meets the one of most links, and the members of buckets that are apart even then
are joined exactly on the rare shingles that two linked sets must share. Rows of
that join are in proportion to the members, whatever the size of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark.llm.components import components, joined
from fabspark.llm.text import Words, distinct, mix, texts
from fabspark.session import settled

COLLECTIONS = 14
HASHES = 3
PERCENT = 80  # 100 * intersection >= PERCENT * union
BROADCAST_IDS = 500_000  # candidate documents up to this many go to all executors (8 bytes each), more are joined

_PAIR = np.uint64(0xD6E8FEB86659FD93)  # fixed values: odd multipliers
_SINGLE = np.uint64(0xA0761D6478BD642F)
_SEEDS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def shingles(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, shingle) pairs: two neighbouring words, or the only word of a text."""
    doc = w.doc
    same = doc[1:] == doc[:-1]
    pairs = mix(w.hashes[:-1] * _PAIR + w.hashes[1:])[same]
    lone = w.first[:-1][np.diff(w.first) == 1]
    return distinct(np.concatenate([doc[:-1][same], doc[lone]]),
                    np.concatenate([pairs, mix(w.hashes[lone] * _SINGLE)]))


def sketch(doc: np.ndarray, sets: np.ndarray, n: int, collections: int, hashes: int) -> np.ndarray:
    """``collections`` keys per text, each of ``hashes`` minimums; zeros for an empty set."""
    out = np.zeros((n, collections), np.uint64)
    if len(doc):
        first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
        for c in range(collections):
            for h in range(hashes):
                low = np.minimum.reduceat(mix(sets ^ _SEEDS[c * hashes + h]), first)
                out[doc[first], c] = mix(out[doc[first], c] * _PAIR + low)
    return out


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), _long(values))


def sketches(docs: DataFrame, text: str, key: str, collections: int = COLLECTIONS, hashes: int = HASHES) -> DataFrame:
    """One row per document: size and fingerprint of its set, and its collections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(1)):
                doc, sets = shingles(t.lowered().words())
                bounds = np.searchsorted(doc, np.arange(len(t) + 1))
                keys = sketch(doc, sets, len(t), collections, hashes)
                total = np.zeros((2, len(sets) + 1), np.uint64)
                np.cumsum(sets, out=total[0, 1:])
                np.cumsum(mix(sets ^ _SEEDS[-1]), out=total[1, 1:])
                f = total[:, bounds[1:]] - total[:, bounds[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.at, len(t)), pa.array(np.diff(bounds)), _long(f[0]), _long(f[1]),
                     _lists(keys.ravel(), np.arange(len(t) + 1) * collections)], ["id", "n", "f0", "f1", "keys"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(f"`{key}`"), F.col(f"`{text}`")) \
        .mapInArrow(run, f"id {kind}, n long, f0 long, f1 long, keys array<bigint>")


def _tables(nodes: DataFrame, collections: int) -> DataFrame:
    """(key, place, id, n) for every table: places order a bucket by other collections."""
    tables = list(combinations(range(collections), 2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(2).flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            keys = keys.reshape(batch.num_rows, collections)
            high = keys >> np.uint64(48)
            for t, (i, j) in enumerate(tables):
                key = mix(keys[:, i] * _PAIR + keys[:, j]) ^ _SEEDS[t]
                rest = [k % collections for k in range(j + 1, j + collections) if k % collections not in (i, j)][:4]
                place = np.zeros(batch.num_rows, np.uint64)
                for k in rest:
                    place = (place << np.uint64(16)) | high[:, k]
                yield pa.RecordBatch.from_arrays([_long(key), _long(place), batch.column(0), batch.column(1)],
                                                 ["key", "place", "id", "n"])

    kind = nodes.schema["id"].dataType.simpleString()
    return nodes.select("id", "n", "keys").mapInArrow(run, f"key long, place long, id {kind}, n long")


def _neighbours(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of sorted rows: each with the one before it and the first of its bucket.

    Buckets that go on in another partition hand on their first row as kind 1,
    those of more than three rows their key as kind 2.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # key, id, n of the row before, id, n of its bucket's first, and its place in the bucket
        for batch in batches:
            if not batch.num_rows:
                continue
            key, ids, n = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            new = np.r_[True, key[1:] != key[:-1]]
            start = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
            lead, lead_n = ids[start], n[start]
            prev, prev_n = np.r_[ids[:1], ids[:-1]], np.r_[n[:1], n[:-1]]
            alone, place = new.copy(), np.arange(len(key)) - start
            edge = [(key[0], ids[0], n[0])] if last is None else []
            if last is not None and key[0] == last[0]:
                run_on = start == 0
                lead, lead_n = np.where(run_on, last[3], lead), np.where(run_on, last[4], lead_n)
                prev[0], prev_n[0], alone[0] = last[1], last[2], False
                place[run_on] += last[5] + 1
            last = (key[-1], ids[-1], n[-1], lead[-1], lead_n[-1], place[-1])
            crowd = key[place == 3]
            a = np.concatenate([ids[~alone], ids[~alone]])
            b = np.concatenate([lead[~alone], prev[~alone]])
            na, nb = np.concatenate([n[~alone]] * 2), np.concatenate([lead_n[~alone], prev_n[~alone]])
            ok = (a != b) & (100 * np.minimum(na, nb) >= percent * np.maximum(na, nb))
            a, b = np.minimum(a[ok], b[ok]), np.maximum(a[ok], b[ok])
            none = np.zeros(len(crowd), np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.zeros(len(a), np.int64), np.array([e[0] for e in edge], np.int64), crowd])),
                 pa.array(np.concatenate([a, np.array([e[1] for e in edge], np.int64), none])),
                 pa.array(np.concatenate([b, np.array([e[2] for e in edge], np.int64), none])),
                 pa.array(np.repeat(np.arange(3, dtype=np.int32), [len(a), len(edge), len(crowd)]))],
                ["key", "a", "b", "kind"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int64()) for x in (last[0], last[3], last[4])]
                                             + [pa.array([1], pa.int32())], ["key", "a", "b", "kind"])

    return rows.select("key", "id", "n").mapInArrow(run, "key long, a long, b long, kind int")


def proposals(nodes: DataFrame, *, collections: int = COLLECTIONS, percent: int = PERCENT) -> DataFrame:
    """What the sorted tables tell: pairs, rows at the edges of partitions, keys of buckets beyond three rows."""
    parts = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return settled(_neighbours(_tables(nodes, collections).repartitionByRange(parts, "key", "place", "id")
                               .sortWithinPartitions("key", "place", "id"), percent), "pairs")


def candidates(found: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b, votes), a < b, that tables propose, with the number of tables."""
    pairs = found.where("kind = 0").select("a", "b")
    edges = found.where("kind = 1").select("key", F.col("a").alias("id"), F.col("b").alias("n"))  # two a partition
    first = edges.groupBy("key").agg(F.min(F.struct("id", "n")).alias("c"))
    across = edges.join(first, "key").where("id <> c.id") \
        .where(f"100 * least(n, c.n) >= {percent} * greatest(n, c.n)") \
        .select(F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b"))
    return pairs.union(across).groupBy("a", "b").agg(F.count("*").alias("votes"))


def _few(small: DataFrame) -> DataFrame:
    return F.broadcast(small) if small.count() <= BROADCAST_IDS else small


def crowded(nodes: DataFrame, found: DataFrame, *, collections: int = COLLECTIONS) -> DataFrame:
    """(key, id, n) of buckets whose pairs were not all proposed: of more than three rows, or in several partitions."""
    keys = settled(found.where("kind > 0").select("key").distinct(), "keys")
    return _tables(nodes, collections).select("key", "id", "n").join(_few(keys), "key", "left_semi")


def unsettled(members: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, id, n, group) of the buckets that hold several components."""
    m = members.join(groups.withColumnRenamed("node", "id"), "id", "left") \
        .select("key", "id", "n", F.coalesce("component", "id").alias("group"))
    keys = settled(m.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"))
                   .where("low <> high").select("key"), "keys")
    return m.join(_few(keys), "key", "left_semi")


def _ends(pairs: DataFrame) -> DataFrame:
    """(id, degree) of the ends of pairs, counted on either side first, so that no pair is doubled; an id may come twice."""
    return reduce(DataFrame.union, [pairs.groupBy(F.col(c).alias("id")).agg(F.count("*").alias("degree")) for c in ("a", "b")])


def hub_pairs(members: DataFrame, links: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of every member with the one of most links in its bucket, unless they are connected."""
    degree = _ends(links).groupBy("id").agg(F.sum("degree").alias("degree"))
    hubs = settled(members.join(degree, "id", "left").groupBy("key")
                   .agg(F.max(F.struct(F.coalesce("degree", F.lit(0)).alias("degree"), "id", "n", "group")).alias("h")), "hubs")
    return members.join(_few(hubs), "key").where("group <> h.group") \
        .where(f"100 * least(n, h.n) >= {percent} * greatest(n, h.n)") \
        .select(F.least("id", "h.id").alias("a"), F.greatest("id", "h.id").alias("b")).distinct()


def _starts(rows: DataFrame, percent: int) -> DataFrame:
    """(id, n, group, rest, item) of the start of every set, rarest shingles first.

    A set of ``n`` that is linked with another shares one of its first
    ``n - ceil(percent * n / 100) + 1`` shingles with it, in any order that is the same
    for all. A shingle of one set alone takes a place and makes no row; ``rest`` counts
    the shingles from here to the end.
    """
    each = settled(rows.select("id", "group", F.size("set").alias("n"), F.xxhash64("set").alias("h"),
                               F.explode("set").alias("item")), "items")
    shared = each.groupBy("item").agg(F.count("*").alias("f")).where("f > 1")
    return each.join(shared, "item").groupBy("id", "group", "n", "h") \
        .agg(F.sort_array(F.collect_list(F.struct("f", "item"))).alias("items")) \
        .withColumn("lone", F.expr("n - size(items)")) \
        .withColumn("first", F.expr(f"n - cast(ceil({percent} * n / 100) as int) + 1")) \
        .where("first > lone") \
        .select("id", "n", "group", "lone", F.posexplode(F.expr("slice(items.item, 1, first - lone)")).alias("i", "item")) \
        .select("id", "n", "group", F.expr("n - lone - i").alias("rest"), "item")


def rare_pairs(rows: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) of sets of different groups that may be linked, none that is linked left out.

    ``rows`` are (id, group, set). Pairs meet by a rare shingle that both start
    with, and become rows only where enough shingles are left after it for a
    link, so a set makes at most as many rows as its start has shingles. The
    smaller set of a pair needs more left, so most of its start meets nothing.
    """
    starts = settled(_starts(rows, percent), "starts")
    a = starts.alias("a")
    b = starts.where(f"{100 + percent} * rest >= {2 * percent} * n").alias("b")
    return a.join(b, F.expr(f"""a.item = b.item AND a.group <> b.group AND (a.n > b.n OR a.n = b.n AND a.id > b.id)
            AND {100 + percent} * least(a.rest, b.rest) >= {percent} * (a.n + b.n)""")) \
        .select(F.least("a.id", "b.id").alias("a"), F.greatest("a.id", "b.id").alias("b")).distinct()


def sets_of(docs: DataFrame, ids: DataFrame, text: str, key: str) -> DataFrame:
    """(id, set) of the documents named: full sets as sorted 64-bit hashes."""
    wanted = ids.select(F.col("id").alias("_id"))
    if ids.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    some = docs.select(F.col(f"`{key}`").alias("_id"), F.col(f"`{text}`").alias("_text")).join(wanted, "_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in texts(batch.column(1)):
                doc, sets = shingles(t.lowered().words())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.at, len(t)),
                     _lists(sets, np.searchsorted(doc, np.arange(len(t) + 1)))], ["id", "set"])

    return some.mapInArrow(run, "id long, set array<bigint>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    both = F.size(F.array_intersect("set", "other"))
    return pairs.join(sets.withColumnRenamed("id", "a"), "a") \
        .join(sets.select(F.col("id").alias("b"), F.col("set").alias("other")), "b") \
        .where(100 * both >= percent * (F.size("set") + F.size("other") - both)).select("a", "b")


def near_duplicates(docs: DataFrame, *, text: str = "text", key: str = "doc_id", collections: int = COLLECTIONS,
                    hashes: int = HASHES, percent: int = PERCENT) -> DataFrame:
    """One row per document with the component of near-duplicates it belongs to.

    Returns ``key`` (long), ``n_shingles`` (size of the set), ``component_id`` (the
    smallest key reachable over links, itself included) and ``kept`` (the key is its
    component). A link holds between documents whose sets have
    ``100 * intersection >= percent * union``. A text that is null, empty or only
    white space has no set and no links. Repeated rows are one node and keep one
    row each. A row with a null key has no component and is kept. Other columns
    are dropped, whatever their names.
    """
    docs = docs.select(F.col(f"`{key}`").cast("long").alias("_key"), F.col(f"`{text}`").alias("_text"))
    all_ = settled(sketches(docs, "_text", "_key", collections, hashes), "sketches")
    nodes = settled(all_.where("n > 0 AND id IS NOT NULL").groupBy("n", "f0", "f1")
                    .agg(F.min("id").alias("id"), F.first("keys").alias("keys")), "nodes")
    found = proposals(nodes, collections=collections, percent=percent)
    pairs = settled(candidates(found, percent=percent), "candidates")
    crowd = settled(crowded(nodes, found, collections=collections), "crowd")
    ids = settled(_ends(pairs).select("id").union(crowd.select("id").distinct()).distinct(), "ids")
    # A key with several texts stands for its classes' smallest; its sets are looked at one by one.
    sets = settled(sets_of(docs, ids, "_text", "_key").distinct(), "sets")
    best = pairs.groupBy("b").agg(F.max(F.struct("votes", "a")).alias("m")).select("m.a", "b")
    sure = settled(confirm(best, sets, percent), "sure")
    groups = settled(components(sure), "groups")
    of = lambda c: groups.select(F.col("node").alias(c), F.col("component").alias(f"{c}_group"))
    open_ = pairs.join(best, ["a", "b"], "left_anti").join(of("a"), "a", "left").join(of("b"), "b", "left") \
        .where("a_group IS NULL OR b_group IS NULL OR a_group <> b_group").select("a", "b")
    links = settled(confirm(open_, sets, percent), "links")
    groups = settled(joined(groups, links), "groups")
    links = sure.union(links)
    left = settled(unsettled(crowd, groups), "left")
    if not left.isEmpty():
        met = settled(hub_pairs(left, links, percent).join(pairs, ["a", "b"], "left_anti"), "met")
        groups = settled(joined(groups, confirm(met, sets, percent)), "groups")
        apart = unsettled(left.select("key", "id", "n"), groups).select("id", "group").distinct()
        more = settled(rare_pairs(apart.join(sets, "id"), percent), "more")
        if not more.isEmpty():
            groups = settled(joined(groups, confirm(more, sets, percent)), "groups")
    # Equal sets first, then components over the smallest key of each set.
    classes = nodes.select("n", "f0", "f1", F.col("id").alias("node")).join(groups, "node", "left") \
        .select("n", "f0", "f1", F.coalesce("component", "node").alias("component"))
    rows = all_.select("id", "n", "f0", "f1").join(classes, ["n", "f0", "f1"], "left") \
        .select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"))
    return rows.select(F.col("id").alias(key), F.col("n").alias("n_shingles"), "component_id",
                       F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, *, text: str = "text", key: str = "doc_id", **how) -> DataFrame:
    """The documents that stay, with all their columns: one of each group, the one of smallest key.

    Rows that repeat a key are one document, of which any row stays. Rows with
    a null key and texts without words all stay, as nothing is a copy of them.
    """
    found = settled(near_duplicates(docs, text=text, key=key, **how).select(F.col(f"`{key}`").alias("_key"), "kept"), "kept")
    gone = settled(found.where("NOT kept").select("_key").distinct(), "gone")
    wide = gone.count() > BROADCAST_IDS
    out = docs.join(gone if wide else F.broadcast(gone), docs[key] == gone["_key"], "left_anti")
    again = found.where("kept AND _key IS NOT NULL").groupBy("_key").count().where("count > 1").select("_key")
    again = settled(again, "again")
    if again.isEmpty():
        return out
    return out.join(again, out[key] == again["_key"], "left_anti") \
        .unionByName(out.join(again, out[key] == again["_key"], "left_semi").dropDuplicates([key]))
