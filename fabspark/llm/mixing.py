"""Mixing sources to target weights by a splitting tree over blocks.

A source's documents, in an order given by a hash of their key, are cut into
blocks. A source is taken in whole passes over its blocks and one part of a
pass, which ends inside one block; what that block cannot fill is filled from the
blocks after it, until no document of them fits. Each taken block of a pass is a
unit, documents from later blocks belong to the unit of the last. The units of
all sources are dealt to output shards by a tree: a node draws how many units of
each source go left without replacement (multivariate hypergeometric, so quotas
add up exactly), and the leaves' quotas cut every source's permuted units into
disjoint runs. Rows then know their shards from their own key and a table with
one row per source; nothing is sorted but blocks, and no text is moved.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fabspark.session import settled

CAP = 3.0  # times a source's size that may be taken
BLOCK_ROWS = 256
SHARDS = 16
SEED = 42
BROADCAST_SOURCES = 10_000  # up to this many sources, their table goes to all executors
BROADCAST_EXTRAS = 500_000  # so do hashes of this many documents

_STEP = 2_147_483_647  # a prime above any number of units, so that its multiples run through all of them


def words(text: str | Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def cyclic_weights(sources: DataFrame, weights: tuple[float, ...] = (1.0, 2.0, 3.0)) -> DataFrame:
    """(source, weight): the weights repeat over the sources by code point, null last."""
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    given = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    return sources.select("source").distinct().select("source", given.alias("weight"))


def targets(sources: DataFrame, cap: float = CAP) -> DataFrame:
    """Adds ``target`` to (source, weight, words): all words shared by weight, none above ``cap`` times its source.

    The excess of sources at their cap is shared among the others by weight until
    none is above: sources are capped in order of cap over weight, which is a
    running sum over one row per source.
    """
    most = F.col("words") * cap
    before = Window.orderBy("_ratio", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    all_ = Window.partitionBy(F.lit(0))
    part = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0.0))
    level = lambda words, weight: F.when(weight > 0, words / weight).otherwise(F.lit(0.0))
    out = sources.withColumn("_most", most) \
        .withColumn("_ratio", F.when(F.col("weight") > 0, F.col("_most") / F.col("weight")).otherwise(float("inf"))) \
        .withColumn("_level", level(F.sum("words").over(all_) - part("_most"), F.sum("weight").over(all_) - part("weight"))) \
        .withColumn("_full", F.col("_ratio") <= F.col("_level"))
    free = lambda c: F.sum(F.when(~F.col("_full"), F.col(c)).otherwise(0.0)).over(all_)
    left = F.sum("words").over(all_) - F.sum(F.when(F.col("_full"), F.col("_most")).otherwise(0.0)).over(all_)
    return out.withColumn("target", F.when(F.col("_full"), F.col("_most"))
                          .otherwise(level(left, free("weight")) * F.col("weight"))) \
        .drop("_most", "_ratio", "_level", "_full")


@dataclass
class Plan:
    """``sources``: one row per source with its passes, blocks and the shards' bounds.
    ``extras``: hashes of the documents taken from the block in which a source's last pass ends, and after it."""

    sources: DataFrame
    extras: DataFrame
    seed: int

    def _with_source(self, df: DataFrame, source: str) -> DataFrame:
        s = self.sources.select(*(F.col(c).alias(f"_mix_{c}") for c in self.sources.columns))
        if self.sources.count() <= BROADCAST_SOURCES:
            s = F.broadcast(s)
        return df.join(s, df[source].eqNullSafe(s["_mix_source"]), "left")

    def assign(self, df: DataFrame, key: str, source: str) -> DataFrame:
        """Adds ``_mix_shards`` (the shard of each copy taken; empty if none) and the source's columns."""
        place = _hash(self.seed, F.col(f"`{key}`"))
        df = self._with_source(df.withColumn("_mix_hash", place), source) \
            .withColumn("_mix_block", _block("_mix_hash", "_mix_blocks"))
        extras = self.extras.select(F.col("source").alias("_extra_source"), F.col("hash").alias("_extra_hash"))
        if self.extras.count() <= BROADCAST_EXTRAS:
            extras = F.broadcast(extras)
        df = df.join(extras, df[source].eqNullSafe(extras["_extra_source"])
                     & (df["_mix_hash"] == extras["_extra_hash"]), "left")
        extra = (F.col("_mix_block") < F.col("_mix_cut")) \
            | ((F.col("_mix_block") >= F.col("_mix_cut")) & F.col("_extra_hash").isNotNull())
        copies = (F.col("_mix_passes") + extra.cast("long")).cast("int")
        block = lambda n: F.when(n > F.col("_mix_passes"), F.least("_mix_block", "_mix_cut")).otherwise(F.col("_mix_block"))
        unit = lambda n: (n - 1) * F.col("_mix_blocks") + block(n)
        at = lambda n: F.pmod(unit(n) * F.lit(_STEP), F.col("_mix_units"))
        shard = lambda n: F.size(F.filter("_mix_bounds", lambda b: b <= at(n)))
        return df.withColumn("_mix_shards", F.when(copies > 0, F.transform(F.sequence(F.lit(1), copies), shard))
                             .otherwise(F.array().cast("array<int>")))


def _hash(seed: int, key: Column) -> Column:
    return F.xxhash64(F.lit(seed), key)


def _block(place: str, blocks: str) -> Column:
    """Block of a hash: equal ranges of its upper half."""
    return F.shiftrightunsigned(F.shiftrightunsigned(F.col(place), 32) * F.col(blocks), 32)


def plan(docs: DataFrame, weights: DataFrame, *, key: str = "doc_id", source: str = "source", size: str = "size",
         cap: float = CAP, shards: int = SHARDS, block_rows: int = BLOCK_ROWS, seed: int = SEED) -> Plan:
    """What to take of each source, from one row per document with its size.

    ``weights``: (source, weight). Rows with one key and source share their fate.
    """
    rows = docs.select(F.col(f"`{source}`").alias("source"), F.col(f"`{size}`").alias("size"),
                       _hash(seed, F.col(f"`{key}`")).alias("hash"))
    per = rows.groupBy("source").agg(F.sum("size").alias("words"), F.count("*").alias("rows"))
    w = weights.select(F.col("source").alias("_s"), "weight")
    per = per.join(w, per["source"].eqNullSafe(w["_s"]), "left").drop("_s") \
        .withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    passes = F.when(F.col("words") > 0, F.floor(F.col("target") / F.col("words"))).otherwise(0).cast("long")
    per = settled(targets(per, cap).withColumn("passes", passes)
                  .withColumn("rest", F.round(F.col("target")).cast("long") - F.col("passes") * F.col("words"))
                  .withColumn("blocks", F.ceil(F.col("rows") / block_rows).cast("long")), "sources")
    first = Plan(per, per.select("source", F.lit(0).cast("long").alias("hash")).limit(0), seed)
    placed = first._with_source(rows, "source").withColumn("block", _block("hash", "_mix_blocks")) \
        .select("source", "hash", "size", "block", F.col("_mix_rest").alias("rest"))
    sums = placed.groupBy("source", "block", "rest").agg(F.sum("size").alias("size"))
    run = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    cuts = settled(sums.withColumn("end", F.sum("size").over(run)).where("end > rest").groupBy("source")
                   .agg(F.min(F.struct("block", F.expr("rest - (end - size) AS left"))).alias("c"))
                   .select(F.col("source").alias("_c"), F.col("c.block").alias("cut"), F.col("c.left").alias("left")), "cuts")
    extras = _filled(placed.select("source", "block", "hash", "size"), cuts)
    per = per.join(cuts, per["source"].eqNullSafe(cuts["_c"]), "left").drop("_c", "left") \
        .withColumn("cut", F.when(F.col("rest") > 0, F.coalesce("cut", "blocks")).otherwise(F.lit(-1))) \
        .withColumn("units", F.col("passes") * F.col("blocks") + F.least(F.col("cut") + 1, F.col("blocks")))
    per = settled(per, "sources")
    return Plan(settled(_dealt(per, shards, seed), "plan"), extras, seed)


def _filled(pool: DataFrame, cuts: DataFrame) -> DataFrame:
    """(source, hash) of the documents that fill what is ``left`` of each source from its block ``cut`` on.

    The cut block gives its largest documents first, as long as they fit. Then the
    later blocks are run through with the documents that still fit, whole blocks
    until the next cut, and so on until none fits.
    """
    greedy = F.aggregate(
        "docs", F.struct(F.col("left").alias("left"), F.array().cast("array<bigint>").alias("hash")),
        lambda a, d: F.when(d["size"] <= a["left"], F.struct((a["left"] - d["size"]).alias("left"),
                                                             F.array_append(a["hash"], d["hash"]).alias("hash")))
        .otherwise(a))
    run = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    taken = []
    while True:
        last = pool.join(cuts, pool["source"].eqNullSafe(cuts["_c"]) & (pool["block"] == cuts["cut"])) \
            .groupBy("source", "cut", "left", "hash").agg(F.sum("size").alias("size")) \
            .groupBy("source", "cut", "left").agg(F.sort_array(F.collect_list(F.struct("size", "hash")), asc=False).alias("docs"))
        last = settled(last.select("source", "cut", greedy.alias("got")), "last")
        taken.append(last.select("source", F.explode("got.hash").alias("hash")))
        now = last.select(F.col("source").alias("_c"), "cut", F.col("got.left").alias("left")).where("left > 0")
        each = pool.groupBy("source", "block", "hash").agg(F.sum("size").alias("size")).where("size > 0")
        pool = settled(each.join(now, each["source"].eqNullSafe(now["_c"]) & (each["block"] > now["cut"])
                                 & (each["size"] <= now["left"])).select("source", "block", "hash", "size", "left"), "pool")
        if pool.isEmpty():
            return settled(reduce(DataFrame.unionByName, taken), "extras")
        ends = settled(pool.groupBy("source", "block", "left").agg(F.sum("size").alias("size"))
                       .withColumn("end", F.sum("size").over(run)), "ends")
        fits = ends.where("end <= left").select(F.col("source").alias("_c"), F.col("block").alias("_b"))
        taken.append(pool.join(fits, pool["source"].eqNullSafe(fits["_c"]) & (pool["block"] == fits["_b"]))
                     .select("source", "hash"))
        cuts = settled(ends.where("end > left").groupBy("source")
                       .agg(F.min(F.struct("block", F.expr("left - (end - size) AS left"))).alias("c"))
                       .select(F.col("source").alias("_c"), F.col("c.block").alias("cut"), F.col("c.left").alias("left")), "cuts")
        pool = pool.drop("left")


def _dealt(per: DataFrame, shards: int, seed: int) -> DataFrame:
    """Adds ``bounds``: where in a source's permuted units each shard's run ends."""
    quota = "array<struct<source:string,n:bigint>>"
    nodes = per.groupBy().agg(F.sum("units").alias("units"),
                              F.sort_array(F.collect_list(F.struct("source", F.col("units").alias("n")))).alias("quotas")) \
        .select(F.lit(0).alias("shard"), F.lit(shards).alias("count"), F.coalesce("units", F.lit(0)).alias("units"),
                F.col("quotas").cast(quota))

    def drawn(total: Column, left: Column) -> Column:
        """How many units of each source go left, drawn one by one without replacement."""
        def one(acc: Column, q: Column) -> Column:
            each = F.when(q["n"] > 0, F.sequence(F.lit(1).cast("long"), q["n"])).otherwise(F.array().cast("array<bigint>"))

            def unit(b: Column, i: Column) -> Column:
                h = F.xxhash64(F.lit(seed), F.col("shard"), F.col("count"), q["source"], i)
                hit = (F.pmod(h, F.greatest(b["total"], F.lit(1))) < b["left"]).cast("long")
                return F.struct((b["total"] - 1).alias("total"), (b["left"] - hit).alias("left"), (b["n"] + hit).alias("n"))

            end = F.aggregate(each, F.struct(acc["total"].alias("total"), acc["left"].alias("left"),
                                             F.lit(0).cast("long").alias("n")), unit)
            return F.struct(end["total"].alias("total"), end["left"].alias("left"),
                            F.array_append(acc["out"], F.struct(q["source"].alias("source"), end["n"].alias("n"))).alias("out"))

        start = F.struct(total.alias("total"), left.alias("left"), F.array().cast(quota).alias("out"))
        return F.aggregate("quotas", start, one, lambda acc: acc["out"])

    for _ in range(max(0, (shards - 1).bit_length())):
        half = F.floor(F.col("count") / 2).cast("int")
        nodes = nodes.withColumn("half", half) \
            .withColumn("left", F.floor(F.col("units") * F.col("half") / F.col("count"))) \
            .withColumn("lefts", drawn(F.col("units"), F.col("left")))
        rights = F.zip_with("quotas", "lefts", lambda q, x: F.struct(q["source"].alias("source"), (q["n"] - x["n"]).alias("n")))
        side = lambda shard, count, units, quotas: F.struct(
            shard.alias("shard"), count.alias("count"), units.alias("units"), quotas.alias("quotas"))
        both = F.array(side(F.col("shard"), F.col("half"), F.col("left"), F.col("lefts")),
                       side(F.col("shard") + F.col("half"), F.col("count") - F.col("half"),
                            F.col("units") - F.col("left"), rights))
        same = F.array(side(F.col("shard"), F.col("count"), F.col("units"), F.col("quotas")))
        nodes = settled(nodes.select(F.explode(F.when(F.col("count") > 1, both).otherwise(same)).alias("x")).select("x.*"),
                        "tree")
    leaves = nodes.select("shard", F.explode("quotas").alias("q")).select("shard", "q.source", "q.n")
    end = F.sum("n").over(Window.partitionBy("source").orderBy("shard"))
    bounds = leaves.withColumn("end", end.cast("long")).groupBy(F.col("source").alias("_b")) \
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("shard", "end"))), lambda x: x["end"]).alias("bounds"))
    return per.join(bounds, per["source"].eqNullSafe(bounds["_b"]), "left").drop("_b")


def mix(docs: DataFrame, plan_: Plan, *, key: str = "doc_id", source: str = "source") -> DataFrame:
    """The mixed corpus: one row per copy taken, with ``shard`` and ``place`` within it.

    All columns of ``docs`` are kept (``shard`` and ``place`` are replaced). Write with
    ``repartition("shard").sortWithinPartitions("shard", "place")`` to shuffle locally.
    """
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("shard", "place")]
    return plan_.assign(docs, key, source) \
        .select(*kept, "_mix_hash", F.posexplode("_mix_shards").alias("_mix_copy", "shard")) \
        .select(*kept, "shard", F.xxhash64("_mix_hash", "_mix_copy").alias("place"))


def taken(docs: DataFrame, weights: DataFrame, *, text: str = "text", key: str = "doc_id", source: str = "source",
          **how) -> DataFrame:
    """One row per document: its size, its source's size and target, and the words taken of it.

    Returns ``key``, ``size`` (words; 0 for a null text), ``source_size``, ``target``
    (its source's), ``taken`` (size times copies) and ``shards`` (of each copy). A
    null source is one of its own; documents without words are taken 0 times over;
    repeated rows share their fate; an empty table gives no rows.
    """
    sizes = settled(docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{source}`").alias("source"),
                                words(F.col(f"`{text}`")).alias("size")), "sizes")
    p = plan(sizes, weights, key="_key", **how)
    return p.assign(sizes, "_key", "source").select(
        F.col("_key").alias(key), "size", F.col("_mix_words").alias("source_size"), F.col("_mix_target").alias("target"),
        (F.col("size") * F.size("_mix_shards")).cast("long").alias("taken"), F.col("_mix_shards").alias("shards"))


def corpus(docs: DataFrame, weights: DataFrame, *, text: str = "text", key: str = "doc_id", source: str = "source",
           shard_words: int = 4_000_000, **how) -> DataFrame:
    """The mixed corpus, dealt to shards of about ``shard_words`` words and shuffled within each.

    One row per copy taken, with all columns of ``docs``, ``shard`` and ``place``.
    """
    sizes = settled(docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{source}`").alias("source"),
                                words(F.col(f"`{text}`")).alias("size")), "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    p = plan(sizes, weights, key="_key", shards=shards, **how)
    return mix(docs, p, key=key, source=source).repartition(shards, "shard").sortWithinPartitions("shard", "place")
