"""Near-duplicate vectors by a robust-pruned flat graph.

Equal vectors of one label are one node. Nodes of a label are put into the shards
of their ``OVERLAP`` nearest centroids (fitted on a bounded sample). Each shard
builds a flat graph: every node keeps those of its nearest nodes that no kept one
covers (robust pruning), and some far ones. The adjacency lists of all shards are
united. Every node is then searched for in its shards: a beam walks greedily from
the medoid, and from every node found in range the search expands over its
neighbours as long as new ones are in range. Hits are confirmed in double
precision. A pair that meets in several shards counts in the lowest of them only,
so tasks hand on counts and one link per node, never pairs.

A shard beyond ``SHARD`` nodes is cut into blocks, and each two blocks are
searched against each other: nothing is dropped, and no task grows. The recall
against brute force is measured on ``AUDIT`` nodes; below ``RECALL`` the search is
run again with more overlap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark.llm.components import components
from fabspark.llm.sample import by_hash
from fabspark.session import settled

COSINE = 0.98
SAMPLE = 20_000  # vectors that centroids are fitted on
TARGET = 1_000  # nodes of a cluster, as far as the sample allows
OVERLAP = 2
SHARD = 3_000  # nodes of a task's graph
NEAR = 16  # neighbours kept of the nearest
FAR = 8  # neighbours kept of random ones
POOL = 48  # candidates for either
ALPHA = 1.2
BEAM = 24
AUDIT = 200
RECALL = 0.95


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of a list column as unit vectors in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pruned(x: np.ndarray, rows: np.ndarray, pool: np.ndarray, keep: int) -> np.ndarray:
    """Robust pruning of each row's candidates; -1 fills up."""
    own = x[rows]
    to_own = 1.0 - np.einsum("rcd,rd->rc", x[pool], own)
    to_own[pool == rows[:, None]] = np.inf
    order = np.argsort(to_own, axis=1)
    pool, dist = np.take_along_axis(pool, order, 1), np.take_along_axis(to_own, order, 1)
    cand = x[pool]
    among = 1.0 - cand @ cand.transpose(0, 2, 1)
    alive = np.isfinite(dist)
    out = np.full((len(rows), keep), -1)
    each = np.arange(len(rows))
    for k in range(keep):
        pick = alive.argmax(axis=1)
        some = alive[each, pick]
        out[some, k] = pool[some, pick[some]]
        alive &= ~((ALPHA * among[each, pick] <= dist) & some[:, None])
        alive[each, pick] = False
    return out


def build(x: np.ndarray, seed: int = 3) -> np.ndarray:
    """Neighbours of every node of a shard: near ones, then far ones; -1 where there are fewer."""
    n = len(x)
    x = x.astype(np.float32)
    rng = np.random.default_rng(seed)
    out = np.full((n, NEAR + FAR), -1)
    size = min(POOL, n)
    for lo in range(0, n, 256):
        rows = np.arange(lo, min(lo + 256, n))
        sims = x[rows] @ x.T
        near = np.argpartition(-sims, size - 1, axis=1)[:, :size]
        out[rows, :NEAR] = _pruned(x, rows, near, NEAR)
        out[rows, NEAR:] = _pruned(x, rows, rng.integers(0, n, (len(rows), POOL)), FAR)
    return out


def search(x: np.ndarray, graph: np.ndarray, queries: np.ndarray, cosine: float) -> list[np.ndarray]:
    """Nodes in range of each query. ``graph`` has neighbours, -1 where there are fewer."""
    n = len(x)
    low = x.astype(np.float32)
    medoid = int(np.argmax(low @ low.mean(axis=0)))
    found: list[np.ndarray] = []
    for lo in range(0, len(queries), 512):
        q = queries[lo:lo + 512].astype(np.float32)
        m = len(q)
        each = np.arange(m)[:, None]
        seen = np.zeros((m, n + 1), bool)
        seen[:, [medoid, n]] = True
        ids = np.full((m, BEAM), n)
        ids[:, 0] = medoid
        sims = np.full((m, BEAM), -np.inf, np.float32)
        sims[:, 0] = q @ low[medoid]
        open_ = np.isfinite(sims)
        hits = seen & False
        hits[:, medoid] = sims[:, 0] >= cosine - 1e-4
        while True:
            best = np.where(open_, sims, -np.inf)
            at = best.argmax(axis=1)
            go = np.flatnonzero(np.isfinite(best[np.arange(m), at]))
            if not len(go):
                break
            open_[go, at[go]] = False
            near = graph[ids[go, at[go]]]
            near = np.where(near < 0, n, near)
            near = np.where(seen[go[:, None], near], n, near)
            seen[go[:, None], near] = True
            s = np.einsum("rcd,rd->rc", low[np.minimum(near, n - 1)], q[go])
            s[near == n] = -np.inf
            r, c = np.nonzero(s >= cosine - 1e-4)
            hits[go[r], near[r, c]] = True
            # The same node twice in a row of neighbours would take two places of the beam.
            all_ids = np.concatenate([ids[go], near], axis=1)
            all_sims = np.concatenate([sims[go], s], axis=1)
            all_open = np.concatenate([open_[go], np.isfinite(s)], axis=1)
            top = np.argpartition(-all_sims, BEAM - 1, axis=1)[:, :BEAM]
            row = np.arange(len(go))[:, None]
            ids[go], sims[go], open_[go] = all_ids[row, top], all_sims[row, top], all_open[row, top]
        for i in range(m):
            inside = np.flatnonzero(hits[i, :n])
            front = inside
            while len(front):  # expand while new nodes are in range
                near = np.unique(graph[front])
                near = near[near >= 0]
                near = near[~hits[i, near]]
                front = near[low[near] @ q[i] >= cosine - 1e-4]
                hits[i, front] = True
            inside = np.flatnonzero(hits[i, :n])
            found.append(inside[x[inside] @ queries[lo + i] >= cosine])
    return found


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node connected with each node by the links (a, b)."""
    root = np.arange(n)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def _centroids(sample: pa.Table, sizes: dict, target: int) -> dict:
    """Centroids of each (label, length) of the sample, by k-means."""
    out = {}
    for key in sorted(set(zip(sample["label"].to_pylist(), sample["dim"].to_pylist(), strict=True))):
        rows = sample.filter(pa.compute.and_(pa.compute.equal(sample["label"], key[0]), pa.compute.equal(sample["dim"], key[1])))
        x = _unit(rows["embedding"])
        k = max(1, min(round(sizes[key] / target), len(x) // 8))
        c = x[np.random.default_rng(1).choice(len(x), k, replace=False)]
        for _ in range(8):
            near = (x @ c.T).argmax(axis=1)
            sums = np.stack([np.bincount(near, x[:, d], k) for d in range(x.shape[1])], axis=1)
            norm = np.linalg.norm(sums, axis=1, keepdims=True)
            c = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), c)
        out[key] = c
    return out


def _assigned(nodes: DataFrame, centroids: dict, overlap: int) -> DataFrame:
    """Adds the shards of each node: those of its nearest centroids, in order."""
    shared = nodes.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, dim = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "dim"))
            shards = [[0]] * batch.num_rows
            for key in set(zip(label.tolist(), dim.tolist(), strict=True)):
                c = shared.value.get(key)
                at = np.flatnonzero((label == key[0]) & (dim == key[1]))
                if c is None or len(c) == 1:
                    continue
                sims = _unit(batch.column("embedding").take(pa.array(at))) @ c.T
                best = np.sort(np.argsort(-sims, axis=1, kind="stable")[:, :overlap], axis=1)
                for i, b in zip(at.tolist(), best.tolist(), strict=True):
                    shards[i] = b
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.list_(pa.int32()))],
                                             [*batch.schema.names, "shards"])

    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema.fields)
    return nodes.mapInArrow(run, f"{kind}, shards array<int>")


def _searched(nodes: DataFrame, cosine: float, shard_size: int) -> DataFrame:
    """(node, links, root) per node and task: weighted links, and a node it is connected with."""
    here = nodes.select("*", F.explode("shards").alias("shard"))
    blocks = settled(here.groupBy("label", "dim", "shard").agg(F.ceil(F.count("*") / shard_size).cast("int").alias("blocks")),
                     "blocks")
    here = here.join(blocks, ["label", "dim", "shard"]) \
        .withColumn("block", F.pmod("node", "blocks").cast("int"))

    def graph(rows: pa.Table) -> pa.Table:
        ids = rows["node"].to_numpy()
        order = np.argsort(ids)
        near = build(_unit(rows["embedding"])[order])
        some = near >= 0
        lists = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(some.sum(axis=1))].astype(np.int32)),
                                         pa.array(ids[order][near[some]]))
        return pa.table({"node": pa.array(ids[order]), "near": lists})

    lists = here.groupBy("label", "dim", "shard", "block").applyInArrow(graph, "node long, near array<bigint>")
    united = settled(lists.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")

    def task(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("node")
        x, ids = _unit(rows["embedding"]), rows["node"].to_numpy()
        block, weight = rows["block"].to_numpy(), rows["weight"].to_numpy()
        lo, hi, shard = (rows[c][0].as_py() for c in ("lo", "hi", "shard"))
        at, asked = np.flatnonzero(block == hi), np.flatnonzero(block == lo)
        if not len(at) or not len(asked):
            return pa.table({"node": pa.array([], pa.int64()), "links": pa.array([], pa.int64()), "root": pa.array([], pa.int64())})
        near = rows["near"].combine_chunks().take(pa.array(at))
        flat, bounds = near.flatten().to_numpy(zero_copy_only=False), np.r_[0, np.cumsum(pa.compute.list_value_length(near).to_numpy())]
        place = np.minimum(np.searchsorted(ids[at], flat), len(at) - 1)
        flat = np.where(ids[at][place] == flat, place, -1)  # neighbours in other blocks or shards are not here
        graph = np.full((len(at), int(np.diff(bounds).max(initial=1))), -1)
        graph[np.repeat(np.arange(len(at)), np.diff(bounds)), np.arange(len(flat)) - np.repeat(bounds[:-1], np.diff(bounds))] = flat
        hits = search(x[at], graph, x[asked], cosine)
        a = np.repeat(asked, [len(h) for h in hits])
        b = at[np.concatenate(hits)] if len(a) else a
        shards = rows["shards"].combine_chunks()
        width = int(pa.compute.max(pa.compute.list_value_length(shards)).as_py())
        own = np.full((len(ids), width), -1)
        size = pa.compute.list_value_length(shards).to_numpy()
        own[np.repeat(np.arange(len(ids)), size), np.concatenate([np.arange(s) for s in size])] = \
            shards.flatten().to_numpy(zero_copy_only=False)
        # The lowest shard that both are in counts the pair.
        both = (own[a][:, :, None] == own[b][:, None, :]) & (own[a][:, :, None] >= 0)
        first = np.where(both.any(axis=2), own[a], np.iinfo(np.int64).max).min(axis=1, initial=np.iinfo(np.int64).max)
        ok = (a != b) & (first == shard)
        a, b = np.minimum(a[ok], b[ok]), np.maximum(a[ok], b[ok])
        pair = np.unique(a * len(ids) + b)
        a, b = pair // len(ids), pair % len(ids)
        links = np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
        root = _roots(a, b, len(ids))
        some = np.flatnonzero(links)
        return pa.table({"node": pa.array(ids[some]), "links": pa.array(links[some].astype(np.int64)),
                         "root": pa.array(ids[root[some]])})

    tasks = here.join(united, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))) \
        .withColumn("lo", F.least("block", "other")).withColumn("hi", F.greatest("block", "other"))
    return tasks.groupBy("label", "dim", "shard", "lo", "hi").applyInArrow(task, "node long, links long, root long")


def audit(nodes: DataFrame, found: DataFrame, cosine: float, size: int = AUDIT) -> float:
    """Share of the links of ``size`` nodes (chosen by hash) that were found, against all nodes by brute force."""
    some = by_hash(nodes, "node", size, 9).select("node", "label", "dim", "embedding").toArrow()
    if not some.num_rows:
        return 1.0
    shared = nodes.sparkSession.sparkContext.broadcast(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some = shared.value
        total = np.zeros(some.num_rows, np.int64)
        label, dim, ids = (some[c].to_numpy() for c in ("label", "dim", "node"))
        for batch in batches:
            for d in np.unique(dim):
                rows, at = np.flatnonzero(batch.column("dim").to_numpy() == d), np.flatnonzero(dim == d)
                if not len(rows):
                    continue
                x = _unit(batch.column("embedding").take(pa.array(rows)))
                y = _unit(some["embedding"].combine_chunks().take(pa.array(at)))
                link = (y @ x.T >= cosine) & (label[at][:, None] == batch.column("label").to_numpy(zero_copy_only=False)[rows]) \
                    & (ids[at][:, None] != batch.column("node").to_numpy()[rows])
                total[at] += link @ batch.column("weight").to_numpy()[rows]
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["node", "exact"])

    exact = nodes.select("node", "label", "dim", "embedding", "weight").mapInArrow(run, "node long, exact long") \
        .groupBy("node").agg(F.sum("exact").alias("exact"))
    got, all_ = exact.join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left") \
        .agg(F.coalesce(F.sum(F.least(F.coalesce("links", F.lit(0)), "exact")), F.lit(0)),
             F.coalesce(F.sum("exact"), F.lit(0))).first()
    return got / all_ if all_ else 1.0


def near_duplicates(vectors: DataFrame, *, vector: str = "embedding", key: str = "vec_id", label: str = "label",
                    cosine: float = COSINE, shard_size: int = SHARD, target: int = TARGET) -> DataFrame:
    """One row per vector with its links and its component.

    Vectors of equal label whose cosine is at least ``cosine`` are linked. Returns
    ``key`` (long), ``n_links`` (other vectors linked directly), ``component_id``
    (smallest key reachable, itself included), ``kept`` (the key is its component)
    and ``audit_recall``. A vector that is null, empty, zero or holds null or
    non-finite components, and one with a null label, has no links; vectors of
    different lengths are not compared. Repeated rows are one vector and keep one
    row each; a null key has no component and is kept.
    """
    rows = vectors.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("string").alias("label"),
                          F.col(f"`{vector}`").cast("array<double>").alias("embedding"))
    fine = F.exists("embedding", lambda v: v != 0) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v)
                                                              & (F.abs(v) < float("inf")))
    rows = rows.withColumn("ok", F.coalesce(fine & F.col("id").isNotNull() & F.col("label").isNotNull(), F.lit(False))) \
        .withColumn("node", F.when(F.col("ok"), F.xxhash64("label", "embedding")))
    nodes = settled(rows.where("ok").groupBy("node").agg(
        F.first("label").alias("label"), F.first("embedding").alias("embedding"), F.min("id").alias("id"),
        F.count_distinct("id").alias("weight")).withColumn("dim", F.size("embedding")), "nodes")
    sample = by_hash(nodes, "node", SAMPLE, 1).select("label", "dim", "embedding").toArrow()
    keys = nodes.sparkSession.createDataFrame(
        sorted(set(zip(sample["label"].to_pylist(), sample["dim"].to_pylist(), strict=True))), "label string, dim int")
    sizes = {(r["label"], r["dim"]): r["n"] for r in
             nodes.join(F.broadcast(keys), ["label", "dim"]).groupBy("label", "dim").agg(F.count("*").alias("n")).collect()}
    centroids = _centroids(sample, sizes, target)
    for overlap in (OVERLAP, 2 * OVERLAP):
        found = settled(_searched(_assigned(nodes, centroids, overlap), cosine, shard_size), "found")
        recall = audit(nodes, found, cosine)
        if recall >= RECALL:
            break
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    at = lambda n, c: nodes.select(F.col("node").alias(n), F.col("id").alias(c))
    edges = found.where("node <> root").select("node", "root").distinct().join(at("node", "a"), "node").join(at("root", "b"), "root")
    groups = settled(components(edges.select("a", "b")), "groups")
    per = nodes.select("node", "id", "weight").join(links, "node", "left") \
        .join(groups.select(F.col("node").alias("id"), "component"), "id", "left") \
        .select("node", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
                F.coalesce("component", "id").alias("component"))
    return rows.select("id", "node").join(per, "node", "left").select(
        F.col("id").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        F.coalesce(F.col("id") == F.coalesce("component", "id"), F.lit(True)).alias("kept"),
        F.lit(float(recall)).alias("audit_recall"))
