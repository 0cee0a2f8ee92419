"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fabspark.session import settled

MAX_ROUNDS = 60
BROADCAST_NODES = 500_000  # labels of up to so many nodes go to all executors (16 bytes each), more are joined


def relabelled(df: DataFrame, labels: DataFrame, column: str, few: bool) -> DataFrame:
    """``df`` with the values of ``column`` replaced by their component, where ``labels`` (node, component) has one."""
    new = labels.select(F.col("node").alias("_node"), F.col("component").alias("_new"))
    return df.join(F.broadcast(new) if few else new, F.col(column) == F.col("_node"), "left") \
        .withColumn(column, F.coalesce("_new", column)).drop("_node", "_new")


def _flat(labels: DataFrame, few: bool) -> DataFrame:
    """Labels followed to their ends: every look-up doubles the way, until no label has a smaller one."""
    for _ in range(MAX_ROUNDS):
        new = labels.select("node", F.col("component").alias("was"), "component")
        new = settled(relabelled(new, labels, "component", few), "labels")
        labels = new.select("node", "component")
        if new.where("component <> was").isEmpty():
            return labels
    raise RuntimeError("labels did not settle")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node in ``links``; the component is its smallest node.

    Contraction: every node takes the smallest one around it as its label, labels
    are followed to their ends, and the links between labels go on. A label that
    stays for two rounds has taken a node in the first, so two rounds leave at most
    half of the nodes. Tables are written to the shared folder, so neither lineage
    nor driver memory grows; the driver sees counts only. Null nodes and loops are
    dropped.
    """
    e = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")) \
        .where(f"`{a}` IS NOT NULL AND `{b}` IS NOT NULL AND u <> v").distinct()
    e = settled(e, "links")
    rounds = []
    for _ in range(MAX_ROUNDS):
        low = e.union(e.select("v", "u")).groupBy(F.col("u").alias("node")).agg(F.min("v").alias("v")) \
            .select("node", F.least("node", "v").alias("component"))
        low = settled(low, "labels")
        few = low.count() <= BROADCAST_NODES
        low = _flat(low, few)
        rounds.append((low, few))
        e = settled(relabelled(relabelled(e, low, "u", few), low, "v", few).where("u <> v")
                    .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        if e.isEmpty():
            break
    else:
        raise RuntimeError("links did not settle")
    out, _ = rounds[0]
    for low, few in rounds[1:]:
        out = relabelled(out, low, "component", few)
    return out


def joined(groups: DataFrame, links: DataFrame) -> DataFrame:
    """Components of the links behind ``groups`` (node, component) and of ``links`` (a, b) as well.

    Only the new links between components are looked at.
    """
    few = groups.count() <= BROADCAST_NODES
    ends = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    between = components(relabelled(relabelled(ends, groups, "u", few), groups, "v", few), "u", "v")
    between = settled(between, "between")
    met = relabelled(groups, between, "component", between.count() <= BROADCAST_NODES)
    # A node of new links alone is its own label there.
    return met.union(between.join(F.broadcast(groups) if few else groups, "node", "left_anti"))
