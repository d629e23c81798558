"""Connected components of an edge table, by contraction; no part of the graph leaves the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, match_counted


def _roots(parent: DataFrame, work: Workspace, name: str) -> DataFrame:
    """Pointer jumping: (u, m) with m the end of the chain u -> m(u) -> ...; each round halves what is left."""
    for i in range(64):
        up = parent.select(F.col("u").alias("m"), F.col("m").alias("mm")).filter("m <> mm")
        # Chains are followed by joining on targets; a target that many nodes share is found by its count.
        keyed = work.save(parent.groupBy("m").agg(F.count("*").alias("n")).join(up, "m"), f"{name}-up{i}")
        if keyed.isEmpty():
            return parent
        moved = match_counted(parent.select("u", "m"), keyed, ["m"], "n").select("u", F.col("mm").alias("m"))
        stay = parent.join(keyed.select(F.col("m")), "m", "left_anti").select("u", "m")
        parent = work.save(moved.unionByName(stay), f"{name}-jump{i}")
    raise RuntimeError("pointer chains longer than 2^64")


def components(edges: DataFrame, work: Workspace, name: str = "cc") -> DataFrame:
    """(node, component) of every node of edges(a, b); component is the least node reachable. A written table.

    A round points each node at its least neighbour, follows the pointers to their ends and contracts the graph to
    these. At least half of the nodes with an edge go in each round."""
    both = edges.filter("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v"))
    graph = work.save(both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), f"{name}-e0")
    label = None
    for i in range(64):
        if graph.isEmpty():
            break
        least = graph.groupBy("u").agg(F.min("v").alias("v"), F.count("*").alias("n")).select("u", F.least("u", "v").alias("m"), "n")
        least = work.save(least, f"{name}-m{i}")
        root = _roots(least.select("u", "m"), work, f"{name}-r{i}")
        counted = work.save(root.join(least.select("u", "n"), "u"), f"{name}-n{i}")
        half = match_counted(graph, counted, ["u"], "n").select(F.col("v").alias("u"), F.col("m").alias("w"))
        # The graph is symmetric, so n also counts the rows on this side.
        full = match_counted(half, counted, ["u"], "n").select(F.col("m").alias("u"), F.col("w").alias("v"))
        graph = work.save(full.filter("u <> v").distinct(), f"{name}-e{i + 1}")
        if label is None:
            label = root.select(F.col("u").alias("node"), F.col("m").alias("component"))
        else:
            sizes = label.groupBy("component").agg(F.count("*").alias("n"))
            keyed = work.save(sizes.join(root.select(F.col("u").alias("component"), "m"), "component", "left").withColumn("m", F.coalesce("m", "component")), f"{name}-k{i}")
            label = match_counted(label, keyed, ["component"], "n").select("node", F.col("m").alias("component"))
        label = work.save(label, f"{name}-l{i}")
    return label if label is not None else both.select(F.col("u").alias("node"), F.col("v").alias("component")).limit(0)


def joined(label: DataFrame, more: DataFrame, work: Workspace, name: str) -> DataFrame:
    """label(node, component) after more edges(a, b) are added: only those between components are contracted, and the edges
    that made the components are not gone through again. A written label; nodes of more may be new."""
    ends = [label.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")) for c in ("a", "b")]
    across = more.join(ends[0], "a", "left").join(ends[1], "b", "left").select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))
    across = work.save(across.filter("a <> b").distinct(), f"{name}-across")
    if across.isEmpty():
        return label
    top = components(across, work, name)
    sizes = label.groupBy("component").agg(F.count("*").alias("n"))
    keyed = work.save(sizes.join(top.select(F.col("node").alias("component"), F.col("component").alias("m")), "component", "left").withColumn("m", F.coalesce("m", "component")), f"{name}-keyed")
    moved = match_counted(label, keyed, ["component"], "n").select("node", F.col("m").alias("component"))
    return work.save(moved.unionByName(top.join(label.select("node"), "node", "left_anti")), f"{name}-joined")
