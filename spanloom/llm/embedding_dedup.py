"""Embedding near-dedup by int8 tile products with rigorous error bounds.

Vectors of a label are compared tile by tile. A tile holds unit vectors u = s*q + e with int8 codes q, a scale s and
the exact norm of the error e. For two vectors |u.v - s*t*(q.r)| <= |e| + |f| + |e||f|, so a pair whose code product
plus that bound stays under the threshold can't link. Only the others are recomputed from the stored components in
double precision. Code products are exact: a matrix product of small integers in float32 (float64 for long vectors).

Equal vectors of a label are one node with a multiplicity, so a vector that a third of the rows share costs one row.
Tiles are dealt by a hash, and a task holds two tiles, whatever the label's size. It gives link counts per vector and
a spanning forest of the links it found, not the links.

Defined results: null, zero or non-finite vectors, null components and null labels link with nothing; vectors of other
length link with nothing; repeated vec_ids are rows of their own in the counts and one node in components; an empty
table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, match_counted, prepare_python
from .components import components

TILE = 2048
THRESHOLD = 0.98
GROUP = ["label", "dim"]
SAME = [*GROUP, "h1", "h2"]


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scales, and upper bounds of the error's norm, of the unit vectors of the rows of x (double)."""
    unit = x / np.sqrt((x * x).sum(1))[:, None]
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None])
    error = np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(1)) + 1e-12
    return codes.astype(np.int8), scale, error


def linked(x: np.ndarray, y: np.ndarray, same: bool, threshold: float = THRESHOLD, block: int = 256, pairs: int = 1 << 15):
    """Index arrays (i, j), chunk by chunk, of the rows with cosine >= threshold; i < j only if same."""
    (qx, sx, ex), (qy, sy, ey) = quantised(x), quantised(y)
    exact = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64
    qy = qy.astype(exact).T
    nx, ny = np.sqrt((x * x).sum(1)), np.sqrt((y * y).sum(1))
    for a in range(0, len(x), block):
        part = slice(a, a + block)
        upper = (qx[part].astype(exact) @ qy).astype(np.float64) * np.outer(sx[part], sy)
        upper += ex[part, None] + ey + np.outer(ex[part], ey)
        i, j = np.nonzero(upper >= threshold - 1e-9)
        i += a
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), pairs):
            s, t = i[k : k + pairs], j[k : k + pairs]
            keep = np.einsum("ij,ij->i", x[s], y[t]) / (nx[s] * ny[t]) >= threshold
            yield s[keep], t[keep]


def forest(n: int, i: np.ndarray, j: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """Least node of each node's component after adding the links (i, j) to components given by root."""
    root = np.arange(n) if root is None else root
    while True:
        a, b = root[i], root[j]
        if (a == b).all():
            return root
        low = root.copy()
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low[low] != low).any():
            low = low[low]
        root = low[root]


def _tile_pair(table: pa.Table) -> pa.Table:
    """Counts (a, n) and forest edges (a, b) of the links in one pair of tiles."""
    side, node, n = (table.column(c).to_numpy() for c in ("side", "node", "n"))
    order = np.argsort(node, kind="stable")
    flat = table.column("embedding").combine_chunks()
    x = np.asarray(flat.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(len(node), -1)[order]
    side, node, n = side[order], node[order], n[order]
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    left, right = np.flatnonzero(side == lo), np.flatnonzero(side == hi)
    links, root = np.zeros(len(node), np.int64), np.arange(len(node))
    if len(left) and len(right):
        for i, j in linked(x[left], x[right], lo == hi):
            i, j = left[i], right[j]
            links += np.bincount(i, n[j], len(node)).astype(np.int64) + np.bincount(j, n[i], len(node)).astype(np.int64)
            root = forest(len(node), i, j, root)
    some, child = np.flatnonzero(links), np.flatnonzero(root != np.arange(len(node)))
    a = np.concatenate((node[some], node[child]))
    b = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(node[root[child]])])
    count = pa.concat_arrays([pa.array(links[some]), pa.nulls(len(child), pa.int64())])
    return pa.table({"a": pa.array(a), "b": b, "n": count})


def near_duplicates(vectors: DataFrame, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    prepare_python(spark)
    work = Workspace(spark, "embedding_dedup")
    e = F.col("embedding")
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = F.coalesce(F.col("label").isNotNull() & finite & F.exists(e, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), e.alias("embedding"), good.alias("good"))
    keyed = rows.filter("good and vec_id is not null").withColumns({"dim": F.size(e), "h1": F.xxhash64(e), "h2": F.xxhash64(F.lit(1), F.reverse(e))})
    same = work.save(keyed.groupBy(*SAME).agg(F.min("vec_id").alias("node"), F.count("*").alias("n"), F.first("embedding").alias("embedding")), "same")
    sizes = work.save(same.groupBy(*GROUP).agg(F.count("*").alias("size")), "sizes")
    parts = F.ceil(F.col("size") / tile).cast("long")
    dealt = match_counted(same.select(*GROUP, "node", "n", "embedding"), sizes, GROUP, "size").withColumn("side", F.pmod(F.xxhash64("node"), parts))
    dealt = dealt.select(*GROUP, "node", "n", "embedding", "side", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other"))
    dealt = dealt.withColumns({"lo": F.least("side", "other"), "hi": F.greatest("side", "other")}).drop("other")
    found = work.save(dealt.groupBy(*GROUP, "lo", "hi").applyInArrow(_tile_pair, "a long, b long, n long"), "found")
    # Rows that share a vec_id in different classes are one node: an edge joins its classes' nodes.
    ids = keyed.select("vec_id", *SAME)
    members = work.save(match_counted(ids, same.select(*SAME, "node", "n"), SAME, "n").select("vec_id", "node", "n"), "members")
    own = members.filter("vec_id <> node").select(F.col("vec_id").alias("a"), F.col("node").alias("b"))
    twice = members.select("vec_id", "node").distinct().groupBy("vec_id").agg(F.count("*").alias("k")).filter("k > 1")
    edges = found.filter("b is not null").select("a", "b")
    label = components(edges if twice.isEmpty() else edges.unionByName(own), work)
    links = found.filter("n is not null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    counted = members.groupBy("node").agg(F.count("*").alias("m"))
    facts = counted.join(links, "node", "left").join(label, "node", "left")
    facts = work.save(facts.select("node", "m", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "node").alias("component")), "facts")
    out = match_counted(members, facts, ["node"], "m").select("vec_id", (F.col("links") + F.col("n") - 1).alias("n_links"), F.col("component").alias("component_id"))
    rest = rows.filter("not good or vec_id is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.col("vec_id") == F.col("component_id"))
