"""Removal of byte strings of SIZE bytes that start at two places or more, over all documents.

Every window of SIZE bytes names one anchor: the least of its hashed GRAM-byte grams (the leftmost on ties). Equal
windows name equal anchors at equal places, so windows only need to meet within the anchors' groups. An anchor carries
its context, the bytes of all windows that name it, by hash:

1. anchors whose gram occurs once in the corpus hold no repeat;
2. a context that occurs again, hash and place, is repeated in whole, without its bytes being moved;
3. of what is left, a window has SIDE bytes before its gram or SIDE bytes after it; contexts whose bytes there, by hash,
   no other context of the gram shares hold no other repeat;
4. one copy of each context still left is dealt out by its gram in shards of bounded size. A shard's suffixes are sorted
   with their common prefixes (induced_sort): neighbours that share SIZE bytes are repeats, by comparison of the bytes.
   A gram with more than HOT contexts is dealt out window by window and counted with partial aggregation, so no group
   meets in one task.

Bytes that marked windows cover are then cut from their documents; windows are judged on the input alone. Texts are never
shuffled: tasks that scan documents read what concerns their rows from a table written for them (Beside).

Defined results: a null or empty text has 0 bytes and the digest of nothing; equal documents of SIZE bytes or more are
removed in whole, all of them; matches never span documents; texts of any length are read whole, in parts that share
SIZE - 1 bytes; rows of one doc_id are documents of their own; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import induced_sort
from .common import Beside, Workspace, match_counted, prepare_python
from .hashing import INVERSE, RANDOM, mix, powers

SIZE = 400
GRAM = 32
SIDE = (SIZE - GRAM) // 2
#: Contexts of a gram beyond which its windows are dealt out singly.
HOT = 2048
SHARD_BYTES = 8 << 20
PLACE = (1 << 24) - 1


def sums_of(buf: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.concatenate(([np.uint64(0)], np.cumsum(RANDOM[buf] * powers(len(buf)), dtype=np.uint64)))


def hash_between(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((sums[ends] - sums[starts]) * powers(len(sums), INVERSE, "down")[starts] + np.asarray(ends - starts, np.uint64))


def window_minima(x: np.ndarray, w: int) -> np.ndarray:
    """min(x[i:i+w]) for every i, by block-wise prefix and suffix minima."""
    n = len(x)
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.iinfo(x.dtype).max, x.dtype)
    padded[:n] = x
    square = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(square, 1).ravel()
    back = np.minimum.accumulate(square[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchors(raw: bytes, size: int = SIZE, gram: int = GRAM):
    """(gram hash, place in context, context hash, hashes of the sides, first window, last window) of each anchor of a
    document, as arrays. A side is the bytes next to the gram; it is 0 where no window of the context reaches that far.

    Long documents are cut into parts that share size - 1 bytes, so that every window lies in exactly one part."""
    out, step = [], PLACE // 2
    for base in range(0, max(len(raw) - size + 1, 0), step):
        buf = np.frombuffer(raw[base : base + step + size - 1], np.uint8)
        sums = sums_of(buf)
        at = np.arange(len(buf) - gram + 1)
        grams = hash_between(sums, at, at + gram)
        least = window_minima((grams & np.uint64(~PLACE & (2**64 - 1))) | at.astype(np.uint64), size - gram + 1)
        named = (least & np.uint64(PLACE)).astype(np.int64)
        first = np.concatenate(([0], np.flatnonzero(named[1:] != named[:-1]) + 1))
        last = np.append(first[1:] - 1, len(named) - 1)
        p, side = named[first], (size - gram) // 2
        low, high = np.maximum(p - side, 0), np.minimum(p + gram + side, len(buf))
        before = np.where(first <= p - side, (hash_between(sums, low, p) >> np.uint64(33)).astype(np.int32) | 1, 0)
        after = np.where(last + size >= p + gram + side, (hash_between(sums, p, high) >> np.uint64(33)).astype(np.int32) | 1, 0)
        out.append((grams[p], p - first, hash_between(sums, first, last + size), before.astype(np.int32), after.astype(np.int32), first + base, last + base))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else None


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _all_anchors(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, cols = [], []
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                got = anchors(_raw(text))
                if got is not None:
                    ids.append(np.full(len(got[0]), row))
                    cols.append(got)
            if ids:
                g, place, c, before, after, first, last = (np.concatenate(x) for x in zip(*cols, strict=True))
                arrays = [np.concatenate(ids), g.view(np.int64), place, c.view(np.int64), before, after, first, last]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["row", "gram", "place", "context", "before", "after", "first", "last"])

    return docs.mapInArrow(run, "row long, gram long, place long, context long, before int, after int, first long, last long")


def _contexts(docs: DataFrame, wanted: DataFrame, work: Workspace) -> DataFrame:
    """The bytes of the wanted contexts (row, gram, place, context, first, last), read from their documents."""
    beside = Beside(work, "wanted").save(wanted)
    names = ["gram", "place", "context"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some, found = [], []
            for text, at in zip(batch.column("text"), beside.of(batch.column("row")), strict=True):
                if at.num_rows:
                    raw = _raw(text.as_py())
                    found.append(at.select(names))
                    some += [raw[a : b + SIZE] for a, b in zip(at.column("first").to_pylist(), at.column("last").to_pylist(), strict=True)]
            if found:
                table = pa.concat_tables(found).combine_chunks()
                yield pa.RecordBatch.from_arrays([*(table.column(n).combine_chunks().cast(pa.int64()) for n in names), pa.array(some, pa.binary())], names=[*names, "bytes"])

    return docs.select("row", "text").mapInArrow(run, "gram long, place long, context long, bytes binary")


def window_hashes(parts: list[bytes], size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows of the parts: hash, index of the part, start in the part."""
    buf = np.frombuffer(b"".join(parts), np.uint8)
    begin = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    n = np.diff(begin) - size + 1
    part = np.repeat(np.arange(len(parts)), n)
    start = np.arange(len(part)) - np.repeat(np.concatenate(([0], np.cumsum(n)[:-1])), n)
    at = begin[part] + start
    return hash_between(sums_of(buf), at, at + size), part, start


FOUND = "gram long, place long, context long, a long, b long"


def _found(meta: list[tuple], spans: list[tuple[int, int, int]]) -> pa.Table:
    rows = [(*meta[p], a, b) for p, a, b in spans]
    return pa.table({n: pa.array([r[i] for r in rows], pa.int64()) for i, n in enumerate(("gram", "place", "context", "a", "b"))})


def _shard(folder: str):
    def run(table: pa.Table) -> pa.Table:
        meta = list(zip(*(table.column(c).to_pylist() for c in ("gram", "place", "context")), strict=True))
        parts = table.column("bytes").to_pylist()
        begin = np.concatenate(([0], np.cumsum([len(p) + 1 for p in parts])))
        marked = induced_sort.repeats(parts, SIZE, folder)
        spans = np.array(list(induced_sort.runs(marked)), np.int64).reshape(-1, 2)  # a part's last places are never marked
        part = np.searchsorted(begin, spans[:, 0], side="right") - 1
        return _found(meta, list(zip(part.tolist(), (spans[:, 0] - begin[part]).tolist(), (spans[:, 1] - begin[part]).tolist(), strict=True)))

    return run


def _single(contexts: DataFrame, work: Workspace) -> DataFrame:
    """The same result for grams of many contexts: windows as rows, counted by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            hashes, part, start = window_hashes(batch.column("bytes").to_pylist())
            cols = [batch.column(c).to_numpy()[part] for c in ("gram", "place", "context")]
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols), pa.array(start), pa.array(hashes.view(np.int64))], names=["gram", "place", "context", "start", "h"])

    rows = work.save(contexts.mapInArrow(run, "gram long, place long, context long, start long, h long"), "windows")
    many = work.save(rows.groupBy("gram", "h").agg(F.count("*").alias("n")).filter("n > 1"), "repeated-windows")
    return match_counted(rows, many, ["gram", "h"], "n").select("gram", "place", "context", F.col("start").alias("a"), F.col("start").alias("b"))


def covered(docs: DataFrame, work: Workspace) -> DataFrame:
    """(row, first, last) of runs of window starts that are repeats."""
    found = work.save(_all_anchors(docs), "anchors")
    ctx = ["gram", "place", "context"]
    facts = (F.count("*").alias("n"), F.first("before").alias("before"), F.first("after").alias("after"), F.min(F.struct("row", "first", "last")).alias("at"))
    one = work.save(found.groupBy(*ctx).agg(*facts), "contexts")
    grams = work.save(one.groupBy("gram").agg(F.count("*").alias("k"), F.sum("n").alias("n")).filter("n > 1"), "grams")
    several = work.save(match_counted(one, grams.filter("k > 1").select("gram", "k"), ["gram"], "k"), "several")
    # Both sides of a context as keys; a key that several contexts share is where a window of theirs can be equal.
    sides = F.array(F.struct(F.lit(0).alias("side"), F.col("before").alias("h")), F.struct(F.lit(1).alias("side"), F.col("after").alias("h")))
    keyed = several.select(*ctx, F.explode(sides).alias("s")).select(*ctx, "s.side", "s.h").filter("h <> 0")
    keyed = work.save(keyed, "sides")
    shared = work.save(keyed.groupBy("gram", "side", "h").agg(F.count("*").alias("n")).filter("n > 1"), "shared")
    near = work.save(match_counted(keyed, shared, ["gram", "side", "h"], "n").select(*ctx).distinct(), "near")
    several = work.save(several.join(near, ctx, "left_semi"), "open")
    work.drop("sides", "near", "shared")
    bytes_ = work.save(_contexts(docs, several.select(*ctx, "at.row", "at.first", "at.last"), work), "bytes")
    hot = several.filter(F.col("k") > HOT).select("gram").distinct()
    hot = work.save(hot, "hot")  # fewer grams than contexts / HOT
    cold = bytes_.join(hot, "gram", "left_anti")
    total = bytes_.agg(F.sum(F.length("bytes"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    spans = cold.withColumn("shard", F.pmod(F.xxhash64("gram"), F.lit(shards))).groupBy("shard").applyInArrow(_shard(work.path("queues")), FOUND)
    if not hot.isEmpty():
        spans = spans.unionByName(_single(bytes_.join(hot, "gram", "left_semi"), work))
    # Contexts that occur again are repeated in whole; the others where their shard says so.
    partly = spans.groupBy(*ctx).agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    known = one.join(partly, ctx, "left").filter("n > 1 or spans is not null")
    known = work.save(known.select(*ctx, "n", F.when(F.col("n") == 1, F.col("spans")).alias("spans")), "known")
    hits = match_counted(found.select("row", *ctx, "first", "last"), known, ctx, "n")
    whole = F.array(F.struct(F.col("first"), F.col("last")))
    part = F.transform("spans", lambda s: F.struct((F.col("first") + s["a"]).alias("first"), (F.col("first") + s["b"]).alias("last")))
    return hits.select("row", F.explode(F.when(F.col("spans").isNull(), whole).otherwise(part)).alias("s")).select("row", "s.*")


def cut(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of raw, and how many maximal runs of bytes went."""
    out, runs, at, end = [], 0, 0, -1
    for first, last in sorted((a, b + SIZE) for a, b in spans):
        if first > end:
            runs += 1
            out.append(raw[max(at, 0) : first])
        at = end = max(end, last)
    out.append(raw[at:])
    return b"".join(out), runs


def dedup(docs: DataFrame, texts: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row; with texts also the kept bytes."""
    spark = docs.sparkSession
    prepare_python(spark)
    work = Workspace(spark, "suffix_dedup")
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    beside = Beside(work, "spans").save(covered(rows.select("row", "text"), work))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, at in zip(batch.column("text").to_pylist(), beside.of(batch.column("row")), strict=True):
                raw = _raw(text)
                kept, n = cut(raw, list(zip(at.column("first").to_pylist(), at.column("last").to_pylist(), strict=True))) if at.num_rows else (raw, 0)
                out.append((len(raw), len(raw) - len(kept), n, hashlib.sha256(kept).hexdigest(), kept if texts else None))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[i] for r in out], t) for i, t in enumerate(types))], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    done = rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return done if texts else done.drop("kept")
