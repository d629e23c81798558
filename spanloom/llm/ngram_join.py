"""N-gram Jaccard join by parity sketches.

A document's word shingles are toggled into a wide bit sketch: every shingle flips one bit, so the Hamming distance of
two sketches is at most the size of the sets' symmetric difference. For a band of set sizes the threshold bounds that
difference by d; the sketch is cut into m > d blocks, so two similar documents agree on at least m - d whole blocks.
Blocks are joined by a 64-bit XOR of their set bits. Candidates are verified on the shingle sets of the whole texts.

* A set's blocks are ordered: those of two shingles or more by their key, then those of one, then empty ones. As a pair
  agrees on m - d blocks or more, the first block it agrees on is among the first d + 1 of either, so these alone are keys.
  Where fewer than d + 1 blocks hold anything, empty ones would be keys, which unrelated sets share: such a set takes the
  blocks it has and is laid out once more under another seed. Both sets of a similar pair come to the first seed under
  which either has d + 1 filled blocks, and there they agree on a filled one. After the last seed empty blocks are keys.
* Documents of equal sets are one node, so copies are never paired with each other.
* Block rows are dealt by ranges of (key, document), so a key of any size spreads over tasks. Rows of keys that are not
  alone get their folded sketch and are dealt once more. A task compares the sketches of all pairs of a run of at most RUN
  rows, and of a star and a chain of a longer one; only pairs within the bound leave it, so no table holds the others.
  These pairs are verified on the texts and joined into components, which settles groups of near copies.
* Keys whose long runs still hold several components are dealt out as pairs of tiles of TILE documents. A task compares
  the sketches of one pair of tiles and gives only pairs within the bound, which are verified as well. No link is lost
  to a cap, and no group meets in one task.

Defined results: no words or a null text: no shingles, linked with nothing; fewer words than a shingle has: their
sequence is the one shingle; rows of one doc_id are one node, whatever their texts; a null doc_id is in no component; a
text of any length is read whole (its sketch stops growing at SKETCH_BITS, its keys grow with it); an empty table gives no
rows; extra columns are ignored by `classes` and kept by `keep_one`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, match_counted, prepare_python
from .components import components
from .components import joined as with_edges
from .hashing import LOWER, chunks, joined, mix, range_hashes, word_spans

RUN = 64
TILE = 2048
#: Layouts of a small set before empty blocks become keys.
SEEDS = 8
#: Block rows that a task sorts at once, about, and bytes of the rows that it compares; more make more tasks.
TASK_ROWS = 2_000_000
TASK_BYTES = 32 << 20
#: Bits of a document's own sketch: a power of two of at least twice its shingles, within these. Rows of runs, which are
#: many and mostly unrelated, move with the sketch folded to a quarter.
SKETCH_BITS = (512, 1 << 14)
#: Ids of candidates that may be broadcast (8 MB); beyond it they meet the texts in a shuffled join.
FEW_IDS = 1_000_000
SETS = "doc_id long, n_shingles long, f1 long, f2 long, keys array<long>, sketch binary, mini binary"


class Bands:
    """Bands of set sizes for a threshold p/q: band i has smaller sets in [at[i], at[i+1]) and larger ones up to q/p times that."""

    def __init__(self, p: int, q: int):
        self.p, self.q, self.at = p, q, [1]

    def _reach(self, i: int) -> None:
        while len(self.at) <= i:
            self.at.append(max(self.at[-1] + 1, self.at[-1] * self.q * self.q // (self.p * self.p)))

    def of(self, n: int) -> list[tuple[int, int, int]]:
        """(band, d, m) of each band that a set of n shingles is in."""
        i = 0
        while self._reach(i + 1) or self.at[i + 1] <= n:
            i += 1
        bands = [i] + ([i - 1] if i and n <= (self.at[i] - 1) * self.q // self.p else [])
        out = []
        for b in bands:
            top = self.at[b + 1] - 1
            d = (self.q - self.p) * (top + top * self.q // self.p) // (self.q + self.p)
            if d:  # at d = 0 only equal sets are similar
                out.append((b, d, d + 1 + (2 * d) // 5))
        return out


def shingle_hashes(texts: list, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles, A-Z lower-cased."""
    buf, at = joined(texts)
    buf = LOWER[buf]
    starts, ends = word_spans(buf)
    hashes = range_hashes(buf, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    bounds = np.searchsorted(starts, at)
    odd = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        whole = np.zeros(max(len(hashes) - size + 1, 0), np.uint64)
        for k in range(size):
            whole += hashes[k : k + len(whole)] * odd[k]
        whole = mix(whole)
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a >= size:
                yield np.unique(whole[a : b - size + 1])
            elif b > a:
                yield mix(np.array([np.sum(hashes[a:b] * odd[: b - a], dtype=np.uint64) + np.uint64(b - a)], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def block_keys(shingles: np.ndarray, bands: Bands) -> np.ndarray:
    """The join keys of one set: its first d + 1 blocks of every band it is in."""
    out = []
    for band, d, m in bands.of(len(shingles)) if len(shingles) else ():
        for seed in range(SEEDS):
            salt = np.uint64(band + 1) << np.uint64(32) | np.uint64(seed) << np.uint64(56)
            # The high half of h says which block, so sorting h brings blocks together; the low half says which bit in it.
            h = np.sort(mix(shingles ^ mix(np.array([salt], np.uint64))))
            block = ((h >> np.uint64(32)) * np.uint64(m)) >> np.uint64(32)
            first = np.concatenate(([0], np.flatnonzero(block[1:] != block[:-1]) + 1))
            parity = np.bitwise_xor.reduceat(mix(h & np.uint64(0xFFFFFFFF)), first)
            with np.errstate(over="ignore"):
                key = mix(mix(parity) + mix(block[first] + salt))
            if len(key) > d:
                single = np.diff(np.append(first, len(h))) < 2
                out.append(key[np.lexsort((key, single))[: d + 1]])
                break
            out.append(key)
        else:
            empty = np.setdiff1d(np.arange(m, dtype=np.uint64), block[first], assume_unique=True)
            with np.errstate(over="ignore"):
                out.append(np.sort(mix(mix(np.zeros(1, np.uint64)) + mix(empty + salt)))[: d + 1 - len(key)])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def parity_sketch(shingles: np.ndarray) -> bytes:
    """Every shingle flips bit (hash mod size). Folding a sketch in half by XOR gives that of half the size."""
    least, most = SKETCH_BITS
    bits = min(most, max(least, 1 << (2 * len(shingles)).bit_length()))
    flips = np.bincount((mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((flips & 1).astype(np.uint8), bitorder="little").tobytes()


def folded(sketch: bytes, size: int) -> np.ndarray:
    x = np.frombuffer(sketch, np.uint64)
    while len(x) * 8 > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def within(n: np.ndarray, m: np.ndarray, distance: np.ndarray, p: int, q: int) -> np.ndarray:
    """Whether sets of n and m shingles whose sketches differ in so many bits can reach p/q."""
    return (np.minimum(n, m) * q >= np.maximum(n, m) * p) & (distance * (q + p) <= (q - p) * (n + m))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def sets(docs: DataFrame, size: int, p: int, q: int) -> DataFrame:
    """Per row its set's size, 128-bit fingerprint, block keys and sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = Bands(p, q)
        for batch in batches:
            texts, n, f1, f2, keys, sketch = batch.column("text").to_pylist(), [], [], [], [], []
            for i, j in chunks(texts):
                for s in shingle_hashes(texts[i:j], size):
                    n.append(len(s))
                    f1.append(np.sum(s, dtype=np.uint64))
                    f2.append(np.sum(mix(s ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64))
                    keys.append(block_keys(s, bands))
                    sketch.append(parity_sketch(s))
            flat = _signed(np.concatenate([*keys, np.zeros(0, np.uint64)]))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(k) for k in keys]))), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), _signed(np.array(f1, np.uint64)), _signed(np.array(f2, np.uint64)), lists, pa.array(sketch, pa.binary()), pa.array([folded(x, len(x) // 4).tobytes() for x in sketch], pa.binary())], names=["doc_id", "n_shingles", "f1", "f2", "keys", "sketch", "mini"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SETS)


def _columns(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> list[pa.Array] | None:
    """Columns of all rows of a task, or None without rows."""
    parts = [b for b in batches if b.num_rows]
    return [pa.concat_arrays([b.column(c) for b in parts]) for c in names] if parts else None


def _sorted_runs(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by (key, doc); per run of a key its start and length, and whether it is a task's first or last."""
    order = np.lexsort((doc, key))
    key = key[order]
    start = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1))
    edge = np.zeros(len(start), bool)
    edge[[0, -1]] = True
    return order, start, np.diff(np.append(start, len(key))), edge


def meeting(rows: DataFrame, total: int) -> DataFrame:
    """Of total rows (key, doc) those whose key another row has, or may have in the next task."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = _columns(batches, ("key", "doc"))
        if cols:
            key, doc = (c.to_numpy(zero_copy_only=False) for c in cols)
            order, _, length, edge = _sorted_runs(key, doc)
            keep = order[np.repeat((length > 1) | edge, length)]
            yield pa.RecordBatch.from_arrays([pa.array(key[keep]), pa.array(doc[keep])], names=["key", "doc"])

    return rows.select("key", "doc").repartitionByRange(tasks, "key", "doc").mapInArrow(run, "key long, doc long")


def distances(raw: list[bytes], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which sketches a and b differ, the larger folded to the size of the smaller."""
    words = np.array([len(x) for x in raw]) // 8
    level, out = np.minimum(words[a], words[b]), np.zeros(len(a), np.int64)
    for w in np.unique(level):
        some = np.flatnonzero(level == w)
        used = np.unique(np.concatenate((a[some], b[some])))
        bits = np.zeros((len(used), w), np.uint64)
        for v in np.unique(words[used]):
            own = np.flatnonzero(words[used] == v)
            x = np.frombuffer(b"".join(raw[i] for i in used[own]), np.uint64).reshape(len(own), v)
            while x.shape[1] > w:
                x = x[:, : x.shape[1] // 2] ^ x[:, x.shape[1] // 2 :]
            bits[own] = x
        for i in range(0, len(some), 1 << 14):
            at = some[i : i + (1 << 14)]
            out[at] = np.bitwise_count(bits[np.searchsorted(used, a[at])] ^ bits[np.searchsorted(used, b[at])]).sum(1)
    return out


def runs(rows: DataFrame, tasks: int, p: int, q: int, most: int = RUN) -> DataFrame:
    """From rows (key, doc, n, mini): pairs whose sizes n and sketches mini are within the bound (hot null), and the rows of
    keys too long or cut by a task's edge (hot their key)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = _columns(batches, ("key", "doc", "n", "mini"))
        if not cols:
            return
        key, doc, size = (c.to_numpy(zero_copy_only=False) for c in cols[:3])
        order, start, length, edge = _sorted_runs(key, doc)
        key, doc, size, raw = key[order], doc[order], size[order].astype(np.int64), cols[3].take(pa.array(order)).to_pylist()
        found = [np.zeros((0, 2), np.int64)]

        def compare(a: np.ndarray, b: np.ndarray) -> None:
            fit = within(size[a], size[b], np.zeros(len(a), np.int64), p, q)
            a, b = a[fit], b[fit]
            if len(a):
                near = within(size[a], size[b], distances(raw, a, b), p, q)
                a, b = doc[a[near]], doc[b[near]]
                found.append(np.stack((np.minimum(a, b), np.maximum(a, b)), 1))

        for k in range(1, most):  # neighbours k apart in short runs of more than k rows
            some = (length > k) & (length <= most)
            s, n = start[some], length[some] - k
            if not len(s):
                break
            at = np.repeat(s - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(int(n.sum()))
            compare(at, at + k)
        long = length > most
        for s, n in zip(start[long], length[long], strict=True):
            rest = np.arange(s + 1, s + n)
            compare(np.concatenate((rest - 1, np.full(n - 1, s))), np.concatenate((rest, rest)))
        pairs = np.unique(np.concatenate(found), axis=0)
        left = np.repeat(long | edge, length)
        hot = pa.concat_arrays([pa.nulls(len(pairs), pa.int64()), pa.array(key[left])])
        yield pa.RecordBatch.from_arrays([hot, *(pa.array(np.concatenate((pairs[:, i], doc[left]))) for i in (0, 1))], names=["hot", "a", "b"])

    return rows.repartitionByRange(tasks, "key", "doc").mapInArrow(run, "hot long, a long, b long")


def tiles(hot: DataFrame, several: DataFrame, sketches: DataFrame, p: int, q: int, tile: int = TILE) -> DataFrame:
    """From (key, doc, comp): the pairs of a key of different components whose sketches are within the bound.

    A key of n rows is cut into n / tile tiles; each pair of tiles is a task's group of at most about 2 tile rows."""

    def run(table: pa.Table) -> pa.Table:
        doc, comp, n, side = (table.column(c).to_numpy() for c in ("doc", "comp", "n", "side"))
        raw = table.column("sketch").to_pylist()
        size = min(map(len, raw))
        bits = np.stack([folded(s, size) for s in raw])
        lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
        left = np.flatnonzero(side == lo)
        right = left if lo == hi else np.flatnonzero(side == hi)
        out = [np.zeros((0, 2), np.int64)]
        for i in left:
            j = right[(comp[right] != comp[i]) & ((doc[right] > doc[i]) | (lo != hi))]
            j = j[within(n[i], n[j], np.zeros(len(j), np.int64), p, q)]
            far = np.bitwise_count(bits[j] ^ bits[i]).sum(1).astype(np.int64)
            j = j[within(n[i], n[j], far, p, q)]
            out.append(np.stack((np.minimum(doc[i], doc[j]), np.maximum(doc[i], doc[j])), 1))
        both = np.concatenate(out)
        return pa.table({"a": both[:, 0], "b": both[:, 1]})

    parts = several.select("key", F.ceil(F.col("n") / tile).cast("long").alias("parts"), "n")
    dealt = match_counted(hot, parts, ["key"], "n").drop("n").withColumn("side", F.pmod(F.xxhash64("doc"), "parts"))
    dealt = dealt.select("key", "doc", "comp", "side", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"))
    dealt = dealt.join(sketches.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "sketch"), "doc")
    pair = {"lo": F.least("side", "other"), "hi": F.greatest("side", "other")}
    return dealt.withColumns(pair).drop("other").groupBy("key", "lo", "hi").applyInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, size: int, p: int, q: int) -> DataFrame:
    """The pairs (a, b) whose sets reach p/q, by exact counts over the whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, np.ndarray] = {}

        def of(text: str) -> np.ndarray:
            if text not in known:
                if len(known) >= 256:
                    known.clear()
                known[text] = next(shingle_hashes([text], size))
            return known[text]

        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                s, t = of(x), of(y)
                both = len(s) + len(t)
                if min(len(s), len(t)) * q < max(len(s), len(t)) * p:
                    keep.append(False)
                    continue
                shared = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(shared > 0 and q * shared >= p * (both - shared))
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(pa.array(keep)), batch.column("b").filter(pa.array(keep))], names=["a", "b"])

    x = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x"))
    y = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y"))
    return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    few = ids.count() <= FEW_IDS
    return docs.filter("text is not null").select("doc_id", "text").join(F.broadcast(ids) if few else ids, "doc_id", "left_semi")


def links(docs: DataFrame, reps: DataFrame, work: Workspace, size: int, p: int, q: int) -> DataFrame:
    """(node, component) of the representatives that link to another."""
    rows = reps.select(F.explode("keys").alias("key"), F.col("doc_id").alias("doc"))
    sketches = work.save(reps.select("doc_id", "n_shingles", "sketch", "mini"), "sketches")
    total = reps.agg(F.sum(F.size("keys"))).first()[0] or 0
    met = work.save(meeting(rows, total), "met")
    work.drop("reps")  # the keys, most of what was written, have done their work
    mini = sketches.select(F.col("doc_id").alias("doc"), F.col("n_shingles").cast("int").alias("n"), "mini")
    met = work.save(met.join(mini, "doc").select("key", "doc", "n", "mini"), "met-mini")
    held = met.agg(F.sum(F.length("mini") + 64)).first()[0] or 0
    tasks = max(int(work.spark.conf.get("spark.sql.shuffle.partitions")), -(-held // TASK_BYTES))
    found = work.save(runs(met, tasks, p, q), "runs")
    work.drop("met", "met-mini")
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()

    def check(pairs: DataFrame, name: str) -> DataFrame:
        close = work.save(pairs, f"close-{name}")
        texts = work.save(texts_of(docs, work.save(ends(close), f"ids-{name}")), f"texts-{name}")
        return work.save(verified(close, texts, size, p, q), f"edges-{name}")

    edges = check(found.filter("hot is null").select("a", "b").distinct(), "runs")
    label = components(edges, work, "cc")
    hot = found.filter("hot is not null").select(F.col("hot").alias("key"), F.col("a").alias("doc"))
    hot = hot.join(label.select(F.col("node").alias("doc"), "component"), "doc", "left").select("key", "doc", F.coalesce("component", "doc").alias("comp"))
    hot = work.save(hot, "hot")
    work.drop("runs")
    several = hot.groupBy("key").agg(F.count("*").alias("n"), F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("key", "n")
    several = work.save(several, "several")
    if several.isEmpty():
        return label
    more = check(tiles(hot, several, sketches, p, q), "tiles")
    return with_edges(label, more, work, "cc-tiles")


def classes(docs: DataFrame, size: int = 5, p: int = 80, q: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row: documents link where q * shared >= p * union."""
    spark = docs.sparkSession
    prepare_python(spark)
    work = Workspace(spark, "ngram_join")
    full = work.save(sets(docs, size, p, q), "sets")
    mark = ["n_shingles", "f1", "f2"]
    all_sets = work.save(full.select("doc_id", *mark), "facts")
    some = all_sets.filter("n_shingles > 0 and doc_id is not null")
    equal = work.save(some.groupBy(*mark).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "equal")
    same = match_counted(some.select("doc_id", *mark), equal.filter("n > 1"), mark, "n").filter("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # A set is sketched once: rows that are their class's least id.
    least = equal.select(F.col("rep").alias("doc_id"), *mark)
    reps = full.filter("n_shingles > 0 and doc_id is not null").join(least, ["doc_id", *mark], "left_semi").filter(F.size("keys") > 0).dropDuplicates(["doc_id", *mark])
    reps = work.save(reps.select("doc_id", "n_shingles", "keys", "sketch", "mini"), "reps")
    work.drop("sets")
    label = links(docs, reps, work, size, p, q)
    # Classes take their representative's component. An id that is in several classes joins them.
    shared = some.select("doc_id", *mark).distinct().groupBy("doc_id").agg(F.count("*").alias("k")).filter("k > 1")
    if not shared.isEmpty():
        label = components(same.unionByName(label.select(F.col("node").alias("a"), F.col("component").alias("b"))), work, "cc-ids")
        equal_label = equal.join(label.select(F.col("node").alias("rep"), "component"), "rep", "left")
    else:
        equal_label = equal.join(label.select(F.col("node").alias("rep"), "component"), "rep", "left")
    keyed = work.save(equal_label.select(*mark, "n", F.coalesce("component", "rep").alias("component")), "labelled")
    out = match_counted(some.select("doc_id", *mark), keyed, mark, "n").select("doc_id", "n_shingles", F.col("component").alias("component_id"))
    none = all_sets.filter("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return out.unionByName(none)


def keep_one(docs: DataFrame, size: int = 5, p: int = 80, q: int = 100) -> DataFrame:
    """docs without the documents that are in a component but not its least id; repeated rows of an id stay once each."""
    gone = classes(docs, size, p, q).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*(F.col(f"`{c}`") for c in docs.columns))
