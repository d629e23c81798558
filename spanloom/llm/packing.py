"""Packing token sequences: best-fit decreasing over a segment tree of remaining capacities.

One pass tokenizes every document, cuts it into full windows plus a rest and keeps only lengths and checksums. The rests
are dealt by a hash of their document into shards of bounded size; each shard packs its rests longest first, each into
the open window with the least room that still holds it. Full windows are sequences of their own. A shard leaves only
its last few windows with room, which is small against the tens of thousands of rests it holds.

Defined results: a null or empty text is one piece that holds only the closing id; equal rows are packed each for
itself; a null doc_id stays null; a text of any length is tokenized whole and cut into full windows; an empty table gives
no pieces; other columns are ignored, so names can't clash.
"""

from __future__ import annotations

import gc
import os
import re
import unicodedata
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace, prepare_python

WINDOW = 4096
#: A shard holds about this many rests, whatever the table's size.
SHARD_RESTS = 50_000
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


class Numbers(dict):
    """Words by number. One that is missing gets its number of the generation before, or the next free one."""

    def __init__(self, old: dict[str, int], free: int):
        super().__init__()
        self.old, self.free, self.fresh = old, free, []

    def __missing__(self, word: str) -> int:
        k = self.old.get(word)
        if k is None:
            k, self.free = self.free, self.free + 1
            self.fresh.append(word)
        self[word] = k
        return k


class Tokens:
    """Ids of texts as little-endian 32-bit bytes, equal to tokenizers' encode(add_special_tokens=False).

    No id spans white space, so a word's ids depend on it alone: each word is numbered in one look-up, the ids of words
    lie end to end in one table, and a text's ids are gathered from it by the numbers. Latin texts take this way, with
    the vocabulary's normalizer (NFC, lower case) in Python's terms; a text with any character on which the two engines
    could differ, or that might hold the name of a special token, goes to the library whole."""

    ODD = "[^\t\n\r\x20-\x7e\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-\u012f\u0131-\u01c3]|<\\|"
    #: Words of a generation of the table, which holds two at most; words gathered and words encoded at once.
    WORDS, CHUNK, BLOCK = 600_000, 500_000, 1000

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.beyond = re.compile(self.ODD).search
        self.known = bytes(i for i in range(256) if not self.beyond(chr(i)))
        self.numbers = Numbers({}, 0)
        self.ids, self.used = np.zeros(1 << 20, "<u4"), 0
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def odd(self, text: str) -> bool:
        """Whether a text must go to the library whole."""
        try:
            return "<|" in text or bool(text.encode("latin-1").translate(None, self.known))
        except UnicodeEncodeError:
            return bool(self.beyond(text))

    def _store(self, numbers: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(self.used + 2 * len(ids), "<u4")])
        self.ids[self.used : self.used + len(ids)] = ids
        self.start[numbers] = self.used + np.cumsum(lengths) - lengths
        self.length[numbers] = lengths
        self.used += len(ids)

    def _gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of numbered words one after another, and each word's count."""
        lengths = self.length[numbers]
        ends = np.cumsum(lengths)
        shift = np.repeat(self.start[numbers] - ends + lengths, lengths)
        return self.ids[shift + np.arange(len(shift))], lengths

    def _turn(self) -> None:
        """The words of this generation become the old one, alone in the table; those met there again move up."""
        ids, lengths = self._gather(np.fromiter(self.numbers.values(), np.int64, len(self.numbers)))
        n = len(lengths)
        self.numbers = Numbers(dict(zip(self.numbers, range(n), strict=True)), n)
        self.used, self.start, self.length = 0, np.zeros(n, np.int64), np.zeros(n, np.int64)
        self._store(np.arange(n), ids, lengths)

    def _encoded(self, block: list[str], joined: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block of words, and each word's count. Words of letters are one pre-token each, so they can be read as
        one text, which is faster; should their number not come out, they are read one by one."""
        got = self.tokenizer.encode("\n".join(block) if joined else block, is_pretokenized=not joined, add_special_tokens=False)
        of = np.array(got.word_ids, np.int64)
        if joined:
            of = np.cumsum(np.diff(of, prepend=of[:1]) != 0)
            if len(of) == 0 or of[-1] + 1 != len(block):
                return self._encoded(block, False)
        return np.array(got.ids, "<u4"), np.bincount(of, minlength=len(block))

    def _learn(self) -> None:
        """Encodes the fresh words. Letters with one mark after them are the letters' ids and the mark's."""
        numbers, fresh = self.numbers, self.numbers.fresh
        marked, letters, others = [], [], []
        for w in fresh:  # grows while it is walked: a marked word's letters may be new
            if w.isalpha():
                letters.append(w)
            elif w[-1] in ".,;:" and w[:-1].isalpha():
                marked.append((numbers[w], numbers[w[:-1]], numbers[w[-1]]))
            else:
                others.append(w)
        grow = np.zeros(numbers.free - len(self.start), np.int64)
        self.start, self.length = np.concatenate([self.start, grow]), np.concatenate([self.length, grow])
        for words, joined in ((letters, True), (others, False)):
            for i in range(0, len(words), self.BLOCK):
                block = words[i : i + self.BLOCK]
                self._store(np.fromiter(map(numbers.__getitem__, block), np.int64, len(block)), *self._encoded(block, joined))
        if marked:
            table = np.array(marked, np.int64)
            ids, lengths = self._gather(table[:, 1:].ravel())
            self._store(table[:, 0], ids, lengths.reshape(-1, 2).sum(axis=1))
        fresh.clear()

    def _chunk(self, split: list[list[str]]) -> list[bytes]:
        if len(self.numbers) > self.WORDS:
            self._turn()
        counts = np.fromiter(map(len, split), np.int64, len(split))
        numbers = np.fromiter(map(self.numbers.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        self._learn()
        ids, lengths = self._gather(numbers)
        at = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])] * 4
        flat = ids.tobytes()
        return [flat[a:b] for a, b in pairwise(at.tolist())]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        waiting: list[list[str]] = []
        whole, n = [], 0
        for i, t in enumerate(texts):
            if self.odd(t):
                whole.append(i)
                waiting.append([])
                continue
            waiting.append(unicodedata.normalize("NFC", t).lower().split())
            n += len(waiting[-1])
            if n >= self.CHUNK:
                out += self._chunk(waiting)
                waiting, n = [], 0
        out += self._chunk(waiting)
        for i, e in zip(whole, self.tokenizer.encode_batch([texts[i] for i in whole], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, "<u4").tobytes()
        return out


@lru_cache(maxsize=2)
def tokens_of(path: str) -> Tokens:
    """One tokenizer and cache for all tasks that a Python worker runs."""
    return Tokens(path)


def cut(doc_id: int, ids: bytes, window: int) -> Iterator[tuple]:
    n = len(ids) // 4
    for s in range(0, n, window):
        part = ids[4 * s : 4 * (s + window)]
        yield doc_id, s, len(part) // 4, zlib.crc32(part), n


def pieces(docs: DataFrame, vocabulary: str, end_id: int = 2, window: int = WINDOW) -> DataFrame:
    """Per document its full windows and its rest: lengths and checksums, no ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tokens = tokens_of(vocabulary)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            gc.disable()  # encoding makes no cycles, and collections would walk every word
            try:
                ids = tokens.encode([t or "" for t in batch.column("text").to_pylist()])
                out = [row for d, x in zip(batch.column("doc_id").to_pylist(), ids, strict=True) for row in cut(d, x + end, window)]
            finally:
                gc.enable()
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [()] * 5)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECES)


class Rooms:
    """Segment tree over remaining capacities 0..window: counts of open windows, and the tightest one that fits."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.count = [0] * (2 * self.size)
        self.open: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, room: int, by: int) -> None:
        i, count = room + self.size, self.count
        while i:
            count[i] += by
            i >>= 1

    def put(self, room: int, bin_: int) -> None:
        self.open[room].append(bin_)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """The bin with the least room >= least, removed; None if none has it."""
        i, count = least + self.size, self.count
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.size
        self._add(room, -1)
        return room, self.open[room].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length (each at most window), for lengths in any order; ties keep their order."""
    bins, offsets, rooms, made = [0] * len(lengths), [0] * len(lengths), Rooms(window), 0
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        room, b = rooms.take(lengths[i]) or (window, made)
        made += b == made
        bins[i], offsets[i] = b, window - room
        if room > lengths[i]:
            rooms.put(room - lengths[i], b)
    return bins, offsets


def pack(docs: DataFrame, vocabulary: str, end_id: int = 2, window: int = WINDOW, shard_rests: int = SHARD_RESTS) -> DataFrame:
    """Every id of every document in one piece of one sequence of at most window ids."""
    spark = docs.sparkSession
    prepare_python(spark)
    work = Workspace(spark, "packing")
    cuts = work.save(pieces(docs, vocabulary, end_id, window).withColumn("n", F.monotonically_increasing_id()), "pieces")
    full = F.col("length") == window
    shards = max(1, -(-cuts.filter(~full).count() // shard_rests))

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("n", "ascending")])
        bins, offsets = best_fit_decreasing(table.column("length").to_pylist(), window)
        shard = table.column("shard")[0].as_py()
        placed = {"sequence_id": pa.array([(b * shards + shard) * 2 + 1 for b in bins], pa.int64()), "offset": pa.array(offsets, pa.int64())}
        return pa.table({n: placed[n] if n in placed else table.column(n) for n in names})

    names = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
    schema = ", ".join(f"{n} long" for n in names)
    rests = cuts.filter(~full).withColumn("shard", F.pmod(F.xxhash64("n"), F.lit(shards))).groupBy("shard").applyInArrow(run, schema)
    whole = cuts.filter(full).select(*names[:5], (F.col("n") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(rests)


def padding(packed: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row: ids, sequences and padding ids (none at a fill that is a power of two)."""
    fill = packed.groupBy("sequence_id").agg(F.sum("length").alias("f"))
    pad: Callable = lambda f: F.when(f.bitwiseAND(f - 1) == 0, 0).otherwise(window - f)
    return fill.agg(F.sum("f").alias("n_ids"), F.count("*").alias("n_sequences"), F.coalesce(F.sum(pad(F.col("f"))), F.lit(0)).alias("n_padding"))
