"""Quality classifier: hashed word and character n-gram vectors, averaged per document, softmax on top.

Training is numpy stochastic gradient descent in one task over a bounded sample of labelled rows (SAMPLE rows, drawn by
a hash of the id). Features of a text are its words, pairs of neighbouring words, and character n-grams of a word with
its borders. Because the output is linear in the averaged vector, the trained table folds into one number per bucket:
scoring a text is a gather and a mean over all its features, with the folded table (4 bytes a bucket, a fixed size) sent
to the executors. A text's features and sums are its own, so its score does not depend on the rows around it.

Labels are learnt only from rows outside the held-out fold crc32(doc_id) mod 5 = 0. Text is the only input of a score.

Defined results: a null or empty text scores what the bias says; repeated rows score equal; a null doc_id has no fold
and counts as held out; without both labels in the sample every score is the share of ones (0.5 if none); an
empty table gives no rows; extra columns are ignored; a text of any length is scored whole. Several labels of one id
count by their largest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare_python
from .hashing import chunks, joined, mix, range_hashes, word_spans

#: Labelled rows that training reads at most (in expectation): a parameter, not a function of the corpus.
SAMPLE = 4000
#: Buckets of words and their pairs, then of character n-grams.
HASHED = 1 << 16
#: Pairs of a word with the one 1, 2 or 3 before it have a bucket for whether they are equal, besides: hashed pairs tell
#: repeats only of words that the sample has seen repeated (without it, 332 of 395 low texts held out of check_s are found).
BACK = (1, 2, 3)
BUCKETS = 3 * HASHED + 2 * len(BACK)
CHARS = (3, 4)
WIDTH = 10
EPOCHS = 6
RATE = 0.6
CUT = 0.3
FOLDS = 5


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(True))


def _bucket(h: np.ndarray, group: int) -> np.ndarray:
    return (mix(h) >> np.uint64(64 - 16)).astype(np.int64) + group * HASHED


def features(texts: list) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets of all words, word pairs and character n-grams, each with where every text's begin."""
    buf, at = joined(texts)
    starts, ends = word_spans(buf)
    hashes = range_hashes(buf, starts, ends) if len(starts) else np.zeros(0, np.uint64)
    begin = np.searchsorted(starts, at[:-1])
    text = np.repeat(np.arange(len(texts)), np.diff(np.append(begin, len(starts))))
    out = [(_bucket(hashes, 0), begin)]
    same = np.flatnonzero(text[1:] == text[:-1])
    with np.errstate(over="ignore"):
        pairs = hashes[same] * np.uint64(0x9E3779B97F4A7C15) + hashes[same + 1]
    out.append((_bucket(pairs, 1), np.searchsorted(same, begin)))
    # Characters, all white space as one sign: an n-gram may begin or end with it, a word's border, but not hold it inside.
    chars = np.frombuffer("\n".join(["", *(t or "" for t in texts), ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    white = (chars == 32) | ((chars >= 9) & (chars <= 13))
    chars = np.where(white, 32, chars).astype(np.uint64)
    where = np.concatenate(([0], np.cumsum([len(t or "") + 1 for t in texts])))
    for n in CHARS:
        count = max(len(chars) - n + 1, 0)
        inner = np.zeros(count, bool)
        h = np.zeros(count, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(n):
                h = h * np.uint64(0x100000001B3) + chars[k : k + count]
                if 0 < k < n - 1:
                    inner |= white[k : k + count]
        # The line feed before a text is the border of its first word; none of its n-grams passes the one after it.
        ok = np.flatnonzero(~inner)
        out.append((_bucket(h[ok], 2), np.searchsorted(ok, where[:-1])))
    echoes = np.empty((len(hashes), len(BACK)), np.int64)
    for j, k in enumerate(BACK):
        same = np.zeros(len(hashes), np.int64)
        same[k:] = (hashes[k:] == hashes[:-k]) & (text[k:] == text[:-k])
        echoes[:, j] = 3 * HASHED + 2 * j + same
    return [*out, (echoes.ravel(), begin * len(BACK))]


def means(values: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Mean of values[begin[i]:begin[i+1]] each, 0 where empty, summed range by range."""
    end = np.append(begin[1:], len(values))
    out, some = np.zeros(len(begin)), np.flatnonzero(end > begin)
    if len(some):
        out[some] = np.add.reduceat(values.astype(np.float64), begin[some]) / (end - begin)[some]
    return out


def bags(texts: list) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's distinct buckets and their weights: each group of features weighs the same."""
    groups, out = features(texts), []
    for i in range(len(texts)):
        parts = [x[b[i] : b[i + 1] if i + 1 < len(b) else len(x)] for x, b in groups]
        each = np.repeat([1 / max(len(p), 1) / len(groups) for p in parts], [len(p) for p in parts])
        ids, where = np.unique(np.concatenate(parts), return_inverse=True)
        out.append((ids.astype(np.int32), np.bincount(where, each, len(ids)).astype(np.float32)))
    return out


def train(texts: list, labels: list[int], seed: int = 7) -> tuple[np.ndarray, float]:
    """The folded table (one number per bucket) and the bias of the log odds of label 1."""
    y = np.asarray(labels, np.int64)
    ones = float(y.mean()) if len(y) else 0.5
    if not 0 < ones < 1:
        return np.zeros(BUCKETS, np.float32), float(np.clip(np.log((ones + 1e-6) / (1 - ones + 1e-6)), -9, 9))
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS, WIDTH), np.float32) - 0.5) / WIDTH).astype(np.float32)
    out = np.zeros((WIDTH, 2), np.float32)
    bias = np.log(np.array([1 - ones, ones], np.float32))
    data = [bag for i, j in chunks(texts) for bag in bags(texts[i:j])]
    steps, t = EPOCHS * len(data), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(data)):
            ids, weight = data[i]
            rate = RATE * (1 - t / steps)
            t += 1
            rows = vectors[ids]
            mean = weight @ rows
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out @ p
            out -= rate * np.outer(mean, p)
            bias -= 0.05 * rate * p
            # Weights of a bag sum to about 1 over many buckets; the step is scaled so that each bucket moves visibly.
            vectors[ids] = rows - (rate * 20 * np.sqrt(weight))[:, None] * back
    return ((vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0]))


def labelled(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(text, y) of about sample labelled rows outside the held-out fold, drawn by a hash of the id."""
    known = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("y"))
    n = known.count()
    part = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(1_000_000)) < min(1_000_000, max(1, sample * 1_000_000 // max(n, 1)))
    # At most about `sample` ids by construction, hence the broadcast.
    return docs.select("doc_id", "text").join(F.broadcast(known.filter(part)), "doc_id").select("text", "y")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        texts, y = [], []
        for pdf in batches:
            texts += [t if isinstance(t, str) else "" for t in pdf["text"]]
            y += pdf["y"].tolist()
        order = np.lexsort((y, texts)) if texts else []
        table, bias = train([texts[i] for i in order], [y[i] for i in order])
        yield pd.DataFrame({"folded": [table.tobytes()], "bias": [bias]})

    prepare_python(docs.sparkSession)
    row = labelled(docs, labels, sample).repartition(1).mapInPandas(run, "folded binary, bias double").first()
    if row is None:  # nothing labelled: no partition, so no task to train in
        return train([], [])
    return np.frombuffer(bytes(row["folded"]), np.float32), row["bias"]


def score_texts(texts: list, table: np.ndarray, bias: float) -> np.ndarray:
    groups = features(texts)
    z = sum(means(table[x], b) for x, b in groups) / len(groups) + bias
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def score(docs: DataFrame, table: np.ndarray, bias: float) -> DataFrame:
    prepare_python(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            s = [score_texts(texts[i:j], table, bias) for i, j in chunks(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(np.concatenate(s) if s else [], pa.float64())], names=["doc_id", "held_out", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))
