"""Sampling, splitting and order statistics. Randomness is a SHA-256 of seed and key, equal in every engine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import unit


def order(seed: int, key: str):
    return F.sha2(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string")), 256)


def per_stratum(rows: DataFrame, stratum: str, key: str, n: int, seed: int) -> DataFrame:
    """n rows per stratum. The rank filter is pushed below the shuffle as a limit per task and stratum."""
    w = W.partitionBy(stratum).orderBy("_o")
    return rows.withColumn("_o", order(seed, key)).withColumn("_k", F.row_number().over(w)).filter(F.col("_k") <= n).drop("_o", "_k")


def split(rows: DataFrame, group: str, share: float, seed: int) -> DataFrame:
    """Adds split: test for that share of groups, else train."""
    return rows.withColumn("split", F.when(unit(F.lit(str(seed)), F.col(group).cast("string")) < share, "test").otherwise("train"))


def excluded(rows: DataFrame, seen: DataFrame, *keys: tuple[str, ...]) -> DataFrame:
    """rows without those that equal a seen row in all columns of any of the keys."""
    for key in keys:
        rows = rows.join(seen.select(*key).distinct(), list(key), "left_anti")
    return rows


def first_of(rows: DataFrame, key: str, by: str) -> DataFrame:
    """One row per key: the one with the least `by`."""
    best = rows.groupBy(key).agg(F.min_by(F.struct(*rows.columns), by).alias("_r"))
    return best.select("_r.*")


def order_statistics(rows: DataFrame, group: str, value: str) -> DataFrame:
    """n, mean, p50 (upper median), p95 (nearest rank, half to even), p99 (interpolated) and max of each group.

    Ranks come from counts per distinct value, so a group's values are summed before they meet in a task."""
    v = rows.filter(F.col(value).isNotNull()).groupBy(group, value).agg(F.count("*").alias("c"))
    w = W.partitionBy(group).orderBy(value).rowsBetween(W.unboundedPreceding, W.currentRow)
    r = v.withColumn("hi", F.sum("c").over(w)).withColumn("n", F.sum("c").over(W.partitionBy(group)))
    at = lambda rank: F.max(F.when((F.col("hi") > rank) & (F.col("hi") - F.col("c") <= rank), F.col(value)))
    n = F.col("n")
    p95 = F.least(n - 1, F.bround(F.lit(0.95) * (n - 1), 0).cast("long"))
    place = F.lit(0.99) * (n - 1)
    g = r.groupBy(group).agg(F.max("n").alias("n"), F.sum(F.col(value) * F.col("c")).alias("total"), at(F.floor(n / 2)).alias("p50"), at(p95).alias("p95"), at(F.floor(place)).alias("lo"), at(F.ceil(place)).alias("up"), F.max(value).alias("max"))
    part = F.lit(0.99) * (n - 1) - F.floor(F.lit(0.99) * (n - 1))
    return g.select(group, "n", F.round(F.col("total") / n, 2).alias("mean"), "p50", "p95", F.round(F.col("lo") + (F.col("up") - F.col("lo")) * part, 6).alias("p99"), "max")


def halves(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """2n rows drawn by hash, with part 0 for the first n and 1 for the others: disjoint by their ranks."""
    drawn = rows.withColumn("_o", order(seed, key)).orderBy("_o", key).limit(2 * n)
    return drawn.withColumn("part", (F.row_number().over(W.orderBy("_o", key)) > n).cast("int")).drop("_o")  # 2n rows


def split_held_out(rows: DataFrame, group: str, held_out, share: float, seed: int) -> DataFrame:
    """As split, but rows of the held-out pool are test whatever their group."""
    return split(rows, group, share, seed).withColumn("split", F.when(held_out, "test").otherwise(F.col("split")))


def unseen(generated: DataFrame, key: str, *pools: DataFrame) -> DataFrame:
    """Generated rows, one of each key, whose key is in no pool: training, gold, or what was seen before."""
    rows = generated.filter(F.col(key).isNotNull()).dropDuplicates([key])
    for pool in pools:
        rows = rows.join(pool.select(key).distinct(), key, "left_anti")
    return rows


def require_disjoint(rows: DataFrame, key: str, by: str) -> DataFrame:
    """rows as they are; a key under several values of `by` fails the query."""
    many = F.size(F.collect_set(by)) > 1
    ok = rows.groupBy(F.col(key).alias("_key")).agg(F.when(many, F.raise_error(F.concat(F.lit("in several parts: "), F.col("_key").cast("string")))).otherwise(F.lit(True)).alias("_ok"))
    return rows.join(ok, F.col(key).eqNullSafe(F.col("_key"))).filter("_ok").select(*rows.columns)
