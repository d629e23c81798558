"""Rates, intervals, agreement, order statistics and costs as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Z = 1.96


def ratio(k: Column, n: Column) -> Column:
    return F.try_divide(k.cast("double"), n.cast("double"))


def round_scaled(x: Column, digits: int) -> Column:
    """Rounded as SQL engines round doubles: scaled by a power of ten, halves away from zero, scaled back. F.round goes by
    the shortest decimal instead: 201 / 400 gives 0.503 there and 0.502 here, as 0.5025 * 1000 falls short of the half."""
    scale = F.lit(float(10**digits))
    return F.round(x * scale) / scale


def wilson(k: Column, n: Column, z: float = Z) -> tuple[Column, Column]:
    """Bounds of the score interval, null for n = 0."""
    n_, p, zz = n.cast("double"), ratio(k, n), F.lit(z * z)
    mid = (p + F.try_divide(zz, 2 * n_)) / (1 + F.try_divide(zz, n_))
    half = F.lit(z) * F.sqrt(F.try_divide(p * (1 - p), n_) + F.try_divide(zz, 4 * n_ * n_)) / (1 + F.try_divide(zz, n_))
    some = n_ > 0
    return F.when(some, F.greatest(F.lit(0.0), mid - half)), F.when(some, F.least(F.lit(1.0), mid + half))


def rate(k: Column, n: Column) -> Column:
    lo, hi = wilson(k, n)
    return F.struct(k.cast("long").alias("k"), n.cast("long").alias("n"), ratio(k, n).alias("rate"), lo.alias("ci_low"), hi.alias("ci_high"))


def prf(tp: Column, n_pred: Column, n_ref: Column, empty: float | None = None) -> tuple[Column, Column, Column]:
    """Precision, recall, F1. empty None: null where a denominator is 0; empty 0.0: zero instead."""
    p, r = ratio(tp, n_pred), ratio(tp, n_ref)
    f = F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / F.nullif(p + r, F.lit(0.0)))
    return tuple(x if empty is None else F.coalesce(x, F.lit(empty)) for x in (p, r, f))


def multiset_f1(tp: Column, n_a: Column, n_b: Column) -> Column:
    return F.when(n_a + n_b == 0, F.lit(1.0)).otherwise(2.0 * tp / F.nullif(n_a + n_b, F.lit(0)))


def upper_median(values: Column) -> Column:
    """v[n // 2] of the sorted values."""
    return F.get(F.array_sort(values), F.floor(F.size(values) / 2).cast("int"))


def nearest_p95(values: Column) -> Column:
    """v[round(.95(n-1))], halves to even."""
    n = F.size(values)
    return F.get(F.array_sort(values), F.least(n - 1, F.bround(F.lit(0.95) * (n - 1), 0).cast("int")))


def is_peak(ts: Column) -> Column:
    """Working days from 1 to 4 and from 6 to 10 o'clock."""
    h = F.hour(ts)
    return (F.weekday(ts) < 5) & (((h >= 1) & (h < 4)) | ((h >= 6) & (h < 10)))


def token_cost(prompt: Column, hit: Column, miss: Column, out: Column, price: Column, factor: Column) -> Column:
    """price: struct<miss,hit,out> per million tokens; a null miss is what the prompt has beyond hits."""
    m = F.coalesce(miss, prompt - F.coalesce(hit, F.lit(0)))
    return factor * (m * price["miss"] + F.coalesce(hit, F.lit(0)) * price["hit"] + F.coalesce(out, F.lit(0)) * price["out"]) / F.lit(1e6)


def overlap(a: Column, b: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a["end"], b["end"]) - F.greatest(a["start"], b["start"]))


def overlaps(a: Column, b: Column) -> Column:
    return (a["start"] < b["end"]) & (a["end"] > b["start"])


def softmax(z: Column) -> Column:
    top = F.array_max(z)
    e = F.transform(z, lambda x: F.exp(x - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, x: a + x)
    return F.transform(e, lambda x: x / total)
