"""From scores of tags to spans: best allowed path, word tokens, truncated ends, cuts; folds inside the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.stats import softmax
from ..schema import LEVELS, SPAN
from .spans import indexes, let, span

LABELS = ("O", *(f"{p}-{level}" for level in LEVELS for p in "BI"))
FORBIDDEN = -1e9
#: What a word token is, in the tagger's training and here.
WORD = r"[^\s,\.;:()]+|[,\.;:()]"


def _doubles(values) -> Column:
    return F.array(*(F.lit(float(v)) for v in values))


def viterbi(logp: Column, labels: tuple[str, ...] = LABELS) -> Column:
    """The likeliest tags for array<array<double>> (tokens x labels) where an I- tag follows its own B- or I-; of equal ones
    the first label wins. No tokens give no tags."""
    ok = lambda a, b: not b.startswith("I-") or a in (f"B-{b[2:]}", b)
    into = F.array(*(_doubles(0.0 if ok(a, b) else FORBIDDEN for a in labels) for b in labels))
    start = _doubles(FORBIDDEN if b.startswith("I-") else 0.0 for b in labels)
    add = lambda x, y: F.zip_with(x, y, lambda a, b: a + b)
    best = lambda x: (F.array_position(x, F.array_max(x)) - 1).cast("int")
    zero = F.struct(add(F.get(logp, F.lit(0)), start).alias("score"), F.array().cast("array<array<int>>").alias("back"))

    def step(a: Column, row: Column) -> Column:
        reach = F.transform(into, lambda allowed: add(a["score"], allowed))
        return let(reach, lambda r: F.struct(F.zip_with(F.transform(r, lambda x: F.array_max(x)), row, lambda x, y: x + y).alias("score"), F.concat(a["back"], F.array(F.transform(r, best))).alias("back")))

    def path(a: Column) -> Column:
        last = F.array(best(a["score"]))
        return F.reverse(F.aggregate(F.reverse(a["back"]), last, lambda p, b: F.concat(p, F.array(F.get(b, F.element_at(p, -1))))))

    ids = F.aggregate(F.slice(logp, F.lit(2), F.greatest(F.size(logp) - 1, F.lit(0))), zero, step, path)
    names = F.array(*map(F.lit, labels))
    return F.when(F.size(logp) == 0, F.array().cast("array<string>")).otherwise(F.transform(ids, lambda i: F.get(names, i)))


def chosen_probability(logits: Column, label: Column) -> Column:
    """Softmax probability of the label with that index."""
    return F.get(softmax(logits), label)


def word_tokens(text: Column) -> Column:
    """Words and the marks , . ; : ( ) one by one."""
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def tagged_spans(text: Column, offsets: Column, tags: Column, cut: Column, threshold: float = 0.5) -> Column:
    """Spans of B- and I- tags over <start,end> offsets. The last one is truncated if it touches the text's end and its last
    token's probability `cut` lies above the threshold. Tags are such that an I- never stands alone."""
    opens = F.filter(indexes(tags), lambda i: F.get(tags, i).startswith("B-"))
    last = lambda i: F.coalesce(F.get(F.filter(indexes(tags), lambda j: (j > i) & ~F.get(tags, j).startswith("I-")), F.lit(0)), F.size(tags)) - 1
    runs = F.transform(opens, lambda i: F.struct(i.alias("first"), last(i).alias("last")))
    edge = F.length(F.rtrim(F.regexp_replace(text, r"(?U)\s+\z", "")))

    def build(r: Column, k: Column, n: Column) -> Column:
        a, b = F.get(offsets, r["first"])["start"], F.get(offsets, r["last"])["end"]
        truncated = (k == n - 1) & (b == edge) & F.coalesce(F.get(cut, r["last"]) > threshold, F.lit(False))
        return span(a, b, F.substring(F.get(tags, r["first"]), 3, 9), F.substring(text, a + 1, b - a), truncated)

    return let(runs, lambda all_: F.transform(all_, lambda r, k: build(r, k, F.size(all_)))).cast(f"array<{SPAN}>")


def covered(text: Column, spans: Column, level: str) -> Column:
    """Sorted positions of letters and digits that spans of a level cover."""
    at = F.flatten(F.transform(F.filter(spans, lambda s: (s["level"] == level) & (s["end"] > s["start"])), lambda s: F.sequence(s["start"], s["end"] - 1)))
    return F.array_sort(F.array_distinct(F.filter(at, lambda i: F.substring(text, i + 1, F.lit(1)).rlike(r"[\p{L}\p{N}]"))))


def weighted_cut(cuts: Column, u: Column) -> Column:
    """One of the cuts by its weight exp(-cut/16) + .02 and a number in [0, 1); null if there is none."""
    weigh = lambda c: F.exp(-c / F.lit(16.0)) + F.lit(0.02)
    total = F.aggregate(cuts, F.lit(0.0), lambda a, c: a + weigh(c))
    zero = F.struct(F.lit(0.0).alias("sum"), F.lit(None).cast("int").alias("cut"))

    def step(a: Column, c: Column) -> Column:
        upto = a["sum"] + weigh(c)
        return F.struct(upto.alias("sum"), F.coalesce(a["cut"], F.when(upto > u * total, c.cast("int"))).alias("cut"))

    return F.aggregate(cuts, zero, step, lambda a: F.coalesce(a["cut"], F.get(cuts, F.size(cuts) - 1).cast("int")))
