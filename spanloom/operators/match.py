"""Alignment of two labelings of a text, and multiset scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import overlap
from ..schema import ITEM, WEIGHTS
from .spans import let

WORD = "[ \\n\\t\\r]+"
PAIR = "array<struct<neg:int,o:int,n:int>>"


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), WORD, -1), lambda t: t != "")


def _digit(t: Column) -> Column:
    return F.substring(t, 1, 1).between("0", "9")


def _capital(t: Column) -> Column:
    return F.substring(t, 1, 1).between("A", "Z")


def _ends(t: Column, *marks: str) -> Column:
    return F.substring(t, -1, 1).isin(*marks)


def rule_a(t: Column) -> Column:
    return F.when(_digit(t), "L6").when(_capital(t), "L5").when(_ends(t, ",", ".", ";", ":"), "L4").otherwise("O")


def rule_b(t: Column) -> Column:
    return F.when(_digit(t), "L6").when(_capital(t) & (F.length(t) > 3), "L5").when(_ends(t, ",", ";", ":"), "L3").otherwise("O")


def rule_c(t: Column) -> Column:
    first = F.substring(t, 1, 1)
    return F.when(_digit(t), "L6").when((_capital(t) | first.isin(*"aeiou")) & (F.length(t) > 3), "L5").when(_ends(t, ",", ";", ":"), "L3").otherwise("O")


def runs_of(labels: Column) -> Column:
    """Maximal runs of equal labels but O: array<struct<start,end,level>> over token positions, end exclusive."""
    at = lambda i: F.coalesce(F.get(labels, i), F.lit("O"))
    some = F.when(F.size(labels) > 0, F.sequence(F.lit(0), F.size(labels) - 1)).otherwise(F.array().cast("array<int>"))
    first = F.filter(some, lambda i: (at(i) != "O") & (at(i) != at(i - 1)))
    last = F.filter(some, lambda i: (at(i) != "O") & (at(i) != at(i + 1)))
    return F.transform(F.arrays_zip(first.alias("f"), last.alias("l")), lambda p: F.struct(p["f"].alias("start"), (p["l"] + 1).alias("end"), F.get(labels, p["f"]).alias("level")))


def annotated(docs: DataFrame, **rules) -> DataFrame:
    """docs with, per rule, the spans it gives over the tokens of the whole text."""
    named = docs.withColumn("w", tokens(F.col("text")))
    return named.select(*docs.columns, *(let(F.transform("w", rule), runs_of).alias(k) for k, rule in rules.items()))


def greedy_pairs(old: Column, new: Column) -> Column:
    """Pairs <o,n> of indexes, largest overlap first, then by old and new index, each index once."""
    every = F.flatten(F.transform(old, lambda a, i: F.transform(F.filter(F.transform(new, lambda b, j: F.struct((-overlap(a, b)).cast("int").alias("neg"), i.alias("o"), j.alias("n"))), lambda p: p["neg"] < 0), lambda p: p)))
    free = lambda acc, p: ~F.exists(acc, lambda q: (q["o"] == p["o"]) | (q["n"] == p["n"]))
    return F.aggregate(F.array_sort(every), F.array().cast(PAIR), lambda acc, p: F.when(free(acc, p), F.concat(acc, F.array(p))).otherwise(acc))


def weight(level: Column) -> Column:
    table = F.create_map(*(F.lit(x) for kv in WEIGHTS.items() for x in kv))
    return F.coalesce(F.try_element_at(table, level), F.lit(1.0))


def diff_items(old: Column, new: Column) -> Column:
    """COR/INC for equal places (k-th to k-th), PAR by largest overlap, MIS and SPU for what is left; sorted by start.

    old and new are arrays of spans in natural order."""
    null = F.lit(None)
    nth = lambda x: F.transform(x, lambda s, i: F.struct(s.alias("s"), F.size(F.filter(F.slice(x, F.lit(1), i), lambda t: (t["start"] == s["start"]) & (t["end"] == s["end"]))).alias("k")))
    same = lambda a, b: (a["s"]["start"] == b["s"]["start"]) & (a["s"]["end"] == b["s"]["end"]) & (a["k"] == b["k"])
    item = lambda kind, o, n, match, sev: F.struct(F.lit(kind).alias("kind") if isinstance(kind, str) else kind.alias("kind"), o.alias("old"), n.alias("new"), match.alias("label_match"), sev.cast("double").alias("severity"))

    def build(x: Column) -> Column:
        o, n = x["o"], x["n"]
        exact = F.flatten(F.transform(o, lambda a: F.transform(F.filter(n, lambda b: same(a, b)), lambda b: item(F.when(a["s"]["level"] == b["s"]["level"], "COR").otherwise("INC"), a["s"], b["s"], a["s"]["level"] == b["s"]["level"], F.when(a["s"]["level"] == b["s"]["level"], 0.0).otherwise(F.greatest(weight(a["s"]["level"]), weight(b["s"]["level"])))))))
        ro = F.transform(F.filter(o, lambda a: ~F.exists(n, lambda b: same(a, b))), lambda a: a["s"])
        rn = F.transform(F.filter(n, lambda b: ~F.exists(o, lambda a: same(a, b))), lambda b: b["s"])
        return let(F.struct(exact.alias("exact"), ro.alias("o"), rn.alias("n"), greedy_pairs(ro, rn).alias("p")), rest)

    def rest(x: Column) -> Column:
        o, n, p = x["o"], x["n"], x["p"]
        part = F.transform(p, lambda q: let(F.struct(F.get(o, q["o"]).alias("a"), F.get(n, q["n"]).alias("b")), lambda y: item("PAR", y["a"], y["b"], y["a"]["level"] == y["b"]["level"], F.when(y["a"]["level"] == y["b"]["level"], weight(y["b"]["level"])).otherwise(F.greatest(weight(y["a"]["level"]), weight(y["b"]["level"]))))))
        spare = lambda s, side: F.filter(F.transform(s, lambda a, i: F.struct(a.alias("s"), i.alias("i"))), lambda a: ~F.exists(p, lambda q: q[side] == a["i"]))
        mis = F.transform(spare(n, "n"), lambda b: F.struct(F.lit("MIS").alias("kind"), null.alias("old"), b["s"].alias("new"), F.lit(False).alias("label_match"), weight(b["s"]["level"]).alias("severity")))
        spu = F.transform(spare(o, "o"), lambda a: F.struct(F.lit("SPU").alias("kind"), a["s"].alias("old"), null.alias("new"), F.lit(False).alias("label_match"), weight(a["s"]["level"]).alias("severity")))
        every = F.concat(x["exact"].cast(f"array<{ITEM}>"), part.cast(f"array<{ITEM}>"), mis.cast(f"array<{ITEM}>"), spu.cast(f"array<{ITEM}>"))
        order = F.array_sort(F.transform(every, lambda i, k: F.struct(F.coalesce(i["old"]["start"], i["new"]["start"]).alias("at"), k.alias("k"), i.alias("i"))))
        return F.transform(order, lambda z: z["i"])

    return let(F.struct(nth(old).alias("o"), nth(new).alias("n")), build)


KINDS = ("COR", "INC", "PAR", "MIS", "SPU", "TRUNC")


def compare(old: Column, new: Column, truncation: bool = False) -> Column:
    """The diff struct of two arrays of spans. With truncation, equal spans that differ in that flag are TRUNC of .1."""

    def flagged(i: Column) -> Column:
        off = (i["kind"] == "COR") & (i["old"]["truncated"] != i["new"]["truncated"])
        return F.when(off, i.withField("kind", F.lit("TRUNC")).withField("severity", F.lit(0.1))).otherwise(i)

    def of(items: Column) -> Column:
        sev = F.transform(items, lambda i: i["severity"])
        off = F.filter(items, lambda i: i["kind"] != "COR")
        levels = F.array_compact(F.flatten(F.transform(off, lambda i: F.array(i["old"]["level"], i["new"]["level"]))))
        count = lambda k: F.size(F.filter(items, lambda i: i["kind"] == k)).alias(k)
        return F.struct(
            (F.size(off) == 0).alias("identical"), items.alias("items"), F.struct(*map(count, KINDS)).alias("counts"), F.size(old).alias("n_old"), F.size(new).alias("n_new"),
            F.round(F.aggregate(sev, F.lit(0.0), lambda a, x: a + x), 4).alias("severity_total"), F.coalesce(F.array_max(sev), F.lit(0.0)).alias("severity_max"),
            F.array_sort(F.array_distinct(levels)).alias("levels_involved"), F.when((F.size(old) == 0) & (F.size(new) > 0), "old_empty").when((F.size(old) > 0) & (F.size(new) == 0), "new_empty").alias("abstain"),
        )

    found = diff_items(F.array_sort(old), F.array_sort(new))
    return let(F.transform(found, flagged) if truncation else found, of)


def multiset_scores(pred: DataFrame, gold: DataFrame, case: str, *key: str) -> DataFrame:
    """(case, tp, n_pred, n_gold, exact) of rows (case, key...) on two sides: multiset intersection by counts."""
    side = lambda d, p, g: d.select(case, *key, F.lit(p).alias("p"), F.lit(g).alias("g"))
    both = side(pred, 1, 0).unionByName(side(gold, 0, 1)).groupBy(case, *key).agg(F.sum("p").alias("p"), F.sum("g").alias("g"))
    return both.groupBy(case).agg(F.sum(F.least("p", "g")).alias("tp"), F.sum("p").alias("n_pred"), F.sum("g").alias("n_gold"), (F.sum(F.abs(F.col("p") - F.col("g"))) == 0).alias("exact"))
