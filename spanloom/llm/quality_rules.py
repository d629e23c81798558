"""Quality rules as a bitmask ledger.

`ledger` evaluates every rule once per document and stores the measurements and one failure bit per rule. A policy is a
versioned set of rules, that is a mask: applying it, or asking what a rule alone removes, is a bit operation over the
ledger and never touches a text again. All of it is DataFrame expressions; a document is one row, so no shuffle.

Defined results: a null or blank text has no words, all measures 0, and fails; repeated rows are judged each for itself;
an empty table gives an empty ledger; extra columns are ignored by the query and kept by `apply_policy`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, let, words

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL over the measures; null counts as passed


#: Bit i of fail_mask is rule i. New rules are appended, so that old ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_trigrams", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 40 * n_lines"),
    Rule("word_length_low", "10 * word_chars < 20 * n_words"),
    Rule("word_length_high", "word_chars > 20 * n_words"),
)
BASE = ("few_words", "repeated_trigrams")
#: Versions of the policy; a version never changes once it was used.
POLICIES = {
    "base": BASE,
    "v1": tuple(r.name for r in RULES),
}


def bit(name: str) -> int:
    return 1 << [r.name for r in RULES].index(name)


def mask_of(policy: str) -> int:
    return sum(bit(n) for n in POLICIES[policy])


def _repeat_words(found: Column) -> Column:
    """Words covered by three-word windows that occur twice or more: sort (window hash, position), keep equal
    neighbours, and add up the union of the intervals [p, p+3)."""

    def covered(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(let(F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), union)))

    def union(s: Column) -> Column:
        same = lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
        at = F.sort_array(F.transform(F.filter(s, same), lambda x: x["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last"))
        return F.aggregate(at, start, lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")), lambda a: a["n"])

    return F.when(F.size(found) < 4, F.lit(0)).otherwise(let(found, covered))


def measures(text: Column) -> dict[str, Column]:
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    two = let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d")))
    m = let(words(text), lambda w: F.struct(F.size(w).alias("n_words"), _repeat_words(w).alias("n_repeat_words")))
    return {
        "m": m,
        "word_chars": F.length(F.translate(whole, WHITE, "")).cast("long"),
        "n_symbols": (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long"),
        "lines": two,
    }


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: the key, the measures and fail_mask (long)."""
    raw = docs.select(F.col(key), *(c.alias(n) for n, c in measures(F.col(text)).items()))
    flat = raw.select(
        key,
        F.col("m.n_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.col("lines.n") - F.col("lines.d")).cast("long").alias("n_dup_lines"),
        F.col("m.n_repeat_words").cast("long").alias("n_repeat_words"),
        F.col("lines.n").cast("long").alias("n_lines"),
    )
    bits = [F.when(F.expr(r.fails), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, r in enumerate(RULES)]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return flat.withColumn("fail_mask", mask)


def apply_policy(led: DataFrame, policy: str = "v1") -> DataFrame:
    """Adds base_failed, kept and the policy's version to a ledger."""
    hit = lambda m: F.col("fail_mask").bitwiseAND(F.lit(m).cast("long")) != 0
    return led.withColumns({"base_failed": hit(mask_of("base")), "kept": ~hit(mask_of("base") | mask_of(policy)), "policy": F.lit(policy)})


def ablation(led: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of a policy: documents it fails, documents that it alone fails, and how many stay without it.

    The ledger shrinks to one row per distinct mask (at most 2^rules) before anything is compared."""
    total = mask_of(policy)
    counts = led.groupBy(F.col("fail_mask").bitwiseAND(F.lit(total).cast("long")).alias("mask")).agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(bit(n)).cast("long").alias("bit")) for n in POLICIES[policy]))
    each = counts.select("mask", "n", F.explode(rules).alias("r")).select("mask", "n", "r.*")
    has = F.col("mask").bitwiseAND(F.col("bit")) != 0
    rest = F.col("mask").bitwiseAND(F.bitwise_not(F.col("bit")))
    n_if = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return each.groupBy("rule").agg(n_if(has).alias("n_failed"), n_if(F.col("mask") == F.col("bit")).alias("n_only_this"), n_if(rest == 0).alias("n_kept_without"), n_if(F.col("mask") == 0).alias("n_kept"))


def keep(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The documents that pass the policy, all their columns: the pipeline's form, one narrow pass without a join."""
    led = ledger(docs.select(F.struct("*").alias("row")), key="row", text="row.text")
    return apply_policy(led, policy).filter("kept").select("row.*")
