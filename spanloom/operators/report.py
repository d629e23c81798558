"""Reports over cases as one long table of counts.

A case: case_id, decision, confirmed, audit, old and new (arrays of spans, new null while nothing was compared), diff (the
struct of match.compare), calls (array<struct<raw,cost,elapsed>> of the judge) and parse_calls (the same of the parser).
Each case is turned into its contributions inside the row, so that a report is one shuffle of counts with a key each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import prf, ratio, wilson
from ..schema import LEVELS

JUDGED = ("model_better", "deepseek_better", "tie", "inconclusive")
PART = "array<struct<section:string,key:string,k:long,n:long,m:long,usd:double>>"


def _part(section: str, key, k, n=None, m=None, usd=None) -> Column:
    at = lambda x, kind: (x if isinstance(x, Column) else F.lit(x)).cast(kind)
    return F.struct(F.lit(section).alias("section"), at(key, "string").alias("key"), at(k, "long").alias("k"), at(n, "long").alias("n"), at(m, "long").alias("m"), at(usd, "double").alias("usd"))


def _only(when: Column, *parts: Column) -> Column:
    return F.when(F.coalesce(when, F.lit(False)), F.array(*parts).cast(PART)).otherwise(F.array().cast(PART))


def _each(items: Column, part) -> Column:
    return F.coalesce(F.transform(items, part).cast(PART), F.array().cast(PART))


def _true(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("long")


def contributions() -> Column:
    """What one case adds to each line of the report. k of n, or true positives of n predicted and m expected."""
    c = F.col
    judged, compared = c("decision").isin(*JUDGED), c("new").isNotNull() & c("diff").isNotNull()
    better, sound = c("decision") == "deepseek_better", c("decision") == "model_better"
    evaluable = judged | (c("decision") == "agree")
    at = lambda side, level: F.size(F.filter(side, lambda s: s["level"] == level))
    equal = F.filter(c("diff.items"), lambda i: i["kind"] == "COR")
    hits = lambda level: F.size(F.filter(equal, lambda i: i["old"]["level"] == level))
    longer = F.when(better, F.size("new") > F.size("old")).otherwise(F.size("old") > F.size("new"))
    named = F.filter(c("calls"), lambda x: x["raw"].isin("1", "2"))
    spent = lambda calls: F.aggregate(calls, F.lit(0.0), lambda a, x: a + F.coalesce(x["cost"], F.lit(0.0)))
    count = lambda arr: F.coalesce(F.size(arr), F.lit(0))
    return F.concat(
        F.array(_part("decision", F.coalesce(c("decision"), F.lit("open")), 1), _part("audit", "flagged", _true(c("audit")), 1)).cast(PART),
        _only(compared, _part("agreement", "identical", _true(c("diff.identical")), 1), _part("spans", "all", c("diff.counts.COR"), c("diff.n_old"), c("diff.n_new"))),
        _only(compared, *(_part("spans", level, hits(level), at("old", level), at("new", level)) for level in LEVELS)),
        _only(judged, _part("judge", "flip_rate", _true(c("decision") == "inconclusive"), 1), _part("judge", "tie_rate", _true(c("decision") == "tie"), 1), _part("judge", "first_slot_win_rate", F.size(F.filter(named, lambda x: x["raw"] == "1")), F.size(named))),
        _only((better | sound) & (F.size("old") != F.size("new")), _part("judge", "winner_has_more_spans_rate", _true(longer), 1)),
        _only(evaluable, _part("quality", "deepseek_better", _true(better), 1), _part("quality", "confirmed_error", _true(better & c("confirmed")), 1)),
        _only(evaluable, *(_part("level_rate", level, _true(better & F.array_contains("diff.levels_involved", level)), 1) for level in LEVELS)),
        _each(F.when(better, F.filter("diff.items", lambda i: i["kind"] != "COR")), lambda i: _part("error_kind", i["kind"], 1)),
        _only(F.lit(True), _part("cost", "judge", F.when(judged, count("calls")).otherwise(0), usd=F.when(judged, spent(c("calls"))).otherwise(0.0)), _part("cost", "deepseek", count("parse_calls"), usd=spent(c("parse_calls")))),
    )


def run_metrics(cases: DataFrame) -> DataFrame:
    """(section, key, k, n, m, usd, rate, ci_low, ci_high, precision, recall, f1): a rate of k in n with its interval, or for
    the section `spans` precision, recall and F1. Levels that no side has and rates of nothing are left out."""
    rows = cases.select(F.explode(contributions()).alias("p")).select("p.*")
    g = rows.groupBy("section", "key").agg(*(F.sum(x).alias(x) for x in ("k", "n", "m")), F.round(F.sum("usd"), 8).alias("usd"))
    g = g.filter(((F.col("section") != "spans") | (F.col("key") == "all") | (F.col("n") + F.col("m") > 0)) & ((F.col("section") != "level_rate") | (F.col("k") > 0)))
    spans = F.col("section") == "spans"
    lo, hi = wilson(F.col("k"), F.col("n"))
    p, r, f = prf(F.col("k"), F.col("n"), F.col("m"))
    rated, scored = lambda x: F.when(~spans, x), lambda x: F.when(spans, x)
    return g.select("section", "key", "k", "n", "m", "usd", rated(ratio(F.col("k"), F.col("n"))).alias("rate"), rated(lo).alias("ci_low"), rated(hi).alias("ci_high"), scored(p).alias("precision"), scored(r).alias("recall"), scored(f).alias("f1"))


def quality_of(metrics: DataFrame) -> DataFrame:
    """One row (quality, by_level) as decisions.verified_recommendation takes them: the report has 7 levels at most."""
    facts = F.struct("k", "n", "rate", "ci_low")
    whole = F.max(F.when((F.col("section") == "quality") & (F.col("key") == "confirmed_error"), facts)).alias("quality")
    level = F.struct("k", "n", "rate", "ci_low", F.col("key").alias("level"))
    return metrics.agg(whole, F.array_sort(F.collect_list(F.when(F.col("section") == "level_rate", level))).alias("by_level"))


def confusion(cases: DataFrame, pred: str, truth: str) -> DataFrame:
    """Counts of pairs of verdicts; cases that lack one are left out."""
    return cases.filter(F.col(pred).isNotNull() & F.col(truth).isNotNull()).groupBy(pred, truth).agg(F.count("*").alias("n"))


def estimate(n: Column, parse_usd: float, judge_usd: float) -> Column:
    """struct<parse_usd,judge_max_usd,total_max_usd>: every case parsed once and judged in both orders."""
    a, b = n * F.lit(parse_usd), n * F.lit(2.0 * judge_usd)
    return F.struct(F.round(a, 4).alias("parse_usd"), F.round(b, 4).alias("judge_max_usd"), F.round(a + b, 4).alias("total_max_usd"))


def preview(cases: DataFrame, skipped: int, parse_usd: float, judge_usd: float, budget: float) -> DataFrame:
    """One row about cases(case_id, text, spans, ok) before a run: how many, skipped, estimate, with a hard violation, and the
    first five by id."""
    n = cases.agg(F.count("*").alias("n_cases"), F.count_if(~F.col("ok")).alias("n_hard"))
    first = cases.select("case_id", "text", "spans").orderBy("case_id").limit(5).agg(F.array_sort(F.collect_list(F.struct("case_id", "text", "spans"))).alias("sample"))
    return n.crossJoin(first).select("n_cases", F.lit(skipped).alias("skipped"), estimate(F.col("n_cases"), parse_usd, judge_usd).alias("estimate"), F.lit(budget).alias("budget_usd"), "n_hard", "sample")  # one row each


def progress(messages: DataFrame, cases: DataFrame) -> DataFrame:
    """(run_id, what, name, n): cases by stage, messages in work and failed by topic."""
    stages = cases.groupBy("run_id", F.col("stage").alias("name")).agg(F.count("*").alias("n")).withColumn("what", F.lit("stage"))
    busy = messages.filter(F.col("status").isin("processing", "failed")).groupBy("run_id", F.col("status").alias("what"), F.col("topic").alias("name")).agg(F.count("*").alias("n"))
    return stages.select("run_id", "what", "name", "n").unionByName(busy)


def billed(attempts: DataFrame, price: Column, peak: Column) -> DataFrame:
    """One row of totals over attempts(hit, miss, out, reasoning): those without `out` were never billed; peak ones cost
    double. price: struct<miss,hit,out> for a million tokens."""
    a = attempts.filter(F.col("out").isNotNull()).select("*", peak.alias("_peak"), price.alias("_p"))
    part = lambda x: F.coalesce(F.col(x), F.lit(0))
    usd = F.when(F.col("_peak"), 2.0).otherwise(1.0) * (part("miss") * F.col("_p.miss") + part("hit") * F.col("_p.hit") + part("out") * F.col("_p.out")) / 1e6
    total = lambda x: F.coalesce(F.sum(part(x)), F.lit(0)).cast("long").alias(f"{x}_tokens")
    return a.agg(F.coalesce(F.sum(usd), F.lit(0.0)).alias("total_usd"), F.count("*").alias("billed_calls"), F.count_if("_peak").alias("peak_calls"), *map(total, ("hit", "miss", "out", "reasoning")))


def usd(x: Column) -> Column:
    return F.when(x.isNull(), "-").otherwise(F.concat(F.lit("$"), F.format_number(x, 4)))


def percent(x: Column) -> Column:
    return F.when(x.isNull(), "-").otherwise(F.concat(F.format_number(100 * x, 1), F.lit("%")))


def interval(lo: Column, hi: Column) -> Column:
    return F.when(lo.isNull() | hi.isNull(), "").otherwise(F.concat(F.lit("["), percent(lo), F.lit(", "), percent(hi), F.lit("]")))
