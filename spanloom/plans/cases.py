"""Cases out of conversation turns and benchmark items, by the differences that match.compare finds: kinds, gate, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import decisions, match, report, spans
from ..schema import SPAN, WEIGHTS
from .labeling import SPANS_C, read, wilson_sql

THRESHOLD = 2.0


def _whole(x: Column) -> Column:
    return F.transform(x, lambda s: F.struct(s["start"], s["end"], s["level"], F.lit(None).cast("string").alias("text"), F.lit(False).alias("truncated"))).cast(f"array<{SPAN}>")


def _compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns with the spans of two labelers over their tokens and the difference between these."""
    t = match.annotated(read(spark, sf_dir, "conversations").select("role", "text"), a=match.rule_a, b=match.rule_c)
    t = t.select("role", _whole(F.col("a")).alias("old"), _whole(F.col("b")).alias("new"))
    return t.withColumn("diff", match.compare(F.col("old"), F.col("new")))


def _judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases with both calls of a rule judge: it names the side with more spans, slot 1 on a difference of one."""
    c = _compared(spark, sf_dir)
    gap = F.size("new") - F.size("old")
    slot = lambda order: F.when(F.abs(gap) == 1, "1").when(gap == 0, "tie").when((gap > 0) == F.lit(order == 1), "1").otherwise("2")
    call = lambda order: F.struct(slot(order).alias("raw"), F.lit(0.01).alias("cost"), F.lit(1.0).alias("elapsed"))
    winner = decisions.consensus(decisions.side_of(slot(0), F.lit(0)), decisions.side_of(slot(1), F.lit(1)))
    c = c.withColumn("decision", decisions.decision(F.col("diff.identical"), winner))
    calls = F.when(~F.col("diff.identical"), F.array(call(0), call(1)))
    c = c.withColumns({"calls": calls, "parse_calls": F.array(call(0)), "audit": F.col("role") == "system"})
    return c.withColumn("confirmed", decisions.confirmed(F.col("decision"), F.col("diff.severity_total"), F.lit(THRESHOLD)))


def span_diff_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of turns by kind: how many, of equal level, their severity."""
    i = _compared(spark, sf_dir).select(F.explode("diff.items").alias("i"))
    return i.groupBy("i.kind").agg(F.count("*").alias("n"), F.count_if("i.label_match").alias("n_same_level"), F.round(F.sum("i.severity"), 6).alias("severity"))


_WEIGHT = "CASE {x} " + " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in WEIGHTS.items()) + " ELSE 1.0::DOUBLE END"
_TURNS = SPANS_C.replace("WITH tok", "WITH documents AS (SELECT conv_id || ':' || turn AS doc_id, role AS lang, text FROM conversations), tok", 1) + f"""
, eq AS (SELECT doc_id, s, e, sa.level AS lo, sb.level AS ln FROM sa JOIN sb USING (doc_id, s, e)),
ra AS (SELECT sa.* FROM sa ANTI JOIN eq USING (doc_id, s, e)), rb AS (SELECT sb.* FROM sb ANTI JOIN eq USING (doc_id, s, e)),
p AS (SELECT ra.doc_id, ra.s AS o, rb.s AS n, least(ra.e, rb.e) - greatest(ra.s, rb.s) AS ov FROM ra JOIN rb ON ra.doc_id = rb.doc_id AND ra.s < rb.e AND ra.e > rb.s),
l AS (SELECT doc_id, list({{'o': o, 'n': n}} ORDER BY -ov, o, n) AS q FROM p GROUP BY doc_id),
g AS (SELECT doc_id, unnest(list_reduce(list_prepend([{{'o': -1, 'n': -1}}], list_transform(q, lambda y: [y])), lambda acc, y:
        CASE WHEN len(list_filter(acc, lambda z: z.o = y[1].o OR z.n = y[1].n)) > 0 THEN acc ELSE list_concat(acc, y) END)) AS y FROM l),
par AS (SELECT g.doc_id, y.o AS o, y.n AS n, ra.level AS lo, rb.level AS ln FROM g JOIN ra ON ra.doc_id = g.doc_id AND ra.s = y.o JOIN rb ON rb.doc_id = g.doc_id AND rb.s = y.n),
items AS (
  SELECT doc_id, CASE WHEN lo = ln THEN 'COR' ELSE 'INC' END AS kind, lo, ln, CASE WHEN lo = ln THEN 0.0::DOUBLE ELSE greatest({_WEIGHT.format(x="lo")}, {_WEIGHT.format(x="ln")}) END AS sev FROM eq
  UNION ALL SELECT doc_id, 'PAR', lo, ln, CASE WHEN lo = ln THEN {_WEIGHT.format(x="ln")} ELSE greatest({_WEIGHT.format(x="lo")}, {_WEIGHT.format(x="ln")}) END FROM par
  UNION ALL SELECT doc_id, 'MIS', NULL, level, {_WEIGHT.format(x="level")} FROM rb WHERE NOT EXISTS (SELECT 1 FROM par WHERE par.doc_id = rb.doc_id AND par.n = rb.s)
  UNION ALL SELECT doc_id, 'SPU', level, NULL, {_WEIGHT.format(x="level")} FROM ra WHERE NOT EXISTS (SELECT 1 FROM par WHERE par.doc_id = ra.doc_id AND par.o = ra.s)),
sev AS (SELECT doc_id, round(sum(sev), 4) AS total, count(*) FILTER (kind <> 'COR') AS off, count(*) FILTER (kind = 'COR') AS cor FROM items GROUP BY doc_id),
na AS (SELECT doc_id, count(*) AS na FROM sa GROUP BY doc_id), nb AS (SELECT doc_id, count(*) AS nb FROM sb GROUP BY doc_id),
c AS (SELECT d.doc_id, lang AS role, coalesce(total, 0) AS total, coalesce(off, 0) = 0 AS same, coalesce(cor, 0) AS cor, coalesce(na, 0) AS na, coalesce(nb, 0) AS nb
      FROM documents d LEFT JOIN sev USING (doc_id) LEFT JOIN na USING (doc_id) LEFT JOIN nb USING (doc_id)),
w AS (SELECT *, CASE WHEN same THEN 'agree' WHEN abs(nb - na) = 1 THEN 'inconclusive' WHEN nb = na THEN 'tie' WHEN nb > na THEN 'deepseek_better' ELSE 'model_better' END AS decision FROM c)
"""
_KINDS = _TURNS + "SELECT kind, count(*) AS n, count(*) FILTER (lo = ln) AS n_same_level, round(sum(sev), 6) AS severity FROM items GROUP BY kind"


def severity_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns by role and decision: how many, those confirmed by their whole severity, and its sum."""
    c = _judged(spark, sf_dir)
    return c.groupBy("role", "decision").agg(F.count("*").alias("n"), F.count_if("confirmed").alias("n_confirmed"), F.round(F.sum("diff.severity_total"), 4).alias("severity"))


_GATE = _TURNS + f"SELECT role, decision, count(*) AS n, count(*) FILTER (decision = 'deepseek_better' AND total >= {THRESHOLD}) AS n_confirmed, round(sum(total), 4) AS severity FROM w GROUP BY ALL"


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report of a run whose cases are the turns."""
    m = report.run_metrics(_judged(spark, sf_dir))
    return m.select("section", "key", "k", "n", "m", *(F.round(x, 6).alias(x) for x in ("usd", "rate", "ci_low", "ci_high", "precision", "recall", "f1")))


_LEVELS = "(SELECT 'L' || i AS v FROM range(1, 8) t(i))"
_REPORT = _TURNS + f"""
, lv AS (SELECT DISTINCT doc_id, v FROM (SELECT doc_id, lo AS v FROM items WHERE kind <> 'COR' UNION ALL SELECT doc_id, ln FROM items WHERE kind <> 'COR') WHERE v IS NOT NULL),
f AS (
  SELECT 'decision' AS section, decision AS key, count(*) AS k, NULL::BIGINT AS n, NULL::BIGINT AS m, NULL::DOUBLE AS usd FROM w GROUP BY decision
  UNION ALL SELECT 'audit', 'flagged', count(*) FILTER (role = 'system'), count(*), NULL, NULL FROM w
  UNION ALL SELECT 'agreement', 'identical', count(*) FILTER (same), count(*), NULL, NULL FROM w
  UNION ALL SELECT 'spans', 'all', sum(cor)::BIGINT, sum(na)::BIGINT, sum(nb)::BIGINT, NULL FROM w
  UNION ALL SELECT 'spans', v, (SELECT count(*) FROM items WHERE kind = 'COR' AND lo = v), (SELECT count(*) FROM sa WHERE level = v), (SELECT count(*) FROM sb WHERE level = v), NULL FROM {_LEVELS}
  UNION ALL SELECT 'judge', 'flip_rate', count(*) FILTER (decision = 'inconclusive'), count(*), NULL, NULL FROM w WHERE NOT same
  UNION ALL SELECT 'judge', 'tie_rate', count(*) FILTER (decision = 'tie'), count(*), NULL, NULL FROM w WHERE NOT same
  UNION ALL SELECT 'judge', 'first_slot_win_rate', sum(CASE WHEN abs(nb - na) = 1 THEN 2 WHEN nb = na THEN 0 ELSE 1 END)::BIGINT, sum(CASE WHEN nb = na THEN 0 ELSE 2 END)::BIGINT, NULL, NULL FROM w WHERE NOT same
  UNION ALL SELECT 'judge', 'winner_has_more_spans_rate', count(*), count(*), NULL, NULL FROM w WHERE decision IN ('deepseek_better', 'model_better') HAVING count(*) > 0
  UNION ALL SELECT 'quality', 'deepseek_better', count(*) FILTER (decision = 'deepseek_better'), count(*), NULL, NULL FROM w
  UNION ALL SELECT 'quality', 'confirmed_error', count(*) FILTER (decision = 'deepseek_better' AND total >= {THRESHOLD}), count(*), NULL, NULL FROM w
  UNION ALL SELECT 'level_rate', v, (SELECT count(*) FROM lv JOIN w USING (doc_id) WHERE decision = 'deepseek_better' AND lv.v = x.v), (SELECT count(*) FROM w), NULL, NULL FROM {_LEVELS} x
  UNION ALL SELECT 'error_kind', kind, count(*), NULL, NULL, NULL FROM items JOIN w USING (doc_id) WHERE kind <> 'COR' AND decision = 'deepseek_better' GROUP BY kind
  UNION ALL SELECT 'cost', 'judge', 2 * count(*) FILTER (NOT same), NULL, NULL, 0.02::DOUBLE * count(*) FILTER (NOT same) FROM w
  UNION ALL SELECT 'cost', 'deepseek', count(*), NULL, NULL, 0.01::DOUBLE * count(*) FROM w),
r AS (SELECT * FROM f WHERE NOT (section = 'spans' AND key <> 'all' AND n + m = 0) AND NOT (section = 'level_rate' AND k = 0)),
i AS (SELECT *, k::DOUBLE / nullif(n, 0) AS p_, k::DOUBLE / nullif(m, 0) AS r_ FROM r),
s AS (SELECT section, key, k, n, m, round(usd, 6) AS usd, round(p_, 6) AS rate, {wilson_sql("k", "n")} FROM i WHERE section <> 'spans' AND n IS NOT NULL
  UNION ALL SELECT section, key, k, n, m, round(usd, 6), NULL, NULL, NULL FROM i WHERE section <> 'spans' AND n IS NULL
  UNION ALL SELECT section, key, k, n, m, round(usd, 6), NULL, NULL, NULL FROM i WHERE section = 'spans')
SELECT s.*, CASE WHEN section = 'spans' THEN round(p_, 6) END AS precision, CASE WHEN section = 'spans' THEN round(r_, 6) END AS recall,
       CASE WHEN section = 'spans' THEN round(CASE WHEN p_ + r_ = 0 THEN 0.0::DOUBLE ELSE 2 * p_ * r_ / (p_ + r_) END, 6) END AS f1
FROM s JOIN i USING (section, key)
"""
_REPORT = _REPORT.replace("SELECT s.*,", "SELECT s.section, s.key, s.k, s.n, s.m, s.usd, s.rate, s.ci_low, s.ci_high,")


def tokens_bio_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items cut into tokens and tags at the spans of a labeler, and back: tokens, spans, whether these return."""
    b = read(spark, sf_dir, "benchmark").select("item_id", "text", match.tokens(F.col("text")).alias("w"))
    b = b.select("item_id", "text", spans.let(F.transform("w", match.rule_a), match.runs_of).alias("runs"), spans.locate_tokens(F.col("text"), F.col("w")).alias("at"))
    place = lambda r: spans.let(F.struct(F.get("at", r["start"])["start"].alias("a"), F.get("at", r["end"] - 1)["end"].alias("b")), lambda x: spans.span(x["a"], x["b"], r["level"], F.substring("text", x["a"] + 1, x["b"] - x["a"])))
    b = b.select("item_id", "text", F.transform("runs", place).alias("s"))
    tokens, bio = spans.tokens_and_bio(F.col("text"), F.col("s"))
    b = b.withColumns({"tokens": tokens, "bio": bio})
    back = spans.spans_from_bio(F.col("text"), F.col("tokens"), F.col("bio"))
    return b.select("item_id", F.size("tokens").cast("long").alias("n_tokens"), F.size("s").cast("long").alias("n_spans"), (back == F.col("s")).alias("same"))


_ROUND = SPANS_C.replace("WITH tok", "WITH documents AS (SELECT item_id AS doc_id, '' AS lang, text FROM benchmark), tok", 1) + """
SELECT doc_id AS item_id, len(regexp_extract_all(text, '[\\p{L}\\p{N}]+|[^\\p{L}\\p{N}\\s]'))::BIGINT AS n_tokens, (SELECT count(*) FROM sa WHERE sa.doc_id = documents.doc_id) AS n_spans, true AS same FROM documents
"""

QUERIES = {f.__name__: f for f in (span_diff_kinds, severity_gate, run_report, tokens_bio_roundtrip)}
ORACLES = dict(zip(QUERIES, (_KINDS, _GATE, _REPORT, _ROUND), strict=True))
