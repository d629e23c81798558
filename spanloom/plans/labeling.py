"""Queries over two rule labelings of the documents: spans, agreement, differences, decisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.stats import prf, ratio, round_scaled, wilson
from ..operators import decisions, match
from ..operators.spans import let

LEVELS = ("L3", "L4", "L5", "L6")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def both(spark: SparkSession, sf_dir: str, b=match.rule_b) -> DataFrame:
    return match.annotated(read(spark, sf_dir, "documents").select("doc_id", "lang", "text"), a=match.rule_a, b=b).drop("text")


def _plain(x: str):
    return F.transform(x, lambda s: F.struct(s["start"], s["end"]))


def span_agreement_prf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per level: equal spans, spans of either side, precision, recall, F1."""
    d = both(spark, sf_dir)
    tag = lambda x, k: F.transform(x, lambda s: F.struct(s["level"].alias("level"), F.lit(k).alias("k")))
    rows = d.select(F.explode(F.concat(tag(F.array_intersect("a", "b"), 0), tag(F.col("a"), 1), tag(F.col("b"), 2))).alias("r")).select("r.*")
    n = lambda k: F.sum(F.when(F.col("k") == k, 1).otherwise(0)).cast("long")
    g = rows.groupBy("level").agg(n(0).alias("tp"), n(1).alias("n_old"), n(2).alias("n_new"))
    p, r, f = prf(F.col("tp"), F.col("n_old"), F.col("n_new"))
    return g.select("level", "tp", "n_old", "n_new", F.round(p, 6).alias("p"), F.round(r, 6).alias("r"), F.round(f, 6).alias("f1"))


#: Tokens, labels and spans of the two labelings, as SQL.
SPANS = """
WITH tok AS (
  SELECT doc_id, lang, unnest(range(0, len(w))) AS i, unnest(w) AS t
  FROM (SELECT doc_id, lang, list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\n\\t\\r]+'), lambda x: x <> '') AS w FROM documents)),
lab AS (
  SELECT doc_id, lang, i,
    CASE WHEN regexp_matches(t, '^[0-9]') THEN 'L6' WHEN regexp_matches(t, '^[A-Z]') THEN 'L5' WHEN regexp_matches(t, '[,.;:]$') THEN 'L4' ELSE 'O' END AS la,
    CASE WHEN regexp_matches(t, '^[0-9]') THEN 'L6' WHEN regexp_matches(t, '^[{B}]') AND length(t) > 3 THEN 'L5' WHEN regexp_matches(t, '[,;:]$') THEN 'L3' ELSE 'O' END AS lb
  FROM tok),
prv AS (SELECT *, lag(la, 1, 'O') OVER o AS pa, lag(lb, 1, 'O') OVER o AS pb FROM lab WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
run AS (SELECT *, sum(CASE WHEN la <> pa THEN 1 ELSE 0 END) OVER o AS ra, sum(CASE WHEN lb <> pb THEN 1 ELSE 0 END) OVER o AS rb FROM prv WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
sa AS (SELECT doc_id, any_value(lang) AS lang, la AS level, min(i) AS s, max(i) + 1 AS e FROM run WHERE la <> 'O' GROUP BY doc_id, la, ra),
sb AS (SELECT doc_id, any_value(lang) AS lang, lb AS level, min(i) AS s, max(i) + 1 AS e FROM run WHERE lb <> 'O' GROUP BY doc_id, lb, rb)
"""
SPANS_B, SPANS_C = SPANS.replace("{B}", "A-Z"), SPANS.replace("{B}", "A-Zaeiou")

_PRF = SPANS_B + """
, c AS (
  SELECT level, count(*) AS tp, 0 AS o, 0 AS n FROM sa JOIN sb USING (doc_id, level, s, e) GROUP BY level
  UNION ALL SELECT level, 0, count(*), 0 FROM sa GROUP BY level UNION ALL SELECT level, 0, 0, count(*) FROM sb GROUP BY level),
g AS (SELECT level, sum(tp)::BIGINT AS tp, sum(o)::BIGINT AS n_old, sum(n)::BIGINT AS n_new FROM c GROUP BY level),
q AS (SELECT *, tp::DOUBLE / nullif(n_old, 0) AS pp, tp::DOUBLE / nullif(n_new, 0) AS rr FROM g)
SELECT level, tp, n_old, n_new, round(pp, 6) AS p, round(rr, 6) AS r, round(CASE WHEN pp + rr = 0 THEN 0.0::DOUBLE ELSE 2 * pp * rr / (pp + rr) END, 6) AS f1 FROM q
"""


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlapping spans at unequal places: (doc_id, o, n, ov, level_match, chain). Spans that meet share tokens, so a
    pair is a group of token positions; no span is compared with those it can't meet."""
    d = both(spark, sf_dir, match.rule_c)
    d = d.withColumn("_same", F.array_intersect(_plain("a"), _plain("b")))
    side = lambda x: F.flatten(F.transform(x, lambda s: F.transform(F.sequence(s["start"], s["end"] - 1), lambda i: F.struct(i.alias("i"), s["start"].alias("start"), s["level"].alias("level")))))
    left = d.select("doc_id", "_same", F.explode(side(F.col("a"))).alias("o")).select("doc_id", F.col("o.i").alias("i"), F.col("o.start").alias("o"), F.col("o.level").alias("lo"))
    right = d.select("doc_id", F.explode(side(F.col("b"))).alias("n")).select("doc_id", F.col("n.i").alias("i"), F.col("n.start").alias("n"), F.col("n.level").alias("ln"))
    same = d.select("doc_id", F.explode("_same").alias("s")).select("doc_id", F.col("s.start").alias("o"), F.lit(True).alias("gone"))
    pairs = left.join(right, ["doc_id", "i"]).groupBy("doc_id", "o", "n").agg(F.count("*").cast("int").alias("ov"), (F.first("lo") == F.first("ln")).alias("level_match"))
    open_ = pairs.join(same, ["doc_id", "o"], "left_anti")
    w = W.partitionBy("doc_id").orderBy("o", "n")
    fresh = (F.lag("o").over(w).isNull() | ((F.lag("o").over(w) != F.col("o")) & (F.lag("n").over(w) != F.col("n")))).cast("int")
    return open_.withColumn("fresh", fresh).withColumn("chain", F.sum("fresh").over(w)).drop("fresh")


def span_greedy_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Greedy pairing by largest overlap, each span once: overlapping pairs, matched pairs, of equal level."""
    pair = F.struct((-F.col("ov")).alias("neg"), F.col("o"), F.col("n"), F.col("level_match").alias("m"))
    kind = "array<struct<neg:int,o:int,n:int,m:boolean>>"
    chains = _pairs(spark, sf_dir).groupBy("doc_id", "chain").agg(F.array_sort(F.collect_list(pair)).cast(kind).alias("p"))
    free = lambda acc, p: ~F.exists(acc, lambda q: (q["o"] == p["o"]) | (q["n"] == p["n"]))
    got = F.aggregate("p", F.array().cast(kind), lambda acc, p: F.when(free(acc, p), F.concat(acc, F.array(p))).otherwise(acc))
    c = chains.select(F.size("p").alias("n"), got.alias("g"))
    return c.agg(F.sum("n").cast("long").alias("pairs"), F.sum(F.size("g")).cast("long").alias("par"), F.sum(F.size(F.filter("g", lambda x: x["m"]))).cast("long").alias("same_level"))


_GREEDY = SPANS_C + """
, p AS (
  SELECT sa.doc_id, sa.s AS o, sb.s AS n, least(sa.e, sb.e) - greatest(sa.s, sb.s) AS ov, sa.level = sb.level AS m
  FROM sa JOIN sb ON sa.doc_id = sb.doc_id AND sa.s < sb.e AND sa.e > sb.s AND NOT (sa.s = sb.s AND sa.e = sb.e)),
f AS (SELECT *, CASE WHEN lag(o) OVER w IS NULL OR (lag(o) OVER w <> o AND lag(n) OVER w <> n) THEN 1 ELSE 0 END AS x FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY o, n)),
c AS (SELECT *, sum(x) OVER (PARTITION BY doc_id ORDER BY o, n) AS chain FROM f),
l AS (SELECT doc_id, chain, list({'o': o, 'n': n, 'm': m} ORDER BY -ov, o, n) AS q FROM c GROUP BY doc_id, chain),
g AS (SELECT len(q) AS k, list_reduce(list_prepend([{'o': -1, 'n': -1, 'm': false}], list_transform(q, lambda y: [y])), lambda acc, y:
        CASE WHEN len(list_filter(acc, lambda z: z.o = y[1].o OR z.n = y[1].n)) > 0 THEN acc ELSE list_concat(acc, y) END) AS r FROM l)
SELECT sum(k)::BIGINT AS pairs, sum(len(r) - 1)::BIGINT AS par, sum(len(list_filter(r, lambda z: z.m)))::BIGINT AS same_level FROM g
"""


def span_diff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language: equal places with equal and unequal level, and spans left on either side."""
    d = both(spark, sf_dir)
    full, place = F.size(F.array_intersect("a", "b")), F.size(F.array_intersect(_plain("a"), _plain("b")))
    n = lambda c: F.sum(c).cast("long")
    return d.groupBy("lang").agg(n(full).alias("cor"), n(place - full).alias("inc"), n(F.size("a") - place).alias("old_left"), n(F.size("b") - place).alias("new_left"))


_DIFF = SPANS_B + """
, x AS (SELECT sa.lang, count(*) AS place, sum(CASE WHEN sa.level = sb.level THEN 1 ELSE 0 END) AS full_ FROM sa JOIN sb USING (doc_id, s, e) GROUP BY sa.lang),
na AS (SELECT lang, count(*) AS n FROM sa GROUP BY lang), nb AS (SELECT lang, count(*) AS n FROM sb GROUP BY lang)
SELECT lang, coalesce(full_, 0)::BIGINT AS cor, (coalesce(place, 0) - coalesce(full_, 0))::BIGINT AS inc, (coalesce(na.n, 0) - coalesce(place, 0))::BIGINT AS old_left,
       (coalesce(nb.n, 0) - coalesce(place, 0))::BIGINT AS new_left
FROM (SELECT DISTINCT lang FROM documents) LEFT JOIN x USING (lang) LEFT JOIN na USING (lang) LEFT JOIN nb USING (lang)
"""


def iob2_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per level: tags, and I- tags whose predecessor has another level, when every run of rule b is tagged I- from a
    token with a capital on."""
    tag = lambda w: F.transform(w, lambda t: F.when(match.rule_b(t) == "O", "O").otherwise(F.concat(F.when(t.rlike("^[A-Z]"), "I-").otherwise("B-"), match.rule_b(t))))
    level = lambda x: F.substring(x, 3, 2)
    marks = lambda t: F.transform(t, lambda x, i: F.struct(level(x).alias("level"), (x.startswith("I-") & (level(F.coalesce(F.get(t, i - 1), F.lit("O"))) != level(x))).alias("bad")))
    rows = read(spark, sf_dir, "documents").select(F.explode(let(tag(match.tokens(F.col("text"))), marks)).alias("r")).select("r.*")
    return rows.filter("level <> ''").groupBy("level").agg(F.count("*").alias("n_tags"), F.count_if("bad").alias("n_bad"))


_IOB2 = SPANS_B + """
, tag AS (SELECT t.doc_id, t.i, CASE WHEN lb = 'O' THEN 'O' WHEN regexp_matches(t.t, '^[A-Z]') THEN 'I-' || lb ELSE 'B-' || lb END AS g FROM tok t JOIN lab l USING (doc_id, i)),
p AS (SELECT *, lag(g, 1, 'O') OVER (PARTITION BY doc_id ORDER BY i) AS h FROM tag)
SELECT substr(g, 3, 2) AS level, count(*) AS n_tags, sum(CASE WHEN g LIKE 'I-%' AND substr(h, 3, 2) <> substr(g, 3, 2) THEN 1 ELSE 0 END)::BIGINT AS n_bad FROM p WHERE g <> 'O' GROUP BY 1
"""


def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases with the verdicts of a rule judge in both orders: it prefers the side with more spans, but slot 1 on a
    difference of one."""
    d = both(spark, sf_dir)
    diff = F.size("b") - F.size("a")
    c = d.select("doc_id", "lang", (F.col("a") == F.col("b")).alias("identical"), diff.alias("diff"), F.greatest(F.size("a"), F.size("b")).alias("most"))
    winner = lambda order: F.when(F.abs("diff") == 1, F.lit("1")).when(F.col("diff") == 0, F.lit("tie")).when((F.col("diff") > 0) == (F.lit(order) == 1), F.lit("1")).otherwise(F.lit("2"))
    c = c.withColumns({"v0": decisions.side_of(winner(0), F.lit(0)), "v1": decisions.side_of(winner(1), F.lit(1))})
    c = c.withColumn("winner", decisions.consensus(F.col("v0"), F.col("v1")))
    c = c.withColumn("decision", decisions.decision(F.col("identical"), F.col("winner")))
    return c.withColumn("severity", F.abs("diff").cast("double") / F.greatest("most", F.lit(1)))


def decision_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language and decision: cases, those confirmed at a severity of .3, and flips."""
    c = _cases(spark, sf_dir).withColumn("confirmed", decisions.confirmed(F.col("decision"), F.col("severity"), F.lit(0.3)))
    return c.groupBy("lang", "decision").agg(F.count("*").alias("n"), F.count_if("confirmed").alias("n_confirmed"), F.count_if(~F.col("identical") & F.col("winner").isNull()).alias("n_flip"))


_CASES = SPANS_B + """
, la AS (SELECT doc_id, list({'s': s, 'e': e, 'l': level} ORDER BY s) AS a FROM sa GROUP BY doc_id),
lb AS (SELECT doc_id, list({'s': s, 'e': e, 'l': level} ORDER BY s) AS b FROM sb GROUP BY doc_id),
c AS (SELECT doc_id, lang, coalesce(a, []) AS a, coalesce(b, []) AS b FROM documents LEFT JOIN la USING (doc_id) LEFT JOIN lb USING (doc_id)),
k AS (SELECT doc_id, lang, a = b AS identical, len(b) - len(a) AS diff, greatest(len(a), len(b)) AS most FROM c),
v AS (SELECT *, CASE WHEN abs(diff) = 1 THEN NULL WHEN diff = 0 THEN 'tie' WHEN diff > 0 THEN 'new' ELSE 'old' END AS winner, abs(diff)::DOUBLE / greatest(most, 1) AS severity FROM k),
w AS (SELECT *, CASE WHEN identical THEN 'agree' WHEN winner IS NULL THEN 'inconclusive' WHEN winner = 'old' THEN 'model_better' WHEN winner = 'tie' THEN 'tie' ELSE 'deepseek_better' END AS decision FROM v)
"""
_GATE = _CASES + """
SELECT lang, decision, count(*) AS n, count(*) FILTER (decision = 'deepseek_better' AND severity >= 0.3) AS n_confirmed, count(*) FILTER (NOT identical AND winner IS NULL) AS n_flip FROM w GROUP BY ALL
"""


def judge_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: judged cases, flip rate and its interval, tie rate, share of verdicts for the side with more spans."""
    c = _cases(spark, sf_dir).filter("not identical")
    g = c.agg(F.count("*").alias("n"), F.count_if(F.col("winner").isNull()).alias("flips"), F.count_if(F.col("winner") == "tie").alias("ties"), F.count_if(F.col("winner").isin("old", "new") & (F.col("diff") != 0)).alias("unequal"), F.count_if(((F.col("winner") == "new") & (F.col("diff") > 0)) | ((F.col("winner") == "old") & (F.col("diff") < 0))).alias("more"))
    lo, hi = wilson(F.col("flips"), F.col("n"))
    return g.select("n", "flips", F.round(ratio(F.col("flips"), F.col("n")), 6).alias("flip_rate"), F.round(lo, 6).alias("ci_low"), F.round(hi, 6).alias("ci_high"), F.round(ratio(F.col("ties"), F.col("n")), 6).alias("tie_rate"), F.round(ratio(F.col("more"), F.col("unequal")), 6).alias("more_spans_rate"))


_W = """round(greatest(0.0::DOUBLE, (P + 3.8416::DOUBLE / (2 * N) - 1.96::DOUBLE * sqrt(P * (1 - P) / N + 3.8416::DOUBLE / (4.0::DOUBLE * N * N))) / (1 + 3.8416::DOUBLE / N)), 6) AS ci_low,
round(least(1.0::DOUBLE, (P + 3.8416::DOUBLE / (2 * N) + 1.96::DOUBLE * sqrt(P * (1 - P) / N + 3.8416::DOUBLE / (4.0::DOUBLE * N * N))) / (1 + 3.8416::DOUBLE / N)), 6) AS ci_high"""


def wilson_sql(k: str, n: str) -> str:
    return _W.replace("P", f"(({k})::DOUBLE / ({n}))").replace("N", f"({n})::DOUBLE")


_HEALTH = _CASES + f"""
, h AS (SELECT count(*) AS n, count(*) FILTER (winner IS NULL) AS flips, count(*) FILTER (winner = 'tie') AS ties,
  count(*) FILTER (winner IN ('old', 'new') AND diff <> 0) AS unequal, count(*) FILTER ((winner = 'new' AND diff > 0) OR (winner = 'old' AND diff < 0)) AS more FROM w WHERE NOT identical)
SELECT n, flips, round(flips::DOUBLE / n, 6) AS flip_rate, {wilson_sql("flips", "n")}, round(ties::DOUBLE / n, 6) AS tie_rate, round(more::DOUBLE / unequal, 6) AS more_spans_rate FROM h
"""


def severity_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per severity threshold: support, errors, precision, recall; an error is a case the new side won."""
    c = _cases(spark, sf_dir).filter("winner is not null").select(round_scaled(F.col("severity"), 3).alias("severity"), (F.col("winner") == "new").alias("error"))
    s = decisions.sweep(c, "severity", "error")
    return s.select("t", "support", "errors", round_scaled(F.col("precision"), 6).alias("precision"), round_scaled(F.col("recall"), 6).alias("recall"))


_SWEEP = _CASES + """
, x AS (SELECT round(severity, 3) AS s, winner = 'new' AS e FROM w WHERE winner IS NOT NULL),
t AS (SELECT DISTINCT s AS t FROM x UNION SELECT 0.0)
SELECT t, count(*) FILTER (s >= t) AS support, count(*) FILTER (s >= t AND e) AS errors, round(count(*) FILTER (s >= t AND e)::DOUBLE / nullif(count(*) FILTER (s >= t), 0), 6) AS precision,
       round(count(*) FILTER (s >= t AND e)::DOUBLE / nullif(count(*) FILTER (e), 0), 6) AS recall
FROM t, x GROUP BY t
"""


def suggest_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decisions.suggest(severity_sweep(spark, sf_dir), 0.5, 10)


_SUGGEST = f"SELECT min(t) AS t FROM ({_SWEEP}) WHERE precision >= 0.5 AND support >= 10"


def retrain_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and reasons per language from the confirmed share of cases."""
    g = _cases(spark, sf_dir).groupBy("lang").agg(F.count("*").alias("n"), F.count_if((F.col("decision") == "deepseek_better") & (F.col("severity") >= 0.3)).alias("k"), F.count_if(F.col("decision") == "deepseek_better").alias("kb"))
    status, reasons = decisions.recommend(F.col("n"), F.col("k"), F.col("n"), F.col("kb"), {"min_cases": 100, "overall": 0.05, "min_slice": 20, "slice": 0.2})
    return g.select("lang", "n", "k", status.alias("status"), F.array_join(reasons, ",").alias("reasons"))


_LOW = "((({k})::DOUBLE / n) + 3.8416::DOUBLE / (2 * n::DOUBLE) - 1.96::DOUBLE * sqrt((({k})::DOUBLE / n) * (1 - (({k})::DOUBLE / n)) / n + 3.8416::DOUBLE / (4.0::DOUBLE * n * n))) / (1 + 3.8416::DOUBLE / n)"
_RECOMMEND = _CASES + f"""
, g AS (SELECT lang, count(*) AS n, count(*) FILTER (decision = 'deepseek_better' AND severity >= 0.3) AS k, count(*) FILTER (decision = 'deepseek_better') AS kb FROM w GROUP BY lang),
r AS (SELECT *, n >= 100 AND {_LOW.format(k="k")} >= 0.05 AS a, n >= 20 AND {_LOW.format(k="kb")} >= 0.2 AS b FROM g)
SELECT lang, n, k, CASE WHEN a OR b THEN 'retrain' WHEN n < 100 THEN 'insufficient' ELSE 'keep' END AS status,
       CASE WHEN a AND b THEN 'overall,slice' WHEN a THEN 'overall' WHEN b THEN 'slice' ELSE '' END AS reasons FROM r
"""


def multiset_f1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language: multiset intersection of (level, text of the span) of the two labelings, exact documents, micro F1."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    entity = lambda w, s: F.struct(s["level"].alias("level"), F.lower(F.array_join(F.slice(w, s["start"] + 1, s["end"] - s["start"]), " ")).alias("txt"))
    spans = lambda w, rule: let(F.transform(w, rule), lambda labels: F.transform(match.runs_of(labels), lambda s: entity(w, s)))
    side = lambda rule: docs.select("doc_id", F.explode(let(match.tokens(F.col("text")), lambda w: spans(w, rule))).alias("x")).select("doc_id", "x.*")
    m = match.multiset_scores(side(match.rule_a), side(match.rule_b), "doc_id", "level", "txt")
    g = docs.select("doc_id", "lang").join(m, "doc_id", "left").groupBy("lang").agg(*(F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("tp", "n_pred", "n_gold")), F.count_if(F.coalesce("exact", F.lit(True))).alias("n_exact"))
    return g.withColumn("f1", F.round(2.0 * F.col("tp") / F.nullif(F.col("n_pred") + F.col("n_gold"), F.lit(0)), 6))


_MULTI = SPANS_B + """
, ta AS (SELECT doc_id, level, lower(string_agg(t, ' ' ORDER BY i)) AS txt, s FROM sa JOIN tok USING (doc_id) WHERE i >= s AND i < e GROUP BY doc_id, level, s),
tb AS (SELECT doc_id, level, lower(string_agg(t, ' ' ORDER BY i)) AS txt, s FROM sb JOIN tok USING (doc_id) WHERE i >= s AND i < e GROUP BY doc_id, level, s),
u AS (SELECT doc_id, level, txt, 1 AS p, 0 AS g FROM ta UNION ALL SELECT doc_id, level, txt, 0, 1 FROM tb),
k AS (SELECT doc_id, level, txt, sum(p) AS p, sum(g) AS g FROM u GROUP BY ALL),
m AS (SELECT doc_id, sum(least(p, g)) AS tp, sum(p) AS n_pred, sum(g) AS n_gold, sum(abs(p - g)) = 0 AS exact FROM k GROUP BY doc_id)
SELECT lang, coalesce(sum(tp), 0)::BIGINT AS tp, coalesce(sum(n_pred), 0)::BIGINT AS n_pred, coalesce(sum(n_gold), 0)::BIGINT AS n_gold, count(*) FILTER (coalesce(exact, true)) AS n_exact,
       round(2.0::DOUBLE * coalesce(sum(tp), 0) / nullif(coalesce(sum(n_pred), 0) + coalesce(sum(n_gold), 0), 0), 6) AS f1
FROM documents LEFT JOIN m USING (doc_id) GROUP BY lang
"""


def grouping_sets_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases and equal documents for all and for each language."""
    rows = both(spark, sf_dir).select("lang", (F.col("a") == F.col("b")).alias("same"), F.size("a").alias("na"))
    sets = rows.groupingSets([[], ["lang"]], "lang").agg(F.grouping("lang").alias("whole"), F.count("*").alias("n"), F.count_if("same").alias("n_exact"), F.sum("na").cast("long").alias("n_spans"))
    return sets.select(F.when(F.col("whole") == 1, "all").otherwise(F.col("lang")).alias("subset"), "n", "n_exact", "n_spans")


_SETS = SPANS_B + """
, la AS (SELECT doc_id, list({'s': s, 'e': e, 'l': level} ORDER BY s) AS a FROM sa GROUP BY doc_id),
lb AS (SELECT doc_id, list({'s': s, 'e': e, 'l': level} ORDER BY s) AS b FROM sb GROUP BY doc_id),
c AS (SELECT lang, coalesce(a, []) = coalesce(b, []) AS same, len(coalesce(a, [])) AS na FROM documents LEFT JOIN la USING (doc_id) LEFT JOIN lb USING (doc_id))
SELECT coalesce(lang, 'all') AS subset, count(*) AS n, count(*) FILTER (same) AS n_exact, sum(na)::BIGINT AS n_spans FROM c GROUP BY GROUPING SETS ((), (lang))
"""


def chain_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose chains of levels agree for all three labelings, for two, or for none."""
    d = match.annotated(read(spark, sf_dir, "documents").select("doc_id", "text"), a=match.rule_a, b=match.rule_b, c=match.rule_c)
    chain = lambda x: F.array_join(F.transform(x, lambda s: s["level"]), ">")
    k = d.select(chain("a").alias("a"), chain("b").alias("b"), chain("c").alias("c"))
    n = F.size(F.array_distinct(F.array("a", "b", "c")))
    return k.groupBy(F.when(n == 1, "all").when(n == 2, "two").otherwise("none").alias("agreement")).agg(F.count("*").alias("n"))


_CHAIN = SPANS_B.replace("WITH tok", "WITH tok") + SPANS_C.replace("WITH tok AS", ", tok2 AS").replace("FROM tok)", "FROM tok2)").replace("lab AS", "lab2 AS").replace("FROM lab ", "FROM lab2 ").replace("prv AS", "prv2 AS").replace("FROM prv ", "FROM prv2 ").replace("run AS", "run2 AS").replace("FROM run ", "FROM run2 ").replace("sa AS", "sa2 AS").replace("sb AS", "sc AS") + """
, ca AS (SELECT doc_id, string_agg(level, '>' ORDER BY s) AS a FROM sa GROUP BY doc_id), cb AS (SELECT doc_id, string_agg(level, '>' ORDER BY s) AS b FROM sb GROUP BY doc_id),
cc AS (SELECT doc_id, string_agg(level, '>' ORDER BY s) AS c FROM sc GROUP BY doc_id),
z AS (SELECT len(list_distinct([coalesce(a, ''), coalesce(b, ''), coalesce(c, '')])) AS n FROM documents LEFT JOIN ca USING (doc_id) LEFT JOIN cb USING (doc_id) LEFT JOIN cc USING (doc_id))
SELECT CASE n WHEN 1 THEN 'all' WHEN 2 THEN 'two' ELSE 'none' END AS agreement, count(*) AS n FROM z GROUP BY 1
"""


def silver_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cases the new side won with a confirmed error."""
    c = _cases(spark, sf_dir).withColumn("confirmed", decisions.confirmed(F.col("decision"), F.col("severity"), F.lit(0.3)))
    return c.filter((F.col("decision") == "deepseek_better") & F.col("confirmed").eqNullSafe(True)).select("doc_id", F.round("severity", 6).alias("severity"))


_SILVER = _CASES + "SELECT doc_id, round(severity, 6) AS severity FROM w WHERE decision = 'deepseek_better' AND severity >= 0.3"

QUERIES = {f.__name__: f for f in (span_agreement_prf, span_greedy_overlap, span_diff_counts, iob2_violations, decision_gate, judge_health, severity_sweep, suggest_threshold, retrain_recommendation, multiset_f1, grouping_sets_eval, chain_agreement, silver_export)}
ORACLES = dict(zip(QUERIES, (_PRF, _GREEDY, _DIFF, _IOB2, _GATE, _HEALTH, _SWEEP, _SUGGEST, _RECOMMEND, _MULTI, _SETS, _CHAIN, _SILVER), strict=True))
