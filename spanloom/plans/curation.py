"""Queries over corpus text, labels, events and conversations: cleaning, sampling, statistics, queues."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import stats, text
from ..operators import corpus, decisions, sample
from ..operators.spans import let
from .labeling import _CASES, read, wilson_sql
from .labeling import _cases as cases


def match_key_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of lines that several documents share, after accents were decomposed on purpose. A document counts once for a
    key; the whole text is normalized at once, as nothing composes across a line's end."""
    d = read(spark, sf_dir, "documents").select(text.nfc(F.replace("text", F.lit("é"), F.lit("e\u0301"))).alias("t"))
    keys = d.select(F.explode(F.array_distinct(F.transform(F.split("t", "\n", -1), lambda x: text.match_key(x, normalize=False)))).alias("key"))
    return keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")


_KEYS = "SELECT key, count(*) AS n FROM (SELECT trim(regexp_replace(lower(nfc_normalize(replace(string_split(text, chr(10))[1], 'é', 'e' || chr(769)))), '\\s+', ' ', 'g'), ' ,.;:-') AS key FROM documents) GROUP BY key HAVING count(*) > 1"


def fold_diacritics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per language: documents with marks, and a checksum over the texts without them."""
    d = read(spark, sf_dir, "documents").select("lang", "text", text.strip_marks(F.col("text")).alias("plain"))
    digest = F.conv(F.substring(F.md5("plain"), 1, 8), 16, 10).cast("long")
    return d.groupBy("lang").agg(F.count("*").alias("n"), F.count_if(F.col("plain") != F.col("text")).alias("n_marked"), F.sum(digest).alias("checksum"))


_FOLD = "WITH d AS (SELECT lang, text, replace(replace(strip_accents(text), 'đ', 'd'), 'Đ', 'D') AS p FROM documents) SELECT lang, count(*) AS n, count(*) FILTER (p <> text) AS n_marked, sum(('0x' || substr(md5(p), 1, 8))::BIGINT)::BIGINT AS checksum FROM d GROUP BY lang"


def word_bigram_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigrams of letters-only words by their unmarked key: total, number of forms, the most frequent form."""
    lines = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    rows = lines.select("id", F.posexplode(let(text.letters_only(F.col("text")), lambda w: corpus.ngrams(w, 2))).alias("pos", "form"))
    table = rows.select(text.strip_marks(F.col("form")).alias("key"), "form", F.struct("id", "pos").alias("at")).groupBy("key", "form").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    return corpus.dominant(table).filter("n_forms > 1")


_FORMS = """
WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{Nl}\\p{No}]+') AS x FROM documents),
t AS (SELECT doc_id, unnest(range(0, len(x) - 1)) AS p, x FROM w WHERE len(x) > 1),
g AS (SELECT doc_id, p, x[p + 1] || ' ' || x[p + 2] AS form FROM t),
f AS (SELECT replace(replace(strip_accents(form), 'đ', 'd'), 'Đ', 'D') AS key, form, count(*) AS n, min((doc_id, p)) AS first FROM g GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY n DESC, first) AS k, sum(n) OVER (PARTITION BY key) AS total, count(*) OVER (PARTITION BY key) AS n_forms FROM f)
SELECT key, form, n, total::BIGINT AS total, n_forms FROM r WHERE k = 1 AND n_forms > 1
"""


def corpus_quality_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by the reasons for which the corpus filter removes them."""
    lines = read(spark, sf_dir, "documents").select(F.explode(F.split("text", "\n")).alias("line")).filter(F.trim("line") != "")
    return lines.groupBy(F.array_join(corpus.reasons(F.col("line")), ",").alias("reasons")).agg(F.count("*").alias("n"))


_REASONS = """
WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
w AS (SELECT line, regexp_extract_all(lower(line), '[\\p{L}\\p{Nl}\\p{No}]+') AS x FROM l WHERE trim(line) <> ''),
r AS (SELECT list_filter([
  CASE WHEN len(list_filter(x, lambda y: regexp_matches(y, '^[a-z]+$') AND (regexp_matches(y, '[aeiouy](c|ch|p|t)$') OR regexp_matches(y, '(ie|uo|ye)(n|m|ng|c|t|p|u)$')))) > 0 THEN 'orthography' END,
  CASE WHEN length(trim(line)) < 32 THEN 'short' END,
  CASE WHEN len(x) = 0 OR regexp_matches(line, '&#[0-9]+;') THEN 'strange' END], lambda z: z IS NOT NULL) AS r FROM w)
SELECT array_to_string(r, ',') AS reasons, count(*) AS n FROM r GROUP BY 1
"""


def html_entity_junk(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "pages").select("page_id", F.size(F.regexp_extract_all("html", F.lit("&#?[A-Za-z0-9]+;"), F.lit(0))).cast("long").alias("n_entities"), F.size(F.regexp_extract_all("html", F.lit("<[A-Za-z]"), F.lit(0))).cast("long").alias("n_tags"))
    return d.filter("n_entities > 0")


_JUNK = "SELECT * FROM (SELECT page_id, len(regexp_extract_all(html, '&#?[A-Za-z0-9]+;'))::BIGINT AS n_entities, len(regexp_extract_all(html, '<[A-Za-z]'))::BIGINT AS n_tags FROM pages) WHERE n_entities > 0"


def gold_leakage_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark text. Candidates meet on the hash of a benchmark's first words, all but the last of a
    short one and eight at most, so no document is searched for every item; the text itself decides."""
    items = read(spark, sf_dir, "benchmark").select("item_id", F.trim(F.replace("text", F.lit("\n"), F.lit(" "))).alias("item")).withColumn("w", F.split("item", " "))
    items = items.filter("item <> ''").withColumn("k", F.greatest(F.lit(1), F.least(F.lit(8), F.size("w") - 1)))
    lengths = sorted(r[0] for r in items.select("k").distinct().collect())  # 1 to 8
    hashed = lambda w, i, k: F.xxhash64(F.lit(k), *(F.get(w, i + j) for j in range(k)))
    none = F.array().cast("array<bigint>")
    all_of = lambda w, k: F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: hashed(w, i, k))).otherwise(none)
    key = F.coalesce(*(F.when(F.col("k") == k, hashed(F.col("w"), F.lit(0), k)) for k in lengths)) if lengths else F.lit(0).cast("long")
    items = items.select("item_id", "item", key.alias("h"))
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    grams = docs.select("doc_id", F.explode(let(F.split("text", "[ \n]"), lambda w: F.array_distinct(F.concat(none, *(all_of(w, k) for k in lengths))))).alias("h"))
    hits = grams.join(items, "h").select("doc_id", "item_id", "item")
    return hits.join(docs, "doc_id").filter(F.contains(F.concat(F.lit(" "), F.replace("text", F.lit("\n"), F.lit(" "))), F.concat(F.lit(" "), F.col("item")))).select("doc_id", "item_id").distinct()


_LEAK = "SELECT DISTINCT doc_id, item_id FROM documents, (SELECT item_id, trim(replace(text, chr(10), ' ')) AS item FROM benchmark) WHERE len(string_split(item, ' ')) >= 8 AND contains(' ' || replace(text, chr(10), ' '), ' ' || item)"


def resume_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that no label covers yet."""
    return read(spark, sf_dir, "documents").select("doc_id", "lang").join(read(spark, sf_dir, "labels"), "doc_id", "left_anti")


_TODO = "SELECT doc_id, lang FROM documents ANTI JOIN labels USING (doc_id)"


def stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty documents per language, the least by seeded hash."""
    return sample.per_stratum(read(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 20, 42)


_SAMPLE = "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY sha256('42|' || doc_id)) AS k FROM documents) WHERE k <= 20"


def audit_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose audit number lies under five percent."""
    e = read(spark, sf_dir, "events").select("event_id", text.unit(F.lit("run"), F.col("event_id").cast("string")).alias("u"))
    return e.filter("u < 0.05").select("event_id", F.round("u", 9).alias("u"))


_AUDIT = "SELECT event_id, round(u, 9) AS u FROM (SELECT event_id, ('0x' || substr(sha256('run|' || event_id), 1, 8))::UBIGINT / 4294967296.0::DOUBLE AS u FROM events) WHERE u < 0.05"


def rate_wilson_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of documents with a low label, by language."""
    d = read(spark, sf_dir, "documents").select("doc_id", "lang").join(read(spark, sf_dir, "labels"), "doc_id")
    g = d.groupBy("lang").agg(F.count_if(F.col("quality") == 0).alias("k"), F.count("*").alias("n"))
    lo, hi = stats.wilson(F.col("k"), F.col("n"))
    return g.select("lang", "k", "n", F.round(stats.ratio(F.col("k"), F.col("n")), 6).alias("rate"), F.round(lo, 6).alias("ci_low"), F.round(hi, 6).alias("ci_high"))


_WILSON = f"WITH g AS (SELECT lang, count(*) FILTER (quality = 0) AS k, count(*) AS n FROM documents JOIN labels USING (doc_id) GROUP BY lang) SELECT lang, k, n, round(k::DOUBLE / n, 6) AS rate, {wilson_sql('k', 'n')} FROM g"


def kappa_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = decisions.kappa(read(spark, sf_dir, "labels"), "quality", "toxic")
    return k.select("n", *(F.round(c, 6).alias(c) for c in ("po", "pe", "kappa")))


_KAPPA = """
WITH t AS (SELECT quality AS x, toxic AS y FROM labels WHERE quality IS NOT NULL AND toxic IS NOT NULL),
n AS (SELECT count(*) AS n, count(*) FILTER (x = y)::DOUBLE / count(*) AS po FROM t),
m AS (SELECT sum(a.c::DOUBLE * b.c) AS s FROM (SELECT x AS v, count(*) AS c FROM t GROUP BY x) a JOIN (SELECT y AS v, count(*) AS c FROM t GROUP BY y) b USING (v)),
k AS (SELECT n, po, coalesce(s, 0) / (n::DOUBLE * n) AS pe FROM n, m)
SELECT n, round(po, 6) AS po, round(pe, 6) AS pe, round(CASE WHEN pe < 1 THEN (po - pe) / (1 - pe) END, 6) AS kappa FROM k
"""


def latency_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, upper median, nearest 95th and interpolated 99th percentile, maximum, by type of event."""
    return sample.order_statistics(read(spark, sf_dir, "events"), "event_type", "value")


_LATENCY = """
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL)
SELECT event_type, any_value(n) AS n, round(avg(value), 2) AS mean, max(value) FILTER (i = n // 2) AS p50, max(value) FILTER (i = least(n - 1, round_even(0.95::DOUBLE * (n - 1), 0)::BIGINT)) AS p95,
       round(quantile_cont(value, 0.99), 6) AS p99, max(value) AS max FROM r GROUP BY event_type
"""


def token_cost_peak(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs of events priced by type, doubled in peak hours."""
    price = F.when(F.col("event_type") == "click", F.struct(F.lit(0.3).alias("miss"), F.lit(0.03).alias("hit"), F.lit(1.2).alias("out"))).otherwise(F.struct(F.lit(0.5).alias("miss"), F.lit(0.05).alias("hit"), F.lit(2.0).alias("out")))
    e = read(spark, sf_dir, "events").withColumns({"peak": stats.is_peak(F.col("ts")), "prompt": F.floor("value").cast("double")})
    e = e.withColumn("cost", stats.token_cost(F.col("prompt"), F.floor(F.col("prompt") / 4), F.lit(None).cast("double"), F.floor(F.col("prompt") / 2), price, F.when(F.col("peak"), 2.0).otherwise(1.0)))
    return e.groupBy("event_type", "peak").agg(F.count("*").alias("n"), F.round(F.sum("cost"), 8).alias("cost"))


_COST = """
WITH e AS (SELECT event_type, isodow(ts) <= 5 AND (hour(ts) BETWEEN 1 AND 3 OR hour(ts) BETWEEN 6 AND 9) AS peak, floor(value)::DOUBLE AS p FROM events)
SELECT event_type, peak, count(*) AS n, round(sum((CASE WHEN peak THEN 2.0 ELSE 1.0 END::DOUBLE) * (CASE WHEN event_type = 'click' THEN (p - floor(p / 4)) * 0.3::DOUBLE + floor(p / 4) * 0.03::DOUBLE + floor(p / 2) * 1.2::DOUBLE
  ELSE (p - floor(p / 4)) * 0.5::DOUBLE + floor(p / 4) * 0.05::DOUBLE + floor(p / 2) * 2.0::DOUBLE END) / 1e6::DOUBLE), 8) AS cost FROM e GROUP BY ALL
"""


def topic_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages by topic and status: the status follows from the payload's number."""
    k = F.get_json_object("props", "$.k").cast("long")
    status = F.element_at(F.array(*map(F.lit, ("pending", "processing", "done", "failed"))), (F.pmod(k, F.lit(4)) + 1).cast("int"))
    return read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("topic"), status.alias("status")).agg(F.count("*").alias("n"))


_TOPICS = "SELECT event_type AS topic, ['pending', 'processing', 'done', 'failed'][(json_extract(props, '$.k')::BIGINT % 4) + 1] AS status, count(*) AS n FROM events GROUP BY ALL"


def queue_fifo_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Oldest and newest message of each topic and user; max_by needs no sort of a key."""
    return read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("topic"), "user_id").agg(F.min("event_id").alias("head"), F.max_by("value", "event_id").alias("latest_value"))


_FIFO = "SELECT event_type AS topic, user_id, min(event_id) AS head, arg_max(value, event_id) AS latest_value FROM events GROUP BY ALL"


def budget_cutoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per user: events and cost within a running budget of 500."""
    w = W.partitionBy("user_id").orderBy("event_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    e = read(spark, sf_dir, "events").withColumn("run", F.sum(F.floor("value")).over(w))
    return e.filter("run <= 500").groupBy("user_id").agg(F.count("*").alias("n"), F.sum(F.floor("value")).cast("long").alias("spent"))


_BUDGET = "SELECT user_id, count(*) AS n, sum(v)::BIGINT AS spent FROM (SELECT user_id, floor(value) AS v, sum(floor(value)) OVER (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS r FROM events) WHERE r <= 500 GROUP BY user_id"


def json_extract_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers found in model answers that wrap the payload in a fence and talk."""
    answer = F.concat(F.lit("sure:\n```json\n"), "props", F.lit("\n```\ndone"))
    k = F.get_json_object(text.extract_json(answer), "$.k").cast("long")
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.count(k).alias("n"), F.sum(k).cast("long").alias("total"))


_PROPS = "SELECT event_type, count(json_extract(props, '$.k')) AS n, sum(json_extract(props, '$.k')::BIGINT)::BIGINT AS total FROM events GROUP BY event_type"


def conversation_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation: turns, changes of role, repeated roles, characters."""
    w = W.partitionBy("conv_id").orderBy("turn")
    c = read(spark, sf_dir, "conversations").select("conv_id", "role", F.lag("role").over(w).alias("last"), F.length("text").alias("n"))
    return c.groupBy("conv_id").agg(F.count("*").alias("turns"), F.count_if(F.col("role") != F.col("last")).alias("changes"), F.count_if(F.col("role") == F.col("last")).alias("repeats"), F.sum("n").cast("long").alias("chars"))


_TURNS = "SELECT conv_id, count(*) AS turns, count(*) FILTER (role <> p) AS changes, count(*) FILTER (role = p) AS repeats, sum(length(text))::BIGINT AS chars FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations) GROUP BY conv_id"


def gold_scan_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with their label (the last of several wins) by source and quality."""
    gold = read(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max_by("quality", F.struct("quality", "toxic")).alias("quality"))
    d = read(spark, sf_dir, "documents").select("doc_id", "source").join(gold, "doc_id", "left")
    return d.groupBy("source", "quality").agg(F.count("*").alias("n"))


_GOLD = "SELECT source, quality, count(*) AS n FROM documents LEFT JOIN (SELECT doc_id, arg_max(quality, (quality, toxic)) AS quality FROM labels GROUP BY doc_id) USING (doc_id) GROUP BY ALL"


def human_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unlabelled documents for people: audited ones first, else those whose case the judge left inconclusive. The reason is
    exploded, so that the filter on it does not work out the case again."""
    d = cases(spark, sf_dir).select("doc_id", "decision").join(read(spark, sf_dir, "labels"), "doc_id", "left_anti")
    reason = F.when(text.unit(F.lit("q"), F.col("doc_id").cast("string")) < 0.1, "random_audit").when(F.col("decision") == "inconclusive", "judge_flip")
    return d.select("doc_id", F.explode(F.array(reason)).alias("reason")).filter("reason is not null")


_HUMAN = "SELECT doc_id, reason FROM (SELECT doc_id, CASE WHEN ('0x' || substr(sha256('q|' || doc_id), 1, 8))::UBIGINT / 4294967296.0::DOUBLE < 0.1 THEN 'random_audit' WHEN n_chars % 7 = 0 THEN 'judge_flip' END AS reason FROM documents ANTI JOIN labels USING (doc_id)) WHERE reason IS NOT NULL"


def split_no_leakage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train and test by a hash of the source, so that no source is in both."""
    d = sample.split(read(spark, sf_dir, "documents"), "source", 0.2, 42)
    return d.groupBy("split").agg(F.count("*").alias("n"), F.count_distinct("source").alias("n_sources"))


_SPLIT = "SELECT CASE WHEN ('0x' || substr(sha256('42|' || source), 1, 8))::UBIGINT / 4294967296.0::DOUBLE < 0.2 THEN 'test' ELSE 'train' END AS split, count(*) AS n, count(DISTINCT source) AS n_sources FROM documents GROUP BY 1"


def prefix_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read(spark, sf_dir, "benchmark")
    cut = text.prefix_cut(F.col("text"), text.unit(F.lit("cut"), F.col("item_id").cast("string")))
    return b.select("item_id", F.length(cut).cast("long").alias("n"), F.md5(cut).alias("digest"))


_CUT = "WITH b AS (SELECT item_id, text, greatest(5, floor(length(text) * (0.4::DOUBLE + ('0x' || substr(sha256('cut|' || item_id), 1, 8))::UBIGINT / 4294967296.0::DOUBLE * 0.55::DOUBLE))::INT) AS k FROM benchmark) SELECT item_id, length(left(text, k))::BIGINT AS n, md5(left(text, k)) AS digest FROM b"

QUERIES = {f.__name__: f for f in (match_key_dups, fold_diacritics, word_bigram_forms, corpus_quality_reasons, html_entity_junk, gold_leakage_exclusion, resume_todo, stratified_sample, audit_sample, rate_wilson_ci, kappa_labels, latency_stats, token_cost_peak, topic_status_counts, queue_fifo_head, budget_cutoff, json_extract_props, conversation_turns, gold_scan_join, human_queue, split_no_leakage, prefix_cut)}
ORACLES = dict(zip(QUERIES, (_KEYS, _FOLD, _FORMS, _REASONS, _JUNK, _LEAK, _TODO, _SAMPLE, _AUDIT, _WILSON, _KAPPA, _LATENCY, _COST, _TOPICS, _FIFO, _BUDGET, _PROPS, _TURNS, _GOLD, _HUMAN, _SPLIT, _CUT), strict=True))

#: The same queries under second names, with SQL for all that they give: every line, the judge's outcome, and all rules.
WHOLE_KEYS = """
WITH l AS (SELECT doc_id, unnest(string_split(nfc_normalize(replace(text, 'é', 'e' || chr(769))), chr(10))) AS line FROM documents),
k AS (SELECT DISTINCT doc_id, trim(regexp_replace(lower(line), '\\s+', ' ', 'g'), ' ,.;:-') AS key FROM l)
SELECT key, count(*) AS n FROM k GROUP BY key HAVING count(*) > 1
"""
JUDGE_QUEUE = _CASES + """
, u AS (SELECT doc_id, CASE WHEN ('0x' || substr(sha256('q|' || doc_id), 1, 8))::UBIGINT / 4294967296.0::DOUBLE < 0.1 THEN 'random_audit' WHEN decision = 'inconclusive' THEN 'judge_flip' END AS reason FROM w ANTI JOIN labels USING (doc_id))
SELECT doc_id, reason FROM u WHERE reason IS NOT NULL
"""
WHOLE_REASONS = """
WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents),
w AS (SELECT line, regexp_extract_all(lower(line), '[\\p{L}\\p{Nl}\\p{No}]+') AS x, replace(replace(strip_accents(line), 'đ', 'd'), 'Đ', 'D') AS plain FROM l WHERE trim(line) <> ''),
g AS (SELECT *, list_transform(range(1, len(x)), lambda i: x[i] || ' ' || x[i + 1]) AS pairs,
  regexp_replace(regexp_replace(line, '(\\p{Nd})\\s*-\\s*(\\p{Nd})', '\\1\\2', 'g'), '(\\p{Nd})\\s*-\\s*(\\p{Nd})', '\\1\\2', 'g') AS tight FROM w),
r AS (SELECT list_filter([
  CASE WHEN len(list_filter(x, lambda y: regexp_matches(y, '^[a-z]+$') AND (regexp_matches(y, '[aeiouy](c|ch|p|t)$') OR regexp_matches(y, '(ie|uo|ye)(n|m|ng|c|t|p|u)$')))) > 0 THEN 'orthography' END,
  CASE WHEN contains(tight, '-') THEN 'hyphen' END,
  CASE WHEN len(list_distinct(pairs)) < len(pairs) OR len(list_filter(range(1, len(x)), lambda i: x[i] = x[i + 1] AND replace(strip_accents(x[i]), 'đ', 'd') IN ({K}))) > 0 THEN 'repeat' END,
  CASE WHEN len(x) = 0 OR regexp_matches(line, '&#[0-9]+;') OR (plain = line AND len(list_filter(x, lambda y: y IN ({K}))) = 0) THEN 'strange' END,
  CASE WHEN length(trim(line)) < 32 THEN 'short' END], lambda z: z IS NOT NULL) AS r FROM g)
SELECT array_to_string(r, ',') AS reasons, count(*) AS n FROM r GROUP BY 1
""".replace("{K}", ", ".join(f"'{k}'" for k in corpus.KEYWORDS))
QUERIES |= {"line_key_dups": match_key_dups, "judge_queue": human_queue, "line_reasons": corpus_quality_reasons}
ORACLES |= {"line_key_dups": WHOLE_KEYS, "judge_queue": JUDGE_QUEUE, "line_reasons": WHOLE_REASONS}
