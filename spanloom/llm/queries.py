"""One query per operator, over whole tables, with production parameters; SQL oracles where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import classifier, embedding_dedup, line_dedup, mixing, ngram_join, packing, pii, quality_rules, suffix_dedup, warc
from .common import table


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = quality_rules.ledger(table(spark, sf_dir, "documents"))
    return quality_rules.apply_policy(led, "v1").select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "fail_mask", "policy")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return classifier.score(docs, *classifier.fit(docs, table(spark, sf_dir, "labels")))


def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), facts=True).select("doc_id", "domain", "lang", "source", "epoch", "n_tokens")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(pii.joined(tuple(pii.BASE)), 256).alias("base_sha256"), pii.joined(pii.KINDS).alias("spans"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, work = warc.archive(table(spark, sf_dir, "pages"), least=0)
    return warc.resolve(warc.captures_of(work), work).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), full=True)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents"), 4, 85, 100)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_quality_rules, op2_packing, op3_quality_classifier, op4_embedding_dedup, op5_suffix_dedup, op6_mixing, op7_pii, op8_warc, op9_line_dedup, op10_ngram_join)
}

_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_WORDS = "list_filter(regexp_split_to_array(coalesce({0}, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"

_OP1 = f"""
WITH base AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_WORDS.format("text")} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
gram AS (SELECT rid, unnest(range(1, len(w) - 1)) AS p, w FROM base WHERE len(w) >= 4),
grams AS (SELECT rid, p, [w[p], w[p + 1], w[p + 2]] AS g FROM gram),
again AS (SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
cover AS (SELECT rid, count(DISTINCT p + o) AS n FROM again, (SELECT unnest([0, 1, 2]) AS o) GROUP BY rid),
m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(l)::BIGINT AS n_lines
  FROM base LEFT JOIN cover USING (rid)),
f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 8 ELSE 0 END
    + CASE WHEN 10 * word_chars < 20 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END)::BIGINT AS fail_mask FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_mask & 3) <> 0 AS base_failed, fail_mask = 0 AS kept,
       n_lines, fail_mask, 'v1' AS policy FROM f
"""

_COMPONENTS = """
, reach(a, b) AS (
  SELECT a, b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
low AS (SELECT a AS id, least(a, min(b)) AS component_id FROM reach GROUP BY a)
"""

_OP4 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
edge AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_dot_product(x.e, y.e) >= 0.98 * sqrt(list_dot_product(x.e, x.e)) * sqrt(list_dot_product(y.e, y.e)))
{_COMPONENTS}
SELECT vec_id, (SELECT count(*) FROM edge WHERE a = vec_id)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
       vec_id = coalesce(component_id, vec_id) AS kept
FROM embeddings LEFT JOIN low ON id = vec_id
"""

_OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS s, max(page_id) OVER (PARTITION BY sha1(h)) AS top FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
       list_reduce(list_transform(range(8), lambda i: list_reduce(list_transform([32768, 1024, 32, 1], lambda k:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(s, (5 * i + 1)::INT, 5))::INT // k) % 32)::INT + 1, 1)), lambda x, y: x || y)), lambda x, y: x || y) AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""

_OP9 = """
WITH l AS (SELECT doc_id, text, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
e AS (SELECT doc_id, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS s FROM l),
f AS (SELECT doc_id, i, s, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM e WHERE regexp_matches(s, '[^\\x20\\x09-\\x0D]')),
w AS (SELECT doc_id, p, s, lead(s, 1) OVER o AS s2, lead(s, 2) OVER o AS s3 FROM f WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
n AS (SELECT doc_id, p, row_number() OVER (PARTITION BY s, s2, s3 ORDER BY doc_id, p) AS k FROM w WHERE s3 IS NOT NULL),
c AS (SELECT DISTINCT doc_id, p + o AS p FROM n, (SELECT unnest([0, 1, 2]) AS o) WHERE k > 1),
g AS (SELECT f.doc_id, f.i FROM f JOIN c USING (doc_id, p)),
k AS (SELECT e.doc_id, string_agg(e.s, chr(10) ORDER BY e.i) AS t FROM e ANTI JOIN g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT doc_id, coalesce(a.n, 0)::BIGINT AS n_lines, coalesce(b.n, 0)::BIGINT AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256
FROM documents LEFT JOIN k USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM f GROUP BY doc_id) a USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id) b USING (doc_id)
"""

_OP10 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, [w[i], w[i + 1], w[i + 2], w[i + 3]] AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 4)
  UNION ALL SELECT doc_id, w FROM d WHERE len(w) BETWEEN 1 AND 3),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
h AS (SELECT doc_id, n, hash(s) AS h FROM g JOIN n USING (doc_id)),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n AS na, y.n AS nb, count(*) AS k FROM h x JOIN h y ON x.h = y.h AND x.doc_id <> y.doc_id
      WHERE 100 * least(x.n, y.n) >= 85 * greatest(x.n, y.n) GROUP BY ALL),
edge AS (SELECT a, b FROM i WHERE 100 * k >= 85 * (na + nb - k))
{_COMPONENTS}
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN low ON id = doc_id
"""

ORACLES = {"op1_quality_rules": _OP1, "op4_embedding_dedup": _OP4, "op8_warc": _OP8, "op9_line_dedup": _OP9, "op10_ngram_join": _OP10}
