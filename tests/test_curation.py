"""Queries over small tables written for the test, against what is worked out by hand."""

import hashlib
import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from spanloom.functions import text
from spanloom.operators import corpus
from spanloom.plans import curation


@pytest.fixture
def tables(spark, tmp_path):
    def write(**rows):
        for name, (schema, data) in rows.items():
            spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def test_human_queue_follows_the_judge(spark, tables):
    # One span against none flips the judge; equal labelings and two against none don't, though 7 characters long.
    audit = lambda i: int(hashlib.sha256(f"q|{i}".encode()).hexdigest()[:8], 16) / 2**32 < 0.1
    calm, drawn = [i for i in range(200) if not audit(i)], next(i for i in range(200) if audit(i))
    texts = ["Ab c", "ab cdef", "Ab c De", "Ab c"]
    docs = [*zip(calm, texts, strict=False), (drawn, "ab cdef")]
    sf = tables(documents=("doc_id long, text string, lang string, n_chars long", [(i, t, "en", len(t)) for i, t in docs]), labels=("doc_id long, quality int, toxic int", [(calm[3], 1, 0)]))
    assert {tuple(r) for r in curation.human_queue(spark, sf).collect()} == {(calm[0], "judge_flip"), (drawn, "random_audit")}


def reasons_of(line):
    plain = lambda x: "".join(c for c in unicodedata.normalize("NFD", x) if unicodedata.category(c) != "Mn").replace("đ", "d").replace("Đ", "D")
    w = re.findall(r"[^\W\d_]+", line.lower())
    pairs = [*zip(w, w[1:], strict=False)]
    hyphen = any(not (re.search(r"\d\s*$", line[: m.start()]) and re.match(r"\s*\d", line[m.end() :])) for m in re.finditer("-", line))
    found = {
        "orthography": any(re.fullmatch("[a-z]+", x) and re.search("[aeiouy](c|ch|p|t)$|(ie|uo|ye)(n|m|ng|c|t|p|u)$", x) for x in w),
        "hyphen": hyphen,
        "repeat": any(a == b and plain(a) in corpus.KEYWORDS for a, b in pairs) or len(set(pairs)) < len(pairs),
        "strange": not w or bool(re.search("&#[0-9]+;", line)) or (plain(line) == line and not set(w) & set(corpus.KEYWORDS)),
        "short": len(line.strip(" ")) < 32,
    }
    return ",".join(k for k, v in found.items() if v)


def test_corpus_quality_reasons_applies_every_rule(spark, tables):
    rng = random.Random(3)
    parts = ["đường", "đường", "Huệ", "quan", "xa", "12", "3", " - ", "-", "tac", "lorem", "Lê", "&#8211;", "3 - 4", "3-4", "ipsum"]
    lines = [" ".join(rng.choices(parts, k=rng.choice([1, 3, 8, 12]))) for _ in range(400)]
    lines += ["Số 3 - 4 đường Nguyễn Huệ ở Bến Nghé", "Số 3 đường Nguyễn Huệ - ở Bến Nghé ", "lê lợi, bến nghé, lê lợi, bến nghé", "plain words here, no level or sign"]
    sf = tables(documents=("doc_id long, text string", [(i, "\n".join(lines[i::7])) for i in range(7)]))
    got = {r.reasons: r.n for r in curation.corpus_quality_reasons(spark, sf).collect()}
    assert got == Counter(map(reasons_of, lines)) and {"hyphen", "repeat", "strange"} <= set(",".join(got).split(","))
    w = text.letters_only(F.col("text"))
    rows = spark.createDataFrame([(x,) for x in lines], "text string").select(corpus.repeats(w).alias("a"), corpus.repeated_keyword(w).isNotNull().alias("b")).collect()
    assert all(r.a == r.b for r in rows)


def test_match_key_dups_reads_every_line(spark, tables):
    docs = ["Tên\nCafé  Sữa.\n\nmột", "khác\ncafé sữa\nCafé sữa", "Tên\nhai", "\n x \nmột;", None, "end\n"]
    sf = tables(documents=("doc_id long, text string", [*enumerate(docs)]))
    assert {r.key: r.n for r in curation.match_key_dups(spark, sf).collect()} == {"tên": 2, "café sữa": 2, "một": 2, "": 3}


def test_line_reasons_equal_their_sql(spark, tables):
    import duckdb

    lines = ["Số 1-2-3 - 4 đường Nguyễn Huệ ở Bến Nghé", "Số 3 đường Nguyễn Huệ - ở Bến Nghé ", "đường đường", "lê lợi, bến nghé, lê lợi, bến nghé", "tac &#8211; 12", "", " ", "--", "plain words, no level or sign in here", "hẻm hẻm 5 - a"]
    sf = tables(documents=("doc_id long, text string", [(0, "\n".join(lines[:5])), (1, "\n".join(lines[5:])), (2, None), (3, "")]))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet/*.parquet'")
    want = sorted(con.sql(curation.ORACLES["line_reasons"]).fetchall())
    assert sorted(map(tuple, curation.QUERIES["line_reasons"](spark, sf).collect())) == want and {"hyphen", "repeat", "strange"} <= set(",".join(r for r, _ in want).split(","))
