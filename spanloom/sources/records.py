"""Scans of captured calls, labelled records, gold sets and line corpora; everything is parsed by Spark's own readers.

A capture is one file: a shell command with a request body and, on a later line, the response. Files whose parts can't be
read are rows of their own with an error, so that one bad capture stops neither the scan nor the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import case_id, nfc, url_path
from ..schema import LEVELS, SPAN

RESULT = "struct<" + ",".join(f"{level}:array<string>" for level in LEVELS) + ">"
RECORD = f"struct<text:string,input:string,tokens:array<string>,bio:array<string>,spans:array<{SPAN}>,len_nfc:int,is_full:boolean,source_id:long,cut:int,group:string>"


def whole_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("content"))


def captures(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(payloads, rejected). payloads: text, result, source<capture,endpoint,batch_index>, a row per text of a request with
    the result at its place; rejected: capture, error."""
    content = F.col("content")
    request = F.from_json(F.regexp_extract(content, r"(?s)--data\s*'\s*(.*)", 1), "struct<texts:array<string>>")
    answer = F.from_json(F.regexp_extract(content, r"(?ms)^\s*(\{\s*\"results\"\s*:.*)", 1), f"struct<results:array<struct<result:{RESULT}>>>")
    url = F.regexp_extract(content, r"curl\s+--location\s+'([^']+)'", 1)
    read = whole_files(spark, path).select(F.regexp_extract("file", "[^/]*$", 0).alias("capture"), request["texts"].alias("texts"), answer["results"].alias("results"), url.alias("url"))
    error = (
        F.when(F.col("texts").isNull(), "request")
        .when(F.col("results").isNull(), "response")
        .when(F.size("texts") != F.size("results"), "length")
        .when(F.col("url") == "", "endpoint")
        .when(F.exists("results", lambda r: r.isNull()), "result")
    )
    judged = read.withColumn("error", error)
    rows = judged.filter("error is null").select("capture", "url", F.posexplode(F.arrays_zip("texts", "results")).alias("i", "x"))
    source = F.struct("capture", url_path(F.col("url")).alias("endpoint"), F.col("i").alias("batch_index"))
    payloads = rows.select(F.col("x.texts").alias("text"), F.col("x.results.result").alias("result"), source.alias("source"))
    return payloads, judged.filter("error is not null").select("capture", "error")


def records(spark: SparkSession, path: str, schema: str = RECORD) -> DataFrame:
    """(file, index, raw) of the objects of JSON arrays; a file that holds anything else fails the query."""
    read = whole_files(spark, path).withColumn("all", F.from_json("content", f"array<{schema}>"))
    array = F.col("content").rlike(r"(?s)^\s*\[")
    checked = read.select("file", F.when(array & F.col("all").isNotNull(), F.col("all")).otherwise(F.raise_error(F.concat(F.lit("not an array of records: "), "file"))).alias("all"))
    return checked.select("file", F.posexplode("all").alias("index", "raw"))


def text_of(raw: Column) -> Column:
    """text, or input where that is missing; both and unlike, or neither, fails."""
    clash = raw["text"].isNotNull() & raw["input"].isNotNull() & (raw["text"] != raw["input"])
    found = F.coalesce(raw["text"], raw["input"])
    return F.when(clash, F.raise_error(F.lit("text and input differ"))).when(found.isNull(), F.raise_error(F.lit("neither text nor input"))).otherwise(found)


def normalized(rows: DataFrame) -> DataFrame:
    """(case_id, raw_text, old<tokens,bio,spans,source>, meta) of records(): text in NFC; meta.nfc_shift where that changed
    it or its length is not what the record says."""
    source = rows.select("file", "index", "raw", text_of(F.col("raw")).alias("given")).withColumn("raw_text", nfc(F.col("given")))
    shift = (F.col("raw_text") != F.col("given")) | F.coalesce(F.length("raw_text") != F.col("raw.len_nfc"), F.lit(False))
    old = F.struct(F.col("raw.tokens").alias("tokens"), F.col("raw.bio").alias("bio"), F.coalesce("raw.spans", F.array().cast(f"array<{SPAN}>")).alias("spans"), F.lit("ml_model").alias("source"))
    meta = F.struct(*(F.col(f"raw.{c}").alias(c) for c in ("is_full", "source_id", "cut", "group", "len_nfc")), shift.alias("nfc_shift"))
    return source.select(case_id(F.col("file"), F.col("index")).alias("case_id"), "raw_text", old.alias("old"), meta.alias("meta"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of lines that hold more than white space, in NFC."""
    read = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    return read.filter(F.col("line").rlike(r"(?U)\S")).withColumn("line", nfc(F.col("line")))


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def gold(spark: SparkSession, path: str) -> DataFrame:
    """(file, index, text, result, subset) of gold sets; texts and results of unlike numbers fail."""
    shape = f"struct<texts:array<string>,results:array<struct<result:{RESULT}>>,sources:array<struct<subset:string,file:string,index:long>>>"
    read = whole_files(spark, path).select("file", F.from_json("content", shape).alias("g"))
    uneven = F.size("g.texts") != F.size("g.results")
    zipped = F.when(uneven, F.raise_error(F.concat(F.lit("texts and results differ in number: "), "file"))).otherwise(F.arrays_zip(F.col("g.texts").alias("text"), F.col("g.results").alias("r"), F.coalesce("g.sources", F.array()).alias("s")))
    rows = read.select("file", F.posexplode(zipped).alias("index", "x"))
    return rows.select("file", "index", "x.text", F.col("x.r.result").alias("result"), F.col("x.s.subset").alias("subset"))


def latest(rows: DataFrame, key: str, by: str) -> DataFrame:
    """One row per key, that with the greatest `by`: the last of several gold entries of a text."""
    return rows.groupBy(key).agg(F.max_by(F.struct(*rows.columns), by).alias("_r")).select("_r.*")


