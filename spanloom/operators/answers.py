"""Model answers and messages: spans out of JSON, blinded projections, and the contract of a queue message."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import extract_json
from ..schema import LEVELS, SPAN
from .spans import let

LOOSE = "struct<start:string,end:string,level:string,text:string,truncated:boolean>"
BODY = f"struct<spans:array<{LOOSE}>>"


def answer_spans(answer: Column) -> Column:
    """struct<spans,n_malformed> of an answer: an object with spans, alone, as the one item of a list or of `records`; null
    if there is none. Spans whose offsets are no numbers or that lack a part are counted, not kept."""
    json = extract_json(answer)
    only = lambda x: F.when(F.size(x) == 1, F.get(x, F.lit(0)))
    body = F.coalesce(
        F.from_json(json, BODY)["spans"],
        only(F.from_json(json, f"struct<records:array<{BODY}>>")["records"])["spans"],
        only(F.from_json(json, f"array<{BODY}>"))["spans"],
    )

    def build(raw: Column) -> Column:
        cast = F.transform(raw, lambda s: F.struct(s["start"].try_cast("int").alias("start"), s["end"].try_cast("int").alias("end"), s["level"].alias("level"), s["text"].alias("text"), F.coalesce(s["truncated"], F.lit(False)).alias("truncated")).cast(SPAN))
        good = F.filter(cast, lambda s: s["start"].isNotNull() & s["end"].isNotNull() & s["level"].isNotNull() & s["text"].isNotNull())
        return F.when(raw.isNotNull(), F.struct(good.alias("spans"), (F.size(raw) - F.size(good)).alias("n_malformed")))

    return let(body, build)


def entities(answer: Column) -> Column:
    """<level,text> of well-formed spans of an answer, whatever their offsets; null without a list of spans."""
    raw = F.from_json(extract_json(answer), BODY)["spans"]
    return F.transform(F.filter(raw, lambda s: s["level"].isin(*LEVELS) & s["text"].isNotNull()), lambda s: F.struct(s["level"].alias("level"), s["text"].alias("text")))


def gold_entities(result: Column) -> Column:
    """<level,text> of a struct of lists, level by level."""
    entity = lambda level: lambda t: F.struct(F.lit(level).alias("level"), t.alias("text"))  # noqa: E731  (a second parameter would be the index)
    return F.flatten(F.array(*(F.transform(F.coalesce(result[level], F.array().cast("array<string>")), entity(level)) for level in LEVELS)))


def blinded(spans: Column) -> Column:
    """Levels and texts in the order of places, without the places."""
    return F.transform(F.array_sort(spans), lambda s: F.struct(s["level"].alias("level"), s["text"].alias("text")))


def highlighted(text: Column, spans: Column) -> Column:
    """The text as segments <text,level>, level null between spans; a span that starts inside the one before is left out."""
    segment = lambda a, b, level: F.struct(F.substring(text, a + 1, b - a).alias("text"), level.alias("level"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<text:string,level:string>>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        gap = F.when(s["start"] > a["at"], F.array(segment(a["at"], s["start"], F.lit(None).cast("string")))).otherwise(F.array().cast("array<struct<text:string,level:string>>"))
        return F.when(s["start"] < a["at"], a).otherwise(F.struct(s["end"].alias("at"), F.concat(a["out"], gap, F.array(segment(s["start"], s["end"], s["level"]))).alias("out")))

    tail = lambda a: F.when(a["at"] < F.length(text), F.concat(a["out"], F.array(segment(a["at"], F.length(text), F.lit(None).cast("string"))))).otherwise(a["out"])
    return F.aggregate(F.array_sort(spans), zero, step, tail)


def has_zone(stamp: Column) -> Column:
    return stamp.rlike(r"(?:Z|[+-][0-9]{2}(?::?[0-9]{2}){0,2})$") & stamp.contains("T") | stamp.rlike(r"\d \d.*(?:Z|[+-][0-9]{2}:?[0-9]{2})$")


def message_errors(msg: Column) -> Column:
    """Names of what a message struct breaks: msg_id, text, result.L1..L7, source, produced_at; empty if nothing."""
    empty = lambda c: F.coalesce(F.length(c) == 0, F.lit(True))
    stamp = msg["produced_at"]
    return F.array_compact(F.array(
        F.when(~F.coalesce(msg["msg_id"].rlike(r"(?s)^.+#[0-9]{5}$"), F.lit(False)), "msg_id"),
        F.when(empty(msg["text"]), "text"),
        F.when(msg["result"].isNull(), "result"),
        *(F.when(msg["result"].isNotNull() & (msg["result"][x].isNull() | F.exists(msg["result"][x], lambda t: t.isNull())), f"result.{x}") for x in LEVELS),
        F.when(msg["source"].isNull(), "source"),
        F.when(msg["source"].isNotNull() & empty(msg["source"]["capture"]), "source.capture"),
        F.when(msg["source"].isNotNull() & empty(msg["source"]["endpoint"]), "source.endpoint"),
        F.when(msg["source"].isNotNull() & ~F.coalesce(msg["source"]["batch_index"] >= 0, F.lit(False)), "source.batch_index"),
        F.when(F.try_to_timestamp(stamp).isNull(), "produced_at").when(~has_zone(stamp), "produced_at zone"),
    ))
