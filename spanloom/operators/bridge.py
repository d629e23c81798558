"""From messages with texts by level to cases with spans. Finding a text needs the places of its matches, which no built-in
gives for patterns, so one Arrow UDF locates all entities of a row."""

from __future__ import annotations

import re
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import nfc
from ..schema import LEVELS, SPAN
from .spans import tokens_and_bio

ENTITY = "struct<level:string,text:string>"
LOCATED = f"struct<spans:array<{SPAN}>,unlocated:array<{ENTITY}>,loose:array<{ENTITY}>>"


def locate(text: str, entities: Iterable[tuple[str, str]]) -> dict:
    """Longest entities first, each at the first match that no earlier one touches: verbatim, else with any white space
    between its words. What is nowhere is listed, and so is what only the second way found."""
    taken = bytearray(len(text))
    out: dict[str, list] = {"spans": [], "unlocated": [], "loose": []}
    for level, entity in sorted(entities, key=lambda e: -len(e[1])):
        words = [re.escape(w) for w in entity.split()]
        ways = [(re.escape(entity), False)] * bool(entity) + [(r"\s*".join(words), True)] * bool(words)
        free = ((m, loose) for way, loose in ways for m in re.finditer(way, text) if not any(taken[m.start() : m.end()]))
        m, loose = next(free, (None, False))
        if m is None:
            out["unlocated"].append({"level": level, "text": entity})
            continue
        taken[m.start() : m.end()] = b"\1" * (m.end() - m.start())
        out["spans"].append({"start": m.start(), "end": m.end(), "level": level, "text": m.group(), "truncated": False})
        if loose:
            out["loose"].append({"level": level, "text": entity})
    out["spans"].sort(key=lambda s: s["start"])
    return out


def _located(text: pd.Series, levels: pd.Series, texts: pd.Series) -> pd.DataFrame:
    rows = [locate(t or "", [*zip(a, b, strict=True)]) for t, a, b in zip(text, levels, texts, strict=True)]
    return pd.DataFrame(rows, columns=["spans", "unlocated", "loose"])


def cases(messages: DataFrame) -> DataFrame:
    """(case_id, raw_text, old<tokens,bio,spans,source>, meta) of messages(msg_id, text, result): text and entities in NFC.
    A level that is null has no entities; null entities are skipped."""
    split = "\u0001"  # can't stand in an entity: NFC is applied to all of a row's entities joined
    lists = [F.filter(F.coalesce(F.col("result")[level], F.array().cast("array<string>")), lambda t: t.isNotNull()) for level in LEVELS]
    levels = F.flatten(F.array(*(F.array_repeat(F.lit(level), F.size(x)) for level, x in zip(LEVELS, lists, strict=True))))
    rows = messages.select("msg_id", "text", levels.alias("_levels"), F.flatten(F.array(*lists)).alias("_texts"))
    joined = F.split(nfc(F.array_join("_texts", split)), split, -1)
    rows = rows.select("msg_id", "text", nfc(F.col("text")).alias("raw_text"), "_levels", F.when(F.size("_levels") == 0, F.array().cast("array<string>")).otherwise(joined).alias("_texts"))
    rows = rows.withColumn("_l", F.pandas_udf(_located, LOCATED)("raw_text", "_levels", "_texts"))
    tokens, bio = tokens_and_bio(F.col("raw_text"), F.col("_l.spans"))
    old = F.struct(tokens.alias("tokens"), bio.alias("bio"), F.col("_l.spans").alias("spans"), F.lit("api").alias("source"))
    meta = F.struct(F.col("msg_id").alias("source_msg_id"), F.lit(True).alias("truncated_unknown"), (F.col("raw_text") != F.col("text")).alias("nfc_shift"), F.col("_l.unlocated").alias("unlocated"), F.col("_l.loose").alias("loose_ws_match"))
    return rows.select(F.col("msg_id").alias("case_id"), "raw_text", old.alias("old"), meta.alias("meta"))


def totals(built: DataFrame) -> DataFrame:
    """One row: cases, spans, entities that were not found and that only loose spacing found."""
    n = lambda c: F.coalesce(F.sum(F.size(c)), F.lit(0)).cast("long")
    return built.agg(F.count("*").alias("cases"), n("old.spans").alias("spans"), n("meta.unlocated").alias("unlocated"), n("meta.loose_ws_match").alias("loose"))

