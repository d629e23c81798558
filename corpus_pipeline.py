"""The corpus pipeline: quality rules, line dedup, near-duplicate join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the caller may write and reread it in between, as run()
does. Stages 1 to 4 return the columns of `documents`; the last returns the pieces of packed sequences. Tables that are
empty, have nulls or extra columns pass through by the rules that each operator's module states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from spanloom.llm import line_dedup, mixing, ngram_join, packing, quality_rules
from spanloom.llm.common import Workspace, table

#: Keeps most of the corpus; every document at most once.
TARGETS = mixing.Targets(mixing.TARGETS.weights, share=0.9, max_epochs=1)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that policy v1 rejects go."""
    return quality_rules.keep(docs, "v1")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later occurrences of three-line windows are cut from the texts. A document that they were all of is a copy of what
    came before it: nothing of it is left, so it goes. One that was blank before stays as it is."""
    return line_dedup.dedup(docs, emptied=False)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 0.8 of their five-word shingles, the least doc_id stays."""
    return ngram_join.keep_one(docs, 5, 80, 100)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen by the budgets of their domain, language and source."""
    return mixing.mix(docs, TARGETS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document in sequences of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("ngram_join", near_duplicates),
    ("mixing", mixture),
    ("packing", pack),
]

#: SQL can't express tokenizing and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = work.save(docs, name)
    return docs
