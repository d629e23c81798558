"""Corpus statistics and quality predicates for lines of addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import canon, has_diacritic, letters_only, strip_marks
from .spans import let

#: Words that mark an address level, without marks; pairs first.
KEYWORD_PAIRS = ("thanh pho", "thi xa", "thi tran", "khu pho", "khu vuc")
KEYWORDS = ("duong", "phuong", "quan", "huyen", "xa", "tinh", "ap", "to", "hem", "ngo", "street", "st")
MIN_LENGTH = 32


def ngrams(words: Column, n: int) -> Column:
    count = F.size(words) - (n - 1)
    some = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(some, lambda i: F.array_join(F.slice(words, i + 1, F.lit(n)), " "))


def bad_orthography(words: Column) -> Column:
    """Syllables that can't be without a mark: a final c/ch/p/t, or ie/uo/ye before a final consonant."""
    plain = F.filter(words, lambda w: strip_marks(w) == w)
    return F.filter(plain, lambda w: w.rlike("^[a-z]+$") & (w.rlike("[aeiouy](c|ch|p|t)$") | w.rlike("(ie|uo|ye)(n|m|ng|c|t|p|u)$")))


def level_hyphen(line: Column) -> Column:
    """Whether a hyphen stands anywhere but between two digits, spaces around it aside."""
    return F.regexp_replace(line, r"(?U)(?<=\d)\s*-\s*(?=\d)", "").contains("-")


def repeated_gram(words: Column, n: int) -> Column:
    """The first n-gram that occurs again, else null."""
    return let(ngrams(words, n), lambda g: F.get(F.filter(g, lambda x, i: (F.array_position(g, x) - 1) < i), F.lit(0)))


def _adjacent(words: Column) -> Column:
    return F.filter(words, lambda w, i: (F.get(words, i + 1) == w) & strip_marks(w).isin(*KEYWORDS))


def repeats(words: Column) -> Column:
    """Whether repeated_keyword finds one, in time linear in the words: pairs of keywords and three words repeat two words."""
    return (F.size(_adjacent(words)) > 0) | let(ngrams(words, 2), lambda g: F.size(F.array_distinct(g)) < F.size(g))


def repeated_keyword(words: Column) -> Column:
    """The first adjacent repeat of a keyword, of a keyword pair, of three or of two words."""
    one = F.get(_adjacent(words), F.lit(0))
    two = let(ngrams(words, 2), lambda g: F.get(F.filter(g, lambda x, i: (F.get(g, i + 2) == x) & strip_marks(x).isin(*KEYWORD_PAIRS)), F.lit(0)))
    return F.coalesce(one, two, repeated_gram(words, 3), repeated_gram(words, 2))


def strange(line: Column, words: Column) -> Column:
    return (F.size(words) == 0) | line.rlike("&#[0-9]+;") | (~has_diacritic(line) & ~F.exists(words, lambda w: w.isin(*KEYWORDS)))


def reasons(line: Column) -> Column:
    """Names of the rules that a line breaks."""

    def of(w: Column) -> Column:
        return F.array_compact(F.array(
            F.when(F.size(bad_orthography(w)) > 0, "orthography"),
            F.when(level_hyphen(line), "hyphen"),
            F.when(repeats(w), "repeat"),
            F.when(strange(line, w), "strange"),
            F.when(F.length(F.trim(line)) < MIN_LENGTH, "short"),
        ))

    return let(letters_only(line), of)


def forms(lines: DataFrame, n: int) -> DataFrame:
    """(key, form, n, first): n-grams of words by their unmarked key and their form with tones as digits."""
    rows = lines.select("id", F.posexplode(let(F.transform(letters_only(F.col("text")), lambda w: w), lambda w: ngrams(w, n))).alias("pos", "gram"))
    keyed = rows.select(strip_marks(F.col("gram")).alias("key"), F.array_join(F.transform(F.split("gram", " "), canon), " ").alias("form"), F.struct("id", "pos").alias("at"))
    return keyed.groupBy("key", "form").agg(F.count("*").alias("n"), F.min("at").alias("first"))


def dominant(table: DataFrame) -> DataFrame:
    """Per key its most frequent form (the first seen wins ties) and the total; aggregation only, no sort of a key."""
    best = F.max_by("form", F.struct("n", (-F.col("first.id")).alias("i"), (-F.col("first.pos")).alias("p")))
    return table.groupBy("key").agg(best.alias("form"), F.max("n").alias("n"), F.sum("n").alias("total"), F.count("*").alias("n_forms"))


def context_errors(lines: DataFrame, least: int = 5, times: int = 3) -> DataFrame:
    """(id, gram, form): bigrams written without marks where a marked form dominates and the bare words are rare."""
    pairs, singles = forms(lines, 2), forms(lines, 1)
    marked = lambda t: F.col(f"{t}.form") != F.col(f"{t}.key")
    best = dominant(pairs.alias("f").filter(marked("f")))
    bare = pairs.alias("f").filter(~marked("f")).select("key", F.col("n").alias("mine"))
    suspect = bare.join(best, "key").filter((F.col("n") >= least) & (F.col("n") >= times * F.col("mine"))).select("key", "form")
    rare = singles.groupBy("key").agg(F.sum(F.when(F.col("form") == F.col("key"), F.col("n")).otherwise(0)).alias("plain"), F.sum(F.when(F.col("form") != F.col("key"), F.col("n")).otherwise(0)).alias("toned")).filter((F.col("toned") >= times * F.col("plain")) & (F.col("plain") > 0)).select(F.col("key").alias("word"))
    words = suspect.select("key", "form", F.explode(F.array_distinct(F.split("key", " "))).alias("word")).join(rare, "word", "left_semi").select("key", "form").distinct()
    rows = lines.select("id", F.explode(let(letters_only(F.col("text")), lambda w: F.array_distinct(ngrams(w, 2)))).alias("key"))
    return rows.join(words, "key").select("id", F.col("key").alias("gram"), "form")
