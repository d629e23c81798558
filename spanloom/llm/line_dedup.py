"""Line dedup by overlapping windows of three lines.

Lines that hold a word are numbered in their document; each run of three consecutive ones is hashed to 128 bits. A
window that occurs again, in the same or another document, keeps its first occurrence in the order of (doc_id, row,
position); all later ones are marked, and the union of the lines they cover is cut from the text.

Only windows are shuffled for the search, pre-aggregated per hash. Windows so frequent that there can't be many of them
(over a thousandth of all) are matched by a bounded broadcast, the others by a shuffled join, so no key meets in one task.

Defined results: a null text stays null and has no lines; documents of fewer than three such lines are left as they
are; a document whose lines are all copies keeps its row with what is left (blank lines or nothing); repeated rows are
copies of each other; an empty table stays empty; a text of any length is one row of lines;
extra columns are kept, but for those that `full` names its counts like.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, Workspace, let, match_counted

SIZE = 3
ROW, DROP = "_spanloom_row", "_spanloom_drop"


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _filled(lines: Column) -> Column:
    """Indexes of the lines that hold a word."""
    at = F.transform(lines, lambda x, i: F.when(F.btrim(x, F.lit(WHITE)) != "", i))
    return F.array_compact(at)


def windows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, pos, h1, h2): each window by two independent 64-bit hashes; pos counts lines that hold a word."""

    def of(x: Column) -> Column:
        full = let(_filled(x), lambda f: F.transform(f, lambda i: F.get(x, i)))
        three = lambda f: F.transform(F.sequence(F.lit(0), F.size(f) - SIZE), lambda i: F.struct(i.alias("pos"), F.xxhash64(*(F.get(f, i + k) for k in range(SIZE))).alias("h1"), F.xxhash64(F.lit(SIZE), *(F.get(f, i + k) for k in reversed(range(SIZE)))).alias("h2")))
        return let(full, lambda f: F.when(F.size(f) >= SIZE, three(f)))

    some = docs.filter(F.length("text") - F.length(F.translate("text", "\n", "")) >= SIZE - 1)
    return some.select(ROW, "doc_id", F.explode(let(lines_of(F.col("text")), of)).alias("w")).select(ROW, "doc_id", "w.*")


def dedup(docs: DataFrame, full: bool = False, emptied: bool = True) -> DataFrame:
    """docs with the text of later occurrences cut; with full also n_lines and n_removed (lines that hold a word); without
    emptied, documents that lost every line that holds a word go."""
    work = Workspace(docs.sparkSession, "line_dedup")
    # The same row gets the same number again when a lost task reruns: it counts rows in the partitions of the scan.
    rows = docs.withColumn(ROW, F.monotonically_increasing_id())
    wins = work.save(windows(rows.select(ROW, "doc_id", "text")), "windows")
    again = wins.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", ROW, "pos")).alias("first")).filter("n > 1")
    again = work.save(again, "repeated")
    later = match_counted(wins, again, ["h1", "h2"], "n").filter(F.struct("doc_id", ROW, "pos") != F.col("first"))
    covered = later.groupBy(ROW).agg(F.array_sort(F.collect_set("pos")).alias("starts"))
    # Ascending starts; a line is covered when a start lies within the SIZE - 1 lines before it.
    lines = let(F.col("starts"), lambda s: F.array_distinct(F.flatten(F.transform(s, lambda p: F.sequence(p, p + SIZE - 1)))))
    drop = covered.select(ROW, lines.alias(DROP))
    joined = rows.join(drop, ROW, "left")

    def kept(x: Column) -> Column:
        gone = let(F.struct(_filled(x).alias("f"), F.array_sort(F.col(DROP)).alias("d")), lambda v: F.map_from_arrays(F.transform(v["d"], lambda p: F.get(v["f"], p)), v["d"]))
        return let(gone, lambda g: F.array_join(F.filter(x, lambda _, i: ~F.map_contains_key(g, i)), "\n"))

    text = F.when(F.col(DROP).isNull(), F.col("text")).otherwise(let(lines_of(F.col("text")), kept))
    if not emptied:
        joined = joined.filter(F.col(DROP).isNull() | (F.size(DROP) < let(lines_of(F.col("text")), lambda x: F.size(_filled(x)))))
    extra = {"n_lines": F.coalesce(let(lines_of(F.col("text")), lambda x: F.size(_filled(x))), F.lit(0)).cast("long"), "n_removed": F.coalesce(F.size(DROP), F.lit(0)).cast("long")} if full else {}
    return joined.select(*(text.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns if c not in extra), *(c.alias(n) for n, c in extra.items()))
