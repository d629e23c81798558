"""Sinks: filtered corpora with what was removed, appended results that resume, Markdown tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import markdown_cell


def write_filtered(lines: DataFrame, reasons: str, path: str) -> None:
    """Lines without a reason to `path`/kept, the others to `path`/removed as line, tab, reasons. Overwrites."""
    lines.filter(F.size(reasons) == 0).select("line").write.mode("overwrite").text(f"{path}/kept")
    removed = F.concat_ws("\t", F.col("line"), F.array_join(reasons, ","))
    lines.filter(F.size(reasons) > 0).select(removed.alias("value")).write.mode("overwrite").text(f"{path}/removed")


def append_missing(todo: DataFrame, done: DataFrame, key: str, path: str) -> None:
    """Appends rows of todo whose key is not done yet, as JSON lines: running it again adds nothing."""
    todo.join(done.select(key).distinct(), key, "left_anti").write.mode("append").json(path)


def write_split(rows: DataFrame, path: str) -> None:
    """rows(split, ...) as JSON lines of one folder a split, and their counts."""
    rows.write.mode("overwrite").partitionBy("split").json(f"{path}/rows")
    rows.groupBy("split").agg(F.count("*").alias("rows")).write.mode("overwrite").json(f"{path}/meta")


def markdown(rows: DataFrame) -> DataFrame:
    """One string per row of a Markdown table's body; heading() is its head."""
    cells = [F.coalesce(markdown_cell(F.col(f"`{c}`").cast("string")), F.lit("")) for c in rows.columns]
    return rows.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("value"))


def heading(rows: DataFrame) -> str:
    return f"| {' | '.join(rows.columns)} |\n|{'-|' * len(rows.columns)}"
