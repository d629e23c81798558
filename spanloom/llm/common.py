"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six white-space characters of the word definition `[^\x20\x09-\x0D]+`.
WHITE = " \t\n\x0b\x0c\r"
WHITE_RE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where
    that is unset on a local master (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "spanloom-shared")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class Workspace:
    """Tables written to the shared folder to cut lineage; a lost executor rereads them instead of recomputing.

    Tables that later steps no longer need go with drop(); the rest stay for the lazy result.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/spanloom/{name}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Deletes tables, and lets Spark's cleaner see that the shuffles which made them are no longer used."""
        gc.collect()
        self.spark._jvm.System.gc()
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


class Beside:
    """Rows of a table that belong to rows of a scan, read by the scan's own tasks: a join that moves no text.

    Rows of the scan are numbered by monotonically_increasing_id, whose high bits are the scan's partition. save() writes
    the table by that partition; a task that scans a partition reads its part alone. Both scans must be cut alike."""

    BITS = 33

    def __init__(self, work: Workspace, name: str):
        self.folder, self.part, self.table = work.path(name), None, None

    def save(self, rows: DataFrame, row: str = "row") -> Beside:
        part = F.shiftright(row, self.BITS).alias("_part")
        dealt = rows.select("*", part).repartition("_part").sortWithinPartitions("_part", row)
        dealt.write.option("compression", "zstd").partitionBy("_part").parquet(self.folder)
        return self

    def of(self, rows: pa.Array, row: str = "row") -> list[pa.Table]:
        """For each of consecutive rows of one partition of the scan, what the table holds for it."""
        import numpy as np
        import pyarrow.parquet as pq
        from pyarrow import fs

        ids = rows.to_numpy()
        part = int(ids[0]) >> self.BITS if len(ids) else self.part
        if part != self.part:
            store, path = fs.FileSystem.from_uri(self.folder)
            files = [f.path for f in store.get_file_info(fs.FileSelector(f"{path}/_part={part}", allow_not_found=True)) if f.path.endswith(".parquet")]
            tables = []
            for f in files:
                with store.open_input_file(f) as source:
                    tables.append(pq.ParquetFile(source).read())
            self.part, self.table = part, pa.concat_tables(tables).sort_by(row).combine_chunks() if tables else None
        if self.table is None:
            return [pa.table({})] * len(ids)
        have = self.table.column(row).to_numpy()
        return [self.table.slice(a, b - a) for a, b in zip(np.searchsorted(have, ids), np.searchsorted(have, ids, side="right"), strict=True)]


def prepare_python(spark: SparkSession, rows: int = 1000) -> None:
    """Bounds the rows of an Arrow batch, so that a batch of long texts fits a Python worker, and lets workers that
    start elsewhere than in the repository find this package."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > rows or int(spark.conf.get(key)) <= 0:
        spark.conf.set(key, str(rows))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once a row, whatever the optimizer inlines."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text in order; null and blank texts have none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, WHITE_RE, -1))


def match_counted(rows: DataFrame, keyed: DataFrame, on: list[str], count: str, share: int = 1000) -> DataFrame:
    """rows inner-joined to keyed, which has each key once with the number of its rows in column count.

    Keys that hold over 1/share of all counted rows number fewer than share: they are broadcast, by that bound. The
    others meet in a shuffled join, in which no key has more than that share. keyed must be a written table."""
    total = keyed.agg(F.sum(count)).first()[0] or 0
    hot = F.col(count) > max(total // share, 1)
    mark = "_spanloom_hot"
    common = F.broadcast(keyed.filter(hot).select(*on, F.lit(True).alias(mark)))
    some = rows.join(common, on, "left")
    first = rows.join(F.broadcast(keyed.filter(hot)), on)
    rest = some.filter(F.col(mark).isNull()).drop(mark).join(keyed.filter(~hot), on)
    return first.unionByName(rest)
