"""WARC archives with a two-level capture index.

Writing: equal payloads are found by a grouped digest; of each group the record with the largest page_id is a response,
the others are revisits that name it. Every task writes one archive file of gzip members, one member a record, and
returns where each record lies. Index: capture lines, keyed by the URL with its host reversed, are sorted over all
files and packed into compressed blocks; a sparse directory has one row per block, sorted by its first capture. Reading:
captures wanted are sorted, tasks read the part of the directory that their range of keys falls into, bisect it, then the
block, then read one range of an archive.

Files go to the shared folder by pyarrow's file systems. A task that runs again writes a new file; only files that a
finished task returned are in the index, so lost executors leave no half-read archives.

Defined results: a null or empty html is a payload of 0 bytes; a null url has the empty key; repeated rows of one
page_id are records of their own, and the first in the file is the response if none other has a larger page_id; a null
page_id is less than any other and comes back as null; a payload of any length is one record; an empty table writes
nothing; extra columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Workspace, match_counted, prepare_python

BLOCK_LINES = 256
GZIP_LEVEL = 3
#: Fixed value: revisit profile named by the WARC 1.1 standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {}\r\n\r\n"
CAPTURES = "page_id long, key string, file string, offset long, size long"
BLOCKS = "first_key string, first_page long, last_key string, last_page long, file string, offset long, size long, n_lines long"
#: Stands for a null page_id in an index, where it sorts first.
NO_PAGE = -(1 << 63)
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"


def url_key(url: str | None) -> str:
    """The host's labels reversed, then path and query: `http://a.b.org/x?y` is `org,b,a)/x?y`."""
    rest = (url or "").split("://", 1)[-1]
    if not rest:
        return ""
    cut = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host, path = rest[:cut].rsplit("@", 1)[-1].lower(), rest[cut:].split("#", 1)[0] or "/"
    host, _, port = host.partition(":")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port and port not in ("80", "443") else "") + ")" + (path if path[0] == "/" else "/" + path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record. The block is an HTTP message; a revisit's has no body, and an extension header its payload's
    length. A URL that a header can't hold as it is goes into an extension header as JSON."""
    kind = "response" if refers_to is None else "revisit"
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {datetime.now(UTC):%Y-%m-%dT%H:%M:%SZ}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {url}" if re.fullmatch("[!-~]+", url) else f"X-Target-URI: {json.dumps(url)}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:page:{'' if refers_to == NO_PAGE else refers_to}>"]
    block = HTTP.format(len(payload)).encode() + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> tuple:
    """The columns of RECORDS from one record's bytes; a response's digest and length come from its payload."""
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    payload = body[: int(fields["Content-Length"])].partition(b"\r\n\r\n")[2]
    page = lambda k: int(fields[k][len("<urn:page:") : -1]) if fields[k] != "<urn:page:>" else None
    url = fields["WARC-Target-URI"] if "WARC-Target-URI" in fields else json.loads(fields.get("X-Target-URI", "null"))
    if fields["WARC-Type"] == "response":
        if digest(payload) != fields["WARC-Payload-Digest"][5:]:
            raise ValueError(f"payload of page {page('WARC-Record-ID')} differs from its digest")
        return page("WARC-Record-ID"), url, len(payload), digest(payload), "response", None, payload
    return page("WARC-Record-ID"), url, int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"][5:], "revisit", page("WARC-Refers-To"), None


def _create(folder: str, kind: str):
    """A new file in folder with a name no other attempt has, and its name."""
    from pyarrow import fs

    name = f"{kind}-{uuid.uuid4().hex}"
    store, path = fs.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    return store.open_output_stream(f"{path}/{name}"), name


class Ranges:
    """Reads ranges of files of a folder; keeps a few files open."""

    def __init__(self, folder: str, most: int = 64):
        from pyarrow import fs

        self.store, self.path = fs.FileSystem.from_uri(folder)
        self.files, self.most = {}, most

    def read(self, name: str, offset: int, size: int) -> bytes:
        if name not in self.files:
            if len(self.files) >= self.most:
                self.files.pop(next(iter(self.files))).close()
            self.files[name] = self.store.open_input_file(f"{self.path}/{name}")
        self.files[name].seek(offset)
        return self.files[name].read(size)


def with_revisits(pages: DataFrame, work: Workspace, least: int = 0) -> DataFrame:
    """pages with refers_to: null for responses. Only ids and digests are grouped; payloads move once, to meet it."""
    sized = F.octet_length(F.coalesce("html", F.lit("")))
    rows = pages.select(F.monotonically_increasing_id().alias("_row"), "page_id", "url", "html")
    keys = rows.filter(sized >= least).select("_row", "page_id", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sha"))
    keys = work.save(keys, "digests")
    groups = keys.groupBy("sha").agg(F.count("*").alias("n"), F.max(F.struct("page_id", (-F.col("_row")).alias("back"))).alias("first")).filter("n > 1")
    groups = work.save(groups, "copies")
    again = match_counted(keys, groups, ["sha"], "n").filter(F.col("_row") != -F.col("first.back")).select("_row", F.coalesce("first.page_id", F.lit(NO_PAGE)).alias("refers_to"))
    return rows.join(again, "_row", "left").drop("_row")


def write(pages: DataFrame, work: Workspace, least: int = 0) -> DataFrame:
    """Writes the archives; returns CAPTURES, a written table."""
    folder = work.path("archives")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, html, refers in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "refers_to")), strict=True):
                if out is None:
                    out, name = _create(folder, "warc")
                data = gzip.compress(record(page_id, url, (html or "").encode("utf-8", "surrogatepass"), refers), GZIP_LEVEL, mtime=0)
                out.write(data)
                rows.append((page_id, url_key(url), name, at, len(data)))
                at += len(data)
            yield _batch(rows, CAPTURES)
        if out is not None:
            out.close()

    return work.save(with_revisits(pages, work, least).mapInArrow(run, CAPTURES), "captures")


def index(captures: DataFrame, work: Workspace, lines: int = BLOCK_LINES) -> DataFrame:
    """Sorts captures by key into compressed blocks; returns the directory, a written table with one row per block."""
    folder = work.path("index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, name, at, held = None, "", 0, []

        def flush(n: int):
            nonlocal out, name, at, held
            rows = []
            while len(held) >= max(n, 1):
                part, held = held[:lines], held[lines:]
                if out is None:
                    out, name = _create(folder, "cdx")
                data = zlib.compress("\n".join(json.dumps(x) for x in part).encode(), 6)
                out.write(data)
                rows.append((*part[0][:2], *part[-1][:2], name, at, len(data), len(part)))
                at += len(data)
            return _batch(rows, BLOCKS)

        for batch in batches:
            held += zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "file", "offset", "size")), strict=True)
            yield flush(lines)
        yield flush(1)
        if out is not None:
            out.close()

    numbered = captures.select("key", F.coalesce("page_id", F.lit(NO_PAGE)).alias("page_id"), "file", "offset", "size")
    ordered = numbered.repartitionByRange("key", "page_id", "offset").sortWithinPartitions("key", "page_id", "offset")
    return work.save(ordered.mapInArrow(run, BLOCKS), "directory")


class Captures:
    """Looks captures up: the part of the directory that a range of keys falls into is read, then everything is bisected."""

    def __init__(self, work_index: str, work_archives: str, directory: str):
        import pyarrow.dataset as ds
        from pyarrow import fs

        self.index, self.store = Ranges(work_index), Ranges(work_archives)
        store, path = fs.FileSystem.from_uri(directory)
        self.directory, self.rows, self.block, self.lines = ds.dataset(path, filesystem=store, format="parquet"), [], None, []

    def near(self, low: str, high: str) -> None:
        """Keeps the blocks that can hold keys from low to high."""
        import pyarrow.dataset as ds

        part = self.directory.to_table(filter=(ds.field("last_key") >= low) & (ds.field("first_key") <= high))
        self.rows = sorted(zip(*(part.column(c).to_pylist() for c in ("first_key", "first_page", "last_key", "last_page", "file", "offset", "size")), strict=True))

    def find(self, key: str, page: int | None = None) -> Iterator[tuple]:
        """(file, offset, size) of the captures of a key, or of a page under it, among the blocks near."""
        least, most = (key, NO_PAGE if page is None else page), (key, (1 << 63) - 1 if page is None else page)
        for row in self.rows[bisect_left(self.rows, least, key=lambda r: r[2:4]) :]:
            if row[:2] > most:
                break
            if row[4:] != self.block:
                self.block, self.lines = row[4:], block_lines(self.index, *row[4:])
            for line in self.lines[bisect_left(self.lines, least, key=lambda x: tuple(x[:2])) :]:
                if tuple(line[:2]) > most:
                    break
                yield tuple(line[2:5])

    def read(self, place: tuple) -> tuple:
        return parse(gzip.decompress(self.store.read(*place)))


def block_lines(ranges: Ranges, file: str, offset: int, size: int) -> list[list]:
    return [json.loads(x) for x in zlib.decompress(ranges.read(file, offset, size)).decode().split("\n")]


def resolve(wanted: DataFrame, work: Workspace, payloads: bool = False) -> DataFrame:
    """Every record of the wanted captures (key, page_id), each pair once, by bisection of directory and blocks."""
    folders = work.path("index"), work.path("archives"), work.path("directory")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = None
        for batch in batches:
            keys, pages = (batch.column(c).to_pylist() for c in ("key", "page_id"))
            if not keys:
                continue
            found = found or Captures(*folders)
            found.near(keys[0], keys[-1])
            # Ranges are read in the order in which they lie in the archives.
            places = sorted(x for k, p in zip(keys, pages, strict=True) for x in found.find(k, p))
            yield _batch([r if payloads else (*r[:6], None) for r in map(found.read, places)], RECORDS)

    once = wanted.select("key", F.coalesce("page_id", F.lit(NO_PAGE)).alias("page_id")).distinct()
    return once.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id").mapInArrow(run, RECORDS)


def read_all(directory: DataFrame, work: Workspace, payloads: bool = False) -> DataFrame:
    """Every record by a walk over all blocks of the directory: for a copy of a whole archive, where nothing is searched."""
    archives, blocks = work.path("archives"), work.path("index")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, store = Ranges(blocks), Ranges(archives)
        for batch in batches:
            for place in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "size")), strict=True):
                # Within a block, ranges are read in the order in which they lie in the archives.
                got = (parse(gzip.decompress(store.read(*x[2:5]))) for x in sorted(block_lines(index, *place), key=lambda x: x[2:4]))
                yield _batch([r if payloads else (*r[:6], None) for r in got], RECORDS)

    # One row of the directory stands for many records: deal rows out evenly, whatever files they come from.
    return directory.repartition(work.spark.sparkContext.defaultParallelism * 2).mapInArrow(run, RECORDS)


def lookup(spark: SparkSession, directory: DataFrame, work: Workspace, url: str) -> list[tuple]:
    """All captures of a URL as rows of RECORDS."""
    found, key = Captures(work.path("index"), work.path("archives"), work.path("directory")), url_key(url)
    found.near(key, key)
    return [found.read(x) for x in found.find(key)]


def captures_of(work: Workspace) -> DataFrame:
    """CAPTURES of an archive that was written: what resolve() may be asked for."""
    return work.spark.read.parquet(work.path("captures"))


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], names=[n for n, _ in fields])


def archive(pages: DataFrame, least: int = 0) -> tuple[DataFrame, Workspace]:
    """Writes archives and index of pages(page_id, url, html); returns the directory and where the files are."""
    prepare_python(pages.sparkSession)
    work = Workspace(pages.sparkSession, "warc")
    captures = write(pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html"), work, least)
    return index(captures, work), work
