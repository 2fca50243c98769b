"""WARC archives: a splittable writer with revisit records, and a reader that verifies boundaries.

Writing: one record for each row, through Spark's text writer with the record separator as its line
separator, so files are committed as Spark commits. Equal payloads of at least `least` bytes are
kept once: the row of the smallest id holds the payload, the others are revisits that refer to it.

Reading: every file is cut into blocks that tasks read on their own. Magic text in a block is only
a candidate for a record's start, as payloads may hold it too. Each task emits its candidates with
the offset where the candidate's successor must start; runs inside a block are followed at once, so
each candidate points to its first successor outside of the block, or to where its chain breaks.
Pointer jumping from offset 0 of every file then doubles the reach in each round, so as many rounds
as the logarithm of the blocks per file suffice, and only records that are reached exist. The last
pass reads each block that is reached once, in order.

A header may have any length: a task reads on beyond its block until the header's blank line. The
number of tasks follows from the bytes, not from the few bytes of the block table.

Defined results: a null payload is an empty one; a null id is a response of its own; equal rows are
all written; line breaks and blanks in a URL are written as %20; a null URL is left out. A chain
breaks where no record starts or where a record claims more bytes than the file has; `broken` lists
such files with the offset. `read` raises if there are any, or, if not `strict`, gives all records
before the breaks. An empty file or table gives no record.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import closing
from functools import lru_cache

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import new_folder, stored

# fixed values of the format
MAGIC = b"WARC/1.0\r\n"
_STOP = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

_AHEAD = 1 << 16  # bytes read at once beyond a block
_TASK = 1 << 27  # bytes of archives for a task, where there are more than the session has partitions for
RECORD = (
    "file string, offset bigint, record_type string, record_id string, target_uri string, payload_digest string, "
    "refers_to string, payload_length bigint, payload binary"
)


def revisits(pages: DataFrame, payload: str, page_id: str, least: int = 100) -> DataFrame:
    """(_id, _digest, _first) of the rows that repeat the payload of a smaller id."""
    known = pages.filter(F.octet_length(payload) >= least).filter(F.col(page_id).isNotNull()).select(
        F.col(page_id).alias("_id"), F.sha2(F.col(payload).cast("binary"), 256).alias("_digest")
    )
    # a table of its own, so that the join with it can split the digest of many copies
    firsts = stored(known.groupBy("_digest").agg(F.min("_id").alias("_first"), F.max("_id").alias("_last")).filter("_first < _last").drop("_last"), "firsts")
    return known.join(firsts, "_digest").filter("_id > _first").groupBy("_id", "_digest").agg(F.first("_first").alias("_first"))


def _line(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def _urn(value: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), value.cast("string"), F.lit(">"))


def write(pages: DataFrame, folder: str, payload: str = "html", page_id: str = "page_id", url: str = "url", least: int = 100, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write a WARC record for each row into new files of a folder."""
    rows = pages.select(F.col(page_id).alias("_id"), F.col(url).alias("_url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("_body"))
    # a table of its own: its size is known then, and the payloads are moved only if it is large
    again = stored(revisits(rows, "_body", "_id", least), "revisits")
    rows = rows.withColumn("_digest", F.sha2(F.col("_body").cast("binary"), 256)).join(again, ["_id", "_digest"], "left")
    twin = F.col("_first").isNotNull()
    block = F.concat(F.lit(_HTTP), F.when(twin, "").otherwise(F.col("_body")))
    head = F.concat(
        F.lit(MAGIC.decode()),
        F.lit("WARC-Type: "), F.when(twin, "revisit").otherwise("response"), F.lit("\r\n"),
        _line("WARC-Record-ID", F.coalesce(_urn(F.col("_id")), F.lit("<urn:page:>"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.regexp_replace("_url", r"[\x00-\x20\x7f]", "%20")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "_digest")),
        _line("X-Payload-Length", F.octet_length("_body").cast("string")),
        _line("WARC-Refers-To", _urn(F.col("_first"))),
        _line("WARC-Profile", F.when(twin, _PROFILE)),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
    )
    rows.select(F.concat(head, block).alias("value")).write.option("lineSep", _STOP.decode()).text(folder)


@lru_cache(8)
def _store(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def _open(uri: str) -> pa.NativeFile:
    """A file of any store that Arrow reads, named as Spark names it."""
    uri = re.sub("^s3[an]://", "s3://", re.sub("^file:/+", "file:///", uri))
    top = uri[: uri.rindex("/")]
    store, folder = _store(top)
    return store.open_input_file(f"{folder}/{uri[len(top) + 1 :]}")


class Window:
    """Bytes of an open file from `base` on, read in order and widened as needed."""

    def __init__(self, f: pa.NativeFile, base: int, length: int):
        self.f, self.base, self.length, self.raw = f, base, length, b""
        f.seek(base)

    def hold(self, stop: int) -> bool:
        """Read on until the bytes before `stop` are held; False if the file ends before."""
        missing = min(stop, self.length) - self.base - len(self.raw)
        if missing > 0:
            left = self.length - self.base - len(self.raw)
            self.raw += self.f.read(min(left, max(missing, _AHEAD)))
        return stop <= self.length

    def forget(self, before: int) -> None:
        if before - self.base > 1 << 22:
            self.raw, self.base = self.raw[before - self.base :], before

    def find(self, what: bytes, at: int, stop: int | None = None) -> int:
        """Offset of the first `what` at or after `at` (and before `stop`), reading on if need be; -1 without."""
        while True:
            found = self.raw.find(what, at - self.base, None if stop is None else stop - self.base + len(what) - 1)
            if found >= 0:
                return self.base + found
            held = self.base + len(self.raw)
            if held >= (self.length if stop is None else min(self.length, stop + len(what) - 1)):
                return -1
            at = max(at, held - len(what) + 1)
            self.hold(held + max(_AHEAD, len(self.raw)))


def _header(w: Window, at: int) -> tuple[int, dict[str, str]] | None:
    """The offset after a record's header with its blank line, and its fields; None if no header starts at `at`."""
    w.hold(at + len(MAGIC))
    start = at - w.base
    if not w.raw.startswith(MAGIC, start) or (end := w.find(_STOP, at + len(MAGIC) - 2)) < 0:
        return None
    raw = w.raw[start : end - w.base]
    if b"\r\n" + MAGIC in raw:  # no line of a header is the magic one
        return None
    fields = {}
    for line in raw[len(MAGIC) :].decode("utf-8", "replace").split("\r\n"):
        name, colon, value = line.partition(":")
        if colon:
            fields[name.strip().lower()] = value.strip()
    return (end + len(_STOP), fields) if fields.get("content-length", "").isdecimal() else None


def _record(w: Window, at: int) -> tuple[int, int, dict[str, str]] | None:
    """Where the record at `at` has its body and its successor, and its fields; None if no whole record starts there."""
    if (head := _header(w, at)) is None:
        return None
    to = head[0] + int(head[1]["content-length"]) + len(_STOP)
    return (head[0], to, head[1]) if to <= w.length else None


def successors(w: Window, start: int, stop: int) -> dict[int, int]:
    """Where the record at each candidate offset in [start, stop) ends."""
    out, at = {}, w.find(MAGIC, start, stop)
    while at >= 0:
        if found := _record(w, at):
            out[at] = found[1]
        at = w.find(MAGIC, at + 1, stop)
    return out


def exits(ends: dict[int, int], stop: int) -> dict[int, int]:
    """The first successor of each candidate at or after `stop`, or the offset in the block at which its chain breaks."""
    out: dict[int, int] = {}
    for at in sorted(ends, reverse=True):
        out[at] = out.get(ends[at], ends[at]) if ends[at] < stop else ends[at]
    return out


def blocks(spark: SparkSession, folder: str, size: int) -> DataFrame:
    """(file, length, start, stop) of the blocks of all non-empty files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(F.col("path").alias("file"), "length")
    cut = files.filter("length > 0").withColumn("start", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(size).cast("bigint"))))
    return cut.withColumn("stop", F.least(F.col("start") + size, F.col("length")))


def _tasks(spark: SparkSession, blocks: int, length: int) -> int:
    return max(1, min(blocks, max(int(spark.conf.get("spark.sql.shuffle.partitions")), length // _TASK)))


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for file, length, start, stop in zip(*(c.to_pylist() for c in b.columns)):
            with closing(_open(file)) as f:
                w = Window(f, start, length)
                w.hold(stop)
                found = exits(successors(w, start, stop), stop)
            yield pa.RecordBatch.from_arrays([pa.array([file] * len(found), pa.string()), pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["file", "at", "to"])


def reached(spark: SparkSession, folder: str, size: int = 1 << 23) -> tuple[DataFrame, DataFrame, int]:
    """Blocks, the (file, at) where a chain from the file's start enters a block, breaks or ends the file, and a number of tasks."""
    cut = stored(blocks(spark, folder, size), "blocks")
    known = cut.groupBy("file").agg(F.count("*").alias("n"), F.max("length").alias("length")).agg(F.max("n"), F.sum("n"), F.sum("length")).first()
    most, tasks = known[0] or 0, _tasks(spark, known[1] or 0, known[2] or 0)
    spread = cut.repartition(tasks, "file", "start")
    edges = stored(spread.select("file", "length", "start", "stop").mapInArrow(_candidates, "file string, at bigint, to bigint"), "candidates")
    heads = cut.select("file", F.lit(0).cast("bigint").alias("at")).distinct()
    entries = edges.select("file", F.col("to").alias("at")).union(heads).distinct()
    jump = stored(edges.join(entries, ["file", "at"], "left_semi"), "jumps")
    reach = heads
    for _ in range(max(1, most).bit_length()):
        ahead = reach.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reach = stored(reach.union(ahead).distinct(), "reach")
        further = jump.select("file", F.col("at").alias("to"), F.col("to").alias("_to"))
        # a pointer that ends its file or breaks has nowhere to go and is needed no more
        jump = stored(jump.join(further, ["file", "to"]).select("file", "at", F.col("_to").alias("to")), "jumps")
    return cut, reach, tasks


def broken(cut: DataFrame, reach: DataFrame) -> DataFrame:
    """(file, length, at) of the files whose chain does not end where the file ends, and where it breaks."""
    last = reach.groupBy("file").agg(F.max("at").alias("at"))
    return cut.select("file", "length").distinct().join(last, "file").filter("at != length")


def _urn_value(value: str | None) -> str | None:
    return value.removeprefix("<urn:page:").removesuffix(">") or None if value else None


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RECORD.split(", ")]
    types = [{"string": pa.string(), "bigint": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in RECORD.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), types)], names=names)

    rows, held = [], 0
    for b in batches:
        for file, length, at, stop in zip(*(c.to_pylist() for c in b.columns)):
            with closing(_open(file)) as f:
                w = Window(f, at, length)
                w.hold(stop)
                # a block that a broken chain enters ends with the break
                while at < stop and (found := _record(w, at)):
                    start, to, fields = found
                    w.hold(to)
                    body = w.raw[start - w.base : to - len(_STOP) - w.base]
                    if fields.get("content-type", "").startswith("application/http"):
                        body = body.partition(_STOP)[2]
                    known = fields.get("x-payload-length", "")
                    rows.append((
                        file, at, fields.get("warc-type"), _urn_value(fields.get("warc-record-id")), fields.get("warc-target-uri"),
                        fields.get("warc-payload-digest"), _urn_value(fields.get("warc-refers-to")), int(known) if known.isdecimal() else None, body,
                    ))
                    held += len(body) + 500
                    at = to
                    w.forget(at)
                    if held > 1 << 22:
                        yield batch(rows)
                        rows, held = [], 0
    if rows:
        yield batch(rows)


def read(spark: SparkSession, folder: str, size: int = 1 << 23, strict: bool = True) -> DataFrame:
    """The records (RECORD) of all archives under a folder."""
    cut, reach, tasks = reached(spark, folder, size)
    if strict and (bad := broken(cut, reach).limit(5).collect()):
        raise ValueError("archives break: " + ", ".join(f"{r['file']} of {r['length']} bytes at {r['at']}" for r in bad))
    own = reach.withColumn("start", F.col("at") - F.col("at") % size)
    starts = cut.join(own, ["file", "start"]).select("file", "length", "at", "stop")
    return starts.repartition(tasks, "file", "at").mapInArrow(_records, RECORD)


def round_trip(pages: DataFrame, folder: str | None = None, size: int = 1 << 23, **columns) -> DataFrame:
    """Write pages as archives and read them back."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    write(pages, folder, **columns)
    return read(pages.sparkSession, folder, size)
