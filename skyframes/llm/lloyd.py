"""Product codes of vectors by Lloyd rounds in which members stay with their codebook entry.

A vector's components become integers floor(scale * x), and the vector is cut into consecutive
parts. For each part position a codebook of `entries` integer parts is fitted, and a vector's code
lists the nearest entry of each of its parts (squared Euclidean distance, ties to the lower index).

Member-resident rounds: a part is a row that lives with the owner of its (position, entry, salt).
Only the first shuffle moves all rows to their owners. After that, a round assigns an owner's
members to their nearest entries where they are, and only those whose entry changes go through the
next shuffle, to the owner of the new one. An owner updates from its resident members: it emits one
count and one sum for each entry, so an update merges a few numbers per task, and the new entries,
`parts` x `entries` small integer parts whatever the number of rows, go to every task. The salt
splits an entry among a quarter as many owners as there are shuffle partitions, so that even an
entry which holds every part of a position gives no task more than the average.

Residents are tables in the shared folder, so a lost executor costs one pass. The table that a
round replaces is removed.

Defined results: rows whose vector is null or holds a null, a NaN or an infinite component are
left out, as are empty vectors, vectors of another length than the smallest id's (least) vector, and
all rows if that length can't be cut evenly. An id of several rows starts at most one entry, with
its least vector by components; each of its rows is coded. Rows without id are coded and start no
entry (but without any id there are no entries, hence no rows). With fewer ids than `entries` the
codebooks are that small. An entry without members stays. Null labels count as equal. A component
beyond +-2^28 after scaling is an error, as distances would leave 64 bits. Input columns other
than id, vector and label are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from .tables import new_folder, removed, slices, stored

_MOST = 1 << 28  # distances of components up to here fit 64 bits
_EXACT = 1 << 22  # and up to here they fit the 53 bits of a double
_CHUNK = 4096


def whole_parts(vectors: pa.Array, scale: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Which vectors of a list array are kept, and their scaled integer components (kept, length)."""
    size = np.asarray(vectors.value_lengths().fill_null(-1))
    fits = np.flatnonzero(size == length)
    flat = vectors.take(pa.array(fits)).flatten()
    holes = np.asarray(flat.is_null())
    x = np.asarray(flat.fill_null(0).cast(pa.float64())).reshape(-1, length)
    good = np.isfinite(x).all(1) & ~holes.reshape(-1, length).any(1)
    x = np.floor(scale * x[good])
    if np.abs(x).max(initial=0) > _MOST:
        raise ValueError(f"a component exceeds {_MOST} after scaling by {scale}")
    return fits[good], x.astype(np.int64)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lowest index of the nearest row of `book` for each row of x, and the squared distance; exact."""
    at, far = np.empty(len(x), np.int64), np.empty(len(x), np.int64)
    exact = max(np.abs(x).max(initial=0), np.abs(book).max(initial=0)) <= _EXACT and x.shape[1] <= 1 << 5
    step = _CHUNK if exact else max(1, _CHUNK // max(1, x.shape[1]))
    for start in range(0, len(x), step):
        some = x[start : start + step]
        if exact:
            a, b = some.astype(float), book.astype(float)
            d = (a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)
        else:
            d = np.square(some[:, None, :] - book).sum(2)
        best = d.argmin(1)
        at[start : start + step], far[start : start + step] = best, d[np.arange(len(some)), best]
    return at, far


def updated(books: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Each entry's floor of the mean of its members; an entry without members stays."""
    return np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], books)


def _flat(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64).reshape(-1, width)


def _by_position(batch: pa.RecordBatch, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and distance of each row of a batch of parts."""
    position = np.asarray(batch.column("position"))
    x = _flat(batch.column("part"), books.shape[2])
    at, far = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
    for p in np.unique(position):
        here = np.flatnonzero(position == p)
        at[here], far[here] = nearest(x[here], books[p])
    return at, far


def _first_books(rows: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray | None:
    """(parts, entries, width): the parts of the smallest ids' vectors; None without any."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = rows.filter("v is not null and id is not null and size(v) > 0").filter(~bad)
    least = good.agg(F.min("id")).first()[0]
    if least is None:
        return None
    length = len(good.filter(F.col("id") == F.lit(least)).agg(F.min("v")).first()[0])
    if length % parts:
        return None
    good = good.filter(F.size("v") == length)
    ids = good.select("id").distinct().orderBy("id").limit(entries)
    scaled = good.join(F.broadcast(ids), "id").select("id", F.transform("v", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    found = sorted(tuple(r) for r in scaled.groupBy("id").agg(F.min("v")).collect())
    first = np.array([v for _, v in found], np.int64)
    return np.stack(np.split(first, parts, axis=1))


def _salts(partitions: int) -> int:
    return max(1, -(-partitions // 4))


def residents(rows: DataFrame, books: np.ndarray, scale: int) -> DataFrame:
    """A row per kept row and position with its nearest entry; id and label go with position 0 only."""
    parts, _, width = books.shape
    kinds = dict(rows.dtypes)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, _CHUNK):
            kept, x = whole_parts(b.column("v"), scale, parts * width)
            own = b.take(pa.array(kept))
            for p in range(parts):
                part = x[:, p * width : (p + 1) * width]
                none = np.full(len(kept), p > 0)
                yield pa.RecordBatch.from_arrays([
                    own.column("row"), pa.array(np.full(len(kept), p, np.int32)), pa.array(nearest(part, books[p])[0].astype(np.int32)),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1, dtype=np.int32) * width), pa.array(part.ravel().astype(np.int32))),
                    *[pa.array(own.column(c).to_pylist(), own.column(c).type, mask=none) if p else own.column(c) for c in ("id", "label")],
                ], names=["row", "position", "entry", "part", "id", "label"])

    return rows.mapInArrow(split, f"row bigint, position int, entry int, part array<int>, id {kinds['id']}, label {kinds['label']}")


def _owned(rows: DataFrame, partitions: int) -> DataFrame:
    """Rows moved to the owner of their (position, entry, salt)."""
    salt = F.pmod(F.xxhash64("row"), F.lit(_salts(partitions)))
    return rows.repartition(partitions, "position", "entry", salt)


def member_sums(members: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Counts (parts, entries) and sums (parts, entries, width) of resident members: one row per task and entry is merged."""

    def update(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(shape[:2], np.int64), np.zeros(shape, np.int64)
        for b in batches:
            at = np.asarray(b.column("position")), np.asarray(b.column("entry"))
            np.add.at(counts, at, 1)
            np.add.at(sums, at, _flat(b.column("part"), shape[2]))
        p, e = np.nonzero(counts)
        lists = [[int(n), *map(int, s)] for n, s in zip(counts[p, e], sums[p, e])]
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(lists, pa.list_(pa.int64()))], names=["position", "entry", "sums"])

    made = members.select("position", "entry", "part").mapInArrow(update, "position int, entry int, sums array<bigint>")
    each = made.select("position", "entry", F.posexplode("sums").alias("i", "x")).groupBy("position", "entry", "i").agg(F.sum("x").alias("x"))
    counts, sums = np.zeros(shape[:2], np.int64), np.zeros(shape, np.int64)
    for r in each.collect():  # as many numbers as the codebooks have
        if r["i"]:
            sums[r["position"], r["entry"], r["i"] - 1] = r["x"]
        else:
            counts[r["position"], r["entry"]] = r["x"]
    return counts, sums


def _judged(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("moved", BooleanType())])


def _round(members: DataFrame, books: np.ndarray, path: str) -> None:
    """Assign resident members and write them, those that change their entry apart."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, _ = _by_position(b, books)
            moved = at != np.asarray(b.column("entry"))
            columns = {n: b.column(n) for n in b.schema.names} | {"entry": pa.array(at, pa.int32()), "moved": pa.array(moved)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    members.mapInArrow(assign, _judged(members.schema)).write.partitionBy("moved").parquet(path)


def fitted(rows: DataFrame, parts: int, entries: int, rounds: int, scale: int) -> tuple[DataFrame, np.ndarray | None]:
    """Resident members after the last round, and the final codebooks; rows: row, id, label, v."""
    spark = rows.sparkSession
    books = _first_books(rows, parts, entries, scale)
    if books is None:
        return rows, None
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    old = [new_folder(spark, "residents")]
    _owned(residents(rows, books, scale), n).write.parquet(old[0])
    members = spark.read.parquet(old[0])
    schema = members.schema
    for r in range(rounds):
        books = updated(books, *member_sums(members, books.shape))
        if r + 1 == rounds:
            break
        path, come = new_folder(spark, "members"), new_folder(spark, "movers")
        _round(members, books, path)
        judged = spark.read.schema(_judged(schema)).parquet(path)
        _owned(judged.filter("moved").drop("moved"), n).write.parquet(come)
        members = judged.filter("not moved").drop("moved").unionByName(spark.read.schema(schema).parquet(come))
        removed(spark, *old)
        old = [path, come]
    return members, books


def encoded(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024,
    vector: str = "embedding", vec_id: str = "vec_id", label: str = "label",
) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of each kept row.

    code: two hex digits for each part; error: sum of the parts' squared distances to their entries.
    """
    spark = vectors.sparkSession
    if not 0 < entries <= 256:
        raise ValueError("a code has two hex digits for each part, so there are 1 to 256 entries")
    kinds = dict(vectors.dtypes)
    # a table of its own: row numbers stay as they are once they are written
    rows = stored(vectors.select(F.monotonically_increasing_id().alias("row"), F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v")), "vectors")
    members, books = fitted(rows, parts, entries, rounds, scale)
    if books is None:
        none = f"vec_id {kinds[vec_id]}, label {kinds[label]}, code string, error bigint, label_error bigint, codebooks_sha256 string"
        return spark.createDataFrame([], none)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, far = _by_position(b, books)
            yield pa.RecordBatch.from_arrays([b.column("row"), b.column("position"), pa.array(at, pa.int32()), pa.array(far), b.column("id"), b.column("label")], names=["row", "position", "entry", "far", "id", "label"])

    final = members.mapInArrow(measure, f"row bigint, position int, entry int, far bigint, id {kinds[vec_id]}, label {kinds[label]}")
    digits = [F.max(F.when(F.col("position") == p, F.lower(F.lpad(F.hex("entry"), 2, "0")))) for p in range(parts)]
    coded = stored(
        final.groupBy("row").agg(F.max("id").alias("vec_id"), F.max("label").alias("label"), F.concat(*digits).alias("code"), F.sum("far").alias("error")).drop("row"), "codes"
    )
    totals = stored(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"), "label-errors")
    text = ",".join(map(str, books.ravel().tolist()))
    return (
        coded.join(totals, F.col("label").eqNullSafe(F.col("_label")), "left").drop("_label")
        .withColumn("codebooks_sha256", F.lit(sha256(text.encode()).hexdigest()))
    )
