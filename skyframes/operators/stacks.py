"""Arrow passes over pictures: stacks of frames of one size, and images as runs.

A frame is a table row with its bytes (``data``, ``height``, ``width``). A pass takes the rows of a
record batch as stacks of frames of one size, so that small pictures share the cost of a call and a
large one is a stack of its own. A binary image is a table row, too, with its foreground as runs:
``start ARRAY<INT>`` (positions ``y * width + x``, ascending) and ``length ARRAY<INT>``; pixel rows
are made only where a result asks for them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframes.operators.kernels import flat_runs

RUNS = "start array<int>, length array<int>"
_PIXELS = 1 << 16  # few enough for the arrays of a kernel to stay in a core's cache


def numbered(batch: pa.RecordBatch, *names: str) -> tuple[np.ndarray, list[tuple]]:
    """A number for each row, the same for rows with the same values of the named columns, and the values of each number."""
    code = np.zeros(len(batch), np.int64)
    for name in names:
        part = batch.column(name).dictionary_encode("encode")
        code = code * (len(part.dictionary) + 1) + np.asarray(part.indices)
        code = np.unique(code, return_inverse=True)[1]
    first = pa.array(np.unique(code, return_index=True)[1])
    return code, list(zip(*(batch.column(c).take(first).to_pylist() for c in names)))


def _bytes_of(data: pa.Array, rows: np.ndarray, size: int) -> np.ndarray:
    """(rows, size) bytes of the given rows, none of which is null."""
    kind = np.int64 if pa.types.is_large_binary(data.type) else np.int32
    _, ends, held = data.buffers()
    ends = np.frombuffer(ends, kind)[data.offset : data.offset + len(data) + 1].astype(np.int64)
    begin = ends[:-1][rows]
    if (ends[1:][rows] - begin != size).any():
        raise ValueError(f"frames do not hold the {size} bytes of their size")
    if not size:
        return np.zeros((len(rows), 0), np.uint8)
    if not ((begin - begin[0]) % size).any():
        shift = int(begin[0] % size)
        whole = np.frombuffer(held, np.uint8)[shift:]
        whole = whole[: len(whole) // size * size].reshape(-1, size)
        return whole[(begin - shift) // size]
    return np.frombuffer(b"".join(v.as_buffer() for v in data.take(pa.array(rows))), np.uint8).reshape(-1, size)


def stacks(batch: pa.RecordBatch, most: int = _PIXELS, beside: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and (stack, H, W, 3) bytes of the frames of a batch, at most about `most` pixels at once.

    Rows without bytes are left out; bytes that do not fill the stated size are an error. Rows of equal
    numbers in `beside` come one after the other.
    """
    data = batch.column("data")
    high, wide = (np.asarray(batch.column(c).fill_null(0)).astype(np.int64) for c in ("height", "width"))
    real = np.flatnonzero(np.asarray(data.is_valid()))
    if beside is not None:
        real = real[np.argsort(beside[real], kind="stable")]
    for size in np.unique(np.stack([high[real], wide[real]], 1), axis=0):
        rows = real[(high[real] == size[0]) & (wide[real] == size[1])]
        step = max(1, most // max(1, int(size[0] * size[1])))
        for i in range(0, len(rows), step):
            some = rows[i : i + step]
            yield some, _bytes_of(data, some, int(size[0] * size[1] * 3)).reshape(len(some), *size, 3)


def lists(rows: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.ListArray:
    """A list of values for each of n rows; rows: ascending row number of each value."""
    ends = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values).cast(kind))


def listed(batch: pa.RecordBatch | pa.StructArray, rows: np.ndarray, *names: str) -> list[np.ndarray]:
    """Elements of list columns of the given rows: the place in `rows` of each, and its value in each column. The lists of a row are of one length."""
    column = batch.field if isinstance(batch, pa.StructArray) else batch.column
    columns = [column(c).take(pa.array(rows)) for c in names]
    place = np.repeat(np.arange(len(rows)), np.asarray(columns[0].value_lengths().fill_null(0)))
    return [place, *(np.asarray(c.flatten()).astype(np.int64) for c in columns)]


def run_lists(flags: np.ndarray) -> list[pa.ListArray]:
    """Columns start and length of a stack of binary images."""
    image, start, length = flat_runs(flags)
    return [lists(image, x, len(flags), pa.int32()) for x in (start, length)]


def arrow_pass(df: DataFrame, schema: str, function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]) -> DataFrame:
    """mapInArrow with a function of one batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from function(batch)

    return df.mapInArrow(run, schema)


def kept(df: DataFrame, *names: str) -> str:
    """These columns of a table as a schema text."""
    kinds = dict(df.dtypes)
    return ", ".join(f"`{n}` {kinds[n]}" for n in names)


def run_rows(images: DataFrame, *keys: str, values: dict[str, str] | None = None) -> DataFrame:
    """Pixel rows (keys, y, x and values) of runs; values: arrays with an element for each run."""
    values = values or {}
    arrays = [F.col("start"), F.col("length"), *[F.col(source).alias(name) for name, source in values.items()]]
    runs = images.select(*keys, F.col("width").alias("__wide"), F.inline(F.arrays_zip(*arrays)))
    each = runs.select(*keys, "__wide", *values, F.explode(F.sequence(F.col("start"), F.col("start") + F.col("length") - 1)).alias("pos"))
    return each.select(*keys, F.expr("pos div __wide").cast("int").alias("y"), (F.col("pos") % F.col("__wide")).alias("x"), *values)


def as_runs(images: DataFrame, pos: str = "pos") -> DataFrame:
    """Binary images with their foreground as runs instead of positions."""
    others = [c for c in images.columns if c != pos]

    def packed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        column = batch.column(pos)
        size = np.asarray(column.value_lengths().fill_null(0))
        row, at = np.repeat(np.arange(len(batch)), size), np.asarray(column.flatten()).astype(np.int64)
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) != 1) | (np.diff(row) != 0)
        first = np.flatnonzero(new)
        made = [lists(row[first], x, len(batch), pa.int32()) for x in (at[first], np.diff(np.append(first, len(at))))]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in others] + made, names=[*others, "start", "length"])

    return arrow_pass(images.select(*others, pos), f"{kept(images, *others)}, {RUNS}", packed)
