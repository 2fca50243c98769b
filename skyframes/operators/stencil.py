"""Neighbourhood operators on images, all narrow: no shuffle and no sort.

Two image columns are used, one image per table row as the image source delivers them:

* ``data BINARY`` with ``height`` and ``width``: B, G, R bytes, row by row;
* ``pos ARRAY<INT>`` with ``height`` and ``width``: a binary image as the ascending
  positions ``y * width + x`` of its foreground.

Built-in lambdas over arrays cost microseconds per pixel (they are interpreted), and a
row per neighbour pixel costs a shuffle of 13 rows per pixel. The kernels therefore run
on Arrow batches inside the task that already holds the image. A table row is bounded by
one camera frame; Arrow batches are bounded by `spark.sql.execution.arrow.maxBytesPerBatch`, and
what a task makes of one goes back in pieces, so its memory does not grow with the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframes.functions import color
from skyframes.operators.kernels import derivatives, grey, ridges, smooth, sweep
from skyframes.operators.stacks import arrow_pass, kept, lists, stacks

_INTS = T.ArrayType(T.IntegerType())
_PIXELS = 1 << 18  # of a batch that goes back to Spark


def image_udf(result: T.DataType):
    """Arrow function over images. Marked nondeterministic so that Catalyst never runs it twice per row."""
    return lambda fn: F.pandas_udf(fn, result).asNondeterministic()


def run_steps(pos: np.ndarray, height: int, width: int, steps: tuple) -> tuple[np.ndarray, int, int]:
    """Binary image after the steps, cut to the part of the frame that can hold foreground, and its corner.

    One ring of background more than the steps can grow into stays around the foreground
    wherever the frame goes on, so erosion and filling see what they would see in the frame.
    """
    if len(pos) == 0:
        return np.zeros((1, 1), bool), 0, 0
    y, x = np.divmod(pos, width)
    margin = 1 + sum(getattr(step, "reach", 0) for step in steps)
    top, left = max(int(y.min()) - margin, 0), max(int(x.min()) - margin, 0)
    bottom, right = min(int(y.max()) + margin, height - 1), min(int(x.max()) + margin, width - 1)
    image = np.zeros((bottom - top + 1, right - left + 1), bool)
    image[y - top, x - left] = True
    for step in steps:
        image = step(image)
    return image, top, left


def frame_positions(local: np.ndarray, wide: int, top: int, left: int, width: int) -> np.ndarray:
    """Positions in the frame of positions in a cut-out of the given width and corner."""
    y, x = np.divmod(local, wide)
    return (y + top) * width + x + left


def smooth_luma(images: DataFrame, *keys: str) -> DataFrame:
    """Bilaterally smoothed grey values, flat: keys, height, width, smooth."""
    named = [*keys, "height", "width"]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for rows, bgr in stacks(batch):
            own = batch.take(pa.array(rows))
            values = smooth(grey(bgr)).reshape(len(rows), -1)
            found = lists(np.repeat(np.arange(len(rows)), values.shape[1]), values.ravel(), len(rows), pa.int32())
            yield pa.RecordBatch.from_arrays([*(own.column(c) for c in named), found], names=[*named, "smooth"])

    return arrow_pass(images.select(*named, "data"), f"{kept(images, *named)}, smooth array<int>", run)


def ridge_pixels(images: DataFrame, *keys: str) -> DataFrame:
    """Ridges of the gradient of the smoothed grey image: keys, height, width, pos and mag (positions and magnitudes)."""
    named = [*keys, "height", "width"]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for rows, bgr in stacks(batch):
            own = batch.take(pa.array(rows))
            mag = ridges(*derivatives(smooth(grey(bgr)))).reshape(len(rows), -1)
            row, pos = np.nonzero(mag)
            found = [lists(row, x, len(rows), pa.int32()) for x in (pos, mag[row, pos])]
            yield pa.RecordBatch.from_arrays([*(own.column(c) for c in named), *found], names=[*named, "pos", "mag"])

    return arrow_pass(images.select(*named, "data"), f"{kept(images, *named)}, pos array<int>, mag array<int>", run)


def erode(size: int):
    """Step: keep foreground whose whole size x size window, clipped at the border, is foreground."""
    return lambda image: sweep(image, size, np.minimum)


def dilate(size: int):
    """Step: add pixels with foreground in their size x size window."""
    def step(image: np.ndarray) -> np.ndarray:
        return sweep(image, size, np.maximum)

    step.reach = size // 2
    return step


def reshape(pos: Column, *steps) -> Column:
    """Positions after the given steps on the binary image, all in one pass over Arrow batches."""

    @image_udf(_INTS)
    def run(pos: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
        found = []
        for at, high, wide in zip(pos, height, width):
            image, top, left = run_steps(at, high, wide, steps)
            found.append(frame_positions(np.flatnonzero(image), image.shape[1], top, left, wide))
        return pd.Series(found)

    return run(pos, "height", "width")


def _pieces(sizes: np.ndarray, most: int) -> Iterator[slice]:
    """Rows one after the other, of at most about `most` together; a row is never cut."""
    part = (np.cumsum(sizes) - sizes) // most
    ends = [*np.flatnonzero(np.diff(part)) + 1, len(sizes)]
    return (slice(a, b) for a, b in zip([0, *ends], ends) if b > a)


def packed_pixels(images: DataFrame, *keys: str) -> DataFrame:
    """Pixels of B, G, R bytes as one INT each (see `skyframes.functions.color`): keys, width, bgr."""
    named = [*keys, "width"]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = np.asarray(pc.binary_length(batch.column("data")).fill_null(0)).astype(np.int64)
        if (sizes % 3).any():
            raise ValueError("frames do not hold 3 bytes a pixel")
        for some in _pieces(sizes, 3 * _PIXELS):
            own = batch.slice(some.start, some.stop - some.start)
            raw = b"".join(v.as_buffer() for v in own.column("data") if v.is_valid)
            p = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
            row = np.repeat(np.arange(len(own)), sizes[some] // 3)
            found = lists(row, p[:, 0] << 16 | p[:, 1] << 8 | p[:, 2], len(own), pa.int32())
            yield pa.RecordBatch.from_arrays([*(own.column(c) for c in named), found], names=[*named, "bgr"])

    return arrow_pass(images.select(*named, "data"), f"{kept(images, *named)}, bgr array<int>", run)


def pixel_rows(images: DataFrame, *keys: str) -> DataFrame:
    """One row per pixel of ``data``: keys, y, x, b, g, r."""
    p = F.col("bgr")
    return (
        packed_pixels(images, *keys)
        .select(*keys, F.col("width").alias("__wide"), F.posexplode("bgr").alias("pos", "bgr"))
        .select(*keys, *_place(), color.blue(p).alias("b"), color.green(p).alias("g"), color.red(p).alias("r"))
    )


def _place() -> list[Column]:
    return [F.expr("pos div __wide").cast("int").alias("y"), (F.col("pos") % F.col("__wide")).alias("x")]


def value_rows(images: DataFrame, values: str, *keys: str) -> DataFrame:
    """One row per element of a flat image column: keys, y, x, v."""
    return images.select(*keys, F.col("width").alias("__wide"), F.posexplode(values).alias("pos", "v")).select(
        *keys, *_place(), "v"
    )


def position_rows(images: DataFrame, pos: str, *keys: str, values: dict[str, str] | None = None) -> DataFrame:
    """One row per listed position: keys, y, x and any arrays aligned with the positions."""
    values = values or {}
    arrays = [F.col(pos).alias("pos"), *[F.col(source).alias(name) for name, source in values.items()]]
    return images.select(*keys, F.col("width").alias("__wide"), F.inline(F.arrays_zip(*arrays))).select(
        *keys, *_place(), *values
    )


def pack(pixels: DataFrame, *keys: str) -> DataFrame:
    """Foreground pixel rows to one binary image per key: keys, height, width, pos.

    An image has H*W positions and (keys, y, x) is unique, so a group is never larger than
    one frame, however many frames were counted into it. The partition count is stated:
    the images go on to Arrow functions, where work per byte is high, and merging partitions
    by their few bytes would leave most cores idle. It is the session's shuffle partition count.
    """
    parts = int(pixels.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    image = [*keys, "height", "width"]
    return pixels.select(*image, "y", "x").repartition(parts, *keys).groupBy(*image).agg(
        F.array_sort(F.collect_list((F.col("y") * F.col("width") + F.col("x")).cast("int"))).alias("pos")
    )
