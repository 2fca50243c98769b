"""Edge pixels of frames (Canny 1986): smooth, differentiate, thin, link by hysteresis."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframes.operators import kernels, stencil
from skyframes.operators.stacks import RUNS, arrow_pass, kept, run_lists, stacks


def smoothed(images: DataFrame, *keys: str) -> DataFrame:
    """Flat smoothed grey image: keys, height, width, smooth."""
    return stencil.smooth_luma(images, *keys)


def ridges(images: DataFrame, *keys: str) -> DataFrame:
    """Thinned gradient: keys, height, width, ridge (pos, mag)."""
    return stencil.ridge_pixels(images, *keys).select(*keys, "height", "width", F.struct("pos", "mag").alias("ridge"))


def edge_flags(bgr: np.ndarray, low: int, high: int) -> np.ndarray:
    """8-connected ridges above `low` that somewhere exceed `high`, for each frame of a stack."""
    smooth = kernels.smooth(kernels.grey(bgr)).astype(np.int16)  # magnitudes are at most 2040
    return kernels.linked_edges(kernels.ridges(*kernels.derivatives(smooth), low), low, high)


def edge_images(images: DataFrame, *keys: str, low: int = 100, high: int = 200) -> DataFrame:
    """Edges of each frame as runs: keys, height, width, start, length. Ridges are linked in the pass that finds them."""
    named = [*keys, "height", "width"]

    def find(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for rows, bgr in stacks(batch):
            own = batch.select(named).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*(own.column(c) for c in named), *run_lists(edge_flags(bgr, low, high))], names=[*named, "start", "length"])

    return arrow_pass(images.select(*named, "data"), f"{kept(images, *named)}, {RUNS}", find)
