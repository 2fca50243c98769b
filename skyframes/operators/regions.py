"""Regions of binary images: components, hole filling, largest regions.

Labels are found per image on its runs, inside the task that holds the image; a loop of
distributed min-label joins would shuffle every run of every image once per round for
components that never leave their image. Ranking and cutting stay array expressions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframes.operators.kernels import components as connected_runs
from skyframes.operators.stencil import frame_positions, image_udf, position_rows, run_steps

_INTS = T.ArrayType(T.IntegerType())
_LONGS = T.ArrayType(T.LongType())
_PARTS = T.StructType(
    [T.StructField("pos", _INTS), T.StructField("label", _INTS), T.StructField("total", _LONGS)]
)


def components(pos: Column, *steps, connectivity: int = 8) -> Column:
    """Struct of aligned arrays (pos, label, total) of the foreground after the given steps.

    label: smallest position of the component. total: its pixel count.
    """
    reach = {8: 1, 4: 0}[connectivity]

    @image_udf(_PARTS)
    def label(pos: pd.Series, height: pd.Series, width: pd.Series) -> pd.DataFrame:
        found = []
        for at, high, wide in zip(pos, height, width):
            image, top, left = run_steps(at, high, wide, steps)
            start, length, part = connected_runs(image, reach)
            part = part[np.repeat(np.arange(len(start)), length)]
            total = np.zeros(len(start), np.int64)
            np.add.at(total, part, 1)
            place = (image.shape[1], top, left, wide)
            found.append((frame_positions(np.flatnonzero(image), *place), frame_positions(start, *place)[part], total[part]))
        return pd.DataFrame(found, columns=["pos", "label", "total"])

    return label(pos, "height", "width")


def component_rows(images: DataFrame, parts: str, *keys: str) -> DataFrame:
    """Pixel rows (keys, y, x, label, area) of labelled images."""
    return position_rows(
        images, f"{parts}.pos", *keys, values={"label": f"{parts}.label", "area": f"{parts}.total"}
    )


def ranking(parts: Column) -> Column:
    """Components of an image as structs (area, order), largest first, ties by smallest label."""
    pairs = F.arrays_zip(parts.getField("total").alias("total"), parts.getField("label").alias("label"))
    firsts = F.filter(F.arrays_zip(pairs.alias("c"), parts.getField("pos").alias("pos")), lambda p: p.pos == p.c.label)
    return F.sort_array(
        F.transform(firsts, lambda p: F.struct(p.c.total.alias("area"), (-p.c.label).alias("order"))), asc=False
    )


def ranked_regions(images: DataFrame, parts: str, top: Column, min_area: Column | None, *keys: str) -> DataFrame:
    """Pixel rows (keys, y, x, area, region, n_regions) of the `top` largest components.

    region is the rank from 1, n_regions the number of regions of the image.
    """
    chosen = F.slice(ranking(F.col(parts)), F.lit(1), top)
    if min_area is not None:
        chosen = F.filter(chosen, lambda c: c.area >= min_area)
    keyed = images.withColumn("__chosen", chosen).withColumn("n_regions", F.size("__chosen"))
    place = F.array_position(F.col("__chosen"), F.struct(F.col("area"), (-F.col("label")).alias("order")))
    return (
        component_rows(keyed, parts, *keys, "__chosen", "n_regions")
        .withColumn("region", place.cast("int"))
        .where("region > 0")
        .drop("__chosen", "label")
    )
