"""Sun discs: sun-like pixels under a mask, their region, its circle, and acceptance."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframes.operators import kernels
from skyframes.operators.mask import beside_pictures, masks_by_day, sights
from skyframes.operators.stacks import RUNS, arrow_pass, kept, numbered, run_lists, stacks

SIGHT = ("frame_id", "device_id", "mask_day", "height", "width")
_PIXELS = 1 << 16  # of pictures at once; each has up to three masks


def _cut(stack: np.ndarray, margin: int) -> tuple[slice, slice]:
    """Rows and columns that hold all foreground of a stack, and a margin where the image goes on."""
    out = []
    for axis, size in ((2, stack.shape[1]), (1, stack.shape[2])):
        hit = np.flatnonzero(stack.any((0, axis)))
        out.append(slice(max(0, hit[0] - margin), min(size, hit[-1] + 1 + margin)) if len(hit) else slice(0, 1))
    return out[0], out[1]


def _boxes(stack: np.ndarray) -> np.ndarray:
    """top, bottom, left and right (ends excluded) of the foreground of each image, a column each; every image has some."""
    out = []
    for axis in (2, 1):
        hit = stack.any(axis)
        out += [hit.argmax(1), hit.shape[1] - hit[:, ::-1].argmax(1)]
    return np.stack(out)


def largest_regions(spots: np.ndarray, size: int) -> np.ndarray:
    """For each image the largest region of its eroded and filled pixels, grown and filled again."""
    window = 0, *_cut(spots, size // 2 + 1)
    part = spots[:, window[1], window[2]]
    part = kernels.largest_each(kernels.fill_each(kernels.sweep(part, size, np.minimum)))
    part = kernels.largest_each(kernels.fill_each(kernels.sweep(part, size, np.maximum)))
    out = np.zeros(spots.shape, bool)
    out[:, window[1], window[2]] = part
    return out


def _sights(images: DataFrame, mask: DataFrame, only: DataFrame | None) -> DataFrame:
    """Pictures with the masks that serve their day, of the frames in `only` (frame_id, mask_day) if given.

    Stored frames are picked by lists that go to the slice of a day with the masks, others by a semi join.
    """
    masks = masks_by_day(mask)
    if only is None:
        return beside_pictures(images, masks, "frame_id")
    wanted = only.select("frame_id", "mask_day").distinct()
    if "slice" not in images.columns:
        return beside_pictures(images.join(wanted, "frame_id", "left_semi"), masks, "frame_id")
    place = ["device_id", "day", "height", "width"]
    lists = images.select("frame_id", *place, "slice").join(wanted, "frame_id", "left_semi").groupBy(*place, "slice").agg(F.collect_set("frame_id").alias("__frames"))
    beside = lists.join(masks, place).hint("shuffle_hash")
    return images.join(beside, [*place, "slice"]).where(F.array_contains("__frames", F.col("frame_id")))


def _each_sight(images: DataFrame, mask: DataFrame, only: DataFrame | None, limit: int, size: int, schema: str, made) -> DataFrame:
    """One row per frame and mask with a sun-like region: SIGHT and what `made` gives for stacks of regions and mask images."""
    names = [*SIGHT, *[c.split()[0] for c in schema.split(", ")]]

    def look(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        drawn: dict[tuple, tuple] = {}
        for rows, bgr in stacks(batch, _PIXELS, numbered(batch, "device_id", "day")[0]):
            place, days, under = sights(batch, bgr.shape[:3], rows, drawn)
            if not len(place):
                continue
            spots = kernels.sunny(bgr, limit)[place] & under
            regions = largest_regions(spots, size)
            seen = np.flatnonzero(regions.any((1, 2)))
            if not len(seen):
                continue
            own = batch.select([c for c in SIGHT if c != "mask_day"]).take(pa.array(rows[place[seen]]))
            keys = {c: own.column(c) for c in SIGHT if c != "mask_day"} | {"mask_day": pa.array(days[seen])}
            yield pa.RecordBatch.from_arrays([*(keys[c] for c in SIGHT), *made(regions[seen], under[seen])], names=names)

    pictures = _sights(images, mask, only).select("frame_id", "device_id", "day", "height", "width", "data", "masks")
    kinds = kept(images, "frame_id", "device_id")
    seen = arrow_pass(pictures, f"{kinds}, mask_day bigint, height int, width int, {schema}", look)
    return seen if only is None else seen.join(only.select("frame_id", "mask_day").distinct(), ["frame_id", "mask_day"], "left_semi")


def sun_regions(images: DataFrame, mask: DataFrame, only: DataFrame | None = None, limit: int = 10, size: int = 3) -> DataFrame:
    """Largest sun-like region per frame and mask: (frame_id, device_id, mask_day, height, width, start, length).

    One pass over the pictures: hue, mask and region are found where the picture is, and one row
    for each frame and mask leaves it. mask: image rows of runs; `only` lists the wanted (frame_id, mask_day).
    """
    return _each_sight(images, mask, only, limit, size, RUNS, lambda regions, under: run_lists(regions))


def _bits(image: np.ndarray) -> tuple[bytes, int, int]:
    return np.packbits(image).tobytes(), *image.shape


def _image(raw: bytes, high: int, wide: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(raw, np.uint8), count=high * wide).reshape(high, wide).astype(bool)


@lru_cache(1 << 12)
def _circle_of_shape(raw: bytes, high: int, wide: int) -> tuple[int, int, int]:
    """`circle_of` of a cut-out: suns of many frames have the same shape."""
    return circle_of(_image(raw, high, wide))


@lru_cache(1 << 12)
def _area_on_shape(cx: int, cy: int, r: int, raw: bytes, high: int, wide: int) -> int:
    *_, area = kernels.parts_of(kernels.fill_each((kernels.disc(cx, cy, r, high, wide) & _image(raw, high, wide))[None]))
    return int(area.max(initial=0))


def circle_of(region: np.ndarray) -> tuple[int, int, int]:
    """cx, cy, r: the whole-number smallest circle around the foreground of an image."""
    _, start, length = kernels.flat_runs(region[None])
    return whole_circle(start, length, region.shape[1])


def whole_circle(start: np.ndarray, length: np.ndarray, wide: int) -> tuple[int, int, int]:
    """cx, cy, r of runs, cut to integers after rounding away float noise. A run may go on into the next row."""
    last = start + length - 1
    if (start // wide != last // wide).any():
        flags = np.zeros((1, int(last.max()) // wide + 1, wide), bool)
        flags.ravel()[kernels.spread_runs(start, length)[0]] = True
        _, start, length, *_ = kernels.parts_of(flags)
    return tuple(int(np.floor(np.round(v, 6))) for v in kernels.enclosing_circle(kernels.row_ends(start, length, wide)))


def measured(regions: np.ndarray, under: np.ndarray, least: int, most: int) -> list[list[int | None]]:
    """cx, cy, r, area and disc_area of regions under masks; nulls where no disc of least <= r <= most is.

    disc_area: pixels of the largest filled region of the disc that lies on the mask.
    """
    out = []
    for region, mask, top, bottom, left, right in zip(regions, under, *_boxes(regions).tolist()):
        found = [None] * 5
        # a region wider or higher than any accepted disc needs no circle
        if max(bottom - top, right - left) <= 2 * most + 4:
            part = region[top:bottom, left:right]
            cx, cy, r = _circle_of_shape(*_bits(part))
            cx, cy = cx + left, cy + top
            if least <= r <= most:
                found = [cx, cy, r, int(np.count_nonzero(part)), disc_area(cx, cy, r, mask)]
        out.append(found)
    return [list(x) for x in zip(*out)]


def disc_area(cx: int, cy: int, r: int, mask: np.ndarray) -> int:
    """Pixels of the largest filled region of a disc on a mask; 0 without any."""
    high, wide = mask.shape
    top, left = max(0, cy - r - 1), max(0, cx - r - 1)
    box = mask[top : min(high, cy + r + 2), left : min(wide, cx + r + 2)]
    if not box.size:
        return 0
    return _area_on_shape(cx - left, cy - top, r, *_bits(box))


def accept(discs: DataFrame, least: int = 15, most: int = 100, filled: float = 0.5) -> DataFrame:
    """Discs of a sun's size that the region fills well enough; an empty disc is no sun."""
    share = F.try_divide(F.col("area").cast("double"), F.col("disc_area").cast("double"))
    return discs.where(F.col("r").between(least, most) & (share >= filled))


def detect(
    images: DataFrame, mask: DataFrame, only: DataFrame | None = None, least: int = 15, most: int = 100, filled: float = 0.5, limit: int = 10, size: int = 3
) -> DataFrame:
    """Suns as (frame_id, device_id, mask_day, cx, cy, r, area, disc_area).

    Circle and disc are measured in the pass that finds the region, where its mask is at hand.
    """
    schema = "cx int, cy int, r int, area bigint, disc_area bigint"
    kinds = pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()

    def made(regions: np.ndarray, under: np.ndarray) -> list[pa.Array]:
        return [pa.array(x, kind) for x, kind in zip(measured(regions, under, least, most), kinds)]

    return accept(_each_sight(images, mask, only, limit, size, schema, made), least, most, filled).drop("height", "width")


def _with_columns(images: DataFrame, schema: str, columns: tuple[str, ...], one) -> DataFrame:
    """Adds integer columns that a function gives for each row of the named columns."""
    names = [c for c in images.columns]

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        made = [one(*row) for row in zip(*(batch.column(c).to_pylist() for c in columns))]
        new = [pa.array([m[k] for m in made], pa.int64() if part.endswith("bigint") else pa.int32()) for k, part in enumerate(schema.split(", "))]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *new], names=[*names, *[p.split()[0] for p in schema.split(", ")]])

    return arrow_pass(images, f"{kept(images, *names)}, {schema}", run)


def enclosing_circles(images: DataFrame) -> DataFrame:
    """Adds cx, cy, r, the whole-number smallest circle around the pixels of `pos`."""

    def one(pos: list[int], wide: int) -> tuple[int, int, int]:
        at = np.array(pos, np.int64)
        return whole_circle(at, np.ones_like(at), wide)

    return _with_columns(images, "cx int, cy int, r int", ("pos", "width"), one)


def disc_areas(discs: DataFrame, mask_pos: str) -> DataFrame:
    """Adds disc_area: pixels of the largest filled region of the disc that lies on `mask_pos`."""

    def one(cx: int, cy: int, r: int, pos: list[int], high: int, wide: int) -> tuple[int]:
        mask = np.zeros(high * wide, bool)
        mask[np.array(pos, np.int64)] = True
        return (disc_area(cx, cy, r, mask.reshape(high, wide)),)

    return _with_columns(discs, "disc_area bigint", ("cx", "cy", "r", mask_pos, "height", "width"), one).drop(mask_pos)
