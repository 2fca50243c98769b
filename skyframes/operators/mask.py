"""Sky mask of each device and day: pixel hits, regions, region brightness, final mask.

Pictures stay pictures and binary images stay runs (see `stacks`): counting, labelling and summing
are Arrow passes that give one row per frame, image or band of rows. Pixel rows are a query's own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyframes.functions import color
from skyframes.operators import kernels
from skyframes.operators.edges import edge_flags
from skyframes.operators.stacks import RUNS, arrow_pass, kept, listed, lists, numbered, run_rows, stacks

IMAGE = ("device_id", "day", "height", "width")
_BAND = 1 << 14  # pixels of a band of rows
_HELD = 1 << 22  # pixels of the counters that a task holds open


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sky_flags(bgr: np.ndarray) -> np.ndarray:
    """The colour rule on (..., H, W, 3) images."""
    return color.is_sky_color(*(bgr[..., k].astype(np.int16) for k in range(3)))


class _Counter:
    """Dense hits of one device, day and picture size."""

    def __init__(self, high: int, wide: int):
        self.color, self.edge, self.n = np.zeros((high, wide), np.int32), np.zeros((high, wide), np.int32), 0

    def add(self, sky: np.ndarray, edge: np.ndarray) -> None:
        self.color += sky.sum(0, dtype=np.int32)
        self.edge += edge.sum(0, dtype=np.int32)
        self.n += len(sky)


_HITS = ("y0", "n_frames", "color_hits", "edge_hits")
_HITS_SCHEMA = "y0 int, n_frames bigint, color_hits array<int>, edge_hits array<int>"


def _bands(key: tuple, c: _Counter, kinds: pa.Schema) -> pa.RecordBatch:
    step = max(1, _BAND // max(1, c.color.shape[1]))
    tops = list(range(0, len(c.color), step))
    columns = [pa.array([v] * len(tops), kinds.field(name).type) for name, v in zip(IMAGE, key)]
    hits = [pa.array([x[y : y + step].ravel() for y in tops], pa.list_(pa.int32())) for x in (c.color, c.edge)]
    return pa.RecordBatch.from_arrays([*columns, pa.array(tops, pa.int32()), pa.array([c.n] * len(tops), pa.int64()), *hits], names=[*IMAGE, *_HITS])


def _band(place: tuple, sums: list, kinds: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip([*place, *sums], kinds)], schema=kinds)


def pixel_hits(images: DataFrame, low: int = 100, high: int = 200) -> DataFrame:
    """Hits of each device, day and picture size, in bands of rows: (IMAGE, y0, n_frames, color_hits, edge_hits).

    The arrays count, for the pixels of a band row by row, the frames with sky colour and those
    with an edge. One pass over the frames gives both flags; a task counts into dense arrays, a pair
    for each device, day and size it meets, and gives a pair away when it has too many open. The
    parts of a band are added up one by one, so neither a camera with most of the frames nor a long
    day gathers anywhere.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, _Counter] = {}
        kinds, pixels = None, 0
        for batch in batches:
            kinds = batch.schema
            # frames of a key side by side, so that a stack has few keys
            number, keys = numbered(batch, *IMAGE)
            for rows, bgr in stacks(batch, beside=number):
                sky, edge = sky_flags(bgr), edge_flags(bgr, low, high)
                ends = (np.flatnonzero(np.diff(number[rows])) + 1).tolist()
                for some in map(slice, [0, *ends], [*ends, len(rows)]):
                    key = keys[number[rows[some.start]]]
                    c = held.pop(key, None)
                    if c is None:
                        c, pixels = _Counter(*bgr.shape[1:3]), pixels + sky[0].size
                    c.add(sky[some], edge[some])
                    held[key] = c  # the one used last comes last
                    while pixels > _HELD and len(held) > 1:
                        first = next(iter(held))
                        pixels -= held[first].color.size
                        yield _bands(first, held.pop(first), kinds)
        for key, c in held.items():
            yield _bands(key, c, kinds)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, sums, kinds = None, [], None
        for batch in batches:
            kinds, n, sky, edge = batch.schema, *(batch.column(c) for c in _HITS[1:])
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in (*IMAGE, "y0")))):
                parts = [n[i].as_py(), *(np.asarray(c[i].values) for c in (sky, edge))]
                if key == last:
                    sums = [a + b for a, b in zip(sums, parts)]
                    continue
                if last is not None:
                    yield _band(last, sums, kinds)
                last, sums = key, parts
        if last is not None:
            yield _band(last, sums, kinds)

    schema = f"{kept(images, *IMAGE)}, {_HITS_SCHEMA}"
    parts = images.select(*IMAGE, "data").mapInArrow(count, schema)
    place = [*IMAGE, "y0"]
    return parts.repartition(_partitions(images), *place).sortWithinPartitions(*place).mapInArrow(merge, schema)


def hit_rows(hits: DataFrame) -> DataFrame:
    """Pixel rows (IMAGE, y, x, color_hits, edge_hits, n_frames) of bands."""
    each = hits.select(*IMAGE, "y0", "n_frames", F.posexplode(F.arrays_zip("color_hits", "edge_hits")).alias("pos", "hit"))
    count = lambda c: F.col(f"hit.{c}").cast("bigint").alias(c)
    return each.select(
        *IMAGE, (F.col("y0") + F.expr("pos div width").cast("int")).alias("y"), (F.col("pos") % F.col("width")).alias("x"), count("color_hits"), count("edge_hits"), "n_frames"
    )


def raw_mask(hits: DataFrame, beta1: float = 0.75, beta2: float = 0.5) -> DataFrame:
    """Image rows (IMAGE, start, length): pixels that show sky in at least beta1 of the frames and an edge in less than beta2.

    Bands give runs; an image is put together from its bands and is never larger than one picture.
    """

    def often(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found = [[], []]
        for i, (y0, wide, n) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("y0", "width", "n_frames")))):
            sky, edge = (np.asarray(batch.column(c)[i].values) for c in ("color_hits", "edge_hits"))
            _, start, length = kernels.flat_runs(((sky >= n * beta1) & (edge < n * beta2))[None])
            found[0].append(start + y0 * wide)
            found[1].append(length)
        runs = [pa.array(x, pa.list_(pa.int32())) for x in found]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in (*IMAGE, "y0")), *runs], names=[*IMAGE, "y0", "start", "length"])

    bands = arrow_pass(hits, f"{kept(hits, *IMAGE)}, y0 int, {RUNS}", often).where(F.size("start") > 0)
    whole = bands.groupBy(*IMAGE).agg(F.array_sort(F.collect_list(F.struct("y0", "start", "length"))).alias("bands"))
    return whole.select(*IMAGE, F.flatten("bands.start").alias("start"), F.flatten("bands.length").alias("length"))


def _drawn(batch: pa.RecordBatch, i: int) -> np.ndarray:
    """The binary image of a row of runs, as a stack of one."""
    start, length = (np.asarray(batch.column(c)[i].values).astype(np.int64) for c in ("start", "length"))
    shape = 1, batch.column("height")[i].as_py(), batch.column("width")[i].as_py()
    return kernels.drawn(shape, np.zeros(len(start), np.int64), start, length)


REGIONS = f"n_regions int, {RUNS}, region array<int>, area array<bigint>"


def _ranked(batch: pa.RecordBatch, shaped, top, least) -> list[pa.Array]:
    """Columns of REGIONS: the `top` largest components of each image's reshaped foreground, of at least `least` pixels."""
    out = []
    for i in range(len(batch)):
        image, start, length, label, area = kernels.parts_of(shaped(_drawn(batch, i)))
        rank = kernels.ranks(image, label, area)
        size = batch.column("height")[i].as_py() * batch.column("width")[i].as_py()
        good = (rank < top(i)) & (area[label] >= least(size))
        out.append((len(np.unique(rank[good])), start[good], length[good], rank[good] + 1, area[label][good]))
    kinds = pa.int32(), *(pa.list_(t) for t in (pa.int32(), pa.int32(), pa.int32(), pa.int64()))
    return [pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)]


def sky_regions(raw: DataFrame, size: int = 5, top: int = 3, part: int = 20) -> DataFrame:
    """Image rows (IMAGE, n_regions, start, length, region, area): up to `top` regions of at least 1/`part` of the image, after erosion.

    `region` (the rank by area) and `area` are given for each run; `n_regions` counts the regions of the image.
    """

    def label(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        made = _ranked(batch, lambda x: kernels.fill_each(kernels.sweep(x, size, np.minimum)), lambda i: top, lambda pixels: pixels / part)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in IMAGE), *made], names=[*IMAGE, "n_regions", "start", "length", "region", "area"])

    return arrow_pass(raw.select(*IMAGE, "start", "length"), f"{kept(raw, *IMAGE)}, {REGIONS}", label).where("n_regions > 0")


def region_rows(regions: DataFrame) -> DataFrame:
    """Pixel rows (IMAGE, y, x, area, region, n_regions) of regions."""
    return run_rows(regions, *IMAGE, "n_regions", values={"area": "area", "region": "region"}).select(*IMAGE, "y", "x", "area", "region", "n_regions")


def beside_pictures(images: DataFrame, rows: DataFrame, *columns: str) -> DataFrame:
    """Pictures with the row of their device, day and size, without moving pictures that are stored.

    `rows` is small beside the pictures. Stored frames (`sources.frames`) lie in buckets by device,
    day, size and slice of the day; the other side is copied to the slices that a day has, which
    metadata tell, and goes to the buckets. Other pictures meet it as Catalyst decides.
    """
    pictures = images.select(*columns, *IMAGE, *[c for c in ("slice",) if c in images.columns], "data")
    if "slice" not in images.columns:
        return pictures.join(rows, list(IMAGE))
    copies = images.select(*IMAGE, "slice").distinct().join(rows, list(IMAGE))
    return pictures.join(copies.hint("shuffle_hash"), [*IMAGE, "slice"])


def region_sums(images: DataFrame, regions: DataFrame) -> DataFrame:
    """Sum of |r - b| per frame and region of its own day and picture size.

    A frame meets the regions of its day as runs. Running sums over its pixels make a region cost
    its runs, not its pixels, and one row per frame and region leaves the pass.
    """

    def add(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for rows, bgr in stacks(batch):
            difference = np.abs(bgr[..., 2].astype(np.int64) - bgr[..., 0]).reshape(len(rows), -1)
            running = np.zeros((len(rows), difference.shape[1] + 1), np.int64)
            np.cumsum(difference, axis=1, out=running[:, 1:])
            place, start, length, region = listed(batch, rows, "start", "length", "region")
            names = int(region.max(initial=0)) + 1
            name = place * names + region
            # whole numbers below 2 ** 53, so that the sums are exact
            sums = np.bincount(name, running[place, start + length] - running[place, start]).astype(np.int64)
            found = np.flatnonzero(np.bincount(name))
            at, region = np.divmod(found, names)
            sums = sums[found]
            own = batch.select(["frame_id", *IMAGE]).take(pa.array(rows[at]))
            yield pa.RecordBatch.from_arrays([*own.columns, pa.array(region, pa.int32()), pa.array(sums, pa.int64())], names=["frame_id", *IMAGE, "region", "rb_sum"])

    met = beside_pictures(images, regions.select(*IMAGE, "start", "length", "region"), "frame_id")
    return arrow_pass(met.drop("slice"), f"{kept(images, 'frame_id', *IMAGE)}, region int, rb_sum bigint", add)


def region_correlation(sums: DataFrame, least: float = 0.3) -> DataFrame:
    """Correlation over the frames of each further region with region 1, and whether it is kept.

    A constant series has no correlation and is not kept.
    """
    # a frame's rows meet in a sort by its id; lists of them in a hash table would be sorted twice
    base = F.max(F.when(F.col("region") == 1, F.col("rb_sum"))).over(Window.partitionBy("frame_id", *IMAGE))
    series = sums.select(*IMAGE, "region", "rb_sum", base.alias("base")).where("region > 1 and base is not null")
    a, b = F.col("base").cast("double"), F.col("rb_sum").cast("double")
    corr = F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))
    return (
        series.groupBy(*IMAGE, "region")
        .agg(corr.alias("corr"))
        .withColumn("keep", F.coalesce(F.col("corr") >= least, F.lit(False)))
    )


def decided_regions(regions: DataFrame, correlation: DataFrame) -> DataFrame:
    """Regions rows with region 1 and the regions whose brightness follows it; n_regions stays the number before."""
    kept_ones = correlation.where("keep").groupBy(*IMAGE).agg(F.collect_set("region").alias("__kept"))
    runs = F.filter(F.arrays_zip("start", "length", "region", "area"), lambda r: (r.region == 1) | F.coalesce(F.array_contains("__kept", r.region), F.lit(False)))
    chosen = regions.join(kept_ones, list(IMAGE), "left").withColumn("__runs", runs)
    return chosen.select(*IMAGE, "n_regions", *[F.col(f"__runs.{c}").alias(c) for c in ("start", "length", "region", "area")])


def final_mask(decided: DataFrame, size: int = 5) -> DataFrame:
    """Image rows (IMAGE, start, length): kept regions dilated, filled and cut to the largest
    `n_regions` outlines, the number of regions before the decision."""

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        most = batch.column("n_regions").to_pylist()
        _, start, length, *_ = _ranked(batch, lambda x: kernels.fill_each(kernels.sweep(x, size, np.maximum)), lambda i: most[i], lambda pixels: 0)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in IMAGE), start, length], names=[*IMAGE, "start", "length"])

    return arrow_pass(decided.select(*IMAGE, "n_regions", "start", "length"), f"{kept(decided, *IMAGE)}, {RUNS}", cut)


def mask_rows(mask: DataFrame) -> DataFrame:
    """Pixel rows (IMAGE, y, x) of masks."""
    return run_rows(mask, *IMAGE)


def masks_by_day(mask: DataFrame) -> DataFrame:
    """(IMAGE, masks): for each day the masks that serve it, its own and those of the days beside it, as (mask_day, start, length)."""
    served = F.explode(F.sequence(F.col("day") - 1, F.col("day") + 1))
    each = mask.select("device_id", served.alias("day"), "height", "width", F.struct(F.col("day").alias("mask_day"), "start", "length").alias("m"))
    return each.groupBy(*IMAGE).agg(F.array_sort(F.collect_list("m")).alias("masks"))


def sights(batch: pa.RecordBatch, shape: tuple[int, int, int], rows: np.ndarray, drawn: dict[tuple, tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each frame of a stack and mask that serves its day: the frame's place in the stack, the mask's day, the mask's image.

    drawn: the masks of the devices and days of the batch that are drawn already; it grows. Frames of one
    device, day and size have the same masks (`masks_by_day`).
    """
    masks = batch.column("masks")
    code, keys = numbered(batch.select(["device_id", "day"]).take(pa.array(rows)), "device_id", "day")
    keys = [(shape[1:], *key) for key in keys]
    for key, first in zip(keys, np.unique(code, return_index=True)[1]):
        if key not in drawn:
            own = masks.slice(int(rows[first]), 1).flatten()
            place, start, length = listed(own, np.arange(len(own)), "start", "length")
            drawn[key] = np.asarray(own.field("mask_day")).astype(np.int64), kernels.drawn((len(own), *shape[1:]), place, start, length)
    sets = [drawn[key] for key in keys]
    size = np.array([len(days) for days, _ in sets], np.int64)[code]
    first = np.concatenate([[0], np.cumsum([len(days) for days, _ in sets])]).astype(np.int64)[code]
    which = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
    return np.repeat(np.arange(len(rows)), size), np.concatenate([days for days, _ in sets])[which], np.concatenate([images for _, images in sets])[which]


def masked_pixels(images: DataFrame, mask: DataFrame) -> DataFrame:
    """A row per frame and mask that serves its day: (frame_id, mask_day, width, pos, bgr), the pixels under the mask in order."""

    def look(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, drawn = batch.column("frame_id"), {}
        for rows, bgr in stacks(batch, beside=numbered(batch, "device_id", "day")[0]):
            place, days, under = sights(batch, bgr.shape[:3], rows, drawn)
            packed = bgr.astype(np.int32)
            packed = (packed[..., 0] << 16 | packed[..., 1] << 8 | packed[..., 2]).reshape(len(bgr), -1)
            sight, pos = np.nonzero(under.reshape(len(under), bgr.shape[1] * bgr.shape[2]))
            made = [lists(sight, x, len(place), pa.int32()) for x in (pos, packed[place[sight], pos])]
            wide = pa.array(np.full(len(place), bgr.shape[2]), pa.int32())
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows[place])), pa.array(days), wide, *made], names=["frame_id", "mask_day", "width", "pos", "bgr"])

    met = beside_pictures(images, masks_by_day(mask), "frame_id").drop("slice")
    return arrow_pass(met, f"{kept(images, 'frame_id')}, mask_day bigint, width int, pos array<int>, bgr array<int>", look)
