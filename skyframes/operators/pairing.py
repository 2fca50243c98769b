"""Frames of neighbouring days taken at the same time of day, and the suns they agree on."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyframes.session import stage_table

MOMENT = ["device_id", "day", "tod"]
_CUTS = 256
_STRETCHES = "device_id string, day bigint, neighbour_day bigint, tod bigint, first bigint, match_tod bigint, match_first bigint, n bigint"


def match_stretches(base_tod, base_n, match_tod, match_n, tolerance: int) -> np.ndarray:
    """Greedy matching of two ascending lists of moments, each standing for n frames.

    Frames count through from 0 on both sides. Each base frame takes the first unused
    candidate not more than `tolerance` before it, unless that one is more than
    `tolerance` after it. Returns rows (base index, rank within it, match index,
    rank within it, length): stretches of frames matched one to one.
    """
    ahead = np.concatenate([[0], np.cumsum(match_n)])
    low = ahead[np.searchsorted(match_tod, base_tod - tolerance)].tolist()
    high = ahead[np.searchsorted(match_tod, base_tod + tolerance, side="right")].tolist()
    taken, used = [], 0
    for i, n in enumerate(base_n.tolist()):
        used = max(used, low[i])
        n = min(n, high[i] - used)
        if n > 0:
            taken.append((i, used, n))
            used += n
    if not taken:
        return np.zeros((0, 5), np.int64)
    base, start, length = np.array(taken, np.int64).T
    # cut each stretch where the candidates' moment changes
    first = np.searchsorted(ahead, start, side="right") - 1
    last = np.searchsorted(ahead, start + length - 1, side="right") - 1
    count = last - first + 1
    row = np.repeat(np.arange(len(base)), count)
    match = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - first, count)
    begin = np.maximum(start[row], ahead[match])
    end = np.minimum(start[row] + length[row], ahead[match + 1])
    return np.column_stack([base[row], begin - start[row], match, begin - ahead[match], end - begin])


def _matcher(tolerance: int):
    def match_day(key: tuple, moments: pd.DataFrame) -> pd.DataFrame:
        moments = moments.sort_values("tod")
        base, other = moments[moments["is_base"]], moments[~moments["is_base"]]
        b, m = base["tod"].to_numpy(), other["tod"].to_numpy()
        rows = match_stretches(b, base["n"].to_numpy(), m, other["n"].to_numpy(), tolerance)
        return pd.DataFrame(
            {
                "device_id": key[0], "day": key[1], "neighbour_day": key[2],
                "tod": b[rows[:, 0]], "first": rows[:, 1],
                "match_tod": m[rows[:, 2]], "match_first": rows[:, 3], "n": rows[:, 4],
            }
        )

    return match_day


def blocks(frames: DataFrame, block: int) -> DataFrame:
    """(MOMENT, frame_id, block): the frames of a second in blocks of ascending ids.

    The ids of a crowded second are cut at their quantiles, about one for each `block` of its
    frames, so it is sorted in parts however its ids are spread. Quantiles come from a sketch of
    bounded size, `_CUTS` of them; blocks of even more frames grow with the second.
    """
    frames = frames.select(*MOMENT, "frame_id")
    crowded = stage_table(frames.groupBy(*MOMENT).agg(F.count(F.lit(1)).alias("all")).where(F.col("all") > block), "crowded")
    if crowded.isEmpty():
        return frames.withColumn("block", F.lit(0))
    shares = F.array(*[F.lit(i / _CUTS) for i in range(1, _CUTS)])
    cuts = frames.join(crowded, MOMENT).groupBy(*MOMENT).agg(F.max("all").alias("all"), F.percentile_approx("frame_id", shares, F.lit(20 * _CUTS)).alias("cuts"))
    # as many of the cuts as the second needs
    step = F.greatest(F.lit(1), F.floor(F.lit(_CUTS) * block / F.col("all"))).cast("int")
    cuts = stage_table(cuts.select(*MOMENT, F.array_distinct(F.filter("cuts", lambda c, i: (i + 1) % step == 0)).alias("cuts")), "cuts")
    number = F.when(F.col("cuts").isNull(), 0).otherwise(F.size(F.filter("cuts", lambda c: c < F.col("frame_id"))))
    return frames.join(cuts, MOMENT, "left").select(*MOMENT, "frame_id", number.alias("block"))


def numbered(frames: DataFrame, block: int = 4096) -> DataFrame:
    """Adds `rank`, the place of a frame by id among the frames of its device and second, from 0.

    Ranks are counted within blocks of ids and moved by the sizes of the blocks before.
    """
    part = [*MOMENT, "block"]
    keyed = blocks(frames, block)
    sizes = keyed.groupBy(*part).agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy(*MOMENT).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    ahead = sizes.select(*part, F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("ahead"))
    place = F.row_number().over(Window.partitionBy(*part).orderBy("frame_id")) - 1
    return keyed.withColumn("place", place).join(ahead, part).select(
        *MOMENT, "frame_id", (F.col("place") + F.col("ahead")).alias("rank")
    )


def day_pairs(frames: DataFrame, tolerance: int = 120) -> DataFrame:
    """Pairs (device_id, day, neighbour_day, frame_id, match_id) of frames of a day and of the days beside it.

    In order of (time of day, frame id) each frame takes the earliest unused frame of the
    other day within `tolerance` seconds. The walk is sequential, so it runs on seconds, not
    frames: a device has at most 86,400 seconds a day, each one row with a count, whatever
    the number of frames. Frames come back in by rank.
    """
    moments = frames.groupBy(*MOMENT).agg(F.count(F.lit(1)).alias("n"))
    beside = F.explode(F.array(F.lit(-1), F.lit(1)))
    base = moments.withColumn("step", beside).select(
        "device_id", F.col("day").cast("bigint").alias("day"), (F.col("day") + F.col("step")).cast("bigint").alias("neighbour_day"),
        F.col("tod").cast("bigint").alias("tod"), "n", F.lit(True).alias("is_base"),
    )
    other = base.select("device_id", F.col("neighbour_day").alias("day"), F.col("day").alias("neighbour_day"), "tod", "n", F.lit(False).alias("is_base"))
    stretches = base.unionByName(other).groupBy("device_id", "day", "neighbour_day").applyInPandas(_matcher(tolerance), _STRETCHES)
    # in two steps, so that no array grows with a crowded second
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr("(n - 1) div 4096") * 4096, F.lit(4096).cast("bigint")))
    in_chunk = F.explode(F.sequence(F.col("chunk"), F.least(F.col("chunk") + 4095, F.col("n") - 1)))
    pairs = stretches.withColumn("chunk", chunk).withColumn("k", in_chunk).select(
        "device_id", "day", "neighbour_day", "tod", (F.col("first") + F.col("k")).alias("rank"),
        "match_tod", (F.col("match_first") + F.col("k")).alias("match_rank"),
    )
    ranked = numbered(frames)
    matched = ranked.select(
        "device_id", F.col("day").alias("neighbour_day"), F.col("tod").alias("match_tod"),
        F.col("rank").alias("match_rank"), F.col("frame_id").alias("match_id"),
    )
    return (
        pairs.join(ranked, ["device_id", "day", "tod", "rank"])
        .join(matched, ["device_id", "neighbour_day", "match_tod", "match_rank"])
        .select("device_id", "day", "neighbour_day", "frame_id", "match_id")
    )


def matched_frames(frames: DataFrame, pairs: DataFrame) -> DataFrame:
    """Frames that take part in a pair."""
    used = pairs.select("frame_id").unionByName(pairs.select(F.col("match_id").alias("frame_id")))
    return frames.join(used, "frame_id", "left_semi")


def overlap(a: Column, b: Column) -> Column:
    """Whether two circles (cx, cy, r) share an area."""
    dx, dy, reach = a.cx - b.cx, a.cy - b.cy, a.r + b.r
    return dx * dx + dy * dy < reach * reach


def overlapping(pairs: DataFrame) -> DataFrame:
    """Pairs with circles cx, cy, r and match_cx, match_cy, match_r that overlap."""
    sun = F.struct("cx", "cy", "r")
    match = F.struct(*[F.col(f"match_{c}").alias(c) for c in ("cx", "cy", "r")])
    return pairs.where(overlap(sun, match))


def pairs_with_suns(pairs: DataFrame, suns: DataFrame, *shared: str) -> DataFrame:
    """Pairs whose frames both show a sun; `shared` are further columns that name a sun, such as mask_day."""
    circles = suns.select("frame_id", *shared, "cx", "cy", "r")
    other = circles.withColumnsRenamed({"frame_id": "match_id", **{c: f"match_{c}" for c in ("cx", "cy", "r")}})
    return pairs.join(circles, ["frame_id", *shared]).join(other, ["match_id", *shared])
