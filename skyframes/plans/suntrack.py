"""Sun tracks of all devices and days in a set of images, given their sky masks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframes.operators import pairing, sun, track
from skyframes.session import stage_table

def agreed_suns(images: DataFrame, mask: DataFrame, tolerance: int = 120, **limits) -> DataFrame:
    """Pairs of overlapping suns of a day and its neighbours, seen under that day's mask.

    Frames are matched by time first, which reads their metadata only. The matched frames,
    each with the days of the masks it is wanted under, meet the few sun-like pixels and not
    the image bytes.
    """
    frames = images.select("frame_id", "device_id", "day", "tod")
    pairs = stage_table(pairing.day_pairs(frames, tolerance), "pairs").withColumn("mask_day", F.col("day"))
    used = pairs.select("frame_id", "mask_day").unionByName(pairs.select(F.col("match_id").alias("frame_id"), "mask_day"))
    suns = stage_table(sun.detect(images, mask, used, **limits), "suns")
    return pairing.overlapping(pairing.pairs_with_suns(pairs, suns, "mask_day"))


def sun_track(images: DataFrame, mask: DataFrame, width: int = 640, height: int = 640, **options) -> DataFrame:
    """Track per device and middle day."""
    return track.fit_tracks(track.centroids(agreed_suns(images, mask, **options)), width, height)
