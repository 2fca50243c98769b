"""From pull requests to the captures to land: validation, windows, selection, names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframes.operators import requests as rq


def select_captures(requests: DataFrame, devices: DataFrame, captures: DataFrame) -> dict[str, DataFrame]:
    """Selected captures with an image, windows, landing folders, and the two kinds of refused requests.

    Every request is in `windows` or in `quarantine`, and only in one of them.
    """
    checked = rq.validate(requests)
    windows = rq.epoch_windows(checked, devices)
    selected = rq.captures_in_windows(windows, captures)
    return {
        "selected": rq.with_image(selected),
        "windows": windows,
        "folders": rq.landing_folders(windows),
        "without_images": rq.requests_without_images(windows, rq.captures_in_windows(windows, rq.with_image(captures), first=True)),
        "quarantine": rq.window_rejects(checked, devices),
    }


def every_request(requests: DataFrame, devices: DataFrame) -> DataFrame:
    """Each request once: its window, or the codes of why it has none."""
    checked = rq.validate(requests)
    windows = rq.epoch_windows(checked, devices).select("request_id", "device_id", "t1", "t2", F.lit(None).cast("string").alias("errors"))
    none = [F.lit(None).cast("bigint").alias(c) for c in ("t1", "t2")]
    rejects = rq.window_rejects(checked, devices)
    return windows.unionByName(rejects.select("request_id", F.col("dev_id").alias("device_id"), *none, F.array_join("errors", ",").alias("errors")))


def frames_of_requests(selected: DataFrame, captures: DataFrame, devices: DataFrame, frames: DataFrame) -> DataFrame:
    """(request_id, capture_id, frame_id): the stored frame of each selected capture, null where none is stored.

    A capture lands under a name, and a stored frame's id is the hash of its file's name. Of captures
    of one device and second the last one has the name; the others have no frame. No picture is read.
    """
    names = rq.landing_names(captures, devices).select(F.col("frame_id").alias("capture_id"), F.xxhash64("name").alias("frame_id"))
    known = names.join(frames.select("frame_id").distinct(), "frame_id", "left_semi")
    return selected.select("request_id", F.col("frame_id").alias("capture_id")).join(known, "capture_id", "left").select("request_id", "capture_id", "frame_id")
