"""Stored frames: import, later imports, refused files, and joins that leave pictures where they are."""

import os
import time

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_images import NAMES, folder, png  # noqa: F401

from skyframes.catalog import views
from skyframes.operators import mask, sun
from skyframes.operators import requests as rq
from skyframes.plans import ingest, sky, suntrack
from skyframes.session import stage_table
from skyframes.sources import frames as store
from skyframes.sources.images import read_images

DAY_ONE = 19723  # 2024-01-01


def test_frames_come_back_as_they_were_read(spark, folder, tmp_path):  # noqa: F811
    (tmp_path / "frames" / "holiday.png").write_bytes(png(1, 1, 3, lambda y, x: (1, 2, 3)))
    target = f"file://{tmp_path}/stored"
    assert store.store_frames(spark, folder, target, buckets=4) == 5
    key = ["frame_id", "device_id", "day", "tod", "height", "width", "data"]
    named = read_images(spark, folder).where("device_id is not null")
    assert sorted(map(tuple, store.read_frames(spark, target).select(key).collect())) == sorted(map(tuple, named.select(key).collect()))
    got = {(r.path.rpartition("/")[2], r.reason) for r in store.refused_files(spark, target).collect()}
    assert got == {("holiday.png", "name"), ("04E670000002_01-06-2024_19-00-05.png", "broken")}
    assert store.frame_collisions(store.read_frames(spark, target)).count() == 0
    twins = store.read_frames(spark, target).withColumn("frame_id", F.lit(1))
    assert [len(set(r.names)) for r in store.frame_collisions(twins).collect()] == [2]


def test_an_import_takes_what_is_new(spark, folder, tmp_path):  # noqa: F811
    target = f"file://{tmp_path}/stored"
    assert store.store_frames(spark, folder, target, buckets=4) == 4
    assert store.store_frames(spark, folder, target) == 0
    new = tmp_path / "frames" / "later"
    new.mkdir()
    (new / "04E670000001_01-05-2024_10-00-00.png").write_bytes(png(3, 4, 3, lambda y, x: (1, 2, 3)))
    old = tmp_path / "frames" / "04E670000001_01-05-2024_08-00-00.png"
    old.write_bytes(png(3, 4, 3, lambda y, x: (4, 5, 6)))
    os.utime(old, (time.time() - 10_000_000,) * 2)  # a copy that kept its old time
    assert store.store_frames(spark, folder, target) == 2
    assert store.store_frames(spark, folder, target) == 0
    assert sorted(r.tod for r in store.read_frames(spark, target).collect()) == [28800, 32400, 32410, 36000, 68400]
    assert store.refused_files(spark, target).count() == 1
    # another session's catalog does not know the table
    spark.sql(f"drop table {store._table(spark, target)[0]}")
    assert store.read_frames(spark, target).count() == 5
    files = [f.name for f in (tmp_path / "stored").glob("part-*.parquet")]
    assert files and all("_0000" in f for f in files)  # each in its bucket


@pytest.fixture(scope="module")
def scene(spark, sf_dir, tmp_path_factory):
    """The scene as PNG files, one per device and second, and the same pictures as a table."""
    path = tmp_path_factory.mktemp("scene")
    # the least id of a second, as a name holds one picture
    images = views.scene_images(spark, sf_dir)
    once = images.groupBy("device_id", "day", "tod").agg(F.min("frame_id").alias("frame_id"))
    images = stage_table(images.join(once, ["device_id", "day", "tod", "frame_id"], "left_semi"), "scene")
    for r in images.collect():
        bgr = np.frombuffer(bytes(r.data), np.uint8).reshape(r.height, r.width, 3)[..., ::-1]
        name = time.strftime(f"{r.device_id}_%m-%d-%Y_%H-%M-%S.png", time.gmtime((r.day - 1 + DAY_ONE) * 86400 + r.tod))
        (path / name).write_bytes(png(r.height, r.width, 3, lambda y, x, p=bgr: p[y, x]))
    target = f"file://{tmp_path_factory.mktemp('store')}/frames"
    store.store_frames(spark, str(path), target, buckets=6, slice_seconds=3600)
    return images, store.read_frames(spark, target)


OPTIONS = {"tolerance": 1800, "least": 1, "most": 5}


def test_from_image_files_to_the_sun_track(spark, scene):
    def track(images):
        found = suntrack.sun_track(images, sky.sky_mask(images), 24, 24, **OPTIONS)
        return sorted((r.device_id, r.day % DAY_ONE, *(round(r[c], 6) for c in ("theta", "a2", "a1", "a0", "rss")), r.n) for r in found.collect())

    images, stored = scene
    later = images.withColumn("day", F.col("day") + DAY_ONE - 1)
    assert stored.count() == images.count()
    assert track(stored) == track(later) != []


def above_pictures(df):
    """The steps of the plan from the scan of the picture bytes up to the join."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda line: len(line) - len(line.lstrip(" :+-*()0123456789"))
    at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and ",data#" in line)
    steps, level = [lines[at]], depth(lines[at])
    for line in reversed(lines[:at]):
        if line.strip() and depth(line) < level:
            level = depth(line)
            steps.append(line)
            if "Join" in line:
                return steps
    raise AssertionError("no join")


def test_joins_leave_stored_pictures_in_their_buckets(spark, scene):
    _, stored = scene
    found = sky.regions(stored)
    masks = sky.sky_mask(stored)
    only = stage_table(stored.select("frame_id", F.col("day").alias("mask_day")), "wanted")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # not because the other side is small
    try:
        plans = [mask.region_sums(stored, found), mask.masked_pixels(stored, masks), sun.detect(stored, masks, least=1, most=5), sun.detect(stored, masks, only, least=1, most=5)]
        for df in plans:
            steps = above_pictures(df)
            assert "Bucketed: true" in steps[0] and "ShuffledHashJoin" in steps[-1]
            assert not any("Exchange" in s or "Sort" in s for s in steps), steps
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_wanted_frames_only(spark, scene):
    _, stored = scene
    masks = sky.sky_mask(stored)
    every = stage_table(sun.detect(stored, masks, least=1, most=5), "every-sun")
    only = every.where("frame_id % 2 = 0 and mask_day % 3 > 0").select("frame_id", "mask_day")
    columns = sorted(every.columns)
    want = sorted(map(tuple, every.join(only, ["frame_id", "mask_day"], "left_semi").select(columns).collect()))
    assert 0 < len(want) < every.count()
    for pictures in (stored, stored.drop("slice")):
        assert sorted(map(tuple, sun.detect(pictures, masks, only, least=1, most=5).select(columns).collect())) == want


def test_selected_captures_meet_their_stored_frames(spark, tmp_path):
    """From a request over its captures and their landing names to frames in the store."""
    start = DAY_ONE * 86400 + 36000
    rows = [(i, "04E670000001", start + 60 * (i // 2), "u" if i != 4 else None) for i in range(8)]  # two a second
    captures = spark.createDataFrame(rows, "frame_id long, device_id string, ts long, image_url string")
    devices = spark.createDataFrame([("04E670000001", -3.0)], "device_id string, utc double")
    requests = spark.createDataFrame([(1, "04E670000001", "2024-1-1", "6:59am", "2024-1-1", "7:02am")], "request_id long, dev_id string, d1 string, t1 string, d2 string, t2 string")
    folder = tmp_path / "landing"
    folder.mkdir()
    landed = {r.name: r.frame_id for r in rq.landing_names(captures, devices).collect()}
    for name, i in landed.items():
        if i != 3:  # one was never fetched
            (folder / name).write_bytes(png(2, 2, 3, lambda y, x, i=i: (i, i, i)))
    target = f"file://{tmp_path}/stored"
    store.store_frames(spark, str(folder), target, buckets=2)
    frames = store.read_frames(spark, target)
    selected = ingest.select_captures(requests, devices, captures)["selected"]
    linked = stage_table(ingest.frames_of_requests(selected, captures, devices, frames), "linked")
    assert sorted((r.request_id, r.capture_id, r.frame_id is not None) for r in linked.collect()) == [(1, 0, False), (1, 1, True), (1, 2, False), (1, 3, False)]
    shown = linked.join(frames, "frame_id").collect()
    assert [(r.capture_id, r.day, r.tod, bytes(r.data)[0]) for r in shown] == [(1, DAY_ONE, 7 * 3600, 1)]
