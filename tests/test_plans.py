"""Whole chains: regions under the sky rules, and the track of the scene's sun."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skyframes import session
from skyframes.catalog import views
from skyframes.operators import mask, stencil, sun
from skyframes.operators.stacks import as_runs, numbered, stacks
from skyframes.plans import ingest, sky, suntrack


def test_scene_track_follows_the_planted_sun(spark, sf_dir):
    images = views.scene_images(spark, sf_dir)
    sky_mask = sky.sky_mask(images)
    agreed = suntrack.agreed_suns(images, sky_mask, tolerance=1800, least=1, most=5)
    rows = agreed.collect()
    assert rows
    for r in rows:
        assert r.mask_day == r.day and abs(r.neighbour_day - r.day) == 1
        assert (r.cx - r.match_cx) ** 2 + (r.cy - r.match_cy) ** 2 < (r.r + r.match_r) ** 2
    tracks = suntrack.sun_track(images, sky_mask, 24, 24, tolerance=1800, least=1, most=5).collect()
    assert tracks and all(t.n > 3 for t in tracks)


def test_two_picture_sizes_on_one_day_stay_apart(spark):
    rng = np.random.default_rng(4)

    def frame(i, day, high, wide):
        bgr = np.zeros((high, wide, 3), np.uint8)
        lum = int(rng.integers(0, 50))
        bgr[:], bgr[: high // 2] = (60, 70, 80), (200, 150, 105 + lum)
        bgr[: high // 2, wide // 2 : wide // 2 + 2] = (60, 70, 80)
        cx, cy = 6 + i % 5, 5
        y, x = np.mgrid[:high, :wide]
        bgr[(x - cx) ** 2 + (y - cy) ** 2 <= 5] = 255
        return (i, "d", day, 40000 + i, high, wide, bytearray(bgr.tobytes()))

    schema = "frame_id long, device_id string, day long, tod long, height int, width int, data binary"
    rows = [frame(i, 1 + i % 2, 24, 24) for i in range(12)] + [frame(100 + i, 1 + i % 2, 20, 32) for i in range(12)]

    def results(some):
        images = spark.createDataFrame(some, schema)
        found = sky.regions(images)
        sums = mask.region_sums(images, found)
        final = sky.sky_mask(images)
        sizes = images.select("device_id", "day", "height", "width").distinct()
        whole = sizes.select("*", F.array(F.lit(0)).alias("start"), F.array(F.col("height") * F.col("width")).alias("length"))
        suns = sun.detect(images, whole, least=1, most=5)
        return [sorted(map(tuple, df.select(*sorted(df.columns)).collect())) for df in (found, sums, mask.region_correlation(sums), final, suns)]

    empty = 0
    for both, a, b in zip(results(rows), results(rows[:12]), results(rows[12:])):
        assert both == sorted(a + b)
        empty += not both
    assert not empty


def test_stage_tables_need_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(session, "_configured", lambda _: None)
    with pytest.raises(ValueError):
        session.stage_table(spark.range(3), "three")


def test_stage_tables_can_be_removed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_configured", lambda _: f"file://{tmp_path}")
    assert session.stage_table(spark.range(3), "three").count() == 3
    assert list(tmp_path.iterdir())
    session.drop_stage_tables(spark)
    assert not list(tmp_path.iterdir())


def test_a_block_removes_its_stage_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "_configured", lambda _: f"file://{tmp_path}")
    before = session.stage_table(spark.range(2), "before")
    with pytest.raises(KeyError):
        with session.stages(spark):
            session.stage_table(spark.range(3), "outer")
            with session.stages(spark):
                assert session.stage_table(spark.range(3), "inner").count() == 3
            assert len([f for f in tmp_path.rglob("*") if f.name.startswith(("outer-", "inner-"))]) == 1
            raise KeyError
    assert [f.name[:6] for f in tmp_path.rglob("*-*") if f.is_dir() and not f.name.startswith("skyframes")] == ["before"]
    assert before.count() == 2
    session.drop_stage_tables(spark)


def test_a_session_without_a_folder_can_be_given_one(spark, monkeypatch):
    """Not by the property, which a running session does not take."""
    given = []
    monkeypatch.setattr(session, "_configured", lambda _: None)
    monkeypatch.setattr(type(spark.sparkContext), "setCheckpointDir", lambda self, folder: given.append(folder))
    session.local_session(8, "6g", "file:///somewhere")
    assert given == ["file:///somewhere"]


def test_regions_zero_to_three(spark):
    def block(device, top, left, high, wide):
        return [(device, 1, 60, 60, y, x) for y in range(top, top + high) for x in range(left, left + wide)]

    raw = block("one", 0, 0, 30, 30)
    raw += block("three", 0, 0, 30, 30) + block("three", 35, 0, 20, 20) + block("three", 35, 30, 20, 22) + block("three", 0, 40, 18, 18)
    raw += block("none", 0, 0, 10, 10)
    df = spark.createDataFrame(raw, "device_id string, day long, height int, width int, y int, x int")
    images = as_runs(stencil.pack(df, "device_id", "day"))
    got = mask.region_rows(mask.sky_regions(images)).groupBy("device_id").agg(F.countDistinct("region").alias("n"), F.max("n_regions").alias("m"))
    assert {r.device_id: (r.n, r.m) for r in got.collect()} == {"one": (1, 1), "three": (3, 3)}


def test_constant_brightness_is_not_kept(spark):
    sums = [("d", 1, 4, 4, f, k, v) for f in range(5) for k, v in ((1, 100 + f), (2, 50 + 2 * f), (3, 7))]
    corr = mask.region_correlation(spark.createDataFrame(sums, "device_id string, day long, height int, width int, frame_id long, region int, rb_sum long"))
    assert {r.region: (r["corr"] and round(r["corr"], 9), r.keep) for r in corr.collect()} == {2: (1.0, True), 3: (None, False)}


def test_ingest_splits_requests(spark, sf_dir):
    got = ingest.select_captures(views.requests(spark, sf_dir), views.devices(spark, sf_dir), views.captures(spark, sf_dir))
    assert got["quarantine"].count() + got["windows"].count() == views.requests(spark, sf_dir).count()
    assert got["quarantine"].where("array_contains(errors, 'unknown_device')").count() > 0
    assert got["selected"].where("image_url is null").count() == 0
    assert got["folders"].count() > got["without_images"].count()


def test_masks_of_a_day_are_drawn_once_for_its_frames(monkeypatch):
    drawn, real = [], mask.kernels.drawn
    monkeypatch.setattr(mask.kernels, "drawn", lambda shape, *runs: drawn.append(shape) or real(shape, *runs))
    kind = pa.list_(pa.struct([("mask_day", pa.int64()), ("start", pa.list_(pa.int32())), ("length", pa.list_(pa.int32()))]))
    days = {1: [(1, [0], [2]), (2, [5], [1])], 2: [(2, [5], [1])], 3: []}
    rows = [1, 2, 1, 3, 2, 1]
    masks = pa.array([[dict(zip(("mask_day", "start", "length"), m)) for m in days[day]] for day in rows], kind)
    batch = pa.RecordBatch.from_arrays([pa.array(["a"] * 6), pa.array(rows, pa.int64()), masks], names=["device_id", "day", "masks"])
    held = {}
    for some in (np.arange(6), np.array([5, 4])):
        place, seen, images = mask.sights(batch, (len(some), 2, 3), some, held)
        assert [(int(p), int(d)) for p, d in zip(place, seen)] == [(p, m[0]) for p, i in enumerate(some) for m in days[rows[i]]]
        for d, image in zip(seen, images):
            assert np.flatnonzero(image).tolist() == ([0, 1] if d == 1 else [5])
    assert sorted(drawn) == [(0, 2, 3), (1, 2, 3), (2, 2, 3)]


def test_the_scene_lays_its_sun_over_whole_pictures(spark, sf_dir):
    """An expression a row of pixels made code that the JVM does not compile."""
    images = views.scene_images(spark, sf_dir)
    assert images._jdf.queryExecution().optimizedPlan().toString().upper().count("CASE WHEN") < 24
    untimed = views.frames(spark, sf_dir).where("tod is null").count()
    assert images.where(F.col("data").isNull()).count() == 0 and untimed == 0


def test_correlation_lists_no_frames(spark):
    """Repeated ids are one frame, whose region 1 is the brightest of theirs; frames without region 1 are left out."""
    schema = "device_id string, day long, height int, width int, frame_id long, region int, rb_sum long"
    sums = [("d", 1, 4, 4, f, k, v) for f, k, v in ((1, 1, 5), (1, 1, 9), (1, 2, 7), (1, 2, 8), (2, 1, 3), (2, 2, 4), (3, 2, 90), (4, 1, 6))]
    corr = mask.region_correlation(spark.createDataFrame(sums, schema))
    assert "collect_list" not in corr._jdf.queryExecution().optimizedPlan().toString()
    (row,) = corr.collect()
    assert row["region"] == 2 and row["corr"] == pytest.approx(np.corrcoef([9, 9, 3], [7, 8, 4])[0, 1])


def test_stacks_take_frames_of_a_key_side_by_side():
    rng = np.random.default_rng(3)
    sizes = [(2, 3), (2, 3), (4, 1), (2, 3), (4, 1), (2, 3), (2, 3)]
    data = [rng.integers(0, 256, h * w * 3).astype(np.uint8).tobytes() for h, w in sizes]
    data[3] = None
    columns = {
        "device_id": pa.array(["b", "a", None, "a", "b", "b", None]), "day": pa.array([1, 2, None, 2, 1, 1, None], pa.int64()),
        "height": pa.array([h for h, _ in sizes], pa.int32()), "width": pa.array([w for _, w in sizes], pa.int32()),
    }
    for kind in (pa.binary(), pa.large_binary()):
        batch = pa.RecordBatch.from_pydict(columns | {"data": pa.array(data, kind)})
        for some in (batch, batch.slice(1, 5), batch.slice(0, 1), batch.slice(3, 1), batch.slice(0, 0)):
            number, keys = numbered(some, "device_id", "day")
            assert [keys[n] for n in number] == list(zip(some.column("device_id").to_pylist(), some.column("day").to_pylist()))
            bytes_of, seen = some.column("data").to_pylist(), []
            for rows, bgr in stacks(some, beside=number):
                assert [x.tobytes() for x in bgr] == [bytes_of[i] for i in rows]
                assert (np.diff(number[rows]) >= 0).all()
                seen += rows.tolist()
            assert sorted(seen) == [i for i, x in enumerate(bytes_of) if x is not None]
    wrong = pa.RecordBatch.from_pydict({"height": pa.array([2, 2]), "width": pa.array([2, 2]), "data": pa.array([bytes(12), bytes(11)])})
    with pytest.raises(ValueError):
        list(stacks(wrong))
