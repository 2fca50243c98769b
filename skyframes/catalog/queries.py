"""Registered queries: one per operator, over the driver's tables or views derived from them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframes.catalog import views
from skyframes.functions import color
from skyframes.functions.names import time_of_day
from skyframes.operators import edges, mask, pairing, regions, requests, stencil, sun, track
from skyframes.operators.kernels import fill
from skyframes.operators.stacks import run_rows
from skyframes.plans import ingest, sky, suntrack
from skyframes.session import stage_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# the scene is 24 pixels wide, so its suns are smaller than the default limits
SCENE_SUN = {"least": 1, "most": 5}
THETA = 0.79
TRACK_DIGITS = {"theta": 6, "a2": 6, "a1": 6, "a0": 4, "rss": 4}


def _query(name: str):
    def add(fn: Query) -> Query:
        def plain(spark: SparkSession, sf_dir: str) -> DataFrame:
            """Integers and flags as BIGINT, so that both engines report the same types."""
            df = fn(spark, sf_dir)
            narrow = ("int", "smallint", "tinyint", "boolean")
            return df.select(*[F.col(c).cast("bigint").alias(c) if t in narrow else F.col(c) for c, t in df.dtypes])

        QUERIES[name] = plain
        return fn

    return add


def _windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return requests.epoch_windows(requests.validate(views.requests(spark, sf_dir)), views.devices(spark, sf_dir))


@_query("s01_capture_range_scan")
def s01(spark, sf_dir):
    return requests.captures_in_windows(_windows(spark, sf_dir), views.captures(spark, sf_dir))


@_query("s02_device_offset")
def s02(spark, sf_dir):
    checked = requests.validate(views.requests(spark, sf_dir))
    return requests.with_offset(checked, views.devices(spark, sf_dir)).select("request_id", "dev_id", "utc")


@_query("s03_device_offset_latest")
def s03(spark, sf_dir):
    metadata = views.captures(spark, sf_dir).withColumn("utc", F.expr("cast(frame_id % 25 - 12 + 0.5 as double)"))
    return requests.latest_offsets(metadata)


@_query("s06_pixel_rows")
def s06(spark, sf_dir):
    return stencil.pixel_rows(views.scene_images(spark, sf_dir), "frame_id")


@_query("s08_landing_names")
def s08(spark, sf_dir):
    return requests.landing_names(views.captures(spark, sf_dir), views.devices(spark, sf_dir))


@_query("s08_landing_folders")
def s08_folders(spark, sf_dir):
    return requests.landing_folders(_windows(spark, sf_dir))


@_query("p01_request_validate")
def p01(spark, sf_dir):
    return requests.validate(views.requests(spark, sf_dir)).withColumn("errors", F.array_join("errors", ","))


@_query("p02_quarantine_counts")
def p02(spark, sf_dir):
    return requests.quarantine_counts(requests.validate(views.requests(spark, sf_dir)))


@_query("p02_window_rejects")
def p02_rejects(spark, sf_dir):
    checked = requests.validate(views.requests(spark, sf_dir))
    return requests.window_rejects(checked, views.devices(spark, sf_dir)).select("request_id", "dev_id", F.array_join("errors", ",").alias("errors"))


@_query("e1_ingest")
def e1(spark, sf_dir):
    return ingest.every_request(views.requests(spark, sf_dir), views.devices(spark, sf_dir))


@_query("s08_landing_rejects")
def s08_rejects(spark, sf_dir):
    return requests.landing_rejects(views.captures(spark, sf_dir), views.devices(spark, sf_dir))


@_query("p03_epoch_window")
def p03(spark, sf_dir):
    return _windows(spark, sf_dir)


@_query("p04_three_day_window")
def p04(spark, sf_dir):
    return requests.three_day_requests(views.devices(spark, sf_dir), F.lit("2024-01-31").cast("date"))


@_query("p05_has_image")
def p05(spark, sf_dir):
    return requests.with_image(views.captures(spark, sf_dir))


@_query("p05_requests_without_images")
def p05_without(spark, sf_dir):
    windows = stage_table(_windows(spark, sf_dir), "windows")
    selected = requests.captures_in_windows(windows, requests.with_image(views.captures(spark, sf_dir)), first=True)
    return requests.requests_without_images(windows, selected).select("request_id", "device_id")


@_query("p06_name_time_of_day")
def p06(spark, sf_dir):
    names = requests.landing_names(views.captures(spark, sf_dir), views.devices(spark, sf_dir))
    return names.select("frame_id", time_of_day(F.col("name")).alias("tod"))


@_query("p07_color_rule")
def p07(spark, sf_dir):
    sky_color = color.is_sky_color(F.col("b"), F.col("g"), F.col("r"))
    return stencil.pixel_rows(views.scene_images(spark, sf_dir), "frame_id").select("frame_id", "y", "x", sky_color.alias("color"))


@_query("p08_luma_hue")
def p08(spark, sf_dir):
    bgr = [F.col(c) for c in "bgr"]
    return stencil.pixel_rows(views.scene_images(spark, sf_dir), "frame_id").select(
        "frame_id", "y", "x", color.luma(*bgr).alias("luma"), color.hue(*bgr).alias("hue"), color.is_sun_hue(*bgr).alias("sunny")
    )


@_query("w01_erode")
def w01(spark, sf_dir):
    eroded = views.tile_images(spark, sf_dir).withColumn("pos", stencil.reshape(F.col("pos"), stencil.erode(3)))
    return stencil.position_rows(eroded, "pos", "image_key")


@_query("w02_dilate")
def w02(spark, sf_dir):
    grown = views.tile_images(spark, sf_dir).withColumn("pos", stencil.reshape(F.col("pos"), stencil.dilate(3)))
    return stencil.position_rows(grown, "pos", "image_key")


@_query("w03_bilateral")
def w03(spark, sf_dir):
    return stencil.value_rows(edges.smoothed(views.scene_images(spark, sf_dir), "frame_id"), "smooth", "frame_id")


@_query("w04_gradient_nms")
def w04(spark, sf_dir):
    found = edges.ridges(views.scene_images(spark, sf_dir), "frame_id")
    return stencil.position_rows(found, "ridge.pos", "frame_id", values={"mag": "ridge.mag"})


@_query("w05_edge_pixels")
def w05(spark, sf_dir):
    return run_rows(edges.edge_images(views.scene_images(spark, sf_dir), "frame_id"), "frame_id")


@_query("g01_components")
def g01(spark, sf_dir):
    tiles = views.tile_images(spark, sf_dir).withColumn("parts", regions.components(F.col("pos")))
    return regions.component_rows(tiles, "parts", "image_key")


@_query("g02_fill_holes")
def g02(spark, sf_dir):
    tiles = views.tile_images(spark, sf_dir).withColumn("pos", stencil.reshape(F.col("pos"), fill))
    return stencil.position_rows(tiles, "pos", "image_key")


@_query("a07_region_area_topk")
def a07(spark, sf_dir):
    tiles = views.tile_images(spark, sf_dir).withColumn("parts", regions.components(F.col("pos"), fill))
    return regions.ranked_regions(tiles, "parts", F.lit(3), F.expr("height * width / 20"), "image_key")


@_query("a01_pixel_hits")
def a01(spark, sf_dir):
    return mask.hit_rows(mask.pixel_hits(views.scene_images(spark, sf_dir))).drop("height", "width")


@_query("a03_sky_mask_raw")
def a03(spark, sf_dir):
    return mask.mask_rows(mask.raw_mask(mask.pixel_hits(views.scene_images(spark, sf_dir)))).drop("height", "width")


@_query("g03_regions")
def g03(spark, sf_dir):
    return mask.region_rows(sky.regions(views.scene_images(spark, sf_dir))).drop("height", "width")


@_query("a04_region_rb_sum")
def a04(spark, sf_dir):
    images = views.scene_images(spark, sf_dir)
    return mask.region_sums(images, sky.regions(images)).drop("height", "width")


@_query("a06_region_corr")
def a06(spark, sf_dir):
    images = views.scene_images(spark, sf_dir)
    correlation = mask.region_correlation(mask.region_sums(images, sky.regions(images)))
    return correlation.drop("height", "width").withColumn("corr", F.round("corr", 6))


@_query("g04_region_decide")
def g04(spark, sf_dir):
    images = views.scene_images(spark, sf_dir)
    return mask.region_rows(sky.kept_regions(images, sky.regions(images))).select("device_id", "day", "y", "x", "region")


@_query("g05_final_mask")
def g05(spark, sf_dir):
    return mask.mask_rows(sky.sky_mask(views.scene_images(spark, sf_dir))).drop("height", "width")


@_query("j01_mask_apply")
def j01(spark, sf_dir):
    images = views.scene_images(spark, sf_dir)
    found = mask.masked_pixels(images, sky.sky_mask(images))
    rows = stencil.position_rows(found, "pos", "frame_id", "mask_day", values={"bgr": "bgr"})
    return rows.select("frame_id", "mask_day", "y", "x", *[channel(F.col("bgr")).alias(c) for c, channel in zip("bgr", (color.blue, color.green, color.red))])


@_query("j02_day_pair_match")
def j02(spark, sf_dir):
    return pairing.day_pairs(views.timed_captures(spark, sf_dir))


@_query("j03_matched_frames")
def j03(spark, sf_dir):
    frames = views.timed_captures(spark, sf_dir)
    return pairing.matched_frames(frames, pairing.day_pairs(frames))


def _sun_pairs(spark, sf_dir):
    circles = views.suns(spark, sf_dir)
    pairs = pairing.day_pairs(circles.select("frame_id", "device_id", "day", "tod"))
    return pairing.pairs_with_suns(pairs, circles)


@_query("j04_sun_overlap")
def j04(spark, sf_dir):
    sun_at = F.struct("cx", "cy", "r")
    match = F.struct(*[F.col(f"match_{c}").alias(c) for c in ("cx", "cy", "r")])
    return _sun_pairs(spark, sf_dir).select("device_id", "day", "frame_id", "match_id", pairing.overlap(sun_at, match).alias("overlap"))


@_query("u05_sun_pairs")
def u05(spark, sf_dir):
    return pairing.overlapping(_sun_pairs(spark, sf_dir))


@_query("u01_sun_region")
def u01(spark, sf_dir):
    images = views.scene_images(spark, sf_dir)
    return run_rows(sun.sun_regions(images, sky.sky_mask(images)), "frame_id", "mask_day")


def _tile_parts(spark, sf_dir):
    """Each component of each filled tile as an image of its own."""
    tiles = views.tile_images(spark, sf_dir).withColumn("parts", regions.components(F.col("pos"), fill))
    rows = regions.component_rows(tiles, "parts", "image_key", "height", "width").withColumnRenamed("label", "component")
    return stencil.pack(rows, "image_key", "component")


@_query("u02_enclosing_circle")
def u02(spark, sf_dir):
    return sun.enclosing_circles(_tile_parts(spark, sf_dir)).select("image_key", "component", "cx", "cy", "r")


@_query("u03_disc_area")
def u03(spark, sf_dir):
    tiles = views.tile_images(spark, sf_dir).select("image_key", F.col("pos").alias("mask_pos"))
    discs = sun.enclosing_circles(_tile_parts(spark, sf_dir)).join(tiles, "image_key")
    return sun.disc_areas(discs, "mask_pos").select("image_key", "component", "cx", "cy", "r", "disc_area")


@_query("u04_sun_detect")
def u04(spark, sf_dir):
    images = views.scene_images(spark, sf_dir)
    return sun.detect(images, sky.sky_mask(images), **SCENE_SUN)


@_query("e3_agreed_suns")
def e3(spark, sf_dir):
    images = views.scene_images(spark, sf_dir)
    return suntrack.agreed_suns(images, sky.sky_mask(images), **SCENE_SUN).select(
        "device_id", "day", "neighbour_day", "frame_id", "match_id", "cx", "cy", "r", "match_cx", "match_cy", "match_r"
    )


@_query("e3_sun_track")
def e3_track(spark, sf_dir):
    images = views.scene_images(spark, sf_dir)
    tracks = suntrack.sun_track(images, sky.sky_mask(images), views.SIDE, views.SIDE, **SCENE_SUN)
    return tracks.withColumns({c: F.round(c, d) for c, d in TRACK_DIGITS.items()})


@_query("t01_centroids")
def t01(spark, sf_dir):
    return track.centroids(u05(spark, sf_dir))


@_query("t02_flip_rotate")
def t02(spark, sf_dir):
    turned = track.flip_rotate(t01(spark, sf_dir), F.lit(THETA))
    return turned.select("device_id", "day", F.round("u", 4).alias("u"), F.round("v", 4).alias("v"))


@_query("t03_parabola_fit")
def t03(spark, sf_dir):
    fits = track.fit_tracks(t01(spark, sf_dir))
    return fits.withColumns({c: F.round(c, d) for c, d in TRACK_DIGITS.items()})


@_query("t04_curve_points")
def t04(spark, sf_dir):
    points = track.track_points(track.fit_tracks(t01(spark, sf_dir)))
    return points.withColumns({c: F.round(c, 4) for c in ("x", "y")})
