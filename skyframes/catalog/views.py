"""Inputs of the registered queries, derived from the driver's tables (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframes.functions.names import epoch_seconds
from skyframes.operators import stencil

SIDE = 24
TILE = 8
KEYS = ("frame_id", "device_id", "day", "tod")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "events").select(
        F.col("event_id").alias("frame_id"),
        F.expr("concat('04E67', lpad(concat('', user_id % 4), 7, '0'))").alias("device_id"),
        epoch_seconds(F.col("ts")).alias("ts"),
        F.expr("case when event_type <> 'error' then concat('img/', event_id, '.jpg') end").alias("image_url"),
    )


def devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        _table(spark, sf_dir, "customer")
        .where("c_custkey % 6 <> 3")
        .groupBy(F.expr("concat('04E67', lpad(concat('', c_custkey % 6), 7, '0'))").alias("device_id"))
        .agg(F.expr("cast(min(c_nationkey) - 12 + 0.5 as double)").alias("utc"))
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey as request_id",
        """case when o_orderkey % 11 = 0 then 'cam-7'
             when o_orderkey % 5 = 0 then concat(' 04e67', lpad(concat('', o_orderkey % 4), 7, '0'), ' ')
             else concat('04E67', lpad(concat('', o_orderkey % 4), 7, '0')) end as dev_id""",
        """case o_orderkey % 13 when 0 then '2024/01/05' when 1 then '2024-13-05' when 2 then '24-01-05'
             when 3 then '2024-02-31' when 4 then '2024-01-40'
             else concat('2024-01-', lpad(concat('', 1 + o_orderkey % 28), 2, '0')) end as d1""",
        """case o_orderkey % 7 when 0 then '9.00am' when 1 then '13:00PM' when 2 then '9:75am'
             when 3 then '12:15 am' else '09:00AM' end as t1""",
        "concat('2024-01-', lpad(concat('', 1 + o_orderkey % 28), 2, '0')) as d2",
        "case o_orderkey % 17 when 0 then '07:00PMx' when 3 then '09:01AM' else '07:00PM' end as t2",
    )


def timed_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All captures with their day number (1 is 2024-01-01) and time of day."""
    return captures(spark, sf_dir).selectExpr(
        "frame_id", "device_id", "ts div 86400 - 19722 as day", "ts % 86400 as tod"
    )


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All captures with what their pictures show: brightness of sky and wall."""
    return timed_captures(spark, sf_dir).selectExpr("*", "(frame_id * 37) % 50 as lum", "(frame_id * 53 + 11) % 47 as wal")


def scene_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scene as images: (frame_id, device_id, day, tod, height, width, data)."""
    shaped = (
        frames(spark, sf_dir)
        .selectExpr("*", "2 + (11 * tod) div 86400 as cx")
        .selectExpr("*", "3 + ((cx - 7) * (cx - 7)) div 8 as cy")
        # a frame row is tiny until its bytes exist: spread the rows first
        .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "frame_id")
        .selectExpr("*", "concat('C896', hex(105 + lum)) as sky", "concat('C896', hex(105 + wal)) as wall", "'3C4650' as ground")
        .selectExpr(
            "*",
            f"unhex(concat(repeat(sky, 14), repeat(ground, 2), repeat(sky, {SIDE - 16}))) as both_skies",
            f"unhex(concat(repeat(sky, 14), repeat(ground, {SIDE - 14}))) as one_sky",
            f"unhex(repeat(ground, {SIDE})) as bare",
            f"unhex(repeat(wall, {SIDE})) as walled",
        )
    )
    kinds = ["both_skies"] * 11 + ["one_sky"] * 3 + ["bare"] * 4 + ["walled"] * (SIDE - 18)
    data = "sunless"
    # the sun: half widths 1 2 2 2 1 of the disc of squared radius 5, which lies within the picture; none without a time of day
    for dy, half in zip(range(-2, 3), (1, 2, 2, 2, 1)):
        data = f"overlay({data} placing X'{'FFFFFF' * (2 * half + 1)}' from cast(3 * ({SIDE} * (cy + {dy}) + cx - {half}) + 1 as int))"
    pictures = shaped.selectExpr(*KEYS, "cx", "cy", f"concat({', '.join(kinds)}) as sunless")
    return pictures.selectExpr(*KEYS, f"{SIDE} as height", f"{SIDE} as width", f"coalesce({data}, sunless) as data")


def scene_pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scene as pixel rows (frame_id, device_id, day, tod, y, x, b, g, r)."""
    return stencil.pixel_rows(scene_images(spark, sf_dir), *KEYS)


def tile_images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Irregular 8x8 binary images: (image_key, label, height, width, pos)."""
    hits = F.array_compact(F.transform("embedding", lambda e, i: F.when(e > 0, i)))
    return _table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("image_key"), "label", F.lit(TILE).alias("height"), F.lit(TILE).alias("width"), hits.alias("pos")
    )


def suns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One circle per capture: (frame_id, device_id, day, tod, cx, cy, r)."""
    return (
        timed_captures(spark, sf_dir)
        .selectExpr("*", "40 + (560 * tod) div 86400 + (frame_id * 29) % 61 - 30 as cx", "15 + frame_id % 20 as r")
        .selectExpr(*KEYS, "cx", "120 + ((cx - 320) * (cx - 320)) div 400 + (frame_id * 37) % 7 as cy", "r")
    )
