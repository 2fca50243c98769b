"""Image files and result tables: import, compaction, decoding, storage."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyframes.functions.names import time_of_day

# fixed pattern of a frame's file name: device, month, day, year
FRAME_NAME = r"([^/_]+)_(\d{2})-(\d{2})-(\d{4})_\d{2}-\d{2}-\d{2}\.[^./]+$"


def named(name: Column) -> list[Column]:
    """device_id, day (days since 1970) and tod read from a file name; null where it does not say."""
    part = [F.nullif(F.regexp_extract(name, FRAME_NAME, k), F.lit("")) for k in (1, 4, 2, 3)]
    date = F.concat_ws("-", *part[1:]).try_cast("date")
    return [part[0].alias("device_id"), F.unix_date(date).cast("bigint").alias("day"), time_of_day(name).alias("tod")]


def _frame_id(name: Column) -> Column:
    """Names are unique per device and second, so their hash identifies a frame."""
    return F.xxhash64(F.regexp_extract(name, r"([^/]+)$", 1))


@F.pandas_udf(T.BinaryType())
def _bgr(data: pd.Series, channels: pd.Series) -> pd.Series:
    def one(raw: bytes, n: int) -> bytes:
        flat = np.frombuffer(raw, np.uint8)
        return np.repeat(flat, 3).tobytes() if n == 1 else flat.reshape(-1, 4)[:, :3].tobytes()

    return pd.Series([one(d, n) for d, n in zip(data, channels)])


def three_channels(image: Column) -> Column:
    """B, G, R bytes of an image struct: a grey byte is repeated, an alpha byte dropped."""
    data, channels = image.getField("data"), image.getField("nChannels")
    odd = channels.isin(1, 4)
    # the function gets the bytes of the pictures that need it, and a lone pixel for the others
    made = _bgr(F.when(odd, data).otherwise(F.lit(b"\0")), F.when(odd, channels).otherwise(1))
    return F.when(odd, made).otherwise(data)


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Images under a path as (frame_id, device_id, day, tod, path, height, width, data).

    Broken files are left out and a name that does not match gives no device; `rejected_files` lists both.
    """
    image = F.col("image")
    origin = F.col("image.origin")
    return (
        spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path)
        .select(
            _frame_id(origin).alias("frame_id"), *named(origin), origin.alias("path"),
            F.col("image.height").alias("height"), F.col("image.width").alias("width"), three_channels(image).alias("data"),
        )
    )


def _plain(path: Column) -> Column:
    return F.regexp_replace(path, "^file:/+", "file:/")


def rejected_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, reason) of the files that give no frame: `name` does not match, or the image is `broken`."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select(_plain(F.col("path")).alias("path"))
    images = spark.read.format("image").option("dropInvalid", True).option("recursiveFileLookup", True).load(path)
    good = images.select(_plain(F.col("image.origin")).alias("path"))
    judged = files.select("path", *named(F.regexp_extract("path", r"([^/]+)$", 1)))
    unnamed = judged.where("device_id is null or day is null or tod is null").select("path", F.lit("name").alias("reason"))
    broken = judged.where("device_id is not null and day is not null and tod is not null").join(good, "path", "left_anti")
    return unnamed.unionByName(broken.select("path", F.lit("broken").alias("reason")))


def read_sequence_files(spark: SparkSession, path: str, splits: int = 4) -> DataFrame:
    """(name, content) pairs of Hadoop sequence files, for a one-way import to Parquet.

    Python handles each record, so this stays off the main path.
    """
    pairs = spark.sparkContext.sequenceFile(path, minSplits=splits)
    return spark.createDataFrame(pairs.map(lambda p: (p[0], bytes(p[1]))), "name string, content binary")


def compact_frames(spark: SparkSession, source: str, target: str) -> None:
    """Pack many small image files into Parquet partitioned by device and day.

    Rebalancing gathers each device and day, and splits those that outgrow a task, so a
    camera with most of the files is written by many tasks. Files whose name does not match
    have no partition; `rejected_files` lists them.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    rows = files.select(name.alias("name"), *named(name), "content").where("device_id is not null and day is not null")
    gathered = rows.hint("rebalance", F.col("device_id"), F.col("day"))
    gathered.write.partitionBy("device_id", "day").parquet(target)


def write_result(table: DataFrame, path: str) -> None:
    """Store a result table (sky_mask, sun_pairs, sun_track) partitioned by day.

    The days of the table are replaced and others stay, so a daily run extends the result and can be
    run again. Rebalancing keeps the number of files small without gathering a busy day in one task.
    """
    days = table.hint("rebalance", F.col("day")).write.option("partitionOverwriteMode", "dynamic")
    days.mode("overwrite").partitionBy("day").parquet(path)
