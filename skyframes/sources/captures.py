"""Capture metadata at rest, by device and day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "frame_id bigint, ts bigint, image_url string, device_id string, day bigint"


def store_captures(captures: DataFrame, path: str) -> None:
    """Store captures (frame_id, device_id, ts, image_url) in partitions by device and day (days since 1970, UTC).

    The partitions of the table are replaced and others stay, so a later day extends the store and a
    failed run can be run again. Within a partition captures are in order of time, so that a range of hours reads few row groups.
    """
    rows = captures.select("frame_id", "ts", "image_url", "device_id", F.floor(F.col("ts") / 86400).alias("day"))
    parts = rows.hint("rebalance", F.col("device_id"), F.col("day")).sortWithinPartitions("device_id", "day", "ts")
    parts.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("device_id", "day").parquet(path)


def read_captures(spark: SparkSession, path: str) -> DataFrame:
    """Stored captures (frame_id, ts, image_url, device_id, day); `operators.requests.captures_in_windows` reads the days it needs."""
    return spark.read.schema(SCHEMA).parquet(path)
