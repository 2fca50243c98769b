"""Decoded frames at rest: a bucketed table that an import extends and that joins never move.

`store_frames` decodes each file once. A frame and a file that gives none are rows of one table, so
what is refused is written in the same pass. Rows lie in buckets by device, day, picture size and
slice of the day. A slice is a stretch of `slice_seconds`; names are unique per device and second,
so no (device, day, slice) has more frames than seconds, and a busy camera spreads over buckets.
Results that meet the frames of a day go to those buckets (`operators.mask.beside_pictures`).

An import lists the files, which reads no content, and takes those whose path the table does not
have yet: only files modified since the oldest of them are decoded. Running it again after a
failure stores what is missing. Files are told apart by their path, frames by their name.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyframes.sources.images import named, three_channels

BUCKETED = ("device_id", "day", "height", "width", "slice")
SCHEMA = "frame_id bigint, device_id string, day bigint, tod bigint, path string, height int, width int, slice int, reason string, data binary"


def _plain(path):
    return F.regexp_replace(path, "^file:/+", "file:/")


def _layout_path(target: str) -> str:
    return f"{target.rstrip('/')}.layout"


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def _table(spark: SparkSession, target: str) -> tuple[str, int]:
    """The name of the stored table in this session's catalog, which may be new, and its slice length."""
    layout = spark.read.parquet(_layout_path(target)).first()
    name = f"frames_{hashlib.md5(target.rstrip('/').encode()).hexdigest()}"
    spark.sql(
        f"create table if not exists {name} ({SCHEMA}) using parquet options (compression 'zstd') "
        f"clustered by ({', '.join(BUCKETED)}) into {layout['buckets']} buckets location {_quoted(target)}"
    )
    return name, layout["slice_seconds"]


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listed_files(spark: SparkSession, source: str) -> DataFrame:
    """(path, modified) of the files under a path; their content is not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    return files.select(_plain(F.col("path")).alias("path"), F.col("modificationTime").alias("modified"))


def store_frames(spark: SparkSession, source: str, target: str, buckets: int = 200, slice_seconds: int = 600) -> int:
    """Decode the files under `source` that `target` does not have yet, and add them; returns how many there were.

    The number of buckets and the slice length are those of the first import.
    """
    if not _exists(spark, _layout_path(target)):
        spark.createDataFrame([(buckets, slice_seconds)], "buckets int, slice_seconds int").write.parquet(_layout_path(target))
    name, slice_seconds = _table(spark, target)
    stored = spark.table(name).select("path")
    new = F.col("held").isNull()
    # times are compared in whole seconds
    since = F.date_format(F.min(F.when(new, F.col("modified"))) - F.expr("interval 2 seconds"), "yyyy-MM-dd'T'HH:mm:ss")
    known = listed_files(spark, source).join(stored.withColumn("held", F.lit(True)).distinct(), "path", "left")
    first, n, held = known.agg(since, F.count_if(new), F.count_if("held")).first()
    if not n:
        return 0
    reader = spark.read.format("image").option("dropInvalid", False).option("recursiveFileLookup", True)
    if held:
        reader = reader.option("modifiedAfter", first)
    image = F.col("image")
    files = reader.load(source).select(_plain(image["origin"]).alias("path"), "image")
    if held:
        files = files.join(stored, "path", "left_anti")
    decoded = image["height"] > 0
    frame = F.regexp_extract("path", r"([^/]+)$", 1)
    rows = files.select(F.xxhash64(frame).alias("frame_id"), *named(frame), "path", "image")
    bad_name = F.col("device_id").isNull() | F.col("day").isNull() | F.col("tod").isNull()
    reason = F.when(bad_name, "name").when(~decoded, "broken")
    rows = rows.select(
        "frame_id", "device_id", "day", "tod", "path", F.when(decoded, image["height"]).alias("height"), F.when(decoded, image["width"]).alias("width"),
        F.floor(F.col("tod") / slice_seconds).cast("int").alias("slice"), reason.alias("reason"), F.when(reason.isNull(), three_channels(image)).alias("data"),
    )
    parts = spark.read.parquet(_layout_path(target)).first()["buckets"]
    rows.repartition(parts, *BUCKETED).write.insertInto(name)
    return n


def read_frames(spark: SparkSession, target: str) -> DataFrame:
    """Stored frames as (frame_id, device_id, day, tod, path, height, width, slice, data); nothing is decoded."""
    return spark.table(_table(spark, target)[0]).where("reason is null").drop("reason")


def refused_files(spark: SparkSession, target: str) -> DataFrame:
    """(path, reason) of the files that gave no frame: `name` does not match, or the image is `broken`."""
    return spark.table(_table(spark, target)[0]).where("reason is not null").select("path", "reason")


def frame_collisions(frames: DataFrame) -> DataFrame:
    """(frame_id, names) of ids that frames of several names share: an id is a 64-bit hash of the name."""
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    known = frames.select("frame_id", name.alias("name")).distinct()
    many = known.groupBy("frame_id").agg(F.count("*").alias("n"), F.min("name").alias("a"), F.max("name").alias("b")).where("n > 1")
    return many.select("frame_id", F.array("a", "b").alias("names"))
