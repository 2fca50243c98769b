"""Session helpers and stage tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, memory: str = "8g", stages: str | None = None) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own.

    `stages` is the folder for stage tables if no configuration names one.
    """
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("skyframes")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    if stages and not _configured(spark):
        spark.sparkContext.setCheckpointDir(stages)
    return spark


def _configured(spark: SparkSession) -> str | None:
    """The folder of spark.checkpoint.dir; where that is unset, the one that the session was given later."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    return named or spark.sparkContext.getCheckpointDir()


_SCOPE: ContextVar[str] = ContextVar("scope", default="")


def stage_dir(spark: SparkSession) -> str:
    """This run's folder for stage tables, in the folder every executor can reach."""
    shared = _configured(spark)
    if not shared:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return f"{shared.rstrip('/')}/skyframes-{spark.sparkContext.applicationId}{_SCOPE.get()}"


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Removes the stage tables that the block writes when it ends, also by an error; blocks may be nested.

    Results that read them must be written or counted within the block.
    """
    token = _SCOPE.set(f"{_SCOPE.get()}/{uuid.uuid4().hex}")
    try:
        yield
    finally:
        drop_stage_tables(spark)
        _SCOPE.reset(token)


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write a stage result and read it back.

    Lineage is cut by a table that outlives executors, and the file sizes give
    Catalyst true statistics, so a later join broadcasts it only if it is small.
    """
    spark = df.sparkSession
    path = f"{stage_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stage_tables(spark: SparkSession) -> None:
    """Remove the stage tables of this run, or of the innermost `stages` block; results that read them can't be read after that."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stage_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
