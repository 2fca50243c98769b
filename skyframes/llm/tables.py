"""Stage tables of the operators and small column helpers."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, or, where that is unset, the one that the session was given later."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not found:
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return found.rstrip("/")


_SCOPE: ContextVar[str] = ContextVar("scope", default="")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}{_SCOPE.get()}/{name}-{uuid.uuid4().hex}"


@contextmanager
def stages(spark: SparkSession) -> Iterator[None]:
    """Removes the stage tables and archives that the block writes when it ends, also by an error; blocks may be nested.

    Results that read them must be written or counted within the block.
    """
    token = _SCOPE.set(f"{_SCOPE.get()}/block-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        removed(spark, f"{shared_dir(spark)}{_SCOPE.get()}")
        _SCOPE.reset(token)


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a stage's rows to the shared folder and read them back: lost executors cost no recomputation.

    The shuffle files of the write are removed when it ends, as the table stands for them.
    """
    spark = df.sparkSession
    path, before = new_folder(spark, name), spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, *paths: str) -> None:
    """Delete stage tables that nothing reads any more."""
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def likely_in(keys: DataFrame, key: str, bits: int = 1 << 23) -> Column:
    """A filter to put before a shuffle join on `key`: true for every key of the table and for few others.

    A Bloom filter of fixed size (`bits`, a power of two; 1 MB), built by an aggregate and read as a
    scalar subquery. It never drops a row of the join; with too many keys it drops few others.
    """
    h = F.xxhash64(key)
    places = F.array(h.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(h, 32).bitwiseAND(F.lit(bits - 1)))
    none = keys.sparkSession.range(bits // 64).select(F.col("id").alias("word"), F.lit(0).cast("bigint").alias("bits"))
    some = keys.select(F.explode(places).alias("at")).selectExpr("shiftright(at, 6) word", "shiftleft(1L, cast(at & 63 as int)) bits")
    words = some.union(none).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    table = words.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda w: w["bits"])).scalar()

    def hit(i: int) -> Column:
        at = places[i]
        return F.get(table, F.shiftright(at, 6).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int"))) != 0

    return hit(0) & hit(1)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches in parts, so that what Python makes of them stays small; freed memory goes back."""
    for b in batches:
        for start in range(0, len(b), rows):
            yield b.slice(start, rows)
        pa.default_memory_pool().release_unused()


def appended(df: DataFrame, schema: str, function: Callable[[pa.RecordBatch], list], without: tuple[str, ...] = ()) -> DataFrame:
    """Add columns that a function computes for a batch of rows at once.

    function: gets a record batch, returns one array (or list) for each new column.
    Columns of the input with the same names are replaced, and those of `without` go.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    new = StructType.fromDDL(schema)
    kept = [c for c in df.columns if c.lower() not in {n.lower() for n in [*new.names, *without]}]
    narrow = df.select(*[F.col(f"`{c}`") for c in df.columns])
    fields = to_arrow_schema(new)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            made = [x if isinstance(x, pa.Array) else pa.array(x, fields.field(i).type) for i, x in enumerate(function(b))]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + made, names=kept + new.names)

    out = StructType([f for f in df.schema.fields if f.name in kept] + new.fields)
    return narrow.mapInArrow(rows, out)
