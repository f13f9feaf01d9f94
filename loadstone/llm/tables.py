"""Reading, intermediate tables and session settings that the operators share."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.fields import quoted
from loadstone.storage import scratch_dir

# Most bytes of one Arrow batch on its way to Python.
BATCH_BYTES = 8 * 1024 * 1024
FEW_BYTES = 32 * 1024 * 1024  # of a side of a join that may be broadcast, all of its values
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def column(df: DataFrame, name: str) -> Column:
    """A column by its plain name, dots and blanks included."""
    return df[quoted(name)]


def whole(df: DataFrame) -> Column:
    """All columns of a row as one struct, out of the way of an operator's own names."""
    return F.struct(*[column(df, c) for c in df.columns])


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: computed once, whoever reads
    them, and safe from the loss of an executor."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows through a reliable checkpoint, for the rounds of an iteration."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(scratch_dir(df.sparkSession, "checkpoint"))
    return df.checkpoint()


def drawn(df: DataFrame, digest: Column, rows: int, total: int) -> DataFrame:
    """At most ``rows`` of ``total`` rows, always the same: those of the smallest digests
    (hex). A threshold a little above what that takes leaves few rows to order."""
    if total > rows:
        share = min(1.0, 1.2 * rows / total)
        df = df.where(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") < int(share * 2**32))
    return df.orderBy(digest).limit(rows)


def small_side(df: DataFrame) -> DataFrame:
    """A side of a join to broadcast, if the bytes of all its values are few; else as it
    is, for Spark to join by its key.

    It keeps whole texts out of a shuffle where a list of ids or digests selects them.
    """
    size = sum((_bytes(column(df, f.name), f.dataType) for f in df.schema), F.lit(0).cast("bigint"))
    return F.broadcast(df) if (df.agg(F.sum(size)).first()[0] or 0) <= FEW_BYTES else df


def _bytes(value: Column, kind: T.DataType) -> Column:
    """What a value takes in a row, its place included."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return 8 + F.coalesce(F.octet_length(value), F.lit(0))
    if isinstance(kind, T.ArrayType):
        each = F.aggregate(value, F.lit(0).cast("bigint"), lambda total, x: total + _bytes(x, kind.elementType))
        return 16 + F.coalesce(each, F.lit(0))
    return F.lit(8)


def bounded_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes, unless the session does so already: rows of
    very long texts would otherwise meet ten thousand at a time."""
    set_to = spark.conf.get(_BATCH, None)
    if set_to is None or set_to.lower().rstrip("b") in ("-1", "2147483647", "9223372036854775807"):
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def give_back_memory() -> None:
    """Collect what earlier tasks of this worker have left in cycles, and hand freed memory
    back to the system where its allocators keep it: Arrow's has a pool of its own."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


@contextmanager
def without_cycle_search() -> Iterator[None]:
    """No search for reference cycles while a task fills large dictionaries: these have
    none, and walking them again and again takes a third of such a task's time."""
    was_on = gc.isenabled()
    give_back_memory()
    gc.disable()
    try:
        yield
    finally:
        if was_on:
            gc.enable()
        give_back_memory()
