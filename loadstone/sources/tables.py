"""Table scans for export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: rows of the fullest stream, as a multiple of those of the emptiest, up to which
# streams count as even.
EVEN = 1.1

# Rows, and splits with rows, that one task of an export reads at most, as far as
# splits allow.
TASK_ROWS, TASK_SPLITS = 4_000_000, 8


def export_scan(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    """A whole table, by catalog name or as a DataFrame."""
    return source if isinstance(source, DataFrame) else spark.table(source)


def export_filter(df: DataFrame, where: str | None) -> DataFrame:
    """Rows that satisfy a SQL predicate; Catalyst hands it on to the file scan."""
    return df.where(F.expr(where)) if where else df


def export_streams(df: DataFrame, streams: int | None) -> DataFrame:
    """``streams`` parallel streams, which are even (see ``EVEN``).

    Splits that hold rows are merged, without a shuffle, if there are that many of
    them and merging leaves the streams even. Otherwise the rows are dealt out
    round-robin, before they are formatted: a file of one row group is one split with
    rows, however many splits Spark makes.
    """
    if streams is None:
        return df
    if streams < 1:
        raise ValueError("at least one stream is required")
    if streams == 1:
        return df.coalesce(1)
    merged = df.coalesce(streams)
    found = count_per_stream(merged).agg(
        F.count(F.lit(1)).alias("streams"), (F.max("rows") <= EVEN * F.min("rows")).alias("even")
    ).first()
    return merged if found["streams"] == streams and found["even"] else df.repartition(streams)


def export_tasks(df: DataFrame, streams: int | None) -> DataFrame:
    """:func:`export_streams`, but streams of more than ``TASK_ROWS`` rows or ``TASK_SPLITS``
    splits are several: what a task reads does not grow with the table. Their splits are
    merged, without a shuffle, into as many as it takes, even or not."""
    if streams is None or streams < 1:
        return export_streams(df, streams)
    found = count_per_stream(df).agg(F.count(F.lit(1)).alias("splits"), F.sum("rows").alias("rows")).first()
    splits, rows = found["splits"], found["rows"] or 0
    tasks = max(min(splits, -(-rows // TASK_ROWS)), -(-splits // TASK_SPLITS))
    return df.coalesce(tasks) if tasks > streams else export_streams(df, streams)


def count_per_stream(df: DataFrame) -> DataFrame:
    """Rows of each stream that has any: (stream, rows)."""
    return df.groupBy(F.spark_partition_id().alias("stream")).agg(
        F.count(F.lit(1)).alias("rows")
    )
