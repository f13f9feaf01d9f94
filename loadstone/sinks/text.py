"""Text parts: gzip CSV and SequenceFile."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadstone.session import session_settings
from loadstone.sources.delimited import one_split_each
from loadstone.sources.tables import count_per_stream
from loadstone.storage import delete_tree, scratch_dir

# Rows per exported part, gzip level, SequenceFile codecs.
EXPORT_ROWS_PER_PART = 10_000_000
GZIP_LEVEL = "BEST_SPEED"
SEQUENCE_CODEC = "org.apache.hadoop.io.compress.SnappyCodec"
SEQUENCE_CODEC_FALLBACK = "org.apache.hadoop.io.compress.DefaultCodec"

WHOLE_FILE = 2**40  # bytes of a split that holds any file


def write_csv_gz(
    lines: DataFrame,
    path: str,
    mode: str = "errorifexists",
    rows_per_part: int = EXPORT_ROWS_PER_PART,
) -> None:
    """The one column of ``lines`` as gzip text, a new part every ``rows_per_part`` rows."""
    (
        lines.write.mode(mode)
        .option("compression", "gzip")
        .option("zlib.compress.level", GZIP_LEVEL)
        .option("maxRecordsPerFile", rows_per_part)
        .text(path)
    )


@contextmanager
def bounded_streams(
    lines: DataFrame, rows_per_part: int
) -> Iterator[tuple[DataFrame, dict[int, int]]]:
    """``lines`` in partitions of ``rows_per_part`` rows at most, and the rows of each.

    The counts cover the scan without its columns, and come back as a row for each partition.
    If one is over the bound, every task cuts its rows by a running number into files of a
    scratch folder, which are the partitions from there on: no row is dealt out to another
    executor, and source, filter and formats are gone through once.
    """
    counts = _counts(lines)
    if max(counts.values(), default=0) <= rows_per_part:
        yield lines, counts
        return
    spark = lines.sparkSession
    cut = scratch_dir(spark, "streams")
    try:
        lines.write.option("maxRecordsPerFile", rows_per_part).option("compression", "lz4").orc(cut)
        # Whatever the sizes of the files, each is one partition.
        with session_settings(spark, one_split_each(spark, WHOLE_FILE)):
            parts = spark.read.schema(lines.schema).orc(cut)
            yield parts, _counts(parts)
    finally:
        delete_tree(spark, cut)


def _counts(lines: DataFrame) -> dict[int, int]:
    return {r["stream"]: r["rows"] for r in count_per_stream(lines).orderBy("stream").collect()}


def write_sequence(
    lines: DataFrame, path: str, rows_per_part: int = EXPORT_ROWS_PER_PART
) -> dict[int, int]:
    """``lines`` as block-compressed SequenceFile parts: key ``""``, value line and newline.

    DataFrames have no writer for this format, so this is the one RDD step, in
    its Scala form: ``ds.as[(String, String)].rdd.saveAsSequenceFile(path, codec)``.
    The rows stay in the JVM; PySpark's RDD method would pass each of them
    through a Python worker. The codec is Snappy where it can be had. Returns
    the rows of each part that has any.
    """
    with bounded_streams(lines, rows_per_part) as (bounded, counts):
        _save_sequence(bounded, path)
    return counts


def _save_sequence(lines: DataFrame, path: str) -> None:
    jvm = lines.sparkSession._jvm
    pairs = lines.select(F.lit("").alias("_1"), F.concat(lines[0], F.lit("\n")).alias("_2"))
    string = jvm.org.apache.spark.sql.Encoders.STRING()
    encoder = jvm.org.apache.spark.sql.Encoders.tuple(string, string)
    rdd = getattr(pairs._jdf, "as")(encoder).rdd()
    tag = jvm.scala.reflect.ClassTag.apply(jvm.java.lang.Class.forName("java.lang.String"))
    writable = jvm.org.apache.spark.WritableFactory.stringWritableFactory()
    saver = jvm.org.apache.spark.rdd.RDD.rddToSequenceFileRDDFunctions(
        rdd, tag, tag, writable, writable
    )
    codec = jvm.java.lang.Class.forName(_codec(lines))
    saver.saveAsSequenceFile(path, jvm.scala.Option.apply(codec))


def _codec(lines: DataFrame) -> str:
    jvm = lines.sparkSession._jvm
    try:
        jvm.java.lang.Class.forName("org.xerial.snappy.Snappy")
        return SEQUENCE_CODEC
    except Exception:  # noqa: BLE001 - no Snappy on the class path
        return SEQUENCE_CODEC_FALLBACK
