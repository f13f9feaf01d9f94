"""Delimited text: line scan, field split and sample."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadstone.session import session_settings
from loadstone.storage import total_bytes

DEFAULT_DELIMITER = "þ"
DEFAULT_SAMPLE_ROWS = 4096

# Most bytes of a sample, which passes through the driver.
SAMPLE_BYTES = 64 * 1024 * 1024

# Suffixes of files that Hadoop cannot cut into splits.
UNSPLITTABLE_SUFFIXES = (".gz", ".zst", ".lz4", ".snappy", ".deflate")

# Fixed value: splits of a job's own files.
OWN_SPLIT_BYTES = 128 * 1024 * 1024

LINE = "__line"

# Where a line of a file stands: its file, the first byte and the length of the split it was
# read in, and the lines of that split before it.
FILE, BLOCK, BLOCK_BYTES, NTH = "__file", "__block", "__block_bytes", "__nth"
PLACE = (FILE, BLOCK, BLOCK_BYTES, NTH)
_IN_PARTITION = (1 << 33) - 1

_REGEX_META = set("\\^$.|?*+()[]{}")


def source_paths(sources: str | list[str]) -> list[str]:
    """The paths named by one or several source arguments, each of which may be
    a comma separated list."""
    given = [sources] if isinstance(sources, str) else list(sources)
    paths = [p for arg in given for p in arg.split(",") if p]
    if not paths:
        raise ValueError("source not provided")
    return paths


def scan_lines(spark: SparkSession, sources: str | list[str]) -> DataFrame:
    """Every line of every source as one row (``value``), blank lines included.

    The files are cut into splits at line ends, so the scan is as parallel as
    the input is large, whether it is one file or many.
    """
    return spark.read.text(source_paths(sources))


def placed_lines(scan: DataFrame) -> DataFrame:
    """The lines of a scan of files with their places, as long as each split is a partition
    of its own (see :func:`one_split_each`)."""
    return scan.select(
        "value",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.col("_metadata.file_block_length").alias(BLOCK_BYTES),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION)).alias(NTH),
    )


def one_split_each(spark: SparkSession, split_bytes: int | None = None) -> dict:
    """Settings under which a scan packs no two splits into a partition; with
    ``split_bytes`` files are cut into splits of just that size."""
    limit, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    if split_bytes:
        return {limit: split_bytes, cost: split_bytes}
    # What a split may hold at most is also what opening it is said to cost: it fills a partition.
    return {cost: max(_bytes(spark, limit), _bytes(spark, cost))}


def own_splits() -> dict:
    """Settings for scans of what a job has written itself, however small the session's
    splits are."""
    limit, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    return {limit: OWN_SPLIT_BYTES, cost: OWN_SPLIT_BYTES // 32}


def numbered(rows: DataFrame, split_bytes: int | None, scratch: str) -> DataFrame:
    """``rows`` with the places of lines, and ``source`` and ``row`` for them: the file, and
    the number of the line in it, from 1.

    Lines in front of a split are counted, by a scan of the files that need it, in splits of
    the same size; their sums by file have a row for each split.
    """
    spark = rows.sparkSession
    later = [r[0] for r in rows.where(F.col(BLOCK) > 0).select(FILE).distinct().collect()]
    row = F.col(NTH) + 1
    if later:
        names = [literal_path(unquote(f)) for f in later]
        scan = spark.read.text(names)
        places = scan.select(F.col("_metadata.file_path").alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK))
        # A task takes many splits where these are small: their number is up to the session.
        tasks = max(4 * spark.sparkContext.defaultParallelism, -(-total_bytes(spark, names) // OWN_SPLIT_BYTES))
        with session_settings(spark, one_split_each(spark, split_bytes)):
            places.coalesce(tasks).groupBy(FILE, BLOCK).agg(F.count(F.lit(1)).alias("n")).write.parquet(scratch)
        upto = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
        before = spark.read.parquet(scratch).withColumn("before", F.sum("n").over(upto)).drop("n")
        rows = rows.join(before, [FILE, BLOCK], "left")
        row = row + F.coalesce("before", F.lit(0))
    return rows.select("*", F.col(FILE).alias("source"), row.alias("row")).drop(*PLACE, "before")


def literal_path(path: str) -> str:
    """A path whose characters are not taken for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def max_split_bytes(spark: SparkSession) -> int:
    """The largest split that the session cuts files into."""
    return _bytes(spark, "spark.sql.files.maxPartitionBytes")


def even_split_bytes(spark: SparkSession, total: int, tasks: int) -> int:
    """The size of splits that gives each task one, within the session's bounds."""
    least = _bytes(spark, "spark.sql.files.openCostInBytes")
    return min(max_split_bytes(spark), max(least, -(-total // tasks)))


def _bytes(spark: SparkSession, key: str) -> int:
    text = spark.conf.get(key).lower().rstrip("b")
    scale = {"k": 10, "m": 20, "g": 30, "t": 40}.get(text[-1:], 0)
    return int(text[:-1] if scale else text) << scale


def is_splittable(lines: DataFrame) -> bool:
    """Whether all files of a scan can be cut into splits."""
    return not any(f.lower().endswith(UNSPLITTABLE_SUFFIXES) for f in lines.inputFiles())


def delimiter_char(delimiter: str) -> str:
    if len(delimiter) != 1:
        raise ValueError(f"a delimiter is one character, not {delimiter!r}")
    return delimiter


def split_pattern(delimiter: str) -> str:
    # A single character, escaped only where it must be, is split without a
    # regular expression; \Q..\E would compile one for each row.
    ch = delimiter_char(delimiter)
    return f"\\{ch}" if ch in _REGEX_META else ch


def field_array(line: Column, delimiter: str, width: int = -1) -> Column:
    """All fields of a line; with a ``width``, the surplus stays in one last element."""
    limit = width + 1 if width > 0 else -1
    return F.split(line, split_pattern(delimiter), limit)


def field_text(fields: Column, i: int | Column) -> Column:
    """Field ``i``, the empty string past the end of a short row."""
    return F.coalesce(F.get(fields, F.lit(i)), F.lit(""))


def split_fields(
    lines: DataFrame, width: int, delimiter: str = DEFAULT_DELIMITER, surplus: str | None = None
) -> DataFrame:
    """``value`` to text columns ``f0 .. f<width-1>`` beside the line itself and its place, and
    a column that marks lines with text beyond these, if it is given a name."""
    places = [c for c in PLACE if c in lines.columns]
    cut = lines.select(
        *places, F.col("value").alias(LINE), field_array(F.col("value"), delimiter, width).alias("__fields")
    )
    rest = F.coalesce(F.get(F.col("__fields"), F.lit(width)), F.lit(""))
    more = [(F.rtrim(rest, F.lit(delimiter)) != "").alias(surplus)] if surplus else []
    return cut.select(
        LINE, *places, *[field_text(F.col("__fields"), i).alias(f"f{i}") for i in range(width)], *more
    )


def head_of(lines: DataFrame, rows: int, most: int = SAMPLE_BYTES) -> list:
    """The first ``rows`` lines, as many of them as ``most`` bytes hold, one at least."""
    sizes, fit, total = lines.select(F.octet_length("value")).take(rows), 0, 0
    for (size,) in sizes:
        total += size
        if fit and total > most:
            break
        fit += 1
    return lines.select("value").take(fit) if fit else []


def sample_lines(lines: DataFrame, rows: int | None = None) -> DataFrame:
    """The first ``rows`` lines for schema inference, read from the first splits only;
    ``None`` means the whole input."""
    if rows is None:
        return lines
    if rows <= 0:
        raise ValueError("sample must have at least one row")
    return lines.sparkSession.createDataFrame(head_of(lines, rows), "value string")


def sample_sources(spark: SparkSession, sources: str | list[str], rows: int) -> DataFrame:
    """The first ``rows`` lines of the sources, in the order they are listed.

    A scan of all sources packs their files by size, so the sample goes through
    them one by one, as far as it needs to, and stops at SAMPLE_BYTES.
    """
    if rows <= 0:
        raise ValueError("sample must have at least one row")
    head: list = []
    for path in source_paths(sources):
        head += head_of(scan_lines(spark, path), rows - len(head))
        if len(head) == rows or sum(len(r[0]) for r in head) >= SAMPLE_BYTES:
            break
    return spark.createDataFrame(head, "value string")


def widest_line(lines: DataFrame, delimiter: str = DEFAULT_DELIMITER) -> int:
    """Most fields of any line, empty ones at its end not counted."""
    kept = F.rtrim("value", F.lit(delimiter_char(delimiter)))
    bare = (kept == "") & (F.col("value") != "")  # nothing but delimiters
    fields = F.when(bare, 0).otherwise(F.size(field_array(kept, delimiter)))
    most = lines.select(F.max(fields)).first()[0]
    if most is None:
        raise ValueError("cannot tell the number of fields of an empty input")
    return most
