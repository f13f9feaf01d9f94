"""ORC parts: format options, part size and writer parallelism."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession

from loadstone.fields import FieldSpec
from loadstone.operators.quality import typed_rows
from loadstone.sources.delimited import DEFAULT_DELIMITER, DEFAULT_SAMPLE_ROWS, head_of
from loadstone.storage import MEGABYTE, delete_tree, file_sizes, read_piece, total_bytes

# Compression, its strategy and its buffer. Row indexes stay on;
# Spark's own scans push filters down to them.
ORC_OPTIONS = {
    "compression": "zlib",
    "orc.compression.strategy": "SPEED",
    "orc.compress.size": str(32 * 1024),
}
DEFAULT_PART_MB = 128

# Where the size of rows is measured: so many places, bytes at each, and files that are asked
# for their length; bytes of the first lines where there are no files to look into.
PIECES, PIECE_BYTES, LISTED = 128, 32 * 1024, 10_000
HEAD_BYTES = 4 * MEGABYTE


def orc_writer(df: DataFrame, mode: str, rows_per_part: int | None = None) -> DataFrameWriter:
    writer = df.write.format("orc").mode(mode).options(**ORC_OPTIONS)
    return writer.option("maxRecordsPerFile", rows_per_part) if rows_per_part else writer


def write_orc(
    df: DataFrame, path: str, mode: str = "errorifexists", rows_per_part: int | None = None
) -> None:
    orc_writer(df, mode, rows_per_part).save(path)


def spread_lines(spark: SparkSession, files: Sequence[str]) -> list[str]:
    """Lines from ``PIECES`` places spread evenly over all bytes of text files.

    Of very many files, the places lie in ``LISTED`` of them. What passes through the driver
    is bounded in bytes, whatever the lines are.
    """
    some = [files[i * len(files) // LISTED] for i in range(LISTED)] if len(files) > LISTED else list(files)
    sizes = file_sizes(spark, some)
    total = sum(sizes)
    room = max(1, min(PIECE_BYTES, total // PIECES))
    found: list[bytes] = []
    before, nth = 0, 0
    for file, size in zip(some, sizes):
        while nth < PIECES and nth * total // PIECES < before + size:
            at = nth * total // PIECES - before
            lines = read_piece(spark, file, at, room).split(b"\n")
            # The first and the last one may be cut; a piece inside one line stands for it.
            first, last = (0 if at == 0 else 1), len(lines) - (at + room < size)
            found += lines[first:last] if last > first else lines[:1]
            nth += 1
        before += size
    return [line.decode(errors="replace") for line in found]


def measure_rows(
    lines: DataFrame,
    fields: Sequence[FieldSpec],
    probe_path: str,
    delimiter: str = DEFAULT_DELIMITER,
    files: Sequence[str] | None = None,
) -> tuple[float, float] | None:
    """(ORC bytes, text bytes) per row, measured by writing lines from all over ``files``;
    without these, or if they are compressed, the first lines. None if the input is empty.

    A small file compresses a little worse than a full part, so parts sized by
    this stay below their target.
    """
    spark = lines.sparkSession
    head = spread_lines(spark, files) if files else [r[0] for r in head_of(lines, DEFAULT_SAMPLE_ROWS, HEAD_BYTES)]
    if not head:
        return None
    sample = spark.createDataFrame([(x,) for x in head], "value string").coalesce(1)
    try:
        write_orc(typed_rows(sample, fields, delimiter), probe_path)
        orc_bytes = total_bytes(spark, [f"{probe_path.rstrip('/')}/part-*"])
    finally:
        delete_tree(spark, probe_path)
    text_bytes = sum(len(x.encode()) + 1 for x in head)
    return orc_bytes / len(head), text_bytes / len(head)


def part_splits(ratio: float, part_mb: float, most: int) -> tuple[int, int]:
    """(bytes, number) of equal splits, of ``most`` bytes each at the most, whose text fills
    one part of ``part_mb``."""
    text = max(1, int(part_mb * MEGABYTE / max(ratio, 1e-6)))
    number = -(-text // most)
    return -(-text // number), number


def rows_per_part(orc_bytes_per_row: float, part_mb: float = DEFAULT_PART_MB) -> int:
    """Rows that fill a part of ``part_mb``: Spark caps files by rows, not bytes."""
    return max(1, int(part_mb * MEGABYTE / max(orc_bytes_per_row, 0.001)))


def with_writers(lines: DataFrame, writers: int | None, splits: int | None = None) -> DataFrame:
    """Lines dealt to ``writers`` tasks.

    No more writers than the input has ``splits``: those are merged, without a
    shuffle. Otherwise the lines are dealt out round-robin, here, before they
    are decoded, so that all writers decode and no shuffle follows the counts.
    """
    if writers is None:
        return lines
    if writers < 1:
        raise ValueError("at least one writer is required")
    merge = splits is not None and writers <= splits
    return lines.coalesce(writers) if merge else lines.repartition(writers)


def writers_for(
    spark: SparkSession, text_bytes: int, ratio: float, part_mb: float = DEFAULT_PART_MB
) -> int:
    """Writers that leave about one full part each, and no core of a small job idle.

    One writer per input split would leave parts as much smaller than their
    target as ORC is smaller than text.
    """
    parts = int(text_bytes * ratio / (part_mb * MEGABYTE)) + 1
    return max(parts, spark.sparkContext.defaultParallelism)
