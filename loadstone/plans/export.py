"""The export job: a table to gzip CSV, SequenceFile or ORC parts."""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadstone.operators.export import export_lines
from loadstone.operators.quality import TASK, observed, rows_by_task, task_counts
from loadstone.session import compiled_methods
from loadstone.sinks.orc import write_orc
from loadstone.sinks.text import EXPORT_ROWS_PER_PART, write_csv_gz, write_sequence
from loadstone.sources.tables import export_filter, export_scan, export_tasks
from loadstone.storage import delete_files, part_files

log = logging.getLogger(__name__)

FORMATS = ("csv", "seq", "orc")


@dataclass(frozen=True)
class ExportResult:
    path: str
    fmt: str
    rows: int
    streams: int
    parts: int
    seconds: float
    by_stream: dict[int, int] = field(default_factory=dict, repr=False)  # rows, by part number


def export_format(fmt: str) -> str:
    """``csv``, ``seq`` or ``orc``, in any case."""
    chosen = fmt.lower()
    if chosen not in FORMATS:
        raise ValueError(f"format must be one of {', '.join(FORMATS)}, got {fmt!r}")
    return chosen


def export(
    spark: SparkSession,
    source: str | DataFrame,
    dest: str,
    *,
    where: str | None = None,
    fmt: str = "csv",
    partitions: int | None = None,
    rows_per_part: int = EXPORT_ROWS_PER_PART,
    mode: str = "errorifexists",
) -> ExportResult:
    """Export a table (catalog name or DataFrame) to part files under ``dest``.

    ``where`` is a SQL predicate on the source, ``partitions`` the number of
    parallel streams; of a large table there are more, so that none is too long. Scan, filter, format and write are one stage; rows are only dealt
    out anew where fewer splits than ``partitions`` hold any.
    """
    chosen, started = export_format(fmt), time.monotonic()
    rows = export_tasks(export_filter(export_scan(spark, source), where), partitions)
    if chosen == "seq" and mode not in ("error", "errorifexists"):
        # Hadoop's output formats know no save modes.
        raise ValueError("a SequenceFile export needs a new path")
    with compiled_methods(spark):
        count, by_stream = _write(rows, dest, chosen, mode, rows_per_part)
    files = part_files(spark, dest).agg(
        F.count(F.lit(1)).alias("parts"),
        F.count_distinct(F.regexp_extract("name", "^part-([0-9]+)", 1)).alias("streams"),
    ).first()
    if count == 0:
        # Spark leaves one part without rows, to keep the schema; a stream without rows has none.
        delete_files(spark, dest)
        files = {"streams": 0, "parts": 0}
    result = ExportResult(
        dest, chosen, count, files["streams"], files["parts"], time.monotonic() - started, by_stream
    )
    log.info(
        "finished: %d rows across %d streams in %.0f seconds",
        result.rows,
        result.streams,
        result.seconds,
    )
    return result


def _write(
    rows: DataFrame, dest: str, fmt: str, mode: str, rows_per_part: int
) -> tuple[int, dict[int, int]]:
    """Write the rows in the format and return their number, in all and by stream.

    The counts are observed in the stage that writes, so a task that is run again counts once.
    """
    if fmt == "seq":
        by_stream = write_sequence(export_lines(rows), dest, rows_per_part)
        return sum(by_stream.values()), by_stream
    observation = Observation()
    given = rows if fmt == "orc" else export_lines(rows)
    counted = (
        given.withColumn(TASK, F.spark_partition_id())
        .observe(observation, F.count(F.lit(1)).alias("rows"), rows_by_task(F.col(TASK)).alias("tasks"))
        .drop(TASK)
    )
    if fmt == "orc":
        write_orc(counted, dest, mode, rows_per_part)
    else:
        write_csv_gz(counted, dest, mode, rows_per_part)
    counts = observed(observation)
    return (counts["rows"], task_counts(counts["tasks"])) if counts else (rows.count(), {})
