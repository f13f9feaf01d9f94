"""The load job: delimited text to ORC parts, an external or a native table."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loadstone.fields import FieldSpec, quoted, struct_type
from loadstone.operators.inference import DEFAULT_ZONE, infer_fields
from loadstone.operators.quality import (
    LimitWatch,
    LoadError,
    bad_rows,
    carrier,
    count_rows,
    enforce_limit,
    failed_value,
    good_rows,
    observed,
    reports,
    split_rows,
    strict_rows,
    task_counts,
)
from loadstone.operators.schema import (
    autodetect_names,
    check_fields,
    copy_comments,
    parse_spec,
    schema_provider,
    template_fields,
)
from loadstone.session import compiled_methods, session_settings
from loadstone.sinks.orc import (
    DEFAULT_PART_MB,
    measure_rows,
    part_splits,
    rows_per_part,
    with_writers,
    writers_for,
)
from loadstone.sinks.publish import recover_parts, recover_table
from loadstone.sinks.tables import (
    DEFAULT_LIFETIME_MS,
    TableName,
    adopt_table,
    check_mode,
    existing_schema,
    guard_destination,
    guard_staging,
    publish_split,
    publish_table,
    register_external,
    resolve_table,
    split_folder,
    stage_parts,
    stage_split,
)
from loadstone.sources.delimited import (
    DEFAULT_DELIMITER,
    delimiter_char,
    even_split_bytes,
    is_splittable,
    max_split_bytes,
    numbered,
    one_split_each,
    own_splits,
    placed_lines,
    sample_lines,
    sample_sources,
    scan_lines,
    source_paths,
)
from loadstone.storage import MEGABYTE, delete_tree, scratch_dir, total_bytes

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class LoadResult:
    fields: list[FieldSpec] = field(repr=False)
    rows_read: int
    rows_written: int
    bad: int
    table: str | None
    path: str | None
    surplus: int = 0  # rows with text in fields beyond the schema
    cut: int = 0  # rows with a string longer than its declared length
    by_writer: dict[int, int] = field(default_factory=dict, repr=False)  # rows written, by part number


def resolve_fields(
    spark: SparkSession,
    lines: DataFrame,
    *,
    delimiter: str = DEFAULT_DELIMITER,
    schema: str = "",
    template: str | None = None,
    destination: TableName | None = None,
    database: str | None = None,
    catalog: str | None = None,
    autodetect: bool = False,
    sample_rows: int | None = None,
    zone: str = DEFAULT_ZONE,
) -> list[FieldSpec]:
    """The schema of a load, once per job: inferred, or from the template or
    destination table, or from the specification string, in this order."""
    known = resolve_table(template, database, catalog) if template else destination
    found = existing_schema(spark, known)
    provider = schema_provider(autodetect, template, found)
    if provider == "autodetect":
        # Of the whole input, the pass that infers the types tells the number of columns too.
        named = found is not None or schema or sample_rows is not None
        names = autodetect_names(lines, delimiter, found, schema) if named else None
        with compiled_methods(spark):
            fields = infer_fields(sample_lines(lines, sample_rows), names, delimiter, zone)
        fields = copy_comments(fields, found)
    elif provider == "template":
        fields = template_fields(found)
    else:
        fields = parse_spec(schema)
    return check_fields(spark, fields)


def load(
    spark: SparkSession,
    sources: str | Sequence[str] | DataFrame,
    table: str | None = None,
    *,
    path: str | None = None,
    delimiter: str = DEFAULT_DELIMITER,
    schema: str = "",
    template: str | None = None,
    autodetect: bool = False,
    sample_rows: int | None = None,
    zone: str = DEFAULT_ZONE,
    error_limit: int = 0,
    quarantine: str | None = None,
    mode: str = "error",
    external: bool = False,
    lifetime_ms: int = DEFAULT_LIFETIME_MS,
    adopt: bool = False,
    partitions: int | None = None,
    part_mb: float = DEFAULT_PART_MB,
    catalog: str | None = None,
    database: str | None = None,
) -> LoadResult:
    """Load delimited text (paths, or a DataFrame with a ``value`` column).

    ``path`` is the staging folder of the ORC parts. With ``external`` the table
    is registered over it; otherwise the parts are loaded into the native
    ``table`` once all of them are written and the error limit holds: they are
    copied, or moved with ``adopt``, which leaves the folder empty. Without a
    ``path`` the native table is written directly. Without a ``table`` the parts
    are the result.

    A limit of 0 or 1 fails in the task that meets the first bad value. A higher
    limit drops bad rows, counts them over the whole job, and publishes nothing
    when they reach it; ``quarantine`` names a folder that then receives them.
    Whatever fails, what was there before the load is still there after it; what a lost
    driver left half done, the next load of the same table or path finishes or undoes.
    """
    check_mode(mode)
    delimiter = delimiter_char(delimiter)
    if table is None and path is None:
        raise ValueError("give a table, a path or both")
    if external and (table is None or path is None):
        raise ValueError("an external table needs a table and a path")
    strict = error_limit <= 1
    if strict and quarantine:
        raise ValueError("a load that fails at its first bad row has none to quarantine")
    if adopt and (external or table is None or path is None):
        raise ValueError("parts are adopted from a path by a native table")
    name = resolve_table(table, database, catalog) if table else None
    if name:
        recover_table(spark, name)
    if path:
        recover_parts(spark, path)
    lines = sources if isinstance(sources, DataFrame) else scan_lines(spark, sources)

    # A sample of files goes by the order of the sources; of a DataFrame, by its own.
    sample, rest = lines, sample_rows
    if autodetect and lines is not sources and sample_rows is not None:
        sample, rest = sample_sources(spark, sources, sample_rows), None
    # Before the destination is touched: the schema may come from it.
    fields = resolve_fields(
        spark,
        sample,
        delimiter=delimiter,
        schema=schema,
        template=template,
        destination=name,
        database=database,
        catalog=catalog,
        autodetect=autodetect,
        sample_rows=rest,
        zone=zone,
    )
    log.info("schema: %s", ", ".join(f"{f.name} -> {f.describe()}" for f in fields))
    if name:
        guard_destination(spark, name, mode, path if external else None)
    if path:
        guard_staging(spark, path, mode, shared=external)

    if quarantine and lines is not sources:
        lines = placed_lines(lines)
    layout = _layout(spark, sources, lines, fields, delimiter, path, partitions, part_mb, bool(quarantine))
    lines, cap = layout.lines, layout.rows_per_part
    # Its name tells the observation of this job from others.
    observation = Observation(f"load-{uuid.uuid4().hex}")
    one_pass = quarantine is not None and carrier(fields) is not None
    make = strict_rows if strict else split_rows if one_pass else good_rows
    rows = make(lines, fields, delimiter, observation)
    counts: dict = {}
    watch = LimitWatch(spark, observation._name, error_limit)

    def check(folder: str | None = None) -> None:
        """Called when all rows are written and none of them shows yet."""
        counts.update(observed(observation) or count_rows(lines, fields, delimiter).first().asDict())
        if counts["bad"] and not strict:
            log.error("%d bad rows", counts["bad"])
            if quarantine:
                found = spark.read.schema(struct_type(fields)).orc(split_folder(folder, True)) if folder else None
                bad = bad_rows(lines, fields, delimiter) if found is None else reports(found, fields, layout.placed)
                _quarantine(bad, quarantine, layout.placed, counts.get("split_bytes"), found is not None)
        if not strict:
            enforce_limit(counts["bad"], error_limit)

    try:
        with compiled_methods(spark), session_settings(spark, layout.settings), _watched(watch, strict):
            if one_pass and path:
                stage_split(rows, path, mode, cap, check)
            elif one_pass:
                publish_split(rows, struct_type(fields), name, mode, cap, check)
            elif path:
                stage_parts(rows, path, mode, cap, check)
            else:
                publish_table(rows, name, mode, cap, check, checked_by_job=strict)
    except Exception as e:
        if watch.stopped and not isinstance(e, LoadError) and not counts:
            enforce_limit(watch.bad, error_limit)
        message = failed_value(e)
        if message is None:
            raise
        raise LoadError(message) from e
    if adopt:
        adopt_table(spark, path, struct_type(fields), name, mode, cap)
    elif name and path and not external:
        parts = _with_comments(spark.read.schema(struct_type(fields)).orc(path), fields)
        publish_table(parts, name, mode, cap)
    if external:
        register_external(spark, path, name, lifetime_ms, replace=mode == "replace")
    read, bad = counts["rows"], counts["bad"]
    surplus, cut = counts.get("surplus", 0), counts.get("cut", 0)
    by_writer = task_counts(counts.get("tasks"))
    log.info("wrote %d rows by %d writers", read - bad, len(by_writer))
    if surplus or cut:
        log.warning("%d rows had fields beyond the schema, %d had strings cut to length", surplus, cut)
    return LoadResult(
        fields, read, read - bad, bad, str(name) if name else None, path, surplus, cut, by_writer
    )


@dataclass(frozen=True)
class _Layout:
    """How the lines are dealt to writers: the lines, the most rows of a part if parts are not
    sized by splits, the settings of their scan, and whether the lines have their places."""

    lines: DataFrame
    rows_per_part: int | None = None
    settings: dict = field(default_factory=dict)
    placed: bool = False


def _layout(spark, sources, lines, fields, delimiter, path, partitions, part_mb, quarantined) -> _Layout:
    placed = quarantined and not isinstance(sources, DataFrame)
    settings, files, size = {}, None, None
    if not isinstance(sources, DataFrame) and is_splittable(lines):
        size = total_bytes(spark, source_paths(sources))
        if size > part_mb * MEGABYTE:
            files = lines.inputFiles()
    if placed:
        cores = spark.sparkContext.defaultParallelism
        settings = one_split_each(spark, even_split_bytes(spark, size, cores) if size else None)
    if size is not None and files is None:
        # All of it fits into one part: nothing to cap. Small files are many splits, if each
        # is a partition of its own.
        splits = _splits(lines, settings)
        if placed and partitions is None:
            partitions = min(splits, cores)
        return _Layout(with_writers(lines, partitions, splits), None, settings, placed)
    # The probe goes below the staging folder under a name that readers skip.
    probe = f"{path.rstrip('/')}/_probe-{uuid.uuid4().hex}" if path else scratch_dir(spark)
    per_row = measure_rows(lines, fields, probe, delimiter, files)
    if per_row is None:
        return _Layout(lines if partitions is None else with_writers(lines, partitions), None, settings, placed)
    orc_bytes, text_bytes = per_row
    if files is None:
        splits = None if isinstance(sources, DataFrame) else _splits(lines, settings)
        return _Layout(with_writers(lines, partitions, splits), rows_per_part(orc_bytes, part_mb), settings, placed)
    # Parts are sized by the bytes that each writer reads, wherever in the input they lie.
    ratio = orc_bytes / text_bytes
    split_bytes, _ = part_splits(ratio, part_mb, max_split_bytes(spark))
    settings = {**settings, "spark.sql.files.maxPartitionBytes": split_bytes}
    splits = _splits(lines, settings)
    if partitions is None:
        # Never more than there are splits: that would be a shuffle nobody asked for.
        partitions = min(splits, writers_for(spark, size, ratio, part_mb))
    return _Layout(with_writers(lines, partitions, splits), None, settings, placed)


def _splits(lines: DataFrame, settings: dict) -> int:
    with session_settings(lines.sparkSession, settings):
        # A new plan: splits are cut by the settings at hand.
        return lines.select("value").rdd.getNumPartitions()


@contextmanager
def _watched(watch: LimitWatch, strict: bool) -> Iterator[None]:
    """A strict job ends itself."""
    with nullcontext() if strict else watch:
        yield


def _quarantine(bad: DataFrame, folder: str, placed: bool, split_bytes: int | None, stored: bool) -> None:
    """The reports of bad rows, with their file and the number of their line in it."""
    spark = bad.sparkSession
    split_bytes = split_bytes or max_split_bytes(spark)
    # Bad rows that are not stored are read from the sources again, in the splits of these.
    with session_settings(spark, own_splits() if stored else {}):
        if placed:
            # Read, or decoded, once: what follows asks for them twice.
            at = scratch_dir(spark, "rejected")
            bad.write.parquet(at)
        else:
            bad = bad.select("*", F.lit(None).cast("string").alias("source"), F.lit(None).cast("bigint").alias("row"))
            bad.write.mode("append").option("ignoreNullFields", "false").json(folder)
    if placed:
        with session_settings(spark, own_splits()):
            bad = numbered(spark.read.schema(bad.schema).parquet(at), split_bytes, scratch_dir(spark, "line-counts"))
            bad.write.mode("append").option("ignoreNullFields", "false").json(folder)
        delete_tree(spark, at)


def _with_comments(df: DataFrame, fields: Sequence[FieldSpec]) -> DataFrame:
    return df.select(
        *[
            F.col(quoted(s.name)).alias(s.name, metadata={"comment": s.comment} if s.comment else {})
            for s in fields
        ]
    )
