"""Destination tables: names, save modes, staging guard, external and native tables."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loadstone.fields import quoted
from loadstone.names import TableName, resolve_table, sql_text, table_exists
from loadstone.operators.quality import REJECTED
from loadstone.session import session_settings
from loadstone.sinks import publish
from loadstone.sinks.orc import ORC_OPTIONS, orc_writer, write_orc
from loadstone.storage import delete_files, delete_tree, is_empty, move_files, qualified

__all__ = ["TableName", "resolve_table"]

MODES = ("error", "append", "replace")

# Fixed value: lifetime of an external table, 7 days in milliseconds.
DEFAULT_LIFETIME_MS = 7 * 24 * 60 * 60 * 1000


class DestinationError(RuntimeError):
    """A destination that already holds something."""


def existing_schema(spark: SparkSession, name: TableName | None) -> T.StructType | None:
    if name is None or not spark.catalog.tableExists(str(name)):
        return None
    return spark.table(str(name)).schema


def save_mode(replace: bool = False, append: bool = False) -> str:
    """The mode two flags ask for; append wins over replace, neither means fail."""
    return "append" if append else "replace" if replace else "error"


def check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, got {mode!r}")
    return mode


def guard_staging(spark: SparkSession, path: str, mode: str, shared: bool = False) -> None:
    """``path`` must be empty, unless its parts are to be replaced, or it is
    ``shared``: an external table that is appended to."""
    if mode != "replace" and not (mode == "append" and shared) and not is_empty(spark, path):
        raise DestinationError(f"there are files under {path} already")


def stage_parts(
    df: DataFrame, path: str, mode: str, rows_per_part: int | None, check: Callable[[], None]
) -> None:
    """Write ORC parts under ``path``; ``check`` may still refuse them.

    Parts that replace or join others are written to a folder beside them first, under a
    name that readers skip, and take their place by a journal when all is well.
    """
    spark = df.sparkSession
    if is_empty(spark, path):
        try:
            write_orc(df, path, "append", rows_per_part)
            check()
        except BaseException:
            delete_files(spark, path)
            raise
        return
    fresh = publish.fresh_folder(path)
    try:
        write_orc(df, fresh, "append", rows_per_part)
        check()
    except BaseException:
        delete_tree(spark, fresh)
        raise
    publish.step("parts written")
    (publish.replace_files if mode == "replace" else publish.add_files)(spark, fresh, path)


def write_split(df: DataFrame, folder: str, rows_per_part: int | None) -> None:
    """Rows marked ``REJECTED`` and the others, as ORC parts in one folder each."""
    # Both files of a task are open at once; it need not sort its rows by the mark.
    with session_settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": 2}):
        orc_writer(df, "errorifexists", rows_per_part).partitionBy(REJECTED).save(folder)


def split_folder(folder: str, rejected: bool) -> str:
    return f"{folder}/{REJECTED}={str(rejected).lower()}"


def stage_split(
    df: DataFrame, path: str, mode: str, rows_per_part: int | None, check: Callable[[str], None]
) -> None:
    """As :func:`stage_parts`, of rows with bad ones among them, in one pass. ``check``
    gets the folder of both outputs; only files of good rows move on."""
    spark = df.sparkSession
    fresh = publish.fresh_folder(path)
    try:
        write_split(df, fresh, rows_per_part)
        check(fresh)
    except BaseException:
        delete_tree(spark, fresh)
        raise
    publish.step("parts written")
    good = split_folder(fresh, False)
    (publish.replace_files if mode == "replace" else publish.add_files)(spark, good, path)
    delete_tree(spark, fresh)


def publish_split(
    df: DataFrame,
    schema: T.StructType,
    name: TableName,
    mode: str,
    rows_per_part: int | None,
    check: Callable[[str], None],
) -> None:
    """As :func:`publish_table`, of rows with bad ones among them, in one pass."""
    spark = df.sparkSession
    add = mode == "append" and table_exists(spark, name)
    if add:
        check_columns(schema.names, spark.table(str(name)).columns, name)
    fresh = publish.fresh_name(name)
    spark.catalog.createTable(str(fresh), source="orc", schema=schema, **ORC_OPTIONS)
    try:
        home = publish.location(spark, fresh)
        folder = publish.fresh_folder(home)
        write_split(df, folder, rows_per_part)
        check(folder)
        move_files(spark, split_folder(folder, False), home)
        delete_tree(spark, folder)
        spark.catalog.refreshTable(str(fresh))
    except BaseException:
        publish.drop_table(spark, fresh)
        raise
    if add:
        _add_table(spark, fresh, name, rows_per_part)
        return
    publish.step("table written")
    publish.swap_in(spark, fresh, name)


def guard_destination(
    spark: SparkSession, name: TableName, mode: str, external_path: str | None = None
) -> None:
    """``error`` needs the table absent.

    A table that stays while parts are added under ``external_path`` must be
    external and lie there.
    """
    if not spark.catalog.tableExists(str(name)):
        return
    if mode == "error":
        raise DestinationError(f"there is a table {name} already")
    if mode == "replace" and is_external(spark, name):
        return
    if external_path and table_location(spark, name) != qualified(spark, external_path):
        raise DestinationError(f"table {name} is not external over {external_path}")


def table_location(spark: SparkSession, name: TableName) -> str | None:
    """Where an external table lies; None for a native one."""
    if not is_external(spark, name):
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return qualified(spark, described.first()["data_type"])


def is_external(spark: SparkSession, name: TableName) -> bool:
    return spark.catalog.getTable(str(name)).tableType == "EXTERNAL"


def register_external(
    spark: SparkSession,
    path: str,
    name: TableName,
    lifetime_ms: int = DEFAULT_LIFETIME_MS,
    replace: bool = False,
) -> None:
    """An external table over the ORC files under ``path``, its schema theirs.

    A lifetime above 0 is kept as the property ``expires_at`` (epoch
    milliseconds); dropping expired tables is up to the catalog's owner.
    """
    there = table_exists(spark, name)
    if there and not replace:
        spark.catalog.refreshTable(str(name))
        return
    created = publish.fresh_name(name) if there else name
    properties = ""
    if lifetime_ms > 0:
        properties = f" TBLPROPERTIES ('expires_at' = '{int(time.time() * 1000) + lifetime_ms}')"
    spark.sql(f"CREATE TABLE {created} USING orc OPTIONS (path {sql_text(path)}){properties}")
    if there:
        publish.step("external table made")
        publish.swap_in(spark, created, name)


def publish_table(
    df: DataFrame,
    name: TableName,
    mode: str,
    rows_per_part: int | None = None,
    check: Callable[[], None] = lambda: None,
    checked_by_job: bool = True,
) -> None:
    """Write a native table; ``check`` may still refuse what was written.

    A new or replaced table is written under another name beside it, and takes its
    place when it is complete: until then the old one stays. Rows to append are
    committed by the job that writes them if that job itself fails for a bad row;
    if it does not, they are written to a table of their own first, whose files the
    old one then takes over.
    """
    spark = df.sparkSession
    if mode == "append" and table_exists(spark, name):
        columns = spark.table(str(name)).columns
        check_columns(df.columns, columns, name)
        if checked_by_job:
            _append(df, name, columns, rows_per_part)
            check()
            return
        _add_table(spark, _write_beside(df, name, rows_per_part, check), name, rows_per_part)
        return
    fresh = _write_beside(df, name, rows_per_part, check)
    publish.step("table written")
    publish.swap_in(spark, fresh, name)


def adopt_table(
    spark: SparkSession, path: str, schema: T.StructType, name: TableName, mode: str, rows_per_part: int | None = None
) -> None:
    """The staged ORC parts under ``path`` become, or join, the native table: they are
    moved to its folder. Between file systems they are copied by a job."""
    fresh = publish.fresh_name(name)
    if mode == "append" and table_exists(spark, name):
        check_columns(schema.names, spark.table(str(name)).columns, name)
    if not publish.adopt_parts(spark, path, schema, fresh, ORC_OPTIONS):
        publish_table(spark.read.schema(schema).orc(path), name, mode, rows_per_part)
    elif mode == "append" and table_exists(spark, name):
        _add_table(spark, fresh, name, rows_per_part)
    else:
        publish.swap_in(spark, fresh, name)


def _add_table(spark: SparkSession, fresh: TableName, name: TableName, rows_per_part: int | None) -> None:
    """The rows of ``fresh`` join those of ``name``, as files if they fit."""
    publish.step("table written")
    if not publish.append_table(spark, fresh, name):
        _append(spark.table(str(fresh)), name, spark.table(str(name)).columns, rows_per_part)
    publish.drop_table(spark, fresh)


def _write_beside(
    df: DataFrame, name: TableName, rows_per_part: int | None, check: Callable[[], None]
) -> TableName:
    fresh = publish.fresh_name(name)
    try:
        orc_writer(df, "errorifexists", rows_per_part).saveAsTable(str(fresh))
        check()
    except BaseException:
        publish.drop_table(df.sparkSession, fresh)
        raise
    return fresh


def _append(
    df: DataFrame, name: TableName, columns: Sequence[str], rows_per_part: int | None
) -> None:
    """Append by name, with the options of the ORC writer, which an insert takes from the session."""
    settings = {"spark.sql.orc.compression.codec": ORC_OPTIONS["compression"]}
    settings["spark.sql.files.maxRecordsPerFile"] = str(rows_per_part or 0)
    with session_settings(df.sparkSession, settings):
        df.select(*[quoted(c) for c in columns]).write.insertInto(str(name))


def check_columns(given: Sequence[str], wanted: Sequence[str], name: TableName) -> None:
    if sorted(c.lower() for c in given) != sorted(c.lower() for c in wanted):
        raise DestinationError(f"columns {list(given)} do not match table {name}: {list(wanted)}")
