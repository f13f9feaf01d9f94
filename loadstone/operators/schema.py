"""Schemas from a specification string, a template table or generated names."""

from __future__ import annotations

import re
import zoneinfo
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.fields import (
    DATE,
    DEFAULT_PRECISION,
    DEFAULT_SCALE,
    FLOAT64,
    INT64,
    NARROW_INTEGERS,
    NUMERIC,
    OFFSET_MARK,
    STRING,
    TIMESTAMP_KINDS,
    TIMESTAMP_LOCAL,
    TIMESTAMP_OFFSET,
    TIMESTAMP_ZONED,
    FieldSpec,
    SchemaError,
)
from loadstone.names import generated_name
from loadstone.sources.delimited import widest_line

# --- specification string -------------------------------------------------


def parse_spec(schema: str) -> list[FieldSpec]:
    """``name[:TYPE[:args]],...`` to fields, names lower-cased.

    The args of a field may themselves hold a colon (``ts:TIMESTAMP:HH:mm``).
    """
    if not schema:
        raise SchemaError("no schema: give a specification, a template or autodetect")
    return [_parse_field(item) for item in schema.split(",")]


def _parse_field(item: str) -> FieldSpec:
    name, _, rest = item.partition(":")
    kind, _, args = rest.partition(":")
    name, kind = name.lower(), kind or STRING
    if kind == STRING:
        return FieldSpec(name, STRING, length=_int(name, args) if args else None)
    if kind == NUMERIC:
        precision, scale = _size(name, args, ".") if args else (DEFAULT_PRECISION, DEFAULT_SCALE)
        return FieldSpec(name, NUMERIC, precision=precision, scale=scale)
    if kind == DATE:
        # A date has no zone: all of the args, but a zone before a bar, is format.
        return FieldSpec(name, DATE, format=args.rpartition("|")[2] or None)
    if kind in ("TIMESTAMP", "DATETIME"):
        return _timestamp(name, args)
    if kind in (INT64, FLOAT64):
        if args:
            raise SchemaError(f"{name}: {kind} takes no args, got {args!r}")
        return FieldSpec(name, kind)
    raise SchemaError(f"{name}: there is no type {kind!r}")


def _timestamp(name: str, args: str | None) -> FieldSpec:
    """Arguments of a timestamp: ``zone|format``, a zone, a format or nothing."""
    if not args:
        return FieldSpec(name, TIMESTAMP_OFFSET)
    if "|" in args:
        zone, _, fmt = args.partition("|")
        return FieldSpec(name, TIMESTAMP_LOCAL, zone=zone, format=fmt or None)
    if "/" in args and is_zone(args):
        return FieldSpec(name, TIMESTAMP_LOCAL, zone=args)
    kind = TIMESTAMP_OFFSET if OFFSET_MARK in args else TIMESTAMP_ZONED
    return FieldSpec(name, kind, format=args)


def is_zone(text: str) -> bool:
    """Whether ``text`` is a region id such as America/Chicago, not a format with slashes."""
    try:
        zoneinfo.ZoneInfo(text)
        return True
    except (zoneinfo.ZoneInfoNotFoundError, ValueError, OSError):
        # Hosts without a zone database: a region has a capitalised word in
        # each part, a pattern repeats one letter.
        return not zoneinfo.available_timezones() and all(
            re.fullmatch(r"[A-Z][A-Za-z_+\-0-9]*", part) and len(set(part)) > 1
            for part in text.split("/")
        )


def _int(name: str, text: str) -> int:
    try:
        return int(text)
    except ValueError:
        raise SchemaError(f"{name}: {text!r} is not a number") from None


def _size(name: str, text: str, separator: str) -> tuple[int, int]:
    precision, found, scale = text.partition(separator)
    if not found:
        raise SchemaError(f"{name}: expected precision{separator}scale, got {text!r}")
    return _int(name, precision.strip()), _int(name, scale.strip())


# --- template table -------------------------------------------------------


def template_fields(schema: T.StructType) -> list[FieldSpec]:
    """Fields from an existing table: column types, with type args in the comments."""
    return [_template_field(f) for f in schema.fields]


def column_comment(field: T.StructField) -> str | None:
    return (field.metadata or {}).get("comment") or None


def _template_field(field: T.StructField) -> FieldSpec:
    name, dtype, args = field.name.lower(), field.dataType, column_comment(field)
    if isinstance(dtype, T.StringType):
        spec = FieldSpec(name, STRING, length=_int(name, args) if args else None)
    elif isinstance(dtype, T.LongType):
        spec = FieldSpec(name, INT64)
    elif dtype in NARROW_INTEGERS.values():
        spec = FieldSpec(name, INT64, target=dtype.simpleString())
    elif isinstance(dtype, T.DoubleType):
        spec = FieldSpec(name, FLOAT64)
    elif isinstance(dtype, T.FloatType):
        spec = FieldSpec(name, FLOAT64, target="float")
    elif isinstance(dtype, T.DecimalType):
        if args:
            precision, scale = _size(name, args, ",")
        else:
            precision, scale = dtype.precision, dtype.scale
        spec = FieldSpec(name, NUMERIC, precision=precision, scale=scale)
    elif isinstance(dtype, T.DateType):
        spec = FieldSpec(name, DATE, format=args)
    elif isinstance(dtype, T.TimestampType):
        spec = _timestamp(name, args)
    else:
        raise SchemaError(f"{name}: text cannot be decoded to {dtype.simpleString()}")
    return spec.with_comment(args)


# --- names and comments ---------------------------------------------------


def autodetect_names(
    lines: DataFrame,
    delimiter: str,
    template: T.StructType | None = None,
    schema: str = "",
) -> list[str]:
    """Column names for inference: from the template, else from a comma
    separated list (verbatim), else generated for the fields of the widest line."""
    if template is not None:
        return template.fieldNames()
    if schema:
        return schema.split(",")
    return [generated_name(i) for i in range(widest_line(lines, delimiter))]


def copy_comments(fields: Sequence[FieldSpec], template: T.StructType | None) -> list[FieldSpec]:
    """Column comments of the template, matched without regard to case."""
    comments = {f.name.lower(): column_comment(f) for f in template.fields} if template else {}
    return [f.with_comment(comments.get(f.name.lower(), f.comment)) for f in fields]


# --- precedence, validation, report ---------------------------------------


def schema_provider(
    autodetect: bool, template: str | None, template_schema: T.StructType | None
) -> str:
    """Which provider applies: ``autodetect``, then ``template``, then ``spec``.

    ``template`` is the template table asked for by name, ``template_schema``
    the schema found under that name or, with none named, of the destination.
    """
    if autodetect:
        return "autodetect"
    if template and template_schema is None:
        raise SchemaError(f"no table {template} to take the schema from")
    return "template" if template_schema is not None else "spec"


def check_fields(spark: SparkSession, fields: Sequence[FieldSpec]) -> list[FieldSpec]:
    """Fail on the driver for duplicate names, and for patterns and zones that
    Spark would reject in the tasks."""
    names = [f.name.lower() for f in fields]
    if not names:
        raise SchemaError("schema has no columns")
    for name in names:
        if names.count(name) > 1:
            raise SchemaError(f"duplicate column {name}")
    probes = {}
    for f in fields:
        if f.kind == DATE:
            probes.setdefault((f.format, None), f.name)
        elif f.kind in TIMESTAMP_KINDS:
            probes.setdefault((f.format, f.zone), f.name)
    for (fmt, zone), name in probes.items():
        instant = F.lit("2000-01-01 00:00:00").cast("timestamp")
        if zone:
            instant = F.from_utc_timestamp(instant, zone)
        try:
            # One row without a source: evaluated on the driver, no job.
            spark.sql("SELECT 1 AS one").select(F.date_format(instant, fmt).alias("t")).collect()
        except Exception as e:
            raise SchemaError(f"{name}: Spark cannot use format {fmt!r}, zone {zone!r}: {e}") from e
    return list(fields)


REPORT_SCHEMA = (
    "idx int, name string, type string, length int, precision int, scale int, "
    "format string, zone string"
)


def schema_report(spark: SparkSession, fields: Sequence[FieldSpec]) -> DataFrame:
    """One row per column: how it is decoded."""
    rows = [
        (i, f.name, f.kind, f.length, f.precision, f.scale, f.format, f.zone)
        for i, f in enumerate(fields)
    ]
    return spark.createDataFrame(rows, REPORT_SCHEMA)
