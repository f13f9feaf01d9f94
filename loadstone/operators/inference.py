"""Schema inference: one aggregation over the sample, one decision per column.

Each column needs some ten column-wide tests ("every value is an integer",
"every value is a zoned timestamp", ...). They are taken as bits of one integer
per value and joined with ``bit_and``, grouped by the position of the field.
A group is a column, so a few fixed-size buffers per task hold all there is to
shuffle, whatever the size of the input; and the generated code has one copy of
the tests, whatever the number of columns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstone.fields import (
    DATE,
    FLOAT64,
    INT64,
    NUMERIC,
    STRING,
    TIMESTAMP_LOCAL,
    TIMESTAMP_OFFSET,
    TIMESTAMP_ZONED,
    FieldSpec,
    SchemaError,
)
from loadstone.functions.predicates import (
    DATE_FORMATS,
    TIMESTAMP_FORMATS,
    is_date,
    is_int,
    is_numeric,
    is_timestamp_kind,
)
from loadstone.functions.text import has, trimmed
from loadstone.names import generated_name
from loadstone.sources.delimited import DEFAULT_DELIMITER, delimiter_char, field_array, literal_path, scan_lines
from loadstone.storage import is_empty

# Fixed value: the zone of inferred local timestamps.
DEFAULT_ZONE = "America/Los_Angeles"

# Fixed value: the longest text that is still inferred as a number.
MAX_NUMBER_LENGTH = 18

_NUMERIC_BIT, _INT_BIT = 1, 2
_TIMESTAMP_BITS = {kind: 4 << i for i, kind in enumerate(TIMESTAMP_FORMATS)}
_DATE_BITS = {fmt: 64 << i for i, fmt in enumerate(DATE_FORMATS)}


# --- column-wide aggregates -----------------------------------------------


def all_match(predicate: Column) -> Column:
    """Whether every value of a column satisfies the predicate."""
    return F.bool_and(predicate)


def max_length(x: Column) -> Column:
    """Length in characters of the longest trimmed value."""
    return F.max(F.length(trimmed(x)))


def scale_of(x: Column) -> Column:
    """Characters after the last point; NULL without one.

    Trailing points are dropped first, so ``5.`` counts its ``5``.
    """
    body = F.rtrim(x, F.lit("."))
    return F.when(has(x, ".") & (body != ""), F.length(F.substring_index(body, ".", -1)))


def common_scale(x: Column) -> Column:
    """The scale shared by all values that have a point, NULL if they differ.

    Least and greatest say whether there is just one, in two integers rather
    than a set.
    """
    low, high = F.min(scale_of(x)), F.max(scale_of(x))
    return F.when(low == high, low)


def common_date_format(x: Column) -> Column:
    """The first of DATE_FORMATS that reads every value."""
    return F.coalesce(*[F.when(all_match(is_date(x, fmt)), F.lit(fmt)) for fmt in DATE_FORMATS])


# --- inference ------------------------------------------------------------


def value_bits(t: Column) -> Column:
    """All tests of one trimmed value as bits of an integer.

    The cheap tests come first; casts and parses that fail are dear. A number is
    never tested as a time: but for all-digit dates, which count as integers, no
    text is both.
    """
    time_bits = F.lit(0)
    for kind, bit in _TIMESTAMP_BITS.items():
        time_bits = time_bits.bitwiseOR(F.when(is_timestamp_kind(t, kind), bit).otherwise(0))
    date_bits = F.lit(0)
    for fmt, bit in _DATE_BITS.items():
        date_bits = date_bits.bitwiseOR(F.when(is_date(t, fmt), bit).otherwise(0))
    # Digits, point and signs lie between "+" and "9"; nothing else starts a match.
    return (
        F.when(~F.substring(t, 1, 1).between("+", "9"), F.lit(0))
        .when(is_int(t), F.lit(_NUMERIC_BIT | _INT_BIT))
        .when(is_numeric(t), F.lit(_NUMERIC_BIT))
        .when(has(t, ":"), time_bits)
        .otherwise(date_bits)
    )


def column_statistics(
    sample: DataFrame, width: int | None = None, delimiter: str = DEFAULT_DELIMITER, by: Sequence[str] = ()
) -> DataFrame:
    """One row per column: ``idx``, ``bits``, ``len``, the ``low`` and ``high`` scale, ``n``
    lines that reach it, whether any ``filled`` it, and whether any line is ``blank``.

    Without a ``width`` there are as many columns as the widest line has: one pass finds
    both. With ``by``, a row for each column and group, say of the lines of a file.
    """
    # Empty fields at the end of a line are as good as missing ones.
    kept = F.rtrim("value", F.lit(delimiter_char(delimiter)))
    fields = field_array(kept, delimiter, width or -1)
    fields = F.slice(fields, 1, width) if width else fields
    blank = (F.col("value") == "").alias("blank")
    values = sample.select(*by, blank, F.posexplode(fields).alias("idx", "x"))
    texts = values.select(*by, "blank", "idx", (F.col("x") != "").alias("filled"), trimmed(F.col("x")).alias("t"))
    tested = texts.select(
        *by,
        "idx",
        "filled",
        "blank",
        value_bits(F.col("t")).alias("bits"),
        F.length("t").alias("len"),
        scale_of(F.col("t")).alias("scale"),
    )
    return tested.groupBy(*by, "idx").agg(
        F.bit_and("bits").alias("bits"),
        F.max("len").alias("len"),
        F.min("scale").alias("low"),
        F.max("scale").alias("high"),
        F.count(F.lit(1)).alias("n"),
        F.max("filled").alias("filled"),
        F.max("blank").alias("blank"),
    )


def merged_statistics(state: DataFrame) -> DataFrame:
    """The statistics of all groups together: the same as of all their lines."""
    return state.groupBy("idx").agg(
        F.bit_and("bits").alias("bits"),
        F.max("len").alias("len"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("n").alias("n"),
        F.max("filled").alias("filled"),
        F.max("blank").alias("blank"),
    )


def extend_statistics(
    spark: SparkSession, state: str, sources: str | list[str], delimiter: str = DEFAULT_DELIMITER
) -> DataFrame:
    """The statistics stored in the folder ``state``, by column and ``source`` file, after
    those of files that it does not have yet were added. Files it has are not read again.

    A file counts as the same by its name; state is added to by one job at a time.
    """
    files = [_decoded(f) for f in scan_lines(spark, sources).inputFiles()]
    known = set()
    if not is_empty(spark, state):
        listed = spark.read.schema(_STATE_SCHEMA).parquet(state).select("source").distinct()
        known = {r[0] for r in listed.collect()}
    new = sorted(set(files) - known)
    if new:
        # A file without a line has no column, and is looked at again next time.
        lines = spark.read.text([literal_path(f) for f in new])
        lines = lines.select("value", F.col("_metadata.file_path").alias("source"))
        found = column_statistics(lines, None, delimiter, ["source"])
        # Decoded a row for each column of a file, rather than one for each line.
        found.withColumn("source", _source(F.col("source"))).write.mode("append").parquet(state)
    return spark.read.schema(_STATE_SCHEMA).parquet(state) if new or known else spark.createDataFrame([], _STATE_SCHEMA)


_STATE_SCHEMA = (
    "source string, idx int, bits int, len int, low int, high int, n bigint, filled boolean, blank boolean"
)


def _decoded(uri: str) -> str:
    """A listed file's URI as ``_source`` has it."""
    return re.sub("^file:/+", "file:/", unquote(uri))


def _source(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def decide(name: str, stats: dict, zone: str = DEFAULT_ZONE) -> FieldSpec:
    """The type of a column from its statistics."""
    bits, length, low, high = stats["bits"], stats["len"], stats["low"], stats["high"]
    if bits & _NUMERIC_BIT:
        if bits & _INT_BIT:
            return FieldSpec(name, INT64)
        if length > MAX_NUMBER_LENGTH:
            return FieldSpec(name, STRING, length=length, inferred=True)
        if low is not None and low == high:
            # The precision counts point and minus too.
            return FieldSpec(name, NUMERIC, precision=length, scale=low, inferred=True)
        return FieldSpec(name, FLOAT64)
    # Each column is decoded with the format that matched it.
    for kind, target in (
        ("zoned", TIMESTAMP_ZONED),
        ("zoned_space", TIMESTAMP_ZONED),
        ("offset", TIMESTAMP_OFFSET),
    ):
        if bits & _TIMESTAMP_BITS[kind]:
            return FieldSpec(name, target, format=TIMESTAMP_FORMATS[kind])
    if bits & _TIMESTAMP_BITS["local"]:
        return FieldSpec(name, TIMESTAMP_LOCAL, format=TIMESTAMP_FORMATS["local"], zone=zone)
    for fmt, bit in _DATE_BITS.items():
        if bits & bit:
            return FieldSpec(name, DATE, format=fmt)
    return FieldSpec(name, STRING, length=length, inferred=True)


def infer_fields(
    sample: DataFrame,
    names: Sequence[str] | None,
    delimiter: str = DEFAULT_DELIMITER,
    zone: str = DEFAULT_ZONE,
) -> list[FieldSpec]:
    """Infer one field per name from the lines of ``sample``; without names, one for each
    field of the widest line."""
    if names is not None and not names:
        raise SchemaError("schema has no columns")
    return decide_all(column_statistics(sample, names and len(names), delimiter), names, zone)


def decide_all(
    statistics: DataFrame, names: Sequence[str] | None = None, zone: str = DEFAULT_ZONE
) -> list[FieldSpec]:
    """The fields of :func:`column_statistics`, which have a row for each column."""
    stats = {r["idx"]: r.asDict() for r in statistics.collect()}
    if not stats:
        raise SchemaError("cannot infer a schema from an empty sample")
    if names is None:
        width = max([i + 1 for i, r in stats.items() if r["filled"]] + [int(any(r["blank"] for r in stats.values()))])
        names = [generated_name(i) for i in range(width)]
        if not names:
            raise SchemaError("schema has no columns")
    lines = stats[0]["n"]  # every line reaches its first field
    missing = {"bits": 0, "len": 0, "low": None, "high": None, "n": 0}
    fields = []
    for i, name in enumerate(names):
        of = stats.get(i, missing)
        # Lines that end before a column hold an empty value for it, which has no bits.
        fields.append(decide(name, of if of["n"] == lines else {**of, "bits": 0}, zone))
    return fields
