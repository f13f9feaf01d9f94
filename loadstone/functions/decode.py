"""Typed decoding: the text of a field to a typed Catalyst expression.

Every decoder returns NULL for the empty string and for text it cannot read;
``operators.quality`` tells the two apart. All of them stay inside whole-stage
code generation. The common shape of each type takes a cheap route (a byte
search and a plain cast); only text that route cannot vouch for reaches the
pattern parser or a regular expression. Both routes give the same value. They use
their text several times: give them a column, not an expression that is dear.

No decoder depends on the session time zone: each parse finds its zone in the
text, or reads the text as UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadstone.fields import (
    DATE,
    DATE_FORMAT,
    FLOAT64,
    INT64,
    LOCAL_FORMAT,
    NUMERIC,
    OFFSET_FORMAT,
    STRING,
    TIMESTAMP_LOCAL,
    TIMESTAMP_OFFSET,
    ZONE_FORMAT,
    FieldSpec,
)
from loadstone.functions.text import char_is, ends_in_digit, has, trimmed


def decode_string(x: Column, length: int | None = None) -> Column:
    """Text as it is, never trimmed; at most ``length`` characters."""
    text = F.nullif(x, F.lit(""))
    return F.substring(text, 1, length) if length else text


def decode_int64(x: Column) -> Column:
    """ASCII digits with an optional leading minus; out of range is unreadable."""
    # The cast trims by itself and takes just this grammar, but for a plus sign
    # and a trailing DEL. Empty fields are kept from it: a failed cast is dear.
    return F.when((x != "") & ~has(x, "+", "\x7f"), x.try_cast("bigint"))


def decode_float64(x: Column) -> Column:
    """Java's double syntax, so ``NaN``, ``Infinity`` and ``1d`` are legal."""
    # The cast also takes inf, nan and infinity in any case; no finite number
    # has an n in it.
    number = F.when(~has(x, "n", "N"), x.try_cast("double"))
    named = F.when(trimmed(x).rlike(r"^[+-]?(NaN|Infinity)\z"), x.try_cast("double"))
    return F.when(x != "", F.coalesce(number, named))


def decode_narrow_int(x: Column, target: str) -> Column:
    """An integer of a narrower column; out of its range is unreadable."""
    return decode_int64(x).try_cast(target)


def decode_float32(x: Column) -> Column:
    """A double that fits a float; a finite number beyond its range is unreadable."""
    value = decode_float64(x)
    narrow = value.cast("float")
    infinite = lambda c: F.abs(c) == float("inf")
    return F.when(~infinite(narrow) | infinite(value) | F.isnan(value), narrow)


def decode_numeric(x: Column, precision: int, scale: int, exact: bool = False) -> Column:
    """A decimal; digits beyond ``scale`` are cut off, not rounded. If ``exact``, text
    that would lose a digit is unreadable instead."""
    target = f"decimal({precision},{scale})"
    dot = F.instr(x, ".")
    plain = (
        ~has(x, "+", "e", "E")
        & (F.octet_length(x) == F.length(x))
        & ((dot == 0) | (F.length(x) - dot <= scale))
    )
    text = trimmed(x)
    digits = f"[0-9]{{0,{scale}}}0*" if exact else "[0-9]*"
    valid = text.rlike(rf"^-?([0-9]+(\.{digits})?|\.{digits})\z")
    kept = F.regexp_extract(text, rf"^-?[0-9]*(\.[0-9]{{0,{scale}}})?", 0)
    # A point without digits on either side reads as zero.
    cut = F.when(kept.isin(".", "-."), F.lit(0).cast(target)).otherwise(kept.try_cast(target))
    value = F.coalesce(F.when(plain, x.try_cast(target)), F.when(valid, cut))
    return F.when(x != "", value)


def decode_date(x: Column, fmt: str = DATE_FORMAT) -> Column:
    value = F.try_to_date(trimmed(x), fmt)
    if fmt == DATE_FORMAT:
        iso = (F.length(x) == 10) & _iso_date_marks(x) & ends_in_digit(x)
        value = F.coalesce(F.when(iso, x.try_cast("date")), value)
    return F.when(x != "", value)


def decode_ts_offset(x: Column, fmt: str = OFFSET_FORMAT) -> Column:
    """Text with an offset, to the instant it names."""
    return F.when(x != "", F.try_to_timestamp(trimmed(x), F.lit(fmt)))


def decode_ts_zoned(x: Column, fmt: str = ZONE_FORMAT) -> Column:
    """Text with a zone (``UTC-07:00``, a region, ``+00:00``), to the instant it names."""
    return decode_ts_offset(x, fmt)


def decode_ts_local(x: Column, zone: str, fmt: str = LOCAL_FORMAT) -> Column:
    """Local text in a declared zone, to the instant.

    In a spring gap the clock moves forward; in an autumn overlap the earlier
    offset counts.
    """
    # Read as if it were UTC, then moved to the zone.
    utc = F.try_to_timestamp(F.concat(trimmed(x), F.lit(" Z")), F.lit(f"{fmt} XXX"))
    if fmt == LOCAL_FORMAT:
        iso = (F.length(x) == 19) & _iso_time_marks(x) & ends_in_digit(x)
        quick = F.timestamp_seconds(F.unix_timestamp(x.try_cast("timestamp_ntz")))
        utc = F.coalesce(F.when(iso, quick), utc)
    return F.when(x != "", F.to_utc_timestamp(utc, zone))


def decode(spec: FieldSpec, x: Column) -> Column:
    """The decoder ``spec`` declares, applied to the text column ``x``."""
    if spec.kind == STRING:
        return decode_string(x, spec.limit)
    if spec.kind == INT64:
        return decode_narrow_int(x, spec.target) if spec.target else decode_int64(x)
    if spec.kind == FLOAT64:
        return decode_float32(x) if spec.target == "float" else decode_float64(x)
    if spec.kind == NUMERIC:
        return decode_numeric(x, spec.precision, spec.scale, exact=spec.inferred)
    if spec.kind == DATE:
        return decode_date(x, spec.format)
    if spec.kind == TIMESTAMP_LOCAL:
        return decode_ts_local(x, spec.zone, spec.format)
    if spec.kind == TIMESTAMP_OFFSET:
        return decode_ts_offset(x, spec.format)
    return decode_ts_zoned(x, spec.format)


def _iso_date_marks(x: Column) -> Column:
    return char_is(x, 5, "-") & char_is(x, 8, "-")


def _iso_time_marks(x: Column) -> Column:
    return _iso_date_marks(x) & char_is(x, 11, " ") & char_is(x, 14, ":") & char_is(x, 17, ":")

