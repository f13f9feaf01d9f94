"""Tests on text that schema inference is built from."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadstone.fields import LOCAL_FORMAT, OFFSET_FORMAT, ZONE_FORMAT, ZONE_FORMAT_CLOSE
from loadstone.functions.text import char_is, has

# The date patterns tried, in this order.
DATE_FORMATS = ("yyyy-MM-dd", "yyyyMMdd", "yyyy/MM/dd", "MM/dd/yyyy")

# The timestamp patterns tried, by kind.
TIMESTAMP_FORMATS = {
    "local": LOCAL_FORMAT,
    "zoned": ZONE_FORMAT_CLOSE,
    "zoned_space": ZONE_FORMAT,
    "offset": OFFSET_FORMAT,
}


def is_numeric(x: Column) -> Column:
    """Digits with at most one point and one minus, anywhere."""
    return (x != "") & x.rlike(r"^[0-9]*+(-[0-9]*+\.?|\.[0-9]*+-?)?[0-9]*+\z")


def is_int(x: Column) -> Column:
    """At most 18 digits with an optional leading minus."""
    return (x != "") & x.rlike(r"^-?[0-9]{0,18}\z")


def is_decimal(x: Column) -> Column:
    """At most 36 digits and one point; a minus only if the text starts with one."""
    digits = F.length(F.regexp_replace(x, "[^0-9]", ""))
    shape = r"^(-[0-9-]*(\.[0-9-]*)?|[0-9]*(\.[0-9]*)?)\z"
    return (x != "") & x.rlike(shape) & (digits <= 36)


def is_timestamp_kind(x: Column, kind: str) -> Column:
    """Whether ``x`` reads as the timestamp ``kind`` (a key of TIMESTAMP_FORMATS).

    A failed parse costs an exception inside the parser, so text that lacks
    what every match must have is turned away first.
    """
    possible = has(x, ":") & (F.length(x) >= (19 if kind == "local" else 20))
    if kind == "local":
        possible = possible & char_is(x, -3, ":") & char_is(x, -6, ":")
    elif kind == "zoned_space":
        possible = possible & (F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit(""))) >= 2)
    parsed = F.try_to_timestamp(x, F.lit(TIMESTAMP_FORMATS[kind])).isNotNull()
    return F.when(possible, parsed).otherwise(F.lit(False))


def is_date(x: Column, fmt: str) -> Column:
    """Whether ``x`` reads as a date in one of DATE_FORMATS."""
    possible = F.length(x) >= len(fmt)
    for i, ch in enumerate(fmt):
        if not ch.isalpha():
            # The year is the one part of variable width.
            possible = possible & char_is(x, i - len(fmt) if fmt.startswith("y") else i + 1, ch)
    if fmt.isalpha():
        # Where the other patterns have their separators.
        possible = possible & F.substring(x, -3, 1).between("0", "9")
        possible = possible & F.substring(x, -5, 1).between("0", "9")
    parsed = F.try_to_date(x, fmt).isNotNull()
    return F.when(possible, parsed).otherwise(F.lit(False))


def match_date_format(x: Column) -> Column:
    """The first of DATE_FORMATS that reads ``x``, else NULL."""
    return F.coalesce(*[F.when(is_date(x, fmt), F.lit(fmt)) for fmt in DATE_FORMATS])
