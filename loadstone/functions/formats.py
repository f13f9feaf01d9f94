"""Value formatting for text export: one string expression per typed column.

None of the formats depends on the session time zone or on ANSI mode.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

EXPORT_DELIMITER = ","


class ExportTypeError(TypeError):
    """A column whose type has no text form."""


def fmt_decimal(c: Column, scale: int) -> Column:
    """Plain notation without trailing zeros: 100.500 is 100.5, 100.00 is 100."""
    # try_cast prints plain digits also where cast would print an exponent.
    text = c.try_cast("string")
    if scale == 0:
        return text
    return F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))


def fmt_timestamp(c: Column, has_zone: bool = True) -> Column:
    """``yyyy-MM-dd HH:mm:ss UTC``, the fraction dropped.

    A timestamp without zone is taken as UTC wall clock.
    """
    wall = c
    if has_zone:
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        wall = F.timestamp_add("MICROSECOND", F.unix_micros(c), epoch)
    return F.concat(F.substring_index(wall.cast("string"), ".", 1), F.lit(" UTC"))


def fmt_date(c: Column) -> Column:
    return c.cast("string")


def fmt_string(c: Column, delimiter: str = EXPORT_DELIMITER) -> Column:
    """Quoted only where the text holds the delimiter or a newline.

    Inside quotes a quote becomes ``\\"`` and a newline the two characters
    ``\\n``; any other text is passed on as it is, quotes included.
    """
    escaped = F.replace(F.replace(c, F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    special = F.contains(c, F.lit(delimiter)) | F.contains(c, F.lit("\n"))
    return F.when(special, F.concat(F.lit('"'), escaped, F.lit('"'))).otherwise(c)


def fmt_scalar(c: Column) -> Column:
    """Integers, floating point and booleans, printed as Java prints them."""
    return c.cast("string")


def fmt_null(text: Column, name: str, required: bool = False) -> Column:
    """NULL is an empty field; in a required column it is an error."""
    if required:
        return F.coalesce(text, F.raise_error(F.lit(f"{name} is required and has no value")))
    return F.coalesce(text, F.lit(""))


def fmt_value(c: Column, dtype: T.DataType) -> Column:
    """The text form of ``c``, NULL where ``c`` is NULL."""
    if isinstance(dtype, T.DecimalType):
        return fmt_decimal(c, dtype.scale)
    if isinstance(dtype, T.TimestampType):
        return fmt_timestamp(c)
    if isinstance(dtype, T.TimestampNTZType):
        return fmt_timestamp(c, has_zone=False)
    if isinstance(dtype, T.DateType):
        return fmt_date(c)
    if isinstance(dtype, T.StringType):
        return fmt_string(c)
    if is_scalar(dtype):
        return fmt_scalar(c)
    raise ExportTypeError(f"{dtype.simpleString()} has no text form")


def is_scalar(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.IntegralType, T.FloatType, T.DoubleType, T.BooleanType))


def has_text_form(dtype: T.DataType) -> bool:
    return is_scalar(dtype) or isinstance(
        dtype, (T.DecimalType, T.TimestampType, T.TimestampNTZType, T.DateType, T.StringType)
    )
