"""Row assembly for text export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone.fields import quoted
from loadstone.functions.formats import (
    EXPORT_DELIMITER,
    ExportTypeError,
    fmt_null,
    fmt_value,
    has_text_form,
)

EXPORT_LINE = "line"


def unsupported_columns(schema: T.StructType) -> list[tuple[str, str]]:
    """(name, type) of the columns that have no text form."""
    return [
        (f.name, f.dataType.simpleString()) for f in schema.fields if not has_text_form(f.dataType)
    ]


def check_types(schema: T.StructType) -> None:
    """Reject a table with an unsupported column before any of it is read."""
    bad = unsupported_columns(schema)
    if bad:
        raise ExportTypeError("columns without a text form: " + ", ".join(f"{n} {t}" for n, t in bad))


def export_lines(df: DataFrame) -> DataFrame:
    """Every row as one line of comma separated text, without header.

    A projection: no shuffle, and the scan reads what ``df`` selects.
    """
    check_types(df.schema)
    texts = [
        fmt_null(fmt_value(F.col(quoted(f.name)), f.dataType), f.name, required=not f.nullable)
        for f in df.schema.fields
    ]
    return df.select(F.concat_ws(EXPORT_DELIMITER, *texts).alias(EXPORT_LINE))
