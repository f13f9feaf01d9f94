"""Names of tables and columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession

from loadstone.fields import quoted


@dataclass(frozen=True)
class TableName:
    catalog: str | None
    database: str | None
    table: str

    def __str__(self) -> str:
        parts = [p for p in (self.catalog, self.database, self.table) if p]
        return ".".join(quoted(p) for p in parts)


def resolve_table(spec: str, database: str | None = None, catalog: str | None = None) -> TableName:
    """``[catalog:][database.]table``, also ``catalog.database.table``, with defaults.

    The default database may itself be given as ``catalog:database``.
    """
    if database and ":" in database:
        catalog, _, database = database.partition(":")
    head, colon, rest = spec.rpartition(":")
    parts = rest.split(".")
    if colon:
        if not head or len(parts) != 2:
            raise ValueError(f"{spec!r}: a table with a catalog needs a database too")
        return TableName(head, *parts)
    if not all(parts) or len(parts) > 3:
        raise ValueError(f"{spec!r} is not [catalog:][database.]table")
    if len(parts) == 3:
        return TableName(*parts)
    if len(parts) == 2:
        return TableName(catalog, *parts)
    return TableName(catalog if database else None, database, parts[0])


def table_exists(spark: SparkSession, name: TableName) -> bool:
    return spark.catalog.tableExists(str(name))


def sql_text(value: str) -> str:
    """A string as a SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Fixed value: the alphabet of generated column names.
NAME_CHARS = "abcdefghijklmnopqrstuvwxyz0123456789"


def generated_name(i: int) -> str:
    """a..z, 0..9, then two characters and more, the low one first: 36 is ab, 37 is bb."""
    high, low = divmod(i, len(NAME_CHARS))
    return NAME_CHARS[low] + (generated_name(high) if high else "")
