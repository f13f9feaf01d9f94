"""The schema model: one :class:`FieldSpec` per output column."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

STRING = "STRING"
INT64 = "INT64"
FLOAT64 = "FLOAT64"
NUMERIC = "NUMERIC"
DATE = "DATE"
TIMESTAMP_OFFSET = "TIMESTAMP_OFFSET"  # the text carries an offset
TIMESTAMP_ZONED = "TIMESTAMP_ZONED"  # the text carries a zone
TIMESTAMP_LOCAL = "TIMESTAMP_LOCAL"  # local text, the zone is declared

TIMESTAMP_KINDS = (TIMESTAMP_OFFSET, TIMESTAMP_ZONED, TIMESTAMP_LOCAL)

# Default patterns per kind, the marker that tells an offset
# pattern from a zone pattern, and the decimal size used when none is declared.
DATE_FORMAT = "yyyy-MM-dd"
LOCAL_FORMAT = "yyyy-MM-dd HH:mm:ss"
OFFSET_FORMAT = "yyyy-MM-dd HH:mm:ssXXXXX"
ZONE_FORMAT = "yyyy-MM-dd HH:mm:ss z"
ZONE_FORMAT_CLOSE = "yyyy-MM-dd HH:mm:ssz"
OFFSET_MARK = "XXXXX"
DEFAULT_PRECISION, DEFAULT_SCALE = 18, 5
MAX_PRECISION = 38

DEFAULT_FORMATS = {
    DATE: DATE_FORMAT,
    TIMESTAMP_OFFSET: OFFSET_FORMAT,
    TIMESTAMP_ZONED: ZONE_FORMAT,
    TIMESTAMP_LOCAL: LOCAL_FORMAT,
}


# Integer columns of a destination that are narrower than a bigint.
NARROW_INTEGERS = {"int": T.IntegerType(), "smallint": T.ShortType(), "tinyint": T.ByteType()}


class SchemaError(ValueError):
    """A schema that cannot be resolved or decoded."""


def quoted(name: str) -> str:
    """A column or table name as an identifier, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


def pattern_letters(fmt: str) -> set[str]:
    """Pattern letters of a datetime format, without its quoted literals."""
    unquoted = "".join(fmt.split("'")[::2])
    return {c for c in unquoted if c.isalpha()}


@dataclass(frozen=True)
class FieldSpec:
    """How the text of one column is decoded, and what it becomes."""

    name: str
    kind: str = STRING
    length: int | None = None
    precision: int | None = None
    scale: int | None = None
    format: str | None = None
    zone: str | None = None
    comment: str | None = None
    # An inferred length is what was seen, not a limit, and an inferred scale cuts nothing off.
    inferred: bool = False
    # The Spark type of a destination column that is narrower than the kind's own.
    target: str | None = None

    def __post_init__(self) -> None:
        if self.format is None and self.kind in DEFAULT_FORMATS:
            object.__setattr__(self, "format", DEFAULT_FORMATS[self.kind])
        if self.kind == STRING and self.length is not None and self.length <= 0:
            object.__setattr__(self, "length", None)
        if self.kind == NUMERIC:
            p, s = self.precision, self.scale
            if p is None or not 0 < p <= MAX_PRECISION:
                raise SchemaError(f"{self.name}: precision {p} is not in 1..{MAX_PRECISION}")
            if s is None or not 0 <= s <= p:
                raise SchemaError(f"{self.name}: scale {s} is not in 0..{p}")
        if self.kind in TIMESTAMP_KINDS:
            in_text = bool(pattern_letters(self.format) & set("zVXxZO"))
            if self.kind == TIMESTAMP_LOCAL:
                if not self.zone:
                    raise SchemaError(f"{self.name}: a local timestamp needs a zone")
                if in_text:
                    raise SchemaError(
                        f"{self.name}: format {self.format!r} has a zone of its own, "
                        f"so {self.zone!r} cannot be declared"
                    )
            elif not in_text:
                raise SchemaError(
                    f"{self.name}: format {self.format!r} has no zone; declare one as zone|format"
                )

    @property
    def spark_type(self) -> T.DataType:
        if self.kind == STRING:
            return T.StringType()
        if self.kind == INT64:
            return NARROW_INTEGERS.get(self.target, T.LongType())
        if self.kind == FLOAT64:
            return T.FloatType() if self.target == "float" else T.DoubleType()
        if self.kind == NUMERIC:
            return T.DecimalType(self.precision, self.scale)
        if self.kind == DATE:
            return T.DateType()
        return T.TimestampType()

    @property
    def limit(self) -> int | None:
        """The length that a string is cut to."""
        return None if self.inferred or self.kind != STRING else self.length

    @property
    def struct_field(self) -> T.StructField:
        metadata = {"comment": self.comment} if self.comment else None
        return T.StructField(self.name, self.spark_type, True, metadata)

    @property
    def type_name(self) -> str:
        return "TIMESTAMP" if self.kind in TIMESTAMP_KINDS else self.kind

    def with_comment(self, comment: str | None) -> "FieldSpec":
        return replace(self, comment=comment)

    def describe(self) -> str:
        args = {
            "length": self.length,
            "precision": self.precision,
            "scale": self.scale,
            "format": self.format,
            "zone": self.zone,
        }
        shown = ", ".join(f"{k}={v}" for k, v in args.items() if v is not None)
        return f"{self.kind}({shown})" if shown else self.kind


def struct_type(fields: list[FieldSpec]) -> T.StructType:
    return T.StructType([f.struct_field for f in fields])
