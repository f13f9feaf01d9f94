"""Delimited text to typed tables and back, as Spark jobs."""

from loadstone.fields import FieldSpec, SchemaError
from loadstone.operators.inference import infer_fields
from loadstone.operators.quality import LoadError
from loadstone.operators.schema import parse_spec, schema_report, template_fields
from loadstone.plans.export import ExportResult, export
from loadstone.plans.load import LoadResult, load, resolve_fields

__all__ = [
    "ExportResult",
    "FieldSpec",
    "LoadError",
    "LoadResult",
    "SchemaError",
    "export",
    "infer_fields",
    "load",
    "parse_spec",
    "resolve_fields",
    "schema_report",
    "template_fields",
]
