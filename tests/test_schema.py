import pytest
from pyspark.sql import types as T

from loadstone.fields import FieldSpec, SchemaError
from loadstone.operators import schema as S

SPEC_OF_ALL_TYPES = (
    "Order:STRING:12,Customer:STRING:30,price:NUMERIC:11.3,units:NUMERIC:6.0,booked:TIMESTAMP,"
    "weight:FLOAT64,lines:INT64,due:DATE:dd.MM.yyyy,sent:TIMESTAMP:Europe/Berlin,note"
)


def string(name, n):
    return FieldSpec(name, "STRING", length=n)


def numeric(name, p, s):
    return FieldSpec(name, "NUMERIC", precision=p, scale=s)


def offset(name):
    return FieldSpec(name, "TIMESTAMP_OFFSET", format="yyyy-MM-dd HH:mm:ssXXXXX")


def test_spec_of_all_types():
    local = FieldSpec("sent", "TIMESTAMP_LOCAL", format="yyyy-MM-dd HH:mm:ss", zone="Europe/Berlin")
    assert S.parse_spec(SPEC_OF_ALL_TYPES) == [
        string("order", 12),
        string("customer", 30),
        numeric("price", 11, 3),
        numeric("units", 6, 0),
        offset("booked"),
        FieldSpec("weight", "FLOAT64"),
        FieldSpec("lines", "INT64"),
        FieldSpec("due", "DATE", format="dd.MM.yyyy"),
        local,
        FieldSpec("note"),
    ]


@pytest.mark.parametrize(
    "item,expected",
    [
        ("Name", FieldSpec("name")),
        ("a:STRING", FieldSpec("a")),
        ("a:STRING:0", FieldSpec("a")),
        ("a:INT64", FieldSpec("a", "INT64")),
        ("a:FLOAT64", FieldSpec("a", "FLOAT64")),
        ("a:NUMERIC", FieldSpec("a", "NUMERIC", precision=18, scale=5)),
        ("a:DATE", FieldSpec("a", "DATE", format="yyyy-MM-dd")),
        ("a:DATE:MM/dd/yyyy", FieldSpec("a", "DATE", format="MM/dd/yyyy")),
        ("a:DATE:yyyyMMdd", FieldSpec("a", "DATE", format="yyyyMMdd")),
        ("a:DATETIME", FieldSpec("a", "TIMESTAMP_OFFSET")),
        (
            "a:TIMESTAMP:America/Chicago|yyyyMMddHHmmss",
            FieldSpec("a", "TIMESTAMP_LOCAL", format="yyyyMMddHHmmss", zone="America/Chicago"),
        ),
        (
            "a:TIMESTAMP:UTC|yyyy-MM-dd HH:mm:ss",
            FieldSpec("a", "TIMESTAMP_LOCAL", format="yyyy-MM-dd HH:mm:ss", zone="UTC"),
        ),
        (
            "a:TIMESTAMP:yyyy-MM-dd HH.mm.ssz",
            FieldSpec("a", "TIMESTAMP_ZONED", format="yyyy-MM-dd HH.mm.ssz"),
        ),
        (
            "a:TIMESTAMP:yyyy/MM/dd HH:mm:ssXXXXX",
            FieldSpec("a", "TIMESTAMP_OFFSET", format="yyyy/MM/dd HH:mm:ssXXXXX"),
        ),
    ],
)
def test_spec_items(item, expected):
    assert S.parse_spec(item) == [expected]


@pytest.mark.parametrize(
    "spec",
    [
        "",
        "a:BOOL",
        "a:string",
        "a:INT64:5",
        "a:STRING:x",
        "a:NUMERIC:9",
        "a:NUMERIC:39.2",
        "a:NUMERIC:0.0",
        "a:NUMERIC:2.5",
        "a:TIMESTAMP:yyyyMMddHHmmss",
        "a:TIMESTAMP:UTC|yyyy-MM-dd HH:mm:ssz",
    ],
)
def test_spec_errors(spec):
    with pytest.raises(SchemaError):
        S.parse_spec(spec)


def field(name, dtype, comment=None):
    return T.StructField(name, dtype, True, {"comment": comment} if comment else None)


def test_template():
    schema = T.StructType(
        [
            field("KEY", T.StringType(), "24"),
            field("free", T.StringType()),
            field("n", T.LongType(), "ignored"),
            field("d", T.DoubleType(), "ignored"),
            field("q1", T.DecimalType(10, 0), "14,4"),
            field("q2", T.DecimalType(10, 0)),
            field("q3", T.DecimalType(38, 9)),
            field("q4", T.DecimalType(12, 2)),
            field("day", T.DateType(), "MM/dd/yyyy"),
            field("t1", T.TimestampType()),
            field("t2", T.TimestampType(), "yyyy-MM-dd HH:mm:ssz"),
            field("t3", T.TimestampType(), "America/Los_Angeles"),
            field("t4", T.TimestampType(), "America/Los_Angeles|yyyy-MM-dd HH:mm:ss"),
        ]
    )
    got = {f.name: f for f in S.template_fields(schema)}
    assert got["key"].length == 24 and got["free"].length is None
    assert (got["n"].kind, got["d"].kind) == ("INT64", "FLOAT64")
    assert [(got[q].precision, got[q].scale) for q in ("q1", "q2", "q3", "q4")] == [
        (14, 4),
        (10, 0),
        (38, 9),
        (12, 2),
    ]
    assert got["day"].format == "MM/dd/yyyy"
    assert got["t1"].kind == "TIMESTAMP_OFFSET"
    assert (got["t2"].kind, got["t2"].format) == ("TIMESTAMP_ZONED", "yyyy-MM-dd HH:mm:ssz")
    assert (got["t3"].kind, got["t3"].zone) == ("TIMESTAMP_LOCAL", "America/Los_Angeles")
    assert got["t4"].format == "yyyy-MM-dd HH:mm:ss"
    assert got["q1"].comment == "14,4"


@pytest.mark.parametrize(
    "dtype", [T.BooleanType(), T.BinaryType(), T.ArrayType(T.LongType()), T.TimestampNTZType()]
)
def test_template_rejects(dtype):
    with pytest.raises(SchemaError):
        S.template_fields(T.StructType([field("a", dtype)]))


def test_generated_names():
    names = [S.generated_name(i) for i in range(38)]
    assert names[:3] == ["a", "b", "c"] and names[25:27] == ["z", "0"] and names[35] == "9"
    assert names[36:] == ["ab", "bb"]
    assert len({S.generated_name(i) for i in range(36 * 36)}) == 36 * 36
    assert S.generated_name(36 * 36) == "aab"


def test_names_precedence(text):
    lines = text("1þ2", "1þ2þ3þþ", "1")
    schema = T.StructType([field("Template", T.StringType())])
    assert S.autodetect_names(lines, "þ", schema, "x,y") == ["Template"]
    assert S.autodetect_names(lines, "þ", None, "X,y") == ["X", "y"]
    assert S.autodetect_names(lines, "þ") == ["a", "b", "c"]
    assert S.autodetect_names(text(""), "þ") == ["a"]
    assert S.autodetect_names(text("þþ"), "þ") == []


def test_comments_match_without_case():
    template = T.StructType([field("KEY", T.StringType(), "24"), field("b", T.StringType())])
    got = S.copy_comments([FieldSpec("key"), FieldSpec("b"), FieldSpec("c")], template)
    assert [f.comment for f in got] == ["24", None, None]


def test_provider():
    schema = T.StructType([])
    assert S.schema_provider(True, "t", schema) == "autodetect"
    assert S.schema_provider(True, "t", None) == "autodetect"
    assert S.schema_provider(False, "t", schema) == "template"
    assert S.schema_provider(False, None, schema) == "template"
    assert S.schema_provider(False, None, None) == "spec"
    with pytest.raises(SchemaError):
        S.schema_provider(False, "t", None)


@pytest.mark.parametrize(
    "fields",
    [
        [],
        [FieldSpec("a"), FieldSpec("A")],
        [FieldSpec("a", "DATE", format="not a pattern")],
        [FieldSpec("a", "DATE", format="YYYY-ww")],
        [FieldSpec("a", "TIMESTAMP_LOCAL", zone="Nowhere/Land")],
    ],
)
def test_check_fields(spark, fields):
    with pytest.raises(SchemaError):
        S.check_fields(spark, fields)


def test_check_fields_accepts(spark):
    fields = S.parse_spec(SPEC_OF_ALL_TYPES)
    assert S.check_fields(spark, fields) == fields


def test_report(spark):
    rows = S.schema_report(spark, S.parse_spec("a:STRING:3,t:TIMESTAMP:Asia/Tokyo")).collect()
    assert [tuple(r) for r in sorted(rows)] == [
        (0, "a", "STRING", 3, None, None, None, None),
        (1, "t", "TIMESTAMP_LOCAL", None, None, None, "yyyy-MM-dd HH:mm:ss", "Asia/Tokyo"),
    ]
