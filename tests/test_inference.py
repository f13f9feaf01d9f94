import random

import pytest

from loadstone.fields import SchemaError
from loadstone.functions import predicates as P
from loadstone.operators import inference as I
from loadstone.operators.quality import count_rows, typed_rows
from loadstone.plans.load import resolve_fields


def infer(text, values, **options):
    return I.infer_fields(text(*values), ["c"], **options)[0]


@pytest.mark.parametrize(
    "values,expected",
    [
        (["1", " 22 ", "-3"], "INT64"),
        (["9" * 18], "INT64"),
        (["-" + "9" * 18], "INT64"),
        (["9" * 19], "STRING(length=19)"),
        (["-"], "INT64"),
        (["20120305"], "INT64"),
        (["1.50", "22.25"], "NUMERIC(precision=5, scale=2)"),
        (["1.50", "7"], "NUMERIC(precision=4, scale=2)"),
        (["-1.5"], "NUMERIC(precision=4, scale=1)"),
        (["3700.0014      "], "NUMERIC(precision=9, scale=4)"),
        (["1.5", "1.25"], "FLOAT64"),
        (["1-2"], "FLOAT64"),
        (["1.5", "1234567890123456.25"], "STRING(length=19)"),
        (["2012-03-05 05:55:26+00:00"], "TIMESTAMP_ZONED(format=yyyy-MM-dd HH:mm:ssz)"),
        (["2012-03-05 05:55:26Z", "2012-03-10 13:12:12-06:00"], "TIMESTAMP_ZONED(format=yyyy-MM-dd HH:mm:ssz)"),
        (["2012-03-05 05:55:26 UTC-07:00"], "TIMESTAMP_ZONED(format=yyyy-MM-dd HH:mm:ss z)"),
        (["2012-03-05 05:55:26"], "TIMESTAMP_LOCAL(format=yyyy-MM-dd HH:mm:ss, zone=America/Los_Angeles)"),
        (["2012-03-05 05:55:26", "2012-03-05 05:55:26Z"], "STRING(length=20)"),
        (["2012-03-05", "2021-12-31"], "DATE(format=yyyy-MM-dd)"),
        (["2012/03/05"], "DATE(format=yyyy/MM/dd)"),
        (["03/05/2012"], "DATE(format=MM/dd/yyyy)"),
        (["2012-03-05", "03/05/2012"], "STRING(length=10)"),
        (["2021-02-31"], "STRING(length=10)"),
        (["1", ""], "STRING(length=1)"),
        (["2012-03-05", " "], "STRING(length=10)"),
        (["", ""], "STRING"),
        (["Ω1"], "STRING(length=2)"),
    ],
)
def test_decision(text, values, expected):
    assert infer(text, values).describe() == expected


def test_zone_option(text):
    assert infer(text, ["2012-03-05 05:55:26"], zone="Asia/Tokyo").zone == "Asia/Tokyo"


def test_empty_sample(spark):
    with pytest.raises(SchemaError):
        I.infer_fields(spark.createDataFrame([], "value string"), ["c"])


def test_short_rows_count_as_empty_and_surplus_is_ignored(text):
    fields = I.infer_fields(text("1þ2þ3", "1", "1þ2þ3þ4"), ["a", "b", "c"])
    assert [f.kind for f in fields] == ["INT64", "STRING", "STRING"]


# A wide row: keys of many digits, padded text, numbers and three ways to write a time.
SHAPE = [
    ("7" * 22, "STRING(length=22)"),
    ("", "STRING"),
    ("123456.75   ", "NUMERIC(precision=9, scale=2)"),
    ("1999-12-31 23:59:58+00:00", "TIMESTAMP_ZONED(format=yyyy-MM-dd HH:mm:ssz)"),
    ("0", "INT64"),
    ("8" * 20 + "    ", "STRING(length=20)"),
    ("1999-12-31 23:59:58-03:00", "TIMESTAMP_ZONED(format=yyyy-MM-dd HH:mm:ssz)"),
    ("some words", "STRING(length=10)"),
    ("1999-12-31 23:59:58", "TIMESTAMP_LOCAL(format=yyyy-MM-dd HH:mm:ss, zone=America/Los_Angeles)"),
    ("-15", "INT64"),
]


def test_shape_of_a_wide_row(spark, text):
    """What is inferred also decodes: every row, every column."""
    lines = text(*["þ".join(v for v, _ in SHAPE)] * 49)
    fields = resolve_fields(spark, lines, autodetect=True)
    assert [f.describe() for f in fields] == [kind for _, kind in SHAPE]
    assert [f.name for f in fields] == list("abcdefghij")
    assert count_rows(lines, fields).first().asDict() == {"rows": 49, "bad": 0}
    row = typed_rows(lines, fields).first()
    assert row["b"] is None and [c for c in row.asDict() if row[c] is None] == ["b"]


def test_sample_is_the_head(spark, file_of):
    """Rows after the sample do not count; with no sample size all of them do."""
    path = file_of("s.txt", ["1"] * 5 + ["x"])
    lines = spark.read.text(path)
    assert resolve_fields(spark, lines, autodetect=True, sample_rows=5)[0].kind == "INT64"
    assert resolve_fields(spark, lines, autodetect=True, sample_rows=6)[0].kind == "STRING"
    assert resolve_fields(spark, lines, autodetect=True, sample_rows=None)[0].kind == "STRING"


@pytest.mark.parametrize(
    "x,numeric,integer,decimal",
    [
        ("", False, False, False),
        ("5", True, True, True),
        ("-5", True, True, True),
        ("5-", True, False, False),
        ("-", True, True, True),
        (".", True, False, True),
        ("1.2.3", False, False, False),
        ("-1-2", False, False, True),
        ("--", False, False, True),
        ("+5", False, False, False),
        ("5\n", False, False, False),
        ("9" * 18, True, True, True),
        ("9" * 19, True, False, True),
        ("9" * 37, True, False, False),
        ("-." + "9" * 36, True, False, True),
        ("٣", False, False, False),
    ],
)
def test_number_tests(decoded, x, numeric, integer, decimal):
    assert decoded(P.is_numeric, [x]) == [numeric]
    assert decoded(P.is_int, [x]) == [integer]
    assert decoded(P.is_decimal, [x]) == [decimal]


def test_scale(decoded):
    texts = ["5", "5.25", "5.", ".", "1.2.345", "..", ".5", ""]
    assert decoded(I.scale_of, texts) == [None, 2, 1, None, 3, None, 1, None]


RAGGED = [
    ["1þ2þ3", "1", "1þ2þ3þ4þþþ"], ["þþ", "þ"], [""], ["", "þþ"], ["a", ""], [" þ", "xþyþþ"], ["1.5þþ", "2.25", "þ þ"], ["þ2012-03-05", "þ2013-01-01þ"],
]


@pytest.mark.parametrize("lines", RAGGED)
def test_width_and_types_in_one_pass(text, lines):
    from loadstone.operators.schema import autodetect_names

    names = autodetect_names(text(*lines), "þ")
    if not names:
        with pytest.raises(SchemaError):
            I.infer_fields(text(*lines), None)
        return
    assert I.infer_fields(text(*lines), None) == I.infer_fields(text(*lines), names)
    assert [f.name for f in I.infer_fields(text(*lines), None)] == names


def test_statistics_that_grow(spark, tmp_path):
    rng, state, every = random.Random(9), str(tmp_path / "state"), []
    (tmp_path / "in +%20").mkdir()
    assert I.extend_statistics(spark, state, [write(tmp_path / "in +%20" / "none.txt", [])]).isEmpty()
    for n in range(5):
        lines = ["þ".join(rng.choice(["", "1", "2.5", "x", "2012-03-05"]) for _ in range(rng.randint(1, 2 + n))) for _ in range(20)]
        lines = lines if n else ["1þ2", "3þ4"]
        every += lines
        path = write(tmp_path / "in +%20" / f"[{n}].txt", lines)
        stored = I.extend_statistics(spark, state, str(tmp_path / "in +%20"))
        assert stored.select("source").distinct().count() == n + 1
        whole = spark.createDataFrame([(x,) for x in every], "value string")
        assert I.decide_all(I.merged_statistics(stored)) == I.infer_fields(whole, None)
        # What is in the state is not read again.
        assert path
        (tmp_path / "in +%20" / f"[{n}].txt").write_text("wþiþdþeþr\n" * 3, encoding="utf-8")
    assert I.extend_statistics(spark, state, str(tmp_path / "in +%20")).exceptAll(stored).isEmpty()


def write(path, lines):
    path.write_text("".join(x + "\n" for x in lines), encoding="utf-8")
    return str(path)


def test_autodetect_scans_once_for_the_schema(spark, tmp_path, monkeypatch):
    from loadstone.plans.load import resolve_fields
    from loadstone.sources import delimited

    monkeypatch.setattr(delimited, "widest_line", lambda *a: pytest.fail("a scan of its own"))
    path = write(tmp_path / "x.txt", ["1þa", "2þbþ3.5"])
    fields = resolve_fields(spark, spark.read.text(path), autodetect=True)
    assert [(f.name, f.kind) for f in fields] == [("a", "INT64"), ("b", "STRING"), ("c", "STRING")]


def test_file_names_are_decoded_once_each(spark, file_of, tmp_path, monkeypatch):
    """The name of a file is decoded for its statistics, not for each of its lines."""
    from loadstone.operators import inference

    seen = []
    make = inference.column_statistics
    monkeypatch.setattr(inference, "column_statistics", lambda lines, *more: seen.append(lines) or make(lines, *more))
    name = file_of("a +b%20c.txt", ["1þ2", "3þ4"])
    stored = inference.extend_statistics(spark, str(tmp_path / "state"), name.replace("+", "*"))
    assert "url_decode" not in seen[0]._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {r["source"] for r in stored.collect()} == {f"file:{name}"}
