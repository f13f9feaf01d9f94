import gzip

import pytest

from loadstone.sources import delimited as D
from loadstone.sources import tables as X


def values(df):
    return [r["value"] for r in df.collect()]


def test_lines_are_taken_as_they_are(spark, file_of):
    lines = ['a,"b', "", "  ", "#c", "\\", "ä"]
    assert sorted(values(D.scan_lines(spark, file_of("a.txt", lines)))) == sorted(lines)


def test_line_ends(spark, file_of):
    assert sorted(values(D.scan_lines(spark, file_of("a.txt", ["1", "2"], "\r\n")))) == ["1", "2"]


def test_several_sources(spark, file_of):
    a, b, c = (file_of(f"{n}.txt", [n]) for n in "abc")
    assert sorted(values(D.scan_lines(spark, [f"{a},{b}", c]))) == ["a", "b", "c"]
    assert D.source_paths("x") == ["x"]
    with pytest.raises(ValueError):
        D.source_paths([])


def test_missing_source(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        D.scan_lines(spark, str(tmp_path / "none")).collect()


def test_compressed_source(spark, tmp_path, file_of):
    path = tmp_path / "a.txt.gz"
    path.write_bytes(gzip.compress(b"1\n2\n"))
    lines = D.scan_lines(spark, str(path))
    assert sorted(values(lines)) == ["1", "2"]
    assert not D.is_splittable(lines)
    assert D.is_splittable(D.scan_lines(spark, file_of("b.txt", ["1"])))


@pytest.mark.parametrize("delimiter", ["þ", ",", "|", "\t", ".", "\\", "$", "^", "*", "(", "[", "{", " ", "x"])
def test_delimiters_are_literal(text, delimiter):
    line = delimiter.join(["1", "", "3"])
    row = D.split_fields(text(line), 3, delimiter).drop(D.LINE).first()
    assert tuple(row) == ("1", "", "3")


@pytest.mark.parametrize("delimiter", ["", "||"])
def test_a_delimiter_is_one_character(delimiter):
    with pytest.raises(ValueError):
        D.split_pattern(delimiter)


def test_ragged_rows(text):
    rows = D.split_fields(text("", "1", "1þ2þ3þ4", "þþ", "1þþ"), 3).drop(D.LINE).collect()
    assert [tuple(r) for r in rows] == [
        ("", "", ""),
        ("1", "", ""),
        ("1", "2", "3"),
        ("", "", ""),
        ("1", "", ""),
    ]


def test_sample(spark, file_of):
    lines = D.scan_lines(spark, file_of("a.txt", [str(i) for i in range(100)]))
    assert values(D.sample_lines(lines, 10)) == [str(i) for i in range(10)]
    assert D.sample_lines(lines, 1000).count() == 100
    assert D.sample_lines(lines, None) is lines
    assert D.sample_lines(lines).count() == 100
    with pytest.raises(ValueError):
        D.sample_lines(lines, 0)


def test_streams(spark):
    df = spark.range(0, 100, 1, 8)
    assert X.export_streams(df, 3).rdd.getNumPartitions() == 3
    spread = X.export_streams(df, 30)
    assert spread.rdd.getNumPartitions() == 30 and X.count_per_stream(spread).count() == 30
    assert [r["rows"] for r in X.count_per_stream(X.export_streams(df, 2)).collect()] == [50, 50]
    with pytest.raises(ValueError):
        X.export_streams(df, 0)


def test_streams_of_uneven_splits_are_even(spark):
    """Eight splits merge into 3, 3 and 2; the rows of skewed ones into one stream."""
    skewed = spark.range(0, 9000, 1, 1).union(spark.range(0, 600, 1, 3))
    for df, rows in ((spark.range(0, 8000, 1, 8), 8000), (skewed, 9600)):
        counts = [r["rows"] for r in X.count_per_stream(X.export_streams(df, 3)).collect()]
        assert len(counts) == 3 and sum(counts) == rows and max(counts) <= 1.1 * min(counts)
