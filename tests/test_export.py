import gzip
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadstone import export
from loadstone.functions import formats as X
from loadstone.functions.decode import decode_date, decode_numeric
from loadstone.operators.export import export_lines
from loadstone.operators.quality import rows_by_task, task_counts
from loadstone.sinks.text import bounded_streams


@pytest.fixture
def one(spark):
    """The export line of one row."""

    def run(value, dtype, nullable=True):
        schema = T.StructType([T.StructField("c", dtype, nullable)])
        return export_lines(spark.createDataFrame([(value,)], schema)).first()["line"]

    return run


@pytest.mark.parametrize(
    "value,dtype,expected",
    [
        (Decimal("100.500"), T.DecimalType(9, 3), "100.5"),
        (Decimal("100.00"), T.DecimalType(9, 2), "100"),
        (Decimal("100"), T.DecimalType(9, 0), "100"),
        (Decimal("0.00"), T.DecimalType(9, 2), "0"),
        (Decimal("-0.0100"), T.DecimalType(9, 4), "-0.01"),
        (Decimal("0E-18"), T.DecimalType(38, 18), "0"),
        (Decimal("1E-9"), T.DecimalType(38, 18), "0.000000001"),
        (datetime(2020, 1, 2, 3, 4, 5, 999999), T.TimestampType(), "2020-01-02 03:04:05 UTC"),
        (datetime(2020, 1, 2, 3, 4, 5, 1), T.TimestampNTZType(), "2020-01-02 03:04:05 UTC"),
        (datetime(1969, 12, 31, 23, 59, 59, 500000), T.TimestampType(), "1969-12-31 23:59:59 UTC"),
        (date(2020, 1, 2), T.DateType(), "2020-01-02"),
        ("plain", T.StringType(), "plain"),
        ('say "hi"', T.StringType(), 'say "hi"'),
        ('a,"b"', T.StringType(), '"a,\\"b\\""'),
        ('a\n"b"\nc', T.StringType(), '"a\\n\\"b\\"\\nc"'),
        ("", T.StringType(), ""),
        ("\\", T.StringType(), "\\"),
        (5, T.LongType(), "5"),
        (5, T.ShortType(), "5"),
        (12345678.9, T.DoubleType(), "1.23456789E7"),
        (0.5, T.FloatType(), "0.5"),
        (float("nan"), T.DoubleType(), "NaN"),
        (True, T.BooleanType(), "true"),
    ],
)
def test_values(one, value, dtype, expected):
    assert one(value, dtype) == expected
    assert one(None, dtype) == ""


def test_required(one, spark):
    assert one("x", T.StringType(), nullable=False) == "x"
    df = spark.createDataFrame([(None,), ("x",)], "c string")
    text = X.fmt_null(X.fmt_string(F.col("c")), "c", required=True)
    with pytest.raises(Exception, match="c is required and has no value"):
        df.select(text).collect()


def test_session_zone_does_not_matter(one, spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        instant = spark.sql("SELECT timestamp'2020-03-08 07:30:00 UTC' AS t, timestamp_ntz'2020-03-08 02:30:00' AS n")
        assert export_lines(instant).first()["line"] == "2020-03-08 07:30:00 UTC,2020-03-08 02:30:00 UTC"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_rows(spark):
    df = spark.sql("SELECT 1L AS a, CAST(NULL AS STRING) AS `b.c`, 'x,y' AS d, CAST(NULL AS DOUBLE) AS e")
    assert export_lines(df).first()["line"] == '1,,"x,y",'


@pytest.mark.parametrize("sql", ["array(1)", "map(1, 2)", "struct(1)", "X'00'", "INTERVAL 1 DAY"])
def test_unsupported_types(spark, sql):
    with pytest.raises(X.ExportTypeError, match="columns without a text form: bad"):
        export_lines(spark.sql(f"SELECT 1 AS ok, {sql} AS bad"))


@pytest.fixture
def numbers(spark):
    return spark.range(0, 1000, 1, 8).select("id", (F.col("id") % 7).cast("string").alias("s"))


def test_csv_gz(spark, numbers, tmp_path):
    result = export(spark, numbers, str(tmp_path / "out"), where="s = '3'", partitions=2)
    lines = []
    for part in (tmp_path / "out").glob("part-*.gz"):
        data = gzip.decompress(part.read_bytes()).decode()
        assert data.endswith("\n")
        lines += data.splitlines()
    assert sorted(lines) == sorted(f"{i},3" for i in range(1000) if i % 7 == 3)
    assert (result.rows, result.streams, result.parts) == (143, 2, 2)


def test_gzip_level(spark, tmp_path):
    """The fastest level leaves larger files than the default."""
    df = spark.range(0, 200000, 1, 1).select(F.md5(F.col("id").cast("string")).alias("s"), "id")
    export(spark, df, str(tmp_path / "fast"))
    export_lines(df).write.option("compression", "gzip").text(str(tmp_path / "default"))
    size = lambda d: sum(p.stat().st_size for p in (tmp_path / d).glob("part-*"))
    assert size("fast") > size("default")


def test_parts_are_capped(spark, numbers, tmp_path):
    result = export(spark, numbers, str(tmp_path / "out"), rows_per_part=100, partitions=1)
    assert (result.rows, result.streams, result.parts) == (1000, 1, 10)


@pytest.mark.parametrize("rows_per_part,parts", [(10_000_000, 8), (60, 24)])
def test_sequence_file(spark, numbers, tmp_path, rows_per_part, parts):
    path = str(tmp_path / "out")
    result = export(spark, numbers, path, fmt="SEQ", rows_per_part=rows_per_part)
    pairs = spark.sparkContext.sequenceFile(path).collect()
    assert sorted(pairs) == sorted(("", f"{i},{i % 7}\n") for i in range(1000))
    assert (result.rows, result.parts) == (1000, parts)
    head = next((tmp_path / "out").glob("part-*")).read_bytes()[:200]
    assert head.startswith(b"SEQ") and b"org.apache.hadoop.io.Text" in head and b"SnappyCodec" in head


def test_sequence_file_keeps_modes_out(spark, numbers, tmp_path):
    with pytest.raises(ValueError):
        export(spark, numbers, str(tmp_path / "out"), fmt="seq", mode="overwrite")
    with pytest.raises(ValueError):
        export(spark, numbers, str(tmp_path / "out"), fmt="avro")


def test_bounded_streams_only_when_needed(spark, numbers):
    lines = export_lines(numbers)
    with bounded_streams(lines, 125) as (same, counts):
        assert same is lines and counts == dict.fromkeys(range(8), 125)
    with bounded_streams(lines, 124) as (split, counts):
        assert "Exchange" not in split._jdf.queryExecution().executedPlan().toString()
        assert sorted(counts.values()) == [1] * 8 + [124] * 8
        assert sorted(r[0] for r in split.collect()) == sorted(f"{i},{i % 7}" for i in range(1000))


def test_over_full_stream_is_cut_where_it_is(spark, tmp_path):
    """One stream of 1000 rows beside empty ones: its task cuts it, nothing is shuffled."""
    skewed = spark.range(0, 1000, 1, 1).union(spark.range(0, 3, 1, 3))
    result = export(spark, skewed, str(tmp_path / "out"), fmt="seq", rows_per_part=300)
    assert (result.rows, result.parts) == (1003, 7)
    assert sorted(result.by_stream.values()) == [1, 1, 1, 100, 300, 300, 300]


@pytest.mark.parametrize("fmt", ["csv", "orc", "seq"])
def test_rows_by_stream(spark, numbers, tmp_path, fmt):
    """The rows told of a stream are those in the parts that carry its number."""
    path = str(tmp_path / "out")
    result = export(spark, numbers, path, fmt=fmt, where="id < 300 OR id >= 990")
    assert result.by_stream == {0: 125, 1: 125, 2: 50, 7: 10} and result.rows == 310
    if fmt == "csv":
        stored = {
            int(p.name[5:10]): len(gzip.decompress(p.read_bytes()).splitlines())
            for p in (tmp_path / "out").glob("part-*.gz")
        }
        assert {n: rows for n, rows in stored.items() if rows} == result.by_stream


def test_counts_of_very_many_tasks_are_exact(spark):
    """The aggregate behind the counts, over as many tasks as it tracks."""
    tasks = spark.range(0, 200_000, 1, 4).select(F.explode(F.sequence(F.lit(0), F.col("id") % 3)), "id")
    found = tasks.agg(rows_by_task(F.col("id")).alias("tasks")).first()["tasks"]
    assert task_counts(found) == {i: i % 3 + 1 for i in range(200_000)}


def test_orc(spark, numbers, tmp_path):
    result = export(spark, numbers, str(tmp_path / "out"), fmt="ORC")
    assert result.rows == 1000
    assert spark.read.orc(str(tmp_path / "out")).exceptAll(numbers).count() == 0


def test_table_by_name(spark, numbers, tmp_path):
    numbers.createOrReplaceTempView("numbers")
    try:
        assert export(spark, "numbers", str(tmp_path / "out"), where="id < 10").rows == 10
    finally:
        spark.catalog.dropTempView("numbers")


def test_formats_decode_back(spark):
    """What is written for a decimal or a date reads back as the same value."""
    df = spark.range(2000).select(
        (F.col("id") * 37 - 5000).cast("decimal(14,0)").alias("n"),
        F.date_add(F.lit("1960-01-01").cast("date"), (F.col("id") * 17).cast("int")).alias("d"),
    ).withColumn("n", (F.col("n") / 1000).cast("decimal(14,4)"))
    back = df.select(
        "*",
        decode_numeric(X.fmt_decimal(F.col("n"), 4), 14, 4).alias("n2"),
        decode_date(X.fmt_date(F.col("d"))).alias("d2"),
    )
    assert back.where("n <> n2 OR d <> d2 OR n2 IS NULL OR d2 IS NULL").count() == 0


def test_long_streams_are_several(spark, numbers, tmp_path, monkeypatch):
    """Two streams of 500 rows, where a task reads 250 at most: four, of two splits each."""
    from loadstone.sources import tables

    monkeypatch.setattr(tables, "TASK_ROWS", 250, raising=False)
    result = export(spark, numbers, str(tmp_path / "out"), partitions=2)
    assert (result.rows, result.streams) == (1000, 4) and set(result.by_stream.values()) == {250}
