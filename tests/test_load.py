import json
from datetime import date
from decimal import Decimal
from pathlib import Path
from random import Random

import pyarrow.orc as po
import pytest
from pyspark.sql import functions as F

from loadstone import LoadError, SchemaError, load, parse_spec
from loadstone.operators import quality as Q
from loadstone.operators.schema import column_comment
from loadstone.sinks import orc, tables
from loadstone.sinks.tables import DestinationError, resolve_table
from loadstone.storage import part_files

SPEC = "id:INT64,qty:NUMERIC:5.2,day:DATE,note:STRING:5"
GOOD = ["1þ1.50þ2020-01-01þfirst", "2þþ2020-01-02", "3þ.5þþlonger text"]
BAD = ["xþ1þ2020-01-01", "4þ1þ2021-02-31", "5þ1e3þ2021-02-31"]


@pytest.fixture
def database(spark, tmp_path):
    spark.sql(f"CREATE DATABASE load_test LOCATION '{tmp_path}/db'")
    yield "load_test"
    spark.sql("DROP DATABASE load_test CASCADE")


@pytest.fixture
def source(file_of):
    return file_of("source.txt", GOOD)


@pytest.fixture
def mixed(file_of):
    return file_of("mixed.txt", GOOD + BAD)


def own_tables(spark, database):
    listed = spark.sql(f"SHOW TABLES IN {database}").collect()
    return [r["tableName"] for r in listed if not r["isTemporary"]]


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_staging(spark, source, tmp_path):
    path = str(tmp_path / "out")
    result = load(spark, source, path=path, schema=SPEC)
    assert (result.rows_read, result.rows_written, result.bad) == (3, 3, 0)
    rows = sorted(spark.read.orc(path).collect())
    assert [tuple(r) for r in rows] == [
        (1, Decimal("1.50"), date(2020, 1, 1), "first"),
        (2, None, date(2020, 1, 2), None),
        (3, Decimal("0.50"), None, "longe"),
    ]
    assert not [p for p in Path(path).iterdir() if "probe" in p.name]


def test_orc_options(spark, source, tmp_path):
    load(spark, source, path=str(tmp_path / "out"), schema=SPEC)
    file = po.ORCFile(str(next((tmp_path / "out").glob("part-*.orc"))))
    assert (file.compression, file.compression_size) == ("ZLIB", 32 * 1024)


def test_empty_source(spark, tmp_path):
    (tmp_path / "empty.txt").write_text("")
    result = load(spark, str(tmp_path / "empty.txt"), path=str(tmp_path / "out"), schema=SPEC)
    assert (result.rows_read, result.rows_written, result.bad) == (0, 0, 0)


def test_first_bad_value_fails(spark, mixed, tmp_path):
    message = r"undecodable column 0 id INT64 value='x' line: xþ1þ2020-01-01|column 2 day"
    with pytest.raises(LoadError, match=message):
        load(spark, mixed, path=str(tmp_path / "out"), schema=SPEC)
    assert not list((tmp_path / "out").glob("part-*"))


def test_limit_counts_the_whole_job(spark, mixed, tmp_path, database):
    options = {"schema": SPEC, "mode": "replace", "partitions": 3}
    table, path = f"{database}.t", str(tmp_path / "out")
    with pytest.raises(LoadError, match="3 rows are bad; the load allows fewer than 3"):
        load(spark, mixed, table, path=path, error_limit=3, **options)
    assert not spark.catalog.tableExists(table)
    result = load(spark, mixed, table, path=path, error_limit=4, **options)
    assert (result.rows_read, result.rows_written, result.bad) == (6, 3, 3)
    assert ids(spark.table(table)) == [1, 2, 3]


def test_limit_of_a_direct_load(spark, mixed, database):
    table = f"{database}.t"
    with pytest.raises(LoadError):
        load(spark, mixed, table, schema=SPEC, error_limit=2)
    assert not spark.catalog.tableExists(table)
    assert load(spark, mixed, table, schema=SPEC, error_limit=4).bad == 3
    assert ids(spark.table(table)) == [1, 2, 3]


@pytest.mark.parametrize("limit,kept", [(3, False), (4, True)])
def test_quarantine(spark, mixed, tmp_path, limit, kept):
    quarantine = str(tmp_path / "bad")
    try:
        load(spark, mixed, path=str(tmp_path / "out"), schema=SPEC, error_limit=limit, quarantine=quarantine)
        assert kept
    except LoadError:
        assert not kept
    rows = sorted(spark.read.json(quarantine).collect(), key=lambda r: r["line"])
    assert [(r["col_idx"], r["col_name"], r["type"], r["len"], r["value"]) for r in rows] == [
        (2, "day", "DATE(format=yyyy-MM-dd)", 10, "2021-02-31"),
        (1, "qty", "NUMERIC(precision=5, scale=2)", 3, "1e3"),
        (0, "id", "INT64", 1, "x"),
    ]
    assert [r["line"] for r in rows] == sorted(BAD)


@pytest.mark.parametrize("bad,limit,stops", [(0, 0, False), (1, 0, True), (1, 1, True), (1, 2, False), (2, 2, True)])
def test_limit_rule(bad, limit, stops):
    assert Q.reaches_limit(bad, limit) is stops


def test_only_strings_are_never_bad(text):
    fields = parse_spec("a,b:STRING:1")
    assert Q.bad_rows(text("1þ2", ""), fields).count() == 0
    assert Q.good_rows(text("1þ2", ""), fields).count() == 2
    assert Q.strict_rows(text("1þ2", ""), fields).count() == 2


def test_modes_of_a_table(spark, source, database):
    table = f"{database}.t"
    load(spark, source, table, schema=SPEC)
    with pytest.raises(DestinationError):
        load(spark, source, table, schema=SPEC)
    load(spark, source, table, schema=SPEC, mode="append")
    assert ids(spark.table(table)) == [1, 1, 2, 2, 3, 3]
    load(spark, source, table, schema=SPEC, mode="replace")
    assert ids(spark.table(table)) == [1, 2, 3]
    with pytest.raises(ValueError):
        load(spark, source, table, schema=SPEC, mode="overwrite")


def test_append_matches_columns_by_name(spark, text, database):
    spark.sql(f"CREATE TABLE {database}.t (b BIGINT, a STRING) USING parquet")
    load(spark, text("xþ1"), f"{database}.t", autodetect=True, template=f"{database}.t2", schema="a,b", mode="append")
    assert [tuple(r) for r in spark.table(f"{database}.t").collect()] == [(1, "x")]
    with pytest.raises(DestinationError, match="do not match"):
        load(spark, text("xþ1"), f"{database}.t", autodetect=True, template=f"{database}.t2", schema="a,c", mode="append")


def test_mode_flags():
    assert [tables.save_mode(r, a) for r, a in [(0, 0), (1, 0), (0, 1), (1, 1)]] == [
        "error",
        "replace",
        "append",
        "append",
    ]


def test_staging_guard(spark, source, tmp_path):
    path = tmp_path / "out"
    load(spark, source, path=str(path), schema=SPEC)
    for mode in ("error", "append"):
        with pytest.raises(DestinationError, match="already"):
            load(spark, source, path=str(path), schema=SPEC, mode=mode)
    (path / "below").mkdir()
    (path / "below" / "kept.txt").write_text("x")
    (path / "old.orc").write_text("x")
    load(spark, source, path=str(path), schema=SPEC, mode="replace")
    assert (path / "below" / "kept.txt").exists() and not (path / "old.orc").exists()
    assert ids(spark.read.orc(str(path))) == [1, 2, 3]


def test_external_table(spark, source, mixed, tmp_path, database):
    table, path = f"{database}.t", str(tmp_path / "it's")
    load(spark, source, table, path=path, external=True, schema=SPEC)
    assert ids(spark.table(table)) == [1, 2, 3]
    assert tables.is_external(spark, resolve_table(table))
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    assert int(properties["expires_at"]) > 1_700_000_000_000
    load(spark, source, table, path=path, external=True, schema=SPEC, mode="append")
    assert ids(spark.table(table)) == [1, 1, 2, 2, 3, 3]
    # Appended parts show at once, so the limit is checked before they are written.
    with pytest.raises(LoadError):
        load(spark, mixed, table, path=path, external=True, schema=SPEC, mode="append", error_limit=2)
    assert len(ids(spark.table(table))) == 6
    load(spark, source, table, path=path, external=True, schema=SPEC, mode="replace", lifetime_ms=0)
    assert ids(spark.table(table)) == [1, 2, 3]
    assert "expires_at" not in spark.sql(f"SHOW TBLPROPERTIES {table}").toPandas()["key"].tolist()


@pytest.mark.parametrize("staged", [False, True])
def test_failed_replace_keeps_the_table(spark, source, mixed, database, tmp_path, staged):
    table, path = f"{database}.kept", str(tmp_path / "staged") if staged else None
    load(spark, source, table, path=path, schema=SPEC)
    for limit in (0, 2):
        with pytest.raises(LoadError):
            load(spark, mixed, table, path=path, schema=SPEC, mode="replace", error_limit=limit)
        assert ids(spark.table(table)) == [1, 2, 3]
        assert own_tables(spark, database) == ["kept"]
        if staged:
            assert ids(spark.read.orc(path)) == [1, 2, 3]


def test_failed_replace_keeps_an_external_table(spark, source, mixed, database, tmp_path):
    table, options = f"{database}.ext", {"path": str(tmp_path / "ext"), "external": True, "schema": SPEC}
    load(spark, source, table, **options)
    for limit in (0, 2):
        with pytest.raises(LoadError):
            load(spark, mixed, table, mode="replace", error_limit=limit, **options)
        assert ids(spark.table(table)) == [1, 2, 3]


def test_failed_load_leaves_no_parts(spark, mixed, tmp_path):
    path = tmp_path / "none"
    with pytest.raises(LoadError):
        load(spark, mixed, path=str(path), schema=SPEC, error_limit=2)
    assert not list(path.glob("part-*"))


def test_lost_text_is_counted(spark, text, tmp_path):
    result = load(spark, text("abcþ1", "aþ2þmore", "aþ3þþ", "abþ4"), path=str(tmp_path / "p"), schema="s:STRING:2,n:INT64")
    assert (result.rows_written, result.surplus, result.cut) == (4, 1, 1)


def test_nothing_to_quarantine(spark, source, tmp_path):
    with pytest.raises(ValueError):
        load(spark, source, path=str(tmp_path / "p"), schema=SPEC, quarantine=str(tmp_path / "q"))


def test_narrow_columns(spark, text, database):
    table = f"{database}.narrow"
    spark.sql(f"CREATE TABLE {table} (i INT, s SMALLINT, t TINYINT, f FLOAT, d DECIMAL(38,9), w DECIMAL(10,0)) USING orc")
    rows = text("1þ2þ3þ1.5þ1.123456789þ2.7", "2147483648þ2þ3þ1þ1þ1", "1þ2þ128þ1þ1þ1", "1þ2þ3þ1e39þ1þ1", "1þ2þ3þInfinityþ1þ1")
    result = load(spark, rows, table, mode="append", error_limit=10)
    assert result.bad == 3
    stored = sorted(tuple(map(str, r)) for r in spark.table(table).collect())
    assert stored == [("1", "2", "3", "1.5", "1.123456789", "2"), ("1", "2", "3", "inf", "1.000000000", "1")]


def test_inference_cuts_nothing(spark, text, tmp_path):
    rows = ["ab|1.25"] * 30 + ["  longer than the sample|1.25999"] * 5
    options = {"delimiter": "|", "autodetect": True}
    load(spark, text(*rows), path=str(tmp_path / "all"), **options)
    stored = spark.read.orc(str(tmp_path / "all")).toDF("s", "n")
    assert sorted({(r["s"], float(r["n"])) for r in stored.collect()}) == [("  longer than the sample", 1.25999), ("ab", 1.25)]
    # A sample may be wrong about the rest; what it would cut is bad instead.
    result = load(spark, text(*rows), path=str(tmp_path / "some"), sample_rows=10, error_limit=100, **options)
    assert result.bad == 5


def test_external_table_elsewhere(spark, source, tmp_path, database):
    options = {"external": True, "schema": SPEC}
    load(spark, source, f"{database}.native", schema=SPEC)
    for mode in ("append", "replace"):
        with pytest.raises(DestinationError, match="is not external over"):
            load(spark, source, f"{database}.native", path=str(tmp_path / "a"), mode=mode, **options)
    load(spark, source, f"{database}.t", path=str(tmp_path / "b"), **options)
    with pytest.raises(DestinationError, match="is not external over"):
        load(spark, source, f"{database}.t", path=str(tmp_path / "c"), mode="append", **options)
    load(spark, source, f"{database}.t", path=str(tmp_path / "c"), mode="replace", **options)
    assert ids(spark.table(f"{database}.t")) == [1, 2, 3]


def test_sample_follows_the_order_of_sources(spark, file_of, tmp_path):
    """The first source counts, not the largest."""
    small, large = file_of("small.txt", ["1", "2"]), file_of("large.txt", ["x"] * 1000)
    options = {"autodetect": True, "error_limit": 2000}
    fields = load(spark, [small, large], path=str(tmp_path / "a"), sample_rows=2, **options).fields
    assert fields[0].kind == "INT64"
    fields = load(spark, [small, large], path=str(tmp_path / "b"), sample_rows=3, **options).fields
    assert fields[0].kind == "STRING"
    fields = load(spark, f"{large},{small}", path=str(tmp_path / "c"), sample_rows=2, **options).fields
    assert fields[0].kind == "STRING"


def test_destination_is_the_template(spark, text, database):
    table = f"{database}.t"
    spark.sql(f"CREATE TABLE {table} (ID BIGINT, d DATE COMMENT 'MM/dd/yyyy') USING orc")
    load(spark, text("7þ03/05/2012"), table, schema="other", mode="append")
    assert [tuple(r) for r in spark.table(table).collect()] == [(7, date(2012, 3, 5))]
    with pytest.raises(SchemaError, match="no table none"):
        load(spark, text("7"), f"{database}.u", template="none", database=database)


def test_comments_reach_the_table(spark, text, database, tmp_path):
    spark.sql(f"CREATE TABLE {database}.tpl (ID BIGINT COMMENT 'key', d DATE COMMENT 'MM/dd/yyyy') USING orc")
    options = {"autodetect": True, "template": "tpl", "database": database}
    load(spark, text("7þ2012-03-05"), "direct", **options)
    load(spark, text("7þ2012-03-05"), "staged", path=str(tmp_path / "out"), **options)
    for name in ("direct", "staged"):
        fields = spark.table(f"{database}.{name}").schema.fields
        assert [(f.name, column_comment(f)) for f in fields] == [("ID", "key"), ("d", "MM/dd/yyyy")]


@pytest.mark.parametrize(
    "spec,database,catalog,expected",
    [
        ("t", None, None, "`t`"),
        ("t", "d", None, "`d`.`t`"),
        ("t", "d", "c", "`c`.`d`.`t`"),
        ("t", "p:d", None, "`p`.`d`.`t`"),
        ("d.t", None, "c", "`c`.`d`.`t`"),
        ("p:d.t", "x", "c", "`p`.`d`.`t`"),
        ("c.d.t", None, None, "`c`.`d`.`t`"),
    ],
)
def test_table_names(spec, database, catalog, expected):
    assert str(resolve_table(spec, database, catalog)) == expected


@pytest.mark.parametrize("spec", ["p:t", ":d.t", "", "a.b.c.d", "a..b"])
def test_bad_table_names(spec):
    with pytest.raises(ValueError):
        resolve_table(spec)


def test_part_size(spark, file_of, tmp_path):
    random = Random(7)
    source = file_of("many.txt", [f"{random.getrandbits(60)}þ{i % 100}.25þ2020-01-01" for i in range(40000)])
    path = str(tmp_path / "out")
    load(spark, source, path=path, schema=SPEC, part_mb=0.05)
    sizes = [r["bytes"] for r in part_files(spark, path).collect()]
    assert len(sizes) > 2 and max(sizes) <= 0.05 * 2**20 * 1.3
    assert spark.read.orc(path).count() == 40000


@pytest.mark.parametrize("partitions", [1, 2, 9])
def test_writers(spark, tmp_path, file_of, partitions):
    names = [file_of(f"{n}.txt", [f"{n}{i}" for i in range(50)]) for n in range(3)]
    load(spark, names, path=str(tmp_path / "out"), schema="id:INT64", partitions=partitions)
    parts = [p.name[:10] for p in (tmp_path / "out").glob("part-*.orc")]
    assert len(set(parts)) == partitions
    assert spark.read.orc(str(tmp_path / "out")).count() == 150


def test_writers_follow_the_part_size(spark):
    cores = spark.sparkContext.defaultParallelism
    assert orc.writers_for(spark, 100, 0.5) == cores
    assert orc.writers_for(spark, 100 * 2**40, 0.2) == int(100 * 2**40 * 0.2 / 2**27) + 1
    assert orc.rows_per_part(100.0, 128) == 128 * 2**20 // 100
    with pytest.raises(ValueError):
        orc.with_writers(spark.range(1), 0)


def test_arguments(spark, source):
    with pytest.raises(ValueError):
        load(spark, source, schema=SPEC)
    with pytest.raises(ValueError):
        load(spark, source, "t", external=True, schema=SPEC)


def test_bad_rows_under_skew(spark):
    """A third of all rows bad with one and the same text."""
    lines = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit("x")).otherwise(F.col("id").cast("string")).alias("value")
    )
    fields = parse_spec("id:INT64")
    assert Q.count_rows(lines, fields).first().asDict() == {"rows": 30000, "bad": 10000}
    assert Q.bad_rows(lines, fields).count() == 10000
    assert Q.good_rows(lines, fields).count() == 20000
    assert json.loads(Q.bad_rows(lines, fields).toJSON().first())["value"] == "x"
