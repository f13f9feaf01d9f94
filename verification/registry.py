"""Registry of queries, and the text renderings of tables they start from."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadstone.sources.delimited import DEFAULT_DELIMITER
from loadstone.storage import scratch_dir

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and the SQL that gives the same rows."""

    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text(name: str) -> Column:
    return F.col(name).cast("string")


def money(name: str) -> Column:
    return F.col(name).cast("decimal(12,2)").cast("string")


def day(name: str) -> Column:
    return F.col(name).cast("date").cast("string")


def second(name: str) -> Column:
    """A timestamp without zone to the second: yyyy-MM-dd HH:mm:ss."""
    return F.substring_index(F.col(name).cast("string"), ".", 1)






def _columns() -> dict[str, dict[str, Callable[[str], Column]]]:
    return {
        "customer": {
            "c_custkey": text,
            "c_name": text,
            "c_nationkey": text,
            "c_acctbal": money,
            "c_mktsegment": text,
        },
        "orders": {
            "o_orderkey": text,
            "o_custkey": text,
            "o_orderstatus": text,
            "o_totalprice": money,
            "o_orderdate": day,
            "o_orderpriority": text,
        },
        "lineitem": {
            "l_orderkey": text,
            "l_partkey": text,
            "l_suppkey": text,
            "l_linenumber": text,
            "l_quantity": money,
            "l_extendedprice": money,
            "l_discount": money,
            "l_tax": money,
            "l_returnflag": text,
            "l_linestatus": text,
            "l_shipdate": day,
        },
        "events": {
            "event_id": text,
            "ts": second,
            "user_id": text,
            "event_type": text,
            "value": money,
            "props": text,
        },
    }


_SQL = {
    text: "CAST({c} AS VARCHAR)",
    money: "CAST(CAST({c} AS DECIMAL(12,2)) AS VARCHAR)",
    day: "strftime({c}, '%Y-%m-%d')",
    second: "strftime({c}, '%Y-%m-%d %H:%M:%S')",
}


def text_columns(name: str) -> dict[str, Column]:
    return {c: render(c) for c, render in _columns()[name].items()}


def text_sql(name: str) -> dict[str, str]:
    return {c: _SQL[render].format(c=c) for c, render in _columns()[name].items()}


def lines(
    spark: SparkSession, sf_dir: str, name: str, delimiter: str = DEFAULT_DELIMITER, **changed
) -> DataFrame:
    """A table as delimited lines (``value``); ``changed`` columns get other text."""
    columns = {**text_columns(name), **changed}
    return table(spark, sf_dir, name).select(
        F.concat_ws(delimiter, *columns.values()).alias("value")
    )


def lines_sql(name: str, delimiter: str = DEFAULT_DELIMITER) -> str:
    return f"concat_ws('{delimiter}', {', '.join(text_sql(name).values())})"


def text_file(spark: SparkSession, df: DataFrame, label: str) -> str:
    """Write lines as text files in the scratch folder; returns their path."""
    path = scratch_dir(spark, label)
    df.write.text(path)
    return path


def scratch_database(spark: SparkSession) -> str:
    name = f"loadstone_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_dir(spark, 'db')}'")
    return name


def rows_by_part(stored: DataFrame, reported: dict[int, int]) -> DataFrame:
    """Reported rows, stored rows (each with its ``part``), and parts in which these differ."""
    spark = stored.sparkSession
    told = spark.createDataFrame([(int(p), int(n)) for p, n in reported.items()], "part int, reported bigint")
    found = stored.groupBy("part").agg(F.count(F.lit(1)).alias("stored"))
    both = told.join(found, "part", "full")
    return both.agg(
        F.sum("reported").alias("reported"),
        F.sum("stored").alias("stored"),
        F.count_if(~F.col("reported").eqNullSafe(F.col("stored"))).alias("differing"),
    )


LINEITEM_SPEC = (
    "l_orderkey:INT64,l_partkey:INT64,l_suppkey:INT64,l_linenumber:INT64,"
    "l_quantity:NUMERIC:12.2,l_extendedprice:NUMERIC:12.2,l_discount:FLOAT64,"
    "l_tax:NUMERIC:4.2,l_returnflag:STRING:1,l_linestatus,l_shipdate:DATE"
)
ORDERS_SPEC = (
    "o_orderkey:INT64,o_custkey:INT64,o_orderstatus,o_totalprice:NUMERIC:12.2,"
    "o_orderdate:DATE,o_orderpriority:STRING:15"
)

# Typed columns of the base tables, as the specifications above decode them.
LINEITEM_SQL = """l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
  CAST(l_quantity AS DECIMAL(12,2)) AS l_quantity,
  CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice,
  CAST(CAST(CAST(l_discount AS DECIMAL(12,2)) AS VARCHAR) AS DOUBLE) AS l_discount,
  CAST(l_tax AS DECIMAL(4,2)) AS l_tax,
  l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS l_shipdate"""
ORDERS_SQL = """o_orderkey, o_custkey, o_orderstatus,
  CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority"""
