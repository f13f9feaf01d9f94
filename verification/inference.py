"""Text tests, column-wide aggregates and schema inference."""

from functools import reduce

from pyspark.sql import functions as F

from loadstone.functions import predicates as P
from loadstone.operators import inference as I
from loadstone.operators.schema import autodetect_names, schema_report
from loadstone.sources.delimited import LINE, split_fields
from loadstone.storage import scratch_dir
from verification.registry import (
    day,
    lines,
    money,
    query,
    second,
    table,
    text,
    text_columns,
    text_file,
    text_sql,
)

# Forms a number takes, and forms that only look like one.
_NUMBER_SQL = {
    "amount": "CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)",
    "negative": "'-' || CAST(CAST(value AS DECIMAL(12,2)) AS VARCHAR)",
    "id": "CAST(event_id AS VARCHAR)",
    "long_id": "'1234567890123' || event_id",
    "range": "user_id || '-' || event_id",
    "version": "user_id || '.' || event_id || '.1'",
    "dotted": "event_id || '.'",
    "day": "strftime(ts, '%Y-%m-%d')",
    "word": "event_type",
    "empty": "regexp_replace(event_type, '.', '', 'g')",
    "minus": "regexp_replace(event_type, '^.*$', '-')",
}


def _number_forms():
    return {
        "amount": money("value"),
        "negative": F.concat(F.lit("-"), money("value")),
        "id": text("event_id"),
        "long_id": F.concat(F.lit("1234567890123"), text("event_id")),
        "range": F.concat_ws("-", text("user_id"), text("event_id")),
        "version": F.concat_ws(".", text("user_id"), text("event_id"), F.lit("1")),
        "dotted": F.concat(text("event_id"), F.lit(".")),
        "day": F.substring(second("ts"), 1, 10),
        "word": F.col("event_type"),
        "empty": F.regexp_replace("event_type", ".", ""),
        "minus": F.regexp_replace("event_type", "^.*$", "-"),
    }


def _test_numbers(test):
    def run(spark, sf_dir):
        forms = [test(x).alias(name) for name, x in _number_forms().items()]
        return table(spark, sf_dir, "events").select("event_id", *forms)

    return run


def _numbers_sql(condition):
    forms = ", ".join(
        f"({condition.format(x=f'({sql})')}) AS {name}" for name, sql in _NUMBER_SQL.items()
    )
    return f"SELECT event_id, {forms} FROM events"


_COUNT = "length({x}) - length(replace({x}, '%s', '')) <= 1"
query(
    "is_numeric",
    _numbers_sql(
        "regexp_full_match({x}, '[0-9.-]+') AND " + _COUNT % "." + " AND " + _COUNT % "-"
    ),
)(_test_numbers(P.is_numeric))
query(
    "is_int", _numbers_sql("{x} <> '' AND regexp_full_match({x}, '-?[0-9]{{0,18}}')")
)(_test_numbers(P.is_int))
query(
    "is_decimal",
    _numbers_sql(
        "regexp_full_match({x}, '[0-9.-]+') AND ({x} LIKE '-%' OR {x} NOT LIKE '%-%') AND "
        + _COUNT % "."
        + " AND length(regexp_replace({x}, '[^0-9]', '', 'g')) <= 36"
    ),
)(_test_numbers(P.is_decimal))


@query(
    "is_timestamp_kind",
    """SELECT event_id, event_type = 'click' AS local,
      event_type IN ('error', 'signup') AS zoned, event_type = 'view' AS zoned_space,
      event_type IN ('error', 'signup') AS offset_kind FROM events""",
)
def is_timestamp_kind(spark, sf_dir):
    at = second("ts")
    x = (
        F.when(F.col("event_type") == "click", at)
        .when(F.col("event_type") == "error", F.concat(at, F.lit("+00:00")))
        .when(F.col("event_type") == "signup", F.concat(at, F.lit("Z")))
        .when(F.col("event_type") == "view", F.concat(at, F.lit(" UTC-07:00")))
        .otherwise(F.concat(F.substring(at, 1, 16), F.lit(":77")))
    )
    names = {"local": "local", "zoned": "zoned", "zoned_space": "zoned_space", "offset": "offset_kind"}
    return table(spark, sf_dir, "events").select(
        "event_id", *[P.is_timestamp_kind(x, kind).alias(name) for kind, name in names.items()]
    )


@query(
    "match_date_format",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'yyyy-MM-dd'
      WHEN '2-HIGH' THEN 'yyyyMMdd' WHEN '3-MEDIUM' THEN 'yyyy/MM/dd'
      WHEN '4-NOT SPECIFIED' THEN 'MM/dd/yyyy' END AS fmt FROM orders""",
)
def match_date_format(spark, sf_dir):
    p = F.split(day("o_orderdate"), "-")
    x = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat_ws("-", p[0], p[1], p[2]))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(p[0], p[1], p[2]))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat_ws("/", p[0], p[1], p[2]))
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.concat_ws("/", p[1], p[2], p[0]))
        .otherwise(F.concat_ws("/", F.lit("31"), p[1], p[0]))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", P.match_date_format(x).alias("fmt"))


def _per_column(spark, sf_dir, name, aggregate, alias):
    """One row per text column: (name, <alias>), from a single aggregation."""
    columns = text_columns(name)
    row = table(spark, sf_dir, name).agg(*[aggregate(x).alias(c) for c, x in columns.items()])
    return row.unpivot([], list(columns), "name", alias)


def _per_column_sql(name, aggregate, alias):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS name, {aggregate.format(x=sql)} AS {alias} FROM {name}"
        for c, sql in text_sql(name).items()
    )


@query(
    "agg_all_match",
    _per_column_sql("lineitem", "bool_and(regexp_full_match({x}, '-?[0-9]{{0,18}}'))", "ints"),
)
def agg_all_match(spark, sf_dir):
    return _per_column(spark, sf_dir, "lineitem", lambda x: I.all_match(P.is_int(x)), "ints")


@query("agg_max_length", _per_column_sql("lineitem", "CAST(max(length({x})) AS INTEGER)", "longest"))
def agg_max_length(spark, sf_dir):
    padded = lambda x: I.max_length(F.concat(F.lit("  "), x, F.lit("\t")))
    return _per_column(spark, sf_dir, "lineitem", padded, "longest")


@query(
    "agg_scale",
    """WITH t AS (SELECT CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) AS q,
        CAST(l_extendedprice AS VARCHAR) AS p, l_shipdate AS d FROM lineitem)
    SELECT 'whole' AS name, CAST(NULL AS BIGINT) AS scale UNION ALL
    SELECT 'money', CASE WHEN min(length(q) - strpos(q, '.')) = max(length(q) - strpos(q, '.'))
      THEN min(length(q) - strpos(q, '.')) END FROM t UNION ALL
    SELECT 'mixed', CASE WHEN min(length(q) - strpos(q, '.')) = max(length(q) - strpos(q, '.'))
      AND false THEN 0 END FROM t UNION ALL
    SELECT 'trailing', CASE WHEN min(length(split_part(q, '.', 1))) = max(length(split_part(q, '.', 1)))
      THEN min(length(split_part(q, '.', 1))) END FROM t""",
)
def agg_scale(spark, sf_dir):
    """No point, one scale, two scales, and a trailing point."""
    whole = F.split(money("l_quantity"), r"\.")[0]
    columns = {
        "whole": whole,
        "money": money("l_quantity"),
        "mixed": F.when(F.col("l_linenumber") == 1, F.concat(money("l_quantity"), F.lit("0"))).otherwise(
            money("l_quantity")
        ),
        "trailing": F.concat(whole, F.lit(".")),
    }
    row = table(spark, sf_dir, "lineitem").agg(
        *[I.common_scale(x).cast("bigint").alias(c) for c, x in columns.items()]
    )
    return row.unpivot([], list(columns), "name", "scale")


@query(
    "agg_date_format",
    """SELECT 'dashes' AS name, CASE WHEN count(*) > 0 THEN 'yyyy-MM-dd' END AS fmt FROM orders
    UNION ALL SELECT 'slashes', CASE WHEN count(*) > 0 THEN 'MM/dd/yyyy' END FROM orders
    UNION ALL SELECT 'digits', CASE WHEN count(*) > 0 THEN 'yyyyMMdd' END FROM orders
    UNION ALL SELECT 'mixed', NULL""",
)
def agg_date_format(spark, sf_dir):
    plain = day("o_orderdate")
    p = F.split(plain, "-")
    slashes = F.concat_ws("/", p[1], p[2], p[0])
    columns = {
        "dashes": plain,
        "slashes": slashes,
        "digits": F.concat(p[0], p[1], p[2]),
        "mixed": F.when(F.col("o_orderstatus") == "F", plain).otherwise(slashes),
    }
    row = table(spark, sf_dir, "orders").agg(
        *[I.common_date_format(x).alias(c) for c, x in columns.items()]
    )
    return row.unpivot([], list(columns), "name", "fmt")


# The sources inference runs on, and what their columns infer to; lengths come
# from the data.
_EVENTS = {
    "event_id": "INT64",
    "ts": "TIMESTAMP_LOCAL",
    "user_id": "INT64",
    "event_type": "STRING",
    "value": "NUMERIC",
    "props": "STRING",
}
_SOURCES = {
    "lineitem": (
        "lineitem",
        dict.fromkeys(["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"], "INT64")
        | dict.fromkeys(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "NUMERIC")
        | {"l_returnflag": "STRING", "l_linestatus": "STRING", "l_shipdate": "DATE"},
    ),
    "orders": (
        "orders",
        {
            "o_orderkey": "INT64",
            "o_custkey": "INT64",
            "o_orderstatus": "STRING",
            "o_totalprice": "NUMERIC",
            "o_orderdate": "DATE",
            "o_orderpriority": "STRING",
        },
    ),
    "events": ("events", _EVENTS),
    "events_offset": ("events", _EVENTS | {"ts": "TIMESTAMP_ZONED"}),
    "customer": (
        "customer",
        {
            "c_custkey": "INT64",
            "c_name": "STRING",
            "c_nationkey": "INT64",
            "c_acctbal": "NUMERIC",
            "c_mktsegment": "STRING",
        },
    ),
}

_FORMATS = {
    "DATE": ("yyyy-MM-dd", None),
    "TIMESTAMP_LOCAL": ("yyyy-MM-dd HH:mm:ss", "America/Los_Angeles"),
    "TIMESTAMP_ZONED": ("yyyy-MM-dd HH:mm:ssz", None),
}


def _inferred_sql(source, i, column, name=None):
    table_name, kinds = _SOURCES[source]
    kind, sql = kinds[column], text_sql(table_name)[column]
    length = f"CAST(max(length({sql})) AS INTEGER)"
    fmt, zone = _FORMATS.get(kind, (None, None))
    quote = lambda v: f"'{v}'" if v else "CAST(NULL AS VARCHAR)"
    null = "CAST(NULL AS INTEGER)"
    return f"""SELECT {i} AS idx, '{name or column}' AS name, '{kind}' AS type,
      {length if kind == 'STRING' else null} AS length,
      {length if kind == 'NUMERIC' else null} AS precision,
      {'2' if kind == 'NUMERIC' else null} AS scale,
      {quote(fmt)} AS format, {quote(zone)} AS zone, '{source}' AS source FROM {table_name} HAVING count(*) > 0"""


@query(
    "infer_schema",
    " UNION ALL ".join(
        _inferred_sql(source, i, column)
        for source, (_, kinds) in _SOURCES.items()
        for i, column in enumerate(kinds)
    ),
)
def infer_schema(spark, sf_dir):
    """Inference over every row of five sources."""
    reports = []
    for source, (name, kinds) in _SOURCES.items():
        changed = {}
        if source == "events_offset":
            changed["ts"] = F.concat(second("ts"), F.lit("+00:00"))
        fields = I.infer_fields(lines(spark, sf_dir, name, **changed), list(kinds))
        reports.append(schema_report(spark, fields).withColumn("source", F.lit(source)))
    return reduce(lambda a, b: a.unionByName(b), reports)


@query(
    "schema_report",
    " UNION ALL ".join(
        _inferred_sql("customer", i, column, "abcde"[i])
        for i, column in enumerate(_SOURCES["customer"][1])
    ),
)
def report(spark, sf_dir):
    """The report of a schema with generated names."""
    source = lines(spark, sf_dir, "customer")
    fields = I.infer_fields(source, autodetect_names(source, "þ"))
    return schema_report(spark, fields).withColumn("source", F.lit("customer"))


@query(
    "autodetect_names",
    " UNION ALL ".join(
        f"SELECT '{'abcdefghijk'[i]}' AS name, count(nullif({sql}, '')) AS filled FROM lineitem"
        + (" WHERE l_linenumber > 1" if i >= 5 else "")
        for i, sql in enumerate(text_sql("lineitem").values())
    ),
)
def names(spark, sf_dir):
    """Generated names, with the number of values each column holds. The rows of a
    first line item are short, and the first line of the table is one of them."""
    columns = list(text_columns("lineitem").values())
    short, full = F.concat_ws("þ", *columns[:5]), F.concat_ws("þ", *columns)
    source = table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") == 1, short).otherwise(full).alias("value")
    )
    generated = autodetect_names(source, "þ")
    fields = split_fields(source, len(generated)).drop(LINE).toDF(*generated)
    row = fields.agg(*[F.count(F.nullif(F.col(c), F.lit(""))).alias(c) for c in generated])
    return row.unpivot([], generated, "name", "filled")


@query(
    "infer_continued",
    " UNION ALL ".join(
        f"SELECT * FROM ({_inferred_sql('lineitem', i, column, 'abcdefghijk'[i])}), (SELECT unnest(['once', 'in parts']) AS how)"
        for i, column in enumerate(_SOURCES["lineitem"][1])
    ),
)
def infer_continued(spark, sf_dir):
    """A schema with its width from one pass over files, and the same from stored statistics
    that were added to file by file."""
    source = spark.read.text(text_file(spark, lines(spark, sf_dir, "lineitem"), "lines"))
    folder, state = scratch_dir(spark, "growing"), scratch_dir(spark, "statistics")
    result = None
    for n in range(3):
        part = source.where(F.pmod(F.xxhash64("value"), F.lit(3)) == n)
        part.write.text(f"{folder}/{n}")
        stored = I.extend_statistics(spark, state, f"{folder}/*/part-*")
    found = {
        "once": I.infer_fields(spark.read.text(f"{folder}/*/part-*"), None),
        "in parts": I.decide_all(I.merged_statistics(stored)),
    }
    for how, fields in found.items():
        rows = schema_report(spark, fields).withColumn("source", F.lit("lineitem")).withColumn("how", F.lit(how))
        result = rows if result is None else result.unionByName(rows)
    return result
