"""Value formats, row assembly and the sinks of the export job."""

import math
from functools import reduce

from pyspark.sql import functions as F

from loadstone.functions import formats as X
from loadstone.operators.export import export_lines, unsupported_columns
from loadstone.plans.export import export
from loadstone.storage import scratch_dir
from verification.registry import TABLES, query, rows_by_part, table

_PLAIN = r"regexp_replace(regexp_replace(CAST({0} AS VARCHAR), '0+$', ''), '\.$', '')"
_QUOTED = (
    "CASE WHEN contains({0}, ',') OR contains({0}, chr(10)) THEN '\"' || "
    "replace(replace({0}, '\"', '\\\"'), chr(10), '\\n') || '\"' ELSE {0} END"
)


@query(
    "fmt_decimal",
    f"""SELECT l_orderkey, l_linenumber, {_PLAIN.format('CAST(l_quantity AS DECIMAL(12,2))')} AS quantity,
      {_PLAIN.format('CAST(-l_extendedprice AS DECIMAL(14,3))')} AS price,
      {_PLAIN.format('CAST(CAST(l_discount AS DECIMAL(12,2)) AS DECIMAL(38,18))')} AS discount,
      CAST(CAST(l_quantity * 10 AS DECIMAL(12,0)) AS VARCHAR) AS tens FROM lineitem""",
)
def fmt_decimal(spark, sf_dir):
    exact = F.col("l_discount").cast("decimal(12,2)").cast("decimal(38,18)")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        X.fmt_decimal(F.col("l_quantity").cast("decimal(12,2)"), 2).alias("quantity"),
        X.fmt_decimal((-F.col("l_extendedprice")).cast("decimal(14,3)"), 3).alias("price"),
        X.fmt_decimal(exact, 18).alias("discount"),
        X.fmt_decimal((F.col("l_quantity") * 10).cast("decimal(12,0)"), 0).alias("tens"),
    )


@query(
    "fmt_timestamp",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S UTC') AS wall,
      strftime(make_timestamp(-86400000000 + event_id * 3600000777), '%Y-%m-%d %H:%M:%S UTC') AS instant
    FROM events""",
)
def fmt_timestamp(spark, sf_dir):
    """Timestamps without zone, and instants from before 1970 on, fractions dropped."""
    instant = F.timestamp_micros(F.col("event_id") * 3600000777 - 86400000000)
    return table(spark, sf_dir, "events").select(
        "event_id",
        X.fmt_timestamp(F.col("ts"), has_zone=False).alias("wall"),
        X.fmt_timestamp(instant).alias("instant"),
    )


@query("fmt_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders")
def fmt_date(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", X.fmt_date(F.col("o_orderdate").cast("date")).alias("day")
    )


@query(
    "fmt_string",
    f"""SELECT 'documents' AS source, doc_id AS id, {_QUOTED.format('text')} AS text FROM documents
    UNION ALL SELECT 'pages', page_id, {_QUOTED.format('html')} FROM pages
    UNION ALL SELECT 'events', event_id, {_QUOTED.format('props')} FROM events""",
)
def fmt_string(spark, sf_dir):
    """Commas, newlines and quotes; and quotes alone, which stay as they are."""
    parts = [("documents", "doc_id", "text"), ("pages", "page_id", "html"), ("events", "event_id", "props")]
    frames = [
        table(spark, sf_dir, name).select(
            F.lit(name).alias("source"),
            F.col(key).alias("id"),
            X.fmt_string(F.col(value)).alias("text"),
        )
        for name, key, value in parts
    ]
    return reduce(lambda a, b: a.unionByName(b), frames)


@query(
    "fmt_scalar",
    """SELECT l_orderkey, CAST(l_partkey AS VARCHAR) AS big, CAST(l_linenumber AS VARCHAR) AS small,
      CAST(l_quantity AS VARCHAR) AS wide, CAST(CAST(l_quantity AS FLOAT) AS VARCHAR) AS narrow,
      CASE WHEN l_quantity > 25 THEN 'true' ELSE 'false' END AS flag,
      CASE WHEN l_quantity < 10 THEN CAST(l_quantity * 1000000 AS BIGINT) || '.0'
        ELSE CAST(l_quantity / 10 AS DECIMAL(12,1)) || 'E7' END AS exponent
    FROM lineitem""",
)
def fmt_scalar(spark, sf_dir):
    """Large floating point values take Java's exponent form."""
    quantity = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        X.fmt_scalar(F.col("l_partkey")).alias("big"),
        X.fmt_scalar(F.col("l_linenumber")).alias("small"),
        X.fmt_scalar(quantity).alias("wide"),
        X.fmt_scalar(quantity.cast("float")).alias("narrow"),
        X.fmt_scalar(quantity > 25).alias("flag"),
        X.fmt_scalar(quantity * 1e6).alias("exponent"),
    )


@query(
    "fmt_null",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END AS status,
      CASE WHEN o_orderstatus = 'O' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS cust,
      o_orderpriority AS required FROM orders""",
)
def fmt_null(spark, sf_dir):
    status = F.col("o_orderstatus")
    cust = F.when(status != "O", F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        X.fmt_null(X.fmt_string(F.nullif(status, F.lit("F"))), "status").alias("status"),
        X.fmt_null(X.fmt_scalar(cust), "cust").alias("cust"),
        X.fmt_null(X.fmt_string(F.col("o_orderpriority")), "priority", required=True).alias("required"),
    )


@query(
    "export_type_check",
    " UNION ALL ".join(
        f"SELECT '{name}' AS name, "
        + ("'embedding'" if name == "embeddings" else "''")
        + f" AS rejected, count(*) AS rows FROM {name}"
        for name in TABLES
    ),
)
def export_type_check(spark, sf_dir):
    """Every table: the columns that stop its export, and the rows it would export."""
    frames = []
    for name in TABLES:
        source = table(spark, sf_dir, name)
        rejected = [column for column, _ in unsupported_columns(source.schema)]
        rows = source if rejected else export_lines(source)
        frames.append(
            rows.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("name"), F.lit(",".join(rejected)).alias("rejected"), "rows"
            )
        )
    return reduce(lambda a, b: a.unionByName(b), frames)


_ORDER_LINE = (
    "concat_ws(',', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), "
    "CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END, "
    f"{_PLAIN.format('CAST(o_totalprice AS DECIMAL(12,2))')}, "
    "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S UTC'), o_orderpriority)"
)
_CHAT_LINE = f"concat_ws(',', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR), role, {_QUOTED.format('text')})"


def _orders(spark, sf_dir):
    """Orders with exact prices and some NULLs."""
    return table(spark, sf_dir, "orders").withColumns(
        {
            "o_orderstatus": F.nullif(F.col("o_orderstatus"), F.lit("P")),
            "o_totalprice": F.col("o_totalprice").cast("decimal(12,2)"),
        }
    )


@query(
    "export_rows",
    f"SELECT {_ORDER_LINE} AS line FROM orders UNION ALL SELECT {_CHAT_LINE} FROM conversations",
)
def export_rows(spark, sf_dir):
    chats = table(spark, sf_dir, "conversations")
    return export_lines(_orders(spark, sf_dir)).unionByName(export_lines(chats))


@query("export_csv_gz", f"SELECT {_CHAT_LINE} AS line FROM conversations UNION ALL SELECT {_ORDER_LINE} FROM orders")
def export_csv_gz(spark, sf_dir):
    paths = [scratch_dir(spark, "csv"), scratch_dir(spark, "csv")]
    export(spark, table(spark, sf_dir, "conversations"), paths[0])
    export(spark, _orders(spark, sf_dir), paths[1])
    return spark.read.text(paths).select(F.col("value").alias("line"))


def _read_sequence(spark, path):
    """Keys and values of SequenceFile parts as rows."""
    pairs = spark.sparkContext.sequenceFile(path)
    return spark.createDataFrame(pairs, "key string, value string", verifySchema=False)


@query("export_seqfile", f"SELECT '' AS key, {_ORDER_LINE} || chr(10) AS value FROM orders")
def export_seqfile(spark, sf_dir):
    path = scratch_dir(spark, "seq")
    export(spark, _orders(spark, sf_dir), path, fmt="SEQ")
    return _read_sequence(spark, path)


@query("export_parts", "SELECT count(*) AS rows, true AS within, true AS several FROM lineitem")
def export_parts(spark, sf_dir):
    """Parts that hold an eighth of the rows at most."""
    source, path = table(spark, sf_dir, "lineitem"), scratch_dir(spark, "parts")
    most = math.ceil(source.count() / 8)
    export(spark, source, path, rows_per_part=most)
    per_part = spark.read.text(path).groupBy(F.input_file_name().alias("part")).count()
    return per_part.agg(
        F.sum("count").alias("rows"),
        (F.max("count") <= most).alias("within"),
        (F.count(F.lit(1)) >= 8).alias("several"),
    )


@query(
    "export_format",
    f"""SELECT 'csv' AS fmt, {_ORDER_LINE} AS line FROM orders UNION ALL
    SELECT 'seq', {_ORDER_LINE} FROM orders UNION ALL SELECT 'orc', {_ORDER_LINE} FROM orders""",
)
def export_format(spark, sf_dir):
    """The same rows read back from each of the three formats."""
    source, frames = _orders(spark, sf_dir), []
    for fmt in ("csv", "seq", "orc"):
        path = scratch_dir(spark, fmt)
        export(spark, source, path, fmt=fmt)
        if fmt == "csv":
            rows = spark.read.text(path).select(F.col("value").alias("line"))
        elif fmt == "seq":
            rows = _read_sequence(spark, path).select(F.rtrim("value", F.lit("\n")).alias("line"))
        else:
            rows = export_lines(spark.read.orc(path))
        frames.append(rows.select(F.lit(fmt).alias("fmt"), "line"))
    return reduce(lambda a, b: a.unionByName(b), frames)


@query(
    "export_row_count",
    "SELECT count(*) AS reported, count(*) AS stored, true AS streams FROM lineitem",
)
def export_row_count(spark, sf_dir):
    """The rows an export reports, beside the lines found, and its stream count."""
    source, path = table(spark, sf_dir, "lineitem"), scratch_dir(spark, "counted")
    result = export(spark, source, path)
    return spark.read.text(path).agg(
        F.lit(result.rows).cast("bigint").alias("reported"),
        F.count(F.lit(1)).alias("stored"),
        F.lit(1 <= result.streams <= source.rdd.getNumPartitions()).alias("streams"),
    )


@query(
    "export_stream_counts",
    "SELECT count(*) AS reported, count(*) AS stored, CAST(0 AS BIGINT) AS differing FROM lineitem",
)
def export_stream_counts(spark, sf_dir):
    """The rows reported for each stream, beside the lines in the parts that carry its number."""
    path = scratch_dir(spark, "by-stream")
    result = export(spark, table(spark, sf_dir, "lineitem"), path, partitions=4, rows_per_part=5000)
    part = F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1).cast("int")
    return rows_by_part(spark.read.text(path).select(part.alias("part")), result.by_stream)
