"""Scans: lines, several sources, fields, samples, table scans, filters, streams."""

from pyspark.sql import functions as F

from loadstone.sources.delimited import (
    DEFAULT_SAMPLE_ROWS,
    LINE,
    sample_lines,
    scan_lines,
    split_fields,
)
from loadstone.sources.tables import (
    count_per_stream,
    export_filter,
    export_scan,
    export_streams,
)
from verification.registry import (
    lines,
    lines_sql,
    query,
    table,
    text_columns,
    text_file,
    text_sql,
)


@query(
    "scan_delimited",
    f"""SELECT CASE WHEN event_type = 'error' THEN '' ELSE {lines_sql('events')} END AS line
    FROM events""",
)
def scan_delimited(spark, sf_dir):
    """Lines with quotes in them, and blank lines, which are rows too."""
    full = F.concat_ws("þ", *text_columns("events").values())
    source = table(spark, sf_dir, "events").select(
        F.when(F.col("event_type") == "error", F.lit("")).otherwise(full).alias("value")
    )
    return scan_lines(spark, text_file(spark, source, "lines")).select(
        F.col("value").alias("line")
    )


@query(
    "scan_multi_source",
    f"""SELECT {lines_sql('orders')} AS line FROM orders
    UNION ALL SELECT {lines_sql('customer')} FROM customer
    UNION ALL SELECT {lines_sql('lineitem')} FROM lineitem""",
)
def scan_multi_source(spark, sf_dir):
    """Three sources as one input: two in a comma list, one as its own argument."""
    paths = [
        text_file(spark, lines(spark, sf_dir, name), name)
        for name in ("orders", "customer", "lineitem")
    ]
    return scan_lines(spark, [f"{paths[0]},{paths[1]}", paths[2]]).select(
        F.col("value").alias("line")
    )


_FIELDS = list(text_sql("lineitem").values())


@query(
    "split_fields",
    "SELECT "
    + ", ".join(
        f"{sql} AS f{i}" if i < 5 else f"CASE WHEN l_linenumber = 7 THEN '' ELSE {sql} END AS f{i}"
        for i, sql in enumerate(_FIELDS)
    )
    + " FROM lineitem",
)
def split(spark, sf_dir):
    """Short rows, surplus fields and trailing delimiters among the full rows."""
    columns = list(text_columns("lineitem").values())
    full, short = F.concat_ws("þ", *columns), F.concat_ws("þ", *columns[:5])
    number = F.col("l_linenumber")
    source = table(spark, sf_dir, "lineitem").select(
        F.when(number == 7, short)
        .when(number == 6, F.concat(full, F.lit("þsurplusþmore")))
        .when(number == 5, F.concat(full, F.lit("þþ")))
        .otherwise(full)
        .alias("value")
    )
    return split_fields(source, len(columns)).drop(LINE)


@query(
    "sample_rows",
    f"""SELECT least(count(*), {DEFAULT_SAMPLE_ROWS}) AS sampled,
    least(count(*), {DEFAULT_SAMPLE_ROWS}) AS found, count(*) AS loaded FROM events""",
)
def sample(spark, sf_dir):
    """A sample: its size, how many of it are source lines, and that the
    source still has all of its rows."""
    path = text_file(spark, lines(spark, sf_dir, "events"), "sample")
    source = scan_lines(spark, path)
    taken = sample_lines(source, DEFAULT_SAMPLE_ROWS).withColumn("hit", F.lit(1))
    joined = source.join(taken, "value", "left")
    return joined.agg(F.count("hit").alias("found"), F.count(F.lit(1)).alias("loaded")).select(
        F.lit(taken.count()).cast("bigint").alias("sampled"), "found", "loaded"
    )


@query("export_scan", "SELECT * FROM orders")
def scan_table(spark, sf_dir):
    return export_scan(spark, table(spark, sf_dir, "orders"))


_PREDICATE = "o_orderstatus = 'F' AND o_totalprice > 100000"


@query("export_filter", f"SELECT * FROM orders WHERE {_PREDICATE}")
def filter_table(spark, sf_dir):
    return export_filter(export_scan(spark, table(spark, sf_dir, "orders")), _PREDICATE)


@query(
    "export_partitions",
    """SELECT n AS streams, count(*) AS rows, true AS even
    FROM lineitem, (SELECT CAST(unnest([1, 3, 8]) AS BIGINT) AS n) GROUP BY n""",
)
def streams(spark, sf_dir):
    """Rows over 1, 3 and 8 streams, whatever the splits of the table, and whether
    the streams are even."""
    source, result = table(spark, sf_dir, "lineitem"), None
    for n in (1, 3, 8):
        counts = count_per_stream(export_streams(source, n)).agg(
            F.count(F.lit(1)).alias("streams"), F.sum("rows").alias("rows"),
            (F.max("rows") <= 1.1 * F.min("rows")).alias("even"),
        )
        result = counts if result is None else result.unionByName(counts)
    return result
