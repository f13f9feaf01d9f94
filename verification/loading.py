"""Schemas of a load, bad rows, and the sinks of the load job."""

import time
from unittest import mock

from pyspark.sql import functions as F

from loadstone.fields import SchemaError
from loadstone.functions.formats import fmt_timestamp
from loadstone.operators.quality import (
    LoadError,
    bad_rows,
    count_rows,
    good_rows,
    reaches_limit,
    typed_rows,
)
from loadstone.operators.schema import column_comment, parse_spec, template_fields
from loadstone.plans.load import load, resolve_fields
from loadstone.session import session_settings
from loadstone.sinks import publish
from loadstone.sinks.orc import measure_rows, write_orc
from loadstone.sinks.tables import DestinationError, resolve_table
from loadstone.sources.delimited import scan_lines
from loadstone.storage import part_files, scratch_dir
from verification.registry import (
    LINEITEM_SPEC,
    LINEITEM_SQL,
    ORDERS_SPEC,
    ORDERS_SQL,
    lines,
    query,
    rows_by_part,
    scratch_database,
    table,
    text_columns,
    text_file,
    text_sql,
)

# --- schemas --------------------------------------------------------------


@query("load_with_spec", f"SELECT {LINEITEM_SQL} FROM lineitem")
def load_with_spec(spark, sf_dir):
    return typed_rows(lines(spark, sf_dir, "lineitem"), parse_spec(LINEITEM_SPEC))


@query(
    "revenue_by_flag",
    """SELECT l_returnflag, l_linestatus, count(*) AS rows,
      CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS quantity,
      CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS price,
      min(CAST(l_shipdate AS DATE)) AS first_shipped FROM lineitem GROUP BY ALL""",
)
def revenue_by_flag(spark, sf_dir):
    """A load read straight into an aggregation: only the columns it uses are decoded."""
    rows = typed_rows(lines(spark, sf_dir, "lineitem"), parse_spec(LINEITEM_SPEC))
    return rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum("l_quantity").alias("quantity"),
        F.sum("l_extendedprice").alias("price"),
        F.min("l_shipdate").alias("first_shipped"),
    )


_EVENTS_TEMPLATE = """event_id BIGINT,
  ts TIMESTAMP COMMENT 'America/Chicago|yyyy-MM-dd HH:mm:ss',
  user_id BIGINT COMMENT 'no args for this type',
  event_type STRING COMMENT '4',
  value DECIMAL(10,0) COMMENT '12,2',
  props STRING"""


def _events_template(spark):
    name = f"{scratch_database(spark)}.template"
    spark.sql(f"CREATE TABLE {name} ({_EVENTS_TEMPLATE}) USING orc")
    return name


@query(
    "load_with_template",
    """SELECT event_id, strftime(ts + INTERVAL '6 hours', '%Y-%m-%d %H:%M:%S UTC') AS ts, user_id,
      substr(event_type, 1, 4) AS event_type, CAST(value AS DECIMAL(12,2)) AS value, props
    FROM events""",
)
def load_with_template(spark, sf_dir):
    fields = template_fields(spark.table(_events_template(spark)).schema)
    rows = typed_rows(lines(spark, sf_dir, "events"), fields)
    return rows.withColumn("ts", fmt_timestamp(F.col("ts")))


@query(
    "schema_comments",
    """SELECT 'event_id' AS name, '' AS comment, count(event_id) AS filled FROM events
    UNION ALL SELECT 'ts', 'America/Chicago|yyyy-MM-dd HH:mm:ss', count(ts) FROM events
    UNION ALL SELECT 'user_id', 'no args for this type', count(user_id) FROM events
    UNION ALL SELECT 'event_type', '4', count(event_type) FROM events
    UNION ALL SELECT 'value', '12,2', count(value) FROM events
    UNION ALL SELECT 'props', '', count(props) FROM events""",
)
def schema_comments(spark, sf_dir):
    """An inferred load that takes names and comments from a template, read back as a table."""
    template = _events_template(spark)
    loaded = f"{template.partition('.')[0]}.loaded"
    load(spark, lines(spark, sf_dir, "events"), loaded, autodetect=True, template=template)
    rows = spark.table(loaded)
    counts = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    comments = {f.name: column_comment(f) or "" for f in rows.schema.fields}
    comment = F.coalesce(
        *[F.when(F.col("name") == name, F.lit(value)) for name, value in comments.items()]
    )
    return counts.unpivot([], rows.columns, "name", "filled").select(
        "name", comment.alias("comment"), "filled"
    )


@query(
    "schema_precedence",
    """SELECT 'autodetect' AS asked, 'DATE' AS date_kind, 'o_orderdate' AS date_name, count(*) AS rows,
      CAST(0 AS BIGINT) AS bad FROM orders
    UNION ALL SELECT 'template', 'STRING', 'o_orderdate', count(*), 0 FROM orders
    UNION ALL SELECT 'destination', 'STRING', 'o_orderdate', count(*), 0 FROM orders
    UNION ALL SELECT 'spec', 'TIMESTAMP_LOCAL', 'ordered', count(*), count(*) FROM orders
    UNION ALL SELECT 'missing', 'none', 'none', count(*), 0 FROM orders""",
)
def schema_precedence(spark, sf_dir):
    """The same lines under each way to a schema. The template and the
    specification disagree with the data, so each shows which one was used."""
    source = lines(spark, sf_dir, "orders")
    template = f"{scratch_database(spark)}.template"
    spark.sql(
        f"CREATE TABLE {template} (o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, "
        "o_totalprice DOUBLE, o_orderdate STRING, o_orderpriority STRING) USING orc"
    )
    spec = "key:INT64,cust:INT64,status,price:FLOAT64,ordered:TIMESTAMP:Asia/Tokyo,priority"
    ways = {
        "autodetect": {"autodetect": True, "template": template, "schema": spec},
        "template": {"template": template, "schema": spec},
        "destination": {"destination": resolve_table(template), "schema": spec},
        "spec": {"schema": spec},
        "missing": {"template": f"{template}_none", "schema": spec},
    }
    result = None
    for asked, options in ways.items():
        try:
            fields = resolve_fields(spark, source, **options)
            shown, counts = fields[4], count_rows(source, fields)
        except SchemaError:
            shown = None
            counts = source.agg(F.count(F.lit(1)).alias("rows"), F.lit(0).cast("bigint").alias("bad"))
        rows = counts.select(
            F.lit(asked).alias("asked"),
            F.lit(shown.kind if shown else "none").alias("date_kind"),
            F.lit(shown.name if shown else "none").alias("date_name"),
            "rows",
            "bad",
        )
        result = rows if result is None else result.unionByName(rows)
    return result


# --- quality --------------------------------------------------------------


def _broken_orders(spark, sf_dir):
    """Orders with the keys of one status and the dates of one priority broken:
    almost half of the rows are bad."""
    columns = text_columns("orders")
    key, date = columns["o_orderkey"], columns["o_orderdate"]
    return lines(
        spark,
        sf_dir,
        "orders",
        o_orderkey=F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("x"), key)).otherwise(key),
        o_orderdate=F.when(
            F.col("o_orderpriority") == "5-LOW", F.concat(F.substring(date, 1, 4), F.lit("-02-31"))
        ).otherwise(date),
    )


_O = text_sql("orders")
_BAD_KEY = "o_orderstatus = 'P'"
_BAD_ROW = f"({_BAD_KEY} OR o_orderpriority = '5-LOW')"
_KEY_TEXT = f"CASE WHEN {_BAD_KEY} THEN 'x' || o_orderkey ELSE {_O['o_orderkey']} END"
_DATE_TEXT = (
    "CASE WHEN o_orderpriority = '5-LOW' THEN year(o_orderdate) || '-02-31' "
    f"ELSE {_O['o_orderdate']} END"
)
_BROKEN_SQL = (
    f"concat_ws('þ', {_KEY_TEXT}, {_O['o_custkey']}, {_O['o_orderstatus']}, {_O['o_totalprice']}, "
    f"{_DATE_TEXT}, o_orderpriority)"
)


@query(
    "bad_rows",
    f"""SELECT {_BROKEN_SQL} AS line, CASE WHEN {_BAD_KEY} THEN 0 ELSE 4 END AS col_idx,
      CASE WHEN {_BAD_KEY} THEN 'o_orderkey' ELSE 'o_orderdate' END AS col_name,
      CASE WHEN {_BAD_KEY} THEN 'INT64' ELSE 'DATE(format=yyyy-MM-dd)' END AS type,
      CAST(CASE WHEN {_BAD_KEY} THEN length({_KEY_TEXT}) ELSE 10 END AS INTEGER) AS len,
      CASE WHEN {_BAD_KEY} THEN {_KEY_TEXT} ELSE {_DATE_TEXT} END AS value
    FROM orders WHERE {_BAD_ROW}""",
)
def quarantined(spark, sf_dir):
    return bad_rows(_broken_orders(spark, sf_dir), parse_spec(ORDERS_SPEC))


@query(
    "bad_row_numbers",
    f"""WITH numbered AS (
      SELECT *, row_number() OVER (PARTITION BY o_orderkey % 3 ORDER BY o_orderkey) AS row, o_orderkey % 3 AS file FROM orders)
    SELECT file, row, {_BROKEN_SQL} AS line, CASE WHEN {_BAD_KEY} THEN 'o_orderkey' ELSE 'o_orderdate' END AS col_name
    FROM numbered WHERE {_BAD_ROW}""",
)
def bad_row_numbers(spark, sf_dir):
    """File and line number of each bad row, from a load that reads sorted files in many
    splits and writes its table and its quarantine in one pass."""
    source = scratch_dir(spark, "numbered")
    broken, key = _broken_orders(spark, sf_dir), F.regexp_extract("value", "^x?([0-9]+)", 1).cast("bigint")
    placed = broken.select("value", key.alias("key"), (key % 3).alias("file")).repartitionByRange(3, "file")
    placed.sortWithinPartitions("file", "key").drop("key").write.partitionBy("file").text(source)
    out = scratch_dir(spark, "quarantine")
    settings = {"spark.sql.files.maxPartitionBytes": 20_000, "spark.sql.files.openCostInBytes": 1}
    with session_settings(spark, settings):
        load(
            spark, source, f"{scratch_database(spark)}.orders", schema=ORDERS_SPEC,
            error_limit=2**62, quarantine=out,
        )
    file = F.regexp_extract("source", "file=([0-9])", 1).cast("bigint")
    return spark.read.json(out).select(file.alias("file"), "row", "line", "col_name")


@query("good_rows", f"SELECT {ORDERS_SQL} FROM orders WHERE NOT {_BAD_ROW}")
def kept(spark, sf_dir):
    return good_rows(_broken_orders(spark, sf_dir), parse_spec(ORDERS_SPEC))


@query(
    "error_limit",
    f"""WITH b AS (SELECT count(*) AS bad FROM orders WHERE {_BAD_ROW})
    SELECT 'zero' AS name, bad, bad >= 1 AS stops FROM b
    UNION ALL SELECT 'as_many', bad, true FROM b
    UNION ALL SELECT 'one_more', bad, false FROM b""",
)
def error_limit(spark, sf_dir):
    """Limit 0 stops at the first bad row, limit n at the n-th."""
    counts = count_rows(_broken_orders(spark, sf_dir), parse_spec(ORDERS_SPEC))
    limits = F.array(
        F.struct(F.lit("zero").alias("name"), F.lit(0).cast("bigint").alias("most")),
        F.struct(F.lit("as_many").alias("name"), F.col("bad").alias("most")),
        F.struct(F.lit("one_more").alias("name"), (F.col("bad") + 1).alias("most")),
    )
    return counts.select("bad", F.inline(limits)).select(
        "name", "bad", reaches_limit(F.col("bad"), F.col("most")).alias("stops")
    )


@query(
    "load_row_count",
    f"""SELECT count(*) AS rows_read, count(*) FILTER (WHERE NOT {_BAD_ROW}) AS rows_written,
      count(*) FILTER (WHERE {_BAD_ROW}) AS bad, count(*) FILTER (WHERE NOT {_BAD_ROW}) AS stored
    FROM orders""",
)
def load_row_count(spark, sf_dir):
    """The counts a load reports, beside the rows found in its parts."""
    path = scratch_dir(spark, "counted")
    source = _broken_orders(spark, sf_dir)
    result = load(spark, source, path=path, schema=ORDERS_SPEC, error_limit=2**62)
    return (
        spark.read.orc(path)
        .agg(F.count(F.lit(1)).alias("stored"))
        .select(
            F.lit(result.rows_read).cast("bigint").alias("rows_read"),
            F.lit(result.rows_written).cast("bigint").alias("rows_written"),
            F.lit(result.bad).cast("bigint").alias("bad"),
            "stored",
        )
    )


@query(
    "load_writer_counts",
    f"""SELECT count(*) FILTER (WHERE NOT {_BAD_ROW}) AS reported, count(*) FILTER (WHERE NOT {_BAD_ROW}) AS stored,
      CAST(0 AS BIGINT) AS differing FROM orders""",
)
def load_writer_counts(spark, sf_dir):
    """The rows reported for each writer, beside those in the parts that carry its number."""
    path = scratch_dir(spark, "by-writer")
    result = load(spark, _broken_orders(spark, sf_dir), path=path, schema=ORDERS_SPEC, error_limit=2**62, partitions=5)
    part = F.regexp_extract(F.input_file_name(), "part-([0-9]+)", 1).cast("int")
    return rows_by_part(spark.read.orc(path).select(part.alias("part")), result.by_writer)


# --- ORC parts ------------------------------------------------------------


@query("write_orc", f"SELECT {LINEITEM_SQL} FROM lineitem")
def orc(spark, sf_dir):
    path = scratch_dir(spark, "orc")
    write_orc(typed_rows(lines(spark, sf_dir, "lineitem"), parse_spec(LINEITEM_SPEC)), path)
    return spark.read.orc(path)


@query(
    "write_orc_parts",
    "SELECT count(*) AS rows, true AS several, true AS within FROM lineitem",
)
def orc_parts(spark, sf_dir):
    """Parts with a quarter of the table's bytes as their target size."""
    source, fields = lines(spark, sf_dir, "lineitem"), parse_spec(LINEITEM_SPEC)
    path = scratch_dir(spark, "parts")
    per_row, _ = measure_rows(source, fields, scratch_dir(spark, "probe"))
    target_mb = per_row * source.count() / 4 / 2**20
    load(spark, source, path=path, schema=LINEITEM_SPEC, part_mb=target_mb)
    sizes = part_files(spark, path).agg(
        F.count(F.lit(1)).alias("parts"), F.max("bytes").alias("largest")
    ).first()
    # A file carries its footer on top of the rows.
    within = sizes["largest"] <= 1.25 * target_mb * 2**20
    return spark.read.orc(path).agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(sizes["parts"] >= 3).alias("several"),
        F.lit(within).alias("within"),
    )


@query(
    "write_parallel",
    """SELECT 'fewer' AS asked, true AS got, count(*) AS rows FROM lineitem
    UNION ALL SELECT 'more', true, count(*) FROM lineitem""",
)
def writers(spark, sf_dir):
    """Half as many writers as input splits, which are merged, and twice as many,
    to which the lines are dealt out."""
    source = text_file(spark, lines(spark, sf_dir, "lineitem").repartition(6), "writers")
    splits = scan_lines(spark, source).rdd.getNumPartitions()
    result = None
    for asked, count in (("fewer", max(1, splits // 2)), ("more", 2 * splits)):
        path = scratch_dir(spark, "written")
        load(spark, source, path=path, schema=LINEITEM_SPEC, partitions=count)
        # The names of files are looked at once each, not with every row.
        files = spark.read.orc(path).groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"))
        task = F.regexp_extract("file", "part-([0-9]+)", 1)
        rows = files.agg((F.count_distinct(task) == count).alias("got"), F.sum("rows").alias("rows"))
        rows = rows.select(F.lit(asked).alias("asked"), "got", "rows")
        result = rows if result is None else result.unionByName(rows)
    return result


# --- tables ---------------------------------------------------------------


@query(
    "save_modes",
    """SELECT 'error' AS step, count(*) AS rows, false AS refused FROM orders
    UNION ALL SELECT 'append', 2 * count(*), false FROM orders
    UNION ALL SELECT 'error again', 2 * count(*), true FROM orders
    UNION ALL SELECT 'replace', count(*), false FROM orders""",
)
def save_modes(spark, sf_dir):
    """Rows of one table after each of four loads."""
    name = f"{scratch_database(spark)}.orders"
    source = lines(spark, sf_dir, "orders")
    steps = []
    for step in ("error", "append", "error again", "replace"):
        refused = False
        try:
            # The destination is its own template once it exists.
            load(spark, source, name, schema=ORDERS_SPEC, mode=step.split()[0])
        except DestinationError:
            refused = True
        steps.append((step, spark.table(name).count(), refused))
    return spark.createDataFrame(steps, "step string, rows bigint, refused boolean")


@query(
    "staging_guard",
    """SELECT 'error' AS step, count(*) AS rows, false AS refused FROM orders
    UNION ALL SELECT 'error again', count(*), true FROM orders
    UNION ALL SELECT 'append', count(*), true FROM orders
    UNION ALL SELECT 'replace', count(*), false FROM orders""",
)
def staging_guard(spark, sf_dir):
    """A staging folder that holds parts is refused, or cleared by replace."""
    path = scratch_dir(spark, "staging")
    source = lines(spark, sf_dir, "orders")
    steps = []
    for step in ("error", "error again", "append", "replace"):
        refused = False
        try:
            load(spark, source, path=path, schema=ORDERS_SPEC, mode=step.split()[0])
        except DestinationError:
            refused = True
        steps.append((step, spark.read.orc(path).count(), refused))
    return spark.createDataFrame(steps, "step string, rows bigint, refused boolean")


@query("register_external", f"SELECT {ORDERS_SQL} FROM orders")
def external(spark, sf_dir):
    name = f"{scratch_database(spark)}.orders"
    source = text_file(spark, lines(spark, sf_dir, "orders"), "external")
    path = scratch_dir(spark, "external")
    load(spark, source, name, path=path, external=True, schema=ORDERS_SPEC)
    return spark.table(name)


@query("load_table", f"SELECT {ORDERS_SQL} FROM orders WHERE NOT {_BAD_ROW}")
def native(spark, sf_dir):
    """Staged, then loaded; a first try is stopped by its error limit and publishes nothing."""
    name = f"{scratch_database(spark)}.orders"
    source = _broken_orders(spark, sf_dir)
    options = {"schema": ORDERS_SPEC, "mode": "replace"}
    path = scratch_dir(spark, "native")
    try:
        load(spark, source, name, path=path, error_limit=2, **options)
    except LoadError:
        if spark.catalog.tableExists(name):
            raise
    load(spark, source, name, path=path, error_limit=2**62, adopt=True, **options)
    return spark.table(name)


class _Lost(BaseException):
    """The end of a driver."""


# The step before the one that decides, and that one; tests/test_publish.py has them all.
_PUBLISHES = {"replace": (1, 2), "retyped": (1, 2), "append": (0, 1)}


@query(
    "publish_recovery",
    """SELECT kind, CAST(step AS BIGINT) AS step, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys
    FROM (VALUES ('replace', 1, false), ('replace', 2, true), ('retyped', 1, false), ('retyped', 2, true),
      ('append', 0, false), ('append', 1, true)) k(kind, step, decided), orders
    WHERE CASE WHEN NOT decided THEN o_orderkey % 2 = 0 WHEN kind = 'append' THEN true ELSE o_orderkey % 2 = 1 END
    GROUP BY kind, step""",
)
def publish_recovery(spark, sf_dir):
    """What a table holds after a load whose driver is lost between two steps of its publish,
    and a recovery: all of the old state or all of the new one."""
    database, result = scratch_database(spark), None
    orders = text_columns("orders")
    even, odd = (
        spark.read.text(text_file(spark, table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 2 == n).select(
            F.concat_ws("þ", *orders.values()).alias("value")
        ), "half"))
        for n in (0, 1)
    )
    for kind, steps in _PUBLISHES.items():
        for n in steps:
            name, reached = f"{database}.{kind}_{n}", []
            load(spark, even, name, schema=ORDERS_SPEC)

            def step(done, reached=reached, n=n):
                reached.append(done)
                if len(reached) == n + 1:
                    raise _Lost

            how = {"mode": "replace", "autodetect": kind == "retyped"}
            if kind == "append":
                how = {"mode": "append", "error_limit": 2}
            with mock.patch.object(publish, "step", step):
                try:
                    load(spark, odd, name, schema=ORDERS_SPEC, **how)
                except _Lost:
                    pass
            publish.recover_table(spark, resolve_table(name))
            rows = spark.table(name).agg(F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys"))
            rows = rows.select(F.lit(kind).alias("kind"), F.lit(n).cast("bigint").alias("step"), "rows", "keys")
            result = rows if result is None else result.unionByName(rows)
    return result


@query(
    "load_autodetect",
    f"""SELECT 'lineitem' AS source, CAST(l_orderkey AS VARCHAR) || ' ' || l_linenumber AS id,
      CASE WHEN l_linenumber > 3 THEN '  ' || l_returnflag || ' and more  ' ELSE l_returnflag END AS word,
      CAST(CAST(l_tax AS DECIMAL(12,2)) + CASE WHEN l_linenumber > 3 THEN 0.00001 ELSE 0 END AS DOUBLE) AS number
    FROM lineitem
    UNION ALL SELECT 'events', CAST(event_id AS VARCHAR),
      CASE WHEN event_id % 7 = 6 THEN props || props ELSE props END,
      CAST(CAST(value AS DECIMAL(12,2)) + CASE WHEN event_id % 7 = 6 THEN 0.125 ELSE 0 END AS DOUBLE) FROM events""",
)
def load_autodetect(spark, sf_dir):
    """Inferred loads of whole tables in which later values are longer, padded and of
    another scale than the first ones: nothing is cut."""
    lineitem, events = text_columns("lineitem"), text_columns("events")
    late, some = F.col("l_linenumber") > 3, F.col("event_id") % 7 == 6
    flag, tax, props = lineitem["l_returnflag"], lineitem["l_tax"], events["props"]
    value = F.col("value").cast("decimal(12,2)")
    sources = {
        "lineitem": table(spark, sf_dir, "lineitem").select(
            F.concat_ws(" ", lineitem["l_orderkey"], lineitem["l_linenumber"]).alias("id"),
            F.when(late, F.concat(F.lit("  "), flag, F.lit(" and more  "))).otherwise(flag).alias("word"),
            F.when(late, F.concat(tax, F.lit("001"))).otherwise(tax).alias("number"),
        ),
        "events": table(spark, sf_dir, "events").select(
            F.concat(F.lit("#"), events["event_id"]).alias("id"),
            F.when(some, F.concat(props, props)).otherwise(props).alias("word"),
            F.when(some, (value + F.lit(0.125).cast("decimal(12,3)")).cast("string"))
            .otherwise(events["value"]).alias("number"),
        ),
    }
    result = None
    for name, df in sources.items():
        path = scratch_dir(spark, "inferred")
        given = df.select(F.concat_ws("þ", "id", "word", "number").alias("value"))
        load(spark, text_file(spark, given, name), path=path, autodetect=True, schema="id,word,number")
        rows = spark.read.orc(path).select(
            F.lit(name).alias("source"),
            F.ltrim(F.col("id"), F.lit("#")).alias("id"),
            "word",
            F.col("number").cast("double").alias("number"),
        )
        result = rows if result is None else result.unionByName(rows)
    return result


_TYPED = """o_orderkey INT, o_custkey DECIMAL(10,0), o_orderstatus STRING, o_totalprice DECIMAL(38,9),
  o_orderdate DATE, o_orderpriority STRING"""


@query(
    "append_to_typed_table",
    f"""SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CAST(o_custkey AS DECIMAL(10,0)) AS o_custkey,
      o_orderstatus, CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 0.123456789 AS DECIMAL(38,9)) AS o_totalprice,
      CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
    FROM orders WHERE o_orderstatus <> 'P'""",
)
def append_to_typed_table(spark, sf_dir):
    """A destination's declared sizes count; a key beyond an INT is a bad value."""
    name = f"{scratch_database(spark)}.typed"
    spark.sql(f"CREATE TABLE {name} ({_TYPED}) USING orc")
    columns = text_columns("orders")
    price = F.col("o_totalprice").cast("decimal(12,2)") + F.lit("0.123456789").cast("decimal(10,9)")
    far = F.concat(F.lit("9999999999"), columns["o_orderkey"])
    source = lines(
        spark, sf_dir, "orders",
        o_orderkey=F.when(F.col("o_orderstatus") == "P", far).otherwise(columns["o_orderkey"]),
        o_custkey=F.concat(columns["o_custkey"], F.lit(".7")),
        o_totalprice=price.cast("string"),
    )
    load(spark, source, name, mode="append", error_limit=2**62)
    return spark.table(name)


@query(
    "replace_after_failure",
    """SELECT kind, bad, count(*) AS rows, CAST(sum(o_orderkey) AS BIGINT) AS keys
    FROM orders, (SELECT unnest(['native', 'staged', 'external']) AS kind),
      (SELECT unnest(['first', 'counted']) AS bad) GROUP BY kind, bad""",
)
def replace_after_failure(spark, sf_dir):
    """What a table holds after a replace that fails at the first bad row, and after
    one that fails at its limit: what it held before."""
    database, good = scratch_database(spark), lines(spark, sf_dir, "orders")
    broken, result = _broken_orders(spark, sf_dir), None
    for kind in ("native", "staged", "external"):
        name, options = f"{database}.{kind}", {"schema": ORDERS_SPEC, "external": kind == "external"}
        if kind != "native":
            options["path"] = scratch_dir(spark, kind)
        load(spark, good, name, **options)
        for bad, limit in (("first", 0), ("counted", 2)):
            try:
                load(spark, broken, name, mode="replace", error_limit=limit, **options)
            except LoadError:
                pass
            rows = spark.table(name).agg(
                F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys")
            ).select(F.lit(kind).alias("kind"), F.lit(bad).alias("bad"), "rows", "keys")
            result = rows if result is None else result.unionByName(rows)
    return result


@query(
    "table_lifetime",
    """SELECT lifetime AS kept_for_ms, count(*) AS rows
    FROM orders, (SELECT CAST(unnest([86400000, 604800000]) AS BIGINT) AS lifetime) GROUP BY lifetime
    UNION ALL SELECT CAST(0 AS BIGINT), count(*) FROM orders""",
)
def table_lifetime(spark, sf_dir):
    """Lifetimes that external tables carry, to the minute; none for 0."""
    database, result = scratch_database(spark), None
    source = lines(spark, sf_dir, "orders")
    for n, lifetime in enumerate((86_400_000, None, 0)):
        name, options = f"{database}.t{n}", {} if lifetime is None else {"lifetime_ms": lifetime}
        started = int(time.time() * 1000)
        load(spark, source, name, path=scratch_dir(spark, "kept"), external=True, schema=ORDERS_SPEC, **options)
        properties = spark.sql(f"SHOW TBLPROPERTIES {name}").where("key = 'expires_at'")
        expires = F.coalesce(F.max(F.col("value").cast("bigint")) - started, F.lit(0))
        kept = properties.agg((F.round(expires / 600_000) * 600_000).cast("bigint").alias("kept_for_ms"))
        rows = spark.table(name).agg(F.count(F.lit(1)).alias("rows"))
        both = kept.first()[0]
        rows = rows.select(F.lit(both).cast("bigint").alias("kept_for_ms"), "rows")
        result = rows if result is None else result.unionByName(rows)
    return result


@query(
    "table_names",
    """SELECT n AS given, count(*) AS rows FROM orders,
      (SELECT unnest(['table', 'database.table', 'catalog:database.table', 'catalog.database.table']) AS n)
    GROUP BY n""",
)
def table_names(spark, sf_dir):
    """One load for each way to name a table, read back by its full name."""
    database = scratch_database(spark)
    source, result = lines(spark, sf_dir, "orders"), None
    ways = {
        "table": ("a", {"database": database}),
        "database.table": (f"{database}.b", {}),
        "catalog:database.table": (f"spark_catalog:{database}.c", {}),
        "catalog.database.table": (f"spark_catalog.{database}.d", {}),
    }
    for given, (name, defaults) in ways.items():
        load(spark, source, name, schema=ORDERS_SPEC, **defaults)
        rows = spark.table(f"spark_catalog.{database}.{name[-1]}").agg(F.count(F.lit(1)).alias("rows"))
        rows = rows.select(F.lit(given).alias("given"), "rows")
        result = rows if result is None else result.unionByName(rows)
    return result
