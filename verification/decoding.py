"""Typed decoding of clean and of broken text.

The broken forms hang on a column of each row, so every table is decoded whole.
"""

from pyspark.sql import functions as F

from loadstone.functions import decode as D
from loadstone.functions.formats import fmt_timestamp
from verification.registry import day, money, query, second, table, text


def variants(column, cases, default):
    """A CASE over the values of ``column``."""
    expr = None
    for value, text_form in cases.items():
        hit = F.col(column) == value
        expr = F.when(hit, text_form) if expr is None else expr.when(hit, text_form)
    return expr.otherwise(default)


def texts(spark, sf_dir, name, x, *keys):
    """Key columns of a table and ``x`` as a column: decoders use their text several times, and
    would make an expression anew for each use."""
    return table(spark, sf_dir, name).select(*keys, x.alias("x"))


@query(
    "decode_string",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
      WHEN event_type = 'click' THEN '  ' || event_type || ' '
      WHEN event_type = 'view' THEN '   ' ELSE props END AS s FROM events""",
)
def decode_string(spark, sf_dir):
    """Empty is NULL; blanks stay, also where there is nothing else."""
    x = variants(
        "event_type",
        {
            "error": F.lit(""),
            "click": F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")),
            "view": F.lit("   "),
        },
        F.col("props"),
    )
    return texts(spark, sf_dir, "events", x, "event_id").select("event_id", D.decode_string(F.col("x")).alias("s"))


@query("decode_varchar", "SELECT p_partkey, substr(p_name, 1, 5) AS name FROM part")
def decode_varchar(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", D.decode_string(F.col("p_name"), 5).alias("name")
    )


@query(
    "decode_int64",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN o_custkey
      WHEN '2-HIGH' THEN -o_custkey WHEN '5-LOW' THEN o_orderkey END AS n,
      o_orderpriority IN ('3-MEDIUM', '4-NOT SPECIFIED') AS bad FROM orders""",
)
def decode_int64(spark, sf_dir):
    """Padded, negative, signed with a plus, too long for 64 bits."""
    key = text("o_custkey")
    x = variants(
        "o_orderpriority",
        {
            "1-URGENT": F.concat(F.lit("  "), key, F.lit("\t")),
            "2-HIGH": F.concat(F.lit("-"), key),
            "3-MEDIUM": F.concat(F.lit("+"), key),
            "4-NOT SPECIFIED": F.concat(F.lit("99999999999999999999"), key),
        },
        text("o_orderkey"),
    )
    rows = texts(spark, sf_dir, "orders", x, "o_orderkey").select("*", D.decode_int64(F.col("x")).alias("n"))
    return rows.select("o_orderkey", "n", ((F.col("x") != "") & F.col("n").isNull()).alias("bad"))


@query(
    "decode_float64",
    """WITH t AS (SELECT c_custkey, c_mktsegment AS m,
        CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS x FROM customer)
    SELECT c_custkey, CASE m WHEN 'BUILDING' THEN CAST(x || 'e1' AS DOUBLE)
      WHEN 'FURNITURE' THEN NULL ELSE CAST(x AS DOUBLE) END AS d,
      m = 'FURNITURE' AS bad FROM t""",
)
def decode_float64(spark, sf_dir):
    """Padded, with an exponent, with Java's type suffix; inf and nan are not numbers."""
    amount = money("c_acctbal")
    x = variants(
        "c_mktsegment",
        {
            "AUTOMOBILE": F.concat(F.lit(" "), amount, F.lit("  ")),
            "BUILDING": F.concat(amount, F.lit("e1")),
            "MACHINERY": F.concat(amount, F.lit("d")),
            "FURNITURE": F.when(F.col("c_acctbal") > 0, F.lit("nan")).otherwise(F.lit("-inf")),
        },
        amount,
    )
    rows = texts(spark, sf_dir, "customer", x, "c_custkey").select("c_custkey", D.decode_float64(F.col("x")).alias("d"))
    return rows.select("*", F.col("d").isNull().alias("bad"))


_CUT = "CAST(trunc(CAST({0} AS DECIMAL(14,2)) * 10) AS DECIMAL(14,0)) * CAST(0.1 AS DECIMAL(2,1))"


@query(
    "decode_numeric",
    f"""WITH t AS (SELECT l_orderkey, l_linenumber AS k, l_linestatus, l_extendedprice AS price,
        CAST(l_quantity AS INTEGER) AS q FROM lineitem)
    SELECT l_orderkey, k AS l_linenumber, CAST(CASE k
      WHEN 1 THEN {_CUT.format('price')} WHEN 2 THEN {_CUT.format('-price')}
      WHEN 3 THEN {_CUT.format('price')}
      WHEN 4 THEN CASE WHEN q < 10 THEN q ELSE q // 10 END * CAST(0.1 AS DECIMAL(2,1))
      WHEN 5 THEN CAST(q AS DECIMAL(14,1))
      WHEN 6 THEN CASE WHEN l_linestatus = 'O' THEN CAST(0 AS DECIMAL(14,1)) END
      END AS DECIMAL(14,1)) AS n, k = 7 OR (k = 6 AND l_linestatus <> 'O') AS bad FROM t""",
)
def decode_numeric(spark, sf_dir):
    """Excess scale is cut toward zero; no leading zero, a bare point, wrong signs."""
    price, quantity = money("l_extendedprice"), F.col("l_quantity").cast("int").cast("string")
    x = variants(
        "l_linenumber",
        {
            1: price,
            2: F.concat(F.lit("-"), price),
            3: F.concat(F.lit(" "), price, F.lit("17   ")),
            4: F.concat(F.lit("."), quantity),
            5: F.concat(quantity, F.lit(".")),
            6: F.when(F.col("l_linestatus") == "O", F.lit(".")).otherwise(F.lit("-")),
        },
        F.when(F.col("l_linestatus") == "O", F.concat(quantity, F.lit("e3"))).otherwise(
            F.concat(F.lit("+"), price)
        ),
    )
    keys = ("l_orderkey", "l_linenumber")
    rows = texts(spark, sf_dir, "lineitem", x, *keys).select(*keys, D.decode_numeric(F.col("x"), 14, 1).alias("n"))
    return rows.select("*", F.col("n").isNull().alias("bad"))


@query(
    "decode_date",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
        THEN CAST(o_orderdate AS DATE) END AS d1,
      CASE WHEN o_orderpriority = '3-MEDIUM' THEN CAST(o_orderdate AS DATE) END AS d2,
      CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN CAST(o_orderdate AS DATE) END AS d3
    FROM orders""",
)
def decode_date(spark, sf_dir):
    """Default pattern, padded, two other patterns, and a day that does not exist."""
    plain = day("o_orderdate")
    parts = F.split(plain, "-")
    x = variants(
        "o_orderpriority",
        {
            "1-URGENT": plain,
            "2-HIGH": F.concat(F.lit(" "), plain, F.lit("\t")),
            "3-MEDIUM": F.concat_ws("/", parts[1], parts[2], parts[0]),
            "4-NOT SPECIFIED": F.concat(*[parts[i] for i in range(3)]),
        },
        F.concat(parts[0], F.lit("-02-31")),
    )
    return texts(spark, sf_dir, "orders", x, "o_orderkey").select(
        "o_orderkey",
        D.decode_date(F.col("x")).alias("d1"),
        D.decode_date(F.col("x"), "MM/dd/yyyy").alias("d2"),
        D.decode_date(F.col("x"), "yyyyMMdd").alias("d3"),
    )


_TS = "strftime(ts {0}, '%Y-%m-%d %H:%M:%S UTC')"


@query(
    "decode_ts_offset",
    f"""SELECT event_id, CASE event_type WHEN 'click' THEN {_TS.format('')}
      WHEN 'error' THEN {_TS.format("- INTERVAL '5 hours 30 minutes'")}
      WHEN 'view' THEN {_TS.format("+ INTERVAL '8 hours'")}
      WHEN 'signup' THEN {_TS.format('')} END AS instant FROM events""",
)
def decode_ts_offset(spark, sf_dir):
    at = second("ts")
    x = variants(
        "event_type",
        {
            "click": F.concat(at, F.lit("+00:00")),
            "error": F.concat(at, F.lit("+05:30")),
            "view": F.concat(F.lit(" "), at, F.lit("-08:00 ")),
            "signup": F.concat(at, F.lit("Z")),
        },
        at,
    )
    return texts(spark, sf_dir, "events", x, "event_id").select(
        "event_id", fmt_timestamp(D.decode_ts_offset(F.col("x"))).alias("instant")
    )


@query(
    "decode_ts_zoned",
    f"""SELECT event_id, CASE event_type WHEN 'click' THEN {_TS.format("+ INTERVAL '7 hours'")}
      WHEN 'error' THEN {_TS.format('')}
      WHEN 'view' THEN {_TS.format("+ INTERVAL '6 hours'")}
      WHEN 'signup' THEN {_TS.format("- INTERVAL '2 hours'")} END AS instant FROM events""",
)
def decode_ts_zoned(spark, sf_dir):
    """``UTC-07:00``, a zone name, a region in winter, an offset; no zone is unreadable."""
    at = second("ts")
    x = variants(
        "event_type",
        {
            "click": F.concat(at, F.lit(" UTC-07:00")),
            "error": F.concat(at, F.lit(" UTC")),
            "view": F.concat(at, F.lit(" America/Chicago")),
            "signup": F.concat(at, F.lit(" +02:00")),
        },
        at,
    )
    return texts(spark, sf_dir, "events", x, "event_id").select(
        "event_id", fmt_timestamp(D.decode_ts_zoned(F.col("x"))).alias("instant")
    )


@query(
    "decode_ts_local",
    f"""SELECT event_id, CASE WHEN event_type IN ('click', 'error')
        THEN {_TS.format("+ INTERVAL '6 hours'")} END AS chicago,
      CASE WHEN event_type = 'view' THEN {_TS.format("- INTERVAL '9 hours'")} END AS tokyo
    FROM events""",
)
def decode_ts_local(spark, sf_dir):
    """Declared zones: Chicago in winter with the default pattern, Tokyo with its own."""
    at = second("ts")
    x = variants(
        "event_type",
        {
            "click": at,
            "error": F.concat(F.lit("\t"), at, F.lit("  ")),
            "view": F.regexp_replace(at, "[^0-9]", ""),
        },
        F.concat(F.substring(at, 1, 10), F.lit(" 24:00:00")),
    )
    return texts(spark, sf_dir, "events", x, "event_id").select(
        "event_id",
        fmt_timestamp(D.decode_ts_local(F.col("x"), "America/Chicago")).alias("chicago"),
        fmt_timestamp(D.decode_ts_local(F.col("x"), "Asia/Tokyo", "yyyyMMddHHmmss")).alias("tokyo"),
    )


@query(
    "decode_ts_seasons",
    """SELECT event_id, CASE event_type
        WHEN 'click' THEN epoch_us(ts + INTERVAL '6 hours')
        WHEN 'view' THEN epoch_us(ts + INTERVAL '182 days' + INTERVAL '5 hours')
        WHEN 'error' THEN epoch_us(TIMESTAMP '2020-03-08 08:30:00.000001') + event_id % 1000
        ELSE epoch_us(TIMESTAMP '2020-11-01 06:30:00.25') END AS micros,
      CASE WHEN event_type = 'view' THEN epoch_us(ts + INTERVAL '182 days' + INTERVAL '7 hours')
        WHEN event_type = 'click' THEN epoch_us(ts + INTERVAL '8 hours') END AS pacific
    FROM events""",
)
def decode_ts_seasons(spark, sf_dir):
    """Winter and summer, a time that the clock skips in spring and one that it shows
    twice in autumn, all with fractions, which stay."""
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    summer = F.col("ts") + F.expr("INTERVAL 182 DAYS")
    skipped = F.concat(F.lit("2020-03-08 02:30:00."), F.lpad((F.col("event_id") % 1000 + 1).cast("string"), 6, "0"))
    pattern = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    x = variants(
        "event_type",
        {"click": stamp(F.col("ts")), "view": stamp(summer), "error": skipped},
        F.lit("2020-11-01 01:30:00.250000"),
    )
    zoned = F.when(F.col("event_type").isin("click", "view"), F.concat(F.col("x"), F.lit(" America/Los_Angeles")))
    rows = texts(spark, sf_dir, "events", x, "event_id", "event_type").select("event_id", "x", zoned.alias("zoned"))
    return rows.select(
        "event_id",
        F.unix_micros(D.decode_ts_local(F.col("x"), "America/Chicago", pattern)).alias("micros"),
        F.unix_micros(D.decode_ts_zoned(F.col("zoned"), pattern + " VV")).alias("pacific"),
    )
