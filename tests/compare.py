"""Run every registered query beside its SQL on DuckDB and compare the rows.

Usage: python tests/compare.py [sf dir] [query ...]
More session settings go into COMPARE_CONF as key=value,key=value.
"""

import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def duck(sf_dir):
    from verification.registry import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(str(r[i]) for i in order) for r in rows]
    return sorted(out), [names[i] for i in order]


def compare(spark, con, sf_dir, name, fn, sql):
    """None if the rows agree, else what differs."""
    df = fn(spark, sf_dir)
    ours, our_names = normal([tuple(r) for r in df.collect()], df.columns)
    if sql is None:
        return None
    rel = con.execute(sql)
    theirs, their_names = normal(rel.fetchall(), [d[0] for d in rel.description])
    if our_names != their_names:
        return f"columns {our_names} != {their_names}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    diff = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(diff)} of {len(ours)} rows differ, first {diff[0]}" if diff else None


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for setting in os.environ.get("COMPARE_CONF", "").split(","):
        key, _, value = setting.partition("=")
        if key:
            spark = spark.config(key, value)
    spark = spark.getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    return spark


def main(sf_dir="/root/testdata/sf0.01", *only):
    import __spark_entry__ as entry

    spark, con = session(), duck(sf_dir)
    sqls, failed = entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name, fn, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
