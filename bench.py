"""Headline jobs at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

The text inputs are rendered from the tables once, before the clock starts. Each
job runs once to warm up and then three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from loadstone import export, infer_fields, load, parse_spec  # noqa: E402
from loadstone.operators import quality  # noqa: E402
from loadstone.operators.export import export_lines  # noqa: E402
from loadstone.sources.delimited import scan_lines, split_fields  # noqa: E402
from verification.registry import LINEITEM_SPEC, lines, table  # noqa: E402

RUNS = 3


def folder_bytes(path: str) -> int:
    return sum(f.stat().st_size for f in Path(path).glob("part-*"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    work = tempfile.mkdtemp(prefix="loadstone-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    lines(spark, sf_dir, "lineitem").repartition(int(cpus)).write.text(f"{work}/lineitem")
    source, fields = scan_lines(spark, f"{work}/lineitem"), parse_spec(LINEITEM_SPEC)
    lineitem, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    documents = table(spark, sf_dir, "documents")
    # A first run creates part files; each later one needs a path of its own.
    paths = (f"{work}/out-{i}" for i in range(10**6))

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    def revenue():
        rows = quality.typed_rows(source, fields)
        rows.groupBy("l_returnflag", "l_linestatus").agg(
            F.sum("l_quantity"), F.sum("l_extendedprice"), F.min("l_shipdate")
        ).collect()

    jobs = {
        "split_lineitem": lambda: noop(split_fields(source, len(fields))),
        "decode_lineitem": lambda: noop(quality.typed_rows(source, fields)),
        "decode_lineitem_good_rows": lambda: noop(quality.good_rows(source, fields)),
        "decode_lineitem_strict": lambda: noop(quality.strict_rows(source, fields)),
        "decode_and_aggregate": revenue,
        "infer_lineitem_full_scan": lambda: infer_fields(source, [f.name for f in fields]),
        "load_lineitem_orc": lambda: load(
            spark, f"{work}/lineitem", path=next(paths), schema=LINEITEM_SPEC
        ),
        "load_lineitem_autodetect": lambda: load(
            spark, f"{work}/lineitem", path=next(paths), autodetect=True
        ),
        "format_lineitem": lambda: noop(export_lines(lineitem)),
        "export_orders_csv_gz": lambda: export(spark, orders, next(paths)),
        "export_lineitem_csv_gz": lambda: export(spark, lineitem, next(paths), partitions=int(cpus)),
        "export_documents_csv_gz": lambda: export(spark, documents, next(paths), partitions=int(cpus)),
        "export_lineitem_seq": lambda: export(
            spark, lineitem, next(paths), fmt="seq", partitions=int(cpus)
        ),
        "export_orders_seq": lambda: export(spark, orders, next(paths), fmt="seq"),
    }
    rows = {"lineitem": lineitem.count(), "orders": orders.count(), "documents": documents.count()}
    seconds, rate = {}, {}
    for name, job in jobs.items():
        job()
        taken = []
        for _ in range(RUNS):
            start = time.perf_counter()
            job()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
        count = next((n for t, n in rows.items() if t in name), rows["lineitem"])
        rate[name] = round(count / seconds[name])
    orc = next(paths)
    load(spark, f"{work}/lineitem", path=orc, schema=LINEITEM_SPEC)
    ratio = folder_bytes(orc) / folder_bytes(f"{work}/lineitem")
    print(
        json.dumps(
            {
                "metric": "total time of the load and export jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "rows_per_sec": rate,
                "orc_bytes_per_text_byte": round(ratio, 3),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
