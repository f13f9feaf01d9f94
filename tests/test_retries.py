"""Tasks that fail and run again change neither rows nor counts.

In a process of its own: a local session repeats tasks only if its master says so.
"""

import json
import subprocess
import sys
from pathlib import Path

SCRIPT = """
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import SparkSession
from loadstone import export, load

spark = (
    SparkSession.builder.master("local[2,4]")
    .config("spark.ui.enabled", "false")
    .config("spark.ui.showConsoleProgress", "false")
    .getOrCreate()
)
spark.sparkContext.setLogLevel("OFF")
out = sys.argv[2]


def flaky(batches):
    # The first attempt of each task breaks off after it has handed on a batch.
    for n, batch in enumerate(batches):
        yield batch
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("lost")


spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
ids = spark.range(0, 2000, 1, 4)
lines = ids.selectExpr("CASE WHEN id % 2 = 0 THEN 'x' ELSE CAST(id AS STRING) END AS value")
lines = lines.mapInPandas(flaky, "value string")
loaded = load(spark, lines, path=out + "/load", schema="id:INT64", error_limit=5000, partitions=3)
exported = export(spark, ids.mapInPandas(flaky, "id bigint"), out + "/export")
print(json.dumps({
    "load": [loaded.rows_read, loaded.rows_written, loaded.bad],
    "writers": [len(loaded.by_writer), sum(loaded.by_writer.values())],
    "streams": exported.by_stream,
    "stored": spark.read.orc(out + "/load").distinct().count(),
    "export": exported.rows,
    "lines": spark.read.text(out + "/export").distinct().count(),
}))
"""


def test_repeated_tasks_count_once(tmp_path):
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT, root, str(tmp_path)],
        capture_output=True,
        text=True,
        timeout=300,
        check=False,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert json.loads(done.stdout.splitlines()[-1]) == {
        "load": [2000, 1000, 1000],
        "writers": [3, 1000],
        "streams": {"0": 500, "1": 500, "2": 500, "3": 500},
        "stored": 1000,
        "export": 2000,
        "lines": 2000,
    }
