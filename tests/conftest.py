import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("loadstone-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    return session


@pytest.fixture
def text(spark):
    """Lines as a DataFrame with a ``value`` column."""

    def make(*lines):
        return spark.createDataFrame([(line,) for line in lines], "value string")

    return make


@pytest.fixture
def decoded(spark):
    """Values of a decoder over several texts, in order."""

    def run(decoder, texts):
        rows = [(i, t) for i, t in enumerate(texts)]
        from pyspark.sql import functions as F

        # Repartitioned, so that the optimizer does not evaluate it ahead on
        # the driver: the generated code is what is to be tested.
        df = spark.createDataFrame(rows, "i int, x string").repartition(2)
        out = df.select("i", decoder(F.col("x")).alias("v")).collect()
        return [r["v"] for r in sorted(out, key=lambda r: r["i"])]

    return run


@pytest.fixture
def file_of(tmp_path):
    def make(name, lines, newline="\n"):
        path = tmp_path / name
        path.write_text(newline.join(lines) + newline, encoding="utf-8", newline="")
        return str(path)

    return make
