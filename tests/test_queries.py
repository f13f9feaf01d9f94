import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as entry
from compare import compare, duck
from verification.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES[name], ORACLES.get(name)) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_queries_are_read_without_a_session():
    """A driver lists the queries before it starts Spark, so no module may make a column on import."""
    code = (
        "import __spark_entry__ as e; names = [*e.queries(), *e.oracle_sql()]\n"
        "from pyspark import SparkContext; assert SparkContext._active_spark_context is None\n"
        "print(*names)"
    )
    said = subprocess.run(
        [sys.executable, "-B", "-c", code],
        cwd=Path(entry.__file__).parent, capture_output=True, text=True, timeout=120,
    )
    assert said.returncode == 0, said.stderr[-800:]
    assert said.stdout.split() == [*entry.queries(), *entry.oracle_sql()]
