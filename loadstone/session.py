"""Session settings of the jobs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Fixed value: the largest method, in bytes, that the HotSpot compiler takes.
HOTSPOT_METHOD_LIMIT = 8000
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Keep generated methods small enough to be compiled.

    A stage that decodes or formats some twenty columns outgrows the limit as a
    single method, and would be interpreted from then on, several times slower.
    With the limit in force Spark generates such a stage as small methods
    instead. Set it for good in sessions that build their own DataFrames.
    """
    with session_settings(spark, {_METHOD_LIMIT: HOTSPOT_METHOD_LIMIT}):
        yield


@contextmanager
def session_settings(spark: SparkSession, settings: dict) -> Iterator[None]:
    """Settings that hold for a while, and are put back as they were."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
