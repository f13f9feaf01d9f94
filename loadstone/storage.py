"""File-system helpers over Hadoop paths, and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MEGABYTE = 1024 * 1024


def scratch_dir(spark: SparkSession, label: str = "run") -> str:
    """A new path for intermediate output that all executors share.

    It lies in the folder the session names in ``spark.checkpoint.dir``, and in
    the warehouse folder of a session that names none.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{base.rstrip('/')}/loadstone-{label}-{uuid.uuid4().hex}"


def _path(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme and without a trailing slash."""
    fs, jpath = _path(spark, path)
    return fs.makeQualified(jpath).toString()


def is_empty(spark: SparkSession, path: str) -> bool:
    """Whether nothing lies directly under ``path``; asks for one entry, not the listing."""
    fs, jpath = _path(spark, path)
    return not fs.exists(jpath) or not fs.listStatusIterator(jpath).hasNext()


def delete_files(spark: SparkSession, path: str, keep_folders: bool = False) -> None:
    """Delete the files directly under ``path``; folders below it stay."""
    fs, jpath = _path(spark, path)
    if not fs.exists(jpath):
        return
    if not keep_folders and fs.getContentSummary(jpath).getDirectoryCount() == 1:
        fs.delete(jpath, True)
        return
    for status in _children(fs, jpath):
        if status.isFile():
            fs.delete(status.getPath(), False)


def move_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the files directly under ``source``, if it is there, to the folder ``target``."""
    fs, jpath = _path(spark, source)
    into = _path(spark, target)[1]
    if not fs.exists(jpath):
        return
    for status in list(_children(fs, jpath)):
        name = status.getPath().getName()
        moved = spark._jvm.org.apache.hadoop.fs.Path(into, name)
        if status.isFile() and not name.startswith("_") and not fs.rename(status.getPath(), moved):
            raise OSError(f"cannot move {name} to {target}")


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly under ``path``, without hidden ones."""
    fs, jpath = _path(spark, path)
    return [s.getPath().getName() for s in _children(fs, jpath) if s.isFile() and not s.getPath().getName().startswith(("_loadstone", "._"))]


def hidden_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path`` that readers skip; none if there is no such folder."""
    fs, jpath = _path(spark, path)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(jpath, "[_.]*")) if fs.exists(jpath) else None
    return [s.getPath().getName() for s in found or []]


def delete_named(spark: SparkSession, path: str, names: list[str]) -> None:
    """Delete these files under ``path``, as far as they are there."""
    fs, jpath = _path(spark, path)
    for name in names:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(jpath, name), False)


def write_whole(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there as a whole or not at all."""
    fs, jpath = _path(spark, path)
    part = spark._jvm.org.apache.hadoop.fs.Path(jpath.getParent(), f".{jpath.getName()}")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(part, jpath):
        raise OSError(f"cannot write {path}")


def read_whole(spark: SparkSession, path: str) -> str:
    fs, jpath = _path(spark, path)
    given = fs.open(jpath)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(given, "UTF-8")
    finally:
        given.close()


def file_sizes(spark: SparkSession, files: list[str]) -> list[int]:
    return [fs.getFileStatus(jpath).getLen() for fs, jpath in (_path(spark, f) for f in files)]


def read_piece(spark: SparkSession, path: str, at: int, size: int) -> bytes:
    """At most ``size`` bytes of a file, from byte ``at`` on."""
    fs, jpath = _path(spark, path)
    given = fs.open(jpath)
    try:
        given.seek(at)
        length = min(size, max(0, fs.getFileStatus(jpath).getLen() - at))
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(given, length))
    finally:
        given.close()


def file_system(spark: SparkSession, path: str) -> str:
    """The file system that a path lies in; files are moved within one only."""
    return _path(spark, path)[0].getUri().toString()


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, jpath = _path(spark, path)
    fs.delete(jpath, True)


def total_bytes(spark: SparkSession, paths: list[str]) -> int:
    """Bytes below all of ``paths``, each of which may be a glob."""
    total = 0
    for path in paths:
        fs, jpath = _path(spark, path)
        for status in fs.globStatus(jpath) or []:
            total += fs.getContentSummary(status.getPath()).getLength()
    return total


def _children(fs, jpath) -> Iterator:
    entries = fs.listStatusIterator(jpath)
    while entries.hasNext():
        yield entries.next()


def part_files(spark: SparkSession, path: str, pattern: str = "part-*") -> DataFrame:
    """(name, bytes) of the part files under ``path``, without reading any content."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes")
    )
