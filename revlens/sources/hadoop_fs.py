"""Small file operations on any file system that Spark can reach.

Spark reads and writes tables; what it lacks is to replace one file by another
in one step and to look at a folder without a job. Both go through the Hadoop file
system of the session, so a path may lie on HDFS, an object store or, in tests, a local disk.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import SparkSession


class Entry(NamedTuple):
    name: str
    is_dir: bool
    length: int
    modified: int  # milliseconds


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def _entry(status) -> Entry:
    return Entry(status.getPath().getName(), status.isDirectory(), status.getLen(), status.getModificationTime())


def stat(spark: SparkSession, path: str) -> Entry | None:
    fs, p = _fs(spark, path), _path(spark, path)
    return _entry(fs.getFileStatus(p)) if fs.exists(p) else None


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def entries(spark: SparkSession, folder: str) -> list[Entry]:
    """What lies directly in ``folder``; nothing if it does not exist."""
    fs, p = _fs(spark, folder), _path(spark, folder)
    return [_entry(s) for s in fs.listStatus(p)] if fs.exists(p) else []


def glob(spark: SparkSession, pattern: str) -> list[Entry]:
    return [_entry(s) for s in _fs(spark, pattern).globStatus(_path(spark, pattern)) or []]


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def replace(spark: SparkSession, source: str, target: str) -> None:
    """Rename the file ``source`` to ``target`` in one step. A file that
    ``target`` names before stays readable until then."""
    jvm = spark._jvm
    _fs(spark, target).mkdirs(_path(spark, target).getParent())
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        _path(spark, target).toUri(), spark._jsc.hadoopConfiguration()
    )
    fs = _fs(spark, target)
    context.rename(fs.makeQualified(_path(spark, source)), fs.makeQualified(_path(spark, target)), how)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file aside, then put it in place in one step."""
    folder, _, name = path.rpartition("/")
    aside = f"{folder}/_{name}.aside"
    stream = _fs(spark, aside).create(_path(spark, aside), True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    replace(spark, aside, path)
