"""The few file operations that Spark's own reader and writer do not offer.

They go through Hadoop's FileSystem, so any path that Spark can read will do.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from urllib.parse import unquote

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(context._jsc.hadoopConfiguration())


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or any path that fits a glob, exists."""
    where, files = _open(spark, pattern)
    return bool(files.globStatus(where))


def delete_folder(spark: SparkSession, path: str) -> None:
    where, files = _open(spark, path)
    files.delete(where, True)


def subfolders(spark: SparkSession, path: str) -> Iterator[str]:
    where, files = _open(spark, path)
    for status in files.listStatus(where):
        if status.isDirectory():
            yield status.getPath().getName()


def file_names(spark: SparkSession, path: str) -> list[str]:
    where, files = _open(spark, path)
    return [s.getPath().getName() for s in files.listStatus(where) if s.isFile()]


def total_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """The size of files, given as Spark names them; each folder is listed once."""
    by_folder: dict[str, set[str]] = {}
    for path in paths:
        folder, _, name = unquote(path).rpartition("/")
        by_folder.setdefault(folder, set()).add(name)
    found = 0
    for folder, names in by_folder.items():
        where, files = _open(spark, folder)
        for status in files.listStatus(where):
            if status.getPath().getName() in names:
                found += status.getLen()
    return found


def mark(spark: SparkSession, path: str) -> None:
    """An empty file."""
    where, files = _open(spark, path)
    files.create(where, True).close()


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Move a file that may already have been copied whole."""
    old, files = _open(spark, source)
    new, _ = _open(spark, target)
    if files.exists(new):
        files.delete(old, False)
        return
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    old, files = _open(spark, source)
    new, _ = _open(spark, target)
    files.mkdirs(new.getParent())
    if not files.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")
