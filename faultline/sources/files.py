"""Folders of the file system that a path names, through Hadoop, so that any store of the cluster works."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, target):
    return target.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return _file_system(spark, target).exists(target)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """What a folder holds, by one listing."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [status.getPath().getName() for status in _file_system(spark, root).listStatus(root)]


def glob_folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders that match a pattern, by one call."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return [status.getPath().toString() for status in _file_system(spark, target).globStatus(target) or () if status.isDirectory()]


def delete_folders(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        _file_system(spark, target).delete(target, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file of one file system; it is an error if that fails."""
    old, new = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    if not _file_system(spark, old).rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all."""
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    stream = _file_system(spark, part).create(part, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    move(spark, f"{path}.part", path)


def read_text(spark: SparkSession, path: str) -> str:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = _file_system(spark, target).open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
