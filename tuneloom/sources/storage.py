"""Paths on the cluster's file system (any that Spark can reach)."""

from __future__ import annotations

import uuid
from typing import Iterator

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def is_file(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, path) and _fs(spark, path).getFileStatus(_path(spark, path)).isFile()


def children(spark: SparkSession, path: str) -> Iterator[str]:
    """Names directly below a folder, one by one, so that a caller may stop
    early in a folder of many files; none if it does not exist."""
    if path_exists(spark, path):
        listing = _fs(spark, path).listStatusIterator(_path(spark, path))
        while listing.hasNext():
            yield listing.next().getPath().getName()


def matching_names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the paths that fit a glob pattern; matched on the JVM's side."""
    found = _fs(spark, pattern).globStatus(_path(spark, pattern))
    return sorted(status.getPath().getName() for status in found or [])


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that fit a glob pattern."""
    found = _fs(spark, pattern).globStatus(_path(spark, pattern))
    return sorted(status.getPath().toString() for status in found or [])


def data_files(spark: SparkSession, path: str) -> Iterator[str]:
    """Data files of a folder and the folders in it, or the file itself, one by
    one, so that a caller may stop early. Names with _ or . in front are none."""
    fs = _fs(spark, path)
    status = fs.getFileStatus(_path(spark, path))
    if status.isFile():
        yield status.getPath().toString()
        return
    listing = fs.listStatusIterator(_path(spark, path))
    while listing.hasNext():
        inside = listing.next()
        if inside.getPath().getName()[0] in "_.":
            continue
        if inside.isFile():
            yield inside.getPath().toString()
        else:
            yield from data_files(spark, inside.getPath().toString())


def partition_folders(spark: SparkSession, path: str) -> bool:
    """Whether a folder (or one that fits a pattern) has folders named key=value."""
    return bool(matching_names(spark, f"{path.rstrip('/')}/*=*"))


def start_of(spark: SparkSession, path: str, size: int) -> str:
    """The first bytes of a file as text; a letter cut at the end is left out."""
    fs = _fs(spark, path)
    size = min(size, fs.getFileStatus(_path(spark, path)).getLen())
    stream = fs.open(_path(spark, path))
    try:
        data = spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream, size)
    finally:
        stream.close()
    return bytes(data).decode("utf-8-sig", "ignore")


def folder_bytes(spark: SparkSession, path: str) -> int:
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def delete(spark: SparkSession, path: str) -> None:
    _fs(spark, path).delete(_path(spark, path), True)


def promote(spark: SparkSession, staged: str, final: str) -> None:
    """Put a finished folder in its place. The old one is moved aside first and
    deleted last, so a crash never leaves neither."""
    fs = _fs(spark, final)
    old = f"{final}.old-{uuid.uuid4().hex}"
    fs.mkdirs(_path(spark, final).getParent())
    had_old = fs.exists(_path(spark, final))
    if had_old and not fs.rename(_path(spark, final), _path(spark, old)):
        raise OSError(f"cannot move {final} aside")
    if not fs.rename(_path(spark, staged), _path(spark, final)):
        if had_old:
            fs.rename(_path(spark, old), _path(spark, final))
        raise OSError(f"cannot move {staged} to {final}")
    if had_old:
        fs.delete(_path(spark, old), True)
