"""Files wherever they lie: listing and small writes through Hadoop's file systems, streams through Arrow's."""

from __future__ import annotations

from collections.abc import Sequence
from typing import BinaryIO

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def matching(spark: SparkSession, patterns: str | Sequence[str]) -> list[str]:
    """The files that patterns name, in the order of their names; a pattern without a match gives none."""
    found: list[str] = []
    for pattern in [patterns] if isinstance(patterns, str) else patterns:
        fs, at = _fs(spark, pattern)
        found += [s.getPath().toString() for s in (fs.globStatus(at) or []) if s.isFile()]
    return sorted(found)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at) and fs.getFileStatus(at).isDirectory()


def write_text(spark: SparkSession, path: str, content: str) -> None:
    fs, at = _fs(spark, path)
    out = fs.create(at, True)
    out.write(bytearray(content, "utf-8"))
    out.close()


def move(spark: SparkSession, source: str, target: str) -> None:
    fs, at = _fs(spark, source)
    to = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.delete(to, False)
    if not fs.rename(at, to):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def opened(path: str) -> BinaryIO:
    """A stream of a file as a worker sees it; paths without a scheme are local."""
    if "://" not in path and not path.startswith("file:"):
        return open(path, "rb")
    from pyarrow import fs

    system, at = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return system.open_input_stream(at, compression=None)
