"""Hadoop FileSystem helpers (work for local, HDFS, S3A, ... paths).

Only metadata work happens here: existence checks, listing and deleting of
versions.  Data is always read by Spark's own sources."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

CALLS = 32  # calls to a file system at a time


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm  # py4j gateway to the Hadoop client


def _fs_path(spark: SparkSession, path: str):
    jvm = _jvm(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, p


def existing(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """The paths that exist, with the raw (still percent-encoded) path of their
    qualified URI, which equals ``parse_url(_metadata.file_path, 'PATH')`` for
    the same file.  Many are looked up at a time."""
    def look(path: str) -> str | None:
        fs, p = _fs_path(spark, path)
        return fs.makeQualified(p).toUri().getRawPath() if fs.exists(p) else None

    distinct = list(dict.fromkeys(paths))
    with ThreadPoolExecutor(CALLS) as pool:
        return {p: raw for p, raw in zip(distinct, pool.map(look, distinct)) if raw is not None}


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def subfolders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """Folders directly under ``path`` whose name begins with ``prefix``."""
    fs, p = _fs_path(spark, path)
    return sorted(str(f.getPath().toUri()) for f in fs.listStatus(p)
                  if f.isDirectory() and f.getPath().getName().startswith(prefix))
