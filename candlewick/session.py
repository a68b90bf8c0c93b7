"""Session helpers: a local session for tests/bench and the shared
scratch folder used to cut lineage or stage files."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from candlewick.sources import fs

# Settings the engine is designed for; a cluster session supplies its own.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "candlewick", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (one JVM, ``cores`` threads)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = "8g"
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/S3/...)
    folder and is used as is; without it this raises, as a folder of the
    driver's machine is not seen by the executors.  Only a local session
    (driver and executors in one process) gets a folder of its own.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver "
                               "and all executors share")
        d = tempfile.mkdtemp(prefix="candlewick-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the scratch paths made inside.  What is to outlast
    the block must have been written to a path made before it."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            fs.delete(spark, path)


def written(df, name: str, options: dict | None = None):
    """Write ``df`` as Parquet into the shared folder and read it back: a
    compressed copy that cuts the lineage and survives lost executors.
    ``options`` are those of the Parquet writer."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**(options or {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


