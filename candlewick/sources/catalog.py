"""Catalog tables as versions: replace-table sink, publishing, vacuum, views,
discovery and existence checks.

A table ``db.t`` is a catalog view of its current version, a Parquet table
``db__versions.t__<stamp>_<id>`` with a folder of its own.  Writing makes a new
version that nobody reads yet; publishing points the view at it in one catalog
call, also where the columns change.  Versions stay until :func:`vacuum`, so a
query that was planned before keeps its files to its end, and what was
published before can be published again.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.sources import fs

VERSIONS = "__versions"  # suffix of the database that holds the versions
STAMP = "%Y%m%d%H%M%S%f"
PROPERTY = "candlewick.version"  # of a view: the version that it shows


def quoted(name: str) -> str:
    """``db.table`` with both parts quoted."""
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{loc}")


def _split(spark: SparkSession, name: str) -> tuple[str, str]:
    db, _, tbl = name.rpartition(".")
    return db or spark.catalog.currentDatabase(), tbl


@dataclass(frozen=True)
class Version:
    """A written version of the table ``table``; ``name`` is its own."""
    table: str
    name: str

    @property
    def written(self) -> dt.datetime:
        stamp = self.name.rsplit("__", 1)[1].rsplit("_", 1)[0]
        return dt.datetime.strptime(stamp, STAMP).replace(tzinfo=dt.timezone.utc)


def write_version(df: DataFrame, name: str, sort_within: Sequence[str] | None = None,
                  location: str | None = None, bucket_by: tuple[str, int] | None = None) -> Version:
    """Write ``df`` as a version of ``db.table`` that no reader of the table
    sees.  Its folder lies under ``location`` (by default that of the
    database); a failed write leaves none.  ``sort_within`` orders rows inside
    each file so Parquet min/max statistics prune ranges; ``bucket_by`` (column,
    buckets) stores the rows of a key together, so joins, groups and windows on
    it need no shuffle (a key with most of the rows is then one file: range
    partition before instead)."""
    spark = df.sparkSession
    db, tbl = _split(spark, name)
    ensure_database(spark, db)
    ensure_database(spark, db + VERSIONS)
    own = f"{tbl}__{dt.datetime.now(dt.timezone.utc).strftime(STAMP)}_{uuid.uuid4().hex[:8]}"
    base = location or spark.catalog.getDatabase(quoted(db)).locationUri
    path = f"{base.rstrip('/')}/{tbl}/{own.removeprefix(tbl + '__')}"
    try:
        if bucket_by:
            column, buckets = bucket_by
            # a task per bucket, so that a bucket is one file, in order
            out = df.repartition(buckets, column).write.bucketBy(buckets, column)
            out = out.sortBy(*(sort_within or [column]))
        else:
            out = (df.sortWithinPartitions(*sort_within) if sort_within else df).write
        out.format("parquet").option("path", path).saveAsTable(quoted(f"{db}{VERSIONS}.{own}"))
    except Exception:
        fs.delete(spark, path)
        raise
    return Version(f"{db}.{tbl}", f"{db}{VERSIONS}.{own}")


def publish(spark: SparkSession, *versions: Version) -> None:
    """Show each version under its table's name: one catalog call a table, in
    the order given."""
    for v in versions:
        spark.sql(f"CREATE OR REPLACE VIEW {quoted(v.table)} TBLPROPERTIES ('{PROPERTY}' = '{v.name}') "
                  f"AS SELECT * FROM {quoted(v.name)}")


def write_table(df: DataFrame, name: str, sort_within: Sequence[str] | None = None,
                location: str | None = None, **kw) -> str:
    """Replace the contents of table ``db.table`` with ``df``: a new version,
    published.  A reader sees the old rows or the new ones, a running query the
    version that it was planned on; a failed write leaves the table as it was."""
    publish(df.sparkSession, write_version(df, name, sort_within, location, **kw))
    return name


def current(spark: SparkSession, name: str) -> Version | None:
    """The version that the table shows; None if there is no such table."""
    db, tbl = _split(spark, name)
    table = f"{db}.{tbl}"
    if not spark.catalog.tableExists(quoted(table)):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").where(F.col("key") == PROPERTY).collect()
    return Version(table, rows[0]["value"]) if rows else None


def versions(spark: SparkSession, name: str) -> list[Version]:
    """The versions of a table that are there, oldest first."""
    db, tbl = _split(spark, name)
    if not spark.catalog.databaseExists(quoted(db + VERSIONS)):
        return []
    found = [t.name for t in spark.catalog.listTables(quoted(db + VERSIONS))]
    own = [Version(f"{db}.{tbl}", f"{db}{VERSIONS}.{t}") for t in found if t.rsplit("__", 1)[0] == tbl]
    return sorted(own, key=lambda v: v.name)


def vacuum(spark: SparkSession, name: str, older_than: dt.timedelta, keep: int = 1) -> list[Version]:
    """Delete the versions of a table that were written longer ago than
    ``older_than``, but never the one shown nor the ``keep`` newest.
    ``older_than`` is to exceed the longest query.  Returns what is gone."""
    there = versions(spark, name)
    shown = current(spark, name)
    until = dt.datetime.now(dt.timezone.utc) - older_than
    gone = [v for v in there[:len(there) - keep if keep else None] if v != shown and v.written < until]
    for v in gone:
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(v.name)}").where("col_name = 'Location'").collect()
        spark.sql(f"DROP TABLE IF EXISTS {quoted(v.name)}")
        for r in rows:
            fs.delete(spark, r["data_type"])
    return gone


def create_view(df: DataFrame, name: str) -> str:
    """Lazy view of this session (recomputed on read)."""
    df.createOrReplaceTempView(name)
    return name


def create_sql_view(spark: SparkSession, name: str, sql: str) -> str:
    """Lazy view ``db.name`` of the catalog, which other sessions read, too: a
    warehouse staging model.  Tables that it names are looked up when it is
    read, so it shows their current versions."""
    ensure_database(spark, _split(spark, name)[0])
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS {sql}")
    return name


def _databases(spark: SparkSession) -> list[str]:
    return sorted(d.name for d in spark.catalog.listDatabases() if not d.name.endswith(VERSIONS))


def list_tables(spark: SparkSession) -> DataFrame:
    """All (database, table) pairs of the catalog, distinct and sorted."""
    rows = [(db, t.name) for db in _databases(spark)
            for t in spark.catalog.listTables(quoted(db)) if not t.isTemporary]
    return (spark.createDataFrame(rows, "table_schema string, table_name string")
            .distinct().orderBy("table_schema", "table_name"))


def find_database(spark: SparkSession, table: str) -> str | None:
    """First database (by name) that holds ``table``; None if none does."""
    return next((db for db in _databases(spark) if spark.catalog.tableExists(quoted(f"{db}.{table}"))), None)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def scan(spark: SparkSession, name: str) -> DataFrame:
    """Table scan by name (catalog table, view or parquet path)."""
    if "/" in name:
        return spark.read.parquet(name)
    return spark.table(name)


def scan_versions(spark: SparkSession, written: Mapping[str, Version]) -> dict[str, DataFrame]:
    """Frames over versions, published or not."""
    return {key: spark.table(quoted(v.name)) for key, v in written.items()}


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))
