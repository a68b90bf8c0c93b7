"""Declarative data-quality checks.

Each check returns rows (check, table_name, column_name, failures,
severity) computed in one distributed pass; :func:`enforce` collects
only those few result rows and raises when an error-severity check
fails.  Severity ``warn`` reports without failing the run.  A suite of
checks is declared as data (:func:`declared`) and run in as few passes per
table as it needs (:func:`run_suite`); :func:`failing_rows` lists the keys
behind the counts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ERROR, WARN = "error", "warn"


class DataQualityError(RuntimeError):
    pass


def _result(df: DataFrame, check: str, table: str, column, failures, severity: str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(table).alias("table_name"),
                     (column if not isinstance(column, str) else F.lit(column))
                     .cast("string").alias("column_name"),
                     failures.cast("long").alias("failures"),
                     F.lit(severity).alias("severity"))


def not_null(df: DataFrame, columns: Sequence[str], table: str = "",
             severity: str = ERROR) -> DataFrame:
    """NULL count of every column, all fused into one aggregate."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = agg.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).alias("n")) for c in columns])).alias("kv"))
    return _result(long, "not_null", table, F.col("kv.c"), F.col("kv.n"), severity)


def unique(df: DataFrame, column: str, table: str = "", severity: str = ERROR) -> DataFrame:
    """Number of non-NULL values that occur more than once."""
    dup = (df.where(F.col(column).isNotNull()).groupBy(column).count()
           .where(F.col("count") > 1))
    return _result(dup.agg(F.count(F.lit(1)).alias("n")), "unique", table, column,
                   F.col("n"), severity)


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str,
                  table: str = "", severity: str = WARN) -> DataFrame:
    """Child rows whose non-NULL key has no parent row.

    The child is reduced to (key, rows) map-side before the anti join, so a
    key shared by a third of the child never forms one big join partition.
    """
    keys = (child.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("_rows")))
    parents = parent.select(F.col(parent_column).alias(column)).where(
        F.col(column).isNotNull()).distinct()
    orphans = keys.join(parents, column, "left_anti")
    return _result(orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("n")),
                   "relationships", table, column, F.col("n"), severity)


def min_rows(df: DataFrame, threshold: int, table: str = "", severity: str = ERROR) -> DataFrame:
    """1 failure when the table has fewer than ``threshold`` rows."""
    n = df.agg(F.count(F.lit(1)).alias("n"))
    return _result(n, "min_rows", table, F.lit(None),
                   F.when(F.col("n") < threshold, 1).otherwise(0), severity)


def null_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: total rows and the NULL count of each column."""
    return df.agg(F.count(F.lit(1)).alias("total"),
                  *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in columns])


def duplicate_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rows minus distinct ``a || '-' || b``; a NULL part makes the text
    NULL, which COUNT(DISTINCT) skips, so such rows count as duplicates."""
    key = F.concat(F.col(a).cast("string"), F.lit("-"), F.col(b).cast("string"))
    return df.agg((F.count(F.lit(1)) - F.countDistinct(key)).alias("duplicates"))


def combine(*results: DataFrame) -> DataFrame:
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def enforce(results: DataFrame, samples: Callable[[], Mapping[tuple, list]] | None = None) -> list[dict]:
    """Collect the (few) check rows; raise on a failing error check.
    ``samples`` gives keys for the message (see :func:`sample_keys`)."""
    rows = [r.asDict() for r in results.collect()]
    failed = [r for r in rows if r["failures"] and r["severity"] == ERROR]
    if failed:
        keys = samples() if samples else {}
        told = lambda r: keys.get((r["check"], r["table_name"], r["column_name"]))
        raise DataQualityError(
            "; ".join(f"{r['check']}({r['table_name']}.{r['column_name']}): {r['failures']}"
                      + (f" such as {told(r)}" if told(r) else "") for r in failed))
    return rows


# --------------------------------------------------------------------------
# declared suites
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class Check:
    """One declared test.  ``parent``: (table, column) of a relationship;
    ``least``: rows of a ``min_rows`` test."""
    kind: str
    table: str
    column: str | None = None
    parent: tuple[str, str] | None = None
    least: int = 0
    severity: str = ERROR


KINDS = ("not_null", "unique", "relationships", "min_rows")


def declared(suite: Mapping[str, Mapping]) -> list[Check]:
    """Checks of a declaration: table -> {"columns": {column: tests}, "tests":
    tests}.  A test is a name or a mapping {name: settings}; settings are
    ``severity`` and, for ``relationships``, ``to`` and ``field``, for
    ``min_rows``, ``least``.  Relationships warn unless told otherwise."""
    out = []
    for table, parts in suite.items():
        unknown = set(parts) - {"columns", "tests"}
        if unknown:
            raise ValueError(f"{table}: unknown entries {sorted(unknown)}")
        named = [(None, t) for t in parts.get("tests", ())]
        named += [(c, t) for c, tests in parts.get("columns", {}).items() for t in tests]
        for column, test in named:
            kind, given = (test, {}) if isinstance(test, str) else next(iter(test.items()))
            given = dict(given or {})
            if kind not in KINDS or (column is None) != (kind == "min_rows"):
                raise ValueError(f"{table}.{column}: no such test: {kind}")
            parent = (given.pop("to"), given.pop("field")) if kind == "relationships" else None
            check = Check(kind, table, column, parent, int(given.pop("least", 0)),
                          given.pop("severity", WARN if parent else ERROR))
            if given or check.severity not in (ERROR, WARN):
                raise ValueError(f"{table}.{column}: settings of {kind}: {test}")
            out.append(check)
    return out


def run_suite(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """Results (check, table_name, column_name, failures, severity) of declared
    checks.  A table is read once for all its row counts, NULL counts and
    relationships, and once per column that is to be unique, which counts the
    column's NULLs, too, if nothing else needs the first pass."""
    parts = []
    for table in dict.fromkeys(c.table for c in checks):
        own = [c for c in checks if c.table == table]
        keys = list(dict.fromkeys(c.column for c in own if c.kind == "unique"))
        rows = [c for c in own if c.kind != "unique"]
        if all(c.kind == "not_null" and c.column in keys for c in rows):
            by_key = {k: [c for c in own if c.column == k] for k in keys}
            rows = []
        else:
            by_key = {k: [c for c in own if c.column == k and c.kind == "unique"] for k in keys}
        parts += [_key_pass(tables[table], k, mine) for k, mine in by_key.items()]
        if rows:
            parts.append(_row_pass(tables[table], rows, tables))
    return combine(*parts)


def _cells(one: DataFrame, checks: Sequence[Check], failures: Sequence[Column]) -> DataFrame:
    """Result rows of the one row ``one``."""
    cells = F.array(*[F.struct(
        F.lit(c.kind).alias("check"), F.lit(c.table).alias("table_name"),
        F.lit(c.column).cast("string").alias("column_name"), n.cast("long").alias("failures"),
        F.lit(c.severity).alias("severity")) for c, n in zip(checks, failures)])
    return one.select(F.explode(cells).alias("k")).select("k.*")


def _key_pass(df: DataFrame, column: str, checks: Sequence[Check]) -> DataFrame:
    per = df.groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("_rows"))
    one = per.agg(F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_rows"))), F.lit(0)).alias("not_null"),
                  F.count_if(F.col("_key").isNotNull() & (F.col("_rows") > 1)).alias("unique"))
    return _cells(one, checks, [F.col(c.kind) for c in checks])


def _row_pass(df: DataFrame, checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    columns = dict.fromkeys(c.column for c in checks if c.column is not None)
    rows = df.select(*columns) if columns else df.select(F.lit(1).alias("_one"))
    fails = []
    for k, c in enumerate(checks):
        if c.kind == "relationships":
            keys = _parent_keys(c, tables).withColumnRenamed("_parent", f"_p{k}")
            rows = rows.join(keys, F.col(c.column) == F.col(f"_p{k}"), "left")
            fails.append(F.count_if(F.col(c.column).isNotNull() & F.col(f"_p{k}").isNull()))
        elif c.kind == "not_null":
            fails.append(F.count_if(F.col(c.column).isNull()))
        else:
            fails.append(F.when(F.count(F.lit(1)) < c.least, 1).otherwise(0))
    one = rows.agg(*[f.alias(f"_f{k}") for k, f in enumerate(fails)])
    return _cells(one, checks, [F.col(f"_f{k}") for k in range(len(checks))])


def _parent_keys(check: Check, tables: Mapping[str, DataFrame]) -> DataFrame:
    table, column = check.parent
    return tables[table].select(F.col(column).alias("_parent")).where("_parent IS NOT NULL").distinct()


FAILING = "check string, table_name string, column_name string, severity string, key string, rows bigint"


def failing_rows(checks: Sequence[Check], tables: Mapping[str, DataFrame]) -> DataFrame:
    """What fails, one row per check and key: the keys that occur more than
    once, the keys without a parent, NULL (key NULL) with the rows that have
    it, and for ``min_rows`` the rows there are.  Keys are text.  A table's
    rows are reduced to (key, rows) map-side before anything is joined."""
    parts = []
    for c in checks:
        df = tables[c.table]
        if c.kind == "min_rows":
            bad = df.agg(F.lit(None).cast("string").alias("key"), F.count(F.lit(1)).alias("rows")).where(
                F.col("rows") < c.least)
        else:
            bad = df.groupBy(F.col(c.column).alias("_key")).agg(F.count(F.lit(1)).alias("rows"))
            if c.kind == "not_null":
                bad = bad.where("_key IS NULL")
            elif c.kind == "unique":
                bad = bad.where("_key IS NOT NULL AND rows > 1")
            else:
                bad = bad.where("_key IS NOT NULL").join(
                    _parent_keys(c, tables), F.col("_key") == F.col("_parent"), "left_anti")
            bad = bad.select(F.col("_key").cast("string").alias("key"), "rows")
        parts.append(bad.select(
            F.lit(c.kind).alias("check"), F.lit(c.table).alias("table_name"),
            F.lit(c.column).cast("string").alias("column_name"), F.lit(c.severity).alias("severity"),
            "key", "rows"))
    return combine(*parts)


def sample_keys(failing: DataFrame, per_check: int = 5) -> dict[tuple, list[str | None]]:
    """(check, table, column) -> its first failing keys by rows and key: a
    sample for messages; the table of :func:`failing_rows` has all."""
    order = Window.partitionBy("check", "table_name", "column_name").orderBy(F.desc("rows"), "key")
    top = failing.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_check)
    out: dict[tuple, list[str | None]] = {}
    for r in top.orderBy("check", "table_name", "column_name", "_n").collect():
        out.setdefault((r["check"], r.table_name, r.column_name), []).append(r.key)
    return out


# The thirteen declared tests of the warehouse star schema.
STAR_SUITE = {
    "fact_price_ohlcv": {"columns": {
        "price_sk": ["unique", "not_null"],
        "coin_sk": ["not_null", {"relationships": {"to": "dim_coin", "field": "coin_sk"}}],
        "date_id": ["not_null", {"relationships": {"to": "dim_date", "field": "date_id"}}],
        "close_price": ["not_null"]}},
    "dim_coin": {"columns": {"coin_sk": ["unique", "not_null"], "coin_id": ["unique", "not_null"]}},
    "dim_date": {"columns": {"date_id": ["unique", "not_null"]}},
}


def star_tables(fact: DataFrame, dim_asset: DataFrame, dim_date: DataFrame) -> dict[str, DataFrame]:
    return {"fact_price_ohlcv": fact, "dim_coin": dim_asset, "dim_date": dim_date}


def star_checks(fact: DataFrame, dim_asset: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Results of ``STAR_SUITE``."""
    return run_suite(declared(STAR_SUITE), star_tables(fact, dim_asset, dim_date))
