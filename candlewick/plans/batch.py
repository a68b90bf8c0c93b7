"""The daily batch: CSV files -> silver -> gate -> gold star -> checks.

Steps run as Spark jobs only at the table writes and checks; everything
between them is one lazy plan per table.  Every table is written as a new
version that nobody reads yet (which also cuts lineage: a lost executor
recomputes from the last written version); the gate and the declared checks
run on these versions, and only what passes is published.  A failing run
leaves the tables as they were.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators import enrich, quality, series, star
from candlewick.operators.clean import stage_sql
from candlewick.sources import catalog, csv_bars, literal
from candlewick.sources.spine import DEFAULT_HI, DEFAULT_LO, date_spine

# The silver gate's thresholds.
SILVER_GATE = {
    "ohlcv": {"tests": [{"min_rows": {"least": 100}}]},
    "coin_metadata": {"tests": [{"min_rows": {"least": 1}}]},
}


@dataclass
class BatchConfig:
    silver_db: str = "silver"
    gold_db: str = "gold"
    location: str | None = None  # shared folder for the table files
    calendar: tuple[dt.date, dt.date] = (DEFAULT_LO, DEFAULT_HI)
    windows: Mapping[str, int] = field(default_factory=lambda: dict(enrich.DEFAULT_WINDOWS))
    chunk_rows: int | str | None = series.AUTO
    strict_dates: bool = True
    date_format: str | Mapping[str, str] | None = None  # inferred where none is named
    gate: Mapping[str, Mapping] = field(default_factory=lambda: dict(SILVER_GATE))
    suite: Mapping[str, Mapping] = field(default_factory=lambda: dict(quality.STAR_SUITE))
    fact_buckets: int | None = None  # store the fact bucketed by asset, not by ranges


def utc_stamp(now: dt.datetime | None = None) -> str:
    now = now or dt.datetime.now(dt.timezone.utc)
    return now.strftime("%Y-%m-%dT%H:%M:%SZ")


def run_batch(spark: SparkSession, files: Mapping[str, str | Sequence[str]],
              metadata: DataFrame | Sequence[dict],
              cfg: BatchConfig | None = None, run_ts: str | None = None) -> dict:
    """Run the whole load; returns the published tables, the ingest report,
    the check results and a function for the failing keys.  Raises on an empty load,
    a failed gate or a failing error-severity check, with some of its keys;
    then nothing of that step is published (warn-severity failures are
    reported)."""
    cfg = cfg or BatchConfig()
    run_ts = run_ts or utc_stamp()
    s, g = cfg.silver_db, cfg.gold_db
    steps: dict[str, float] = {}
    clock = [time.perf_counter()]

    def lap(name: str) -> None:
        now = time.perf_counter()
        steps[name] = round(now - clock[0], 3)
        clock[0] = now

    for db in (s, g):
        catalog.ensure_database(spark, db, f"{cfg.location}/{db}.db" if cfg.location else None)

    def write(df: DataFrame, table: str, **kw) -> catalog.Version:
        return catalog.write_version(df, table, location=cfg.location, **kw)

    def read(version: catalog.Version) -> DataFrame:
        return spark.table(catalog.quoted(version.name))

    # 1: bronze -> silver bars
    bars, plan = csv_bars.read_bars_csv(spark, files, run_ts, cfg.strict_dates,
                                        date_format=cfg.date_format)
    ohlcv = write(bars, f"{s}.ohlcv", sort_within=["coin_id", "date"])
    lap("load_ohlcv")

    # 2: metadata
    if isinstance(metadata, Sequence):
        metadata = literal.metadata_rows(spark, metadata, run_ts)
    coin_metadata = write(metadata, f"{s}.coin_metadata")
    lap("load_metadata")

    # 3: gate
    gate = quality.enforce(quality.run_suite(quality.declared(cfg.gate), {
        "ohlcv": read(ohlcv), "coin_metadata": read(coin_metadata)}))
    catalog.publish(spark, ohlcv, coin_metadata)
    silver, meta = spark.table(f"{s}.ohlcv"), spark.table(f"{s}.coin_metadata")
    report = csv_bars.ingest_report(silver, plan)
    lap("verify_silver")

    # 4: models
    catalog.create_sql_view(spark, f"{s}.stg_coin_prices", stage_sql(catalog.quoted(f"{s}.ohlcv")))
    enriched = write(enrich.enrich(spark.table(f"{s}.stg_coin_prices"), windows=cfg.windows,
                                   chunk_rows=cfg.chunk_rows), f"{s}.int_price_enriched")
    dim_asset = write(star.dim_asset(meta, F.current_timestamp()), f"{g}.dim_coin")
    lo, hi = cfg.calendar
    dim_date = write(star.dim_date(date_spine(spark, lo, hi)), f"{g}.dim_date")
    rows = star.fact_price(read(enriched), read(dim_asset), read(dim_date))
    if cfg.fact_buckets:
        fact = write(rows, f"{g}.fact_price_ohlcv", sort_within=["coin_sk", "date_id"],
                     bucket_by=("coin_sk", cfg.fact_buckets))
    else:
        # clustered by asset then day: row-group min/max statistics prune both
        # an asset filter (coin_sk = md5(id)) and a date_id range
        fact = write(rows.repartitionByRange("coin_sk", "date_id"), f"{g}.fact_price_ohlcv",
                     sort_within=["coin_sk", "date_id"])
    lap("build_models")

    # 5: tests, on what is written and not yet published
    suite = quality.declared(cfg.suite)
    tables = quality.star_tables(read(fact), read(dim_asset), read(dim_date))
    failing = lambda: quality.failing_rows(suite, tables)
    checks = quality.enforce(quality.run_suite(suite, tables), lambda: quality.sample_keys(failing()))
    catalog.publish(spark, enriched, dim_asset, dim_date, fact)
    lap("run_tests")
    return {
        "report": report,
        "gate": gate,
        "checks": checks,
        "failing": failing,
        "steps": steps,
        "tables": {name: spark.table(name) for name in (
            f"{s}.ohlcv", f"{s}.coin_metadata", f"{s}.int_price_enriched",
            f"{g}.dim_coin", f"{g}.dim_date", f"{g}.fact_price_ohlcv")},
    }


def vacuum(spark: SparkSession, cfg: BatchConfig, older_than: dt.timedelta, keep: int = 1) -> list[catalog.Version]:
    """Delete old versions of all tables of a batch; ``older_than`` is to
    exceed the longest query (see :func:`catalog.vacuum`)."""
    names = [f"{cfg.silver_db}.{t}" for t in ("ohlcv", "coin_metadata", "int_price_enriched")]
    names += [f"{cfg.gold_db}.{t}" for t in ("dim_coin", "dim_date", "fact_price_ohlcv")]
    return [v for n in names for v in catalog.vacuum(spark, n, older_than, keep)]
