"""Registered queries: name -> (spark, sf_dir) -> DataFrame, each paired
(where SQL can state it) with DuckDB SQL over the same driver tables.

Every query reads the driver tables (or data Spark derives from them)
in full; inputs that need files (CSV round trips, table sinks) are
written to the session's shared scratch folder first.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions import round_away
from candlewick.operators import clean, enrich, quality, serve, series, star, stats
from candlewick.plans import oracle_sql as O
from candlewick.plans.star_build import Warehouse, fixture_calendar, main_warehouse, sparse_warehouse
from candlewick.session import scratch_path, written
from candlewick.sources import catalog, csv_bars, fixtures, literal
from candlewick.sources.spine import spine_from_bounds

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

# Parameters of the registered queries.
RUN_TS = "2024-01-01T00:00:00Z"
VIEW_ASSET = "N"
SLICE_ASSET, SLICE_YEAR, SLICE_MONTH = "A", 1998, 7
MISSING_ASSET = "ZZZ"
SPARSE_SYMBOLS = ["P1", "P2", "P3", "P4", "P5"]
PRICE_COLUMNS = ["open_price", "high_price", "low_price", "close_price", "daily_return_pct"]


def _dates_as_timestamps(df: DataFrame) -> DataFrame:
    """Calendar dates leave as midnight TIMESTAMP_NTZ, which converts to the
    same Python/pandas value as the oracle's TIMESTAMP whichever way a
    result is fetched (a DATE does not)."""
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in dates}) if dates else df


def ts(sql: str, *cols: str) -> str:
    """Oracle side of :func:`_dates_as_timestamps` for the named columns."""
    casts = ", ".join(f"CAST({c} AS TIMESTAMP) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({casts}) FROM ({sql}) AS q"


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def query(spark: SparkSession, sf: str) -> DataFrame:
            return _dates_as_timestamps(fn(spark, sf))
        query.__doc__, query.__name__ = fn.__doc__, getattr(fn, "__name__", name)
        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _tables(spark, sf) -> fixtures.Tables:
    return fixtures.Tables(spark, sf)


def _dirty_warehouse(spark, sf) -> Warehouse:
    """Warehouse over the raw dirty bars (duplicates kept: quality checks)."""
    t = _tables(spark, sf)
    return Warehouse(fixtures.bars_dirty(t), fixtures.asset_meta(t), fixture_calendar(t))


def _dirty_silver_warehouse(spark, sf) -> Warehouse:
    """Warehouse over deduplicated dirty bars: unique (asset, date) like a
    loaded silver table, NULL prices and swapped bars still present."""
    t = _tables(spark, sf)
    silver = clean.dedup(fixtures.bars_dirty(t), ["coin_id", "date"])
    return Warehouse(silver, fixtures.asset_meta(t), fixture_calendar(t))


# --------------------------------------------------------------------------
# sources and sinks
# --------------------------------------------------------------------------

def _csv_files(spark, sf, dirt: bool = False, layouts=None) -> dict:
    t = _tables(spark, sf)
    return csv_bars.write_bars_csv(
        fixtures.text_bars(fixtures.bars(t), dirt), scratch_path(spark, "bars-csv"),
        layouts or fixtures.csv_layouts(), fixtures.csv_layout_of())


def _csv_round_trip(spark, sf, dirt: bool = False):
    return csv_bars.read_bars_csv(spark, _csv_files(spark, sf, dirt), RUN_TS)


_LOCAL_BARS = O.BARS.replace("'lineitem' AS source", "'local_csv' AS source")

register("src_csv_bars", O.with_(_LOCAL_BARS) + "SELECT * FROM bars")(
    lambda spark, sf: _csv_round_trip(spark, sf, dirt=False)[0])

register("clean_coerce", O.with_(_LOCAL_BARS) + """
SELECT * FROM bars
WHERE date_diff('day', DATE '1995-01-01', CAST(date AS DATE)) % 17 <> 0
  AND date_diff('day', DATE '1995-01-01', CAST(date AS DATE)) % 23 <> 0
  AND date_diff('day', DATE '1995-01-01', CAST(date AS DATE)) % 101 <> 0""")(
    lambda spark, sf: _csv_round_trip(spark, sf, dirt=True)[0])


@register("ingest_report", O.with_(O.BARS) + f"""
SELECT coin_id, 'loaded' AS status, NULL AS detail, count(*) AS rows, min(date) AS first_date,
       max(date) AS last_date
FROM bars GROUP BY coin_id
UNION ALL SELECT '{MISSING_ASSET}', 'missing', '/absent.csv', 0, NULL, NULL
UNION ALL SELECT 'NOCLOSE', 'missing_columns', 'missing columns [''close''] in /noclose', 0, NULL, NULL
UNION ALL SELECT 'REJECTED', 'loaded', NULL, 0, NULL, NULL""")
def q_ingest_report(spark, sf):
    """Loaded, missing, without a column, and with no row that survives."""
    base = scratch_path(spark, "odd-csv")
    bars = fixtures.text_bars(fixtures.bars(_tables(spark, sf)))
    price = F.col("open_text")
    bars.select(F.col("date_text").alias("Date"), price.alias("Open"), price.alias("High"),
                price.alias("Low")).write.option("header", True).csv(f"{base}/noclose")
    bars.select(F.col("date_text").alias("Date"), *[F.lit("n/a").alias(c) for c in (
        "Open", "High", "Low", "Close")]).write.option("header", True).csv(f"{base}/rejected")
    silver, plan = csv_bars.read_bars_csv(spark, {
        **_csv_files(spark, sf), MISSING_ASSET: f"{base}/absent.csv", "NOCLOSE": f"{base}/noclose",
        "REJECTED": f"{base}/rejected"}, RUN_TS)
    report = csv_bars.ingest_report(written(silver, "silver"), plan)
    return report.withColumn("detail", F.replace("detail", F.lit(base), F.lit("")))


@register("src_us_dates", O.with_(_LOCAL_BARS) + "SELECT * FROM bars")
def q_src_us_dates(spark, sf):
    """Dates as MM/dd/yyyy in every file; the format is inferred."""
    us = F.date_format(F.to_date("date"), "MM/dd/yyyy")
    layouts = [[(h, us if "date" in h.lower() else c) for h, c in layout]
               for layout in fixtures.csv_layouts()]
    return csv_bars.read_bars_csv(spark, _csv_files(spark, sf, layouts=layouts), RUN_TS)[0]


@register("src_mixed_layouts", O.with_(_LOCAL_BARS) + "SELECT * FROM bars")
def q_src_mixed_layouts(spark, sf):
    """Files of three layouts in every asset's folder, told apart by each
    file's own header: one begins with a column without a name, one has the
    prices in another order, one has its dates as MM/dd/yyyy."""
    bars = fixtures.text_bars(fixtures.bars(_tables(spark, sf)))
    base = scratch_path(spark, "mixed-csv")
    folders: dict[str, str] = {}
    for k, layout in enumerate(fixtures.mixed_layouts()):
        mine = csv_bars.write_bars_csv(bars.where(fixtures.mixed_layout_of() == k), base, [layout],
                                       F.lit(0), mode="append")
        folders.update({a: p[0] for a, p in mine.items()})
    return csv_bars.read_bars_csv(spark, folders, RUN_TS)[0]


@register("src_header_map", O.with_(O.BARS) + """
SELECT h.*, n AS rows FROM (VALUES
  ('A', 0, 'close', 'close'), ('A', 1, 'open', 'open'), ('A', 2, 'low', 'low'),
  ('A', 3, 'high', 'high'), ('A', 4, 'Trade Date', 'date'),
  ('N', 3, 'Date', 'date'), ('N', 4, 'High', 'high'), ('N', 5, 'Low', 'low'),
  ('N', 6, 'Open', 'open'), ('N', 7, 'Close', 'close'),
  ('R', 0, ' Date ', 'date'), ('R', 1, 'OPEN', 'open'), ('R', 2, 'HIGH', 'high'),
  ('R', 3, 'LOW', 'low'), ('R', 4, 'CLOSE', 'close')
) AS h(coin_id, position, header, target)
JOIN (SELECT coin_id, count(*) AS n FROM bars GROUP BY coin_id) USING (coin_id)""")
def q_src_header_map(spark, sf):
    """The mapped columns of each asset's files beside the rows read by them."""
    silver, plan = _csv_round_trip(spark, sf)
    rows = [(asset, pos, header[pos], target) for (header, _), paths in plan["groups"].items()
            for _, asset in paths for pos, target in csv_bars.header_map(header)[0].items()]
    maps = spark.createDataFrame(rows, "coin_id string, position int, header string, target string")
    return maps.join(silver.groupBy("coin_id").agg(F.count(F.lit(1)).alias("rows")), "coin_id")


register("src_metadata_rows", O.with_(O.META) + "SELECT * FROM meta")(
    lambda spark, sf: fixtures.asset_meta(_tables(spark, sf)))

LITERAL_ASSETS = [{"coin_id": "A", "symbol": "AAA", "name": "Accepted", "categories": "['x']"},
                  {"coin_id": "N", "symbol": "NNN", "name": "None", "extracted_at": "2023-05-06T07:08:09Z"},
                  {"coin_id": "Q", "symbol": "QQQ", "name": "Without bars"}]


@register("src_literal_rows", O.with_(O.BARS) + f"""
SELECT m.coin_id, symbol, name, categories, genesis_date, hashing_algorithm, extracted_at,
       count(date) AS bars, max(high) AS top
FROM (VALUES ('A', 'AAA', 'Accepted', '[''x'']', '{RUN_TS}'), ('N', 'NNN', 'None', NULL, '2023-05-06T07:08:09Z'),
             ('Q', 'QQQ', 'Without bars', NULL, '{RUN_TS}')) AS m(coin_id, symbol, name, categories, extracted_at)
CROSS JOIN (SELECT CAST(NULL AS VARCHAR) AS genesis_date, CAST(NULL AS VARCHAR) AS hashing_algorithm)
LEFT JOIN (SELECT coin_id, date, high FROM bars) b ON b.coin_id = m.coin_id GROUP BY ALL""")
def q_src_literal_rows(spark, sf):
    meta = literal.metadata_rows(spark, LITERAL_ASSETS, RUN_TS)
    per = (fixtures.bars(_tables(spark, sf)).groupBy("coin_id")
           .agg(F.count(F.lit(1)).alias("bars"), F.max("high").alias("top")))
    return meta.join(per, "coin_id", "left").withColumn("bars", F.coalesce("bars", F.lit(0)))


register("src_date_spine", O.with_(O.SPINE) + "SELECT * FROM spine")(
    lambda spark, sf: fixture_calendar(_tables(spark, sf)))


@register("src_table_scan", O.with_(O.BARS) + "SELECT * FROM bars")
def q_src_table_scan(spark, sf):
    path = scratch_path(spark, "silver-ohlcv")
    fixtures.bars(_tables(spark, sf)).write.mode("overwrite").parquet(path)
    catalog.create_view(catalog.scan(spark, path), "cw_silver_ohlcv")
    return spark.sql("SELECT * FROM cw_silver_ohlcv")


@register("sink_replace_table", O.with_(O.BARS) + "SELECT * FROM bars")
def q_sink_replace_table(spark, sf):
    loc = scratch_path(spark, "warehouse")
    catalog.ensure_database(spark, "cw_silver", loc)
    t = _tables(spark, sf)
    # written twice: the second write replaces other real rows
    catalog.write_table(fixtures.bars_sparse(t), "cw_silver.ohlcv", location=loc)
    catalog.write_table(fixtures.bars(t), "cw_silver.ohlcv", location=loc, sort_within=["coin_id", "date"])
    return spark.table("cw_silver.ohlcv")


@register("sink_versions", O.with_(O.BARS, O.BARS_SPARSE) + """
SELECT 'before' AS seen, * FROM bars_sparse UNION ALL SELECT 'after', * FROM bars""")
def q_sink_versions(spark, sf):
    """A query planned before a table is replaced keeps the rows that it was
    planned on, also where another set of columns stood there before."""
    loc, t = scratch_path(spark, "versions"), _tables(spark, sf)
    catalog.ensure_database(spark, "cw_versions", loc)
    catalog.write_table(fixtures.asset_meta(t), "cw_versions.ohlcv", location=loc)
    catalog.write_table(fixtures.bars_sparse(t), "cw_versions.ohlcv", location=loc)
    before = spark.table("cw_versions.ohlcv")
    catalog.write_table(fixtures.bars(t), "cw_versions.ohlcv", location=loc)
    catalog.vacuum(spark, "cw_versions.ohlcv", dt.timedelta(0), keep=2)
    return clean.union_all([df.select(F.lit(seen).alias("seen"), "*") for seen, df in (
        ("before", before), ("after", spark.table("cw_versions.ohlcv")))])


@register("staging_view", ts(O.with_(O.BARS, O.BARS_DIRTY, O.stg("bars_dirty")) + "SELECT * FROM stg", "price_date"))
def q_staging_view(spark, sf):
    """The staging view of the catalog, read by another session after the
    table under it was replaced."""
    loc, t = scratch_path(spark, "staging"), _tables(spark, sf)
    catalog.ensure_database(spark, "cw_staging", loc)
    catalog.write_table(fixtures.bars(t), "cw_staging.ohlcv", location=loc)
    catalog.create_sql_view(spark, "cw_staging.stg_coin_prices", clean.stage_sql("cw_staging.ohlcv"))
    catalog.write_table(fixtures.bars_dirty(t), "cw_staging.ohlcv", location=loc)
    return spark.newSession().table("cw_staging.stg_coin_prices")


def _discovery(spark, sf) -> str:
    """Two tables in a database of this query's own."""
    db = "cw_found"
    loc = scratch_path(spark, db)
    catalog.ensure_database(spark, db, loc)
    t = _tables(spark, sf)
    catalog.write_table(fixtures.bars(t), f"{db}.found_bars", location=loc)
    catalog.write_table(fixtures.asset_meta(t), f"{db}.found_meta", location=loc)
    return db


@register("catalog_tables", O.with_(O.BARS, O.META) + """
SELECT 'cw_found' AS table_schema, 'found_bars' AS table_name, count(*) AS row_count FROM bars
UNION ALL SELECT 'cw_found', 'found_meta', count(*) FROM meta""")
def q_catalog_tables(spark, sf):
    """Tables of a database, discovered in the catalog, with their row counts."""
    db = _discovery(spark, sf)
    names = catalog.list_tables(spark).where(F.col("table_schema") == db)
    counts = [catalog.row_count(spark.table(f"{db}.{r.table_name}")).withColumn("_t", F.lit(r.table_name))
              for r in names.collect()]
    return names.join(clean.union_all(counts), F.col("table_name") == F.col("_t")).drop("_t")


@register("catalog_lookup", O.with_(O.BARS) + """
SELECT 'found_bars' AS table_name, 'cw_found' AS database, true AS present, count(*) AS row_count FROM bars
UNION ALL SELECT 'never_written', NULL, false, 0""")
def q_catalog_lookup(spark, sf):
    """First database that holds a table, whether it is there, and its rows."""
    db = _discovery(spark, sf)
    rows = [(n, catalog.find_database(spark, n), catalog.table_exists(spark, f"{db}.{n}"))
            for n in ("found_bars", "never_written")]
    found = spark.createDataFrame(rows, "table_name string, database string, present boolean")
    count = catalog.row_count(spark.table(f"{db}.found_bars")).withColumn("_t", F.lit("found_bars"))
    return (found.join(count, F.col("table_name") == F.col("_t"), "left").drop("_t")
            .withColumn("row_count", F.coalesce("row_count", F.lit(0))))


# --------------------------------------------------------------------------
# union, dedup, distinct
# --------------------------------------------------------------------------

register("union_bars", O.with_(O.BARS, O.BARS_SPARSE)
         + "SELECT * FROM bars UNION ALL SELECT * FROM bars_sparse")(
    lambda spark, sf: clean.union_all([fixtures.bars(_tables(spark, sf)),
                                       fixtures.bars_sparse(_tables(spark, sf))]))

register("dedup_bars", O.with_(O.BARS, O.BARS_DIRTY) + """
SELECT date, d.open, d.high, d.low, d.close, coin_id, d.source, d.extracted_at FROM (
  SELECT coin_id, date,
         arg_min(struct_pack(open, high, low, close, source, extracted_at),
                 row(open, high, low, close, source, extracted_at)) AS d
  FROM bars_dirty GROUP BY coin_id, date)""")(
    lambda spark, sf: clean.dedup(fixtures.bars_dirty(_tables(spark, sf)), ["coin_id", "date"]))

_LINE_REST = ("l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
              "l_returnflag, l_linestatus, l_shipdate")
register("dedup_lines", f"""
SELECT l_orderkey, d.l_partkey, d.l_suppkey, l_linenumber, d.l_quantity, d.l_extendedprice,
       d.l_discount, d.l_tax, d.l_returnflag, d.l_linestatus, d.l_shipdate
FROM (SELECT l_orderkey, l_linenumber, arg_min(struct_pack({_LINE_REST}), row({_LINE_REST})) AS d
      FROM lineitem GROUP BY l_orderkey, l_linenumber)""")(
    lambda spark, sf: clean.dedup(_tables(spark, sf).lineitem, ["l_orderkey", "l_linenumber"]))

register("distinct_pairs", O.with_(O.BARS, O.BARS_DIRTY)
         + "SELECT DISTINCT coin_id, date FROM bars_dirty")(
    lambda spark, sf: fixtures.bars_dirty(_tables(spark, sf)).select("coin_id", "date").distinct())


# --------------------------------------------------------------------------
# staging flags and filter (dirty bars)
# --------------------------------------------------------------------------

_DIRTY_STG = O.with_(O.BARS, O.BARS_DIRTY, O.stg("bars_dirty"))

register("clean_prices", _DIRTY_STG + "SELECT * FROM stg")(
    lambda spark, sf: _dirty_warehouse(spark, sf).staged)

register("flag_null_price", _DIRTY_STG + "SELECT * FROM stg WHERE has_null_price")(
    lambda spark, sf: _dirty_warehouse(spark, sf).staged.where("has_null_price"))

register("flag_invalid_bar", _DIRTY_STG + "SELECT * FROM stg WHERE is_invalid_ohlc")(
    lambda spark, sf: _dirty_warehouse(spark, sf).staged.where("is_invalid_ohlc"))

register("filter_valid_bars", _DIRTY_STG
         + "SELECT * FROM stg WHERE NOT has_null_price AND NOT is_invalid_ohlc")(
    lambda spark, sf: clean.filter_valid_bars(_dirty_warehouse(spark, sf).staged))


# --------------------------------------------------------------------------
# measures and windows (dirty bars: windows count surviving rows only)
# --------------------------------------------------------------------------

_DIRTY_ENR = O.with_(O.BARS, O.BARS_DIRTY, O.SILVER_DIRTY, O.stg("silver_dirty"),
                     O.enriched("stg"))


def _measure(col):
    def q(spark, sf):
        return _dirty_silver_warehouse(spark, sf).enriched.select("coin_id", "price_date", col)
    return q


for _key, _col in [("daily_range", "daily_range"), ("daily_return", "daily_return_pct"),
                   ("price_change", "price_change"), ("moving_avg_7", "ma_7d"),
                   ("moving_avg_30", "ma_30d")]:
    register(_key, _DIRTY_ENR + f"SELECT coin_id, price_date, {_col} FROM enriched")(_measure(_col))

register("enriched_prices", _DIRTY_ENR + "SELECT * FROM enriched")(
    lambda spark, sf: _dirty_silver_warehouse(spark, sf).enriched)


@register("enriched_plain_window", _DIRTY_ENR + "SELECT * FROM enriched")
def q_enriched_plain(spark, sf):
    """Same result through one plain window per asset (no chunking)."""
    w = _dirty_silver_warehouse(spark, sf)
    return enrich.enrich(w.staged, chunk_rows=None)


@register("enriched_small_chunks", _DIRTY_ENR + "SELECT * FROM enriched")
def q_enriched_small_chunks(spark, sf):
    """Same result with 64-row chunks: every asset is split many times,
    exercising the halo rows."""
    w = _dirty_silver_warehouse(spark, sf)
    return enrich.enrich(w.staged, chunk_rows=64)


@register("events_moving_avg", """
SELECT event_type, event_id, ts, round(value - lag(value) OVER w, 8) AS change,
       round(avg(value) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 8) AS ma_7
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""")
def q_events_moving_avg(spark, sf):
    """Row windows over a timestamp order: few keys, so each is cut into
    chunks (of 500 rows here, so that small tables have several)."""
    ev = _tables(spark, sf).events.select("event_type", "event_id", "ts", "value")

    def columns(w):
        return {"change": round_away(F.col("value") - F.lag("value").over(w), 8),
                "ma_7": round_away(F.avg("value").over(w.rowsBetween(-6, 0)), 8)}
    return (series.series_window(ev, ["event_type"], ["ts", "event_id"], 6, columns, chunk_rows=500)
            .select("event_type", "event_id", "ts", "change", "ma_7"))


@register("events_long_frames", """
SELECT event_type, event_id, ts, sum(cents) OVER long / count(cents) OVER long AS ma_1000,
       count(cents) OVER long AS n_1000, min(cents) OVER mid AS low_365, max(cents) OVER mid AS high_365
FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events)
WINDOW long AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 999 PRECEDING AND CURRENT ROW),
       mid AS (PARTITION BY event_type ORDER BY ts, event_id ROWS BETWEEN 364 PRECEDING AND CURRENT ROW)""")
def q_events_long_frames(spark, sf):
    """Long sliding frames, over several chunks of each key; of whole cents,
    whose sums are exact."""
    ev = _tables(spark, sf).events.select("event_type", "event_id", "ts",
                                          F.round(F.col("value") * 100).cast("long").alias("cents"))
    return series.sliding(ev, ["event_type"], ["ts", "event_id"], {
        "ma_1000": series.Frame("cents", "avg", 1000), "n_1000": series.Frame("cents", "count", 1000),
        "low_365": series.Frame("cents", "min", 365), "high_365": series.Frame("cents", "max", 365)},
        chunk_rows=3000).drop("cents")


# --------------------------------------------------------------------------
# dimensions and fact
# --------------------------------------------------------------------------

register("dim_latest_per_key", O.with_(O.META) + """
SELECT * FROM meta
QUALIFY row_number() OVER (PARTITION BY coin_id
        ORDER BY extracted_at DESC, symbol DESC, name DESC, categories DESC,
                 genesis_date DESC, hashing_algorithm DESC) = 1""")(
    lambda spark, sf: star.latest_per_key(fixtures.asset_meta(_tables(spark, sf)),
                                          ["coin_id"], ["extracted_at"]))

register("dim_asset", O.with_(O.META, O.dim_coin("meta")) + "SELECT * FROM dim_coin")(
    lambda spark, sf: main_warehouse(spark, sf).dim_asset)

register("dim_date", O.with_(O.SPINE, O.DIM_DATE) + "SELECT * FROM dim_date")(
    lambda spark, sf: main_warehouse(spark, sf).dim_date)

register("dim_date_latest", O.with_(O.SPINE, O.DIM_DATE) + """
SELECT x.date_id, x.date, x.year, x.month, x.day_name, ['No', 'Yes'][1 + (isodow(x.date) > 5)::INT] AS is_weekend, x.season
FROM (SELECT max(date) AS last FROM spine) JOIN dim_date x ON x.date > last - 5""")(
    lambda spark, sf: serve.dim_date_latest(main_warehouse(spark, sf).dim_date))

register("fact_price", O.STAR + "SELECT * FROM fact")(
    lambda spark, sf: main_warehouse(spark, sf).fact)


@register("fact_bucketed", O.STAR + """
SELECT coin_sk, date_id, close_price, count(*) OVER w AS days_so_far, close_price - first_value(close_price) OVER w AS since_first
FROM fact WINDOW w AS (PARTITION BY coin_sk ORDER BY date_id ROWS UNBOUNDED PRECEDING)""")
def q_fact_bucketed(spark, sf):
    """The fact stored bucketed by asset and read back: windows by asset, in
    the order of the calendar, without a shuffle."""
    loc, w = scratch_path(spark, "bucketed"), main_warehouse(spark, sf)
    catalog.ensure_database(spark, "cw_bucketed", loc)
    catalog.write_table(w.fact, "cw_bucketed.fact", ["coin_sk", "date_id"], location=loc, bucket_by=("coin_sk", 8))
    by = Window.partitionBy("coin_sk").orderBy("date_id").rowsBetween(Window.unboundedPreceding, 0)
    return spark.table("cw_bucketed.fact").select(
        "coin_sk", "date_id", "close_price", F.count(F.lit(1)).over(by).alias("days_so_far"),
        (F.col("close_price") - F.first("close_price").over(by)).alias("since_first"))


register("dim_asset_stamped", O.with_(O.META, O.dim_coin("meta")) + """
SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS dbt_updated_at FROM dim_coin""")(
    lambda spark, sf: star.dim_asset(fixtures.asset_meta(_tables(spark, sf)),
                                     F.lit(RUN_TS[:-1]).cast("timestamp_ntz")))


@register("fact_outside_calendar", O.with_(
    O.BARS, O.META, O.SPINE, O.DIM_DATE, O.stg("bars"), O.enriched("stg"), O.dim_coin("meta"),
    O.fact("enriched", "dim_coin")) + """
SELECT price_sk, coin_sk, CAST(NULL AS INTEGER) AS date_id, close_price FROM fact
WHERE date_id // 10000 >= (SELECT max(year(o_orderdate)) FROM orders)""")
def q_fact_outside_calendar(spark, sf):
    """Bars after the end of a shorter calendar keep their row, without a day."""
    t = _tables(spark, sf)
    w = Warehouse(fixtures.bars(t), fixtures.asset_meta(t),
                  spine_from_bounds(fixtures.complete_order_years(t), "lo", "hi"))
    return w.fact.where(F.col("date_id").isNull()).select("price_sk", "coin_sk", "date_id", "close_price")


# --------------------------------------------------------------------------
# serving
# --------------------------------------------------------------------------

@dataclass
class Gold:
    """Written star schema, as dashboards read it."""

    fact: DataFrame
    dim_asset: DataFrame
    dim_date: DataFrame


_GOLD: dict[tuple[str, str], Gold] = {}


def gold(spark: SparkSession, sf: str) -> Gold:
    """The star schema of the main bars, built and written once per session
    and folder: the fact clustered by asset and day, so an asset or date
    filter prunes row groups."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _GOLD:
        w = main_warehouse(spark, sf)
        dims = written(w.dim_asset, "gold-dim-coin"), written(w.dim_date, "gold-dim-date")
        fact = star.fact_price(w.enriched, *dims)
        _GOLD[key] = Gold(written(fact.repartitionByRange("coin_sk", "date_id")
                                  .sortWithinPartitions("coin_sk", "date_id"), "gold-fact"), *dims)
    return _GOLD[key]


def _wh(fn):
    def q(spark, sf):
        return fn(gold(spark, sf))
    return q


# The serving oracles start from the enriched bars, not from the star: the
# asset's symbol is its id three times, its day is its date.
_SERVE = O.with_(O.BARS, O.stg("bars"), O.enriched("stg"))

register("kpi_total_records", _SERVE + "SELECT count(*) AS total_records FROM enriched")(
    _wh(lambda w: serve.kpi_total_records(w.fact)))

register("kpi_assets_tracked", """
SELECT count(*) AS assets_tracked FROM (SELECT l_returnflag FROM lineitem GROUP BY 1)""")(
    _wh(lambda w: serve.kpi_assets_tracked(w.fact)))

register("kpi_latest_date", """
SELECT CAST(l_shipdate AS DATE) AS latest_date FROM lineitem ORDER BY l_shipdate DESC LIMIT 1""")(
    _wh(lambda w: serve.kpi_latest_date(w.fact, w.dim_date)))

register("asset_list", O.with_(O.META, O.dim_coin("meta"))
         + "SELECT coin_id, repeat(coin_id, 3) AS symbol, name FROM dim_coin")(
    _wh(lambda w: serve.asset_list(w.dim_asset)))

register("price_view", _SERVE + f"""
SELECT * EXCLUDE (coin_id, daily_range, price_change, source, extracted_at, price_date), price_date AS date
FROM enriched WHERE coin_id = '{VIEW_ASSET}'""")(
    _wh(lambda w: serve.price_view(w.fact, w.dim_asset, w.dim_date, VIEW_ASSET)))

register("price_month_slice", _SERVE + f"""
SELECT price_date AS date, repeat('{SLICE_ASSET}', 3) AS symbol, open_price, high_price, low_price,
       close_price, ma_7d, ma_30d
FROM (SELECT *, row_number() OVER (PARTITION BY coin_id ORDER BY price_date) AS place FROM enriched)
WHERE coin_id = '{SLICE_ASSET}' AND strftime(price_date, '%Y-%m') = '{SLICE_YEAR}-{SLICE_MONTH:02}'""")(
    _wh(lambda w: serve.price_month_slice(w.fact, w.dim_asset, w.dim_date,
                                          SLICE_ASSET, SLICE_YEAR, SLICE_MONTH)))

_RL = """
SELECT price_date AS date, repeat(coin_id, 3) AS symbol, daily_return_pct
FROM enriched WHERE open_price <> 0 AND daily_return_pct = daily_return_pct"""

register("returns_long", _SERVE + _RL)(
    _wh(lambda w: stats.returns_long(w.fact, w.dim_asset, w.dim_date)))

# coverage straight from the lines: one bar a day, first and last ship day
register("coverage_by_asset", """
WITH days AS (SELECT DISTINCT l_returnflag AS f, CAST(l_shipdate AS DATE) AS d FROM lineitem),
named AS (SELECT l_returnflag AS f, arg_max('Flag ' || l_returnflag || ' ' || l_linestatus,
                 row(l_shipdate, 'Flag ' || l_returnflag || ' ' || l_linestatus)) AS name
          FROM lineitem GROUP BY l_returnflag)
SELECT repeat(f, 3) AS symbol, name, count(d) AS records, min(d) AS first_date, max(d) AS last_date,
       CAST(max(epoch(d)) - min(epoch(d)) AS BIGINT) // 86400 :: INTEGER AS days
FROM days JOIN named USING (f) GROUP BY f, name""")(
    _wh(lambda w: serve.coverage_by_asset(w.fact, w.dim_asset, w.dim_date)))

register("coverage_total", """
WITH days AS (SELECT l_returnflag AS f, count(DISTINCT CAST(l_shipdate AS DATE)) AS n,
                     arg_max(l_linestatus, row(l_shipdate, l_linestatus)) AS s FROM lineitem GROUP BY 1)
SELECT repeat(f, 3) AS symbol, 'Flag ' || f || ' ' || s AS name, n AS records, 0::BIGINT AS is_total FROM days
UNION ALL SELECT NULL, NULL, sum(n)::BIGINT, 3 FROM days""")(
    _wh(lambda w: serve.coverage_total(w.fact, w.dim_asset, w.dim_date)))

register("table_counts", """
SELECT unnest(['dim_coin', 'dim_date', 'fact_price_ohlcv']) AS table_name, unnest([
  (SELECT count(DISTINCT l_returnflag) FROM lineitem),
  (SELECT date_diff('day', make_date(min(year(d)), 1, 1), make_date(max(year(d)) + 1, 1, 1))
   FROM (SELECT o_orderdate AS d FROM orders UNION ALL SELECT l_shipdate FROM lineitem)),
  (SELECT count(DISTINCT l_returnflag || CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) FROM lineitem)]) AS row_count""")(
    _wh(lambda w: serve.table_counts({"fact_price_ohlcv": w.fact, "dim_coin": w.dim_asset,
                                      "dim_date": w.dim_date})))

register("latest_sample", _SERVE + """
SELECT year(price_date) * 10000 + month(price_date) * 100 + day(price_date) AS date_id,
       repeat(coin_id, 3) AS symbol, round(open_price, 2) AS open, round(high_price, 2) AS high,
       round(low_price, 2) AS low, round(close_price, 2) AS close, round(daily_return_pct, 2) AS return_pct
FROM enriched QUALIFY row_number() OVER (ORDER BY price_date DESC, coin_id) <= 10""")(
    _wh(lambda w: serve.latest_sample(w.fact, w.dim_asset)))


@register("guards", _SERVE + f"""
SELECT 'empty_result' AS guard, coin_id AS subject, 'passed' AS outcome, count(*) AS rows
FROM enriched WHERE coin_id = '{VIEW_ASSET}' GROUP BY coin_id
UNION ALL SELECT 'empty_result', '{MISSING_ASSET}', 'EmptyResult', 0
UNION ALL SELECT 'nothing_loaded', '{MISSING_ASSET}', 'NoDataError', 0
UNION ALL SELECT 'benchmark', '{fixtures.BENCHMARK_SYMBOL}', 'passed',
  (SELECT count(DISTINCT price_date) FROM enriched) * (SELECT count(DISTINCT coin_id) - 1 FROM enriched)
UNION ALL SELECT 'benchmark', '{MISSING_ASSET}', 'passed', 0""")
def q_guards(spark, sf):
    """What stops a run early: an empty view, nothing to load, no benchmark."""
    w, out = gold(spark, sf), []

    def outcome(guard, subject, make):
        try:
            out.append((guard, subject, "passed", make().count()))
        except (serve.EmptyResult, csv_bars.NoDataError) as e:
            out.append((guard, subject, type(e).__name__, 0))

    for a in (VIEW_ASSET, MISSING_ASSET):
        outcome("empty_result", a, lambda: serve.require_rows(
            serve.price_view(w.fact, w.dim_asset, w.dim_date, a), a))
    outcome("nothing_loaded", MISSING_ASSET, lambda: csv_bars.read_bars_csv(
        spark, {MISSING_ASSET: scratch_path(spark, "absent")}, RUN_TS)[0])
    returns = stats.returns_long(w.fact, w.dim_asset, w.dim_date)
    for s in (fixtures.BENCHMARK_SYMBOL, MISSING_ASSET):
        outcome("benchmark", s, lambda: stats.rolling_corr(returns, s, 30))
    return spark.createDataFrame(out, "guard string, subject string, outcome string, rows long")


# --------------------------------------------------------------------------
# data quality (dirty warehouse: duplicates, NULL keys, NULL prices)
# --------------------------------------------------------------------------

_DIRTY_STAR = O.with_(O.BARS, O.BARS_DIRTY, O.META, O.SPINE, O.DIM_DATE, O.stg("bars_dirty"),
                      O.enriched("stg"), O.dim_coin("meta"), O.fact("enriched", "dim_coin"))


def _dq(fn):
    def q(spark, sf):
        return fn(_dirty_warehouse(spark, sf))
    return q


def _dq_gold(fn):
    """Checks that read the fact several times run on a written copy,
    as they do on the written gold table in the batch."""
    def q(spark, sf):
        w = _dirty_warehouse(spark, sf)
        w.fact = written(w.fact, "fact")
        return fn(w)
    return q


register("dq_not_null", _DIRTY_STAR + """
SELECT 'not_null' AS "check", 'fact_price_ohlcv' AS table_name, c AS column_name,
       CAST(n AS BIGINT) AS failures, 'error' AS severity
FROM (SELECT count_if(price_sk IS NULL) AS price_sk, count_if(coin_sk IS NULL) AS coin_sk,
             count_if(date_id IS NULL) AS date_id, count_if(close_price IS NULL) AS close_price
      FROM fact) UNPIVOT (n FOR c IN (price_sk, coin_sk, date_id, close_price))""")(
    _dq(lambda w: quality.not_null(w.fact, ["price_sk", "coin_sk", "date_id", "close_price"],
                                   "fact_price_ohlcv")))

register("dq_unique", _DIRTY_STAR + """
SELECT 'unique' AS "check", 'fact_price_ohlcv' AS table_name, 'price_sk' AS column_name,
       count(*) AS failures, 'error' AS severity
FROM (SELECT price_sk FROM fact WHERE price_sk IS NOT NULL GROUP BY price_sk HAVING count(*) > 1)
UNION ALL
SELECT 'unique', 'dim_coin', 'coin_id', count(*), 'error'
FROM (SELECT coin_id FROM dim_coin WHERE coin_id IS NOT NULL GROUP BY coin_id HAVING count(*) > 1)
UNION ALL
SELECT 'unique', 'dim_date', 'date_id', count(*), 'error'
FROM (SELECT date_id FROM dim_date WHERE date_id IS NOT NULL GROUP BY date_id HAVING count(*) > 1)
""")(
    _dq(lambda w: quality.combine(quality.unique(w.fact, "price_sk", "fact_price_ohlcv"),
                                  quality.unique(w.dim_asset, "coin_id", "dim_coin"),
                                  quality.unique(w.dim_date, "date_id", "dim_date"))))

register("dq_relationships", _DIRTY_STAR + """
SELECT 'relationships' AS "check", 'fact_price_ohlcv' AS table_name, 'coin_sk' AS column_name,
       count(*) AS failures, 'warn' AS severity
FROM fact f WHERE f.coin_sk IS NOT NULL AND f.coin_sk NOT IN (SELECT coin_sk FROM dim_coin)
UNION ALL
SELECT 'relationships', 'fact_price_ohlcv', 'date_id', count(*), 'warn'
FROM fact f WHERE f.date_id IS NOT NULL AND f.date_id NOT IN (SELECT date_id FROM dim_date)
UNION ALL
SELECT 'relationships', 'fact_price_ohlcv', 'coin_sk', count(*), 'warn'
FROM fact f WHERE f.coin_sk IS NOT NULL
  AND f.coin_sk NOT IN (SELECT coin_sk FROM dim_coin WHERE coin_id <> 'R')""")(
    _dq_gold(lambda w: quality.combine(
        quality.relationships(w.fact, "coin_sk", w.dim_asset, "coin_sk", "fact_price_ohlcv"),
        quality.relationships(w.fact, "date_id", w.dim_date, "date_id", "fact_price_ohlcv"),
        # against a dimension missing one asset: every fact row of it is an orphan
        quality.relationships(w.fact, "coin_sk", w.dim_asset.where(F.col("coin_id") != "R"),
                              "coin_sk", "fact_price_ohlcv"))))

register("dq_min_rows", O.with_(O.BARS, O.BARS_DIRTY, O.META) + """
SELECT 'min_rows' AS "check", 'silver.ohlcv' AS table_name, CAST(NULL AS VARCHAR) AS column_name,
       CAST(CASE WHEN count(*) < 100 THEN 1 ELSE 0 END AS BIGINT) AS failures, 'error' AS severity
FROM bars_dirty
UNION ALL
SELECT 'min_rows', 'silver.coin_metadata', NULL, CASE WHEN count(*) < 1 THEN 1 ELSE 0 END, 'error'
FROM meta
UNION ALL
SELECT 'min_rows', 'silver.coin_metadata', NULL, CASE WHEN count(*) < 100 THEN 1 ELSE 0 END,
       'warn' FROM meta""")(
    lambda spark, sf: quality.combine(
        quality.min_rows(fixtures.bars_dirty(_tables(spark, sf)), 100, "silver.ohlcv"),
        quality.min_rows(fixtures.asset_meta(_tables(spark, sf)), 1, "silver.coin_metadata"),
        quality.min_rows(fixtures.asset_meta(_tables(spark, sf)), 100, "silver.coin_metadata",
                         quality.WARN)))

register("dq_null_profile", O.with_(O.BARS, O.BARS_DIRTY) + """
SELECT count(*) AS total, CAST(count_if(open IS NULL) AS BIGINT) AS null_open,
       CAST(count_if(close IS NULL) AS BIGINT) AS null_close,
       CAST(count_if(high IS NULL) AS BIGINT) AS null_high,
       CAST(count_if(low IS NULL) AS BIGINT) AS null_low
FROM bars_dirty""")(
    lambda spark, sf: quality.null_profile(fixtures.bars_dirty(_tables(spark, sf)),
                                           ["open", "close", "high", "low"]))

# rows beyond the first of each pair, and every row without a full pair
register("dq_duplicate_pairs", _DIRTY_STAR + """
SELECT coalesce(sum(CASE WHEN coin_sk IS NULL OR date_id IS NULL THEN n ELSE n - 1 END), 0)::BIGINT AS duplicates
FROM (SELECT coin_sk, date_id, count(*) AS n FROM fact GROUP BY ALL)""")(
    _dq(lambda w: quality.duplicate_pairs(w.fact, "coin_sk", "date_id")))

def _nn(table: str, col: str, label: str) -> str:
    return (f"SELECT 'not_null' AS \"check\", '{label}' AS table_name, '{col}' AS column_name, "
            f"CAST(count_if({col} IS NULL) AS BIGINT) AS failures, 'error' AS severity FROM {table}")


def _uq(table: str, col: str, label: str) -> str:
    return (f"SELECT 'unique', '{label}', '{col}', count(*), 'error' FROM (SELECT {col} FROM {table} "
            f"WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1)")


def _rel(col: str, parent: str) -> str:
    return (f"SELECT 'relationships', 'fact_price_ohlcv', '{col}', count(*), 'warn' FROM fact "
            f"WHERE {col} IS NOT NULL AND {col} NOT IN (SELECT {col} FROM {parent})")


register("dq_star_checks", _DIRTY_STAR + "\nUNION ALL\n".join([
    _nn("fact", "price_sk", "fact_price_ohlcv"), _nn("fact", "coin_sk", "fact_price_ohlcv"),
    _nn("fact", "date_id", "fact_price_ohlcv"), _nn("fact", "close_price", "fact_price_ohlcv"),
    _uq("fact", "price_sk", "fact_price_ohlcv"),
    _rel("coin_sk", "dim_coin"), _rel("date_id", "dim_date"),
    _nn("dim_coin", "coin_sk", "dim_coin"), _nn("dim_coin", "coin_id", "dim_coin"),
    _uq("dim_coin", "coin_sk", "dim_coin"), _uq("dim_coin", "coin_id", "dim_coin"),
    _nn("dim_date", "date_id", "dim_date"), _uq("dim_date", "date_id", "dim_date")]))(
    _dq_gold(lambda w: quality.star_checks(w.fact, w.dim_asset, w.dim_date)))


# The star's suite without asset R in its dimension, a test more, and other
# severities: declared, not programmed.
DIRTY_SUITE = {
    "fact_price_ohlcv": {
        "tests": [{"min_rows": {"least": 1_000_000_000, "severity": "warn"}}],
        "columns": {"price_sk": [{"unique": {"severity": "warn"}}, "not_null"], "close_price": ["not_null"],
                    "open_price": [{"not_null": {"severity": "warn"}}],
                    "coin_sk": [{"relationships": {"to": "dim_coin", "field": "coin_sk", "severity": "error"}}],
                    "date_id": ["not_null", {"relationships": {"to": "dim_date", "field": "date_id"}}]}},
    "dim_coin": {"columns": {"coin_id": ["unique", "not_null"]}},
    "dim_date": {"columns": {"year": ["unique"]}},
}


def _without_r(w: Warehouse) -> dict[str, DataFrame]:
    return quality.star_tables(w.fact, w.dim_asset.where("coin_id <> 'R'"), w.dim_date)


register("dq_suite", _DIRTY_STAR + """
SELECT * FROM (VALUES ('min_rows', 'fact_price_ohlcv', NULL, 1, 'warn'),
  ('not_null', 'dim_coin', 'coin_id', 0, 'error'), ('unique', 'dim_coin', 'coin_id', 0, 'error'),
  ('not_null', 'fact_price_ohlcv', 'price_sk', (SELECT count(*) FROM fact WHERE price_sk IS NULL), 'error'),
  ('unique', 'fact_price_ohlcv', 'price_sk', (SELECT count(*) - count(DISTINCT price_sk) FROM fact WHERE price_sk IN
     (SELECT min(price_sk) FROM fact GROUP BY price_sk HAVING count(*) = 2)), 'warn'),
  ('not_null', 'fact_price_ohlcv', 'close_price', (SELECT count(*) - count(close_price) FROM fact), 'error'),
  ('not_null', 'fact_price_ohlcv', 'open_price', (SELECT count(*) - count(open_price) FROM fact), 'warn'),
  ('relationships', 'fact_price_ohlcv', 'coin_sk', (SELECT count(*) FROM fact WHERE coin_sk = md5('R')), 'error'),
  ('not_null', 'fact_price_ohlcv', 'date_id', (SELECT count(*) FROM fact WHERE date_id IS NULL), 'error'),
  ('relationships', 'fact_price_ohlcv', 'date_id',
     (SELECT count(*) FROM fact WHERE date_id IS NOT NULL) - (SELECT count(*) FROM fact JOIN dim_date USING (date_id)), 'warn'),
  ('unique', 'dim_date', 'year', (SELECT count(DISTINCT year) FROM dim_date), 'error')
) AS v("check", table_name, column_name, failures, severity)""")(
    _dq_gold(lambda w: quality.run_suite(quality.declared(DIRTY_SUITE), _without_r(w))))


register("dq_failing_rows", _DIRTY_STAR + """
SELECT 'min_rows' AS "check", 'fact_price_ohlcv' AS table_name, NULL AS column_name, 'warn' AS severity,
       NULL AS key, (SELECT count(*) FROM fact) AS rows
UNION ALL
SELECT 'unique', 'fact_price_ohlcv', 'price_sk', 'warn', price_sk, count(*) FROM fact GROUP BY price_sk HAVING count(*) > 1
UNION ALL
SELECT 'relationships', 'fact_price_ohlcv', 'coin_sk', 'error', md5('R'), count(*) FROM fact WHERE coin_sk = md5('R')
HAVING count(*) > 0
UNION ALL
SELECT 'unique', 'dim_date', 'year', 'error', CAST(year AS VARCHAR), count(*) FROM dim_date GROUP BY year""")(
    _dq_gold(lambda w: quality.failing_rows(quality.declared(DIRTY_SUITE), _without_r(w))))


@register("dq_enforced", _DIRTY_STAR + """
SELECT 'relationships' AS "check", 'warn' AS severity, 'reported' AS outcome,
       (SELECT count(*) FROM fact WHERE coin_sk <> md5('R')) AS failures
UNION ALL SELECT 'unique', 'error', 'DataQualityError',
       (SELECT count(*) FROM (SELECT price_sk FROM fact GROUP BY price_sk HAVING count(*) > 1))""")
def q_dq_enforced(spark, sf):
    """A failing warning is handed on as rows, a failing error stops the run."""
    w, out = _dirty_warehouse(spark, sf), []
    only_r = w.dim_asset.where("coin_id = 'R'")
    for check in (quality.relationships(w.fact, "coin_sk", only_r, "coin_sk", "fact"),
                  quality.unique(w.fact, "price_sk", "fact")):
        check = written(check, "check")
        r = check.first()
        try:
            quality.enforce(check)
            outcome = "reported"
        except quality.DataQualityError as e:
            outcome = type(e).__name__
        out.append((r["check"], r.severity, outcome, r.failures))
    return spark.createDataFrame(out, "check string, severity string, outcome string, failures long")


# --------------------------------------------------------------------------
# statistics
# --------------------------------------------------------------------------

# every measure of every bar, from the enriched bars; {symbol} is the rule
# that makes the asset's symbol
_PL = """
pl AS (SELECT * FROM (SELECT {symbol} AS symbol, """ + ", ".join(PRICE_COLUMNS) + """ FROM enriched) AS e
       UNPIVOT INCLUDE NULLS (value FOR measure IN (""" + ", ".join(PRICE_COLUMNS) + """)))"""


def _stats_sql(bars_sql: str, symbol: str) -> str:
    """Describe per (symbol, measure).  The sum behind the mean is added up in
    whole multiples of 2^-70, which all these values are."""
    return bars_sql.rstrip() + "," + _PL.format(symbol=symbol) + """
SELECT symbol, measure, count(value) AS count,
       round(CAST(sum(CAST(value * 1180591620717411303424 AS HUGEINT)) AS DOUBLE)
             / 1180591620717411303424 / count(value), 4) AS mean,
       round(stddev_samp(value), 4) AS std, round(min(value), 4) AS min,
       round(quantile_cont(value, 0.25), 4) AS p25, round(quantile_cont(value, 0.5), 4) AS p50,
       round(quantile_cont(value, 0.75), 4) AS p75, round(max(value), 4) AS max
FROM pl GROUP BY symbol, measure"""


register("price_stats", _stats_sql(_SERVE, "repeat(coin_id, 3)"))(
    _wh(lambda w: stats.describe(serve.price_series(w.fact, w.dim_asset, w.dim_date),
                                 PRICE_COLUMNS, ["symbol"]).withColumnRenamed("column", "measure")))

register("return_histogram", _SERVE + ", rl AS (" + _RL + """),
st AS (SELECT symbol, min(daily_return_pct) AS lo, max(daily_return_pct) AS hi FROM rl GROUP BY symbol),
b AS (SELECT rl.symbol, CASE WHEN hi > lo THEN least(floor((daily_return_pct - lo) / (hi - lo) * 50.0), 49)
                             ELSE 0 END AS bin
      FROM rl JOIN st ON rl.symbol = st.symbol),
c AS (SELECT symbol, CAST(bin AS BIGINT) AS bin, count(*) AS count FROM b GROUP BY ALL),
e AS (SELECT symbol, lo, hi, unnest(range(0, 50)) AS bin FROM st)
SELECT e.symbol, CAST(e.bin AS BIGINT) AS bin, round(lo + e.bin * ((hi - lo) / 50.0), 4) AS bin_start,
       round(lo + (e.bin + 1) * ((hi - lo) / 50.0), 4) AS bin_end, coalesce(c.count, 0) AS count
FROM e LEFT JOIN c ON e.symbol = c.symbol AND e.bin = c.bin""")(
    _wh(lambda w: stats.histogram(stats.returns_long(w.fact, w.dim_asset, w.dim_date),
                                  "daily_return_pct", ["symbol"], 50)))


def _sparse(fn):
    def q(spark, sf):
        return fn(sparse_warehouse(spark, sf))
    return q


def _nan_null(e: str) -> str:
    return f"CASE WHEN isnan({e}) THEN NULL ELSE {e} END"


# priorities have the symbol P and their first character
_SPARSE_RL = (O.with_(O.BARS_SPARSE, O.stg("bars_sparse"), O.enriched("stg")) + ", rl AS ("
              + _RL.replace("repeat(coin_id, 3)", "'P' || left(coin_id, 1)") + ")\n")

register("returns_pivot", _SPARSE_RL + "SELECT date, " + ", ".join(
    f"max(CASE WHEN symbol = '{s}' THEN daily_return_pct END) AS \"{s}\"" for s in SPARSE_SYMBOLS)
    + " FROM rl GROUP BY date")(
    _sparse(lambda w: stats.returns_pivot(stats.returns_long(w.fact, w.dim_asset, w.dim_date),
                                          stats.pivot_symbols(w.dim_asset))))

register("returns_unpivot", _SPARSE_RL + "SELECT * FROM rl")(
    _sparse(lambda w: stats.returns_unpivot(
        stats.returns_pivot(stats.returns_long(w.fact, w.dim_asset, w.dim_date),
                            stats.pivot_symbols(w.dim_asset)))))

_CORR_CELLS = ("SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, round("
               + _nan_null("corr(a.daily_return_pct, b.daily_return_pct)") + ", 6) AS corr "
               "FROM rl a JOIN rl b ON a.date = b.date GROUP BY a.symbol, b.symbol")

register("corr_matrix_long", _SPARSE_RL + _CORR_CELLS)(
    _sparse(lambda w: stats.corr_matrix_long(stats.returns_long(w.fact, w.dim_asset, w.dim_date),
                                             w.dim_asset.select("symbol"))))

register("corr_matrix_wide", _SPARSE_RL.rstrip() + ", cells AS (" + _CORR_CELLS
         + ")\nSELECT symbol_a AS symbol, " + ", ".join(
             f"max(CASE WHEN symbol_b = '{s}' THEN corr END) AS \"{s}\"" for s in SPARSE_SYMBOLS)
         + " FROM cells GROUP BY symbol_a")(
    _sparse(lambda w: stats.corr_matrix_wide(stats.returns_long(w.fact, w.dim_asset, w.dim_date),
                                             w.dim_asset.select("symbol"))))

def _pairs_sql(bars_sql: str, symbol: str) -> str:
    """r of every pair by the textbook sums over its common days; the pair in
    the order of the hashed ids."""
    return bars_sql.rstrip() + f""",
v AS (SELECT price_date AS d, md5(coin_id) AS k, {symbol} AS s, daily_return_pct AS x
      FROM enriched WHERE daily_return_pct IS NOT NULL),
p AS (SELECT any_value(a.s) AS symbol_a, any_value(b.s) AS symbol_b, count(*) AS n,
             sum(a.x - m.x) AS sx, sum(b.x - o.x) AS sy, sum((a.x - m.x) ** 2) AS xx,
             sum((b.x - o.x) ** 2) AS yy, sum((a.x - m.x) * (b.x - o.x)) AS xy,
             min(a.x) = max(a.x) OR min(b.x) = max(b.x) AS flat
      FROM v a JOIN v b ON a.d = b.d AND a.k < b.k
      JOIN (SELECT k, avg(x) AS x FROM v GROUP BY k) m ON m.k = a.k
      JOIN (SELECT k, avg(x) AS x FROM v GROUP BY k) o ON o.k = b.k
      GROUP BY a.k, b.k)
SELECT symbol_a, symbol_b, CASE WHEN n > 1 AND NOT flat THEN
  round(greatest(-1, least(1, (n * xy - sx * sy) / (sqrt(n * xx - sx * sx) * sqrt(n * yy - sy * sy)))), 6) END AS correlation
FROM p"""


register("corr_pairs", _pairs_sql(O.with_(O.BARS_SPARSE, O.stg("bars_sparse"), O.enriched("stg")),
                                  "'P' || left(coin_id, 1)"))(
    _sparse(lambda w: stats.corr_pairs(w.fact, w.dim_asset)))

register("rolling_corr", _SERVE + ", rl AS (" + _RL + f"""),
dates AS (SELECT DISTINCT date FROM rl),
syms AS (SELECT DISTINCT symbol FROM rl WHERE symbol <> '{fixtures.BENCHMARK_SYMBOL}'
         AND EXISTS (SELECT 1 FROM rl WHERE symbol = '{fixtures.BENCHMARK_SYMBOL}')),
grid AS (SELECT d.date, s.symbol FROM dates d CROSS JOIN syms s),
j AS (SELECT g.date, g.symbol, x.daily_return_pct AS x, y.daily_return_pct AS y
      FROM grid g
      LEFT JOIN rl x ON x.date = g.date AND x.symbol = g.symbol
      LEFT JOIN (SELECT date, daily_return_pct FROM rl
                 WHERE symbol = '{fixtures.BENCHMARK_SYMBOL}') y ON y.date = g.date)
SELECT date, symbol,
       CASE WHEN count(CASE WHEN x IS NOT NULL AND y IS NOT NULL THEN 1 END) OVER w >= 30
            THEN round({_nan_null("corr(x, y) OVER w")}, 6) END AS rolling_corr
FROM j WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)""")(
    _wh(lambda w: stats.rolling_corr(stats.returns_long(w.fact, w.dim_asset, w.dim_date),
                                     fixtures.BENCHMARK_SYMBOL, 30)))


@register("rolling_corr_small_chunks", ORACLE["rolling_corr"])
def q_rolling_small(spark, sf):
    """Rolling correlation with 100-row grid chunks (halo exercised)."""
    w = gold(spark, sf)
    return stats.rolling_corr(stats.returns_long(w.fact, w.dim_asset, w.dim_date),
                              fixtures.BENCHMARK_SYMBOL, 30, chunk_rows=100)


@register("corr_matrix_small_blocks", ORACLE["corr_matrix_long"])
def q_corr_small_blocks(spark, sf):
    """Correlation matrix with 2-asset blocks and 64-date chunks."""
    w = sparse_warehouse(spark, sf)
    return stats.corr_matrix_long(stats.returns_long(w.fact, w.dim_asset, w.dim_date),
                                  w.dim_asset.select("symbol"), block_size=2, date_chunk=64)


# Oracle outputs holding calendar dates (see _dates_as_timestamps).
_DATE_COLUMNS = {
    "src_date_spine": ["date"], "dim_date": ["date"], "dim_date_latest": ["date"],
    "kpi_latest_date": ["latest_date"], "price_view": ["date"], "price_month_slice": ["date"],
    "returns_long": ["date"], "coverage_by_asset": ["first_date", "last_date"],
    "returns_pivot": ["date"], "returns_unpivot": ["date"], "rolling_corr": ["date"], "rolling_corr_small_chunks": ["date"],
    **{k: ["price_date"] for k in (
        "clean_prices", "flag_null_price", "flag_invalid_bar", "filter_valid_bars",
        "daily_range", "daily_return", "price_change", "moving_avg_7", "moving_avg_30",
        "enriched_prices", "enriched_plain_window", "enriched_small_chunks")},
}
for _name, _cols in _DATE_COLUMNS.items():
    ORACLE[_name] = ts(ORACLE[_name], *_cols)


# --------------------------------------------------------------------------
# many assets (one per supplier): the same operators spread over assets
# --------------------------------------------------------------------------

def _supplier_warehouse(spark, sf) -> Warehouse:
    t = _tables(spark, sf)
    return Warehouse(fixtures.bars_by_supplier(t), fixtures.supplier_meta(t), fixture_calendar(t))


register("supplier_enriched", ts(O.with_(O.BARS_SUPPLIER, O.stg("bars_supplier"),
                                         O.enriched("stg")) + "SELECT * FROM enriched",
                                 "price_date"))(
    lambda spark, sf: _supplier_warehouse(spark, sf).enriched)

_SUPPLIER = O.with_(O.BARS_SUPPLIER, O.stg("bars_supplier"), O.enriched("stg"))

register("supplier_corr_pairs", _pairs_sql(_SUPPLIER, "coin_id"))(
    lambda spark, sf: (lambda w: stats.corr_pairs(w.fact, w.dim_asset))(_supplier_warehouse(spark, sf)))

def _neighbours(w: Warehouse) -> DataFrame:
    """Pairs of suppliers with numbers that follow each other."""
    number = F.substring("coin_id", 2, 20).cast("long")
    a = w.dim_asset.select(F.col("coin_sk").alias("a"), number.alias("n"))
    b = w.dim_asset.select(F.col("coin_sk").alias("b"), (number - 1).alias("n"))
    return a.join(b, "n").select("a", "b")


register("supplier_corr_given_pairs", _pairs_sql(_SUPPLIER, "coin_id").replace(
    "a.k < b.k", "a.k < b.k AND abs(CAST(substr(a.s, 2) AS INT) - CAST(substr(b.s, 2) AS INT)) = 1"))(
    lambda spark, sf: (lambda w: stats.corr_pairs(w.fact, w.dim_asset, pairs=_neighbours(w)))(
        _supplier_warehouse(spark, sf)))

register("supplier_price_stats", _stats_sql(_SUPPLIER, "coin_id"))(
    lambda spark, sf: (lambda w: stats.describe(
        serve.price_series(w.fact, w.dim_asset, w.dim_date), PRICE_COLUMNS, ["symbol"])
        .withColumnRenamed("column", "measure"))(_supplier_warehouse(spark, sf)))


register("part_enriched", ts(O.with_(O.BARS_PART, O.stg("bars_part"), O.enriched("stg"))
                             + "SELECT * FROM enriched", "price_date"))(
    lambda spark, sf: enrich.enrich(clean.stage_prices(
        fixtures.bars_by_part(_tables(spark, sf)))))


@register("part_returns_pivot", ts(O.with_(O.BARS_PART, O.stg("bars_part"), O.enriched("stg")) + """
SELECT price_date AS date, coin_id AS symbol, daily_return_pct,
       (SELECT count(DISTINCT coin_id) FROM enriched) AS width
FROM enriched WHERE daily_return_pct IS NOT NULL""", "date"))
def q_part_returns_pivot(spark, sf):
    """Returns of every part, one array of all parts per date, and back."""
    rows = written(enrich.enrich(clean.stage_prices(fixtures.bars_by_part(_tables(spark, sf))))
                   .select(F.col("price_date").alias("date"), F.col("coin_id").alias("symbol"), "daily_return_pct"),
                   "part-returns")
    order = stats.symbol_positions(rows)
    wide = stats.returns_pivot_array(rows, order).withColumn("size", F.size("values"))
    wide = stats.written_wide(wide, order, "part-pivot")
    width = F.lit(wide.agg(F.max("size")).first()[0]).cast("long")
    return stats.returns_unpivot_array(wide, order).withColumn("width", width)
