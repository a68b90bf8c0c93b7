"""Price-bar inputs derived from the TPC-H-style driver tables.

The driver tables hold no price series, so bars are derived from them;
the oracle SQL in :mod:`candlewick.plans.oracle_sql` states the same
derivations for DuckDB.

* ``bars``: one bar per (return flag, ship date) from ``lineitem``; open
  and close are the first/last extended price in line order.
* ``bars_sparse``: one bar per (order priority, order date) from
  ``orders`` — five assets with uneven dates.
* ``bars_dirty``: ``bars`` with rule-based dirt (NULL prices, swapped
  high/low, NULL assets, duplicated rows at a higher price).
* ``asset_meta`` / ``asset_meta_sparse``: metadata snapshots, one per
  (asset, status) group, so an asset has several versions.
* ``calendar_bounds``: the whole calendar years of order and ship dates.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Provenance of derived bars and the dirt-injection rules.
BARS_SOURCE = "lineitem"
SPARSE_SOURCE = "orders"
BARS_EXTRACTED_AT = "2024-01-01T00:00:00Z"
DIRT_EPOCH = dt.date(1995, 1, 1)
DIRT_NULL_OPEN_EVERY = 17
DIRT_SWAP_HIGH_LOW_EVERY = 13
DIRT_NULL_CLOSE_EVERY = 23
DIRT_NULL_ASSET_EVERY = 101
DIRT_DUPLICATE_EVERY = 19
BENCHMARK_ASSET = "N"
BENCHMARK_SYMBOL = "NNN"


class Tables:
    """Lazy parquet readers for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")


def _fmt_ts(c):
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _line_bars(li: DataFrame, asset: Column) -> DataFrame:
    """OHLC per (asset, ship day): open/close = price of the first/last line
    in (order key, line number, price) order, high/low = max/min price.  One
    aggregate, combined map-side: only (asset, day) rows are shuffled."""
    line = F.struct("l_orderkey", "l_linenumber", "l_extendedprice")
    return (li.groupBy(asset.alias("_a"), F.to_date("l_shipdate").alias("_d"))
            .agg(F.min(line).alias("_first"), F.max("l_extendedprice").alias("high"),
                 F.min("l_extendedprice").alias("low"), F.max(line).alias("_last"))
            .select("_a", "_d", F.col("_first.l_extendedprice").alias("open"), "high", "low",
                    F.col("_last.l_extendedprice").alias("close")))


def bars(t: Tables) -> DataFrame:
    return (_line_bars(t.lineitem, F.col("l_returnflag"))
            .select(F.date_format("_d", "yyyy-MM-dd").alias("date"),
                    "open", "high", "low", "close", F.col("_a").alias("coin_id"),
                    F.lit(BARS_SOURCE).alias("source"),
                    F.lit(BARS_EXTRACTED_AT).alias("extracted_at")))


def bars_sparse(t: Tables) -> DataFrame:
    o = t.orders
    day = F.to_date("o_orderdate")
    return (o.groupBy(F.col("o_orderpriority").alias("coin_id"), day.alias("_d"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
                 F.max("o_totalprice").alias("high"),
                 F.min("o_totalprice").alias("low"),
                 F.max_by("o_totalprice", "o_orderkey").alias("close"))
            .select(F.date_format("_d", "yyyy-MM-dd").alias("date"),
                    "open", "high", "low", "close", "coin_id",
                    F.lit(SPARSE_SOURCE).alias("source"),
                    F.lit(BARS_EXTRACTED_AT).alias("extracted_at")))


def dirty(b: DataFrame) -> DataFrame:
    """Inject rule-based dirt keyed on the day number since DIRT_EPOCH."""
    k = F.datediff(F.to_date("date"), F.lit(DIRT_EPOCH))
    every = lambda n: (k % F.lit(n)) == 0
    swap = every(DIRT_SWAP_HIGH_LOW_EVERY)
    base = b.select(
        "date",
        F.when(every(DIRT_NULL_OPEN_EVERY), F.lit(None).cast("double"))
         .otherwise(F.col("open")).alias("open"),
        F.when(swap, F.col("low")).otherwise(F.col("high")).alias("high"),
        F.when(swap, F.col("high")).otherwise(F.col("low")).alias("low"),
        F.when(every(DIRT_NULL_CLOSE_EVERY), F.lit(None).cast("double"))
         .otherwise(F.col("close")).alias("close"),
        F.when(every(DIRT_NULL_ASSET_EVERY), F.lit(None).cast("string"))
         .otherwise(F.col("coin_id")).alias("coin_id"),
        "source", "extracted_at")
    copies = base.where(every(DIRT_DUPLICATE_EVERY)).select(
        "date", *[(F.col(c) + 1).alias(c) for c in ("open", "high", "low", "close")],
        "coin_id", "source", "extracted_at")
    return base.unionByName(copies)


def bars_dirty(t: Tables) -> DataFrame:
    return dirty(bars(t))


def asset_meta(t: Tables) -> DataFrame:
    """One metadata snapshot per (return flag, line status)."""
    li = t.lineitem
    f = F.col("l_returnflag")
    return (li.groupBy("l_returnflag", "l_linestatus")
            .agg(F.min("l_shipdate").alias("_first"), F.max("l_shipdate").alias("_last"))
            .select(f.alias("coin_id"),
                    F.concat(f, f, f).alias("symbol"),
                    F.concat(F.lit("Flag "), f, F.lit(" "), F.col("l_linestatus")).alias("name"),
                    F.concat(F.lit("['"), F.col("l_linestatus"), F.lit("']")).alias("categories"),
                    F.date_format("_first", "yyyy-MM-dd").alias("genesis_date"),
                    F.col("l_linestatus").alias("hashing_algorithm"),
                    _fmt_ts(F.col("_last")).alias("extracted_at")))


def asset_meta_sparse(t: Tables) -> DataFrame:
    """One metadata snapshot per (order priority, order status)."""
    o = t.orders
    p = F.col("o_orderpriority")
    return (o.groupBy("o_orderpriority", "o_orderstatus")
            .agg(F.min("o_orderdate").alias("_first"), F.max("o_orderdate").alias("_last"))
            .select(p.alias("coin_id"),
                    F.concat(F.lit("P"), F.substring(p, 1, 1)).alias("symbol"),
                    p.alias("name"),
                    F.concat(F.lit("['"), F.col("o_orderstatus"), F.lit("']")).alias("categories"),
                    F.date_format("_first", "yyyy-MM-dd").alias("genesis_date"),
                    F.col("o_orderstatus").alias("hashing_algorithm"),
                    _fmt_ts(F.col("_last")).alias("extracted_at")))


def calendar_bounds(t: Tables) -> DataFrame:
    """One row (lo, hi): the calendar years of all order and ship dates."""
    days = (t.orders.select(F.to_date("o_orderdate").alias("d"))
            .union(t.lineitem.select(F.to_date("l_shipdate"))))
    return (days.agg(F.min("d").alias("_lo"), F.max("d").alias("_hi"))
            .select(F.trunc("_lo", "year").alias("lo"),
                    F.date_sub(F.add_months(F.trunc("_hi", "year"), 12), 1).alias("hi")))


def complete_order_years(t: Tables) -> DataFrame:
    """One row (lo, hi): the years that orders cover to their end; ship dates
    run past it, so a fact built on it has rows without a calendar day."""
    return (t.orders.agg(F.min("o_orderdate").alias("_lo"), F.max("o_orderdate").alias("_hi"))
            .select(F.trunc(F.to_date("_lo"), "year").alias("lo"),
                    F.date_sub(F.trunc(F.to_date("_hi"), "year"), 1).alias("hi")))


def text_bars(b: DataFrame, dirt: bool = False) -> DataFrame:
    """Bars as CSV text (date with a time of day).  With ``dirt``: an
    unparsable open, a blank close or a blank date on rule-picked days,
    padded high values, and exact duplicate lines."""
    k = F.datediff(F.to_date("date"), F.lit(DIRT_EPOCH))
    every = lambda n: (k % F.lit(n)) == 0
    num = lambda c: F.col(c).cast("string")
    date = F.concat(F.col("date"), F.lit(" 23:59:59"))
    cols = {"date_text": date, "open_text": num("open"), "high_text": num("high"),
            "low_text": num("low"), "close_text": num("close")}
    if dirt:
        cols["open_text"] = F.when(every(DIRT_NULL_OPEN_EVERY), F.lit("oops")).otherwise(num("open"))
        cols["close_text"] = F.when(every(DIRT_NULL_CLOSE_EVERY), F.lit("")).otherwise(num("close"))
        cols["date_text"] = F.when(every(DIRT_NULL_ASSET_EVERY), F.lit("")).otherwise(date)
        cols["high_text"] = F.when(every(7), F.concat(F.lit(" "), num("high"), F.lit(" "))) \
            .otherwise(num("high"))
    out = b.select("coin_id", "date", *[c.alias(n) for n, c in cols.items()])
    if dirt:
        out = out.unionByName(out.where(every(DIRT_DUPLICATE_EVERY)))
    return out


def csv_layouts():
    """Three header layouts for the CSV round trip (padded,
    mixed-case, reordered headers and extra columns) over text_bars()."""
    t = F.col
    sno = F.datediff(F.to_date("date"), F.lit(DIRT_EPOCH)).cast("string")
    return [
        [("SNo", sno), ("Name", t("coin_id")), ("Symbol", t("coin_id")), ("Date", t("date_text")),
         ("High", t("high_text")), ("Low", t("low_text")), ("Open", t("open_text")),
         ("Close", t("close_text")), ("Volume", F.lit("0")), ("Marketcap", F.lit(""))],
        [(" Date ", t("date_text")), ("OPEN", t("open_text")), ("HIGH", t("high_text")),
         ("LOW", t("low_text")), ("CLOSE", t("close_text")), ("Adj Close", t("close_text")),
         ("Volume", F.lit("1"))],
        [("close", t("close_text")), ("open", t("open_text")), ("low", t("low_text")),
         ("high", t("high_text")), ("Trade Date", t("date_text")), ("Note", F.lit("x"))],
    ]


def mixed_layouts():
    """Three layouts of files that lie in one folder."""
    t = F.col
    us = F.date_format(F.to_date("date"), "MM/dd/yyyy")
    return [
        [("", F.lit("7")), ("Date", t("date_text")), ("Open", t("open_text")), ("High", t("high_text")),
         ("Low", t("low_text")), ("Close", t("close_text"))],
        [("", F.lit("8")), ("Date", t("date_text")), ("Close", t("close_text")), ("Low", t("low_text")),
         ("High", t("high_text")), ("Open", t("open_text"))],
        [("low", t("low_text")), ("high", t("high_text")), ("open", t("open_text")), ("Date", us),
         ("close", t("close_text"))],
    ]


def mixed_layout_of():
    """Layout index of a bar: its day modulo 3, so that every asset has all."""
    return F.pmod(F.datediff(F.to_date("date"), F.lit(DIRT_EPOCH)), F.lit(3))


def csv_layout_of():
    """Layout index of an asset: its first character code modulo 3."""
    return F.ascii(F.col("coin_id")) % 3


def bars_by_supplier(t: Tables) -> DataFrame:
    """Many-asset bars: one per (supplier, ship date) from ``lineitem``
    (1,000 assets at sf0.1), to show operators spreading over assets."""
    return (_line_bars(t.lineitem, F.col("l_suppkey"))
            .select(F.date_format("_d", "yyyy-MM-dd").alias("date"),
                    "open", "high", "low", "close",
                    F.concat(F.lit("S"), F.col("_a").cast("string")).alias("coin_id"),
                    F.lit(BARS_SOURCE).alias("source"),
                    F.lit(BARS_EXTRACTED_AT).alias("extracted_at")))


def supplier_meta(t: Tables) -> DataFrame:
    """Metadata per supplier (one version each) from ``supplier``."""
    s = t.supplier
    sid = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))
    return s.select(sid.alias("coin_id"), sid.alias("symbol"), F.col("s_name").alias("name"),
                    F.concat(F.lit("['"), F.col("s_nationkey").cast("string"), F.lit("']"))
                    .alias("categories"),
                    F.lit(None).cast("string").alias("genesis_date"),
                    F.lit(None).cast("string").alias("hashing_algorithm"),
                    F.lit(BARS_EXTRACTED_AT).alias("extracted_at"))


def bars_by_part(t: Tables) -> DataFrame:
    """Very many assets: one bar per (part, ship date) from ``lineitem``
    (20,000 assets at sf0.1, about 30 bars each)."""
    return (_line_bars(t.lineitem, F.col("l_partkey"))
            .select(F.date_format("_d", "yyyy-MM-dd").alias("date"),
                    "open", "high", "low", "close",
                    F.concat(F.lit("P"), F.col("_a").cast("string")).alias("coin_id"),
                    F.lit(BARS_SOURCE).alias("source"),
                    F.lit(BARS_EXTRACTED_AT).alias("extracted_at")))
