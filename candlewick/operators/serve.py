"""Serving queries on the star schema: KPIs, asset list, price series,
coverage, samples and table counts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import round_away

PRICE_VIEW_COLUMNS = ("open_price", "high_price", "low_price", "close_price",
                      "daily_return_pct", "ma_7d", "ma_30d")


def kpi_total_records(fact: DataFrame) -> DataFrame:
    return fact.agg(F.count(F.lit(1)).alias("total_records"))


def kpi_assets_tracked(fact: DataFrame) -> DataFrame:
    """Exact distinct asset keys (NULL keys not counted)."""
    return fact.agg(F.countDistinct("coin_sk").alias("assets_tracked"))


def kpi_latest_date(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Latest calendar date that has a fact row.

    The fact is first reduced to its distinct date keys (map-side), so
    only one row per day reaches the join."""
    days = fact.select("date_id").where(F.col("date_id").isNotNull()).distinct()
    return (days.join(dim_date.select("date_id", "date"), "date_id")
            .agg(F.max("date").alias("latest_date")))


def asset_list(dim_asset: DataFrame) -> DataFrame:
    """Asset picker: id, symbol, name ordered by name."""
    return dim_asset.select("coin_id", "symbol", "name").orderBy("name", "coin_id")


def asset_key(asset_id: str | Column) -> Column:
    """Surrogate key of a natural asset id (same md5 rule as the dim)."""
    return F.md5(asset_id if isinstance(asset_id, Column) else F.lit(asset_id))


def price_series(fact: DataFrame, dim_asset: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Every asset's price series: (date, symbol, prices, return, MAs)."""
    return (fact.join(dim_asset.select("coin_sk", "symbol"), "coin_sk")
            .join(dim_date.select("date_id", "date"), "date_id")
            .select("date", "symbol", *PRICE_VIEW_COLUMNS))


def price_view(fact: DataFrame, dim_asset: DataFrame, dim_date: DataFrame, asset_id: str,
               lo: dt.date | None = None, hi: dt.date | None = None) -> DataFrame:
    """One asset's price series (8 columns) ordered by date."""
    return _asset_series(fact, dim_asset, dim_date, asset_id, lo, hi).select(
        "date", *PRICE_VIEW_COLUMNS).orderBy("date")


def _asset_series(fact: DataFrame, dim_asset: DataFrame, dim_date: DataFrame, asset_id: str,
                  lo: dt.date | None = None, hi: dt.date | None = None) -> DataFrame:
    """One asset's price series ordered by date.

    The asset filter is stated on the fact's own key (md5 of the id) as
    well, and an optional date range on ``date_id`` (yyyymmdd is monotone
    in the date), so both reach the fact scan instead of waiting for the
    dimension joins."""
    f = fact.where(F.col("coin_sk") == asset_key(asset_id))
    cal = dim_date.select("date_id", "date")
    if lo is not None:
        f = f.where(F.col("date_id") >= int(lo.strftime("%Y%m%d")))
        cal = cal.where(F.col("date") >= F.lit(lo))
    if hi is not None:
        f = f.where(F.col("date_id") <= int(hi.strftime("%Y%m%d")))
        cal = cal.where(F.col("date") <= F.lit(hi))
    # at most one row (the dimension holds one row per asset): a proven bound
    assets = dim_asset.where(F.col("coin_id") == asset_id).select("coin_sk", "symbol")
    return (f.join(F.broadcast(assets), "coin_sk")
            .join(cal, "date_id")
            .select("date", "symbol", *PRICE_VIEW_COLUMNS))


def price_month_slice(fact: DataFrame, dim_asset: DataFrame, dim_date: DataFrame,
                      asset_id: str, year: int, month: int) -> DataFrame:
    """Documented example: one asset's bars of one calendar month, as a
    date range (sargable) rather than extract(year)/extract(month)."""
    lo = dt.date(year, month, 1)
    hi = (dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=1))
    return _asset_series(fact, dim_asset, dim_date, asset_id, lo, hi).select(
        "date", "symbol", "open_price", "high_price", "low_price", "close_price",
        "ma_7d", "ma_30d").orderBy("date")


def coverage_by_asset(fact: DataFrame, dim_asset: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per asset: records, first and last date, span in days (0 if none)."""
    joined = (fact.select("coin_sk", "date_id")
              .join(dim_asset.select("coin_sk", "symbol", "name"), "coin_sk")
              .join(dim_date.select("date_id", "date"), "date_id"))
    return (joined.groupBy("symbol", "name")
            .agg(F.count(F.lit(1)).alias("records"),
                 F.min("date").alias("first_date"), F.max("date").alias("last_date"))
            .withColumn("days", F.coalesce(F.datediff("last_date", "first_date"), F.lit(0)))
            .orderBy(F.desc("records"), "symbol"))


def coverage_total(fact: DataFrame, dim_asset: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Per-asset record counts plus a grand-total row (symbol NULL), in one
    aggregation with grouping sets."""
    joined = (fact.select("coin_sk", "date_id")
              .join(dim_asset.select("coin_sk", "symbol", "name"), "coin_sk")
              .join(dim_date.select("date_id"), "date_id"))
    return (joined.groupingSets([["symbol", "name"], []], "symbol", "name")
            .agg(F.count(F.lit(1)).alias("records"),
                 F.grouping_id().alias("is_total")))


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """UNION ALL of one-row counts, ordered by table name."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
               .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy("table_name")


def latest_sample(fact: DataFrame, dim_asset: DataFrame, k: int = 10) -> DataFrame:
    """Latest ``k`` fact rows (by date key, then symbol) with prices
    rounded to 2 digits."""
    return (fact.join(dim_asset.select("coin_sk", "symbol"), "coin_sk")
            .select("date_id", "symbol",
                    round_away("open_price", 2).alias("open"),
                    round_away("high_price", 2).alias("high"),
                    round_away("low_price", 2).alias("low"),
                    round_away("close_price", 2).alias("close"),
                    round_away("daily_return_pct", 2).alias("return_pct"))
            .orderBy(F.desc_nulls_last("date_id"), "symbol")
            .limit(k))


def dim_date_latest(dim_date: DataFrame, k: int = 5) -> DataFrame:
    """Latest ``k`` calendar rows with a Yes/No weekend label."""
    return (dim_date.select("date_id", "date", "year", "month", "day_name",
                            F.when(F.col("is_weekend"), "Yes").otherwise("No").alias("is_weekend"),
                            "season")
            .orderBy(F.desc("date")).limit(k))


class EmptyResult(LookupError):
    """A serving query found no rows (e.g. an unknown asset id)."""


def require_rows(df: DataFrame, what: str = "result") -> DataFrame:
    """Stop early on an empty result (one cheap ``isEmpty`` probe that
    reads at most one row), returning ``df`` unchanged otherwise."""
    if df.isEmpty():
        raise EmptyResult(f"no rows for {what}")
    return df
