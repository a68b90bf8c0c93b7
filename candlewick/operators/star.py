"""Star schema: asset dimension, calendar dimension, price fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import date_id, is_weekend, season

def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Newest row per key: greatest ``order`` tuple, then the greatest
    remaining values as a deterministic tie-break.

    A grouped ``max`` of one struct (map-side combined) instead of
    ROW_NUMBER = 1, so a key with millions of versions never lands in one
    task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    ranking = F.struct(*order, *[c for c in rest if c not in order])
    return (df.groupBy(*keys).agg(F.max(ranking).alias("_row"))
            .select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])
            .select(*df.columns))


def dim_asset(meta: DataFrame, updated_at: Column | None = None) -> DataFrame:
    """Asset dimension: latest metadata per asset, md5 surrogate key."""
    latest = latest_per_key(meta, ["coin_id"], ["extracted_at"])
    cols = [F.md5("coin_id").alias("coin_sk"), "coin_id", "symbol", "name", "categories",
            "genesis_date", "hashing_algorithm"]
    if updated_at is not None:
        cols.append(updated_at.alias("dbt_updated_at"))
    return latest.select(*cols)


def dim_date(spine: DataFrame, date_col: str = "date") -> DataFrame:
    """Calendar dimension over a date spine (English names, ISO weeks)."""
    d = F.col(date_col)
    return spine.select(
        date_id(d).alias("date_id"),
        d.alias("date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        F.quarter(d).alias("quarter"),
        F.weekofyear(d).alias("week_of_year"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        is_weekend(d).alias("is_weekend"),
        season(d).alias("season"))


def fact_price(enriched: DataFrame, dim_asset_df: DataFrame, dim_date_df: DataFrame) -> DataFrame:
    """Price fact: enriched rows with asset and calendar keys.

    Left joins, so a bar without metadata or outside the calendar keeps
    its row with a NULL key.  No broadcast is forced: a dimension is
    broadcast if its measured size (files of a stored table, shuffle
    output otherwise) is below the session's threshold, else the join is a
    sort-merge join whose skewed partitions AQE splits.
    """
    assets = dim_asset_df.select("coin_sk", "coin_id")
    days = dim_date_df.select("date_id", F.col("date").alias("_cal_date"))
    e = enriched
    return (e.join(assets, "coin_id", "left")
            .join(days, e["price_date"] == days["_cal_date"], "left")
            .select(
                F.md5(F.concat(F.col("coin_id"), F.lit("|"),
                               F.col("price_date").cast("string"))).alias("price_sk"),
                "coin_sk", "date_id",
                F.col("source").alias("source_system"),
                "open_price", "high_price", "low_price", "close_price",
                "daily_range", "daily_return_pct", "price_change", "ma_7d", "ma_30d",
                "extracted_at"))
