"""Silver -> staged prices: casts, flags, quality filter, dedup, union."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions import round_away

PRICE_COLUMNS = ("open", "high", "low", "close")
SILVER_COLUMNS = ("date", "open", "high", "low", "close", "coin_id", "source", "extracted_at")
PRICE_DIGITS = 8


def utc_text_to_ntz(c) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` text -> TIMESTAMP_NTZ holding the UTC wall
    clock (independent of the session time zone); malformed -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, "Z$", "").try_cast("timestamp_ntz")


def has_null_price(open_c="open", close_c="close") -> Column:
    """Open or close missing (high/low are not looked at)."""
    return F.col(open_c).isNull() | F.col(close_c).isNull()


def is_invalid_bar(high_c="high", low_c="low") -> Column:
    """High below low; a NULL operand counts as valid."""
    return F.coalesce(F.col(high_c) < F.col(low_c), F.lit(False))


def stage_sql(table: str) -> str:
    """:func:`stage_prices` of a silver table as SQL text, for a catalog view."""
    prices = ", ".join(f"round(CAST({c} AS DOUBLE) * 1e{PRICE_DIGITS}D, 0) / 1e{PRICE_DIGITS}D AS {c}_price"
                       for c in PRICE_COLUMNS)
    return (f"SELECT coin_id, to_date(date) AS price_date, {prices}, source, "
            "try_cast(regexp_replace(extracted_at, 'Z$', '') AS TIMESTAMP_NTZ) AS extracted_at, "
            "open IS NULL OR close IS NULL AS has_null_price, "
            "coalesce(high < low, false) AS is_invalid_ohlc "
            f"FROM {table} WHERE coin_id IS NOT NULL AND date IS NOT NULL")


def stage_prices(silver: DataFrame) -> DataFrame:
    """Silver bars -> staged prices (typed, rounded, flagged).

    Keeps rows with an asset and a date; prices are rounded to 8 digits,
    the date text becomes a DATE and the load stamp a timestamp.
    """
    return (silver.where(F.col("coin_id").isNotNull() & F.col("date").isNotNull())
            .select(
                "coin_id",
                F.to_date("date").alias("price_date"),
                *[round_away(F.col(c).cast("double"), PRICE_DIGITS).alias(f"{c}_price")
                  for c in PRICE_COLUMNS],
                "source",
                utc_text_to_ntz("extracted_at").alias("extracted_at"),
                has_null_price().alias("has_null_price"),
                is_invalid_bar().alias("is_invalid_ohlc")))


def filter_valid_bars(staged: DataFrame) -> DataFrame:
    """Drop flagged rows (NULL open/close, high < low)."""
    return staged.where(~F.col("has_null_price") & ~F.col("is_invalid_ohlc"))


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per key: the one with the lowest ``order`` tuple
    (default: all other columns in schema order).

    A grouped ``min_by`` is combined map-side, so a key duplicated a
    million times costs a million comparisons in many tasks, not one
    sort of the whole group in one task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = list(order) if order else rest
    if not rest:
        return df.select(*keys).distinct()
    # one struct (order columns first, the rest as tie-break): its minimum
    # is the kept row, cheaper than min_by over two structs
    tail = [c for c in rest if c not in order]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*order, *tail)).alias("_kept"))
    return kept.select(*keys, *[F.col(f"_kept.{c}").alias(c) for c in rest]).select(*df.columns)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate frames by column name (missing columns -> NULL)."""
    frames = list(frames)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
