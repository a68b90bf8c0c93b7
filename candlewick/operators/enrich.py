"""Staged prices -> enriched prices (range, return, change, moving averages)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.functions import round_away, safe_pct
from candlewick.operators.clean import PRICE_DIGITS, filter_valid_bars
from candlewick.operators.series import AUTO, series_window

DEFAULT_WINDOWS = {"ma_7d": 7, "ma_30d": 30}
RETURN_DIGITS = 4


def daily_range(high="high_price", low="low_price"):
    return round_away(F.col(high) - F.col(low), PRICE_DIGITS)


def daily_return(open_="open_price", close="close_price"):
    """Open-to-close return in percent; NULL when open is 0."""
    return safe_pct(F.col(close) - F.col(open_), F.col(open_), RETURN_DIGITS)


def enrich(staged: DataFrame, key: str = "coin_id", order: str = "price_date",
           close: str = "close_price", windows: Mapping[str, int] = DEFAULT_WINDOWS,
           chunk_rows: int | str | None = AUTO, apply_filter: bool = True) -> DataFrame:
    """Quality filter, then per-bar measures and row-based windows.

    Windows count rows that survived the filter (not calendar days):
    ``price_change`` is close minus the previous surviving close and
    each moving average covers the last ``n`` surviving rows (a partial
    frame at the start of a series).
    """
    prices = filter_valid_bars(staged) if apply_filter else staged
    lookback = max([1, *[n - 1 for n in windows.values()]])
    c = F.col(close)

    def columns(w: Window):
        out = {"price_change": round_away(c - F.lag(c, 1).over(w), PRICE_DIGITS)}
        for name, n in windows.items():
            out[name] = round_away(F.avg(c).over(w.rowsBetween(-(n - 1), 0)), PRICE_DIGITS)
        return out

    measured = prices.select(
        key, order, "open_price", "high_price", "low_price", "close_price",
        daily_range().alias("daily_range"), daily_return().alias("daily_return_pct"),
        "source", "extracted_at")
    out = series_window(measured, [key], [order], lookback, columns, chunk_rows)
    return out.select(key, order, "open_price", "high_price", "low_price", "close_price",
                      "daily_range", "daily_return_pct", "price_change", *windows.keys(),
                      "source", "extracted_at")
