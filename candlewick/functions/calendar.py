"""Calendar attributes of a DATE column (locale: English, ISO weeks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Season of each month.
WINTER_MONTHS = (12, 1, 2)
SPRING_MONTHS = (3, 4, 5)
SUMMER_MONTHS = (6, 7, 8)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_id(d) -> Column:
    """yyyymmdd as INT (20240131)."""
    return F.date_format(_col(d), "yyyyMMdd").cast("int")


def is_weekend(d) -> Column:
    """Saturday or Sunday.  ``dayofweek`` is 1 = Sunday ... 7 = Saturday."""
    return F.dayofweek(_col(d)).isin(1, 7)


def season(d) -> Column:
    m = F.month(_col(d))
    return (
        F.when(m.isin(*WINTER_MONTHS), "Winter")
        .when(m.isin(*SPRING_MONTHS), "Spring")
        .when(m.isin(*SUMMER_MONTHS), "Summer")
        .otherwise("Fall")
    )
