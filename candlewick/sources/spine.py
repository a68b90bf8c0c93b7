"""Generated date spine (calendar rows between two dates, both ends in)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Default calendar bounds of the warehouse.
DEFAULT_LO = dt.date(2013, 1, 1)
DEFAULT_HI = dt.date(2030, 12, 31)


def date_spine(spark: SparkSession, lo: dt.date = DEFAULT_LO, hi: dt.date = DEFAULT_HI,
               name: str = "date") -> DataFrame:
    """One row per day from ``lo`` to ``hi`` (DATE column ``name``)."""
    bounds = spark.range(1).select(F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
    return spine_from_bounds(bounds, "lo", "hi", name)


def spine_from_bounds(bounds: DataFrame, lo: str | Column, hi: str | Column,
                      name: str = "date") -> DataFrame:
    """Spine between bounds held in a (one-row) DataFrame, e.g. the
    min/max of a table, so the calendar follows the data without a driver
    round trip.  NULL or crossed bounds give no days."""
    lo = (F.col(lo) if isinstance(lo, str) else lo).cast("date")
    hi = (F.col(hi) if isinstance(hi, str) else hi).cast("date")
    days = F.when(lo <= hi, F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))) \
        .otherwise(F.array().cast("array<date>"))
    return bounds.select(F.explode(days).alias(name))
