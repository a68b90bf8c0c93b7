import math

import pytest
from pyspark.sql import functions as F

from candlewick.functions import date_id, is_weekend, parse_number, round_away, safe_corr, safe_pct, season


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], list(cols)) if cols else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize("value,digits,expected", [
    (1.005, 2, 1.0), (0.285, 2, 0.28), (2.5, 0, 3.0), (-2.5, 0, -3.0), (0.125, 2, 0.13),
    (12345.678912345, 8, 12345.67891235),
])
def test_round_away_matches_binary_half_away(spark, value, digits, expected):
    assert one(spark, round_away(F.lit(value), digits)) == expected


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_safe_pct_zero_open_is_null(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        assert one(spark, safe_pct(F.lit(5.0), F.lit(0.0))) is None
        assert one(spark, safe_pct(F.lit(0.5), F.lit(10.0))) == 5.0
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("text,expected", [
    ("12d", None), ("NaN", None), ("-", None), ("1,234.5", None), ("oops", None), ("", None),
    (" 12.5 ", 12.5), ("1e3", 1000.0), ("-.5", -0.5), ("+7", 7.0), ("inf", math.inf),
    ("-Infinity", -math.inf), ("\t-inf", -math.inf), ("\t 7", 7.0),
])
def test_parse_number(spark, text, expected):
    assert one(spark, parse_number(F.col("t")), t=text) == expected


def test_safe_corr_null_cases(spark):
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "x double, y double")
    assert flat.agg(safe_corr("x", "y").alias("r")).first()["r"] is None
    single = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "x double, y double")
    assert single.agg(safe_corr("x", "y").alias("r")).first()["r"] is None
    line = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5), (None, 1.0)],
                                 "x double, y double")
    r = line.agg(safe_corr("x", "y").alias("r")).first()["r"]
    import numpy as np
    assert r == pytest.approx(np.corrcoef([1, 2, 3], [2, 4, 6.5])[0, 1], abs=1e-12)


@pytest.mark.parametrize("d,did,weekend,seas", [
    ("2013-01-01", 20130101, False, "Winter"), ("2013-01-05", 20130105, True, "Winter"),
    ("2016-01-01", 20160101, False, "Winter"), ("2016-02-29", 20160229, False, "Winter"),
    ("2018-12-31", 20181231, False, "Winter"), ("2030-12-31", 20301231, False, "Winter"),
    ("2021-07-04", 20210704, True, "Summer"), ("2021-04-10", 20210410, True, "Spring"),
    ("2021-10-15", 20211015, False, "Fall"),
])
def test_calendar_functions(spark, d, did, weekend, seas):
    c = F.to_date(F.lit(d))
    assert one(spark, date_id(c)) == did
    assert one(spark, is_weekend(c)) is weekend
    assert one(spark, season(c)) == seas
