import datetime as dt

from pyspark.sql import functions as F

from candlewick.operators import star
from candlewick.sources import literal
from candlewick.sources.spine import date_spine
from tests.assets import DEFAULT_ASSETS


def test_dim_date_default_calendar(spark):
    dd = star.dim_date(date_spine(spark))
    assert dd.count() == 6574
    rows = {r["date"]: r for r in dd.where(F.col("date").isin(
        [dt.date(2013, 1, 1), dt.date(2013, 1, 5), dt.date(2016, 1, 1), dt.date(2016, 2, 29),
         dt.date(2018, 12, 31), dt.date(2030, 12, 31)])).collect()}
    expect = {
        dt.date(2013, 1, 1): (20130101, 1, 1, "Tuesday", "January", False, "Winter"),
        dt.date(2013, 1, 5): (20130105, 1, 1, "Saturday", "January", True, "Winter"),
        dt.date(2016, 1, 1): (20160101, 1, 53, "Friday", "January", False, "Winter"),
        dt.date(2016, 2, 29): (20160229, 1, 9, "Monday", "February", False, "Winter"),
        dt.date(2018, 12, 31): (20181231, 4, 1, "Monday", "December", False, "Winter"),
        dt.date(2030, 12, 31): (20301231, 4, 1, "Tuesday", "December", False, "Winter"),
    }
    for d, (did, q, wk, dn, mn, we, se) in expect.items():
        r = rows[d]
        assert (r["date_id"], r["quarter"], r["week_of_year"], r["day_name"], r["month_name"],
                r["is_weekend"], r["season"]) == (did, q, wk, dn, mn, we, se)
    assert dd.select("date_id").distinct().count() == 6574


def test_dim_asset_keys_and_latest_version(spark):
    rows = [dict(r, extracted_at="2024-01-02T00:00:00Z") for r in DEFAULT_ASSETS]
    old = dict(DEFAULT_ASSETS[0], name="Old Bitcoin", extracted_at="2023-01-01T00:00:00Z")
    meta = literal.metadata_rows(spark, rows + [old])
    dim = {r["coin_id"]: r for r in star.dim_asset(meta).collect()}
    assert dim["bitcoin"]["coin_sk"] == "cd5b1e4947e304476c788cd474fb579a"
    assert dim["ethereum"]["coin_sk"] == "1878af797413f4c4f7a2d7adc97d19ea"
    assert dim["solana"]["coin_sk"] == "c131f4d1e884d3c88cd6c2c8738d816b"
    assert dim["bitcoin"]["name"] == "Bitcoin"


def test_latest_per_key_tie_is_deterministic(spark):
    df = spark.createDataFrame(
        [("k", "2024", "a"), ("k", "2024", "c"), ("k", "2023", "z"), ("j", "2020", "q")],
        "key string, ts string, v string")
    for parts in (1, 3):
        got = {r["key"]: r["v"] for r in
               star.latest_per_key(df.repartition(parts), ["key"], ["ts"]).collect()}
        assert got == {"k": "c", "j": "q"}


def test_fact_keeps_unmatched_rows_with_null_keys(spark):
    enriched = spark.createDataFrame(
        [("bitcoin", dt.date(2020, 1, 1), 1.0), ("nocoin", dt.date(1999, 1, 1), 2.0)],
        "coin_id string, price_date date, close_price double")
    for c in ("open_price", "high_price", "low_price", "daily_range", "daily_return_pct",
              "price_change", "ma_7d", "ma_30d"):
        enriched = enriched.withColumn(c, F.lit(None).cast("double"))
    enriched = enriched.withColumn("source", F.lit("x")).withColumn(
        "extracted_at", F.lit(None).cast("timestamp_ntz"))
    fact = star.fact_price(enriched, star.dim_asset(literal.metadata_rows(spark, DEFAULT_ASSETS)),
                           star.dim_date(date_spine(spark)))
    rows = {r["price_sk"]: r for r in fact.collect()}
    assert len(rows) == 2
    got = [r for r in rows.values() if r["close_price"] == 2.0][0]
    assert got["coin_sk"] is None and got["date_id"] is None
    ok = [r for r in rows.values() if r["close_price"] == 1.0][0]
    assert ok["date_id"] == 20200101 and ok["coin_sk"] == "cd5b1e4947e304476c788cd474fb579a"


def test_spine_is_not_clamped(spark):
    dd = star.dim_date(date_spine(spark, dt.date(1890, 1, 1), dt.date(2250, 12, 31)))
    r = dd.agg(F.count("*").alias("n"), F.min("date_id").alias("lo"), F.max("date_id").alias("hi")).first()
    assert (r["n"], r["lo"], r["hi"]) == ((dt.date(2250, 12, 31) - dt.date(1890, 1, 1)).days + 1,
                                          18900101, 22501231)
    assert date_spine(spark, dt.date(2020, 1, 2), dt.date(2020, 1, 1)).count() == 0
