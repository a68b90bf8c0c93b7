import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.operators.series import Frame, row_index, series_window, sliding


def _cols(w):
    return {"lag1": F.lag("v", 1).over(w),
            "ma3": F.avg("v").over(w.rowsBetween(-2, 0)),
            "sum5": F.sum("v").over(w.rowsBetween(-4, 0)),
            "n5": F.count(F.lit(1)).over(w.rowsBetween(-4, 0))}


@pytest.fixture(scope="module")
def skewed(spark):
    rnd = random.Random(7)
    rows = []
    # one hot key with most rows, a few small keys, a NULL key
    for k, n in (("hot", 900), ("a", 40), ("b", 3), (None, 25)):
        days = sorted(rnd.sample(range(5000), n))
        rows += [(k, d, rnd.uniform(-5, 5)) for d in days]
    return spark.createDataFrame(rows, "k string, t long, v double")


@pytest.mark.parametrize("chunk", [5, 16, 97, 1 << 20])
def test_chunked_windows_equal_plain_window(skewed, chunk):
    plain = series_window(skewed, ["k"], ["t"], 4, _cols, chunk_rows=None)
    chunked = series_window(skewed, ["k"], ["t"], 4, _cols, chunk_rows=chunk)
    assert chunked.count() == skewed.count()
    key = lambda r: (r["k"] or "", r["t"])
    p = sorted(plain.collect(), key=key)
    c = sorted(chunked.collect(), key=key)
    for a, b in zip(p, c):
        assert a["lag1"] == b["lag1"] and a["n5"] == b["n5"]
        assert a["ma3"] == pytest.approx(b["ma3"], abs=1e-12)
        assert a["sum5"] == pytest.approx(b["sum5"], abs=1e-12)


def test_chunk_must_exceed_lookback(skewed):
    with pytest.raises(ValueError):
        series_window(skewed, ["k"], ["t"], 4, _cols, chunk_rows=4)


def test_row_index_is_dense_per_key(skewed):
    idx = row_index(skewed, ["k"], ["t"], bucket=F.floor(F.col("t") / 100), name="g")
    w = Window.partitionBy("k").orderBy("t")
    check = idx.withColumn("rn", F.row_number().over(w)).where(F.col("rn") != F.col("g"))
    assert check.count() == 0


def test_result_independent_of_partitioning(skewed):
    a = series_window(skewed.repartition(1), ["k"], ["t"], 4, _cols, chunk_rows=16)
    b = series_window(skewed.repartition(7, "t"), ["k"], ["t"], 4, _cols, chunk_rows=16)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_chunked_windows_over_timestamps(spark):
    import datetime as dt
    rnd = random.Random(5)
    base = dt.datetime(2024, 1, 1)
    rows = [("hot", base + dt.timedelta(minutes=rnd.randrange(60 * 24 * 5)), rnd.random())
            for _ in range(400)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double").dropDuplicates(["k", "t"])
    plain = sorted(series_window(df, ["k"], ["t"], 4, _cols, chunk_rows=None).collect())
    chunked = sorted(series_window(df, ["k"], ["t"], 4, _cols, chunk_rows=7).collect())
    assert len(plain) == len(chunked) == df.count()
    for a, b in zip(plain, chunked):
        assert (a["t"], a["lag1"], a["n5"]) == (b["t"], b["lag1"], b["n5"])
        assert a["ma3"] == pytest.approx(b["ma3"], abs=1e-12)


def test_hot_key_is_spread_over_many_tasks(spark):
    """One asset holding all rows: the plain window puts it in one partition,
    the chunked window spreads it over many (16 chunks of 250 rows)."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        df = spark.range(4000).select(F.when(F.col("id") >= 0, F.lit("hot")).alias("k"),
                                      F.col("id").alias("t"),
                                      (F.col("id") % 13).cast("double").alias("v"))

        def partitions(out):
            # the window column stays referenced, so the window is not pruned
            per = out.select(F.spark_partition_id().alias("pid"), "lag1").groupBy("pid").agg(
                F.count("lag1").alias("n"))
            return per.where("n > 0").count()

        assert partitions(series_window(df, ["k"], ["t"], 4, _cols, chunk_rows=None)) == 1
        assert partitions(series_window(df, ["k"], ["t"], 4, _cols, chunk_rows=250)) >= 6
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_auto_takes_the_plain_window_for_dates_only(spark):
    df = spark.range(50).select(F.lit("k").alias("k"), F.expr("date_add(DATE '2020-01-01', CAST(id AS INT))").alias("d"),
                                F.col("id").alias("t"), F.col("id").cast("double").alias("v"))
    plans = [series_window(df, ["k"], [o], 4, _cols)._jdf.queryExecution().optimizedPlan().toString()
             for o in ("d", "t")]
    assert "_cw_chunk" not in plans[0] and "_cw_chunk" in plans[1]


def test_text_order_needs_a_bucket(spark):
    df = spark.createDataFrame([("k", "2020-01-01", 1.0)], "k string, t string, v double")
    with pytest.raises(TypeError, match="bucket"):
        series_window(df, ["k"], ["t"], 4, _cols)


@pytest.mark.parametrize("rows, chunk", [(1, 3), (2, 3), (5, 7), (30, 64), (400, None), (400, 401), (5000, None)])
def test_sliding_frames_equal_plain_windows(skewed, rows, chunk):
    df = skewed.withColumn("v", F.when(F.col("t") % 7 > 0, F.col("v"))).withColumn("n", (F.col("t") % 5).cast("int"))
    w = Window.partitionBy("k").orderBy("t").rowsBetween(-(rows - 1), 0)
    kinds = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max}
    plain = df.withColumns({f"{c}_{k}": f(c).over(w) for c in "vn" for k, f in kinds.items()})
    frames = {f"{c}_{k}": Frame(c, k, rows) for c in "vn" for k in kinds}
    got = sliding(df, ["k"], ["t"], {**frames, "other": Frame("v", "max", 3)}, chunk, F.floor(F.col("t") / 100))
    assert got.columns == [*df.columns, *frames, "other"]
    key = lambda r: (r["k"] or "", r["t"])
    a, b = sorted(plain.collect(), key=key), sorted(got.collect(), key=key)
    assert len(a) == len(b)
    for x, y in zip(a, b):
        for c in frames:
            exact = c[0] == "n" and c != "n_avg" or c[2:] in ("count", "min", "max")
            assert x[c] == y[c] if exact or x[c] is None else y[c] == pytest.approx(x[c], abs=1e-9), (c, x, y)


def test_sliding_frames_lose_no_digits(spark):
    """A value far larger than the others leaves no trace behind its frame."""
    df = spark.createDataFrame([("a", t, 1e17 if t == 5 else 1.0) for t in range(60)], "k string, t long, v double")
    got = {r.t: r.s for r in sliding(df, ["k"], ["t"], {"s": Frame("v", "sum", 4)}, 16).collect()}
    assert all(got[t] == 4.0 for t in range(9, 60)) and got[0] == 1.0


def test_sliding_frames_that_are_none(skewed):
    for frame in (Frame("v", "median", 3), Frame("v", "sum", 0)):
        with pytest.raises(ValueError):
            sliding(skewed, ["k"], ["t"], {"x": frame})
