import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from candlewick.operators import serve
from candlewick.session import scratch_path
from candlewick.sources import catalog, fs


def test_write_replace_discover(spark):
    loc = scratch_path(spark, "cat-test")
    catalog.ensure_database(spark, "cat_gold", loc)
    df = spark.range(5).withColumnRenamed("id", "v")
    catalog.write_table(df, "cat_gold.fact_price_ohlcv", location=loc)
    catalog.write_table(df.where("v < 2"), "cat_gold.fact_price_ohlcv", location=loc)
    assert spark.table("cat_gold.fact_price_ohlcv").count() == 2  # replaced, not appended
    assert catalog.table_exists(spark, "cat_gold.fact_price_ohlcv")
    assert not catalog.table_exists(spark, "cat_gold.nope")
    assert catalog.find_database(spark, "fact_price_ohlcv") == "cat_gold"
    assert catalog.find_database(spark, "never_written") is None
    listed = [(r["table_schema"], r["table_name"]) for r in catalog.list_tables(spark).collect()]
    assert ("cat_gold", "fact_price_ohlcv") in listed
    assert listed == sorted(set(listed))


def test_require_rows(spark):
    df = spark.range(3)
    assert serve.require_rows(df) is df
    with pytest.raises(serve.EmptyResult):
        serve.require_rows(df.where("id > 10"), "asset x")


def folders(spark, loc, table="t"):
    return len(fs.subfolders(spark, f"{loc}/{table}", ""))


def test_a_failing_write_leaves_the_old_rows_and_no_folder(spark):
    loc = scratch_path(spark, "cat-atomic")
    catalog.ensure_database(spark, "cat_atomic", loc)
    name, df = "cat_atomic.t", spark.range(5).withColumnRenamed("id", "v")
    for k in (1, 2, 3):
        catalog.write_table(df.where(f"v < {k}"), name, location=loc)
    fail = df.select(F.when(F.col("v") > 2, F.raise_error(F.lit("boom")).cast("long")).otherwise(F.col("v")).alias("v"))
    with pytest.raises(Exception, match="boom"):
        catalog.write_table(fail, name, location=loc)
    assert sorted(r.v for r in spark.table(name).collect()) == [0, 1, 2]
    assert folders(spark, loc) == len(catalog.versions(spark, name)) == 3
    # other columns are shown by the same call
    catalog.write_table(df.withColumn("w", F.lit("x")), name, location=loc)
    assert spark.table(name).columns == ["v", "w"] and spark.table(name).count() == 5


def test_a_scan_opened_before_a_replace_finishes(spark):
    loc = scratch_path(spark, "cat-readers")
    catalog.ensure_database(spark, "cat_readers", loc)
    name, df = "cat_readers.t", spark.range(1000).withColumnRenamed("id", "v")
    catalog.write_table(df, name, location=loc)
    before, half = spark.table(name), spark.table(name).toLocalIterator()
    assert next(half).v is not None
    catalog.write_table(df.where("v < 3").withColumn("w", F.lit(1)), name, location=loc)
    assert before.count() == 1000 and sum(1 for _ in half) == 999
    assert spark.table(name).count() == 3
    other = spark.newSession()
    assert other.table(name).columns == ["v", "w"]


def test_vacuum_keeps_what_is_shown_new_or_young(spark):
    loc = scratch_path(spark, "cat-vacuum")
    catalog.ensure_database(spark, "cat_vacuum", loc)
    name, df = "cat_vacuum.t", spark.range(9).withColumnRenamed("id", "v")
    made = [catalog.write_version(df.where(f"v < {k}"), name, location=loc) for k in range(1, 5)]
    assert catalog.current(spark, name) is None and not catalog.table_exists(spark, name)
    assert catalog.versions(spark, name) == made and made == sorted(made, key=lambda v: v.written)
    catalog.publish(spark, made[0])  # an old one
    assert spark.table(name).count() == 1 and catalog.current(spark, name) == made[0]
    assert catalog.vacuum(spark, name, dt.timedelta(hours=1)) == []
    assert catalog.vacuum(spark, name, dt.timedelta(0)) == made[1:3]
    assert catalog.versions(spark, name) == [made[0], made[3]] and folders(spark, loc) == 2
    assert spark.table(name).count() == 1
    assert catalog.vacuum(spark, name, dt.timedelta(0), keep=0) == [made[3]]
    # tables of similar names have versions of their own
    catalog.write_table(df, "cat_vacuum.t__x", location=loc)
    assert len(catalog.versions(spark, name)) == 1
    listed = {(r.table_schema, r.table_name) for r in catalog.list_tables(spark).collect()}
    assert {("cat_vacuum", "t"), ("cat_vacuum", "t__x")} <= listed
    assert not any(db.endswith(catalog.VERSIONS) for db, _ in listed)


def test_a_bucketed_version_needs_no_shuffle(spark):
    loc = scratch_path(spark, "cat-buckets")
    catalog.ensure_database(spark, "cat_buckets", loc)
    df = spark.range(2000).select((F.col("id") % 40).alias("k"), F.col("id").alias("v"))
    catalog.write_table(df, "cat_buckets.t", ["k", "v"], location=loc, bucket_by=("k", 4))
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        t = spark.table("cat_buckets.t")
        w = Window.partitionBy("k").orderBy("v")
        for read in (t.groupBy("k").agg(F.sum("v").alias("s")), t.withColumn("before", F.lag("v").over(w)),
                     t.join(t.withColumnRenamed("v", "x"), "k")):
            plan = read._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "Bucketed: true" in plan, plan
        assert {r.k: r.s for r in t.groupBy("k").agg(F.sum("v").alias("s")).collect()} == {
            k: sum(range(k, 2000, 40)) for k in range(40)}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_catalog_view_is_read_by_other_sessions(spark):
    loc = scratch_path(spark, "cat-view")
    catalog.ensure_database(spark, "cat_view", loc)
    catalog.write_table(spark.range(3), "cat_view.t", location=loc)
    catalog.create_sql_view(spark, "cat_view.twice", "SELECT id * 2 AS id FROM cat_view.t")
    catalog.write_table(spark.range(5), "cat_view.t", location=loc)
    assert sorted(r.id for r in spark.newSession().table("cat_view.twice").collect()) == [0, 2, 4, 6, 8]
