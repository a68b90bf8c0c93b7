import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from candlewick.operators import quality
from candlewick.plans.batch import BatchConfig, run_batch, vacuum
from candlewick.session import scratch_path
from candlewick.sources import catalog, csv_bars
from tests.assets import DEFAULT_ASSETS


def _csv(tmp_path, name, start, n, shift=0.0):
    lines = ["SNo,Name,Symbol,Date,High,Low,Open,Close,Volume,Marketcap"]
    for i in range(n):
        d = start + dt.timedelta(days=i)
        o = 100 + i + shift
        lines.append(f"{i},{name},{name},{d} 23:59:59,{o + 5},{o - 5},{o},{o + 1},0,0")
    p = tmp_path / f"{name}.csv"
    p.write_text("\n".join(lines) + "\n")
    return str(p)


def test_run_batch_end_to_end(spark, tmp_path):
    files = {"bitcoin": _csv(tmp_path, "bitcoin", dt.date(2020, 1, 1), 90),
             "ethereum": _csv(tmp_path, "ethereum", dt.date(2020, 2, 1), 60, 3.0),
             "solana": str(tmp_path / "missing.csv")}
    cfg = BatchConfig(silver_db="t_silver", gold_db="t_gold",
                      location=scratch_path(spark, "batch-test"))
    out = run_batch(spark, files, DEFAULT_ASSETS, cfg=cfg, run_ts="2024-01-01T00:00:00Z")
    t = out["tables"]
    assert t["t_gold.fact_price_ohlcv"].count() == 150
    assert t["t_gold.dim_coin"].count() == 3
    assert t["t_gold.dim_date"].count() == 6574
    assert {r["status"] for r in out["report"].collect()} == {"loaded", "missing"}
    assert len(out["checks"]) == 13
    assert all(r["failures"] == 0 for r in out["checks"])
    # running again replaces the tables instead of appending
    out2 = run_batch(spark, files, DEFAULT_ASSETS, cfg=cfg, run_ts="2024-01-02T00:00:00Z")
    assert out2["tables"]["t_gold.fact_price_ohlcv"].count() == 150


def test_a_failing_check_leaves_the_old_gold(spark, tmp_path):
    """Nothing is published that failed; the failing keys are in the error."""
    files = {"bitcoin": _csv(tmp_path, "bitcoin", dt.date(2020, 1, 1), 120)}
    cfg = BatchConfig(silver_db="p_silver", gold_db="p_gold", location=scratch_path(spark, "batch-publish"))
    run_batch(spark, files, DEFAULT_ASSETS, cfg=cfg)
    shown = {t: catalog.current(spark, f"p_gold.{t}") for t in ("fact_price_ohlcv", "dim_coin", "dim_date")}
    more = {"bitcoin": _csv(tmp_path, "more", dt.date(2020, 1, 1), 150)}
    strict = {**quality.STAR_SUITE, "dim_coin": {"columns": {"name": ["unique"], "symbol": [{"unique": {"severity": "error"}}]}}}
    twins = [{**a, "symbol": "SAME"} for a in DEFAULT_ASSETS]
    with pytest.raises(quality.DataQualityError, match="symbol.*SAME"):
        run_batch(spark, more, twins, cfg=dataclasses.replace(cfg, suite=strict))
    assert {t: catalog.current(spark, f"p_gold.{t}") for t in shown} == shown
    assert spark.table("p_gold.fact_price_ohlcv").count() == 120
    assert spark.table("p_silver.ohlcv").count() == 150  # passed its gate
    # a gate that fails leaves silver, too
    with pytest.raises(quality.DataQualityError, match="min_rows"):
        run_batch(spark, {"bitcoin": _csv(tmp_path, "few", dt.date(2020, 1, 1), 20)}, DEFAULT_ASSETS, cfg=cfg)
    assert spark.table("p_silver.ohlcv").count() == 150
    # the old suite passes; versions that nobody shows go with the vacuum
    out = run_batch(spark, more, twins, cfg=cfg)
    assert out["tables"]["p_gold.fact_price_ohlcv"].count() == 150 and out["failing"]().count() == 0
    gone = vacuum(spark, cfg, dt.timedelta(0))
    assert len(gone) >= 6 and all(len(catalog.versions(spark, v.table)) == 1 for v in gone)
    assert spark.newSession().table("p_silver.stg_coin_prices").count() == 150
    assert spark.table("p_gold.fact_price_ohlcv").count() == 150


def test_a_bucketed_fact_is_read_without_a_shuffle_on_its_asset(spark, tmp_path):
    files = {a: _csv(tmp_path, a, dt.date(2020, 1, 1), 60) for a in ("bitcoin", "ethereum")}
    cfg = BatchConfig(silver_db="b_silver", gold_db="b_gold", location=scratch_path(spark, "batch-buckets"), fact_buckets=4)
    fact = run_batch(spark, files, DEFAULT_ASSETS, cfg=cfg)["tables"]["b_gold.fact_price_ohlcv"]
    per = fact.groupBy("coin_sk").agg(F.count("*").alias("n"), F.max("close_price").alias("top"))
    plan = per._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and sorted(r.n for r in per.collect()) == [60, 60]


def test_run_batch_gate_fails_below_minimum(spark, tmp_path):
    files = {"bitcoin": _csv(tmp_path, "bitcoin", dt.date(2020, 1, 1), 20)}
    cfg = BatchConfig(silver_db="g_silver", gold_db="g_gold",
                      location=scratch_path(spark, "batch-gate"))
    with pytest.raises(quality.DataQualityError, match="min_rows"):
        run_batch(spark, files, DEFAULT_ASSETS, cfg=cfg)


def test_run_batch_nothing_loaded(spark, tmp_path):
    with pytest.raises(csv_bars.NoDataError):
        run_batch(spark, {"x": str(tmp_path / "nope.csv")}, DEFAULT_ASSETS,
                  cfg=BatchConfig(location=scratch_path(spark, "batch-none")))


def test_run_batch_gate_fails_without_metadata(spark, tmp_path):
    files = {"bitcoin": _csv(tmp_path, "bitcoin", dt.date(2020, 1, 1), 120)}
    with pytest.raises(quality.DataQualityError, match="coin_metadata"):
        run_batch(spark, files, [], cfg=BatchConfig(silver_db="m_silver", gold_db="m_gold",
                                                    location=scratch_path(spark, "batch-meta")))
