import math
import random
import re
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from candlewick.functions import exact_parts
from candlewick.operators import stats


@pytest.fixture(scope="module")
def values(spark):
    rnd = random.Random(3)
    rows = []
    for k, n in (("x", 501), ("y", 64), ("z", 1), ("w", 2)):
        for _ in range(n):
            v = rnd.choice([0.0, 0.0, 1.5]) if rnd.random() < 0.3 else rnd.gauss(0, 10)
            rows.append((k, v))
    rows.append(("x", None))
    rows.append(("c", 7.25))
    rows.append(("c", 7.25))
    # one extreme outlier: equal-width bins would put everything in one bin
    rows += [("o", rnd.random()) for _ in range(300)] + [("o", 1e9)]
    # heavy duplicates at the quantiles themselves
    rows += [("d", 0.0)] * 400 + [("d", -1.0), ("d", 2.0), ("d", 3.0)]
    return spark.createDataFrame(rows, "k string, v double")


def test_exact_quantiles_match_numpy(values):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {r["k"]: [r[f"q_{i}"] for i in range(len(probs))]
           for r in stats.exact_quantiles(values, "v", probs, ["k"]).collect()}
    pdf = values.toPandas().dropna()
    assert set(got) == set(pdf["k"])
    for k, g in pdf.groupby("k"):
        want = np.quantile(g["v"].to_numpy(), probs, method="linear")
        assert got[k] == pytest.approx(list(want), abs=1e-9), k


def test_exact_quantiles_without_and_with_null_keys(values, spark):
    v = values.where("k = 'o'")
    r = stats.exact_quantiles(v, "v", [0.5]).first()
    assert r["q_0"] == pytest.approx(float(np.median(v.toPandas()["v"])), abs=1e-12)
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", 5.0)], "k string, v double")
    assert {r["k"]: r["q_0"] for r in stats.exact_quantiles(df, "v", [0.5], ["k"]).collect()} == \
        {None: 1.5, "a": 5.0}


def test_quantile_ranks_of_a_hot_key_lie_in_many_partitions(spark):
    """One key with all values: its values are ranked in as many tasks as
    there are range partitions, and only those with a wanted rank are read."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    parts = []
    write = stats.written
    stats.written = lambda df, name: parts.append((name, write(df, name))) or parts[-1][1]
    try:
        df = spark.range(40_000).select(F.lit("hot").alias("k"), (F.col("id") * 7919 % 40_009).cast("double").alias("v"))
        q = stats.exact_quantiles(df, "v", [0.25, 0.5], ["k"]).first()
        want = np.quantile(df.toPandas()["v"], [0.25, 0.5])
        assert [q["q_0"], q["q_1"]] == pytest.approx(list(want))
        sizes = [r["count"] for r in dict(parts)["quantile-parts"].groupBy("_p").count().collect()]
        assert len(sizes) >= 12 and max(sizes) < 10_000
        assert dict(parts)["quantile-ranks"].select("_q").distinct().count() <= 4
    finally:
        stats.written = write
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_describe_keeps_every_value_in_the_mean(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame([(1e28,), (3.0,), (None,), (float("nan"),)], "v double")
        r = stats.describe(df, ["v"]).first()
        assert (r["count"], r["mean"], r["min"], r["max"]) == (2, 5e27, 3.0, 1e28)
        small = stats.describe(spark.createDataFrame([(1e-11,), (3e-11,)], "v double"), ["v"], digits=12).first()
        assert small["mean"] == pytest.approx(2e-11)
        for v in (1e8, 1.5e9, 1e12):
            r = stats.describe(spark.createDataFrame([(v,)] * 10, "v double"), ["v"]).first()
            assert r["mean"] == r["min"] == r["max"] == v
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_a_column_without_a_value_has_a_row(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 2.0, None), (None, None, float("nan"))],
                               "k string, v double, w double")
    got = {(r.k, r.column): (r["count"], r["mean"], r["p50"], r["max"]) for r in stats.describe(df, ["v", "w"], ["k"]).collect()}
    none = (0, None, None, None)
    assert got == {("a", "v"): (2, 1.5, 1.5, 2.0), ("a", "w"): none, (None, "v"): none, (None, "w"): none}


EDGES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 1.0, -1.0, 2.0 ** 62, 2.0 ** 63,
         -2.0 ** -54, 0.1, 1e16, -1e16, 1e-300, 3.0, 2.0 ** 8 - 2.0 ** -45]


def test_exact_sums_are_those_of_fractions(spark):
    """Any doubles, in any order and partitioning: rounded once."""
    rng = random.Random(11)
    groups = {"edges": EDGES, "cancel": [1e308, 1.0, -1e308, 1e-20], "none": []}
    for g in range(12):
        groups[f"r{g}"] = [rng.choice([-1, 1]) * math.ldexp(rng.getrandbits(53), rng.randint(-1126, 900))
                           for _ in range(rng.randint(1, 60))]
    groups["money"] = [rng.randint(-10 ** 7, 10 ** 7) / 100 for _ in range(3000)]
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("none", None), ("none", float("nan")), ("money", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double")
    want = {k: (len(vs), float(sum(map(Fraction, vs))) if vs else None) for k, vs in groups.items()}
    for frame in (df, df.repartition(7).sortWithinPartitions(F.desc("v")), df.coalesce(1)):
        assert {r.k: (r.n, r.total) for r in stats.exact_sums(frame, "v", ["k"]).collect()} == want
    one = stats.exact_sums(df.where("k = 'money'"), "v").first()
    assert (one.n, one.total) == want["money"]
    inf = float("inf")
    odd = spark.createDataFrame([("u", inf), ("u", 1.0), ("d", -inf), ("b", inf), ("b", -inf), ("o", 1.7e308), ("o", 1.7e308)],
                                "k string, v double")
    got = {r.k: r.total for r in stats.exact_sums(odd, "v", ["k"]).collect()}
    assert (got["u"], got["d"], got["o"]) == (inf, -inf, inf) and math.isnan(got["b"])


def test_exact_parts_lose_no_digit(spark):
    place, whole = exact_parts("v")
    for r in spark.createDataFrame([(v,) for v in EDGES], "v double").select("v", place.alias("p"), whole.alias("w")).collect():
        assert Fraction(r.v) == r.w * Fraction(2) ** (8 * r.p)


def test_describe_matches_pandas(values):
    d = {(r["k"], r["column"]): r for r in stats.describe(values, ["v"], ["k"]).collect()}
    pdf = values.toPandas()
    for k, g in pdf.groupby("k"):
        desc = g["v"].describe()
        r = d[(k, "v")]
        assert r["count"] == desc["count"]
        assert r["mean"] == pytest.approx(round(desc["mean"], 4), abs=1e-4)
        for mine, theirs in (("p25", "25%"), ("p50", "50%"), ("p75", "75%"),
                             ("min", "min"), ("max", "max")):
            assert r[mine] == pytest.approx(round(desc[theirs], 4), abs=1e-4)
        if desc["count"] > 1:
            assert r["std"] == pytest.approx(round(desc["std"], 4), abs=1e-4)
        else:
            assert r["std"] is None


def test_histogram_counts_sum_to_non_null(values):
    h = stats.histogram(values, "v", ["k"], bins=50)
    per = {r["k"]: r["n"] for r in h.groupBy("k").agg(F.sum("count").alias("n")).collect()}
    assert per == {"x": 501, "y": 64, "z": 1, "w": 2, "c": 2, "o": 301, "d": 403}
    assert h.groupBy("k").count().where("count != 50").count() == 0
    # constant series: everything in bin 0
    c = {r["bin"]: r["count"] for r in h.where("k = 'c'").collect()}
    assert c[0] == 2 and sum(c.values()) == 2


@pytest.fixture(scope="module")
def returns(spark):
    rnd = random.Random(11)
    rows = []
    dates = pd.date_range("2020-01-01", periods=120).date
    for s in ["A", "B", "C", "D", "E"]:
        for d in dates:
            if rnd.random() < (0.97 if s != "E" else 0.6):
                rows.append((d, s, rnd.gauss(0, 2) + (0.5 if s == "B" else 0.0)))
    rows += [(d, "FLAT", 1.0) for d in dates[:40]]
    return spark.createDataFrame(rows, "date date, symbol string, daily_return_pct double")


@pytest.fixture(scope="module")
def assets(returns):
    return returns.select("symbol").distinct()


@pytest.mark.parametrize("block,chunk", [(256, 4096), (2, 16), (1, 1)])
def test_corr_matrix_matches_pandas(returns, assets, block, chunk):
    pdf = returns.toPandas().pivot(index="date", columns="symbol", values="daily_return_pct")
    want = pdf.corr()
    got = stats.corr_matrix_long(returns, assets, block_size=block, date_chunk=chunk).collect()
    assert len(got) == len(want) ** 2
    for r in got:
        w = want.loc[r["symbol_a"], r["symbol_b"]]
        if np.isnan(w):
            assert r["corr"] is None
        else:
            assert r["corr"] == pytest.approx(round(w, 6), abs=2e-6)


def test_rolling_corr_matches_pandas(returns):
    pdf = returns.toPandas().pivot(index="date", columns="symbol", values="daily_return_pct")
    want = pdf.rolling(30).corr()["A"].reset_index()
    want = want[want["symbol"] != "A"]
    for chunk in (31, 1 << 20, "auto"):
        got = {(r["date"], r["symbol"]): r["rolling_corr"] for r in
               stats.rolling_corr(returns, "A", 30, chunk_rows=chunk).collect()}
        assert len(got) == len(want)
        nonnull = 0
        for _, row in want.iterrows():
            g = got[(row["date"], row["symbol"])]
            if np.isnan(row["A"]):
                assert g is None
            else:
                nonnull += 1
                assert g == pytest.approx(round(row["A"], 6), abs=2e-6)
        assert nonnull > 0


def test_rolling_corr_without_benchmark_is_empty(returns):
    assert stats.rolling_corr(returns, "NOPE", 30).count() == 0


def test_pivot_rejects_duplicates(spark):
    df = spark.createDataFrame([("2020-01-01", "A", 1.0), ("2020-01-01", "A", 2.0)],
                               "date string, symbol string, daily_return_pct double")
    with pytest.raises(Exception, match="duplicate"):
        stats.returns_pivot(df, ["A"]).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_corr_matrix_disjoint_assets_ansi_safe(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        import datetime as dt
        d0 = dt.date(2020, 1, 1)
        rows = [(d0 + dt.timedelta(days=i), "A", float(i % 7)) for i in range(20)]
        rows += [(d0 + dt.timedelta(days=100 + i), "B", float(i % 5)) for i in range(20)]
        df = spark.createDataFrame(rows, "date date, symbol string, daily_return_pct double")
        got = {(r["symbol_a"], r["symbol_b"]): r["corr"]
               for r in stats.corr_matrix_long(df, df.select("symbol")).collect()}
        assert set(got) == {("A", "A"), ("B", "B")}  # no common date, no row
        assert got[("A", "A")] == 1.0
        wide = {r["symbol"]: r for r in stats.corr_matrix_wide(df, df.select("symbol")).collect()}
        assert wide["A"]["B"] is None and wide["B"]["B"] == 1.0
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def _returns(spark, rows):
    import datetime as dt
    d0 = dt.date(2020, 1, 1)
    return spark.createDataFrame([(d0 + dt.timedelta(days=i), k, v) for i, k, v in rows],
                                 "date date, symbol string, daily_return_pct double")


@pytest.mark.parametrize("chunk", [8, 4096])
def test_corr_of_a_series_that_varies_little_on_the_shared_dates(spark, chunk):
    """Far from the key's mean on the shared dates, r is still defined."""
    rnd = random.Random(1)
    rows = [(i, "A", 1.0 + rnd.gauss(0, 1e-8)) for i in range(40)] + [(100 + i, "A", 2.0) for i in range(40)]
    rows += [(i, "B", rnd.gauss(0, 1)) for i in range(40)]
    df = _returns(spark, rows)
    want = df.toPandas().pivot(index="date", columns="symbol", values="daily_return_pct").corr().loc["A", "B"]
    got = {(r["symbol_a"], r["symbol_b"]): r["corr"]
           for r in stats.corr_matrix_long(df, df.select("symbol"), date_chunk=chunk).collect()}
    assert got[("A", "B")] == pytest.approx(want, abs=1e-5)


def test_corr_of_a_series_flat_on_the_shared_dates_only(spark):
    rows = [(i, "A", 0.1 if i < 10 else float(i)) for i in range(30)] + [(i, "B", float(i % 3)) for i in range(10)]
    df = _returns(spark, rows)
    got = {(r["symbol_a"], r["symbol_b"]): r["corr"]
           for r in stats.corr_matrix_long(df, df.select("symbol"), date_chunk=4).collect()}
    assert got[("A", "B")] is None and got[("A", "A")] == 1.0


def test_correlations_reject_duplicates(spark):
    df = _returns(spark, [(0, "A", 1.0), (0, "A", 2.0), (1, "A", 3.0), (0, "B", 1.0), (1, "B", 2.0)])
    with pytest.raises(Exception, match="duplicate"):
        stats.corr_matrix_long(df, df.select("symbol")).collect()
    with pytest.raises(Exception, match="duplicate"):
        stats.rolling_corr(df, "B", 2).collect()


def test_few_assets_give_several_groups(spark, returns, assets):
    m = stats.pair_moments(returns, assets, "date", "symbol", "daily_return_pct", date_chunk=16)
    assert m.where("n = 0").count() == 0
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "MapInPandas" in plan and re.search(r"hashpartitioning\(_dc#\d+L?, _ba", plan) and "SinglePartition" not in plan


def test_copies_of_a_row_grow_with_the_tasks_not_with_the_assets(spark, monkeypatch):
    """As many blocks as a square grid of the tasks needs, at most."""
    df = spark.range(3000).select(F.expr("date'2020-01-01' + cast(id div 750 as int)").alias("date"),
                                  F.concat(F.lit("k"), (F.col("id") % 750).cast("string")).alias("symbol"),
                                  F.hash("id").cast("double").alias("daily_return_pct"))
    monkeypatch.setattr(stats, "TILE", 100)
    seen = {}
    for tasks in ("2", "8", "32"):
        spark.conf.set("spark.sql.shuffle.partitions", tasks)
        try:
            m = stats.pair_moments(df, df.select("symbol"), "date", "symbol", "daily_return_pct", block_size=8)
            plan = m._jdf.queryExecution().analyzed().toString()
            blocks = int(re.search(r"sequence\(cast\(0 as bigint\), cast\((\d+) as bigint\)", plan).group(1)) + 1
            assert blocks == {"2": 2, "8": 4, "32": 8}[tasks]
            r = m.agg(F.count("*").alias("n"), F.sum("n").alias("days"), F.sum("cxy").alias("c")).first()
            seen[tasks] = (r.n, r.days, round(r.c / 1e18, 6))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(set(seen.values())) == 1 and seen["2"][0] == 750 * 751 // 2


def test_given_pairs_agree_with_the_matrix(returns, assets, spark):
    cells = {(r.symbol_a, r.symbol_b): r["corr"] for r in stats.corr_matrix_long(returns, assets).collect()}
    names = sorted({a for a, _ in cells})
    wanted = [(a, b) for a in names for b in names[::2]] + [(names[0], "nobody"), (None, names[0]), (names[0], names[-1])]
    pairs = spark.createDataFrame(wanted, "key_a string, key_b string")
    got = {(r.key_a, r.key_b): r["corr"] for r in stats.corr_of_pairs(
        returns, pairs, "date", "symbol", "daily_return_pct").collect()}
    assert set(got) == {k for k in set(wanted) if k in cells}
    for k, v in got.items():
        assert v == cells[k] if v is None or cells[k] is None else abs(v - cells[k]) <= 1.01e-6, k


def test_array_pivot_of_many_symbols(spark):
    """More symbols than columns; gaps are NULL, other symbols are left out."""
    n = 20_000
    long = spark.range(n).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("symbol"),
                                 F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("date"),
                                 F.col("id").cast("double").alias("daily_return_pct"))
    long = long.where("(hash(symbol) + date) % 3 > 0 OR date = 3")
    order = stats.symbol_positions(long)
    names = [r.symbol for r in order.orderBy("position").collect()]
    assert names == sorted(f"s{k}" for k in range(n))
    some = long.unionByName(spark.createDataFrame([("nobody", 1, 5.0), (None, 1, 5.0)],
                                                 "symbol string, date int, daily_return_pct double"))
    wide = stats.returns_pivot_array(some, order).collect()
    assert sorted(r.date for r in wide) == [1, 2, 3] and all(len(r["values"]) == n for r in wide)
    full = next(r["values"] for r in wide if r.date == 3)
    assert full == [float(s[1:]) for s in names]
    assert 0 < sum(v is None for v in wide[0]["values"] + wide[1]["values"]) < n * 2
    back = stats.returns_unpivot_array(stats.returns_pivot_array(long, order), order)
    assert back.exceptAll(long.select(back.columns)).count() == 0 and back.count() == long.count()
    with pytest.raises(Exception, match="duplicate"):
        stats.returns_pivot_array(long.union(long.limit(1)), order).collect()


def test_a_task_holds_one_wide_row_at_a_time(spark, monkeypatch):
    """All dates in one task: arrays leave it one by one and are stored in
    row groups of few rows; NULL and split dates stay whole."""
    import pyarrow.parquet as pq

    monkeypatch.setattr(stats, "WIDE_CELLS", 2 * 20_000)
    long = spark.range(40_000).select(F.concat(F.lit("s"), (F.col("id") % 10_000).cast("string")).alias("symbol"),
                                      F.when(F.col("id") >= 10_000, F.floor(F.col("id") / 10_000)).alias("date"),
                                      F.col("id").cast("double").alias("daily_return_pct")).where("hash(id) % 3 = 0")
    order = stats.symbol_positions(long.union(spark.sql("SELECT concat('t', id), 0L, 0D FROM range(10000)")))
    wide = stats.returns_pivot_array(long, order)
    assert "MapInArrow" in wide._jdf.queryExecution().executedPlan().toString()
    assert "ollect_list" not in wide._jdf.queryExecution().executedPlan().toString()
    stored = stats.written_wide(wide.coalesce(1), order, "wide")
    rows = [pq.ParquetFile(f.replace("file:", "").replace("///", "/")).metadata for f in stored.inputFiles()]
    assert sum(m.num_rows for m in rows) == 4
    assert max(m.row_group(k).num_rows for m in rows for k in range(m.num_row_groups)) <= 2
    assert {(r.date, r.n) for r in stored.select("date", F.size("values").alias("n")).collect()} == {
        (d, order.count()) for d in (None, 1, 2, 3)}
    back = stats.returns_unpivot_array(stored, order)
    assert back.exceptAll(long.select(back.columns)).count() == 0 and back.count() == long.count()


def test_moments_of_many_pairs_are_neither_shuffled_nor_joined(spark):
    """All days of a pair are in one task, which returns its final row with
    the symbols; rows are copied as arrays, once per block."""
    facts = spark.range(120_000).select(
        F.md5((F.col("id") % 600).cast("string")).alias("coin_sk"),
        F.date_format(F.expr("date'2000-01-01' + cast(id div 600 * 11 as int)"), "yyyyMMdd").cast("int").alias("date_id"),
        ((F.hash("id") % 1000) / 10).alias("daily_return_pct")).where("hash(coin_sk, date_id) % 3 = 0")
    dim = spark.range(601).select(F.md5(F.col("id").cast("string")).alias("coin_sk"),
                                  F.when(F.col("id") != 7, F.concat(F.lit("s"), "id")).alias("symbol"))
    found = stats.corr_pairs(facts, dim, block_size=64)
    plan = found._jdf.queryExecution().executedPlan().toString()
    above = plan[:plan.index("MapInPandas")]
    assert "Exchange" not in above and "Join" not in above and "Aggregate" not in above
    got = {frozenset((r.symbol_a, r.symbol_b)): r.correlation for r in found.collect()}
    wide = facts.toPandas().pivot(index="date_id", columns="coin_sk", values="daily_return_pct")
    name = {r.coin_sk: r.symbol for r in dim.collect()}
    want = wide.corr()
    assert len(got) == 600 * 599 // 2
    for a, b in [(x, y) for x in list(want)[:40] for y in list(want)[::7] if x < y]:
        assert got[frozenset((name[a], name[b]))] == pytest.approx(want.loc[a, b], abs=2e-6)


def test_few_assets_with_many_values_are_cut_into_chunks_of_days(spark, returns, assets, monkeypatch):
    cells = {(r.symbol_a, r.symbol_b): r["corr"] for r in stats.corr_matrix_long(returns, assets).collect()}
    monkeypatch.setattr(stats, "GROUP_VALUES", 100)
    monkeypatch.setattr(stats, "SLICE", 8)
    chunked = stats.corr_matrix_long(returns, assets, block_size=2)
    assert "_dc" in chunked._jdf.queryExecution().executedPlan().toString()
    got = {(r.symbol_a, r.symbol_b): r["corr"] for r in chunked.collect()}
    assert set(got) == set(cells)
    for k, v in got.items():
        assert v == cells[k] if v is None or cells[k] is None else v == pytest.approx(cells[k], abs=1.01e-6), k


@pytest.mark.parametrize("kind", ["date", "bigint", "timestamp"])
def test_many_values_are_paired_without_copies(spark, monkeypatch, kind):
    """With more blocks than the tasks need, values are stored once, in pages;
    tasks read two sets of them: no shuffle, and every pair once with its symbols."""
    day = {"date": "date'2000-01-01' + cast(id div 600 * 11 as int)", "bigint": "id div 600 * 11 - 500",
           "timestamp": "timestamp'2000-01-01' + make_interval(0, 0, 0, 0, 0, 0, id div 600 * 11)"}[kind]
    long = spark.range(60_000).select(
        F.md5((F.col("id") % 600).cast("string")).alias("k"), F.expr(day).alias("d"),
        ((F.hash("id") % 1000) / 10).alias("x")).where("hash(k, d) % 3 = 0")
    assets = spark.range(601).select(F.md5(F.col("id").cast("string")).alias("k"),
                                     F.when(F.col("id") != 7, F.concat(F.lit("s"), "id")).alias("l"))
    small = {(r.key_a, r.key_b): r for r in stats.pair_moments(long, assets, "d", "k", "x", 64, label="l").collect()}
    monkeypatch.setattr(stats, "GROUP_VALUES", 1 << 9)
    monkeypatch.setattr(stats, "COPIED_VALUES", 1 << 12, raising=False)
    found = stats.pair_moments(long, assets, "d", "k", "x", 64, label="l")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan and "CartesianProduct" in plan
    rows = found.collect()
    assert len(rows) == len(small) and {(r.key_a, r.key_b) for r in rows} == set(small)
    names = {r.k: r.l for r in assets.collect()}
    for r in rows:
        want = small[r.key_a, r.key_b]
        assert (r.n, r.x0, r.y1, r.label_a, r.label_b) == (want.n, want.x0, want.y1, names[r.key_a], names[r.key_b])
        assert (r.mx, r.cxx, r.cxy) == pytest.approx((want.mx, want.cxx, want.cxy), rel=1e-9, abs=1e-6)


def test_a_large_asset_or_a_second_value_among_many_values(spark, monkeypatch, returns, assets):
    """Pages hold whole assets: one above a page is cut into chunks of days, as
    before.  A second value of a date raises here, too."""
    monkeypatch.setattr(stats, "GROUP_VALUES", 100)
    monkeypatch.setattr(stats, "COPIED_VALUES", 10)
    cells = {(r.symbol_a, r.symbol_b): r["corr"] for r in stats.corr_matrix_long(returns, assets, block_size=2).collect()}
    monkeypatch.setattr(stats, "PAGE_VALUES", 20)
    cut = stats.corr_matrix_long(returns, assets, block_size=2)
    assert "CartesianProduct" not in cut._jdf.queryExecution().executedPlan().toString()
    assert {(r.symbol_a, r.symbol_b): r["corr"] for r in cut.collect()} == pytest.approx(cells, abs=1.01e-6)
    df = _returns(spark, [(i, k, float(i)) for i in range(30) for k in "ABCD"] + [(3, "A", 2.0)])
    with pytest.raises(Exception, match="duplicate"):
        stats.corr_matrix_long(df, df.select("symbol"), block_size=1).collect()


def test_a_few_very_large_values_cost_no_digits(spark):
    """Centred on the median, a spike outside the shared dates does no harm."""
    rnd = random.Random(5)
    rows = [(i, k, rnd.gauss(0, 1)) for i in range(60) for k in "AB"] + [(90, "A", 1e9), (91, "B", 1e9)]
    df = _returns(spark, rows)
    want = df.toPandas().pivot(index="date", columns="symbol", values="daily_return_pct").corr().loc["A", "B"]
    got = {(r["symbol_a"], r["symbol_b"]): r["corr"] for r in stats.corr_matrix_long(df, df.select("symbol")).collect()}
    assert got[("A", "B")] == pytest.approx(want, abs=1e-6)


def test_small_keys_are_summed_up_in_one_pass_of_all_columns(values, monkeypatch):
    """Neither counts nor ranges of the values of small keys are written; with
    small and large keys, every key has the same results."""
    names = []
    write = stats.written
    monkeypatch.setattr(stats, "written", lambda df, name: names.append(name) or write(df, name))
    two = values.select(F.when(F.col("k") != "y", F.col("k")).alias("k"), "v", (-F.col("v")).alias("w"))
    small = {tuple(r) for r in stats.describe(two, ["v", "w"], ["k"]).collect()}
    assert not [n for n in names if n in ("quantile-counts", "quantile-parts", "quantile-ranks")]
    whole = stats.describe(two, ["v", "w"]).collect()
    for limit in (50, 0):
        names.clear()
        monkeypatch.setattr(stats, "SMALL_KEY", limit)
        assert {tuple(r) for r in stats.describe(two, ["v", "w"], ["k"]).collect()} == small
        assert "quantile-parts" in names
    assert sorted(stats.describe(two, ["v", "w"]).collect()) == sorted(whole)
