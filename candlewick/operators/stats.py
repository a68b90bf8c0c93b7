"""Statistics on price series: describe, histogram, return pivot,
correlation matrix / pairs and rolling correlation against a benchmark.

Scale notes
* Sums of the summary are exact, whatever order a cluster adds in: doubles are
  split into whole numbers by exponent, which add up map-side as decimals.
* Quantiles are exact (linear interpolation) on one path for all keys:
  values are counted map-side, range-partitioned by (key, value), and only
  the partitions that hold a wanted rank are looked into, so a key with any
  share of the rows spreads over many tasks.
* The correlation matrix never joins a date with itself to emit all asset
  pairs.  Assets are cut into blocks; each task gets the values of a block
  pair, turns them into pair moments with matrix products and returns the
  pairs that share a date.  Pairs are neither shuffled nor joined, unless few
  assets with very many dates need chunks of dates, too.  Many values are not
  copied to block pairs: they are stored once, in pages of assets, and each task
  reads two sets of pages.
* Rolling correlation runs per symbol over the date grid; over timestamps
  it runs per (symbol, chunk) with a halo, like the other series windows.
"""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Iterator, Sequence
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions import exact_parts, round_away, safe_corr
from candlewick.operators.series import AUTO, DEFAULT_CHUNK_ROWS, row_index, time_bucket
from candlewick.session import written

STAT_DIGITS = 4
CORR_DIGITS = 6
DESCRIBE_PROBS = (0.25, 0.5, 0.75)


# --------------------------------------------------------------------------
# returns in long and wide form
# --------------------------------------------------------------------------

def returns_long(fact: DataFrame, dim_asset: DataFrame, dim_date: DataFrame,
                 value: str = "daily_return_pct") -> DataFrame:
    """(date, symbol, value) for fact rows with a value, an asset and a
    calendar day."""
    return (fact.where(F.col(value).isNotNull())
            .select("coin_sk", "date_id", value)
            .join(dim_asset.select("coin_sk", "symbol"), "coin_sk")
            .join(dim_date.select("date_id", "date"), "date_id")
            .select("date", "symbol", value))


MAX_PIVOT_COLUMNS = 10_000


def pivot_symbols(assets: DataFrame, symbol: str = "symbol") -> list[str]:
    """The column names of a pivot: the symbols of an asset dimension, sorted.
    A wide table cannot have more than ``MAX_PIVOT_COLUMNS``; more raise (see
    :func:`returns_pivot_array`)."""
    rows = assets.select(symbol).where(F.col(symbol).isNotNull()).distinct() \
        .limit(MAX_PIVOT_COLUMNS + 1).collect()
    if len(rows) > MAX_PIVOT_COLUMNS:
        raise ValueError(f"more than {MAX_PIVOT_COLUMNS} symbols: use returns_pivot_array")
    return sorted(r[0] for r in rows)


def returns_pivot(long: DataFrame, symbols: Sequence[str], date: str = "date",
                  symbol: str = "symbol", value: str = "daily_return_pct") -> DataFrame:
    """Wide date x symbol table for the given symbols.  A duplicated (date,
    symbol) raises at run time instead of silently keeping one value."""
    one = F.when(F.count(F.lit(1)) > 1,
                 F.raise_error(F.lit("duplicate (date, symbol) in pivot input"))
                 ).otherwise(F.first(value))
    return long.groupBy(date).pivot(symbol, list(symbols)).agg(one.cast("double"))


def returns_unpivot(wide: DataFrame, date: str = "date", symbol: str = "symbol",
                    value: str = "daily_return_pct") -> DataFrame:
    """Wide date x symbol table back to long (date, symbol, value), keeping
    present values only."""
    cols = [c for c in wide.columns if c != date]
    return (wide.unpivot([date], cols, symbol, value)
            .where(F.col(value).isNotNull()))


def symbol_positions(assets: DataFrame, symbol: str = "symbol") -> DataFrame:
    """(symbol, position from 0) of the symbols of an asset dimension, in
    order, numbered by slices of their first characters."""
    names = assets.select(F.col(assets.columns[0] if symbol not in assets.columns else symbol).alias("symbol"))
    names = names.where("symbol IS NOT NULL").distinct()
    numbered = row_index(names, [], ["symbol"], bucket=F.substring("symbol", 1, 3), name="position")
    return written(numbered.select("symbol", (F.col("position") - 1).cast("int").alias("position")), "positions")


def returns_pivot_array(long: DataFrame, positions: DataFrame, date: str = "date", symbol: str = "symbol",
                        value: str = "daily_return_pct") -> DataFrame:
    """One row per date with ``values``: an array over all symbols in the order
    of ``positions`` (see :func:`symbol_positions`), NULL where a symbol has no
    value.  For more symbols than a table can have columns.  Values of other
    symbols are left out; a duplicated (date, symbol) raises.

    The cells are sorted by date and a task holds one date's array at a time,
    however many dates it has; an array is many times its cells."""
    width = positions.count()
    mine = positions.withColumnsRenamed({"symbol": "_ps", "position": "_pp"})
    cells = (long.join(mine, F.col(symbol) == F.col("_ps")).where(F.col(value).isNotNull())
             .select(date, "_pp", F.col(value).cast("double").alias("_v")))
    kind = T.StructType([T.StructField(date, long.schema[date].dataType), T.StructField("values", T.ArrayType(T.DoubleType()))])

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        day = full = there = None

        def row() -> pa.RecordBatch:
            values = pa.ListArray.from_arrays(pa.array([0, width], pa.int32()), pa.array(full, mask=~there))
            return pa.RecordBatch.from_arrays([day, values], names=[date, "values"])

        for b in batches:
            place, v = (b.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
            runs = b.column(0).dictionary_encode(null_encoding="encode").indices.to_numpy()
            ends = [*(np.flatnonzero(np.diff(runs)) + 1), len(runs)] if len(runs) else []
            for lo, hi in zip([0, *ends], ends):
                first = b.column(0).slice(lo, 1)
                if day is None or not day.equals(first):
                    if day is not None:
                        yield row()
                    day = pa.concat_arrays([first])  # a copy: the batch is not held
                    full, there = np.zeros(width), np.zeros(width, dtype=bool)
                here = place[lo:hi]  # sorted
                if there[here].any() or (np.diff(here) == 0).any():
                    raise ValueError("duplicate (date, symbol) in pivot input")
                full[here], there[here] = v[lo:hi], True
        if day is not None:
            yield row()

    return cells.repartition(date).sortWithinPartitions(date, "_pp").mapInArrow(dense, kind)


WIDE_CELLS = 1 << 22  # cells of a row group of wide rows


def written_wide(wide: DataFrame, positions: DataFrame, name: str) -> DataFrame:
    """:func:`written` for rows of :func:`returns_pivot_array`, in row groups
    of few rows: Spark reads all arrays of a row group (4096 at most) at once."""
    rows = max(1, WIDE_CELLS // max(1, positions.count()))
    return written(wide, name, {"parquet.block.row.count.limit": rows})


def returns_unpivot_array(wide: DataFrame, positions: DataFrame, date: str = "date", symbol: str = "symbol",
                          value: str = "daily_return_pct") -> DataFrame:
    """:func:`returns_pivot_array` back to (date, symbol, value), present
    values only."""
    cells = wide.select(date, F.posexplode("values").alias("_p", value)).where(F.col(value).isNotNull())
    mine = positions.select(F.col("symbol").alias(symbol), "position")
    return cells.join(mine, F.col("_p") == F.col("position")).select(date, symbol, value)


# --------------------------------------------------------------------------
# exact quantiles and describe
# --------------------------------------------------------------------------

def exact_quantiles(df: DataFrame, value: str, probs: Sequence[float],
                    keys: Sequence[str] = ()) -> DataFrame:
    """Per key: ``q_<i>`` = the ``probs[i]`` quantile of ``value`` with
    linear interpolation between closest ranks (numpy/pandas 'linear',
    DuckDB quantile_cont).  NULL/NaN values are ignored; a NULL key is a
    group of its own.

    Keys of up to ``SMALL_KEY`` rows sort their values in one array each; the
    values of larger ones spread over tasks (:func:`_ranged_quantiles`).
    """
    if not keys:
        return exact_quantiles(df.withColumn("_all", F.lit(0)), value, probs, ["_all"]).drop("_all")
    keys = list(keys)
    base = written(df.select(*keys, F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")), "quantile-values")
    sizes = written(base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")), "quantile-sizes")
    return _quantiles(base, ["_v"], probs, keys, sizes).drop("_column")


SMALL_KEY = 1 << 13  # rows of a key that fit an array


def _quantiles(base: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str],
               sizes: DataFrame) -> DataFrame:
    """(keys, _column, q_<i>) of each column of a stored frame without NaN;
    ``sizes`` has the rows (_rows) of every key.  No row for a column of a key
    without a value."""
    large = sizes.where(F.col("_rows") > SMALL_KEY).select(*[F.col(k).alias(f"_k_{k}") for k in keys])
    if large.isEmpty():
        return _listed_quantiles(base, columns, probs, keys)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    cells = base.join(large, same, "left_semi").select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_column"), F.col(c).alias("_v")) for c in columns])).alias("_kv"))
    ranged = _ranged_quantiles(cells.select(*keys, "_kv.*").where("_v IS NOT NULL"), probs, [*keys, "_column"])
    return _listed_quantiles(base.join(large, same, "left_anti"), columns, probs, keys).unionByName(ranged)


def _listed_quantiles(base: DataFrame, columns: Sequence[str], probs: Sequence[float],
                      keys: Sequence[str]) -> DataFrame:
    """Quantiles of keys that fit an array: all columns in one pass."""
    lists = base.groupBy(*keys).agg(*[F.sort_array(F.collect_list(c)).alias(f"_l{i}") for i, c in enumerate(columns)])
    cells = lists.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("_column"), F.col(f"_l{i}").alias("_l")) for i, c in enumerate(columns)])).alias("_c"))
    cells = cells.select(*keys, "_c.*").where(F.size("_l") > 0)
    h = [(F.size("_l") - 1) * F.lit(float(p)) for p in probs]
    lo, hi = ([F.get("_l", f(x).cast("int")) for x in h] for f in (F.floor, F.ceil))
    return cells.select(*keys, "_column", *[(lo[i] + (hi[i] - lo[i]) * (x - F.floor(x))).alias(f"q_{i}")
                                            for i, x in enumerate(h)])


def _ranged_quantiles(base: DataFrame, probs: Sequence[float], keys: Sequence[str]) -> DataFrame:
    """Quantiles of ``_v`` for keys of any size.

    Equal values become one row with a count (map-side), the rows are
    range-partitioned by (key, value) and written with their partition
    number.  Partition totals give every partition its offset in its key;
    a wanted rank lies in one partition, and ranks are counted only there.
    """
    # written before the ranges are sampled, which reads it a second time
    counts = written(base.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_c")), "quantile-counts")
    parts = written(counts.repartitionByRange(*keys, "_v")
                    .withColumn("_p", F.spark_partition_id()), "quantile-parts")
    by_key = Window.partitionBy(*keys)
    sizes = (parts.groupBy(*keys, "_p").agg(F.sum("_c").alias("_s"))
             .withColumn("_n", F.sum("_s").over(by_key))
             .withColumn("_off", F.sum("_s").over(by_key.orderBy("_p")) - F.col("_s")))
    # wanted 0-based ranks floor(h) and ceil(h) of every probability
    h = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]
    ranks = F.array_distinct(F.array(*[f(x).cast("long") for x in h for f in (F.floor, F.ceil)]))
    places = written(sizes.withColumn("_r", F.explode(ranks))
                     .where((F.col("_r") >= F.col("_off")) & (F.col("_r") < F.col("_off") + F.col("_s")))
                     .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_p").alias("_q"),
                             "_off", "_n", "_r"), "quantile-ranks")
    here = F.col("_p") == F.col("_q")
    for k in keys:
        here = here & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    wanted = places.groupBy(*[f"_k_{k}" for k in keys], "_q").agg(
        F.min("_off").alias("_off"), F.min("_n").alias("_n"), F.collect_set("_r").alias("_rs"))
    upto = Window.partitionBy(*keys, "_p").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    hit = (parts.join(wanted, here)
           .withColumn("_hi", F.col("_off") + F.sum("_c").over(upto))
           .select(*keys, "_v", "_n", F.explode(F.filter(
               "_rs", lambda r: (r >= F.col("_hi") - F.col("_c")) & (r < F.col("_hi")))).alias("_r")))
    at = lambda r: F.max(F.when(F.col("_r") == r.cast("long"), F.col("_v")))
    out = hit.groupBy(*keys).agg(F.first("_n").alias("_n"), *[
        f(x) for i, x in enumerate(h) for f in (
            lambda x, i=i: at(F.floor(x)).alias(f"_lo{i}"), lambda x, i=i: at(F.ceil(x)).alias(f"_hi{i}"))])
    lo, hi = (lambda i: F.col(f"_lo{i}")), (lambda i: F.col(f"_hi{i}"))
    return out.select(*keys, *[(lo(i) + (hi(i) - lo(i)) * (x - F.floor(x))).alias(f"q_{i}")
                               for i, x in enumerate(h)])


def exact_sums(df: DataFrame, value: str, keys: Sequence[str] = ()) -> DataFrame:
    """Per key: ``n`` (values) and ``total``, their sum as if it were added up
    without rounding and rounded once, so that it does not hang on the order
    of the rows.  NULL and NaN values are left out; a key without a value has
    n = 0 and a NULL total.  A NULL key is a group of its own.

    Values become whole numbers by place (:func:`exact_parts`), which add up
    exactly, map-side; a key has one row per place that occurs."""
    keys = list(keys)
    place, whole = exact_parts(value)
    v = F.col(value).cast("double")
    inf = F.lit(float("inf"))
    parts = (df.select(*keys, place.alias("_p"), whole.cast("decimal(38,0)").alias("_w"), v.alias("_v"))
             .groupBy(*keys, "_p").agg(
                 F.sum("_w").alias("_w"), F.count_if(F.col("_v").isNotNull() & ~F.isnan("_v")).alias("_n"),
                 F.count_if(F.col("_v") == inf).alias("_up"), F.count_if(F.col("_v") == -inf).alias("_down")))
    sums = parts.groupBy(*keys).agg(
        F.collect_list(F.when(F.col("_w").isNotNull(), F.struct(
            F.col("_p").alias("p"), F.col("_w").cast("string").alias("w")))).alias("_parts"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_n", "_up", "_down")])
    total = (F.when(F.col("_n") == 0, None).when((F.col("_up") > 0) & (F.col("_down") > 0), F.lit(float("nan")))
             .when(F.col("_up") > 0, inf).when(F.col("_down") > 0, -inf).otherwise(_joined("_parts")))
    return sums.select(*keys, F.col("_n").alias("n"), total.cast("double").alias("total"))


@F.arrow_udf(T.DoubleType())
def _joined(parts: pa.Array) -> pa.Array:
    """The places of a sum, rounded once: a value for every group, not row."""
    def total(places) -> float | None:
        if not places:
            return None
        low = min(x["p"] for x in places)
        whole = sum(int(x["w"]) << 8 * (x["p"] - low) for x in places)
        try:
            return float(Fraction(whole) * Fraction(2) ** (8 * low))
        except OverflowError:
            return math.inf if whole > 0 else -math.inf

    return pa.array([total(x) for x in parts.to_pylist()], pa.float64())


def describe(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = (),
             digits: int = STAT_DIGITS) -> DataFrame:
    """Summary statistics per key and column: count, mean (of the exact sum),
    std (n-1), min, 25/50/75 % (exact, linear), max — rounded to ``digits``.
    NULL and NaN values are left out; a column without a value has count 0 and
    NULLs."""
    keys = list(keys)
    number = lambda c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))
    base = written(df.select(*keys, *[number(c).alias(c) for c in columns]), "describe")
    stats = written(base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), *[
        f(c).alias(f"{n}_{i}") for i, c in enumerate(columns) for n, f in (
            ("count", F.count), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]), "describe-moments")
    moments = stats.select(*keys, F.explode(F.array(*[F.struct(
        F.lit(c).alias("column"), *[F.col(f"{n}_{i}").alias(n) for n in ("count", "std", "min", "max")])
        for i, c in enumerate(columns)])).alias("_m")).select(*keys, "_m.*")
    values = base.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns])).alias("_kv"))
    values = values.select(*keys, "_kv.column", "_kv.value")
    by = [*keys, "column"]
    found = moments
    quantiles = _quantiles(base, columns, DESCRIBE_PROBS, keys, stats).withColumnRenamed("_column", "column")
    for part in (quantiles, exact_sums(values, "value", by)):
        part = part.withColumnsRenamed({k: f"_k_{k}" for k in by})
        same = F.col("column") == F.col("_k_column")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
        found = found.join(part, same, "left").drop(*[f"_k_{k}" for k in by])
    r = lambda c: round_away(c, digits)
    mean = F.try_divide(F.col("total"), F.col("n").cast("double"))
    return found.select(*keys, "column", "count", r(mean).alias("mean"), r("std").alias("std"),
                        r("min").alias("min"), r("q_0").alias("p25"), r("q_1").alias("p50"),
                        r("q_2").alias("p75"), r("max").alias("max"))


def _bin_of(v: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin in [0, bins); monotone in v because every IEEE
    operation used is monotone."""
    place = F.floor(F.try_divide(v - lo, hi - lo) * F.lit(float(bins)))
    return F.when(hi > lo, F.least(place, F.lit(bins - 1))).otherwise(F.lit(0)).cast("long")


# --------------------------------------------------------------------------
# histogram
# --------------------------------------------------------------------------

def histogram(df: DataFrame, value: str, keys: Sequence[str] = (), bins: int = 50,
              digits: int = STAT_DIGITS) -> DataFrame:
    """Equal-width histogram per key over [min, max]: every bin (empty ones
    with count 0) with its edges.  The maximum falls into the last bin; a
    constant series puts everything into bin 0."""
    if not keys:
        return histogram(df.withColumn("_all", F.lit(0)), value, ["_all"], bins,
                         digits).drop("_all")
    keys = list(keys)
    v = written(df.select(*keys, F.col(value).alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v")), "histogram")
    # one row per key, written: the join with it is a broadcast if the files
    # are small, else one whose skewed partitions can be split
    st = written(v.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi")), "bounds")
    vb = v.join(st, keys)
    counts = (vb.withColumn("bin", _bin_of(F.col("_v"), F.col("_lo"), F.col("_hi"), bins))
              .groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("count")))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    edges = st.select(*keys, "_lo", "_hi",
                      F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")).select(
        *keys, F.col("bin").cast("long").alias("bin"),
        round_away(F.col("_lo") + F.col("bin") * width, digits).alias("bin_start"),
        round_away(F.col("_lo") + (F.col("bin") + 1) * width, digits).alias("bin_end"))
    return (edges.join(counts, [*keys, "bin"], "left")
            .select(*keys, "bin", "bin_start", "bin_end",
                    F.coalesce("count", F.lit(0)).alias("count")))


# --------------------------------------------------------------------------
# correlation matrix from block moments
# --------------------------------------------------------------------------

_MOMENTS = ("n", "mx", "my", "cxx", "cyy", "cxy", "x0", "x1", "y0", "y1")
_MOMENT_SCHEMA = "dc long, n long, " + ", ".join(f"{c} double" for c in _MOMENTS[1:])


GROUP_VALUES = 1 << 24  # values that a task's group may hold
TILE = 256  # assets of either side whose pairs are computed at once
TILE_CELLS = 1 << 21  # dates x assets of a side of a tile
SLICE = 256  # days of an asset that are one row, their values in arrays
COPIED_VALUES = 1 << 24  # copies of values, for all block pairs, that may be shuffled
PAGE_ASSETS = 512  # assets of a page
PAGE_VALUES = 1 << 19  # values of a page, which ends with the asset that reaches them
FILE_VALUES = 1 << 22  # values of a file of pages


class _Side:
    """The values of some assets, asset by asset; days are numbers from 0 on."""

    def __init__(self, names: np.ndarray, labels: np.ndarray | None, sizes: np.ndarray, days: np.ndarray,
                 values: np.ndarray, centre: np.ndarray | None = None):
        self.names, self.labels, self.days, self.values = names, labels, days, values
        self.ends = np.concatenate([[0], np.cumsum(sizes)])
        self.centre = _medians(values, sizes) if centre is None else centre

    def tile(self, at: int, size: int, dates: int) -> tuple:
        """(names, labels, centres, values, presence) of some assets, the last
        two by date x asset."""
        names = self.names[at:at + size]
        lo, hi = self.ends[at], self.ends[at + len(names)]
        place = self.days[lo:hi], np.repeat(np.arange(len(names)), np.diff(self.ends[at:at + len(names) + 1]))
        v, m = np.zeros((dates, len(names))), np.zeros((dates, len(names)), dtype=bool)
        v[place], m[place] = self.values[lo:hi], True
        return names, None if self.labels is None else self.labels[at:at + size], self.centre[at:at + size], v, m


def _medians(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The centre of each asset: near most values even if a few are very large."""
    return np.array([np.median(x) for x in np.split(values, np.cumsum(sizes)[:-1])])


def _block(pdf: pd.DataFrame, days: np.ndarray, sizes: np.ndarray) -> _Side:
    """The side of a block, whose rows are slices of assets in any order."""
    names, first, asset = np.unique(pdf["_k"].to_numpy(), return_index=True, return_inverse=True)
    asset = np.repeat(asset, sizes)
    order = np.argsort(asset, kind="stable")
    return _Side(names, pdf["_l"].to_numpy()[first] if "_l" in pdf else None, np.bincount(asset, minlength=len(names)),
                 days[order], np.concatenate(pdf["_v"].to_numpy())[order])


def _tiles(pdf: pd.DataFrame, step: int | None) -> Iterator[pd.DataFrame]:
    """Pair moments of one (date chunk, block a, block b) group."""
    ba, bb, dc = (int(pdf[c].iat[0]) for c in ("_ba", "_bb", "_dc"))
    if len(set(pdf["_b"])) < len({ba, bb}):
        return  # one of the blocks has no value
    sizes = pdf["_v"].map(len).to_numpy()
    days = np.concatenate(pdf["_d"].to_numpy())
    if step is not None:
        days = days + np.repeat(pdf["_s"].to_numpy() * step, sizes)
    dates, days = np.unique(days, return_inverse=True)
    blocks = pdf["_b"].to_numpy()

    def side(block: int) -> _Side:
        return _block(pdf[blocks == block], days[np.repeat(blocks == block, sizes)], sizes[blocks == block])

    side_a = side(ba)
    yield from _pairs(side_a, side_a if ba == bb else side(bb), len(dates), dc)


def _pairs(side_a: _Side, side_b: _Side, dates: int, dc: int = 0) -> Iterator[pd.DataFrame]:
    """Pair moments of two sides (or of one, given twice), a tile of
    pairs at a time: for every pair that shares a date the number of dates,
    means, centred sums and the least and greatest value of either side.

    Sums come from matrix products of values centred per asset, on its median.  Where a
    variance over the shared dates is small beside the asset's own, centring
    per asset has lost digits: such pairs are computed on their own."""
    size, one = max(1, min(TILE, TILE_CELLS // dates)), side_a is side_b
    for k in range(0, len(side_a.names), size):
        a = side_a.tile(k, size, dates)
        for j in range(0, k + 1 if one else len(side_b.names), size):
            same = one and j == k
            yield _tile_moments(a, a if same else side_b.tile(j, size, dates), same, dc)


_SIDES = (("mx", "my"), ("cxx", "cyy"), ("x0", "y0"), ("x1", "y1"))


def _tile_moments(a: tuple, b: tuple, same: bool, dc: int = 0) -> pd.DataFrame:
    (names_a, labels_a, mid_a, va, ma), (names_b, labels_b, mid_b, vb, mb) = a, b
    ca, cb = np.where(ma, va - mid_a, 0.0), np.where(mb, vb - mid_b, 0.0)
    fa, fb = ma.astype(float), mb.astype(float)
    n = (ma.astype(np.float32).T @ mb.astype(np.float32)).astype(float)  # counts up to 2 ** 24 are exact
    ia, ib = np.nonzero((n > 0) & (names_a[:, None] <= names_b[None, :] if same else True))
    n = n[ia, ib]
    sx, sy, sxy = ((p.T @ q)[ia, ib] for p, q in ((ca, fb), (fa, cb), (ca, cb)))
    qx, qy = ((ca * ca).T @ fb)[ia, ib], (fa.T @ (cb * cb))[ia, ib]
    out = {"mx": sx / n + mid_a[ia], "my": sy / n + mid_b[ib],
           "cxx": qx - sx * sx / n, "cyy": qy - sy * sy / n, "cxy": sxy - sx * sy / n,
           "x0": np.full(len(n), -np.inf), "x1": np.full(len(n), np.inf),
           "y0": np.full(len(n), -np.inf), "y1": np.full(len(n), np.inf)}
    one = n == 1
    if one.any():  # the one value itself: all other terms of the sum are 0
        x, y = (va.T @ fb)[ia, ib], (fa.T @ vb)[ia, ib]
        for name, value in (("mx", x), ("my", y), ("cxx", 0.0), ("cyy", 0.0), ("cxy", 0.0), ("x0", x), ("x1", x),
                            ("y0", y), ("y1", y)):
            out[name] = np.where(one, value, out[name])
    for k in np.flatnonzero(~one & ((out["cxx"] <= 1e-3 * qx) | (out["cyy"] <= 1e-3 * qy))):
        both = ma[:, ia[k]] & mb[:, ib[k]]
        px, py = va[both, ia[k]], vb[both, ib[k]]
        dx, dy = px - px.mean(), py - py.mean()
        for name, value in (("mx", px.mean()), ("my", py.mean()), ("cxx", dx @ dx), ("cyy", dy @ dy),
                            ("cxy", dx @ dy), ("x0", px.min()), ("x1", px.max()), ("y0", py.min()),
                            ("y1", py.max())):
            out[name][k] = value

    # blocks are by hash: the lesser key of a pair may be on either side
    rank = np.unique(np.concatenate([names_a, names_b]), return_inverse=True)[1]
    ka, kb = rank[:len(names_a)][ia], rank[len(names_a):][ib]
    flip = ka > kb
    for x, y in _SIDES:
        out[x], out[y] = np.where(flip, out[y], out[x]), np.where(flip, out[x], out[y])
    first, second = np.where(flip, ib + len(names_a), ia), np.where(flip, ia, ib + len(names_a))

    def texts(left: np.ndarray, right: np.ndarray, at: np.ndarray) -> pd.Series:
        taken = pa.array(np.concatenate([left, right]), pa.string(), from_pandas=True).take(pa.array(at))
        return pd.Series(pd.arrays.ArrowExtensionArray(taken))

    named = {"key_a": texts(names_a, names_b, first), "key_b": texts(names_a, names_b, second)}
    if labels_a is not None:
        named |= {"label_a": texts(labels_a, labels_b, first), "label_b": texts(labels_a, labels_b, second)}
    return pd.DataFrame({**named, "dc": np.full(len(n), dc), "n": n.astype("int64"), **out}, copy=False)


def _block_moments(frames: Iterator[pd.DataFrame], step: int | None) -> Iterator[pd.DataFrame]:
    """Tiles of the groups of a partition, which is sorted by group; one group
    is held at a time."""
    held: list[pd.DataFrame] = []
    group = ["_dc", "_ba", "_bb"]
    for f in frames:
        while len(f):
            key = tuple(f[group].iloc[0])
            end = int((f[group] == key).all(axis=1).sum())  # sorted: the first rows
            if held and tuple(held[0][group].iloc[0]) != key:
                whole, held = pd.concat(held), []
                yield from _tiles(whole, step)
                del whole
            held.append(f.iloc[:end])
            f = f.iloc[end:]
    if held:
        whole, held = pd.concat(held), []
        yield from _tiles(whole, step)


def _pages(frames: Iterator[pd.DataFrame], step: int | None) -> Iterator[pd.DataFrame]:
    """Rows of a partition, which is sorted by asset, as pages: a row with a
    number, and arrays of the assets' names, labels, sizes, centres, and of
    their days and values, asset by asset."""
    number, names, labels, sizes, days, values = TaskContext.get().partitionId() << 32, [], [], [], [], []

    def page() -> pd.DataFrame:
        flat = np.concatenate(values)
        row = {"_p": number, "_k": names, **({"_l": labels} if labels else {}), "_n": sizes,
               "_c": _medians(flat, sizes), "_d": np.concatenate(days), "_v": flat}
        return pd.DataFrame({c: pd.Series([x], dtype=object if c != "_p" else "int64") for c, x in row.items()})

    for f in frames:
        marks = f["_l"] if "_l" in f else [None] * len(f)
        for k, s, d, v, label in zip(f["_k"], f["_s"], f["_d"], f["_v"], marks):
            if not names or k != names[-1]:
                if len(names) == PAGE_ASSETS or sum(sizes) >= PAGE_VALUES:
                    yield page()
                    number, names, labels, sizes, days, values = number + 1, [], [], [], [], []
                names.append(k)
                sizes.append(0)
                if "_l" in f:
                    labels.append(label)
            sizes[-1] += len(v)
            days.append(d if step is None else d + s * step)
            values.append(v)
    if names:
        yield page()


def _page_moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Pair moments of two pages each; rows have the columns of both, those of
    the second with an ending."""
    def side(f: pd.DataFrame, at: int, end: str, days: np.ndarray) -> _Side:
        names, sizes, values, centre = (np.asarray(f[c + end].iat[at]) for c in ("_k", "_n", "_v", "_c"))
        labels = np.asarray(f["_l" + end].iat[at], dtype=object) if "_l" + end in f else None
        return _Side(names, labels, sizes, days, values, centre)

    for f in frames:
        for at in range(len(f)):
            one = f["_p"].iat[at] == f["_p_b"].iat[at]
            own = [f[c].iat[at] for c in (("_d",) if one else ("_d", "_d_b"))]
            dates, days = np.unique(np.concatenate(own), return_inverse=True)
            side_a = side(f, at, "", days[:len(own[0])])
            yield from _pairs(side_a, side_a if one else side(f, at, "_b", days[len(own[0]):]), len(dates))
        del f, own, side_a  # before the next batch is read


def _merged(a: Column, b: Column) -> Column:
    """Moments of two disjoint sets of dates as one (pairwise update)."""
    n = a["n"] + b["n"]
    dx, dy = b["mx"] - a["mx"], b["my"] - a["my"]
    both = (a["n"] * b["n"]).cast("double") / n
    share = b["n"].cast("double") / n
    return F.struct(
        n.alias("n"), (a["mx"] + dx * share).alias("mx"), (a["my"] + dy * share).alias("my"),
        (a["cxx"] + b["cxx"] + dx * dx * both).alias("cxx"),
        (a["cyy"] + b["cyy"] + dy * dy * both).alias("cyy"),
        (a["cxy"] + b["cxy"] + dx * dy * both).alias("cxy"),
        F.least(a["x0"], b["x0"]).alias("x0"), F.greatest(a["x1"], b["x1"]).alias("x1"),
        F.least(a["y0"], b["y0"]).alias("y0"), F.greatest(a["y1"], b["y1"]).alias("y1"))


def _present(long: DataFrame, date: str, key: str, value: str) -> DataFrame:
    v = long.select(F.col(date).alias("_d"), F.col(key).alias("_k"),
                    F.col(value).cast("double").alias("_v"))
    return v.where(F.col("_v").isNotNull() & ~F.isnan("_v") & F.col("_d").isNotNull() & F.col("_k").isNotNull())


def one_value(long: DataFrame, date: str, key: str, value: str) -> DataFrame:
    """(_d, _k, _v): the value of each (date, key); a second one raises at
    run time.  NULL and NaN values, and NULL dates and keys, are left out."""
    v = _present(long, date, key, value)
    twice = F.raise_error(F.concat(F.lit("duplicate (date, key) in correlation input: "),
                                   F.col("_d").cast("string"), F.lit(", "), F.col("_k")))
    return (v.groupBy("_d", "_k").agg(F.count(F.lit(1)).alias("_n"), F.first("_v").alias("_v"))
            .select("_d", "_k", F.when(F.col("_n") > 1, twice.cast("double")).otherwise(F.col("_v")).alias("_v")))


def _packed(long: DataFrame, assets: DataFrame, date: str, key: str, value: str,
            date_chunk: int | None) -> tuple[DataFrame, int, int | None]:
    """Values of the assets, written as one row per (asset, slice ``_s``) with
    arrays of days and values; the slice's length; ``step`` to add to days that
    are counted from the beginning of their slice.  A second value of a (date,
    key) raises."""
    kind = long.schema[date].dataType
    numbers = isinstance(kind, (T.DateType, T.IntegerType, T.LongType))
    length = SLICE if numbers else 1
    length = math.gcd(length, date_chunk) if date_chunk else length
    day = F.unix_date("_d") if isinstance(kind, T.DateType) else F.col("_d") if numbers else time_bucket("_d", kind)
    at = F.floor(day / F.lit(length))
    name = (day - at * length).cast("short") if numbers else F.col("_d").cast("string")
    rows = (_present(long, date, key, value).join(assets, F.col("_k") == F.col("_ak")).drop("_ak")
            .withColumn("_s", at).withColumn("_d", name))
    own = [c for c in rows.columns if c not in ("_d", "_v")]
    lists = rows.groupBy(*own).agg(F.collect_list(F.struct("_d", "_v")).alias("_c")).select(
        *own, F.col("_c._d").alias("_d"), F.col("_c._v").alias("_v"))
    twice = F.raise_error(F.concat(F.lit("duplicate (date, key) in correlation input: "), F.col("_k")))
    once = F.when(F.size(F.array_distinct("_d")) < F.size("_d"), twice.cast(lists.schema["_v"].dataType)).otherwise(F.col("_v"))
    return written(lists.withColumn("_v", once), "pair-values"), length, length if numbers else None


def _stored_pages(packed: DataFrame, step: int | None, kind: T.DataType, files: int) -> DataFrame:
    """Rows of :func:`_packed` as pages, written in row groups of few of them,
    as Spark reads all arrays of a row group at once, and with their full size,
    so that a partition of files is no larger in memory."""
    day = "string" if step is None else "long" if isinstance(kind, T.LongType) else "int"
    labels = "_l array<string>, " if "_l" in packed.columns else ""
    rows = packed.repartition(files, "_k").sortWithinPartitions("_k", "_s")
    pages = rows.mapInPandas(lambda frames: _pages(frames, step), "_p long, _k array<string>, " + labels
                             + f"_n array<int>, _c array<double>, _d array<{day}>, _v array<double>")
    return written(pages, "pair-pages", {"parquet.block.row.count.limit": 4, "compression": "uncompressed",
                                         "parquet.enable.dictionary": "false"})


def _page_pairs(pages: DataFrame) -> DataFrame:
    """Every page with itself, and every two pages once.  No row is shuffled: a task
    reads two partitions of the stored pages.  The two of a pair come in the order
    of their numbers if the sum of those is even, else in the other, so that tasks
    have equal work."""
    other = pages.select(*[F.col(c).alias(c + "_b") for c in pages.columns])
    a, b = F.col("_p"), F.col("_p_b")
    once = (a == b) | ((a != b) & ((a < b) == ((a + b) % 2 == 0)))
    return pages.hint("shuffle_replicate_nl").join(other, once)


def pair_moments(long: DataFrame, assets: DataFrame, date: str, key: str, value: str,
                 block_size: int = 256, date_chunk: int | None = None, label: str | None = None) -> DataFrame:
    """Moments of every key pair (a <= b, diagonal included) of the asset set
    over the dates where both have a value: key_a, key_b, n and the columns of
    ``_MOMENTS``.  Pairs without a common date have no row.  ``label`` names a
    column of ``assets`` that goes along as label_a and label_b, so that no
    join needs to move the pairs.

    ``assets`` (its first column) names the keys; others are left out.  Keys
    are dealt to blocks by hash, dates to chunks by value, so neither needs a
    global numbering.  Block pairs make a square grid of tasks: there are at
    most about sqrt(2 * tasks) blocks, and an asset's values, in arrays, are
    copied once per block, so copies grow with the root of the cluster and not
    with the assets - until a group has more than ``GROUP_VALUES`` values, which
    then decide, as a group must fit a task.  A task works through the pairs of
    its two blocks tile by tile.

    A group must fit a task, so blocks, and with them the copies of a value, grow
    with the values.  Beyond ``COPIED_VALUES`` copies nothing is copied: values are
    written once, in pages (:func:`_page_moments`), and a task reads two sets of
    pages, whatever their number.

    Every chunk of days returns a row per pair, and rows of chunks must be
    shuffled to be merged.  So a group of two blocks, or pages, has all days and its
    rows are final, unless the assets are too few for as many blocks as their values
    need and, beyond ``COPIED_VALUES`` copies, one has more values than a page."""
    own = [F.col(assets.columns[0]).alias("_ak")]
    assets = assets.select(*own, *([F.col(label).alias("_l")] if label else [])).where("_ak IS NOT NULL")
    assets = assets.groupBy("_ak").agg(F.min("_l").alias("_l")) if label else assets.distinct()
    assets = written(assets, "correlated-assets")
    count = assets.count()
    packed, length, step = _packed(long, assets, date, key, value, date_chunk)
    total, first, last = packed.agg(F.sum(F.size("_v")), F.min("_s"), F.max("_s")).first()
    total, days = total or 0, ((last - first + 1) if total else 1) * length
    # twice the cores, 32 at least, are tasks enough: more of them are more copies
    spark = long.sparkSession
    tasks = min(int(spark.conf.get("spark.sql.shuffle.partitions")),
                max(32, 2 * spark.sparkContext.defaultParallelism))
    grid = math.isqrt(2 * tasks - 1) + 1
    blocks = max(1, min(-(-count // block_size), max(grid, -(-2 * total // GROUP_VALUES))))
    named = ["key_a", "key_b", *(["label_a", "label_b"] if label else [])]
    schema = ", ".join(f"{c} string" for c in named) + ", " + _MOMENT_SCHEMA
    if date_chunk is None and blocks > 1 and blocks * total > COPIED_VALUES:
        sizes = packed.groupBy("_k").agg(F.sum(F.size("_v")).alias("n"))
        if sizes.agg(F.max("n")).first()[0] <= PAGE_VALUES:
            pages = _stored_pages(packed, step, long.schema[date].dataType, max(grid, -(-total // FILE_VALUES)))
            return _page_pairs(pages).mapInPandas(_page_moments, schema).drop("dc")
    if date_chunk is None:
        chunks = -(-2 * total // (blocks * GROUP_VALUES))
        if blocks == 1:
            date_chunk = SLICE
        elif chunks > 1:
            date_chunk = max(1, days // chunks // length) * length
    chunk = F.floor(F.col("_s") * length / F.lit(date_chunk)) if date_chunk else F.lit(0).cast("long")
    rows = packed.select(*packed.columns, chunk.alias("_dc"), F.pmod(F.xxhash64("_k"), F.lit(blocks)).alias("_b"))
    # a row goes to each pair of blocks that holds its own
    spread = (rows.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
              .withColumn("_ba", F.least("_b", "_o")).withColumn("_bb", F.greatest("_b", "_o")).drop("_o"))
    group = ["_dc", "_ba", "_bb"]
    # groups are few and large: many more partitions than groups, so that few share one
    dealt = spread.repartition(*group) if date_chunk else spread.repartition(2 * blocks * (blocks + 1), *group)
    chunks = dealt.sortWithinPartitions(*group).mapInPandas(lambda frames: _block_moments(frames, step), schema)
    if not date_chunk:
        return chunks.drop("dc")
    # few chunks per pair (dates / date_chunk), merged in date order
    merged = chunks.groupBy("key_a", "key_b").agg(
        *[F.max(c).alias(c) for c in named[2:]], F.array_sort(F.collect_list(F.struct("dc", *_MOMENTS))).alias("_c"))
    bare = F.transform("_c", lambda c: F.struct(*[c[m].alias(m) for m in _MOMENTS]))
    total = F.aggregate(F.slice(bare, 2, F.greatest(F.size("_c") - 1, F.lit(0))), F.get(bare, F.lit(0)), _merged)
    return merged.select(*named, total.alias("_m")).select(*named, "_m.*")


def corr_from_moments(digits: int = CORR_DIGITS) -> Column:
    """Pearson r from pair moments; NULL for n < 2 or a side whose values
    over the common dates are all equal (decided on the values themselves)."""
    flat = (F.col("x0") == F.col("x1")) | (F.col("y0") == F.col("y1"))
    raw = F.try_divide(F.col("cxy"), F.sqrt("cxx") * F.sqrt("cyy"))
    # clamp rounding noise just outside [-1, 1] (inside the WHEN: least and
    # greatest skip NULLs and would turn an undefined r into 1.0)
    r = F.when((F.col("n") >= 2) & ~flat & raw.isNotNull(),
               F.greatest(F.lit(-1.0), F.least(F.lit(1.0), raw)))
    return round_away(r, digits)


def corr_matrix_long(long: DataFrame, assets: DataFrame, date: str = "date", symbol: str = "symbol",
                     value: str = "daily_return_pct", digits: int = CORR_DIGITS,
                     **kw) -> DataFrame:
    """Symmetric matrix of an asset set in long form (symbol_a, symbol_b,
    corr), the diagonal included; pairwise-complete observations.  Pairs
    without a common date have no row."""
    m = pair_moments(long, assets, date, symbol, value, **kw)
    a, b = F.col("key_a"), F.col("key_b")
    # both orientations from one pass (a union would run the moments twice)
    cells = F.when(a == b, F.array(F.struct(a.alias("symbol_a"), b.alias("symbol_b"))))
    cells = cells.otherwise(F.array(F.struct(a.alias("symbol_a"), b.alias("symbol_b")),
                                    F.struct(b.alias("symbol_a"), a.alias("symbol_b"))))
    return (m.select(F.explode(cells).alias("_c"), corr_from_moments(digits).alias("corr"))
            .select("_c.symbol_a", "_c.symbol_b", "corr"))


def corr_matrix_wide(long: DataFrame, assets: DataFrame, date: str = "date", symbol: str = "symbol",
                     value: str = "daily_return_pct", **kw) -> DataFrame:
    """N x N matrix: one row per symbol, one column per symbol."""
    symbols = pivot_symbols(assets, assets.columns[0])
    cells = corr_matrix_long(long, assets, date, symbol, value, **kw)
    return (cells.groupBy(F.col("symbol_a").alias("symbol"))
            .pivot("symbol_b", symbols).agg(F.first("corr")))


def corr_of_pairs(long: DataFrame, pairs: DataFrame, date: str, key: str, value: str,
                  digits: int = CORR_DIGITS) -> DataFrame:
    """Correlation of the given pairs only (``key_a``, ``key_b``) over their
    common dates: (key_a, key_b, corr), no row for a pair without one.  Repeated
    pairs count once.  The work grows with the rows of the assets of the pairs,
    not with all pairs of assets: two joins and one map-side aggregate."""
    v = written(one_value(long, date, key, value), "pair-values")
    named = written(pairs.select("key_a", "key_b").where("key_a IS NOT NULL AND key_b IS NOT NULL").distinct(), "pairs")
    x = v.join(named, F.col("_k") == F.col("key_a")).select("key_a", "key_b", "_d", F.col("_v").alias("_x"))
    both = x.join(v.select(F.col("_k").alias("_kb"), F.col("_d").alias("_db"), F.col("_v").alias("_y")),
                  (F.col("key_b") == F.col("_kb")) & (F.col("_d") == F.col("_db")))
    return both.groupBy("key_a", "key_b").agg(
        F.count(F.lit(1)).alias("n"), F.covar_pop("_x", "_y").alias("cxy"), F.var_pop("_x").alias("cxx"),
        F.var_pop("_y").alias("cyy"), F.min("_x").alias("x0"), F.max("_x").alias("x1"), F.min("_y").alias("y0"),
        F.max("_y").alias("y1")).select("key_a", "key_b", corr_from_moments(digits).alias("corr"))


def corr_pairs(fact: DataFrame, dim_asset: DataFrame, value: str = "daily_return_pct",
               digits: int = CORR_DIGITS, pairs: DataFrame | None = None, **kw) -> DataFrame:
    """Documented pair query: correlation of each unordered asset pair over
    common calendar days, the pair oriented by surrogate key (a < b).  ``pairs``
    (two columns of surrogate keys) names the pairs wanted; without it they are
    all pairs of the dimension."""
    # yyyymmdd as a day, so that chunks of days are even
    rows = fact.select("coin_sk", value, F.to_date(F.col("date_id").cast("string"), "yyyyMMdd").alias("day"))
    if pairs is None:
        found = pair_moments(rows, dim_asset.select("coin_sk", "symbol"), "day", "coin_sk", value, label="symbol", **kw).where("key_a <> key_b")
        return found.select(F.col("label_a").alias("symbol_a"), F.col("label_b").alias("symbol_b"),
                            corr_from_moments(digits).alias("correlation"))
    a, b = (F.col(c) for c in pairs.columns[:2])
    wanted = pairs.select(F.least(a, b).alias("key_a"), F.greatest(a, b).alias("key_b")).where("key_a <> key_b")
    found = corr_of_pairs(rows, wanted, "day", "coin_sk", value, digits).withColumnRenamed("corr", "correlation")
    syms = dim_asset.select("coin_sk", "symbol")
    return (found.join(syms.withColumnsRenamed({"coin_sk": "key_a", "symbol": "symbol_a"}), "key_a")
            .join(syms.withColumnsRenamed({"coin_sk": "key_b", "symbol": "symbol_b"}), "key_b")
            .select("symbol_a", "symbol_b", "correlation"))


# --------------------------------------------------------------------------
# rolling correlation against a benchmark
# --------------------------------------------------------------------------

def rolling_corr(long: DataFrame, benchmark: str, window: int = 30,
                 date: str = "date", symbol: str = "symbol", value: str = "daily_return_pct",
                 digits: int = CORR_DIGITS, chunk_rows: int | str = AUTO) -> DataFrame:
    """Rolling ``window``-row correlation of every other symbol with the
    benchmark over the shared date grid (all dates any symbol has).

    A frame needs ``window`` complete pairs, so a missing day anywhere in
    the frame gives NULL.  Every (grid date, symbol) row is returned, NULL
    where undefined; nothing when the benchmark is absent.  A second value
    of a (date, symbol) raises.  With :data:`AUTO` a DATE grid takes one
    window per symbol (at most 366 rows a year), any other grid chunks."""
    v = written(one_value(long, date, symbol, value).withColumnRenamed("_k", "_s"), "rolling")
    w_rows = lambda w: w.rowsBetween(-(window - 1), 0)
    both = F.col("_x").isNotNull() & F.col("_y").isNotNull()

    def cells(w) -> Column:
        pairs = F.count(F.when(both, F.lit(1))).over(w)
        return F.when(pairs >= window, round_away(safe_corr("_x", "_y", window=w), digits)).alias("rolling_corr")

    if chunk_rows == AUTO and isinstance(long.schema[date].dataType, T.DateType):
        bench = v.where(F.col("_s") == benchmark).select("_d", F.col("_v").alias("_y"))
        lo, hi = v.agg(F.min("_d"), F.max("_d")).first()
        # the dates that any symbol has, one row each: the grid's calendar
        dates = written(v.select("_d").distinct().join(bench, "_d", "left"), "rolling-dates")
        syms = v.where(F.col("_s") != benchmark).select("_s").distinct()
        if lo is None or bench.isEmpty():
            syms, lo, hi = syms.limit(0), dt.date(1970, 1, 1), dt.date(1970, 1, 1)
        grid = syms.select("_s", F.explode(F.sequence(F.lit(lo), F.lit(hi), F.expr("INTERVAL 1 DAY"))).alias("_d"))
        filled = (grid.join(dates, "_d")
                  .join(v.withColumnRenamed("_v", "_x"), ["_s", "_d"], "left"))
        w = w_rows(Window.partitionBy("_s").orderBy("_d"))
        return filled.select(F.col("_d").alias(date), F.col("_s").alias(symbol), cells(w))

    chunk_rows = DEFAULT_CHUNK_ROWS if chunk_rows == AUTO else chunk_rows
    if chunk_rows <= window:
        raise ValueError("chunk_rows must exceed the window")
    # the grid index (one row per date) is read by four branches: once
    grid_dates = written(row_index(v.select("_d").distinct(), [], ["_d"], name="_g"), "rolling-grid")
    vg = v.join(grid_dates, "_d")
    bench = vg.where(F.col("_s") == benchmark).select("_g", F.col("_v").alias("_y"))
    others = vg.where(F.col("_s") != benchmark).select("_s", "_g", F.col("_v").alias("_x"))

    size = grid_dates.count() if not bench.isEmpty() else 0
    syms = (others.select("_s").distinct().withColumn("_G", F.lit(size).cast("long"))
            .where(F.col("_G") > 0))
    c = F.lit(chunk_rows)
    chunks = syms.select("_s", "_G", F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((F.col("_G") - 1) / c))).alias("_c"))
    start = F.greatest(F.lit(1).cast("long"), F.col("_c") * c + 1 - (window - 1))
    end = F.least((F.col("_c") + 1) * c, F.col("_G"))
    grid = chunks.select("_s", "_c", F.explode(F.sequence(start, end)).alias("_g"))
    filled = (grid.join(others, ["_s", "_g"], "left")
              .join(bench, "_g", "left")
              .join(grid_dates, "_g"))
    w = w_rows(Window.partitionBy("_s", "_c").orderBy("_g"))
    home = F.floor((F.col("_g") - 1) / c)
    return (filled.select(F.col("_d").alias(date), F.col("_s").alias(symbol),
                          cells(w),
                          (F.col("_c") == home).alias("_home"))
            .where("_home").drop("_home"))
