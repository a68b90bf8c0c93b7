"""Row-frame windows over per-key series that stay parallel when one key
holds a large share of all rows.

``Window.partitionBy(asset)`` puts a whole asset into one task: with three
assets the job has three tasks however big the cluster is.  The operators
here number the rows of each key without ever sorting a whole key in one
place, cut every key into chunks of ``chunk_rows`` consecutive rows and
copy the last ``lookback`` rows of each chunk into the next one (a halo).
A frame that looks back at most ``lookback`` rows then sees exactly the
rows it would see in the unsplit series, so results are identical to the
plain window while the work spreads over ``rows / chunk_rows`` tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_CHUNK_ROWS = 1 << 20
# Chunk by the declared type of the order column: a DATE order that is unique
# within a key has at most 366 rows a year and needs no chunks; any other
# order is chunked by DEFAULT_CHUNK_ROWS.
AUTO = "auto"

_B, _R, _G, _C, _HOME = "_cw_bucket", "_cw_local", "_cw_index", "_cw_chunk", "_cw_home"


def time_bucket(order_col: str, dtype: T.DataType) -> Column:
    """A coarse, order-preserving slice of the order column: the month for
    dates (daily bars), the day for timestamps (intraday bars), blocks of
    4096 for integral columns."""
    c = F.col(order_col)
    if isinstance(dtype, T.DateType):
        return F.year(c) * 12 + F.month(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_date(F.to_date(c)).cast("long")
    if isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return F.floor(c / F.lit(4096))
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return F.floor(c.cast("double"))
    raise TypeError(f"cannot slice the order column {order_col!r} of type {dtype.simpleString()}; "
                    "pass a bucket column")


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              bucket: Column | None = None, name: str = _G) -> DataFrame:
    """Add ``name``: the 1-based position of each row inside its key,
    ordered by ``order`` (which must be unique within a key).

    Rows are numbered inside (key, bucket) slices, where the bucket is a
    coarse order-preserving function of the order column; every slice is
    then shifted by the row count of the earlier slices of its key.  Only
    the small table of slice sizes is ever grouped by key alone.
    """
    keys, order = list(keys), list(order)
    if bucket is None:
        bucket = time_bucket(order[0], df.schema[order[0]].dataType)
    local = df.withColumn(_B, bucket).withColumn(
        _R, F.row_number().over(Window.partitionBy(*keys, _B).orderBy(*order)))
    sizes = local.groupBy(*keys, _B).agg(F.max(_R).alias("_cw_n"))
    before = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *keys, _B, F.coalesce(F.sum("_cw_n").over(before), F.lit(0)).alias("_cw_off"))
    renamed = offsets.withColumnsRenamed({c: f"_cw_k_{c}" for c in [*keys, _B]})
    joined = local.join(renamed,
                        on=_null_safe_pairs(keys, _B), how="inner")
    return (joined.withColumn(name, F.col("_cw_off") + F.col(_R))
            .drop(_B, _R, "_cw_off", *[f"_cw_k_{k}" for k in keys], f"_cw_k_{_B}"))


def _null_safe_pairs(keys: Sequence[str], bucket: str) -> Column:
    # null-safe throughout: no inferred IS NOT NULL filter is pushed into one
    # branch only, so both uses of the numbered rows keep one identical plan
    # and Spark reuses its shuffle instead of recomputing the input
    cond = F.col(bucket).eqNullSafe(F.col(f"_cw_k_{bucket}"))
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_cw_k_{k}"))
    return cond


def chunked_window(df: DataFrame, keys: Sequence[str], index: str, lookback: int,
                   columns: Callable[[WindowSpec], dict[str, Column]],
                   chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Evaluate window columns whose frames reach at most ``lookback`` rows
    back, over (key, chunk) partitions of ``chunk_rows`` consecutive rows.

    ``index`` is the 1-based row position inside the key (see
    :func:`row_index`).  ``columns(w)`` receives the spec partitioned by
    key and chunk and ordered by ``index`` and returns the new columns;
    frames are added by the caller (``w.rowsBetween(-6, 0)``).
    """
    w = Window.partitionBy(*keys, _C).orderBy(index)
    out = _in_chunks(df, index, lookback, chunk_rows).withColumns(columns(w))
    return out.where(F.col(_C) == F.col(_HOME)).drop(_C, _HOME)


def _in_chunks(df: DataFrame, index: str, lookback: int, chunk_rows: int) -> DataFrame:
    """Rows with their own chunk and the chunk that they are in: the last
    ``lookback`` rows of a chunk are in the next one, too."""
    if chunk_rows <= lookback:
        raise ValueError("chunk_rows must exceed the window lookback")
    pos = F.col(index) - 1
    home = F.floor(pos / F.lit(chunk_rows))
    in_halo = (pos % F.lit(chunk_rows)) >= F.lit(chunk_rows - lookback)
    return (df.withColumn(_HOME, home)
            .withColumn(_C, F.explode(F.when(in_halo & F.lit(lookback > 0),
                                             F.array(F.col(_HOME), F.col(_HOME) + 1))
                                      .otherwise(F.array(F.col(_HOME))))))


def series_window(df: DataFrame, keys: Sequence[str], order: Sequence[str], lookback: int,
                  columns: Callable[[WindowSpec], dict[str, Column]],
                  chunk_rows: int | str | None = AUTO,
                  bucket: Column | None = None) -> DataFrame:
    """Row-frame window columns per key ordered by ``order``.

    ``chunk_rows=None`` uses one plain window partitioned by key; a number
    indexes the rows and cuts each key into chunks, so a hot key is spread
    over many tasks; :data:`AUTO` takes the plain window for a DATE order.
    """
    keys, order = list(keys), list(order)
    if chunk_rows == AUTO:
        dates = len(order) == 1 and isinstance(df.schema[order[0]].dataType, T.DateType)
        chunk_rows = None if dates else DEFAULT_CHUNK_ROWS
    if chunk_rows is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns(columns(w))
    indexed = row_index(df, keys, order, bucket=bucket)
    return chunked_window(indexed, keys, _G, lookback, columns, chunk_rows).drop(_G)


@dataclass(frozen=True)
class Frame:
    """An aggregate (sum, avg, count, min or max) of a column's values in the
    last ``rows`` rows, the current one included."""
    column: str
    kind: str
    rows: int


# kind -> (aggregates that are kept, how two parts of a frame become one)
_PARTS = {"sum": ("sum",), "count": ("count",), "avg": ("sum", "count"), "min": ("min",), "max": ("max",)}


def sliding(df: DataFrame, keys: Sequence[str], order: Sequence[str], frames: Mapping[str, Frame],
            chunk_rows: int | None = None, bucket: Column | None = None) -> DataFrame:
    """Aggregates of sliding row frames of any length, a few steps a row.

    A plain sliding window adds up its whole frame for every row.  Here the
    rows of a key are cut into blocks of the frame's length: a frame is the end
    of one block and the beginning of the next, so it is one running aggregate
    from the block's start and one, a frame ago, to its block's end.  Nothing
    is subtracted, so no digits are lost.  NULLs are left out as SQL does; the
    first rows of a key have the part of the frame that there is.  ``order``
    must be unique within a key, whose rows spread over chunks of
    ``chunk_rows`` (by default a million, or eight of the longest frame)."""
    keys, order = list(keys), list(order)
    longest = max(f.rows for f in frames.values())
    if min(f.rows for f in frames.values()) < 1 or {f.kind for f in frames.values()} - set(_PARTS):
        raise ValueError("frames have one row at least and a kind of " + ", ".join(_PARTS))
    chunk_rows = chunk_rows or max(DEFAULT_CHUNK_ROWS, 8 * longest)
    out = _in_chunks(row_index(df, keys, order, bucket=bucket), _G, longest - 1, chunk_rows)
    parts = {(f.column, k, f.rows) for f in frames.values() for k in _PARTS[f.kind]}
    names = {p: f"_cw_{i}" for i, p in enumerate(sorted(parts))}
    in_chunk = Window.partitionBy(*keys, _C).orderBy(_G)
    for n in sorted({f.rows for f in frames.values()}):
        own = {p: c for p, c in names.items() if p[2] == n}
        out = out.withColumn("_cw_block", F.floor((F.col(_G) - 1) / F.lit(n)))
        block = Window.partitionBy(*keys, _C, "_cw_block")
        until = block.orderBy(F.desc(_G)).rowsBetween(Window.unboundedPreceding, 0)
        since = block.orderBy(_G).rowsBetween(Window.unboundedPreceding, 0)
        agg = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
        out = out.withColumns({f"{c}_u": agg[k](col).over(until) for (col, k, _), c in own.items()})
        out = out.withColumns({f"{c}_s": agg[k](col).over(since) for (col, k, _), c in own.items()})
        # the rest of the frame, where the block's rows do not fill it
        short = (F.col(_G) - 1) % n < n - 1
        out = out.withColumns({f"{c}_u": F.when(short, F.lag(f"{c}_u", n - 1).over(in_chunk)) for c in own.values()})
        out = out.withColumns({c: _both(k, F.col(f"{c}_u"), F.col(f"{c}_s")) for (_, k, _), c in own.items()})
        out = out.drop("_cw_block", *[f"{c}_{x}" for c in own.values() for x in "us"])

    def value(f: Frame) -> Column:
        part = [F.col(names[f.column, k, f.rows]) for k in _PARTS[f.kind]]
        return F.try_divide(*part) if f.kind == "avg" else part[0]

    out = out.where(F.col(_C) == F.col(_HOME)).withColumns({name: value(f) for name, f in frames.items()})
    return out.drop(_C, _HOME, _G, *names.values())


def _both(kind: str, a: Column, b: Column) -> Column:
    if kind in ("sum", "count"):
        return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)
    return (F.least if kind == "min" else F.greatest)(a, b)  # these skip NULLs
