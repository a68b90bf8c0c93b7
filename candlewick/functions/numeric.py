"""Numeric column functions with SQL-warehouse semantics.

All of them are plain Spark expressions: they stay inside whole-stage
codegen and behave the same with ANSI mode on or off (no expression here
can raise on bad input or on a zero divisor).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text accepted as a number: optional sign, digits with an optional
# fraction (or a bare fraction), optional exponent, surrounding blanks.
# Rejects thousands separators and Java float suffixes such as "12d",
# which Spark's own cast would accept.
NUMBER_PATTERN = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INFINITY_PATTERN = r"^\s*[+-]?(?i:inf|infinity)\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_away(c, digits: int) -> Column:
    """Round half away from zero on the binary double value.

    ``F.round`` rounds the shortest decimal rendering (1.005 -> 1.01);
    warehouses such as DuckDB scale, round the binary value and scale
    back (1.005 -> 1.0).  Scaling first and rounding to an integer gives
    the latter, because an integer-scale HALF_UP of a double is exact.
    """
    scale = F.lit(float(10 ** digits))
    return F.round(_col(c) * scale, 0) / scale


def safe_pct(num, den, digits: int = 4) -> Column:
    """``round(num / den * 100, digits)``; NULL instead of an error or
    +-inf when ``den`` is zero."""
    return round_away(F.try_divide(_col(num), _col(den)) * F.lit(100.0), digits)


def safe_corr(x, y, window=None) -> Column:
    """Pearson correlation over pair-complete rows, as an aggregate or,
    with ``window``, over a window frame.  Returns NULL for fewer than two
    pairs or a zero variance (``F.corr`` raises DIVIDE_BY_ZERO under ANSI
    on a flat series).
    """
    x, y = _col(x), _col(y)
    both = x.isNotNull() & y.isNotNull()
    xm, ym = F.when(both, x), F.when(both, y)
    over = (lambda c: c.over(window)) if window is not None else (lambda c: c)
    return F.try_divide(over(F.covar_samp(xm, ym)),
                        over(F.stddev_samp(xm)) * over(F.stddev_samp(ym)))


def parse_number(c) -> Column:
    """Lenient text -> double: malformed text becomes NULL.

    NaN text also becomes NULL (a row with it is dropped like any other
    unparsable value); ``inf``/``infinity`` parse to +-Infinity.
    """
    s = _col(c).cast("string")
    return (
        F.when(s.rlike(NUMBER_PATTERN), F.trim(s).try_cast("double"))
        .when(s.rlike(INFINITY_PATTERN),
              F.when(s.rlike(r"^\s*-"), F.lit(float("-inf")))
              .otherwise(F.lit(float("inf"))))
    )


def exact_parts(c) -> tuple[Column, Column]:
    """A finite double as (place, whole number): c = whole * 2 ** (8 * place).

    The place is about the exponent in steps of 8 bits, chosen so low that all
    digits are left of it and so high that they fit into a long; both scalings
    are by powers of two, so nothing is rounded.  Whole numbers of one place
    add up exactly as decimals.  NULL for NULL, NaN and infinity."""
    v = _col(c).cast("double")
    usable = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))
    size = F.when(v == 0, F.lit(1.0)).otherwise(F.abs(v))
    place = F.when(usable, F.floor((F.log2(size) - 54) / 8))
    half = F.pow(F.lit(2.0), (place * -4).cast("double"))
    return place.cast("int"), (v * half * half).cast("long")
