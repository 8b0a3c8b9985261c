"""Ratios, rounding and moments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c, digits: int) -> Column:
    """Half-up rounding through a decimal, so 0.125 style ties do not depend on the binary value."""
    return F.round(_col(c).cast("decimal(30,10)"), digits).cast("double")


def ratio(num, den, scale: float = 1.0) -> Column:
    """``scale * num / den`` as double, null when the denominator is zero or null."""
    den = _col(den)
    return F.lit(scale) * _col(num).cast("double") / F.nullif(den, F.lit(0).cast("long")).cast("double")


def total(c) -> Column:
    """Sum that is 0, not null, when every value is null."""
    return F.coalesce(F.sum(c), F.lit(0)).cast("long")


def square(c) -> Column:
    """Exact square, wide enough to be summed over any number of rows."""
    wide = _col(c).cast("long")
    return (wide * wide).cast("decimal(20,0)")


def mean_of(n, s) -> Column:
    return ratio(s, n)


def deviation(n, s, ss, sample: bool) -> Column:
    """Standard deviation from count, sum and sum of squares.

    Whole-number inputs make ``n*ss - s*s`` exact, so the result does not depend on the order
    in which partial sums were merged and is exactly 0 when there is no spread.
    """
    wide = "decimal(38,0)"
    n, s, ss = (_col(c).cast(wide) for c in (n, s, ss))
    spread = (n * ss).cast(wide) - (s * s).cast(wide)
    nd = n.cast("double")
    den = nd * (nd - 1) if sample else nd * nd
    return F.sqrt(spread.cast("double") / F.nullif(den, F.lit(0.0)))


def clipped(c, upper) -> Column:
    """``min(c, upper)`` that keeps null (``least`` would return the limit)."""
    c = _col(c)
    return F.when(c > upper, F.lit(upper)).otherwise(c)
