"""Complex numbers as column pairs, rounding, and small numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

Complex = tuple[Column, Column]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def times(a: Complex, b: Complex) -> Complex:
    return a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]


def conj(a: Complex) -> Complex:
    return a[0], -a[1]


def inverse(a: Complex) -> Complex:
    """1 / a; null for zero."""
    power = a[0] * a[0] + a[1] * a[1]
    return F.try_divide(a[0], power), F.try_divide(-a[1], power)


def over(a: Complex, b: Complex) -> Complex:
    """a / b; null where b is zero."""
    power = b[0] * b[0] + b[1] * b[1]
    re, im = times(a, conj(b))
    return F.try_divide(re, power), F.try_divide(im, power)


def amp(re: Column | str = "re", im: Column | str = "im") -> Column:
    re, im = col(re), col(im)
    return F.sqrt(re * re + im * im)


def phase_deg(re: Column | str = "re", im: Column | str = "im") -> Column:
    return F.degrees(F.atan2(col(im), col(re)))


def rounded(c: Column | str, digits: int = 6) -> Column:
    """Rounded, with -0.0 as 0.0."""
    return F.round(col(c), digits) + F.lit(0.0)


#: Doubles below ``_COARSE`` are added on two grids and what is finer.
_COARSE, _GRIDS = 2.0**33, (2.0**20, 2.0**47)


def exact_mean(c: Column | str) -> Column:
    """The mean of doubles, as an aggregate whose sum does not depend on the order of the rows: it is zero where they cancel, only there.

    A double is cut into multiples of 2^-20, multiples of 2^-47 and the rest, each of which is added without rounding: 2^27 values
    below 32 in size (the sums of parts have to stay below 2^33), down to 2^-20 with all their bits. Values from 2^33 on, infinite
    ones and NaN are added as ``avg`` does.
    """
    c = col(c).cast("double")
    fine = F.abs(c) < _COARSE
    on_grid = lambda x, grid: F.rint(x * grid) / grid
    high = F.when(fine, on_grid(c, _GRIDS[0])).otherwise(c)
    low = F.when(fine, c - on_grid(c, _GRIDS[0])).otherwise(0.0)
    middle = on_grid(low, _GRIDS[1])
    return F.try_divide(F.sum(high) + F.sum(middle) + F.sum(low - middle), F.count(c))


def no_nan(c: Column | str) -> Column:
    """NaN as null: excluded."""
    c = col(c)
    return F.when(~F.isnan(c), c)


def decibel(power: Column | str, reference: float = 1.0) -> Column:
    return 10 * F.log10(F.try_divide(col(power), F.lit(float(reference))))
