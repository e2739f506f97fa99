"""Numeric helpers: division guards and half-up rounding on decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INTEGRAL = "decimal(38,0)"


def safe_div(num: Column, den: Column) -> Column:
    """num / NULLIF(den, 0); ANSI mode would otherwise raise on a zero."""
    return num / F.nullif(den, F.lit(0))


def _cents(c: Column) -> Column:
    """A count or an amount with two decimals, in hundredths, as an integer."""
    return (c.cast("decimal(34,2)") * F.lit(100)).cast(_INTEGRAL)


def half_up_ratio(num: Column, den: Column, factor: int, scale: int) -> Column:
    """ROUND(factor * num / den, scale), half up, as a double; NULL for den 0.

    A decimal quotient is itself rounded, and rounding it again can carry a
    value just below a tie over it. So the quotient is taken as an integer
    number of units of ``scale`` and its exact remainder decides.
    """
    d = F.nullif(F.abs(_cents(den)), F.lit(0).cast(_INTEGRAL))
    n = (F.abs(_cents(num)) * F.lit(factor * 10 ** scale)).cast(_INTEGRAL)
    rest = (n % d).cast(_INTEGRAL)
    whole = ((n - rest) / d).cast(_INTEGRAL)  # exact: no rest is left
    units = whole + F.when(rest * 2 >= d, F.lit(1)).otherwise(F.lit(0))
    sign = F.signum(num.cast("double")) * F.signum(den.cast("double"))
    return (units / F.lit(10 ** scale)).cast("double") * sign


def pct(num: Column, den: Column, scale: int) -> Column:
    """ROUND(100.0 * num / den, scale), half up on the exact quotient, as a double."""
    return half_up_ratio(num, den, 100, scale)


def money(col: Column) -> Column:
    return col.cast("decimal(18,2)")


def round_double(col: Column, scale: int) -> Column:
    """Half-up rounding (never banker's), reported as a double."""
    return F.round(col, scale).cast("double")


def avg_half_up(total: Column, n: Column, scale: int) -> Column:
    """Mean of a sum with two decimals over a count, half up on the exact quotient."""
    return half_up_ratio(total, n, 1, scale)
