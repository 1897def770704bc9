"""Exact rounding on integer units, DOUBLE out.

Values are rounded half away from zero on their exact decimal value, the way a
SQL NUMERIC ``ROUND`` does. Working on integer units (DECIMAL(38,0), up to
10^38) keeps the result independent of float error, task order and engine.
The rounded integer is converted to DOUBLE once and divided by 10^digits once;
beyond 2^53 units (9e13 currency units at 2 decimals) that can differ in the
last bit from the DOUBLE nearest the decimal, identically in every engine. Everything here is a
plain Column expression, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def units(total: Column | str, scale: int) -> Column:
    """Exact number of 10^-scale units in a DECIMAL value (scale <= its own)."""
    return (_col(total) * F.lit(10**scale)).cast(_WIDE)


def round_ratio(num: Column | str, den: Column | str, digits: int, num_scale: int = 0) -> Column:
    """round(num / (den * 10^num_scale), digits), half away from zero, as DOUBLE.

    ``num`` and ``den`` are integral; null when either is null or den is 0.
    """
    shift = digits - num_scale
    top = _col(num).cast(_WIDE)
    bot = _col(den).cast(_WIDE)
    if shift >= 0:
        top = top * F.lit(10**shift)
    else:
        bot = bot * F.lit(10 ** (-shift))
    top = top.cast(_WIDE)
    bot = bot.cast(_WIDE)
    # floor((2|top| + bot) / 2bot), kept in DECIMAL(38,0): subtracting the
    # exact remainder first makes the division exact. (``div`` would return
    # a LONG and wrap silently past 9.2e18 units.)
    a = (F.abs(top) * 2 + bot).cast(_WIDE)
    b = (bot * 2).cast(_WIDE)
    q = ((a - a % b) / b).cast(_WIDE)
    q = F.when(top < 0, -q).otherwise(q)
    return F.when(bot != 0, q.cast("double") / F.lit(float(10**digits)))


def round_money(total: Column | str, digits: int) -> Column:
    """ROUND(sum, digits) for a DECIMAL money total (2 decimals)."""
    return round_ratio(units(total, 2), F.lit(1), digits, num_scale=2)


def mean_money(total: Column | str, n: Column | str, digits: int) -> Column:
    """ROUND(AVG(x), digits) given SUM(x) (2 decimals) and COUNT(x)."""
    return round_ratio(units(total, 2), n, digits, num_scale=2)


def percent(k: Column | str, n: Column | str, digits: int) -> Column:
    """ROUND(k * 100.0 / n, digits) for integer counts."""
    return round_ratio(_col(k).cast(_WIDE) * F.lit(100), n, digits)


def mean_percent(total: Column | str, n: Column | str, digits: int, scale: int = 4) -> Column:
    """ROUND(AVG(x) * 100, digits) given SUM(x) (``scale`` decimals) and COUNT(x)."""
    return round_ratio(units(total, scale), n, digits, num_scale=scale - 2)


def as_double(total: Column | str, scale: int = 2) -> Column:
    """A DECIMAL value (``scale`` decimals) as the nearest DOUBLE: one
    correctly rounded division of two exact integers, so any engine agrees."""
    return units(total, scale).cast("double") / F.lit(float(10**scale))


def mean(total: Column | str, n: Column | str, scale: int = 2) -> Column:
    """Unrounded mean SUM/COUNT as DOUBLE, one correctly rounded division."""
    den = (_col(n).cast(_WIDE) * F.lit(10**scale)).cast("double")
    return F.when(_col(n) != 0, units(total, scale).cast("double") / den)
