"""Exact arithmetic on integer money.

Sales are kept as integer cents until the last step.  Means, ratios and
percentages are formed from exact integer (or decimal(38,0)) sums and then
rounded half-up (away from zero) with integer division, so every engine and
every partitioning gives bit-identical results.  Floating point only appears
in the final ``cents / 100`` conversion, which is a single correctly rounded
IEEE division.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BIG = "decimal(38,0)"


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def dec(col) -> Column:
    """Widen an integer column so sums at cluster scale cannot overflow."""
    return _c(col).cast(_BIG)


def idiv(a, b) -> Column:
    """Integer division (truncates toward zero), result bigint."""
    return F.call_function("div", _c(a), _c(b))


def round_ratio(num, den, signed: bool = True) -> Column:
    """``round(num / den)`` half away from zero, for integers, den > 0.

    ``num`` may be a decimal(38,0) sum; the result is a bigint.  Null when
    ``den`` is null or zero.
    """
    num, den = _c(num), _c(den)
    den = F.when(den != 0, den)
    pos = idiv(num * 2 + den, den * 2)
    if not signed:
        return pos
    neg = -idiv(-num * 2 + den, den * 2)
    return F.when(num < 0, neg).otherwise(pos)


def cents_to_units(cents, scale: int = 100) -> Column:
    """Integer cents -> double units by one exact-input division."""
    return _c(cents).cast("double") / F.lit(float(scale))


def ratio_to_units(num, den, digits: int = 2) -> Column:
    """``round(num / den, digits)`` as a double, exact half-up rounding."""
    scale = 10 ** digits
    return cents_to_units(round_ratio(_c(num) * scale, den), scale)


def moment_std(n, s1, s2) -> Column:
    """Sample standard deviation from count, sum and sum of squares.

    With exact sums the variance numerator ``n*s2 - s1^2`` is exact; the
    square root is taken once in double.  Null under two rows.
    """
    n, s1, s2 = dec(n), dec(s1), dec(s2)
    num = (n * s2 - s1 * s1).cast("double")
    den = (n * (n - 1)).cast("double")
    return F.when(n >= 2, F.sqrt(F.greatest(num, F.lit(0.0)) / den))


def round_half_up(x, digits: int = 2) -> Column:
    """Half-up rounding of a double via floor (engine independent)."""
    scale = float(10 ** digits)
    return F.floor(_c(x) * scale + 0.5) / scale
