"""Money, ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.columns import as_col


def money(c: str | Column, scale: int = 4) -> Column:
    """Exact amount: sums over it do not depend on the order of the rows."""
    return as_col(c).cast(f"decimal(18,{scale})")


def round_to(c: str | Column, scale: int = 2) -> Column:
    """Round half up on the decimal value, so 1.005 becomes 1.01; result is a double."""
    return F.round(as_col(c).cast("decimal(28,8)"), scale).cast("double")


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as a double; NULL where the denominator is zero or NULL."""
    return F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))


def percent(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """Share in percent, rounded; NULL for a zero denominator."""
    return round_to(ratio(num, den) * 100, scale)


def percent_or_zero(num: str | Column, den: str | Column, scale: int = 2) -> Column:
    """Like :func:`percent`, but 0 where the denominator is not positive."""
    return F.when(as_col(den) > 0, percent(num, den, scale)).otherwise(F.lit(0.0))


def growth_percent(current: str | Column, previous: str | Column) -> Column:
    """Change against the previous value in percent, unrounded; NULL when that value is zero."""
    cur, prev = as_col(current), as_col(previous)
    return ratio(cur - prev, prev) * 100


def mean(c: str | Column) -> Column:
    """Average from an exact sum: feed it integers or decimals, get a double."""
    col = as_col(c)
    return ratio(F.sum(col), F.count(col))


def mean_rounded(c: str | Column, scale: int = 2) -> Column:
    return round_to(mean(c), scale)


def currency(c: str | Column, symbol: str = "R$ ") -> Column:
    """Text such as ``R$ 1,234.56``; for reports only."""
    return F.concat(F.lit(symbol), F.format_number(as_col(c).cast("decimal(38,2)"), 2))
