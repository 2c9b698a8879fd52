"""Calendar arithmetic. Differences count crossed boundaries, not elapsed units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.columns import as_col

# Month names used in the reports.
MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)


def days_between(start: str | Column, end: str | Column) -> Column:
    return F.datediff(as_col(end).cast("date"), as_col(start).cast("date"))


def years_between(start: str | Column, end: str | Column) -> Column:
    return F.year(as_col(end)) - F.year(as_col(start))


def hours_between(start: str | Column, end: str | Column) -> Column:
    """Number of full-hour marks crossed from start to end."""
    first = F.date_trunc("hour", as_col(start)).cast("timestamp_ntz")
    last = F.date_trunc("hour", as_col(end)).cast("timestamp_ntz")
    return F.timestamp_diff("HOUR", first, last)


def quarter_label(month: str | Column) -> Column:
    """T1 to T4 from a month number."""
    return F.concat(F.lit("T"), F.ceil(as_col(month) / 3).cast("string"))


def year_month(year: str | Column, month: str | Column) -> Column:
    """``2024-03`` from two numbers."""
    return F.concat_ws(
        "-", as_col(year).cast("string"), F.lpad(as_col(month).cast("string"), 2, "0")
    )


def month_index(year: str | Column, month: str | Column) -> Column:
    """Months since year 0, one integer per month: cheaper to group by than text."""
    return as_col(year).cast("int") * 12 + as_col(month).cast("int") - 1


def month_name(month: str | Column) -> Column:
    names = F.array(*[F.lit(n) for n in MONTH_NAMES])
    return F.try_element_at(names, as_col(month).cast("int"))


def month_short(month: str | Column) -> Column:
    return F.substring(month_name(month), 1, 3)


def weekday_sunday_zero(day: str | Column) -> Column:
    return F.dayofweek(as_col(day)) - 1
