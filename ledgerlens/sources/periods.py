"""Which periods a job has to load."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Period = tuple[int, int]


def current_and_previous(as_of: date) -> list[Period]:
    """The month of ``as_of`` and the one before it."""
    index = as_of.year * 12 + as_of.month - 1
    return [divmod_month(index), divmod_month(index - 1)]


def divmod_month(index: int) -> Period:
    return index // 12, index % 12 + 1


def work_list(as_of: date, full: bool = False, first: int = 2020, last: int | None = None) -> list[Period]:
    """All months of the years first..last in a full run (up to ``as_of``), else this month."""
    if not full:
        return [(as_of.year, as_of.month)]
    years = range(first, (last or as_of.year) + 1)
    months = [(y, m) for y in years for m in range(1, 13)]
    return [p for p in months if p <= (as_of.year, as_of.month)]


def in_periods(df: DataFrame, periods: Iterable[Period], year: str = "ano", month: str = "mes") -> DataFrame:
    """Rows of the listed months; on a partitioned table only those folders are read."""
    wanted = F.lit(False)
    for y, m in periods:
        wanted = wanted | ((F.col(year) == y) & (F.col(month) == m))
    return df.where(wanted)


def missing_periods(
    spark: SparkSession, wanted: Sequence[Period], existing: DataFrame, by: Sequence[str] = ("ano", "mes")
) -> DataFrame:
    """Wanted periods that the table does not hold yet."""
    todo = spark.createDataFrame(list(wanted), f"{by[0]} int, {by[1]} int")
    return todo.join(existing.select(*by).distinct(), list(by), "left_anti")


def since_last(source: DataFrame, target: DataFrame, by: str = "ano") -> DataFrame:
    """Rows from the newest period of the target onwards; everything for an empty target."""
    newest = target.agg(F.max(by).alias("_newest")).scalar()
    return source.where(F.coalesce(F.col(by) >= newest, newest.isNull()))
