"""Filters, coercion and set operations on whole rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.columns import as_col


def coerce(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast columns; a value that does not fit becomes NULL."""
    return df.withColumns({n: F.col(n).try_cast(t) for n, t in types.items()})


def at_least(df: DataFrame, name: str, low: object) -> DataFrame:
    """Rows with ``name >= low``; NULL does not qualify."""
    return df.where(F.col(name) >= F.lit(low))


def not_after(df: DataFrame, name: str, as_of: date | str, months: int = 12) -> DataFrame:
    """Drop rows dated further in the future than ``months`` after ``as_of``."""
    limit = F.add_months(F.lit(str(as_of)).cast("date"), months)
    return df.where(F.col(name) <= limit)


def only(df: DataFrame, **wanted: object) -> DataFrame:
    """Optional equality filters; a keyword of None filters nothing, a list means any of it."""
    for name, value in wanted.items():
        if value is None:
            continue
        many = isinstance(value, (list, tuple, set))
        df = df.where(F.col(name).isin(*value) if many else F.col(name) == F.lit(value))
    return df


def fill(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """COALESCE per column; a default may be a value or an expression."""
    return df.withColumns(
        {n: F.coalesce(F.col(n), d if isinstance(d, Column) else F.lit(d)) for n, d in defaults.items()}
    )


def value_if(c: str | Column, bad: object, replacement: str | Column) -> Column:
    """Replace one sentinel value, such as year 0."""
    return F.when(as_col(c) == F.lit(bad), as_col(replacement)).otherwise(as_col(c))


def union_padded(*frames: DataFrame) -> DataFrame:
    """UNION ALL by name; a column missing on one side is NULL there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def distinct_values(df: DataFrame, *names: str) -> DataFrame:
    """Values for a filter list."""
    return df.select(*names).distinct()


def presence(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumns({out: F.col(c).isNotNull() for out, c in names.items()})


def stamp(df: DataFrame, source: str, as_of: object, names: Sequence[str] = ("fonte_dado", "data_carga")) -> DataFrame:
    """Lineage columns: where the rows come from and the load time given by the caller."""
    return df.withColumns({names[0]: F.lit(source), names[1]: F.lit(as_of)})
