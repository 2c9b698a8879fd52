"""Small helpers around Column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truth(predicate: Column) -> Column:
    """A flag that is never NULL: an unknown predicate counts as false."""
    return F.coalesce(predicate, F.lit(False))


def count_where(predicate: Column) -> Column:
    return F.count_if(predicate)


def sum_where(predicate: Column, value: str | Column, default: object = None) -> Column:
    """Sum of ``value`` over matching rows; ``default`` (say 0) for the others."""
    picked = F.when(predicate, as_col(value))
    return F.sum(picked if default is None else picked.otherwise(F.lit(default)))


def mean_where(predicate: Column, value: str | Column) -> Column:
    from ledgerlens.functions.numeric import mean

    return mean(F.when(predicate, as_col(value)))


def pick_where(predicate: Column, values: Iterable[str], order: Iterable[str]) -> Column:
    """Struct of ``values`` of the first matching row in ``order``: attributes of one row.

    ``values`` break ties, so rows that still tie are equal in all that is returned.
    """
    values = list(values)
    first = F.struct(*[F.col(c) for c in order], *[F.col(c).alias(f"_{c}") for c in values])
    return F.min_by(F.struct(*values), F.when(predicate, first))


def flag(predicate: Column, name: str) -> Column:
    return truth(predicate).alias(name)
