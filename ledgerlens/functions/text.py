"""Text cleaning."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.columns import as_col, truth


def standard(c: str | Column) -> Column:
    """Trimmed upper-case text."""
    return F.upper(F.trim(as_col(c)))


def filled(c: str | Column) -> Column:
    """True for text that is neither NULL nor blank."""
    return truth(F.trim(as_col(c)) != "")


def contains_any(c: str | Column, words: Iterable[str]) -> Column:
    """True where the upper-cased text holds one of the words."""
    upper = F.upper(as_col(c))
    found = F.lit(False)
    for word in words:
        found = found | upper.contains(word)
    return truth(found)


def truthy(c: str | Column) -> Column:
    """Text or number that stands for yes: TRUE, 1, SIM, S."""
    return truth(F.upper(F.trim(as_col(c).cast("string"))).isin("TRUE", "1", "SIM", "S"))
