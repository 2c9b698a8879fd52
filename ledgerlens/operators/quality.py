"""Data-quality checks as Spark jobs. Each returns the offending rows or one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def columns_exist(df: DataFrame, names: Sequence[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"no such column: {', '.join(missing)}")


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    columns_exist(df, keys)
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("ocorrencias"))
    return counted.where(F.col("ocorrencias") > 1)


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All rows that share their key with another row."""
    repeated = duplicates(df, keys).drop("ocorrencias")
    return df.join(repeated, list(keys), "left_semi")


def null_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Rows with NULL per column: one scan for all columns."""
    columns_exist(df, names)
    one = df.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])
    return one.unpivot([], list(names), "coluna", "nulos")


def unexpected_values(df: DataFrame, name: str, accepted: Sequence[object]) -> DataFrame:
    """Values outside the accepted list and how often they occur; NULL is not judged."""
    columns_exist(df, [name])
    outside = df.where(F.col(name).isNotNull() & ~F.col(name).isin(*accepted))
    return outside.groupBy(F.col(name).alias("valor")).agg(F.count(F.lit(1)).alias("ocorrencias"))


def orphans(df: DataFrame, parent: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Rows whose key has no parent row; a NULL key is not judged."""
    columns_exist(df, list(keys))
    known = parent.select(*[F.col(p).alias(c) for c, p in keys.items()]).dropna()
    return df.dropna(subset=list(keys)).join(known, list(keys), "left_anti")


def staleness(df: DataFrame, name: str, as_of: str) -> DataFrame:
    """Newest value and its age in days at ``as_of``."""
    newest = F.max(name)
    return df.agg(
        newest.alias("mais_recente"),
        F.datediff(F.lit(as_of).cast("date"), newest.cast("date")).cast("bigint").alias("dias"),
    )


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each named rule; an unknown result does not break it."""
    one = df.agg(*[F.count_if(~rule).alias(name) for name, rule in rules.items()])
    return one.unpivot([], list(rules), "regra", "violacoes")


def summary(checks: Mapping[str, DataFrame]) -> DataFrame:
    """One row per check: name, failing rows, passed."""
    rows = [
        df.agg(F.count(F.lit(1)).alias("falhas")).select(
            F.lit(name).alias("verificacao"), "falhas", (F.col("falhas") == 0).alias("aprovada")
        )
        for name, df in checks.items()
    ]
    return reduce(DataFrame.unionByName, rows)
