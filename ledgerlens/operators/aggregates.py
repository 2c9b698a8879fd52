"""Grouped measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_list(
    df: DataFrame,
    by: Sequence[str],
    value: str,
    out: str,
    separator: str = ", ",
    order: str | None = None,
) -> DataFrame:
    """Distinct values per group as one text, in a fixed order.

    Duplicates are merged in their own aggregation first; ``order`` is an expression whose
    smallest value per entry sorts the list (default: the value itself).
    """
    sort = F.col(value) if order is None else F.min(F.expr(order))
    if order is None:
        entries = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.lit(0).alias("_x"))
        entry = F.struct(F.col(value).alias("_sort"), F.col(value).alias("_text"))
    else:
        entries = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(sort.alias("_sort"))
        entry = F.struct(F.col("_sort"), F.col(value).alias("_text"))
    joined = F.array_join(F.array_sort(F.collect_list(entry)).getField("_text"), separator)
    return entries.groupBy(*by).agg(joined.alias(out))


def herfindahl(
    df: DataFrame, entity: Sequence[str], part: str, value: str, out: str = "indice_concentracao"
) -> DataFrame:
    """Concentration 0-100 of an entity's total over its parts: 100 means a single part."""
    parts = df.groupBy(*entity, part).agg(F.sum(value).alias("_v"))
    v, total = F.col("_v").cast("double"), F.sum("_v").cast("double")
    return parts.groupBy(*entity).agg(
        (F.try_divide(F.sum(v * v), total * total) * 100).alias(out)
    )


def main_part(
    df: DataFrame, entity: Sequence[str], part: str, value: str, out: str, share: str
) -> DataFrame:
    """The part with the largest value per entity and its share in percent."""
    parts = df.groupBy(*entity, part).agg(F.sum(value).alias("_v"))
    best = F.max_by(F.struct(F.col(part), F.col("_v")), F.struct("_v", part))
    return (
        parts.groupBy(*entity)
        .agg(best.alias("_best"), F.sum("_v").alias("_total"))
        .select(
            *entity,
            F.col(f"_best.{part}").alias(out),
            (
                F.try_divide(F.col("_best._v").cast("double"), F.col("_total").cast("double")) * 100
            ).alias(share),
        )
    )


def value_counts(df: DataFrame, by: Sequence[str], out: str = "quantidade") -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(out))


def metric_list(
    df: DataFrame,
    metrics: Mapping[str, tuple[Column, str]],
    names: tuple[str, str, str] = ("metrica", "valor", "descricao"),
) -> DataFrame:
    """One row per metric from a single aggregation; values are text."""
    one = df.agg(*[c.cast("string").alias(f"m{i}") for i, (c, _) in enumerate(metrics.values())])
    rows = [
        F.struct(
            F.lit(title).alias(names[0]),
            F.col(f"m{i}").alias(names[1]),
            F.lit(text).alias(names[2]),
        )
        for i, (title, (_, text)) in enumerate(metrics.items())
    ]
    return one.select(F.inline(F.array(*rows)))


def trend(df: DataFrame, x: str, y: str) -> DataFrame:
    """Straight-line fit and correlation over all rows."""
    fx, fy = F.col(x).cast("double"), F.col(y).cast("double")
    return df.agg(
        F.regr_slope(fy, fx).alias("inclinacao"),
        F.regr_intercept(fy, fx).alias("intercepto"),
        F.corr(fx, fy).alias("correlacao"),
    )
