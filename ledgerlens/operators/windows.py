"""Latest rows, top-n, shares, growth and neighbours."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.columns import as_col
from ledgerlens.functions.numeric import growth_percent
from ledgerlens.operators.ordered import ordered_prefix


def latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """One row per key, the first in the given order.

    Spark drops the other rows of a key before the shuffle (window group limit), so a key that
    holds a large part of the table costs no more than any other.
    """
    return top_n(df, keys, order_by, 1, "_rank").drop("_rank")


def top_n(
    df: DataFrame,
    partition_by: Sequence[str],
    order_by: Sequence[Column],
    n: int,
    rank: str = "rank_no",
) -> DataFrame:
    """First ``n`` rows per group with their rank; pruned before the shuffle."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def largest(df: DataFrame, order_by: Sequence[Column], n: int) -> DataFrame:
    """Global top-n: each task keeps n rows, then they are merged."""
    return df.orderBy(*order_by).limit(n)


def period_growth(
    df: DataFrame,
    entity: Sequence[str],
    period: str,
    value: str,
    out: str = "crescimento_percentual",
    consecutive: bool = False,
    previous_period: str = "_previous_period",
    previous_value: str = "_previous_value",
) -> DataFrame:
    """Growth against the previous period of the same entity, on one row per entity and period.

    ``consecutive`` keeps only rows whose previous period is exactly one earlier.
    """
    w = Window.partitionBy(*entity).orderBy(period)
    both = df.withColumns(
        {previous_period: F.lag(period).over(w), previous_value: F.lag(value).over(w)}
    )
    if consecutive:
        both = both.where(F.col(period) - F.col(previous_period) == 1)
    return both.withColumn(out, growth_percent(value, previous_value))


# Fixed value: rows of one key that one task puts into order; longer logs are split by calendar buckets.
LONG_LOG = 10_000


def by_length(df: DataFrame, key: Sequence[str], rows: int = LONG_LOG) -> tuple[DataFrame, DataFrame]:
    """The rows of keys with at most so many rows, and those of all other keys; no key may be NULL.

    The keys of the second part are at most one per ``rows`` rows of the table, so they are broadcast.
    """
    key = list(key)
    long = F.broadcast(df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).select(*key))
    return df.join(long, key, "left_anti").select(*df.columns), df.join(long, key, "left_semi").select(*df.columns)


def in_buckets(df: DataFrame, time: str, unit: str = "month") -> DataFrame:
    """Calendar bucket of each row, which splits the log of one key over several tasks."""
    return df.withColumn("_bucket", F.date_trunc(unit, F.col(time)))


def previous_in_buckets(
    df: DataFrame, key: Sequence[str], time: str, value: str, out: str, tie: Sequence[str] = ()
) -> DataFrame:
    """LAG per key for rows with a ``_bucket``; keeps the bucket and its partitioning.

    The window runs inside (key, bucket); the first row of a bucket takes the last value of the
    key's previous bucket, from a table with one row per key and bucket.
    """
    key, tie = list(key), list(tie)
    w = Window.partitionBy(*key, "_bucket").orderBy(time, *tie)
    inside = df.withColumns({out: F.lag(value).over(w), "_row": F.row_number().over(w)})
    ends = df.groupBy(*key, "_bucket").agg(
        F.max_by(F.col(value), F.struct(time, *tie)).alias("_end")
    )
    earlier = Window.partitionBy(*key).orderBy("_bucket")
    carry = ends.select(*key, "_bucket", F.lag("_end").over(earlier).alias("_carry"))
    return (
        inside.join(carry, [*key, "_bucket"])
        .withColumn(out, F.when(F.col("_row") == 1, F.col("_carry")).otherwise(F.col(out)))
        .select(*df.columns, out)
    )


def next_in_buckets(df: DataFrame, key: Sequence[str], time: str, out: str) -> DataFrame:
    """Time of the key's next row, like :func:`previous_in_buckets`. Times must differ."""
    key = list(key)
    w = Window.partitionBy(*key, "_bucket").orderBy(time)
    starts = df.groupBy(*key, "_bucket").agg(F.min(time).alias("_begin"))
    later = Window.partitionBy(*key).orderBy("_bucket")
    carry = starts.select(*key, "_bucket", F.lead("_begin").over(later).alias("_carry"))
    return (
        df.withColumn(out, F.lead(time).over(w))
        .join(carry, [*key, "_bucket"])
        .withColumn(out, F.coalesce(F.col(out), F.col("_carry")))
        .select(*df.columns, out)
    )


def previous_in_time(
    df: DataFrame,
    key: Sequence[str],
    time: str,
    value: str,
    out: str,
    tie: Sequence[str] = (),
    unit: str = "month",
    rows: int = LONG_LOG,
) -> DataFrame:
    """LAG per key over a log of any length; keys with more than ``rows`` rows are spread over
    calendar buckets. Rows without key or time are dropped."""
    short, long = by_length(df.dropna(subset=[*key, time]), key, rows)
    before = F.lag(value).over(Window.partitionBy(*key).orderBy(time, *tie))
    spread = previous_in_buckets(in_buckets(long, time, unit), key, time, value, out, tie).drop("_bucket")
    return short.withColumn(out, before).unionByName(spread)


def top_share(
    df: DataFrame,
    partition_by: Sequence[str],
    value: str,
    key: Sequence[str],
    share: float = 0.1,
    at_least: int = 1,
    rows: str = "total",
    picked: str = "top",
    out: str = "concentracao",
) -> DataFrame:
    """Percent of each group's total that its top ``share`` of members holds (Pareto)."""
    order = [F.col(value).desc(), *[F.col(k) for k in key]]
    ranked = ordered_prefix(df, order, partition_by, rank="_rank", rows="_rows")
    part = F.lit(share).cast("decimal(9,6)")
    k = F.greatest(F.lit(at_least).cast("bigint"), F.floor(F.col("_rows") * part).cast("bigint"))
    head = F.sum(F.when(F.col("_rank") <= k, F.col(value))).cast("double")
    return ranked.groupBy(*partition_by).agg(
        F.max("_rows").alias(rows),
        F.max(k).alias(picked),
        (F.try_divide(head, F.sum(value).cast("double")) * 100).alias(out),
    )


def lorenz(
    df: DataFrame, partition_by: Sequence[str], value: str, key: Sequence[str]
) -> DataFrame:
    """Cumulative share of members against cumulative share of value, largest first."""
    order = [F.col(value).desc(), *[F.col(k) for k in key]]
    run = ordered_prefix(
        df, order, partition_by, sums={"_running": value}, rank="posicao", rows="_rows",
        totals={"_total": value},
    )
    members = F.col("posicao").cast("double") / F.col("_rows").cast("double") * 100
    amount = F.try_divide(F.col("_running").cast("double"), F.col("_total").cast("double")) * 100
    return run.select(
        *df.columns,
        "posicao",
        members.alias("percentual_membros"),
        amount.alias("percentual_valor_acumulado"),
    )


def share_of(df: DataFrame, by: Sequence[str], value: str, out: str, scale: float = 100.0) -> DataFrame:
    """Share of each (already aggregated) row in the total of its group."""
    from ledgerlens.operators.joins import with_group_stats

    both = with_group_stats(df, by, {"_total": F.sum(value)})
    part = F.try_divide(F.col(value).cast("double"), F.col("_total").cast("double")) * scale
    return both.withColumn(out, part).drop("_total")


def mode_of(
    df: DataFrame, by: Sequence[str], value: str, out: str | None = None
) -> DataFrame:
    """Most frequent value per group, the smallest one among equals."""
    counts = df.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_times"))
    best = latest(counts, by, [F.col("_times").desc(), F.col(value).asc()])
    return best.select(*by, F.col(value).alias(out or value))


def pivot_sum(
    df: DataFrame,
    by: Sequence[str],
    pivot: str,
    values: Mapping[object, str],
    measure: str | Column,
    fill: object | None = 0,
) -> DataFrame:
    """Rows to columns with the values given up front, over sums per (group, value)."""
    merged = df.groupBy(*by, pivot).agg(F.sum(as_col(measure)).alias("_cell"))
    cells = []
    for v, name in values.items():
        cell = F.sum(F.when(F.col(pivot) == F.lit(v), F.col("_cell")))
        cells.append((cell if fill is None else F.coalesce(cell, F.lit(fill))).alias(name))
    return merged.groupBy(*by).agg(*cells)
