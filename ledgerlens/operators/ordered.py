"""Ranks, running totals and medians without a single-task window.

A global ``ORDER BY`` window, or one per year, pulls whole years into one task. Here the rows are
range-partitioned by the full order, every partition numbers its own rows, and one small row per
(group, partition) carries the offsets. A group of any size is spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.columns import as_col
from ledgerlens.operators.lineage import materialize

_LOW_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def ordered_prefix(
    df: DataFrame,
    order_by: Sequence[Column],
    partition_by: Sequence[str] = (),
    sums: Mapping[str, str] | None = None,
    rank: str = "rank_no",
    rows: str | None = None,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add the 1-based rank within each group, and running sums in that order.

    ``order_by`` must be a total order within the group (end it with a key). ``sums`` maps new
    column to summed column; ``rows`` names the group size; ``totals`` maps new column to a
    column summed over the whole group.
    """
    group = list(partition_by)
    sums, totals = dict(sums or {}), dict(totals or {})
    order = [F.col(g) for g in group] + list(order_by)
    placed = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_pos", F.monotonically_increasing_id()),
        "ordered",
    ).withColumn("_chunk", F.shiftright("_pos", _LOW_BITS))

    chunk = placed.groupBy(*group, "_chunk").agg(
        F.min("_pos").alias("_start"),
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(c).alias(f"_sum_{name}") for name, c in sums.items()],
        *[F.sum(c).alias(f"_tot_{name}") for name, c in totals.items()],
    )
    before = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy(*group)
    offsets = chunk.select(
        *[F.col(g).alias(f"_g_{g}") for g in group],
        F.col("_chunk").alias("_g_chunk"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_start") + 1).alias("_shift"),
        F.sum("_n").over(whole).alias("_rows"),
        *[
            F.sum(f"_sum_{name}").over(before).alias(f"_before_{name}")
            for name in sums
        ],
        *[F.sum(f"_tot_{name}").over(whole).alias(f"_total_{name}") for name in totals],
    )
    same = F.col("_chunk") == F.col("_g_chunk")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))

    if sums:
        inside = Window.partitionBy(*group, "_chunk").orderBy("_pos").rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        placed = placed.withColumns(
            {f"_in_{name}": F.sum(c).over(inside) for name, c in sums.items()}
        )
    joined = placed.join(offsets, same)
    out = [F.col(c) for c in df.columns]
    out.append((F.col("_pos") + F.col("_shift")).alias(rank))
    if rows:
        out.append(F.col("_rows").alias(rows))
    for name in sums:
        earlier = F.coalesce(F.col(f"_before_{name}"), F.lit(0))
        out.append((F.coalesce(F.col(f"_in_{name}"), F.lit(0)) + earlier).alias(name))
    out += [F.col(f"_total_{name}").alias(name) for name in totals]
    return joined.select(*out)


def middle_mean(rank: str, rows: str, value: str | Column) -> Column:
    """Median as an aggregate over rows that :func:`ordered_prefix` ranked by the value."""
    low, high = F.floor((F.col(rows) + 1) / 2), F.ceil((F.col(rows) + 1) / 2)
    middle = F.col(rank).between(low, high)
    picked = F.when(middle, as_col(value))
    return F.try_divide(F.sum(picked).cast("double"), F.count(picked).cast("double"))


def group_median(
    df: DataFrame, partition_by: Sequence[str], value: str, name: str = "median"
) -> DataFrame:
    """Exact median per group. Equal values are merged before they are ordered."""
    group = list(partition_by)
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*group, value)
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    run = ordered_prefix(
        counted, [F.col(value)], group, sums={"_upto": "_times"}, totals={"_all": "_times"}
    )
    low, high = F.floor((F.col("_all") + 1) / 2), F.ceil((F.col("_all") + 1) / 2)
    first = F.col("_upto") - F.col("_times") + 1
    covers_low = (first <= low) & (low <= F.col("_upto"))
    covers_high = (first <= high) & (high <= F.col("_upto"))
    return run.groupBy(*group).agg(
        (
            (
                F.max(F.when(covers_low, F.col(value))).cast("double")
                + F.max(F.when(covers_high, F.col(value))).cast("double")
            )
            / 2
        ).alias(name)
    )


def row_ranks(df: DataFrame, specs: Mapping[str, Sequence[Column]]) -> DataFrame:
    """Global row numbers, one per named total order, spread over all tasks at any size."""
    for name, order in specs.items():
        df = ordered_prefix(df, order, rank=name)
    return df


def percent_ranks(df: DataFrame, specs: Mapping[str, str]) -> DataFrame:
    """Global percent rank of each named column: (rank - 1) / (rows - 1), ties share a rank.

    Equal values are merged before they are ordered; no size decides the plan.
    """
    for name, c in specs.items():
        counted = df.groupBy(F.col(c).alias("_v")).agg(F.count(F.lit(1)).alias("_times"))
        run = ordered_prefix(
            counted, [F.col("_v")], sums={"_upto": "_times"}, totals={"_all": "_times"}
        )
        others = F.greatest(F.col("_all") - 1, F.lit(1)).cast("double")
        below = (F.col("_upto") - F.col("_times")) / others
        df = df.join(
            run.select("_v", below.alias(name)), F.col(c).eqNullSafe(F.col("_v"))
        ).drop("_v")
    return df


def dimension_row_ranks(df: DataFrame, specs: Mapping[str, Sequence[Column]]) -> DataFrame:
    """Row numbers over a table with one row per member of a small dimension, such as parties.

    One sorted task: only for tables whose size the dimension bounds.
    """
    return df.withColumns(
        {
            name: F.row_number().over(Window.orderBy(*order)).cast("bigint")
            for name, order in specs.items()
        }
    )


def dimension_percent_ranks(df: DataFrame, specs: Mapping[str, str]) -> DataFrame:
    """Percent ranks over a table with one row per member of a small dimension."""
    return df.withColumns(
        {name: F.percent_rank().over(Window.orderBy(F.col(c))) for name, c in specs.items()}
    )
