"""Joins that Spark has no single operator for."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def version_join(
    facts: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    at: str,
    start: str = "valid_from",
    end: str = "valid_to",
    how: str = "left",
    first_year: int | None = None,
    last_year: int | None = None,
) -> DataFrame:
    """Attach to each fact the version that was valid at its time.

    Versions are half-open ``[start, end)`` with NULL for an open end and must not overlap. The join
    is an equi-join on the entity plus a range test: each version stands once, however many years
    it covers, both sides are shuffled by the entity and sorted, and Spark splits what is skewed.
    The versions are never broadcast: their number grows with the persons, and Spark takes the size
    of a column that is computed or compressed for far smaller than its rows are at the driver.

    For entities with very many versions and facts the join can be split by calendar year too: with
    ``first_year`` and ``last_year`` a version stands once in every year it covers. Years outside of
    them share the bucket at that edge, on both sides alike, so the two limits decide how finely
    the edges are split, never the result. That multiplies long and open versions by their years.
    """
    on = list(on)
    match = (F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) < F.col(end)))
    left, right = facts, versions.withColumnsRenamed({k: f"_v_{k}" for k in on})
    if first_year is not None and last_year is not None:

        def bucket(c: str) -> Column:
            return F.least(F.greatest(F.year(c), F.lit(first_year)), F.lit(last_year))

        until = F.when(F.col(end).isNull(), F.lit(last_year)).otherwise(bucket(end))
        years = F.sequence(bucket(start), F.greatest(bucket(start), until))
        left, right = left.withColumn("_year", bucket(at)), right.withColumn("_v_year", F.explode(years))
        match = (F.col("_year") == F.col("_v_year")) & match
    for k in on:
        match = match & (F.col(k) == F.col(f"_v_{k}"))
    return left.join(right.hint("merge"), match, how).drop("_year", "_v_year", *[f"_v_{k}" for k in on])


def version_join_by_key(
    facts: DataFrame,
    versions: DataFrame,
    on: Sequence[str],
    at: str,
    start: str = "valid_from",
    end: str = "valid_to",
    how: str = "left",
) -> DataFrame:
    """As :func:`version_join`, with the entity as the only join key.

    For tables that are stored in buckets by it: neither side moves. Each fact is compared with all
    versions of its entity, and an entity's facts are one task's.
    """
    on = list(on)
    right = versions.withColumnsRenamed({k: f"_v_{k}" for k in on})
    match = (F.col(at) >= F.col(start)) & (F.col(end).isNull() | (F.col(at) < F.col(end)))
    for k in on:
        match = match & (F.col(k) == F.col(f"_v_{k}"))
    return facts.join(right, match, how).drop(*[f"_v_{k}" for k in on])


def not_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among the keys of ``other``.

    NULL keys on the other side are ignored (SQL ``NOT IN`` would return nothing); rows with a
    NULL key of their own are dropped, as ``NOT IN`` does.
    """
    keys = list(keys)
    known = other.select(*keys).dropna()
    return df.dropna(subset=keys).join(known, keys, "left_anti")


def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with one coalesced key column per key."""
    return left.join(right, list(keys), "full")


def common_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of two aggregates whose key exists on both sides."""
    return left.join(right, list(keys), "inner")


def with_group_stats(
    df: DataFrame, by: Sequence[str], aggregates: Mapping[str, Column], few: bool = False
) -> DataFrame:
    """Each row beside the aggregates of its group.

    The group rows are aggregated first (map-side combined) and joined back, so that one large
    group never has to fit into one window task. ``few`` says that the groups stay few however many
    rows there are, such as states and parties: they are broadcast and the rows stay where they are.
    """
    by = list(by)
    stats = df.groupBy(*[F.col(k).alias(f"_s_{k}") for k in by]).agg(
        *[c.alias(name) for name, c in aggregates.items()]
    )
    stats = F.broadcast(stats) if few else stats
    same = F.lit(True)
    for k in by:
        same = same & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    return df.join(stats, same, "left").drop(*[f"_s_{k}" for k in by])


def with_benchmark(
    df: DataFrame, aggregates: Mapping[str, Column], source: DataFrame | None = None
) -> DataFrame:
    """Each row beside aggregates of the whole table, as one scalar subquery."""
    one = (df if source is None else source).agg(
        F.struct(*[c.alias(name) for name, c in aggregates.items()]).alias("_bench")
    )
    return df.select("*", one.scalar().alias("_bench")).select(
        *df.columns, *[F.col(f"_bench.{name}").alias(name) for name in aggregates]
    )
