"""Measures that merge: distinct counts, quantiles and heavy values without reading rows again.

Sketches are stored one per (period, group) and merged for any span or coarser group. A theta
sketch counts exactly up to its nominal entries and then within ``THETA_ERROR``, a KLL sketch gives
quantiles within ``KLL_ERROR`` of their rank; both are bounds that three standard errors keep.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THETA_LOG, THETA_ERROR = 12, 0.047  # 2**12 entries: three standard errors of 1 / sqrt(4096)
KLL_K, KLL_ERROR = 800, 0.0065


def distinct_sketches(df: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """One row per group with a sketch of the distinct values of each column; NULL does not count."""
    return df.groupBy(*by).agg(*[F.theta_sketch_agg(v, THETA_LOG).alias(v) for v in values])


def merged_distinct(sketches: DataFrame, by: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Sketches of coarser groups or longer spans, out of the finer ones alone."""
    return sketches.groupBy(*by).agg(*[F.theta_union_agg(v, THETA_LOG).alias(v) for v in values])


def distinct_count(sketch: str | Column) -> Column:
    return F.theta_sketch_estimate(sketch)


def common_count(one: str | Column, other: str | Column) -> Column:
    """How many values two sketches share."""
    return F.theta_sketch_estimate(F.theta_intersection(one, other))


def within(estimate: str | Column, exact: str | Column, whole: str | Column | None = None) -> Column:
    """Whether an estimate keeps the stated error; that of a common count is relative to the union."""
    of = F.col(exact) if whole is None else F.col(whole) if isinstance(whole, str) else whole
    return F.abs(F.col(estimate) - F.col(exact)) <= F.lit(THETA_ERROR) * of


def quantile_sketches(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """One row per group with a quantile sketch ``sketch`` of a number."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), KLL_K).alias("sketch"))


def merged_quantiles(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", KLL_K).alias("sketch"))


def quantile(sketch: str | Column, share: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(share))


def percent_rank(sketch: str | Column, value: str | Column) -> Column:
    """Share of the values up to one."""
    return F.kll_sketch_get_rank_double(sketch, value)


def heavy_values(
    df: DataFrame, value: str, n: int, out: str = "ocorrencias", width: int = 1 << 16, depth: int = 3
) -> DataFrame:
    """The ``n`` most frequent values with their exact counts, ties by value.

    No pass keeps a count per distinct value. The first counts rows in ``depth`` tables of ``width``
    cells by hash, so every value's count is at most that of each of its cells. The values in the n
    fullest cells of one table are then counted exactly: the n-th of these counts is a bound that
    at least n values reach. A value that belongs to the result reaches it too, so all its cells
    do; only values with such cells are counted in the last pass, and none can be missed.
    """
    rows = df.where(F.col(value).isNotNull()).select(value)

    def cell(k: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(k), value), F.lit(width))

    marked = rows.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), cell(k).alias("cell")) for k in range(depth)])).alias("c"))
    cells = marked.groupBy("c.k", "c.cell").agg(F.count(F.lit(1)).alias("n"))
    fullest = cells.where("k = 0").orderBy(F.desc("n"), "cell").limit(n).select("cell")
    some = rows.withColumn("cell", cell(0)).join(F.broadcast(fullest), "cell", "left_semi")
    known = some.groupBy(value).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n")).limit(n)
    # with fewer than n values there, no bound holds and every cell stays
    bound = known.agg(F.when(F.count(F.lit(1)) >= n, F.min("n")).otherwise(F.lit(0))).scalar()
    for k in range(depth):
        high = cells.where((F.col("k") == k) & (F.col("n") >= bound)).select(F.col("cell").alias(f"_{k}"))
        # at most ``width`` rows
        rows = rows.join(F.broadcast(high), cell(k) == F.col(f"_{k}"), "left_semi")
    counted = rows.groupBy(value).agg(F.count(F.lit(1)).alias(out))
    return counted.orderBy(F.desc(out), value).limit(n)
