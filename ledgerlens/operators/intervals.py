"""Joins on time ranges by dyadic intervals.

Time is counted in ticks (days or seconds). A range of ticks is cut into nodes of a binary tree
over all ticks, at most two of each level, and a point asks for the one node of each level that
holds it. So a range and a point meet in exactly one node or in none, whether the range lasts a
second or a century: the join is an equi-join on (level, node) and needs neither a calendar key nor
limits on the years. Nodes much smaller than a range are not cut: its two ends are rounded outwards to
a node of at most a quarter of its length, and the times themselves decide on what meets there.
Points ask only for levels that occur. On the highest of these there are few nodes, so their rows
are salted where there are many points: every salt repeats the ranges.

No side is broadcast by Spark's estimate of its size, which knows nothing of the nodes of a range
and takes columns read from compressed files for smaller than they are at the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SALTED_LEVELS, _SALTED_LEVELS_PER_KEY = 4, 2
_SALTS, _SALTS_PER_KEY = 32, 4  # at most; keys in ``on`` spread the nodes already
_POINTS_PER_SALT = 128  # a node with no more points needs no salts
_ROUNDED_LEVELS = 2  # a range is cut from this many levels below its length on


def tick(df: DataFrame, c: str, unit: str) -> Column:
    """Days or seconds since 1970, rising with time whatever the session's zone."""
    if unit == "day":
        return F.unix_date(F.to_date(c)).cast("bigint")
    if isinstance(df.schema[c].dataType, T.TimestampType):
        return F.floor(F.unix_micros(c) / F.lit(1_000_000)).cast("bigint")
    return F.expr(f"timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', CAST(`{c}` AS TIMESTAMP_NTZ))")


def nodes(first: Column, last: Column) -> Column:
    """Array of (level, node) that makes up the ticks from first to last, both included."""
    one = F.lit(1).cast("bigint")

    def at(level: Column) -> Column:
        size = F.call_function("shiftleft", one, level)
        low = F.call_function("shiftright", first + size - 1, level)  # first whole node
        high = F.call_function("shiftright", last + 1, level)  # after the last whole node
        both = low < high
        odd = lambda x: x.bitwiseAND(one) == 1
        node = lambda x: F.struct(level.cast("int").alias("level"), x.alias("node"))
        return F.array(F.when(both & odd(low), node(low)), F.when(both & odd(high), node(high - 1)))

    levels = F.sequence(F.lit(0), F.floor(F.log2((last - first + 1).cast("double"))).cast("int") + 1)
    return F.array_compact(F.flatten(F.transform(levels, at)))


def rounded(first: Column, last: Column) -> tuple[Column, Column]:
    """The range with both ends moved outwards to nodes of a quarter to an eighth of its length."""
    level = F.greatest(F.floor(F.log2((last - first + 1).cast("double"))).cast("int") - _ROUNDED_LEVELS, F.lit(0))
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
    return first - F.pmod(first, size), last + size - 1 - F.pmod(last, size)


def matches(
    points: DataFrame,
    ranges: DataFrame,
    at: str,
    start: str,
    end: str,
    on: Sequence[str] = (),
    unit: str = "day",
    closed: bool = True,
) -> DataFrame:
    """Distinct (``on``, ``at``) of the points beside every range that covers them.

    Ranges are ``[start, end]``, or ``[start, end)`` where not ``closed``; a NULL end is open. Rows
    without a start or a point's time match nothing.
    """
    on, most = list(on), _SALTS_PER_KEY if on else _SALTS
    salted_levels = _SALTED_LEVELS_PER_KEY if on else _SALTED_LEVELS
    values = points.select(*on, at).dropna().distinct().withColumn("_tick", tick(points, at, unit))
    needed = F.ceil(F.count(F.lit(1)) / F.lit(_POINTS_PER_SALT)).cast("int")
    span = values.agg(
        F.struct(
            F.min("_tick").alias("lo"), F.max("_tick").alias("hi"),
            F.greatest(F.lit(1), F.least(F.lit(most), needed)).alias("salts"),
        )
    ).scalar()
    salts = span["salts"]
    kept = ranges.select(
        *[F.col(k).alias(f"_r_{k}") for k in on],
        *[c for c in ranges.columns if c not in on],
        F.greatest(tick(ranges, start, unit), span["lo"]).alias("_lo"),
        F.least(F.coalesce(tick(ranges, end, unit), span["hi"]), span["hi"]).alias("_hi"),
    )
    kept = kept.where(F.col(start).isNotNull() & (F.col("_lo") <= F.col("_hi")))
    first, last = rounded(F.col("_lo"), F.col("_hi"))
    kept = kept.withColumns({"_lo": first, "_hi": last})
    cut = kept.withColumn("_n", F.explode(nodes(F.col("_lo"), F.col("_hi")))).drop("_lo", "_hi")
    levels = cut.agg(F.collect_set("_n.level")).scalar()
    salted = lambda level: level > F.array_max(levels) - salted_levels
    every = F.sequence(F.lit(0), salts - 1)
    cut = cut.withColumn("_salt", F.explode(F.when(salted(F.col("_n.level")), every).otherwise(F.array(F.lit(0)))))
    one = F.pmod(F.xxhash64(*on, at), salts).cast("int")
    asked = values.select("*", F.explode(levels).alias("_level"))
    asked = asked.select(
        *on, at, "_level", F.call_function("shiftright", F.col("_tick"), F.col("_level")).alias("_node"),
        F.when(salted(F.col("_level")), one).otherwise(F.lit(0)).alias("_own"),
    )
    until = F.col(at) <= F.col(end) if closed else F.col(at) < F.col(end)
    same = (
        (F.col("_level") == F.col("_n.level")) & (F.col("_node") == F.col("_n.node"))
        & (F.col("_own") == F.col("_salt")) & (F.col(at) >= F.col(start)) & (F.col(end).isNull() | until)
    )
    for k in on:
        same = same & (F.col(k) == F.col(f"_r_{k}"))
    # the points of a node and salt are few: the join holds them and streams the ranges
    found = cut.hint("merge").join(asked, same)
    return found.select(*on, at, *[c for c in ranges.columns if c not in on])


def range_join(
    points: DataFrame,
    ranges: DataFrame,
    at: str,
    start: str,
    end: str,
    how: str = "left",
    on: Sequence[str] = (),
    unit: str = "day",
    closed: bool = True,
) -> DataFrame:
    """Points beside the ranges that cover them; see :func:`matches` for what covers what.

    Equal times are matched once and joined back, so a ``left`` join keeps uncovered points. A
    ``right`` join has the rows of an ``inner`` one; it holds equal points and streams their ranges,
    where ``inner`` holds the ranges and streams the points.
    """
    found = matches(points, ranges, at, start, end, on, unit, closed)
    keys = [*on, at]
    found = found.withColumnsRenamed({k: f"_m_{k}" for k in keys})
    same = F.lit(True)
    for k in keys:
        same = same & (F.col(k) == F.col(f"_m_{k}"))
    found = found if how == "left" else found.hint("merge")  # else the points might be broadcast
    return points.join(found, same, how).drop(*[f"_m_{k}" for k in keys])


def overlaps(
    left: DataFrame,
    right: DataFrame,
    left_range: tuple[str, str],
    right_range: tuple[str, str],
    on: Sequence[str] = (),
    unit: str = "day",
    closed: bool = True,
) -> DataFrame:
    """All columns of both sides for each pair of ranges that share a moment, each pair once.

    Two ranges overlap if the right one begins within the left one, or the left one begins later
    than the right one and within it: two joins of starts with ranges. Column names must differ
    between the sides, but for ``on``.
    """
    (ls, le), (rs, re) = left_range, right_range

    def alive(df: DataFrame, start: str, end: str) -> DataFrame:
        full = F.col(end) >= F.col(start) if closed else F.col(end) > F.col(start)
        return df.where(F.col(start).isNotNull() & (F.col(end).isNull() | full))

    left, right = alive(left, ls, le), alive(right, rs, re)
    names = [*left.columns, *[c for c in right.columns if c not in on]]
    inside = range_join(right, left, rs, ls, le, "right", on, unit, closed).select(*names)
    after = range_join(left, right, ls, rs, re, "inner", on, unit, closed).where(F.col(ls) > F.col(rs))
    return inside.unionByName(after.select(*names))
