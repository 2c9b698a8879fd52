"""Connected components by alternating stars."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import settled


def forest(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of long nodes with those left out that close a cycle inside one task.

    Connectivity stays the same, while a dense group shrinks to about its number of nodes
    before anything is shuffled.
    """

    def thin(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = x = root.get(up, up)
            return x

        for part in parts:
            kept = []
            for a, b in zip(part["a"].tolist(), part["b"].tolist(), strict=True):
                ra, rb = find(a), find(b)
                if ra != rb:
                    root[max(ra, rb)] = min(ra, rb)
                    kept.append((a, b))
            yield pd.DataFrame(kept, columns=["a", "b"], dtype="int64")
            if len(root) > 1_000_000:  # forgetting only lets more edges through
                root.clear()

    return edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).mapInPandas(
        thin, "a bigint, b bigint"
    )


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """``node, root``: every node of an edge with the smallest node of its component.

    Large-star and small-star steps alternate until the edges no longer change; the number of
    rounds grows with the logarithm of the longest path. No node's neighbours are gathered: each
    step takes a minimum per node (combined before the shuffle) and joins it back.
    """
    stars = settled(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    seen = None
    for _ in range(rounds):
        both = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        ).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(least, "a")
            .select(F.explode(F.array(F.struct(F.col("b").alias("a"), "m"), F.struct("a", "m"))).alias("e"))
            .select(F.col("e.a").alias("a"), F.col("e.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        stars = settled(small)
        now = stars.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen or now[0] == 0:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle; raise rounds")
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
