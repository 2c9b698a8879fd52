"""Approximate nearest neighbours by inner product: pruned directed graphs in shards.

Equal vectors become one node. Nodes are dealt into shards of bounded size by hash. In a shard a
directed graph is built: greedy searches from the entry propose neighbours for a batch of nodes,
relaxed distance pruning keeps edges that lead in different directions, and edges back are added
and pruned likewise. Largest inner product becomes smallest distance by one more coordinate that
gives all vectors of a shard equal length. The graphs are stored as a table; each block of queries
is answered by beam search in every shard, and the best of all shards win.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored, table

TOP = 20
SHARD = 6000  # nodes per shard
DEGREE = 32  # edges that a node keeps
BUILD_BEAM = 64
SEARCH_BEAM = 96
RELAX = 1.2  # a neighbour is dropped if a kept one is this much nearer to it
QUERY_BLOCK = 4096  # queries that one task answers in one shard
_GRAPH = "dim int, shard int, node int, vec array<float>, hash bigint, edges array<int>"


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vec, dim``: rows whose vector is whole, finite and not zero."""
    x = F.col("vec")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return (
        vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<float>").alias("vec"))
        .where(F.col("vec_id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
        .where(good & F.exists(x, lambda v: v != 0))
        .withColumn("dim", F.size("vec"))
    )


class Graph:
    """The directed graph of one shard, over rows of ``points``."""

    def __init__(self, points: np.ndarray, edges: np.ndarray | None = None):
        self.x = points.astype(np.float32)
        self.edges = edges
        self.entry = int(((self.x - self.x.mean(0)) ** 2).sum(1).argmin()) if len(points) else 0

    def search(self, asked: np.ndarray, beam: int, score: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Beam search for all rows of ``asked`` at once; nodes (-1: none) and their costs."""
        n, rows = len(asked), np.arange(len(asked))
        ids = np.full((n, beam), -1, np.int64)
        cost = np.full((n, beam), np.inf, np.float32)
        done = np.ones((n, beam), bool)
        ids[:, 0] = self.entry
        cost[:, 0] = score(asked, np.full((n, 1), self.entry))[:, 0]
        done[:, 0] = False
        none = len(self.x)
        met = np.zeros((n, none + 1), bool)
        met[:, [self.entry, none]] = True
        live = rows
        while len(live):
            best = np.where(done[live], np.inf, cost[live]).argmin(1)
            more = ~done[live, best]
            live, best = live[more], best[more]
            if not len(live):
                break
            done[live, best] = True
            near = self.edges[ids[live, best]]
            near = np.where(near < 0, none, near)
            known = met[live[:, None], near]
            met[live[:, None], near] = True
            value = np.where(known, np.inf, score(asked[live], np.minimum(near, none - 1)))
            all_cost = np.concatenate([cost[live], value], 1)
            all_ids = np.concatenate([ids[live], np.where(known, -1, near)], 1)
            all_done = np.concatenate([done[live], known], 1)
            pick = np.argpartition(all_cost, beam - 1, axis=1)[:, :beam]
            cost[live] = np.take_along_axis(all_cost, pick, 1)
            ids[live] = np.take_along_axis(all_ids, pick, 1)
            done[live] = np.take_along_axis(all_done, pick, 1)
        order = np.argsort(cost, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(cost, order, 1)

    def _distance(self, asked: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        dots = np.einsum("nd,nkd->nk", asked, self.x[nodes])
        return np.maximum(self.norms[nodes] + (asked**2).sum(1)[:, None] - 2 * dots, 0)

    def _prune(self, node: int, found: np.ndarray, degree: int, relax: float) -> np.ndarray:
        """Nearest first; what a kept neighbour is much nearer to than the node is left out."""
        found = found[(found >= 0) & (found != node)]
        if not len(found):
            return found
        found = np.unique(found)
        x = self.x[found]
        to_node = ((x - self.x[node]) ** 2).sum(1)
        order = np.argsort(to_node, kind="stable")
        found, x, to_node = found[order], x[order], to_node[order]
        between = np.maximum(self.norms[found][:, None] + self.norms[found][None] - 2 * x @ x.T, 0)
        alive = np.ones(len(found), bool)
        kept = []
        for i in range(len(found)):
            if alive[i]:
                kept.append(i)
                if len(kept) == degree:
                    break
                alive &= relax * relax * between[i] > to_node
        return found[kept]

    def build(self, degree: int = DEGREE, beam: int = BUILD_BEAM, relax: float = RELAX, batch: int = 512) -> Graph:
        n = len(self.x)
        self.norms = (self.x**2).sum(1)
        random = np.random.default_rng(7)
        self.edges = np.full((n, degree), -1, np.int64)
        if n <= 1:
            return self
        width = min(8, n - 1)
        start = (np.arange(n)[:, None] + random.integers(1, n, (n, width))) % n
        self.edges[:, :width] = start
        order = random.permutation(n)
        for at in range(0, n, batch):
            some = order[at : at + batch]
            found, _ = self.search(self.x[some], min(beam, n), self._distance)
            back: dict[int, list[int]] = {}
            for node, near in zip(some.tolist(), found, strict=True):
                kept = self._prune(node, np.concatenate([near, self.edges[node]]), degree, relax)
                self.edges[node] = -1
                self.edges[node, : len(kept)] = kept
                for other in kept.tolist():
                    back.setdefault(other, []).append(node)
            for node, new in back.items():
                have = self.edges[node]
                have = have[have >= 0]
                both = np.unique(np.concatenate([have, np.array(new)]))
                if len(both) > degree:
                    both = self._prune(node, both, degree, relax)
                self.edges[node] = -1
                self.edges[node, : len(both)] = both
        return self


def _level(x: np.ndarray) -> np.ndarray:
    """One more coordinate, so that all rows have the length of the longest."""
    square = (x.astype(np.float64) ** 2).sum(1)
    return np.column_stack([x, np.sqrt(np.maximum(square.max() - square, 0))]).astype(np.float32)


def _count(shards: dict[int, int]) -> Column:
    count = F.lit(0)
    for dim, n in shards.items():
        count = F.when(F.col("dim") == dim, n).otherwise(count)
    return count


def build_index(nodes: DataFrame, shards: dict[int, int]) -> DataFrame:
    """Graph table of distinct vectors (dim, vec, hash); ``shards``: number of shards by length."""

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("hash", kind="stable", ignore_index=True)
        x = np.stack(part["vec"].to_list()).astype(np.float32)
        graph = Graph(_level(x)).build()
        part["node"] = np.arange(len(part))
        part["edges"] = [e[e >= 0].tolist() for e in graph.edges]
        return part[["dim", "shard", "node", "vec", "hash", "edges"]]

    dealt = nodes.withColumn("shard", F.pmod(F.col("hash"), _count(shards)).cast("int"))
    return dealt.groupBy("dim", "shard").applyInPandas(run, _GRAPH)


_HITS = "query_id bigint, dim int, hash bigint, vec array<float>, score double"


def search_index(
    graphs: DataFrame, queries: DataFrame, shards: dict[int, int], blocks: int, top: int, beam: int
) -> DataFrame:
    """The ``top`` best nodes of every shard for each query; queries come in blocks."""
    block = F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
    each = F.explode(F.sequence(F.lit(0), _count(shards) - 1))  # the stated query set, to every shard
    spread = queries.select(
        "query_id", F.col("dim").alias("q_dim"), F.col("vec").alias("q_vec"), block.alias("q_block"),
        each.alias("q_shard"),
    )
    number = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    copies = graphs.withColumn("block", number)

    def run(key: tuple, part: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        columns = [c.split()[0] for c in _HITS.split(", ")]
        if not len(part) or not len(asked):
            return pd.DataFrame(columns=columns)
        part = part.sort_values("node", kind="stable", ignore_index=True)
        x = np.stack(part["vec"].to_list()).astype(np.float32)
        edges = np.full((len(part), max(1, max(map(len, part["edges"])))), -1, np.int64)
        for i, e in enumerate(part["edges"]):
            edges[i, : len(e)] = e
        graph = Graph(_level(x), edges)
        exact = x.astype(np.float64)
        ids, hashes = asked["query_id"].to_numpy(), part["hash"].to_numpy()
        q = np.stack(asked["q_vec"].to_list()).astype(np.float32)
        out = []

        def minus_product(rows: np.ndarray, nodes: np.ndarray) -> np.ndarray:
            return -np.einsum("nd,nkd->nk", rows, x[nodes])

        for at in range(0, len(q), 256):
            some = q[at : at + 256]
            found, _ = graph.search(some, min(beam, len(x)), minus_product)
            for row, nodes in enumerate(found):
                nodes = nodes[nodes >= 0]
                value = exact[nodes] @ some[row].astype(np.float64)
                best = np.lexsort((hashes[nodes], -value))[:top]
                out.append(pd.DataFrame({"query_id": ids[at + row], "dim": key[0], "hash": hashes[nodes[best]], "vec": [x[n] for n in nodes[best]], "score": value[best]}))
        return pd.concat(out)[columns]

    grouped = copies.groupBy("dim", "shard", "block")
    return grouped.cogroup(spread.groupBy("q_dim", "q_shard", "q_block")).applyInPandas(run, _HITS)


def nearest(
    vectors: DataFrame,
    is_query: Column,
    top: int = TOP,
    shard: int = SHARD,
    beam: int = SEARCH_BEAM,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``top`` nearest found per query, its own row left out.

    Every usable row is indexed; vectors that are null, zero, or hold null or non-finite values
    take no part, nor do rows without an id. Only vectors of one length are compared. Of rows that
    repeat an id and vector one is used; one id with several vectors counts as several rows. Equal
    vectors are one node, of which the ``top + 1`` smallest ids can be among the answers. Ties go
    to the smaller vec_id. Extra columns are not read; an empty table gives an empty result.
    """
    rows = usable(vectors).withColumn("hash", F.xxhash64("vec"))
    smallest = Window.partitionBy("dim", "hash", "vec").orderBy("vec_id")
    # a limit on the row number per group is applied before the shuffle as well
    kept = (
        rows.select("vec_id", "dim", "hash", "vec").distinct()
        .withColumn("place", F.row_number().over(smallest)).where(F.col("place") <= top + 1)
    )
    members = stored(kept.select("vec_id", "dim", "hash", "vec", "place"), "vectors")
    nodes = members.where("place = 1").select("dim", "vec", "hash")
    sizes = {r["dim"]: r["count"] for r in nodes.groupBy("dim").count().collect()}  # one row per length
    shards = {d: -(-n // shard) for d, n in sizes.items()}
    graphs = stored(build_index(nodes, shards), "graphs")
    asked = rows.where(is_query).select(F.col("vec_id").alias("query_id"), "dim", "vec").distinct()
    number = asked.count()
    blocks = max(1, -(-number // query_block))
    hits = search_index(graphs, asked, shards, blocks, top + 1, beam)
    # of equal scores none is cut off: a node's ids decide, so ties at the end are all kept
    near = hits.withColumn("r", F.rank().over(Window.partitionBy("query_id").orderBy(F.desc("score")))).where(F.col("r") <= top + 1)
    found = near.join(members, ["dim", "hash", "vec"]).where("vec_id <> query_id")
    final = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= top)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)
