"""Merkle manifest of a table, with one multiproof per partition of leaves.

Rows are leaves; those of a language form a tree of eight children a node, and the roots of the
languages, in order, form another. A partition holds a block of consecutive leaves, so most of what
its proofs need it can derive. ``missing`` (the octopus) says which nodes it cannot: for a set of
leaves, the smallest set of node coordinates from which, with the leaves themselves, every proof
follows. Each partition asks for those coordinates once; from its leaves and the nodes that come
back it derives the interiors that its proofs share and writes every single proof.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import settled, stored, table
from ledgerlens.operators.ordered import ordered_prefix

BITS = 3  # eight children
STEP = 4  # levels that one task climbs: blocks of 4,096 leaves
_TOP = "/"  # the tree over the languages; those of languages are named "" (null) or ":" + language


def _hash(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def above(size: int) -> int:
    return (size + (1 << BITS) - 1) >> BITS


def height(size: int) -> int:
    """Levels above the leaves."""
    levels = 0
    while size > 1:
        size, levels = above(size), levels + 1
    return levels


def run_of(parent: int, size: int) -> range:
    """Numbers of a node's children in a level of ``size`` nodes."""
    return range(parent << BITS, min((parent + 1) << BITS, size))


def missing(held: Iterable[int], size: int) -> Iterator[tuple[int, int]]:
    """(level, number) of the nodes that proofs of the ``held`` leaves need and cannot derive."""
    known, level = sorted(set(held)), 0
    while size > 1:
        have = set(known)
        known = sorted({k >> BITS for k in known})
        for parent in known:
            yield from ((level, k) for k in run_of(parent, size) if k not in have)
        size, level = above(size), level + 1


class Path:
    """Nodes over some leaves of one tree, derived from the leaves and fetched nodes."""

    def __init__(self, leaves: dict[int, str], size: int, fetched: dict[tuple[int, int], str]):
        self.sizes, self.levels = [size], [dict(leaves)]
        own = sorted(leaves)
        for (level, k), value in fetched.items():
            if level == 0:
                self.levels[0][k] = value
        while self.sizes[-1] > 1:
            level, size = len(self.levels), self.sizes[-1]
            below = self.levels[-1]
            own = sorted({k >> BITS for k in own})
            made = {p: _hash(below[k] for k in run_of(p, size)) for p in own}
            made.update({k: v for (at, k), v in fetched.items() if at == level})
            self.levels.append(made)
            self.sizes.append(above(size))
        self.root = self.levels[-1][0]
        self._tails: dict[tuple[int, int], str] = {}

    def siblings(self, level: int, k: int) -> tuple[str, str]:
        """Digests left and right of a node in its run."""
        nodes, run = self.levels[level], run_of(k >> BITS, self.sizes[level])
        return "".join(nodes[j] for j in run if j < k), "".join(nodes[j] for j in run if j > k)

    def tail(self, level: int, k: int) -> str:
        """All siblings from a level on to the root; leaves share those of their ancestors."""
        if self.sizes[level] <= 1:
            return ""
        if (level, k) not in self._tails:
            self._tails[level, k] = "".join(self.siblings(level, k)) + self.tail(level + 1, k >> BITS)
        return self._tails[level, k]

    def fold(self, k: int, value: str) -> str:
        """The root that a leaf of that value and the siblings give."""
        for level, size in enumerate(self.sizes):
            if size > 1:
                left, right = self.siblings(level, k)
                value, k = _hash((left, value, right)), k >> BITS
        return value


def _field(c: str | Column) -> Column:
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _leaf(text: Column) -> Column:
    return F.sha2(F.concat(*[_field(c) for c in ("doc_id", "source", "lang", "n_chars")], _field(text)), 256)


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def leaves(docs: DataFrame) -> DataFrame:
    """``tree, doc_id, leaf, changed, row``: a leaf per row, and the leaf that tampering makes of it
    (null where the row is not tampered with)."""
    slim = docs.select(
        F.col("doc_id").cast("bigint"), "source", "lang", F.col("n_chars").cast("bigint"), "text"
    )
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return slim.select(
        F.coalesce(F.concat(F.lit(":"), "lang"), F.lit("")).alias("tree"),
        "doc_id",
        _leaf(F.col("text")).alias("leaf"),
        F.when(hit, _leaf(F.translate("text", _UPPER, _UPPER.lower()))).alias("changed"),
        F.monotonically_increasing_id().alias("row"),
    )


_NODES = "tree string, level int, idx bigint, size bigint, hash string"


def _climb(level: int, every: bool):
    """Nodes over one block of nodes of a level: all of them, or only the highest."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        tree, size = part["tree"].iloc[0], int(part["size"].iloc[0])
        now = dict(zip(part["idx"].tolist(), part["hash"], strict=True))
        here, at, out = size, 0, []
        for _ in range(level):
            here = above(here)
        while here > 1 and at < STEP:
            now = {p: _hash(now[k] for k in run_of(p, here)) for p in sorted({k >> BITS for k in now})}
            here, at = above(here), at + 1
            if every or at == STEP or here == 1:
                out += [(tree, level + at, k, size, v) for k, v in now.items()]
        return pd.DataFrame(out, columns=["tree", "level", "idx", "size", "hash"])

    return run


def grown(nodes: DataFrame, largest: int, every: bool) -> DataFrame:
    """The nodes above the leaves ``tree, level, idx, size, hash``, in blocks of ``STEP`` levels.

    Of the lowest block of levels only the highest are kept, unless ``every``: tasks derive the
    others from their leaves.
    """
    made = None
    for level in range(0, height(largest), STEP):
        block = F.shiftright("idx", BITS * STEP).alias("block")
        up = nodes.groupBy("tree", block).applyInPandas(_climb(level, every or level > 0), _NODES)
        up = settled(up)  # a 4,096th of the rows below
        made = up if made is None else made.union(up)
        nodes = up.where(F.col("level") == level + STEP)
    return nodes.limit(0).select(*[c.split()[0] for c in _NODES.split(", ")]) if made is None else made


_ASKED = "tree string, block bigint, of string, level int, idx bigint"


def _requests(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What each block of leaves has to fetch, of its own tree and of the one above."""
    for part in parts:
        out = []
        for tree, block, first, last, size, place, trees in part.itertuples(index=False):
            out += [(tree, block, tree, at, k) for at, k in missing(range(first, last + 1), size)]
            out += [(tree, block, _TOP, at, k) for at, k in missing([place], trees)]
        yield pd.DataFrame(out, columns=[c.split()[0] for c in _ASKED.split(", ")])


_OUT = (
    "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, "
    "folded_root string, verified boolean"
)


def _expand(part: pd.DataFrame, got: pd.DataFrame) -> pd.DataFrame:
    """Every proof of one block, from its leaves and what it fetched."""
    names = [c.split()[0] for c in _OUT.split(", ")]
    if not len(part):
        return pd.DataFrame(columns=names)
    tree, size = part["tree"].iloc[0], int(part["size"].iloc[0])
    place, trees = int(part["place"].iloc[0]), int(part["trees"].iloc[0])
    fetched: dict[str, dict[tuple[int, int], str]] = {tree: {}, _TOP: {}}
    for of, level, k, value in zip(got["of"], got["level"], got["idx"], got["hash"], strict=True):
        fetched[of][int(level), int(k)] = value
    inner = Path(dict(zip(part["idx"].tolist(), part["leaf"], strict=True)), size, fetched[tree])
    outer = Path({place: inner.root}, trees, fetched[_TOP])
    rest, out = outer.tail(0, place), []
    for doc, k, leaf, changed in zip(part["doc_id"], part["idx"].tolist(), part["leaf"], part["changed"], strict=True):
        folded = outer.fold(place, inner.fold(k, leaf if changed is None else changed))
        proof = _hash((inner.tail(0, k), rest))
        out.append((doc, leaf, inner.root, outer.root, proof, folded, folded == outer.root))
    return pd.DataFrame(out, columns=names).astype({"doc_id": "Int64"})


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, roots, digest of the proof, folded root and verdict of every row.

    Nulls are fields of their own (``-``); a null language has its own tree, the first. Leaves of a
    tree ascend by doc_id, null first, then by leaf; equal leaves, of repeated rows, stand side by
    side. A row without an id, and a null text, is not tampered with. An empty table gives an empty
    result; columns other than the five that make a leaf are not read, whatever their names.
    """
    made = stored(leaves(docs), "leaves")
    placed = ordered_prefix(
        made, [F.asc_nulls_first("doc_id"), F.col("leaf"), F.col("row")], ["tree"], rank="no", rows="size"
    ).select("tree", "doc_id", "leaf", "changed", (F.col("no") - 1).alias("idx"), "size")
    placed = stored(placed, "placed")
    largest = placed.agg(F.max("size")).first()[0]
    if not largest:
        return docs.sparkSession.createDataFrame([], _OUT)
    bottom = placed.select("tree", F.lit(0).alias("level"), "idx", "size", F.col("leaf").alias("hash"))
    nodes = grown(bottom, largest, False)
    alone = bottom.where("size = 1")
    done = nodes.unionByName(alone).where(F.col("level") == _height(F.col("size"), largest))
    ranked = settled(
        ordered_prefix(done.select("tree", "hash"), [F.col("tree")], rank="no", rows="trees").select(
            "tree", "hash", (F.col("no") - 1).alias("place"), "trees"
        )
    )
    roots = ranked.select(
        F.lit(_TOP).alias("tree"), F.lit(0).alias("level"), F.col("place").alias("idx"),
        F.col("trees").alias("size"), "hash",
    )
    trees = ranked.agg(F.max("trees")).first()[0]
    every = nodes.union(roots).union(grown(roots, trees, True)).select(
        F.col("tree").alias("of"), "level", "idx", "hash"
    )
    block = F.shiftright("idx", BITS * STEP)
    # one row per block of leaves
    blocks = placed.groupBy("tree", block.alias("block")).agg(
        F.min("idx").alias("first"), F.max("idx").alias("last"), F.first("size").alias("size")
    )
    asked = blocks.join(ranked.drop("hash"), "tree").select("tree", "block", "first", "last", "size", "place", "trees")
    got = asked.mapInPandas(_requests, _ASKED).join(every, ["of", "level", "idx"])
    # the language's place stands beside its block, not beside every leaf of a large language
    known = asked.select("tree", "block", "place", "trees")
    rows = placed.withColumn("block", block).join(known, ["tree", "block"])
    return rows.groupBy("tree", "block").cogroup(got.groupBy("tree", "block")).applyInPandas(_expand, _OUT)


def _height(size: Column, largest: int) -> Column:
    """Levels above the leaves of a tree of that size."""
    levels = F.lit(0)
    for k in range(height(largest)):
        levels = levels + (size > F.lit(1 << (BITS * k))).cast("int")
    return levels


def op11_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest(table(spark, folder, "documents"))


def _oracle(levels: int = 7, outer: int = 3) -> str:
    """SQL for trees of at most 8**levels leaves and 8**outer languages."""

    def field(c: str) -> str:
        return f"CASE WHEN {c} IS NULL THEN '-' ELSE CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR) END"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} || {field(text)})"

    lowered = f"translate(text, '{_UPPER}', '{_UPPER.lower()}')"
    step = "list_reduce(list_prepend(xor(c, b), [0, 1, 2, 3, 4, 5, 6, 7]), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    step = f"list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda s: ascii(s)::BIGINT)), lambda c, b: {step})"
    ctes = [
        f"base AS (SELECT doc_id, coalesce(':' || lang, '') AS tree, {leaf('text')} AS leaf, CASE WHEN xor({step}, 4294967295) % 3 = 0 THEN {leaf(lowered)} END AS changed FROM documents)",
        "own AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i0 FROM base)",
        "a0 AS (SELECT tree, i0 AS i, count(*) OVER (PARTITION BY tree) AS n, leaf AS h FROM own)",
    ]

    def climb(p: str, count: int) -> None:
        for k in range(count):
            ctes.append(
                f"{p}{k + 1} AS (SELECT tree, i // 8 AS i, CASE WHEN max(n) > 1 THEN (max(n) + 7) // 8 ELSE 1 END AS n, "
                f"CASE WHEN max(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE min(h) END AS h FROM {p}{k} GROUP BY tree, i // 8)"
            )
            ctes.append(
                f"{p}s{k} AS (SELECT x.tree, x.i, x.n, coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i < x.i), '') AS l, "
                f"coalesce(string_agg(y.h, '' ORDER BY y.i) FILTER (y.i > x.i), '') AS r "
                f"FROM {p}{k} x JOIN {p}{k} y ON x.tree = y.tree AND x.i // 8 = y.i // 8 GROUP BY x.tree, x.i, x.n)"
            )

    climb("a", levels)
    ctes.append(f"b0 AS (SELECT '/' AS tree, row_number() OVER (ORDER BY tree) - 1 AS i, count(*) OVER () AS n, h, tree AS lang FROM a{levels})")
    climb("b", outer)
    ctes.append(
        f"f0 AS (SELECT o.doc_id, o.leaf, o.tree, o.i0 AS i, t.h AS subroot, (SELECT h FROM b{outer}) AS root, '' AS p, "
        f"coalesce(o.changed, o.leaf) AS f, b0.i AS place FROM own o JOIN a{levels} t ON o.tree = t.tree JOIN b0 ON b0.lang = o.tree)"
    )
    last = 0
    for p, count in (("a", levels), ("b", outer)):
        for k in range(count):
            on = "s.tree = f.tree AND s.i = f.i" if p == "a" else "s.i = f.i"
            nxt = "f.i // 8" if (p, k) != ("a", levels - 1) else "f.place"
            ctes.append(
                f"f{last + 1} AS (SELECT f.doc_id, f.leaf, f.tree, {nxt} AS i, f.subroot, f.root, "
                f"CASE WHEN s.n > 1 THEN f.p || s.l || s.r ELSE f.p END AS p, "
                f"CASE WHEN s.n > 1 THEN sha256(s.l || f.f || s.r) ELSE f.f END AS f, f.place FROM f{last} f JOIN {p}s{k} s ON {on})"
            )
            last += 1
    return (
        "WITH " + ",\n".join(ctes)
        + f"\nSELECT doc_id, leaf, subroot, root, sha256(p) AS proof_sha256, f AS folded_root, f = root AS verified FROM f{last}"
    )


ORACLE = _oracle()
