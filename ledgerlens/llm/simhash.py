"""Near duplicates by SimHash fingerprints and the generalised pigeonhole principle.

A fingerprint has 64 bits. If two differ in at most ``bits`` places and the places are dealt into
parts with thresholds whose sum is ``bits - parts + 1`` (a threshold of -1 leaves a part out), then
in some part they differ by at most its threshold. So it is enough to look up, per part, the
values within its threshold and to verify what is found there. Parts gather correlated bits;
thresholds, and the number of parts, are those with the least estimated work.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import settled, table, text_key, texts, whole
from ledgerlens.llm.graph import components, forest

WORDS = 4
BITS = 4
SEED = 42
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BLOCK = 1 << 15


def fingerprint(text: str, words: int = WORDS) -> int:
    """SimHash over word shingles, repeats included; no words give zero."""
    joined = b" ".join(text.encode("utf-8", "surrogatepass").translate(_LOWER).split())
    if not joined:
        return 0
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts, ends = np.append(0, gaps + 1), np.append(gaps, len(joined))
    if len(starts) > words:
        starts, ends = starts[: 1 - words], ends[words - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), _BLOCK):
        pairs = zip(starts[at : at + _BLOCK].tolist(), ends[at : at + _BLOCK].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], SEED) for i, j in pairs], np.uint64)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            0, dtype=np.uint16
        )
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, key, fp``: one row per row of ``docs``; a hash of the text, and the fingerprint as a
    signed long."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            made = np.array([fingerprint(t, words) for t in texts(part["text"])], np.uint64)
            yield pd.DataFrame({"doc_id": part["doc_id"], "key": part["key"], "fp": made.view(np.int64)})

    kept = docs.select(
        F.col("doc_id").cast("bigint"), text_key(whole()).alias("key"), whole().alias("text")
    )
    return kept.mapInPandas(run, "doc_id bigint, key bigint, fp bigint")


def _together(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and, for each two bits, how many have both set."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((64, 64))
        n = 0
        for part in parts:
            raw = part["fp"].to_numpy(np.int64).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(bits)
        i, j = np.triu_indices(64)
        yield pd.DataFrame(
            {"cell": np.append(i * 64 + j, -1), "n": np.append(total[i, j], n).astype(np.int64)}
        )

    cells = fps.mapInPandas(run, "cell int, n bigint").groupBy("cell").agg(F.sum("n").alias("n"))
    found = {r["cell"]: r["n"] for r in cells.collect()}  # 2,081 rows at most
    both = np.zeros((64, 64))
    for cell, n in found.items():
        if cell >= 0:
            both[cell // 64, cell % 64] = both[cell % 64, cell // 64] = n
    return int(found.get(-1, 0)), both


def bit_parts(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the 64 bits into parts of nearly equal size, correlated bits together."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    tie = np.abs((both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread))
    np.fill_diagonal(tie, 0)
    free = set(range(64))
    dealt = []
    for k in range(parts):
        room = -(-len(free) // (parts - k))
        inside = sorted(free)
        first = max(inside, key=lambda b: (tie[b, inside].sum(), -b))
        group = [first]
        free.discard(first)
        while len(group) < room:
            best = max(free, key=lambda b: (tie[b, group].sum(), -b))
            group.append(best)
            free.discard(best)
        dealt.append(sorted(group))
    return dealt


def _reach(width: int, radius: int) -> int:
    return sum(comb(width, r) for r in range(radius + 1))


def thresholds(
    n: int, widths: list[int], meet: list[float], bits: int
) -> tuple[float, list[int]]:
    """Least estimated work and the threshold of each part, by dynamic programming.

    ``meet`` is the chance that two fingerprints agree on a part. A threshold r costs its lookups
    and the candidates that these are expected to meet; -1 costs nothing.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for width, chance in zip(widths, meet, strict=True):
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for radius in range(-1, bits + 1):
                looked = _reach(width, radius) if radius >= 0 else 0
                work = cost + n * looked * (1 + n * min(chance, 1.0))
                total = used + radius + 1
                if total <= bits + 1 and work < step.get(total, (np.inf,))[0]:
                    step[total] = (work, [*chosen, radius])
        best = step
    return best[bits + 1]


def _value(fp: Column, group: list[int]) -> Column:
    out = F.lit(0).cast("bigint")
    for k, bit in enumerate(group):
        out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, bit).bitwiseAND(F.lit(1)), k))
    return out


def plan(fps: DataFrame, bits: int) -> list[tuple[list[int], int]]:
    """Parts (bit numbers) with thresholds, for distinct fingerprints ``fp``."""
    n, both = _together(fps)
    share = np.diag(both) / max(n, 1)
    options = []
    for parts in (2, 3, 4):
        groups = bit_parts(n, both, parts)
        # equal bits meet by chance; copies make a part no likelier than one more row in it
        meet = [float(np.prod([share[b] ** 2 + (1 - share[b]) ** 2 for b in g])) for g in groups]
        cost, chosen = thresholds(n, [len(g) for g in groups], meet, bits)
        options.append((cost, parts, list(zip(groups, chosen, strict=True))))
    return min(options, key=lambda x: x[:2])[2]


def links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """``a, b`` with a < b: distinct fingerprints ``fp`` that differ in 1 to ``bits`` bits.

    Links that close a cycle inside a task are left out (see graph.forest), so what is returned
    connects exactly what is linked, without the pairs of a dense group.
    """
    probes, kept = [], []
    for k, (group, radius) in enumerate(plan(fps, bits)):
        if radius < 0:
            continue
        value = _value(F.col("fp"), group)
        near = [
            sum(1 << i for i in flipped)
            for r in range(radius + 1)
            for flipped in combinations(range(len(group)), r)
        ]
        kept.append(F.struct(F.lit(k).alias("part"), value.alias("v")))
        probes.append((k, value, near))
    index = fps.select(F.col("fp").alias("b"), F.explode(F.array(*kept)).alias("at"))
    asked = None
    for k, value, near in probes:
        masks = F.explode(F.array(*[F.lit(m).cast("bigint") for m in near]))
        one = fps.select("fp", value.alias("v"), masks.alias("mask")).select(
            F.col("fp").alias("a"), F.lit(k).alias("part"), F.col("v").bitwiseXOR(F.col("mask")).alias("v")
        )
        asked = one if asked is None else asked.union(one)
    found = asked.join(index.select("b", "at.part", "at.v"), ["part", "v"]).where(
        (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)
    )
    return forest(found.select("a", "b"))


def _grouped(docs: DataFrame, words: int, bits: int) -> tuple[DataFrame, DataFrame]:
    """Rows ``doc_id, key, fp``, and ``fp, first, root``: the smallest (doc_id, key) of each fingerprint
    and the smallest fingerprint of its component."""
    made = settled(fingerprints(docs, words))
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "key"))
    firsts = settled(made.groupBy("fp").agg(F.min(named).alias("first")))
    roots = components(links(firsts.select("fp"), bits))
    return made, firsts.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` for every row of ``docs`` (doc_id, text).

    Texts are lower-cased (A-Z), split at ASCII white space and shingled; a null text counts as
    empty, and texts without words share fingerprint zero. Repeated rows give repeated results. A
    null id keeps its row; it never names a component, and a component of null ids only is null.
    An empty table gives an empty result. Other columns are not read.
    """
    made, named = _grouped(docs, words, bits)
    lowest = named.groupBy("root").agg(F.min("first.doc_id").alias("component_id"))
    by_fp = named.join(lowest, "root").select("fp", "component_id")
    return made.join(by_fp, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one with the smallest doc_id.

    Where rows share an id, the hash of their text tells them apart: only rows of one group replace
    each other. Rows repeated in id and text stay once; rows without an id all stay. An empty table
    stays empty. Texts are read as in ``near_duplicates``; the columns, whatever their names, are
    those of ``docs``.
    """
    _, named = _grouped(docs, words, bits)
    chosen = named.groupBy("root").agg(F.min("first").alias("first")).select("first.*").dropna()
    whole_row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(
        whole_row.alias("row"), F.col("doc_id").cast("bigint").alias("id"), text_key(whole()).alias("text_hash")
    )
    same = (F.col("id") == F.col("doc_id")) & (F.col("text_hash") == F.col("key"))
    once = rows.join(chosen, same, "left_semi").groupBy("id", "text_hash").agg(F.first("row").alias("row"))
    kept = once.select("row").union(rows.where("id is null").select("row"))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))
