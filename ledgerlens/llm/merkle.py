"""Document fingerprints: Merkle trees over sections, paragraphs and pieces.

A text is cut into sections (at empty lines), paragraphs (at line ends) and, so that one long line
still has branches, pieces of some 60 bytes (16 at the start of the text) whose borders depend on
the bytes around them alone.
Every byte belongs to exactly one piece. A piece's digest is a hash of its bytes, an inner node's
the hash of its children's digests, up to the root. The fingerprint is written as the root and the
digests of the pieces, ``root:piece.piece;piece/piece`` with ``;`` between paragraphs and ``/``
between sections: equal roots mean equal texts, and unequal branches tell where texts differ.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import frames, table, text_key, texts, whole

CUT_BITS = 6  # a border after one byte in 2**CUT_BITS on average
FINE_BITS, FINE_BYTES = 4, 256  # finer at the start, so that short texts have branches too
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 20


def _borders(data: np.ndarray) -> np.ndarray:
    """Positions after which a piece ends: at line ends, and where 8 bytes hash to a border."""
    found = []
    for at in range(0, len(data), _BLOCK):
        part = data[max(0, at - 7) : at + _BLOCK]
        lead = min(at, 7)
        word = np.zeros(len(part), np.uint64)
        for k in range(min(8, len(part))):  # byte i with the seven before it; fewer at the start of the text
            word[k:] |= part[: len(part) - k].astype(np.uint64) << np.uint64(8 * k)
        word *= _MIX
        cut = (word >> np.uint64(64 - CUT_BITS)) == 0
        if at == 0:
            cut[:FINE_BYTES] = (word[:FINE_BYTES] >> np.uint64(64 - FINE_BITS)) == 0
        cut |= part == 10
        found.append(np.flatnonzero(cut[lead:]) + at)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def _node(children: list[bytes]) -> bytes:
    return hashlib.blake2b(b"".join(children), digest_size=16).digest()


def fingerprint(text: str) -> str:
    """The Merkle tree of a text as a string; an empty text has a root and no pieces."""
    data = text.encode("utf-8", "surrogatepass")
    ends = (_borders(np.frombuffer(data, np.uint8)) + 1).tolist()
    if data and (not ends or ends[-1] != len(data)):
        ends.append(len(data))
    digest = xxhash.xxh3_128_digest
    sections: list[list[list[bytes]]] = [[[]]]
    start, blank = 0, True
    for end in ends:
        piece = data[start:end]
        sections[-1][-1].append(digest(piece))
        if piece.endswith(b"\n"):
            if blank and piece == b"\n":  # an empty line ends its section
                sections.append([[]])
            else:
                sections[-1].append([])
            blank = True
        else:
            blank = False
        start = end
    sections = [[p for p in s if p] for s in sections]
    sections = [s for s in sections if s]
    root = _node([_node([_node(p) for p in s]) for s in sections])
    leaves = "/".join(";".join(".".join(x[:4].hex() for x in p) for p in s) for s in sections)
    return f"{root.hex()}:{leaves}"


def _leaves(mark: str) -> list[str]:
    body = mark.partition(":")[2]
    return body.replace("/", ".").replace(";", ".").split(".") if body else []


def likeness(a: str, b: str) -> float:
    """Share of equal pieces, copies counted: 1 for equal roots, else at most 1 - 1 / pieces."""
    if a.partition(":")[0] == b.partition(":")[0]:
        return 1.0
    one, two = _leaves(a), _leaves(b)
    common = sum((Counter(one) & Counter(two)).values())
    longest = max(len(one) + len(two), 1)
    return min(2.0 * common / longest, 1 - 1 / (longest + 1))


def differing(a: str, b: str) -> list[tuple[int, int]]:
    """(section, paragraph) of ``a`` whose branch ``b`` does not hold: where edits are."""
    if a.partition(":")[0] == b.partition(":")[0]:
        return []
    there = Counter(p for s in b.partition(":")[2].split("/") for p in s.split(";"))
    out = []
    for i, section in enumerate(a.partition(":")[2].split("/")):
        for j, paragraph in enumerate(section.split(";")):
            if there[paragraph] > 0:
                there[paragraph] -= 1
            else:
                out.append((i, j))
    return out


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """``doc_id, fingerprint`` of each row; a null text counts as empty."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame(
                {"doc_id": part["doc_id"], "fingerprint": [fingerprint(t) for t in texts(part["text"])]}
            )

    kept = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text"))
    return kept.mapInPandas(run, "doc_id bigint, fingerprint string")


_OUT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def with_edits(docs: DataFrame, block_chars: int = 16 << 20, max_blocks: int = 4096) -> DataFrame:
    """Fingerprint of each text, of its edited text, and how near both and the next text are.

    The edited text has its last half (rounded down, code points) replaced by the first as many
    code points of the next document in descending doc_id; the last is followed by the first. Rows
    are dealt into blocks of neighbouring ids, each with a copy of the row that follows its last
    one, so the texts are shuffled once (compressed) and each block is read as a sorted stream.
    Rows of one id are ordered by a hash of their text, rows without an id come last; a null text
    counts as empty; a single row is followed by itself; an empty table gives an empty result.
    Other columns are not read. ``max_blocks`` bounds the borders held by the driver; beyond it
    blocks grow, and are still read as streams.
    """
    rows = docs.select(
        F.col("doc_id").cast("bigint"), whole().alias("text"), text_key(whole()).alias("tie")
    )
    size = rows.agg(F.sum(F.length("text").cast("bigint")), F.count(F.lit(1))).first()
    if not size[1]:
        return docs.sparkSession.createDataFrame([], _OUT)
    blocks = int(min(max_blocks, max(1, -(-(size[0] or 0) // block_chars))))
    marks = [i / blocks for i in range(1, blocks)] or [0.5]
    found = rows.agg(F.percentile_approx("doc_id", marks, 100 * blocks)).first()[0] or []
    # block 0 has the largest ids; a row without an id sorts below all
    borders = sorted({int(x) for x in found}) if blocks > 1 else []
    lowest = len(borders)
    block = F.lit(lowest)
    if borders:
        block = _block_of(borders)
    slim = rows.select("doc_id", "tie", block.alias("block"))
    tops = {
        r["block"]: (r["top"]["doc_id"], r["top"]["tie"])
        for r in slim.groupBy("block")
        .agg(F.max_by(F.struct("doc_id", "tie"), F.struct(F.coalesce("doc_id", F.lit(-(2**63))), F.col("doc_id").isNotNull(), -F.col("tie").cast("decimal(20,0)"))).alias("top"))
        .collect()  # one row per block
    }
    order = sorted(tops)
    carries = [
        F.struct(F.lit(to).alias("block"), F.lit(tops[of][0]).cast("bigint").alias("id"), F.lit(tops[of][1]).alias("t"))
        for to, of in zip(order, order[1:] + order[:1], strict=True)
    ]
    wanted = docs.sparkSession.range(1).select(F.explode(F.array(*carries)).alias("c")).select("c.*")
    own = rows.select(block.alias("block"), F.lit(0).alias("carry"), "doc_id", "tie", "text")
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("tie") == F.col("t"))
    copies = rows.join(F.broadcast(wanted), same).select(  # one row per block
        "block", F.lit(1).alias("carry"), "doc_id", "tie", "text"
    )

    def squeeze(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for part in parts:
            part["body"] = [pack(t.encode("utf-8", "surrogatepass")) for t in part.pop("text")]
            yield part

    packed = own.union(copies).mapInPandas(
        squeeze, "block int, carry int, doc_id bigint, tie bigint, body binary"
    )
    dealt = packed.repartition(len(order), "block").sortWithinPartitions(
        "block", "carry", F.desc_nulls_last("doc_id"), "tie"
    )

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        unpack = zstandard.ZstdDecompressor().decompress

        def pairs() -> Iterator[tuple]:
            held = None
            for part in parts:
                for block, carry, doc, body in zip(
                    part["block"], part["carry"], part["doc_id"], part["body"], strict=True
                ):
                    text = unpack(body).decode("utf-8", "surrogatepass")
                    now = (block, None if pd.isna(doc) else int(doc), text, fingerprint(text))
                    if held is not None and held[0] == block:
                        yield row(held, now)
                    held = None if carry else now

        def row(one: tuple, after: tuple) -> tuple:
            _, doc, text, mark = one
            half = len(text) // 2
            edited = text[: len(text) - half] + after[2][:half]
            new = fingerprint(edited)
            digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
            return doc, len(text), digest, mark, new, likeness(mark, new), likeness(mark, after[3])

        for frame in frames([c.split()[0] for c in _OUT.split(", ")], pairs(), 500):
            yield frame.astype({"doc_id": "Int64"})

    return dealt.mapInPandas(run, _OUT)


def _block_of(borders: list[int]) -> Column:
    """Number of borders above an id, by halving, so that large ids come first."""

    def tree(low: int, high: int) -> Column:
        if low == high:
            return F.lit(len(borders) - low)
        middle = (low + high) // 2
        return F.when(F.col("doc_id") >= borders[middle], tree(middle + 1, high)).otherwise(
            tree(low, middle)
        )

    return tree(0, len(borders))


def op10_merkle(spark: SparkSession, folder: str) -> DataFrame:
    return with_edits(table(spark, folder, "documents"))
