"""Packing documents into sequences of equal length and balanced attention cost.

The cost of a piece of n tokens is ``linear * n + square * n**2`` (the feed-forward part and
attention inside the piece). Documents longer than a sequence first give full pieces; what is left
of each is dealt evenly over shards of bounded size, or shards are stretches of a given order. A shard opens as many sequences as its tokens
need and assigns pieces, longest first, to the cheapest sequence that still has room. Pieces that
fit nowhere are cut over the largest gaps, so a shard has at most one sequence's worth of padding.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import crc_of, settled, table, texts, whole

LENGTH = 4096
END = 2
SHARD_CHARS = 8 << 20  # characters of text per shard; its tokens are held by one task
LINEAR, SQUARE = 1.0, 1.0 / 2048


# Fixed value: how the tokenizer's file splits normalised text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class _Remembered(dict):
    """Values made on first use; once ``room`` are held, new ones are made but not held."""

    def __init__(self, make: Callable[[str], bytes], room: int):
        super().__init__()
        self.make, self.room = make, room

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if len(self) < self.room and len(key) <= 40:
            self[key] = value
        return value


class Ids:
    """Token ids of whole texts, two bytes each, for tokenizers of lower-cased words.

    The tokenizer never joins characters across a space or line feed, nor across the parts that
    ``SPLIT`` finds. So the ids of a text are those of its parts, one after the other, and the ids
    of frequent strings and parts are remembered. Strings that hold a special token are left to
    the tokenizer as a whole.
    """

    def __init__(self, path: str, strings: int = 300_000, parts: int = 500_000):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [regex.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(special)) if special else None
        self.split = regex.compile(SPLIT)
        self.model = self.tokenizer.model
        # a byte's stand-in: itself if it prints, else the next character from 256 on
        printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printed]
        self.byte = {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.strings = _Remembered(self._string, strings)
        self.parts = _Remembered(self._part, parts)

    def _part(self, part: str) -> bytes:
        if part.isascii():  # letters, digits and signs stand for themselves
            found = self.model.tokenize(part)
        else:
            found = self.model.tokenize(part.encode().decode("latin-1").translate(self.byte))
        return struct.pack(f"<{len(found)}H", *[t.id for t in found])

    def _string(self, string: str) -> bytes:
        lower = string.lower()
        if not string.isascii():
            # composed Latin letters only: these change case one by one and need no composing
            simple = max(string) < "\u0250" and "\u0130" not in string and string.isprintable()
            if not simple:
                return self._encoded(string)
        if lower.isalpha():
            return self.parts[lower]
        if lower[:-1].isalpha() and lower[-1] in ".,;:!?":
            return self.parts[lower[:-1]] + self.parts[lower[-1]]
        if not string.isprintable() or (self.special and self.special.search(string)):
            return self._encoded(string)
        return b"".join(map(self.parts.__getitem__, self.split.findall(lower)))

    def _encoded(self, string: str) -> bytes:
        made = self.tokenizer.encode(string, add_special_tokens=False).ids
        return np.array(made, "<u2").tobytes()

    def __call__(self, text: str) -> np.ndarray:
        words = text.replace("\n", " ").split(" ")
        return np.frombuffer(b"".join(map(self.strings.__getitem__, words)), "<u2")


_MADE: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    """One set of remembered ids per worker process, which serves many tasks."""
    if path not in _MADE:
        _MADE[path] = Ids(path)
    return _MADE[path]


_PIECES = "shard int, doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary, place bigint"


def stretches(docs: DataFrame, shard_chars: int) -> DataFrame:
    """``docs`` (read from files) with ``shard`` and ``place``: consecutive stretches of the files' order.

    The order is that of file names and, inside a file, of rows, as they were written. A stretch
    has ``shard_chars`` characters and at most one document more. Characters are summed per block
    of rows, blocks per file; only files and the blocks of one file are ever ordered in one task.
    """
    block = 1000
    placed = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        whole().alias("text"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    ).withColumn("block", F.floor(F.col("row") / block))
    size = F.length("text").cast("bigint") + 1
    slim = settled(placed.select("file", "block", "row", size.alias("size")))
    blocks = slim.groupBy("file", "block").agg(F.sum("size").alias("size"))
    files = blocks.groupBy("file").agg(F.sum("size").alias("size"))
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    ahead = files.select("file", F.coalesce(F.sum("size").over(before.orderBy("file")), F.lit(0)).alias("files"))
    within = before.partitionBy("file").orderBy("block")
    starts = blocks.select("file", "block", F.coalesce(F.sum("size").over(within), F.lit(0)).alias("blocks")).join(ahead, "file")
    inside = before.partitionBy("file", "block").orderBy("row")
    rows = slim.select("file", "block", "row", F.coalesce(F.sum("size").over(inside), F.lit(0)).alias("rows"))
    at = rows.join(starts, ["file", "block"]).select(
        "file", "row", (F.col("files") + F.col("blocks") + F.col("rows")).alias("place")
    )
    return placed.drop("block").join(at, ["file", "row"]).select(
        "doc_id", "text", "place", F.floor(F.col("place") / shard_chars).cast("int").alias("shard")
    )


def pieces(docs: DataFrame, tokenizer: str, length: int, shards: int) -> DataFrame:
    """Full pieces (without ids), and what is left of each document (with ids, two bytes each).

    Pieces are dealt round over the shards, so copies and long documents never meet in one. Where
    documents have a ``shard`` and a ``place``, as from :func:`stretches`, theirs stay.
    """
    ordered = "shard" in docs.columns

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_in = ids_of(tokenizer)
        turn = TaskContext.get().partitionId() * 7919
        for part in parts:
            docs, values = part["doc_id"].tolist(), texts(part["text"])
            own = part["shard"].tolist() if ordered else [None] * len(docs)
            places = part["place"].tolist() if ordered else [0] * len(docs)
            for at in range(0, len(values), 256):
                rows = []
                some = slice(at, at + 256)
                for doc, text, shard, place in zip(docs[some], values[some], own[some], places[some], strict=True):
                    ids = np.append(ids_in(text), np.uint16(END))
                    doc = None if pd.isna(doc) else int(doc)
                    for start in range(0, len(ids), length):
                        piece = ids[start : start + length]
                        body = piece.tobytes() if len(piece) < length else None
                        turn += 1
                        to = shard if ordered else turn % shards
                        rows.append((to, doc, start, len(piece), crc_of(piece), len(ids), body, place))
                made_rows = pd.DataFrame(rows, columns=[c.split()[0] for c in _PIECES.split(", ")])
                yield made_rows.astype({"doc_id": "Int64"})

    more = ["shard", "place"] if ordered else []
    rows = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text"), *more)
    return rows.mapInPandas(run, _PIECES)


def assign(sizes: np.ndarray, length: int, linear: float = LINEAR, square: float = SQUARE) -> list[tuple[int, int, int, int]]:
    """(piece, its first token, tokens, sequence) for sizes up to ``length``, each token once."""
    total = int(sizes.sum())
    n = -(-total // length)
    room, cost = np.full(n, length), np.zeros(n)
    out, uncut = [], []
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        fits = np.where(room >= size, cost, np.inf)
        to = int(fits.argmin()) if n else 0
        if not n or fits[to] == np.inf:
            uncut.append(piece)
            continue
        room[to] -= size
        cost[to] += linear * size + square * size * size
        out.append((piece, 0, size, to))
    gaps = np.argsort(-room, kind="stable").tolist()
    g = 0
    for piece in uncut:
        start, left = 0, int(sizes[piece])
        while left:
            to = gaps[g]
            part = min(left, int(room[to]))
            if part:
                out.append((piece, start, part, to))
                room[to] -= part
                start += part
                left -= part
            if left:
                g += 1
    return out


_OUT = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
    "sequence_id bigint, offset bigint"
)


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = LENGTH,
    shard_chars: int = SHARD_CHARS,
    in_order: bool = False,
) -> DataFrame:
    """One row per piece: where it starts in its document, its length and where it is placed.

    A null text counts as empty and gives the end id alone. Repeated rows and rows without an id
    are packed like any other; an empty table gives an empty result; other columns are not read.

    With ``in_order`` shards are consecutive stretches of the files that ``docs`` reads, sequence
    ids rise from stretch to stretch, and inside one by the mean place of a sequence's tokens. So
    every prefix of the sequences holds the documents of a prefix of the order, up to one stretch.
    """
    if in_order:
        docs, shards = stretches(docs, shard_chars), 0
    else:
        total = docs.agg(F.sum(F.length(whole()).cast("bigint") + 1)).first()[0] or 0
        shards = max(1, -(-total // shard_chars))

    def run(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[0])
        part = part.sort_values(["place", "doc_id", "start", "length", "ids_crc32"], kind="stable", ignore_index=True)
        full = part["length"] == length
        rest = part[~full].reset_index(drop=True)
        done = part[full].copy()
        done["sequence_id"] = (shard << 31) + np.arange(len(done))
        done["offset"] = 0
        first = (shard << 31) + len(done)
        rows, placed, used = [], [], {}
        docs, starts = rest["doc_id"].tolist(), rest["start"].tolist()
        crcs, tokens, bodies = rest["ids_crc32"].tolist(), rest["doc_tokens"].tolist(), rest["ids"].tolist()
        sizes, places = rest["length"].to_numpy(np.int64), rest["place"].tolist()
        for piece, at, size, to in assign(sizes, length):
            crc = crcs[piece]
            if size != sizes[piece]:
                crc = crc_of(np.frombuffer(bodies[piece], "<u2")[at : at + size])
            doc = None if pd.isna(docs[piece]) else int(docs[piece])
            offset = used.get(to, 0)
            rows.append((doc, starts[piece] + at, size, crc, tokens[piece], first + to, offset))
            placed.append(places[piece])
            used[to] = offset + size
        names = [c.split()[0] for c in _OUT.split(", ")]
        made = pd.DataFrame(rows, columns=names)
        out = pd.concat([done[names].astype({"doc_id": "Int64"}), made.astype({"doc_id": "Int64"})], ignore_index=True)
        if in_order:
            out["place"] = done["place"].tolist() + placed
            mean = (out["place"] * out["length"]).groupby(out["sequence_id"]).sum() / out.groupby("sequence_id")["length"].sum()
            order = mean.sort_values(kind="stable").index
            out["sequence_id"] = out["sequence_id"].map(pd.Series((shard << 31) + np.arange(len(order)), order))
            out = out[names]
        return out

    dealt = pieces(docs, tokenizer, length, int(shards))
    return dealt.groupBy("shard").applyInPandas(run, _OUT)


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), tokenizer_path())
