"""Removing repeated passages: longest previous factors across all documents.

A byte is removed if it lies in a string of ``LENGTH`` bytes that also starts earlier, so only one
question is asked of each position: is its longest previous factor (LPF) at least that long? In
suffix order the earlier occurrence that shares most is the nearest position before or after with
a smaller text position (previous and next smaller value). For the question at hand suffix order
matters only up to ``LENGTH`` bytes: suffixes are ordered by the hash of that prefix and then by
text position. There the next smaller value never shares the prefix, and the previous one is the
neighbour in front, or nothing.

Ordering every suffix of the corpus would shuffle it many times over. Suffixes come in runs
instead: positions whose window of ``LENGTH`` bytes has the same smallest k-gram (its anchor). Equal
windows have equal anchors at equal distance, so runs with equal anchors are all that can match.

1. A run whose whole stretch of text occurs earlier is repeated as a whole. Runs are ordered by
   (anchor, stretch, position); all but the first of equal ones are done.
2. First runs that share their anchor with other stretches may match in part. Only their windows
   are ordered one by one.

Each task first does this over its own rows, so what a third of all documents share is sent on
once per batch of rows, not once per document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored, table, text_key, whole

LENGTH = 100
GRAM = 32  # the anchor's length; windows hold LENGTH - GRAM + 1 of them
BUCKET_BYTES = 8 << 20  # text per bucket of anchors
_BLOCK = 1 << 19  # window starts hashed at a time
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_FIELDS = (("anchor", "<u8"), ("stretch", "<u8"), ("doc", "<i8"), ("key", "<i8"), ("start", "<i8"), ("n", "<i4"))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.ones(n, np.uint64), np.ones(n, np.uint64)
    up[1:], down[1:] = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        x = x ^ (x >> np.uint64(32))
        return x * np.uint64(0xD6E8FEB86659FD93)


class Runs:
    """Finds the runs of a piece of text; holds tables that all pieces share."""

    def __init__(self, length: int = LENGTH, gram: int = GRAM):
        self.length, self.gram, self.width = length, gram, length - gram + 1
        self.up, self.down = _powers(_BLOCK + 2 * length + 2)

    def sums(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((sums[end] - sums[start]) * self.down[start])

    def windows(self, data: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Hash of the window at each start."""
        return self.hashes(self.sums(data), start, start + self.length)

    def __call__(self, data: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, ...]:
        """Anchor hash, stretch hash, first start and number of starts of every run.

        ``allowed`` marks the starts whose window lies within one document.
        """
        n, w = len(data) - self.length + 1, self.width
        if n <= 0:
            none = np.zeros(0, np.uint64)
            return none, none, np.zeros(0, np.int64), np.zeros(0, np.int64)
        sums = self.sums(data)
        grams = len(data) - self.gram + 1
        key = _mixed((sums[self.gram :] - sums[:grams]) * self.down[:grams])
        low = np.uint64((1 << 20) - 1)
        key = (key & ~low) | np.arange(grams, dtype=np.uint64)  # ties: the leftmost
        padded = np.full(-(-grams // w) * w + w, _MASK, np.uint64)
        padded[:grams] = key
        blocks = padded.reshape(-1, w)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(behind[:n], ahead[w - 1 : w - 1 + n])
        at = (least & low).astype(np.int64)
        starts = np.flatnonzero(allowed[:n])
        if not len(starts):
            return least[:0], least[:0], starts, starts
        place = at[starts]
        new = np.ones(len(starts), bool)
        new[1:] = (place[1:] != place[:-1]) | (np.diff(starts) != 1)
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(starts)))
        begin, anchor = starts[first], place[first]
        anchors = self.hashes(sums, anchor, anchor + self.gram)
        stretch = self.hashes(sums, begin, begin + count - 1 + self.length)
        # the anchor's place in the stretch and the stretch's length belong to its identity
        stretch = _mixed(stretch ^ ((anchor - begin).astype(np.uint64) << np.uint64(32)) ^ count.astype(np.uint64))
        return anchors, stretch, begin, count


def _ordered(t: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Rows in order of (anchor, stretch, position); whether the neighbour in front is an equal
    stretch (the previous smaller value reaches the whole length), and an equal anchor."""
    order = np.lexsort((t["start"], t["key"], t["doc"], t["stretch"], t["anchor"]))
    t = {k: v[order] for k, v in t.items()}
    twin = np.zeros(len(order), bool)  # one place seen twice, in rows that repeat
    twin[1:] = np.logical_and.reduce([t[k][1:] == t[k][:-1] for k in ("anchor", "stretch", "doc", "key", "start")])
    t = {k: v[~twin] for k, v in t.items()}
    same = np.zeros(len(t["doc"]), bool)
    same[1:] = t["anchor"][1:] == t["anchor"][:-1]
    equal = same.copy()
    equal[1:] &= t["stretch"][1:] == t["stretch"][:-1]
    return t, equal, same


def _spans(t: dict[str, np.ndarray], length: int) -> dict[str, np.ndarray]:
    """Byte ranges covered by repeated windows, ranges of one document joined where they touch."""
    order = np.lexsort((t["start"], t["key"], t["doc"]))
    doc, key = t["doc"][order], t["key"][order]
    start = t["start"][order]
    end = start + t["n"][order] - 1 + length
    if not len(doc):
        return {"doc": doc, "key": key, "start": start, "end": end}
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (key[1:] != key[:-1])
    group = np.cumsum(fresh) - 1
    reach = end.astype(np.int64) + group * (1 << 40)
    top = np.maximum.accumulate(reach) - group * (1 << 40)
    gap = fresh.copy()
    gap[1:] |= start[1:] > top[:-1]
    first = np.flatnonzero(gap)
    last = np.append(first[1:], len(doc)) - 1
    return {"doc": doc[first], "key": key[first], "start": start[first], "end": top[last]}


def _packed(t: dict[str, np.ndarray], pick: np.ndarray) -> bytes:
    """Rows as one compressed block, column by column; ids as differences."""
    out = []
    for name, kind in _FIELDS:
        column = t[name][pick].astype(kind)
        if name in ("doc", "key") and len(column):
            column = np.diff(column, prepend=column.dtype.type(0))
        out.append(column.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def _unpacked(blocks: list[bytes]) -> dict[str, np.ndarray]:
    found: dict[str, list[np.ndarray]] = {name: [np.zeros(0, kind)] for name, kind in _FIELDS}
    width = sum(np.dtype(kind).itemsize for _, kind in _FIELDS)
    for block in blocks:
        raw = zstandard.ZstdDecompressor().decompress(block)
        n, at = len(raw) // width, 0
        for name, kind in _FIELDS:
            size = n * np.dtype(kind).itemsize
            column = np.frombuffer(raw[at : at + size], kind)
            found[name].append(np.cumsum(column) if name in ("doc", "key") else column)
            at += size
    return {name: np.concatenate(parts) for name, parts in found.items()}


_SENT = "bucket int, block binary, doc array<bigint>, key array<bigint>, start array<bigint>, end array<bigint>"
_FOUND = "doc bigint, key bigint, start bigint, end bigint, partial boolean"


def _send(t: dict[str, np.ndarray], by: str, buckets: int, length: int) -> pd.DataFrame:
    """First rows packed by bucket, and the spans that are repeats within these rows."""
    t, equal, _ = _ordered(t)
    spans = _spans({k: v[equal] for k, v in t.items()}, length)
    left = {k: v[~equal] for k, v in t.items()}
    bucket = (left[by] >> np.uint64(20)) % np.uint64(buckets)
    order = np.lexsort((left["start"], left["key"], left["doc"], bucket))
    marks = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))
    rows = [
        (b, _packed(left, order[i:j]), None, None, None, None)
        for b, (i, j) in enumerate(zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True))
        if j > i
    ]
    for at in range(0, len(spans["doc"]), 5000):
        part = [spans[k][at : at + 5000].tolist() for k in ("doc", "key", "start", "end")]
        rows.append(((at // 5000 * 31 + int(part[2][0])) % buckets, None, *part))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in _SENT.split(", ")])


def _settle(length: int, deeper: bool):
    """Reducer of one bucket: repeated spans and, if ``deeper``, runs that may match in part."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        t, equal, same = _ordered(_unpacked([b for b in part["block"] if b is not None]))
        spans = _spans({k: v[equal] for k, v in t.items()}, length)
        out = [pd.DataFrame(spans | {"partial": False})]
        for doc, key, start, end in zip(part["doc"], part["key"], part["start"], part["end"], strict=True):
            if doc is not None:
                out.append(pd.DataFrame({"doc": doc, "key": key, "start": start, "end": end, "partial": False}))
        if deeper:
            group = np.cumsum(~same)
            kinds = np.bincount(group, ~equal) if len(group) else np.zeros(1)
            some = ~equal & (kinds[group] > 1)
            one = {k: v[some] for k, v in t.items()}
            out.append(
                pd.DataFrame({"doc": one["doc"], "key": one["key"], "start": one["start"], "end": one["start"] + one["n"], "partial": True})
            )
        made = pd.concat(out, ignore_index=True)
        return made.astype({"doc": "int64", "key": "int64", "start": "int64", "end": "int64", "partial": "bool"})

    return run


def _compressed(docs: DataFrame) -> DataFrame:
    """``doc, key, body``: id (null as the smallest long), hash of the text, compressed text."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for part in parts:
            part["body"] = [pack(t.encode("utf-8", "surrogatepass")) for t in part.pop("text")]
            yield part

    return docs.mapInPandas(run, "doc_id bigint, doc bigint, key bigint, body binary")


def _rows(docs: DataFrame) -> DataFrame:
    doc = F.col("doc_id").cast("bigint")
    return docs.select(
        doc.alias("doc_id"),
        F.coalesce(doc, F.lit(-(2**63))).alias("doc"),
        text_key(whole()).alias("key"),
        whole().alias("text"),
    )


def repeated_spans(docs: DataFrame, length: int = LENGTH, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``doc, key, start, end``: byte ranges to remove; ranges of one document may overlap."""
    rows = _rows(docs)
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    buckets = int(max(1, -(-size // bucket_bytes)))

    def anchors(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs = Runs(length)

        def table_of(held: list[tuple[int, int, bytes]]) -> dict[str, np.ndarray]:
            found: list[tuple] = []
            stream = np.frombuffer(b"".join(x[2] for x in held), np.uint8)
            ends = np.cumsum([len(x[2]) for x in held])
            begins = ends - [len(x[2]) for x in held]
            for at in range(0, max(len(stream) - length + 1, 0), _BLOCK):
                data = stream[at : at + _BLOCK + length - 1]
                n = len(data) - length + 1
                allowed = np.ones(n, bool)
                i = int(np.searchsorted(ends, at, side="right"))
                j = int(np.searchsorted(begins, at + n + length))
                for end in ends[i:j].tolist():
                    allowed[max(0, end - length + 1 - at) : max(0, end - at)] = False
                a, s, begin, n_starts = runs(data, allowed)
                owner = np.searchsorted(ends, begin + at, side="right")
                found.append((a, s, owner, begin + at - begins[owner], n_starts))
            if not found:
                found = [(np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3]
            a, s, owner, start, n_starts = (np.concatenate(x) for x in zip(*found, strict=True))
            docs_of = np.array([x[0] for x in held], np.int64)
            keys_of = np.array([x[1] for x in held], np.int64)
            return {"anchor": a, "stretch": s, "doc": docs_of[owner], "key": keys_of[owner], "start": start, "n": n_starts}

        held: list[tuple[int, int, bytes]] = []
        size = 0
        for part in parts:
            for doc, key, text in zip(part["doc"].tolist(), part["key"].tolist(), part["text"], strict=True):
                body = text.encode("utf-8", "surrogatepass")
                if len(body) < length:
                    continue
                held.append((doc, key, body))
                size += len(body)
                if size >= bucket_bytes:
                    yield _send(table_of(held), "anchor", buckets, length)
                    held, size = [], 0
        if held:
            yield _send(table_of(held), "anchor", buckets, length)

    sent = rows.select("doc", "key", "text").mapInPandas(anchors, _SENT)
    first = stored(sent.groupBy("bucket").applyInPandas(_settle(length, True), _FOUND), "runs")

    # a document's open runs number at most its bytes over the average run
    runs = first.where("partial").groupBy("doc", "key").agg(
        F.collect_list(F.struct("start", "end")).alias("runs")
    )
    texts = _compressed(rows).select("doc", "key", "body")

    def windows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        finder, unpack = Runs(length), zstandard.ZstdDecompressor().decompress
        held: list[tuple] = []
        n = 0

        def table_of() -> dict[str, np.ndarray]:
            h, doc, key, start = (np.concatenate(x) for x in zip(*held, strict=True))
            return {"anchor": h, "stretch": h, "doc": doc, "key": key, "start": start, "n": np.ones(len(h), np.int32)}

        for part in parts:
            for doc, key, body, spans in zip(part["doc"], part["key"], part["body"], part["runs"], strict=True):
                data = np.frombuffer(unpack(body), np.uint8)
                pairs = {(x["start"], x["end"]) for x in spans}
                start = np.unique(np.concatenate([np.arange(a, b) for a, b in pairs]))
                for at in range(0, len(data), _BLOCK):
                    some = start[(start >= at) & (start < at + _BLOCK)]
                    if len(some):
                        h = finder.windows(data[at : at + _BLOCK + length], some - at)
                        held.append((h, np.full(len(some), doc), np.full(len(some), key), some))
                        n += len(some)
                if n >= 300_000:
                    yield _send(table_of(), "anchor", buckets, length)
                    held, n = [], 0
        if held:
            yield _send(table_of(), "anchor", buckets, length)

    open_texts = texts.join(runs, ["doc", "key"])
    again = open_texts.mapInPandas(windows, _SENT).groupBy("bucket")
    second = again.applyInPandas(_settle(length, False), _FOUND)
    return first.where("not partial").union(second).select("doc", "key", "start", "end")


_OUT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def joined_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching ranges as maximal ones, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _with_spans(docs: DataFrame, length: int) -> DataFrame:
    spans = repeated_spans(docs, length).groupBy(F.col("doc").alias("__doc"), F.col("key").alias("__key")).agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )
    match = (F.col("doc") == F.col("__doc")) & (F.col("key") == F.col("__key"))
    return _compressed(_rows(docs)).join(spans, match, "left").select("doc_id", "body", "spans")


def _cut(body: bytes, spans: object) -> tuple[bytes, bytes, list[tuple[int, int]]]:
    data = zstandard.ZstdDecompressor().decompress(body)
    full = joined_spans([(x["start"], x["end"]) for x in spans]) if spans is not None else []
    kept, at = [], 0
    for start, end in full:
        kept.append(data[at:start])
        at = end
    return data, b"".join([*kept, data[at:]]), full


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, text``: the text that is left; a character cut in part is replaced by U+FFFD."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            left = [_cut(b, s)[1].decode("utf-8", "replace") for b, s in zip(part["body"], part["spans"], strict=True)]
            yield pd.DataFrame({"doc_id": part["doc_id"].astype("Int64"), "text": left})

    return _with_spans(docs, length).mapInPandas(run, "doc_id bigint, text string")


def removed(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per row of ``docs``: bytes, bytes removed, maximal removed runs, SHA-256 of the rest.

    Texts are UTF-8 bytes, null as empty; matches never cross documents. Documents are ordered by
    doc_id (null first), those of one id by a hash of the text; rows equal in both are one
    document, and each of them gets its result. Texts shorter than ``length`` lose nothing. An
    empty table gives an empty result; other columns are not read.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for doc, body, spans in zip(part["doc_id"], part["body"], part["spans"], strict=True):
                data, left, full = _cut(body, spans)
                doc = None if pd.isna(doc) else int(doc)
                rows.append((doc, len(data), len(data) - len(left), len(full), hashlib.sha256(left).hexdigest()))
            made = pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")])
            yield made.astype({"doc_id": "Int64"})

    return _with_spans(docs, length).mapInPandas(run, _OUT)


def op5_repeats(spark: SparkSession, folder: str) -> DataFrame:
    return removed(table(spark, folder, "documents"))
