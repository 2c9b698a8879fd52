"""Removing repeated passages of words with compressed FM-indexes in shards.

A word is removed if a window of ``LENGTH`` words over it also starts earlier. Which windows do is
read off matching statistics: for each position of a streamed text, the length of the longest
stretch from there on that also starts earlier in the index. Backward search over a wavelet matrix
finds them from right to left; a match that cannot grow is shortened to its parent interval.

Streaming every document through the index of every shard would grow with the square of the
corpus. So shards are cut by content, and each holds whatever could match anything in it:

1. A window's anchor is the smallest hash of its grams of ``GRAM`` words. Equal windows have equal
   anchors. Only anchors that occur twice matter; they are found by counting hashes.
2. Consecutive windows of one anchor form a stretch of at most 32 words. Equal stretches of one
   anchor stand for the first of them: the others start later as a whole.
3. Different stretches of one anchor may share windows, and one whose anchor stands in it twice may
   repeat itself. All of these of one anchor go to one shard, are indexed there and streamed
   through the index.
4. An anchor with more than ``WIDE`` different stretches, such as a frequent phrase in ever new
   surroundings, does not fit there. Its windows become stretches of their own, dealt by their
   content, for which step 2 answers.

Texts are packed once into blocks of a stored table that every later pass reads.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import frames, stored, table, text_key, whole

LENGTH = 20
GRAM = 8
WIDTH = LENGTH - GRAM + 1  # grams of a window, and most windows of a stretch
WIDE = 2000
SHARD_WORDS = 200_000
BLOCK_BYTES = 1 << 20
BUCKET_BYTES = 32 << 20  # of text, for the counting of anchors
_KNOWN_WORDS = 300_000

# --- hashes of words, grams and windows -----------------------------------------------------


class _Words(dict):
    """Hash of a word, remembered for the words of this task; forgotten when they are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KNOWN_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = (a ^ np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    x += b
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _joined(a: np.ndarray, b: np.ndarray, apart: int) -> np.ndarray:
    """Hash of what starts at i and what starts ``apart`` later, for each i that has both."""
    n = max(0, min(len(a), len(b) - apart))
    return _mix(a[:n], b[apart : apart + n])


def grams(words: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of the grams of 4, 8, 16 and 20 words that start at each word."""
    two = _joined(words, words, 1)
    four = _joined(two, two, 2)
    eight = _joined(four, four, 4)
    sixteen = _joined(eight, eight, 8)
    return {4: four, 8: eight, 16: sixteen, 20: _joined(sixteen, four, 16)}


def _least(a: np.ndarray) -> np.ndarray:
    """Smallest of ``WIDTH`` values from each place on."""
    one = np.minimum(a[:-1], a[1:])
    two = np.minimum(one[:-2], one[2:])
    four = np.minimum(two[:-4], two[4:])  # of 8
    return np.minimum(four[: len(a) - WIDTH + 1], four[WIDTH - 8 : len(a) - 7])


class Runs:
    """Runs of the windows of several documents whose words stand in one array."""

    def __init__(self, words: np.ndarray, counts: np.ndarray):
        ends = np.cumsum(counts)
        self.begins = ends - counts
        n = len(words) - LENGTH + 1
        self.hashes = grams(words) if n > 0 else {}
        if n <= 0:
            self.anchor = np.zeros(0, np.uint64)
            self.start = self.n = self.owner = np.zeros(0, np.int64)
            return
        allowed = np.ones(n + LENGTH, bool)
        for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
            allowed[max(end - count, end - LENGTH + 1, 0) : end] = False
        start = np.flatnonzero(allowed[:n])
        least = _least(self.hashes[GRAM])[start] if len(start) else np.zeros(0, np.uint64)
        new = np.ones(len(start), bool)
        new[1:] = (least[1:] != least[:-1]) | (np.diff(start) != 1)
        at = np.arange(len(start))
        new |= (at - np.maximum.accumulate(np.where(new, at, 0))) % WIDTH == 0
        first = np.flatnonzero(new)
        self.anchor, self.start = least[first], start[first]
        self.n = np.diff(np.append(first, len(start)))
        self.owner = np.searchsorted(ends, self.start, side="right")

    def restless(self) -> np.ndarray:
        """Anchors that stand twice within a window's reach: a run of theirs may repeat itself."""
        if not self.hashes:
            return self.anchor
        gram = self.hashes[GRAM]
        again = np.zeros(len(gram), bool)
        for k in range(1, WIDTH):
            again[k:] |= gram[k:] == gram[:-k]
        return np.unique(gram[again])

    def stretch(self, which: np.ndarray) -> np.ndarray:
        """Hash of all words of some runs."""
        sixteen, start, size = self.hashes[16], self.start[which], self.n[which] + LENGTH - 1
        whole_run = _mix(sixteen[start], sixteen[start + size - 16])
        return _mix(whole_run, size.astype(np.uint64))


# --- blocks ---------------------------------------------------------------------------------

_BLOCKS = "block bigint, docs array<bigint>, keys array<bigint>, nulls array<boolean>, sizes array<int>, body binary"


def blocks_of(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Texts packed into rows of about ``block_bytes``, numbered in the scan that stores them.

    ``docs`` holds ids (null as the smallest long), ``keys`` hashes of the texts.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pack = zstandard.ZstdCompressor(level=1).compress

        def rows() -> Iterator[tuple]:
            first, held, size = None, [], 0
            for part in parts:
                for row in part.itertuples(index=False, name=None):
                    body = row[4].encode("utf-8", "surrogatepass")
                    if held and size + len(body) > block_bytes:
                        yield made(first, held)
                        first, held, size = None, [], 0
                    first = row[0] if first is None else first
                    held.append((row[1], row[2], row[3], body))
                    size += len(body)
            if held:
                yield made(first, held)

        def made(first: int, held: list[tuple]) -> tuple:
            ids, keys, nulls, bodies = zip(*held, strict=True)
            return first, list(ids), list(keys), list(nulls), [len(b) for b in bodies], pack(b"".join(bodies))

        yield from frames([c.split()[0] for c in _BLOCKS.split(", ")], rows(), 16)

    doc = F.col("doc_id").cast("bigint")
    slim = docs.select(
        F.monotonically_increasing_id().alias("row"), F.coalesce(doc, F.lit(-(2**63))).alias("doc"),
        text_key(whole()).alias("key"), doc.isNull().alias("none"), whole().alias("text"),
    )
    return stored(slim.mapInPandas(run, _BLOCKS), "blocks")


def _bodies(sizes: np.ndarray, body: bytes) -> Iterator[bytes]:
    data = memoryview(zstandard.ZstdDecompressor().decompress(body))
    at = 0
    for size in sizes:
        yield bytes(data[at : at + size])
        at += size


def _hashed(texts: Iterator[bytes], known: _Words) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts in one array, and the number of words of each."""
    found = [np.zeros(0, np.uint64)]
    for text in texts:
        words = text.split()  # exactly \x20 and \x09-\x0D part words
        found.append(np.fromiter(map(known.__getitem__, words), np.uint64, len(words)))
    return np.concatenate(found), np.array([len(x) for x in found[1:]], np.int64)


# --- anchors that occur twice ---------------------------------------------------------------

_SENT = "bucket int, block bigint, anchors binary"
_LOW = np.uint64(16)  # 48 bits count anchors: a chance equality only costs a second look


def _packed(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.diff(values, prepend=np.uint64(0)).tobytes())


def _unpacked(block: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.uint64))


def _anchors(buckets: int):
    """Per block and bucket the anchors in order; those with several runs stand twice."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = _Words()

        def rows() -> Iterator[tuple]:
            for part in parts:
                for block, sizes, body in zip(part["block"], part["sizes"], part["body"], strict=True):
                    runs = Runs(*_hashed(_bodies(sizes, body), known))
                    value, times = np.unique(runs.anchor >> _LOW, return_counts=True)
                    times[np.isin(value, runs.restless() >> _LOW)] = 2
                    value = np.repeat(value, np.minimum(times, 2))
                    bucket = (value % np.uint64(buckets)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")
                    marks = np.searchsorted(bucket[order], np.arange(buckets + 1))
                    for b in np.flatnonzero(np.diff(marks)).tolist():
                        yield b, block, _packed(value[order[marks[b] : marks[b + 1]]])

        yield from frames([c.split()[0] for c in _SENT.split(", ")], rows())

    return run


def _repeated(part: pd.DataFrame) -> pd.DataFrame:
    """For each block the anchors of one bucket that occur twice or more, anywhere."""
    found = [_unpacked(x) for x in part["anchors"]]
    value = np.concatenate(found)
    owner = np.repeat(np.arange(len(found)), [len(x) for x in found])
    order = np.argsort(value, kind="stable")
    value, owner = value[order], owner[order]
    same = value[1:] == value[:-1]
    twice = np.append(same, False) | np.append(False, same)
    value, owner = value[twice], owner[twice]
    order = np.argsort(owner, kind="stable")
    value, owner = value[order], owner[order]
    marks = np.searchsorted(owner, np.arange(len(found) + 1))
    hit = np.flatnonzero(np.diff(marks)).tolist()
    return pd.DataFrame(
        {"block": part["block"].iloc[hit].to_numpy(), "anchors": [_packed(np.unique(value[marks[b] : marks[b + 1]])) for b in hit]}
    )


# --- runs that may match --------------------------------------------------------------------

_RUNS = "first boolean, restless boolean, anchor bigint, stretch bigint, doc bigint, key bigint, start bigint, n bigint, block bigint, at int"


def _candidates(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs with an anchor that occurs twice: the first of equal ones in a block, and (``first`` is
    false) the windows of all others, joined where they touch."""
    known = _Words()
    for part in parts:
        for block, docs, keys, sizes, body, hits in zip(
            *[part[c] for c in ("block", "docs", "keys", "sizes", "body", "hits")], strict=True
        ):
            docs, keys = np.asarray(docs, np.int64), np.asarray(keys, np.int64)
            seen: set[tuple[int, int]] = set()  # rows equal in id and text are one document
            texts = []
            for pair, text in zip(zip(docs.tolist(), keys.tolist(), strict=True), _bodies(sizes, body), strict=True):
                texts.append(b"" if pair in seen else text)
                seen.add(pair)
            runs = Runs(*_hashed(iter(texts), known))
            wanted = np.unique(np.concatenate([_unpacked(x) for x in hits]))
            which = np.flatnonzero(np.isin(runs.anchor >> _LOW, wanted))
            if not len(which):
                continue
            owner = runs.owner[which]
            t = {
                "restless": np.isin(runs.anchor[which], runs.restless()),
                "anchor": runs.anchor[which].view(np.int64), "stretch": runs.stretch(which).view(np.int64),
                "doc": docs[owner], "key": keys[owner], "start": runs.start[which] - runs.begins[owner],
                "n": runs.n[which], "block": np.full(len(which), block), "at": owner.astype(np.int32),
            }
            order = np.lexsort((t["start"], t["key"], t["doc"], t["stretch"], t["anchor"]))
            t = {k: v[order] for k, v in t.items()}
            copy = np.zeros(len(order), bool)
            copy[1:] = (t["anchor"][1:] == t["anchor"][:-1]) & (t["stretch"][1:] == t["stretch"][:-1])
            yield pd.DataFrame({"first": True} | {k: v[~copy] for k, v in t.items()})
            if copy.any():
                yield pd.DataFrame({"first": False} | _touching({k: v[copy] for k, v in t.items()}))


def _touching(t: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Windows of one document in a row as one run."""
    order = np.lexsort((t["start"], t["at"]))
    t = {k: v[order] for k, v in t.items()}
    new = np.ones(len(order), bool)
    new[1:] = (t["at"][1:] != t["at"][:-1]) | (t["start"][1:] != t["start"][:-1] + t["n"][:-1])
    first = np.flatnonzero(new)
    return {k: v[first] for k, v in t.items()} | {"n": np.add.reduceat(t["n"], first)}


_PIECES = "wide boolean, anchor bigint, window bigint, doc bigint, key bigint, start bigint, words binary"


def _pieces(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The words of stretches to be searched; of wide anchors, every window by its hash."""
    known = _Words()

    def rows() -> Iterator[tuple]:
        for part in parts:
            for docs, keys, sizes, body, found in zip(
                *[part[c] for c in ("docs", "keys", "sizes", "body", "found")], strict=True
            ):
                by_doc: dict[int, list] = {}
                for x in found:
                    by_doc.setdefault(x["at"], []).append(x)
                for at, text in enumerate(_bodies(sizes, body)):
                    if at not in by_doc:
                        continue
                    words, _ = _hashed(iter([text]), known)
                    doc, key, windows = int(docs[at]), int(keys[at]), None
                    for x in by_doc[at]:
                        start, n = x["start"], x["n"]
                        if not x["wide"]:
                            yield False, x["anchor"], None, doc, key, start, words[start : start + n + LENGTH - 1].tobytes()
                            continue
                        windows = grams(words)[LENGTH].view(np.int64) if windows is None else windows
                        for i in range(start, start + n):
                            yield True, x["anchor"], int(windows[i]), doc, key, i, None

    for frame in frames([c.split()[0] for c in _PIECES.split(", ")], rows(), 5000):
        yield frame.astype({"window": "Int64"})


# --- the index ------------------------------------------------------------------------------


class WaveletMatrix:
    """Symbols as one bit vector per binary digit, with the number of ones before every 64 bits."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        self.digits = max(1, int(kinds - 1).bit_length())
        self.bits, self.ones, self.zeros = [], [], []
        now = symbols
        for k in range(self.digits - 1, -1, -1):
            bit = (now >> k & 1).astype(bool)
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, bool)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.bits.append(words)
            self.ones.append(np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]).astype(np.int32))
            self.zeros.append(len(bit) - int(bit.sum()))
            now = np.concatenate([now[~bit], now[bit]])
        self.base = np.zeros(kinds, np.int64)
        self.base = self._walk(np.arange(kinds), np.zeros(kinds, np.int64))

    def _walk(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (words, ones, zeros) in enumerate(zip(self.bits, self.ones, self.zeros, strict=True)):
            word, low = at >> 6, (at & 63).astype(np.uint64)
            one = ones[word] + np.bitwise_count(words[word] & ((np.uint64(1) << low) - np.uint64(1)))
            at = np.where(symbol >> (self.digits - 1 - k) & 1, zeros + one, at - one)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before a place."""
        return self._walk(symbol, at) - self.base[symbol]


class FmIndex:
    """FM-index of stretches of words, for matches of at most ``depth`` words that start earlier.

    ``text`` holds word numbers from 1 on and 0 after each stretch, ``place`` the order of the
    positions in the corpus. Suffixes are sorted by their first ``depth`` words, which is enough for
    backward search of patterns of that length.
    """

    def __init__(self, text: np.ndarray, place: np.ndarray, depth: int = LENGTH):
        self.text, self.place, self.depth, n = text, place, depth, len(text)
        self.n = n
        ranks, size, now = {1: text}, 1, text
        while 2 * size <= depth:
            now = ranks[2 * size] = self._pair(now, now, size)
            size *= 2
        covered = size
        while covered < depth:  # 20 as 16 and 4
            step = 1 << ((depth - covered).bit_length() - 1)
            now = self._pair(now, ranks[step], covered)
            covered += step
        order = np.argsort(now, kind="stable")
        kinds = int(text.max()) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=kinds))])
        self.wavelet = WaveletMatrix(text[order - 1], kinds)
        self._common(order, ranks)
        self._earliest(place[order])

    def _pair(self, a: np.ndarray, b: np.ndarray, apart: int) -> np.ndarray:
        after = np.zeros(len(a), np.int64)
        after[: max(0, len(a) - apart)] = b[apart:]
        return np.unique(a.astype(np.int64) * (int(b.max()) + 1) + after, return_inverse=True)[1]

    def _common(self, order: np.ndarray, ranks: dict[int, np.ndarray]) -> None:
        """Common prefixes of neighbours, and for each depth where the interval of a row begins and ends."""
        common = np.zeros(self.n + 1, np.int64)
        i, j = order[:-1], order[1:]
        for size in sorted(ranks, reverse=True):
            a, b = i + common[1:-1], j + common[1:-1]
            inside = np.maximum(a, b) < self.n
            same = ranks[size][np.minimum(a, self.n - 1)] == ranks[size][np.minimum(b, self.n - 1)]
            common[1:-1] += size * (inside & same)
        self.common = np.minimum(common, self.depth)
        rows = np.arange(self.n, dtype=np.int32)
        self.begin, self.end = [np.zeros(self.n, np.int32)], [np.full(self.n, self.n, np.int32)]
        for d in range(1, self.depth + 1):
            border = self.common[:-1] < d
            border[0] = True
            self.begin.append(np.maximum.accumulate(np.where(border, rows, 0)))
            after = np.full(self.n, self.n, np.int32)
            after[:-1] = np.where(border[1:], rows[1:], self.n)
            self.end.append(np.minimum.accumulate(after[::-1])[::-1])
        self.begin, self.end = np.stack(self.begin), np.stack(self.end)

    def _earliest(self, place: np.ndarray) -> None:
        levels = [place.astype(np.int32)]
        while 2 << len(levels) - 1 <= self.n:
            last, half = levels[-1], 1 << len(levels) - 1
            made = last.copy()
            np.minimum(last[:-half], last[half:], out=made[:-half])
            levels.append(made)
        self.least = np.stack(levels)

    def earliest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest place in each interval of rows, none of them empty."""
        k = np.frexp((high - low).astype(float))[1] - 1
        return np.minimum(self.least[k, low], self.least[k, high - (1 << k)])

    def extended(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the interval of each match with one more word in front."""
        both = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
        return self.before[symbol] + both[: len(low)], self.before[symbol] + both[len(low) :]

    def matching(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Matching statistics of stretches of the text, all streamed side by side from their ends.

        For each position the length of the longest match, ``depth`` at most, that starts earlier in
        the corpus than the position itself.
        """
        found = np.zeros(self.n, np.int64)
        low, high = np.zeros(len(starts), np.int64), np.full(len(starts), self.n)
        size = np.zeros(len(starts), np.int64)
        for t in range(int(sizes.max(initial=0))):
            lanes = np.flatnonzero(sizes > t)
            full = lanes[size[lanes] == self.depth]
            self._shorten(full, low, high, size, np.full(len(full), self.depth - 1))
            open_ = lanes
            while len(open_):
                at = starts[open_] + sizes[open_] - 1 - t
                a, b = self.extended(self.text[at], low[open_], high[open_])
                good = a < b
                good[good] = self.earliest(a[good], b[good]) < self.place[at[good]]
                hit = open_[good]
                low[hit], high[hit], size[hit] = a[good], b[good], size[hit] + 1
                left = open_[~good]
                open_ = left[size[left] > 0]
                self._shorten(open_, low, high, size, np.maximum(self.common[low[open_]], self.common[high[open_]]))
            found[starts[lanes] + sizes[lanes] - 1 - t] = size[lanes]
        return found

    def _shorten(self, lanes: np.ndarray, low: np.ndarray, high: np.ndarray, size: np.ndarray, to: np.ndarray) -> None:
        """Drop words at the right end of matches: the interval of the shorter match holds the old one."""
        begin, end = self.begin[to, low[lanes]], self.end[to, high[lanes] - 1]
        low[lanes], high[lanes], size[lanes] = begin, end, to


_SPANS = "doc bigint, key bigint, start bigint, n bigint"


def _search(part: pd.DataFrame) -> pd.DataFrame:
    """Windows of one shard's stretches that start earlier."""
    words = [np.frombuffer(x, np.uint64) for x in part["words"]]
    sizes = np.array([len(x) for x in words], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    inside = np.ones(int((sizes + 1).sum()), bool)
    inside[starts + sizes] = False
    text = np.zeros(len(inside), np.int64)
    text[inside] = np.unique(np.concatenate(words), return_inverse=True)[1] + 1
    piece = np.repeat(np.arange(len(words)), sizes)
    doc, key = part["doc"].to_numpy(np.int64)[piece], part["key"].to_numpy(np.int64)[piece]
    start = part["start"].to_numpy(np.int64)[piece] + np.flatnonzero(inside) - starts[piece]
    order = np.lexsort((start, key, doc))
    new = np.zeros(len(order), np.int64)
    new[1:] = (np.diff(doc[order]) != 0) | (np.diff(key[order]) != 0) | (np.diff(start[order]) != 0)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.cumsum(new)  # places that overlapping stretches share are one
    place = np.full(len(inside), len(order), np.int64)
    place[inside] = rank
    found = FmIndex(text, place).matching(starts, sizes)[inside] >= LENGTH
    hit = np.flatnonzero(found)
    new = np.ones(len(hit), bool)
    new[1:] = (np.diff(hit) != 1) | (piece[hit[1:]] != piece[hit[:-1]])
    first = np.flatnonzero(new)
    begin = hit[first]
    return pd.DataFrame(
        {"doc": doc[begin], "key": key[begin], "start": start[begin], "n": np.diff(np.append(first, len(hit)))}
    )


# --- the operator ---------------------------------------------------------------------------


def repeated_windows(docs: DataFrame) -> DataFrame:
    """``doc, key, start, n``: n windows in a row, the first at word ``start``, that start earlier."""
    return _windows(blocks_of(docs))


def _windows(blocks: DataFrame, wide: int = WIDE, shard_words: int = SHARD_WORDS) -> DataFrame:
    size = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x))).first()[0] or 0
    buckets = int(max(1, -(-size // BUCKET_BYTES)))
    sent = blocks.select("block", "sizes", "body").mapInPandas(_anchors(buckets), _SENT)
    hits = sent.groupBy("bucket").applyInPandas(_repeated, "block bigint, anchors binary")
    hits = hits.groupBy("block").agg(F.collect_list("anchors").alias("hits"))  # at most a block's anchors
    runs = stored(blocks.join(hits, "block").mapInPandas(_candidates, _RUNS), "runs")

    place = F.struct("doc", "key", "start")
    firsts = stored(
        runs.where("first").groupBy("anchor", "stretch").agg(
            F.min(F.struct("doc", "key", "start", "n", "block", "at")).alias("least"), F.count(F.lit(1)).alias("times"),
            F.max("restless").alias("restless"),
        ),
        "firsts",
    )
    several = firsts.where("times > 1").select("anchor", "stretch", F.struct("least.doc", "least.key", "least.start").alias("least"))
    later = runs.where("first").join(several, ["anchor", "stretch"]).where(place != F.col("least"))
    kinds = firsts.groupBy("anchor").agg(F.count(F.lit(1)).alias("kinds"), F.max("restless").alias("restless"))
    kinds = kinds.where("kinds > 1 or restless").select("anchor", "kinds")
    found = firsts.select("anchor", "least.*").join(kinds, "anchor").groupBy("block").agg(
        F.collect_list(F.struct("at", "anchor", "start", "n", (F.col("kinds") > wide).alias("wide"))).alias("found")
    )  # at most a block's words
    pieces = stored(blocks.join(found, "block").mapInPandas(_pieces, _PIECES), "pieces")

    narrow = pieces.where("not wide")
    words = narrow.agg(F.sum(F.octet_length("words").cast("bigint") / 8)).first()[0] or 0
    shards = int(max(1, -(-words // shard_words)))
    shard = F.pmod(F.xxhash64("anchor"), F.lit(shards)).alias("shard")
    searched = narrow.select(shard, "doc", "key", "start", "words").groupBy("shard").applyInPandas(_search, _SPANS)

    single = pieces.where("wide").select("anchor", "window", "doc", "key", "start")
    least = single.groupBy("anchor", "window").agg(F.min(place).alias("least"), F.count(F.lit(1)).alias("times"))
    again = single.join(least.where("times > 1"), ["anchor", "window"]).where(place != F.col("least"))
    names = ["doc", "key", "start", "n"]
    return (
        runs.where("not first").select(*names)
        .union(later.select(*names))
        .union(searched)
        .union(again.select("doc", "key", "start", F.lit(1).cast("bigint").alias("n")))
    )


def _covered(count: int, spans: object) -> np.ndarray:
    """Which of a document's words a repeated window covers."""
    edge = np.zeros(count + 1, np.int64)
    for x in spans:
        edge[x["start"]] += 1
        edge[x["start"] + x["n"] - 1 + LENGTH] -= 1
    return np.cumsum(edge)[:-1] > 0


def _with_spans(docs: DataFrame) -> DataFrame:
    """Blocks, each with the repeated windows of its documents."""
    blocks = blocks_of(docs)
    by_doc = _windows(blocks).groupBy("doc", "key").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    ids = blocks.select("block", F.explode(F.arrays_zip("docs", "keys")).alias("x")).select(
        "block", F.col("x.docs").alias("doc"), F.col("x.keys").alias("key")
    ).distinct()
    of_block = by_doc.join(ids, ["doc", "key"]).groupBy("block").agg(
        F.collect_list(F.struct("doc", "key", "spans")).alias("found")
    )
    return blocks.join(of_block, "block", "left")


def _kept(parts: Iterator[pd.DataFrame]) -> Iterator[tuple[int | None, int, list[bytes]]]:
    """Id, number of words and words that stay, of every row."""
    for part in parts:
        for docs, keys, nulls, sizes, body, found in zip(
            *[part[c] for c in ("docs", "keys", "nulls", "sizes", "body", "found")], strict=True
        ):
            spans = {} if found is None else {(x["doc"], x["key"]): x["spans"] for x in found}
            for doc, key, none, text in zip(docs, keys, nulls, _bodies(sizes, body), strict=True):
                words = text.split()
                some = spans.get((doc, key))
                if some is None:
                    left = words
                else:
                    left = [w for w, gone in zip(words, _covered(len(words), some).tolist(), strict=True) if not gone]
                yield None if none else int(doc), len(words), left


def without_passages(docs: DataFrame) -> DataFrame:
    """``doc_id, text``: the words that stay, joined by one space."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((doc, b" ".join(left).decode("utf-8", "surrogatepass")) for doc, _, left in _kept(parts))
        for frame in frames(["doc_id", "text"], rows):
            yield frame.astype({"doc_id": "Int64"})

    return _with_spans(docs).mapInPandas(run, "doc_id bigint, text string")


_OUT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def removed(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: words, words removed, SHA-256 of the rest.

    A null text has no words. Documents are ordered by doc_id (null first), those of one id by a
    hash of the text; rows equal in both are one document, and each of them gets its result. Texts
    of fewer than ``LENGTH`` words lose nothing. An empty table gives an empty result; other
    columns, whatever their names, are not read. Words are compared by 64-bit hashes, stretches and
    windows of one anchor by another 64 bits beside the anchor's.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = ((doc, n, n - len(left), hashlib.sha256(b" ".join(left)).hexdigest()) for doc, n, left in _kept(parts))
        for frame in frames([c.split()[0] for c in _OUT.split(", ")], rows):
            yield frame.astype({"doc_id": "Int64"})

    return _with_spans(docs).mapInPandas(run, _OUT)


def op12_passages(spark: SparkSession, folder: str) -> DataFrame:
    return removed(table(spark, folder, "documents"))


ORACLE = """
WITH texts AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), starts AS (
  SELECT doc_id, words, unnest(range(1, greatest(len(words) - 18, 1))) AS i FROM texts
), windows AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 19], ' ')) AS w FROM starts
), repeats AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS r FROM windows) WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, i + unnest(range(0, 20)) AS pos FROM repeats
), each_word AS (
  SELECT doc_id, unnest(range(1, len(words) + 1)) AS pos, unnest(words) AS word FROM texts
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
  FROM each_word WHERE (doc_id, pos) NOT IN (SELECT doc_id, pos FROM gone) GROUP BY doc_id
)
SELECT t.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""
