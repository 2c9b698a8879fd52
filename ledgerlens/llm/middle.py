"""Fill-in-middle training text from seekable compressed frames.

A text is stored as independent zstandard frames of at most ``FRAME`` code points, each with the
number of units (a run of A-Z, a-z, or one other code point) and of code points that start before
it. A cut after k units is found by decompressing the one frame in which unit k starts; a stretch
of text is read by decompressing the frames it overlaps, one at a time. So neither cutting, nor
writing the rearranged text, nor restoring it ever holds a whole text: a task holds the compressed
frames of one document and one or two open ones.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import frames as tables
from ledgerlens.llm.common import stored, table, whole

FRAME = 8192
SEGMENT = 16  # frames in a row of the stored table
PLAIN_FROM = 90  # of 100 draws, those from here on leave the text as it is
SPM_BELOW = 20  # of 100 draws, those below put the suffix first
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARKS = (PREFIX, SUFFIX, MIDDLE)

_squeeze = zstandard.ZstdCompressor(level=1)
_open = zstandard.ZstdDecompressor()


def unit_starts(text: str, inside: bool = False) -> np.ndarray:
    """Which code points start a unit; ``inside`` says that a letter stands before the text."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = (code | np.uint32(32)) - np.uint32(97) < np.uint32(26)
    before = np.empty(len(letter), bool)
    if len(letter):
        before[0] = inside
        before[1:] = letter[:-1]
    return ~(letter & before)


def _letter(c: str) -> bool:
    return "a" <= c <= "z" or "A" <= c <= "Z"


class Frames:
    """A text as compressed frames with cumulative counts of units and code points."""

    def __init__(self) -> None:
        self.bodies: list[bytes] = []
        self.units, self.chars = [0], [0]  # before each frame, and in all
        self.inside: list[bool] = []  # whether a unit goes on into the frame

    @classmethod
    def of(cls, pieces: Iterable[str], size: int = FRAME) -> Frames:
        made, held, inside = cls(), "", False
        for piece in pieces:
            held += piece
            while len(held) >= size:
                inside = made._add(held[:size], inside)
                held = held[size:]
        if held:
            made._add(held, inside)
        return made

    def _add(self, text: str, inside: bool) -> bool:
        body = _squeeze.compress(text.encode("utf-8", "surrogatepass"))
        self.add(body, int(unit_starts(text, inside).sum()), len(text), inside)
        return _letter(text[-1])

    def add(self, body: bytes, units: int, chars: int, inside: bool) -> None:
        self.bodies.append(body)
        self.units.append(self.units[-1] + units)
        self.chars.append(self.chars[-1] + chars)
        self.inside.append(inside)

    def text(self, k: int) -> str:
        return _open.decompress(self.bodies[k]).decode("utf-8", "surrogatepass")

    def position(self, unit: int) -> int:
        """Code points before the unit of that number; all of them past the last unit."""
        if unit >= self.units[-1]:
            return self.chars[-1]
        k = bisect_right(self.units, unit) - 1
        starts = np.flatnonzero(unit_starts(self.text(k), self.inside[k]))
        return self.chars[k] + int(starts[unit - self.units[k]])

    def read(self, start: int, end: int) -> Iterator[str]:
        """The code points from start to end, frame by frame."""
        if start >= end:
            return
        for k in range(bisect_right(self.chars, start) - 1, len(self.bodies)):
            at = self.chars[k]
            if at >= end:
                return
            yield self.text(k)[max(0, start - at) : end - at]

    def find(self, mark: str, start: int) -> int:
        """Where the mark first stands from ``start`` on, also across frames."""
        tail, at = "", start
        for piece in self.read(start, self.chars[-1]):
            seen = tail + piece
            found = seen.find(mark)
            if found >= 0:
                return at - len(tail) + found
            at += len(piece)
            tail = seen[1 - len(mark) :]
        raise ValueError(f"no {mark}")


def draws(doc_id: int | None) -> list[int]:
    """Four numbers that the id alone decides; a null id draws like an empty one."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def form_of(numbers: list[int], marked: bool, units: int) -> str:
    if not units or marked or numbers[2] % 100 >= PLAIN_FROM:
        return "plain"
    return "spm" if numbers[3] % 100 < SPM_BELOW else "psm"


def rearranged(text: Frames, form: str, first: int, second: int) -> Iterator[str]:
    """The output in pieces; ``first`` and ``second`` are the cuts in code points."""
    end = text.chars[-1]
    if form == "plain":
        yield from text.read(0, end)
        return
    parts = {PREFIX: (0, first), SUFFIX: (second, end), MIDDLE: (first, second)}
    for mark in MARKS if form == "psm" else (SUFFIX, PREFIX, MIDDLE):
        yield mark
        yield from text.read(*parts[mark])


def restored(output: Frames, form: str) -> Iterator[str]:
    """The text again, from the output and its form alone."""
    end = output.chars[-1]
    if form == "plain":
        yield from output.read(0, end)
        return
    size = len(PREFIX)
    one = output.find(SUFFIX if form == "psm" else PREFIX, size)
    two = output.find(MIDDLE, one + size)
    prefix, suffix = (size, one), (one + size, two)
    if form == "spm":
        prefix, suffix = suffix, prefix
    yield from output.read(*prefix)
    yield from output.read(two + size, end)
    yield from output.read(*suffix)


def _digest(pieces: Iterable[str]) -> str:
    sha = hashlib.sha256()
    for piece in pieces:
        sha.update(piece.encode("utf-8", "surrogatepass"))
    return sha.hexdigest()


_STORE = (
    "row bigint, doc_id bigint, marked boolean, segment int, segments int, "
    "units array<int>, chars array<int>, inside array<boolean>, bodies array<binary>"
)


def framed(docs: DataFrame, size: int = FRAME, per_row: int = SEGMENT) -> DataFrame:
    """The texts of ``docs`` as a stored table of frames, at most ``per_row`` of them in a row.

    ``row`` numbers the rows of ``docs`` in the one scan that writes the frames; an empty text has
    one row without frames.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for part in parts:
                for row, doc, text in zip(part["row"], part["doc_id"], part["text"], strict=True):
                    doc = None if pd.isna(doc) else int(doc)
                    marked = any(m in text for m in MARKS)
                    made = Frames.of((text[i : i + size] for i in range(0, len(text), size)), size)
                    units, chars = np.diff(made.units).tolist(), np.diff(made.chars).tolist()
                    segments = max(1, -(-len(made.bodies) // per_row))
                    for k in range(segments):
                        some = slice(k * per_row, (k + 1) * per_row)
                        yield row, doc, marked, k, segments, units[some], chars[some], made.inside[some], made.bodies[some]

        names = [c.split()[0] for c in _STORE.split(", ")]
        for frame in tables(names, rows(), 500):
            yield frame.astype({"doc_id": "Int64"})

    slim = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint"), whole().alias("text")
    )
    return stored(slim.mapInPandas(run, _STORE), "frames")


def _documents(parts: Iterator[pd.DataFrame]) -> Iterator[tuple[int | None, bool, Frames]]:
    """Documents out of rows of frames that come sorted by (row, segment)."""
    now, doc, flag, held = None, None, False, Frames()
    for part in parts:
        for row, doc_id, marked, *frames in zip(
            *[part[c] for c in ("row", "doc_id", "marked", "bodies", "units", "chars", "inside")], strict=True
        ):
            if row != now:
                if now is not None:
                    yield doc, flag, held
                now, flag, held = row, bool(marked), Frames()
                doc = None if pd.isna(doc_id) else int(doc_id)
            for body, units, chars, inside in zip(*frames, strict=True):
                held.add(body, int(units), int(chars), bool(inside))
    if now is not None:
        yield doc, flag, held


def _cuts(doc: int | None, marked: bool, text: Frames) -> tuple[int, str, int | None, int | None]:
    """Units, form, and both cuts in code points."""
    numbers, n = draws(doc), text.units[-1]
    form = form_of(numbers, marked, n)
    if form == "plain":
        return n, form, None, None
    first, second = sorted(x % (n + 1) for x in numbers[:2])
    return n, form, text.position(first), text.position(second)


def _by_row(docs: DataFrame, run, schema: str) -> DataFrame:
    """Run over the documents; only frames of texts that take several rows are shuffled."""
    frames = framed(docs)
    short, long = frames.where("segments = 1"), frames.where("segments > 1")
    dealt = long.repartition("row").sortWithinPartitions("row", "segment")
    return short.mapInPandas(run, schema).union(dealt.mapInPandas(run, schema))


_PARTS = "doc_id bigint, n bigint, form string, part int, text string"


def fill_in_middle(docs: DataFrame) -> DataFrame:
    """``doc_id, n, form, part, text``: the rearranged texts, in ordered parts of bounded length.

    The parts of one row of ``docs``, joined in order, are its output; an empty output is one empty
    part. Nulls, ties and empty tables are handled as in ``digests``.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for doc, marked, text in _documents(parts):
                n, form, first, second = _cuts(doc, marked, text)
                output = Frames.of(rearranged(text, form, first, second))
                for k in range(max(1, len(output.bodies))):
                    yield doc, n, form, k, output.text(k) if output.bodies else ""

        for frame in tables([c.split()[0] for c in _PARTS.split(", ")], rows()):
            yield frame.astype({"doc_id": "Int64"})

    return _by_row(docs, run, _PARTS)


_OUT = (
    "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
    "output_sha256 string, restored_sha256 string"
)


def digests(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: units, form, lengths of prefix and middle, and the digests of the output
    and of the text restored from it.

    A null text counts as empty. The id alone decides cuts and form, so rows that share an id draw
    alike, each on its own text, and repeated rows give repeated results; a null id draws like an
    empty one. An empty table gives an empty result; other columns, whatever their names, are not
    read. Texts may be of any length: they are read frame by frame.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows() -> Iterator[tuple]:
            for doc, marked, text in _documents(parts):
                n, form, first, second = _cuts(doc, marked, text)
                output = Frames.of(rearranged(text, form, first, second))
                made = _digest(output.read(0, output.chars[-1]))
                again = _digest(restored(output, form))
                yield doc, n, form, first, None if first is None else second - first, made, again

        for frame in tables([c.split()[0] for c in _OUT.split(", ")], rows()):
            yield frame.astype({"doc_id": "Int64", "prefix_chars": "Int64", "middle_chars": "Int64"})

    return _by_row(docs, run, _OUT)


def op13_middle(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"))


ORACLE = """
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || CAST(doc_id AS VARCHAR)) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
  FROM documents
), cut AS (
  SELECT doc_id, text, units, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || h[1:8] AS BIGINT) % (len(units) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(units) + 1) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, text, n, form, array_to_string(units[1:least(a, b)], '') AS p,
         array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS m,
         array_to_string(units[greatest(a, b) + 1:n], '') AS s
  FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
