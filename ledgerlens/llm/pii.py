"""Personal data in texts: patterns, plus boosted trees that judge looser candidates.

Four kinds have a strict pattern and a test; spans that pass are always kept. Generators of high
recall propose further spans, overlapping each other and the strict ones. Trees over features of
the format and the context are trained on strict spans (positive) and on candidates that fail a
hard test (negative); their scores are calibrated, and a threshold for high precision selects
which of the remaining candidates are personal data too. What is still open is decided by score,
then by place.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.boosting import Boosted, Isotonic
from ledgerlens.llm.common import bounded, table, texts, whole

KINDS = ("email", "ip", "card", "phone")
SAMPLE = 20_000  # documents that the model is fitted on, at most
PRECISION = 0.98
MASKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}

# The strict patterns, and the words that often stand before personal data.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match can only start where a run of digits does, which keeps long runs linear
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
CUES = {
    "email": ("mail", "e-mail", "email", "contact", "write", "reach", "address"),
    "ip": ("ip", "host", "server", "address", "from", "client", "login"),
    "card": ("card", "visa", "credit", "account", "payment", "number", "karte", "tarjeta", "carte"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "ring", "telefon", "teléfono", "téléphone"),
}

# Looser patterns of the generators. Each is linear: no part can match what its neighbour matches.
_AT = re.compile(
    r"(?<![\w.])[A-Za-z0-9._%+-]{1,64}\s?[\[({]\s?at\s?[\])}]\s?[A-Za-z0-9-]{1,63}"
    r"(?:(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?)[A-Za-z0-9-]{1,63}){1,4}",
    re.IGNORECASE,
)
_V6 = re.compile(r"(?<![\w:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){7}(?![\w:])")
_DIGITS = re.compile(r"(?<![\w.+-])(?:\([0-9]{2,4}\)|[0-9]{2,5})(?:[ ./-]{1,2}(?:\([0-9]{2,4}\)|[0-9]{2,5})){1,6}(?![\w-])")
_LONG = re.compile(r"(?<![\w.])[0-9]{9,24}(?![\w.])")
_ANY = re.compile(r"[0-9@]|[\[({]\s?at\s?[\])}]", re.IGNORECASE)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping matches of local part, ``@`` and dotted domain, in linear time."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", max(done, at + 1))


def strict(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans (start, kind, end) that pass their test, by start and kind; and those that fail."""
    good: list[tuple[int, int, int]] = []
    bad: list[tuple[int, int, int]] = []
    for start, end in _emails(text) if "@" in text else ():
        good.append((start, 0, end))
    for m in _IP.finditer(text):
        parts = m.group().split(".")
        fits = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)
        (good if fits else bad).append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            good.append((m.start(), 2, m.end()))
        elif 9 <= len(digits) <= 24:
            bad.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            n = sum(c.isdigit() for c in m.group())
            (good if 9 <= n <= 15 else bad).append((m.start(), 3, m.end()))
    good.sort()
    return good, bad


def proposals(text: str) -> Iterator[tuple[int, int, int]]:
    """Looser spans (start, kind, end); they may overlap."""
    for kind, rule in ((0, _AT), (1, _V6), (3, _DIGITS), (2, _LONG), (3, _LONG)):
        for m in rule.finditer(text):
            yield m.start(), kind, m.end()


def _features(text: str, start: int, kind: int, end: int) -> list[float]:
    span = text[start:end]
    before, after = text[max(0, start - 32) : start].lower(), text[end : end + 16].lower()
    digits = [c for c in span if c.isdigit()]
    groups = [len(g) for g in re.findall(r"\d+", span)]
    cue = [w for k in CUES for w in CUES[k] if w in before]
    n = len(digits)
    return [
        *[float(kind == k) for k in range(len(KINDS))],
        float(len(span)), float(n), n / len(span), float(len(groups)),
        float(max(groups, default=0)), float(min(groups, default=0)),
        float(len(set(digits))), float(sum(c.isalpha() for c in span)), float(span.count(".")),
        float(span.count("-")), float(span.count(" ")), float("(" in span), float("@" in span),
        float(span.startswith("+")), float(n >= 12 and n <= 19 and luhn("".join(digits) if "".join(digits).isascii() else "1")),
        float(sum(w in CUES[KINDS[kind]] for w in cue)), float(len(cue)),
        float(before[-1:].isalnum()), float(after[:1].isalnum()), float("=" in before[-4:]),
        float("version" in before or "no." in before or "id" in before.split()[-1:]),
    ]


class Taken:
    """Disjoint stretches of a text in order, so that an overlap is found by halving."""

    def __init__(self, spans: Sequence[tuple[int, int, int]] = ()):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, _, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def overlaps(self, span: tuple[int, int, int]) -> bool:
        before = bisect_left(self.starts, span[2]) - 1
        return before >= 0 and span[0] < self.ends[before]

    def add(self, span: tuple[int, int, int]) -> None:
        """A span that overlaps none of those held."""
        at = bisect_left(self.starts, span[0])
        self.starts.insert(at, span[0])
        self.ends.insert(at, span[2])


@dataclass
class Model:
    trees: Boosted
    scale: Isotonic
    limit: float

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Strict spans, and all spans: the strict ones and those that the trees select."""
        if not _ANY.search(text):
            return [], []
        good, bad = strict(text)
        failed = {(s, k, e) for s, k, e in bad}
        strictly = Taken(good)
        left = [p for p in dict.fromkeys(proposals(text)) if p not in failed and not strictly.overlaps(p)]
        if not left:
            return good, good
        x = np.array([_features(text, *p) for p in left])
        rated = sorted(zip((-self.scale(self.trees.margin(x))).tolist(), left, strict=True))
        extra: list[tuple[int, int, int]] = []
        added = Taken()
        for minus, span in rated:
            if -minus >= self.limit and not added.overlaps(span):
                extra.append(span)
                added.add(span)
        return good, sorted(good + extra)


def fit(docs: DataFrame, sample: int = SAMPLE, precision: float = PRECISION) -> Model:
    """Train on the candidates of at most ``sample`` documents, chosen by a hash of id and text.

    Two thirds of the candidates, by hash, grow the trees; the others calibrate them and set the
    lowest score at which ``precision`` of the kept ones are positive (none: nothing is added).
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for text in texts(part["text"]):
                good, bad = strict(text) if _ANY.search(text) else ([], [])
                rows += [(_features(text, *s), 1.0) for s in good[:50]]
                rows += [(_features(text, *s), 0.0) for s in bad[:50]]
            yield pd.DataFrame(rows, columns=["x", "y"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole().alias("text"))
    key = F.xxhash64("doc_id", F.length("text"))
    ids = bounded(rows.select("doc_id").where("doc_id is not null").distinct(), sample, F.col("doc_id"))
    ids = ids.select(F.col("doc_id").alias("__id"))
    # at most `sample` ids are broadcast; ids may repeat, so the rows are bounded again
    picked = rows.join(F.broadcast(ids), F.col("doc_id") == F.col("__id")).where(
        "text rlike '[0-9@]'"
    )
    made = picked.withColumn("k", key).mapInPandas(run, "x array<double>, y double")
    held = bounded(made, 8 * sample, F.hash("x")).toPandas()
    held["key"] = held["x"].map(lambda v: hashlib.md5(np.asarray(v).tobytes()).hexdigest())
    held = held.sort_values(["key", "y"], kind="stable")
    x = np.array(held["x"].tolist(), float).reshape(-1, 25)
    y = held["y"].to_numpy(float)
    third = held["key"].str[0].isin(list("01234")).to_numpy(bool)
    trees = Boosted(trees=30, depth=3).fit(x[~third], y[~third])
    margin = trees.margin(x[third])
    scale = Isotonic().fit(margin, y[third])
    limit = 2.0
    if third.any() and 0 < y[third].sum() < third.sum():
        scores = scale(margin)
        for t in np.unique(scores)[::-1]:
            if y[third][scores >= t].mean() < precision:
                break
            limit = float(t)
    return Model(trees, scale, max(limit, 0.5))


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


_OUT = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
    "base_sha256 string, spans string"
)


def find(docs: DataFrame, model: Model) -> DataFrame:
    """Per row: counts of the strict spans by kind, their hash, and all spans as text.

    Offsets are code points, ends exclusive. A null or empty text has no spans; repeated rows
    repeat their results; an empty table gives an empty result; other columns are not read.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for doc, text in zip(part["doc_id"], texts(part["text"]), strict=True):
                good, full = model.spans(text)
                counts = [sum(k == kind for _, k, _ in good) for kind in range(len(KINDS))]
                digest = hashlib.sha256(_written(good).encode()).hexdigest()
                rows.append((None if pd.isna(doc) else int(doc), *counts, digest, _written(full)))
            made = pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")])
            yield made.astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text"))
    return rows.mapInPandas(run, _OUT)


def redacted(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by the mask of its kind; overlapping spans by the first."""
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], MASKS[KINDS[kind]]]
            done = end
        elif end > done:  # the rest of a span that the one before covers in part
            done = end
    return "".join([*out, text[done:]])


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with personal data masked in ``text`` and ``n_chars`` (if any) counted anew.

    Null texts stay null; all other columns and all rows stay as they are.
    """

    def clean(values: pd.Series) -> pd.Series:
        return pd.Series(
            [None if not isinstance(t, str) else redacted(t, model.spans(t)[1]) for t in values], dtype=object
        )

    out = docs.withColumn("text", F.pandas_udf(clean, "string")("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind)).select(*[f"`{c}`" for c in docs.columns])
    return out


def op2_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return find(docs, fit(docs))
