"""Quality of documents from weak labels.

Heuristic labellers each vote good, bad or nothing on a whole text. They overlap and err, so their
accuracies are estimated without true labels: expectation-maximisation alternates between the
posterior of each pattern of votes and the accuracy of each labeller. Patterns are counted over
all documents; there are at most 3 to the number of labellers. Posterior labels then train a
linear scorer on hashed features, from a bounded sample, and the scorer judges every document.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.common import bounded, table, texts, whole

SAMPLE = 8_000  # documents that the scorer is trained on, at most
SLOTS = 1 << 15  # hashed features
KEEP = 0.5
_SHAPES = re.compile(r"[^\W\d_]+|\d+|[^\w\s]+|_+")
_PAIRS = re.compile(r"[^\w\s]{2,}")

# Votes turn bad above the first limit and good below the second (see `votes`).
LIMITS = {
    "signs": (0.12, 0.05),  # characters that are neither letters, digits nor white space
    "runs": (0.10, 0.02),  # tokens with two or more signs in a row, per word
    "capitals": (0.50, 0.15),  # capital letters, per letter
    "commonest": (0.20, 0.12),  # occurrences of the commonest word, per word
    "repeats": (0.15, 0.05),  # words that equal the word before, per word
    "lines": (0.30, 0.10),  # lines that equal an earlier line, per line
    "bars": (0.05, 0.01),  # bars and bullets, per word
    "digits": (0.20, 0.08),  # digits, per character
}
LABELLERS = (*LIMITS, "length", "distinct")


_UPPER = np.arange(65, 91)
_LOWER = np.arange(97, 123)
_DIGIT = np.arange(48, 58)
_SPACE = np.array([9, 10, 11, 12, 13, 32])


def measures(text: str, words: list[str], counts: Counter) -> dict[str, float]:
    """Shares over a whole text; characters beyond ASCII count as small letters."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    seen = np.bincount(data, minlength=256)
    wide = int(seen[192:].sum())  # first bytes of characters beyond ASCII
    upper, lower = int(seen[_UPPER].sum()), int(seen[_LOWER].sum()) + wide
    digits, spaces = int(seen[_DIGIT].sum()), int(seen[_SPACE].sum())
    n, size = max(len(words), 1), max(len(text), 1)
    lines = [x for x in text.split("\n") if x.strip()]
    return {
        "signs": (int(seen[:128].sum()) - upper - lower + wide - digits - spaces) / size,
        "runs": len(_PAIRS.findall(text)) / n,
        "capitals": upper / max(upper + lower, 1),
        "commonest": max(counts.values(), default=0) / n if len(words) >= 20 else 0.1,
        "repeats": sum(map(str.__eq__, words, words[1:])) / n,
        "lines": 1 - len(set(lines)) / max(len(lines), 1),
        "bars": (int(seen[124]) + text.count("•") + text.count("·")) / n,
        "digits": digits / size,
        "words": float(len(words)),
        "distinct": len(counts) / n,
    }


def votes(text: str, words: list[str] | None = None, counts: Counter | None = None) -> list[int]:
    """1 good, -1 bad, 0 no vote, in the order of LABELLERS."""
    words = text.split() if words is None else words
    counts = Counter(words) if counts is None else counts
    m = measures(text, words, counts)
    out = [-1 if m[k] > bad else 1 if m[k] < good else 0 for k, (bad, good) in LIMITS.items()]
    out.append(-1 if m["words"] < 3 else 1 if m["words"] >= 50 else 0)
    scarce = m["words"] >= 50 and m["distinct"] < 0.15
    out.append(-1 if scarce else 1 if m["words"] >= 50 and m["distinct"] > 0.3 else 0)
    return out


def pattern(found: list[int]) -> int:
    code = 0
    for v in found:
        code = code * 3 + v + 1
    return code


def unpatterned(code: int) -> list[int]:
    out = []
    for _ in LABELLERS:
        out.append(code % 3 - 1)
        code //= 3
    return out[::-1]


@dataclass
class Labels:
    """Estimated prior and accuracies, and the posterior of good for each pattern."""

    prior: float
    sensitivity: list[float]  # chance of a good vote on a good text, if the labeller votes
    specificity: list[float]  # chance of a bad vote on a bad text, if the labeller votes
    posterior: dict[int, float]


def estimate(counts: dict[int, int], rounds: int = 200) -> Labels:
    """EM over patterns with their counts. Votes are taken as independent given the true label;
    labellers start with few bad votes on good texts, and no more than a tenth are ever assumed,
    since each looks for one kind of fault and sees nothing wrong with the others."""
    codes = sorted(counts)
    v = np.array([unpatterned(c) for c in codes], float).reshape(-1, len(LABELLERS))
    n = np.array([counts[c] for c in codes], float)
    up, down = (v > 0).astype(float), (v < 0).astype(float)
    sens = np.full(len(LABELLERS), 0.995)
    spec = np.full(len(LABELLERS), 0.25)
    prior = 0.85
    post = np.full(len(codes), prior)
    for _ in range(rounds if len(codes) else 0):
        good = np.log(prior) + up @ np.log(sens) + down @ np.log(1 - sens)
        bad = np.log(1 - prior) + up @ np.log(1 - spec) + down @ np.log(spec)
        new = 1 / (1 + np.exp(np.clip(bad - good, -50, 50)))
        w, u = n * new, n * (1 - new)
        sens = np.clip((w @ up + 9.9) / (w @ (up + down) + 10), 0.9, 0.9999)
        spec = np.clip((u @ down + 2) / (u @ (up + down) + 10), 0.01, 0.999)
        prior = float(np.clip((w.sum() + 1) / (n.sum() + 2), 0.01, 0.99))
        moved = np.abs(new - post).max()
        post = new
        if moved < 1e-7:
            break
    return Labels(prior, sens.tolist(), spec.tolist(), dict(zip(codes, post.tolist(), strict=True)))


class Hashed:
    """Slots and values of a text: its words, and their shapes; values have length one.

    Slots may repeat. The slots of frequent words are remembered, up to ``cache`` words.
    """

    def __init__(self, cache: int = 200_000):
        self.known: dict[str, int] = {}
        self.cache = cache

    @staticmethod
    def slots(word: str) -> int:
        """Slot of the word and of its shape, as one number."""
        shape = zlib.crc32(b"#")
        for m in _SHAPES.finditer(word):  # of the whole word, however long
            p = m.group()
            p = "A" if p.isupper() and len(p) > 1 else "a" if p.isalpha() else "9" if p.isdigit() else p
            shape = zlib.crc32(p.encode("utf-8", "surrogatepass"), shape)
        own = zlib.crc32(word.lower().encode("utf-8", "surrogatepass")) % SLOTS
        return own * SLOTS + shape % SLOTS

    def __call__(self, words: list[str], counts: Counter) -> tuple[np.ndarray, np.ndarray]:
        known, slots = self.known, self.slots
        if len(known) > self.cache:
            known.clear()
        for word in counts:
            if word not in known:
                known[word] = slots(word)
        both = np.fromiter(map(known.__getitem__, counts), np.int64, len(counts))
        n = np.fromiter(counts.values(), np.float64, len(counts))
        share = int(20 * n.max() / n.sum()) if len(n) else 0
        at = np.concatenate([both // SLOTS, both % SLOTS, [zlib.crc32(b"~%d" % share) % SLOTS]])
        value = np.concatenate([1.0 + np.log(n), n, [1.0]])
        return at, value / np.sqrt((value**2).sum())


@dataclass
class Scorer:
    weights: np.ndarray
    bias: float

    def __call__(self, at: np.ndarray, value: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[at] @ value + self.bias, -40, 40))))


def train(rows: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 12, rate: float = 0.5) -> Scorer:
    """Logistic regression on posterior labels by adaptive gradient steps, in the given order."""
    w, seen = np.zeros(SLOTS), np.full(SLOTS, 1e-6)
    bias, seen_bias = 0.0, 1e-6
    for _ in range(rounds):
        for at, value, label in rows:
            p = 1 / (1 + np.exp(-np.clip(w[at] @ value + bias, -40, 40)))
            g = (p - label) * value
            seen[at] += g * g
            w[at] -= rate * g / np.sqrt(seen[at])
            seen_bias += (p - label) ** 2
            bias -= rate * (p - label) / np.sqrt(seen_bias)
    return Scorer(w.astype(np.float32), float(bias))


def weak_labels(docs: DataFrame) -> Labels:
    """Labels from the votes on all rows of ``docs``."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = Counter(pattern(votes(t)) for t in texts(part["text"]))
            yield pd.DataFrame({"code": list(found), "n": list(found.values())})

    counts = docs.select(whole().alias("text")).mapInPandas(run, "code int, n bigint").groupBy("code")
    found = counts.agg(F.sum("n").alias("n")).collect()  # 3 ** 10 patterns at most
    return estimate({r["code"]: r["n"] for r in found})


def fit(docs: DataFrame, labels: Labels, sample: int = SAMPLE) -> Scorer:
    """Train the scorer on at most ``sample`` documents, chosen by a hash of the id."""
    posterior = labels.posterior

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed = Hashed()
        for part in parts:
            rows = []
            for doc, text in zip(part["doc_id"], texts(part["text"]), strict=True):
                counts = Counter(words := text.split())
                at, value = hashed(words, counts)
                at, place = np.unique(at, return_inverse=True)
                value = np.bincount(place, value, len(at))
                known = posterior.get(pattern(votes(text, words, counts)), labels.prior)
                rows.append((int(doc), at.tolist(), value.tolist(), known))
            yield pd.DataFrame(rows, columns=["doc_id", "at", "value", "label"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole().alias("text"))
    ids = bounded(rows.select("doc_id").where("doc_id is not null").distinct(), sample, F.col("doc_id"))
    # at most `sample` ids are broadcast
    some = rows.join(F.broadcast(ids), "doc_id")
    made = some.mapInPandas(run, "doc_id bigint, at array<int>, value array<double>, label double")
    held = bounded(made, sample, F.col("doc_id")).select(
        F.xxhash64("doc_id").alias("h"), "at", F.col("value").cast("array<float>").alias("value"), "label"
    ).toPandas()
    held = held.sort_values(["h", "label"], kind="stable")
    return train(
        [(np.asarray(a, np.int64), np.asarray(v, np.float64), y) for a, v, y in zip(held["at"], held["value"], held["label"], strict=True)]
    )


_OUT = "doc_id bigint, votes string, posterior double, score double, keep boolean"


def judge(docs: DataFrame, labels: Labels, scorer: Scorer, keep: float = KEEP) -> DataFrame:
    """Per row: votes (+, - or 0 per labeller), posterior, score of the linear scorer, decision.

    A document goes only if scorer and posterior are both below ``keep``. Null texts count as empty and are judged by their votes like others. Repeated rows get equal
    results; an empty table gives an empty result; other columns are not read.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashed = Hashed()
        for part in parts:
            rows = []
            for doc, text in zip(part["doc_id"], texts(part["text"]), strict=True):
                counts = Counter(words := text.split())
                found = votes(text, words, counts)
                known = labels.posterior.get(pattern(found), labels.prior)
                score = scorer(*hashed(words, counts)) if words else known
                signs = "".join("-0+"[v + 1] for v in found)
                rows.append((None if pd.isna(doc) else int(doc), signs, known, score, max(score, known) >= keep))
            made = pd.DataFrame(rows, columns=[c.split()[0] for c in _OUT.split(", ")])
            yield made.astype({"doc_id": "Int64"})

    rows = docs.select(F.col("doc_id").cast("bigint"), whole().alias("text"))
    return rows.mapInPandas(run, _OUT)


def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = weak_labels(docs)
    return judge(docs, labels, fit(docs, labels))
