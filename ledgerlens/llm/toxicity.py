"""Toxicity of documents: boosted trees over dense features, calibrated by isotonic regression.

Three disjoint parts of the labelled rows are used, each a sample of bounded size: one teaches
the lexicon (words, and stems that stand for many invented endings), one the trees, one the
calibration. Labels, language, source and id are never features.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm.boosting import Boosted, Isotonic
from ledgerlens.llm.common import bounded, table, texts, whole

# Words that are abusive in any corpus, and words that address the reader.
SEED_WORDS = (
    "idiot", "idiots", "moron", "morons", "stupid", "loser", "losers", "pathetic", "worthless",
    "scum", "clown", "trash", "disgusting", "dumb", "garbage", "filthy", "vermin", "imbecile",
)
SECOND_PERSON = (
    "you", "your", "yours", "you're", "youre", "u", "ur", "du", "dich", "dir", "dein", "ihr",
    "tu", "te", "toi", "ton", "vous", "tú", "ti", "usted",
)
# Signs that stand for letters in disguised words.
DISGUISE = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", ".": "", "-": "", "_": ""})

SAMPLE = 20_000  # labelled rows of each part, at most
STEM = (4, 5, 6)
_WORD = re.compile(r"\w+")
_MASKED = re.compile(r"\b\w+[0-9@$!*._-]+\w+")
FEATURES = 16


@dataclass
class Lexicon:
    words: dict[str, float]
    stems: dict[str, float]


def learn_lexicon(rows: DataFrame, least: int = 4, odds: float = 2.5, entries: int = 4000) -> Lexicon:
    """Words and stems that mark rows (text, toxic); ``entries`` bounds what the model keeps."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(part["text"], part["toxic"], strict=True):
                found = set(_WORD.findall(text.lower()))
                stems = {"^" + w[:k] for w in found for k in STEM if len(w) >= k}
                seen[int(toxic)].update(found | stems)
            terms = list(seen[0].keys() | seen[1].keys())
            yield pd.DataFrame({"term": terms, "good": [seen[0][t] for t in terms], "bad": [seen[1][t] for t in terms]})

    totals = rows.agg(F.sum("toxic"), F.count(F.lit(1))).first()
    bad, good = int(totals[0] or 0), int((totals[1] or 0) - (totals[0] or 0))
    counts = rows.mapInPandas(run, "term string, good bigint, bad bigint").groupBy("term").agg(
        F.sum("good").alias("good"), F.sum("bad").alias("bad")
    )
    ratio = F.log((F.col("bad") + 0.5) / (bad + 1.0)) - F.log((F.col("good") + 0.5) / (good + 1.0))
    best = (
        counts.where(F.col("bad") >= least)
        .withColumn("odds", ratio)
        .where(F.col("odds") >= odds)
        .orderBy(F.desc(F.col("odds") * F.log1p("bad")), "term")
        .limit(entries)
        .collect()
    )
    words = {w: 4.0 for w in SEED_WORDS}
    words |= {r["term"]: float(r["odds"]) for r in best if not r["term"].startswith("^")}
    return Lexicon(words, {r["term"][1:]: float(r["odds"]) for r in best if r["term"].startswith("^")})


def features(text: str, lexicon: Lexicon) -> list[float]:
    """Dense features of one whole text; an empty text has zeros."""
    lower = text.lower()
    words = _WORD.findall(lower)
    n, length = len(words), len(text)
    if not n:
        return [0.0] * (FEATURES - 2) + [float(np.log1p(length)), 0.0]
    distinct = set(words)
    hit = distinct & lexicon.words.keys()
    stems = {w for k in STEM for w in distinct if w[:k] in lexicon.stems} - hit if lexicon.stems else set()
    masked = {
        m for m in _MASKED.findall(lower) if (clean := m.translate(DISGUISE)) != m and clean in lexicon.words
    }
    marked = hit | stems
    count = stem_count = near = run = longest = 0
    weight = top = 0.0
    if marked:
        last_you = last_hit = -100
        for i, w in enumerate(words):
            if w in SECOND_PERSON:
                last_you = i
                near += i - last_hit <= 5
            if w in marked:
                value = lexicon.words.get(w, 0.0) or max(lexicon.stems.get(w[:k], 0.0) for k in STEM)
                count += w in hit
                stem_count += w in stems
                weight += value
                top = max(top, value)
                near += i - last_you <= 5
                run = run + 1 if i - last_hit <= 8 else 1
                longest = max(longest, run)
                last_hit = i
    you = sum(w in SECOND_PERSON for w in words) if distinct & set(SECOND_PERSON) else 0
    caps = sum(map(str.isupper, text)) / length
    marks = text.count("!") + text.count("?")
    punctuation = length - sum(map(len, words)) - text.count(" ") - text.count("\n")
    return [
        float(count), count / n, float(len(hit)), float(stem_count), stem_count / n, float(len(stems)),
        weight, weight / n, top, near / n, float(longest), you / n,
        caps, marks / length + punctuation / length, float(np.log1p(n)), len(masked) / n,
    ]


@dataclass
class Model:
    lexicon: Lexicon
    trees: Boosted
    scale: Isotonic

    def scores(self, values: list[str]) -> np.ndarray:
        x = np.array([features(t, self.lexicon) for t in values], float).reshape(-1, FEATURES)
        return np.clip(self.scale(self.trees.margin(x)), 0.0, 1.0)


def fold(key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the text ``null``."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("null")).cast("binary")) % 5


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learn from rows with a label whose fold is not 0: folds 1 and 2 teach the lexicon, 3 the
    trees, 4 the calibration, each from at most ``sample`` rows chosen by a hash of the id.
    """
    known = labels.where("toxic is not null and doc_id is not null").groupBy(
        F.col("doc_id").cast("bigint").alias("doc_id")
    ).agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isin(0, 1)).withColumn("fold", fold())
    parts = []
    for folds in ((1, 2), (3,), (4,)):
        chosen = bounded(known.where(F.col("fold").isin(*folds)), sample, F.col("doc_id"))
        chosen = chosen.select(F.col("doc_id").alias("__id"), "toxic")
        text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole().alias("text"))
        # at most `sample` ids are broadcast, 16 bytes each
        parts.append(
            text.join(F.broadcast(chosen), F.col("doc_id") == F.col("__id")).select("text", "toxic")
        )
    lexicon = learn_lexicon(parts[0])

    def run(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in rows:
            yield pd.DataFrame(
                {"x": [features(t, lexicon) for t in texts(part["text"])], "y": part["toxic"].astype(float)}
            )

    def matrix(part: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        made = part.mapInPandas(run, "x array<double>, y double").sort("x", "y").toPandas()
        x = np.array(made["x"].tolist(), float).reshape(-1, FEATURES)
        return x, made["y"].to_numpy(float)

    x, y = matrix(parts[1])
    trees = Boosted().fit(x, y)
    x, y = matrix(parts[2])
    return Model(lexicon, trees, Isotonic().fit(trees.margin(x), y))


_OUT = "doc_id bigint, held_out boolean, score double, predicted int"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; null and empty texts are scored too.

    Repeated rows get equal scores, an empty table an empty result; other columns are not read.
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = model.scores(texts(part["text"]))
            yield pd.DataFrame(
                {"doc_id": part["doc_id"], "held_out": part["held_out"], "score": found, "predicted": (found >= 0.5).astype(int)}
            )

    rows = docs.select(F.col("doc_id").cast("bigint"), (fold() == 0).alias("held_out"), whole().alias("text"))
    return rows.mapInPandas(run, _OUT)


def keep_harmless(docs: DataFrame, model: Model, above: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score is below ``above``, columns unchanged."""
    judge = F.pandas_udf(lambda t: pd.Series(model.scores(texts(t))), "double")
    return docs.where(judge(whole()) < above)


def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return score(docs, fit(docs, table(spark, folder, "labels")))
