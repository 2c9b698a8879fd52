"""Repeated passages against brute force: the index alone, and whole tables."""

import hashlib
import random
import re

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import passages

SCHEMA = "doc_id bigint, text string, block string, at int, words string, n int"


def _index(pieces):
    """Pieces as (place of the first word, words)."""
    text = np.array([w for _, p in pieces for w in [*p, 0]], np.int64)
    place = np.array([x for s, p in pieces for x in [*range(s, s + len(p)), 10**6]], np.int64)
    sizes = np.array([len(p) for _, p in pieces])
    starts = np.cumsum(sizes + 1) - sizes - 1
    return text, place, starts, sizes


@settings(max_examples=120, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=40), min_size=1, max_size=12), st.sampled_from([3, 8, 20]), st.randoms())
def test_matching_statistics(pieces, depth, r):
    order = list(range(len(pieces)))
    r.shuffle(order)
    pieces = [(100 * k, p) for k, p in zip(order, pieces, strict=True)]
    text, place, starts, sizes = _index(pieces)
    got = passages.FmIndex(text, place, depth).matching(starts, sizes)
    seen = {}
    for s, p in pieces:
        for i in range(len(p)):
            for j in range(i + 1, min(len(p), i + depth) + 1):
                seen.setdefault(tuple(p[i:j]), []).append(s + i)
    for (s, p), begin in zip(pieces, starts.tolist(), strict=True):
        for i in range(len(p)):
            best = max((j - i for j in range(i + 1, min(len(p), i + depth) + 1) if min(seen[tuple(p[i:j])]) < s + i), default=0)
            assert got[begin + i] == best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=300))
def test_rank(symbols):
    made = passages.WaveletMatrix(np.array(symbols), 10)
    at = np.arange(len(symbols) + 1)
    for s in range(10):
        assert made.rank(np.full(len(at), s), at).tolist() == [symbols[:i].count(s) for i in at.tolist()]


def _naive(rows):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    first, gone = {}, [set() for _ in rows]
    for k in order:
        w = words[k][1]
        for i in range(len(w) - 19):
            if first.setdefault(tuple(w[i : i + 20]), (rows[k], i)) != (rows[k], i):
                gone[k].update(range(i, i + 20))
    out = []
    for k, (d, w) in enumerate(words):
        kept = " ".join(x for i, x in enumerate(w) if i not in gone[k])
        out.append((d, len(w), len(gone[k]), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def _rows():
    r = random.Random(3)
    fresh = lambda n: [f"w{r.randrange(4000)}" for _ in range(n)]
    passage, phrase, line = fresh(60), fresh(15), fresh(25)
    rows = []
    for i in range(260):
        w = fresh(r.randrange(5, 150))
        if i % 3 == 0:  # a frequent phrase in ever new surroundings
            at = r.randrange(len(w))
            w[at:at] = phrase
        if i % 4 == 0:
            at = r.randrange(len(w))
            w[at:at] = passage
        if i % 5 == 0:
            w += line * 2
        rows.append((i * 3, r.choice([" ", "\n", "\t "]).join(w)))
    near = fresh(300)
    rows += [(1000 + i, " ".join(x if r.random() > 0.02 else "odd" for x in near)) for i in range(12)]
    rows += [(2000 + i, " ".join(near)) for i in range(9)]
    rows += [(7, None), (8, ""), (10, "same " * 3000), (11, "same " * 30), (None, " ".join(passage)), (13, "é中\xa0x " * 40)]
    for i in range(12):  # texts that repeat themselves, at all distances
        unit = fresh(i + 1)
        rows.append((3000 + i, " ".join((fresh(5) + unit * (60 // len(unit)))[: 45 + i] + fresh(i))))
    return rows + [rows[0], rows[0], (14, " ".join(fresh(30000))), (16, "a b " * 9 + "a b")]


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(passages, "BUCKET_BYTES", 100_000)
    rows = _rows()
    df = spark.createDataFrame([(d, t, "b", 1, "w", 2) for d, t in rows], SCHEMA).repartition(6)
    want = _naive(rows)
    assert sum(x[2] for x in want) > 5000
    assert sorted((tuple(x) for x in passages.removed(df).collect()), key=repr) == want
    assert passages.removed(df.limit(0)).count() == 0


def test_wide_anchors_and_small_shards(spark, monkeypatch):
    made = passages._windows
    monkeypatch.setattr(passages, "_windows", lambda blocks: made(blocks, wide=10, shard_words=900))
    rows = _rows()
    df = spark.createDataFrame([(d, t, "b", 1, "w", 2) for d, t in rows], SCHEMA).repartition(9)
    assert sorted((tuple(x) for x in passages.removed(df).collect()), key=repr) == _naive(rows)


def test_texts_that_stay(spark):
    w = [f"x{i}" for i in range(30)]
    rows = [(1, " ".join(w)), (2, "before " + "\n".join(w[2:27]) + " after")]
    df = spark.createDataFrame([(d, t, "b", 1, "w", 2) for d, t in rows], SCHEMA)
    assert {x.doc_id: x.text for x in passages.without_passages(df).collect()} == {1: " ".join(w), 2: "before after"}


def test_sql_on_benchmark_rows(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = passages.op12_passages(spark, folder)
    want = con.sql(passages.ORACLE)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
