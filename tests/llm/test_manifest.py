"""The manifest against a tree built in memory."""

import hashlib
import random
import zlib
from itertools import groupby

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import manifest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, idx int, hash string"


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(doc, text, lang, source, n):
    f = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    return _h(*map(f, (doc, source, lang, n, text)))


def _levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([_h(*out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
    return out


def _walk(levels, k, value):
    proof = ""
    for nodes in levels[:-1]:
        run = list(range(k // 8 * 8, min(k // 8 * 8 + 8, len(nodes))))
        proof += "".join(nodes[j] for j in run if j != k)
        value, k = _h(*[value if j == k else nodes[j] for j in run]), k // 8
    return proof, value


def _naive(rows):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    made = []
    for doc, text, lang, source, n in rows:
        hit = doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 3 == 0
        used = _leaf(doc, text.translate(lower), lang, source, n) if hit else None
        made.append((lang or "", lang is not None, doc is not None, doc or 0, _leaf(doc, text, lang, source, n), used))
    made.sort(key=lambda r: (r[1], r[0].encode(), r[2], r[3], r[4]))
    trees = [list(g) for _, g in groupby(made, key=lambda r: (r[1], r[0]))]
    levels = [_levels([r[4] for r in t]) for t in trees]
    top = _levels([x[-1][0] for x in levels])
    out = []
    for i, (tree, own) in enumerate(zip(trees, levels, strict=True)):
        for k, (_, _, has, doc, leaf, used) in enumerate(tree):
            p1, v = _walk(own, k, used or leaf)
            p2, v = _walk(top, i, v)
            out.append((doc if has else None, leaf, own[-1][0], top[-1][0], _h(p1, p2), v, v == top[-1][0]))
    return sorted(out, key=repr)


def _rows(n, langs):
    r = random.Random(n)
    made = [(i * 7 % 100003, f"Text {i} É" * r.randrange(4), r.choice(langs), r.choice(["a", "b", None]), i) for i in range(n)]
    return made + [(3, None, "en", "a", None), (None, "No id", "en", None, 1), (4, "", None, "a", 0), (4, "", None, "a", 0), (5, "Long " * 200_000, "xx", "a", 9)]


def test_against_one_tree(spark, monkeypatch):
    monkeypatch.setattr(manifest, "STEP", 2)  # more blocks and passes on few rows
    rows = _rows(1500, ["en"] * 6 + ["de", "fr", None]) + [(9, "t", f"l{i:02d}", None, 1) for i in range(20)]
    df = spark.createDataFrame([(*r, "t", 1, "x") for r in rows], SCHEMA).repartition(7)
    got = sorted((tuple(r) for r in manifest.manifest(df).collect()), key=repr)
    assert got == _naive(rows)
    assert {r[-1] for r in got} == {True, False}


def test_small_tables(spark):
    for rows in ([], [(1, "One", "en", "a", 3)], _rows(9, ["en"])):
        df = spark.createDataFrame([(*r, "t", 1, "x") for r in rows], SCHEMA)
        got = manifest.manifest(df)
        assert got.columns == [c.split()[0] for c in manifest._OUT.split(", ")]
        assert sorted((tuple(r) for r in got.collect()), key=repr) == (_naive(rows) if rows else [])


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 700), st.data())
def test_missing_is_enough_and_least(size, data):
    held = data.draw(st.sets(st.integers(0, size - 1), min_size=1, max_size=20))
    levels = _levels([_h(str(i)) for i in range(size)])
    asked = list(manifest.missing(held, size))
    path = manifest.Path({k: levels[0][k] for k in held}, size, {(at, k): levels[at][k] for at, k in asked})
    assert path.root == levels[-1][0]
    for k in held:
        proof, root = _walk(levels, k, "other")
        assert (path.tail(0, k), path.fold(k, "other")) == (proof, root)
    assert len(set(asked)) == len(asked)
    for at, k in asked:  # nothing below an asked node is held, so none could be derived
        assert not any(h >> (3 * at) == k for h in held)


def test_sql_on_benchmark_rows(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = manifest.op11_manifest(spark, folder)
    want = con.sql(manifest.ORACLE)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
