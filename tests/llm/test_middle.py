"""Fill-in-middle against a plain version, round trips, and rows that are odd."""

import hashlib
import random
import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm import middle

SCHEMA = "doc_id bigint, text string, row string, frame int, body string, n double"


def _plain(doc, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    h = hashlib.sha256(f"1:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(h[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc, n, "plain", None, None, sha(text), sha(text)
    if h[3] % 100 < 20:
        return doc, n, "spm", len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}"), sha(text)
    return doc, n, "psm", len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}"), sha(text)


def _rows():
    r = random.Random(1)
    made = [(i, "".join(r.choice(["word", "Ab", " ", "\n", "é", "中", "<", "<S", "P>", "7", "😀"]) for _ in range(r.randrange(400)))) for i in range(300)]
    made += [(400, None), (401, ""), (402, "x" * 100_000), (403, "a b" * 160_000), (404, "é" * 30_000), (None, "some text here"),
             (405, "y" * 8190 + "<P>" + "z" * 10), (406, "y" * 8191 + "< P>" + "<"), (5, "other text, same id"), (7, made[7][1])]
    return made


def test_against_plain_version(spark):
    rows = _rows()
    df = spark.createDataFrame([(d, t, "clash", 3, "b", 0.5) for d, t in rows], SCHEMA).repartition(6)
    got = sorted((tuple(r) for r in middle.digests(df).collect()), key=repr)
    assert got == sorted((_plain(*r) for r in rows), key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert middle.digests(df.limit(0)).count() == 0 and middle.fill_in_middle(df.limit(0)).count() == 0
    parts = middle.fill_in_middle(df.where("doc_id >= 8")).collect()
    texts = {}
    for p in sorted(parts, key=lambda p: (p.doc_id, p.part)):
        texts[p.doc_id] = texts.get(p.doc_id, "") + p.text
    want = {d: _plain(d, t)[5] for d, t in rows if d is not None and d >= 8}
    assert {d: hashlib.sha256(t.encode()).hexdigest() for d, t in texts.items()} == want
    assert max(len(p.text) for p in parts) <= middle.FRAME


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB<>PSM é\n", max_size=60), st.integers(0, 70), st.integers(0, 70), st.sampled_from(["psm", "spm"]))
def test_round_trip_on_tiny_frames(text, a, b, form):
    if any(m in text for m in middle.MARKS):
        return
    frames = middle.Frames.of(iter([text[:7], text[7:]]), 4)
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    assert frames.units[-1] == len(units)
    first, second = sorted((min(a, len(units)), min(b, len(units))))
    cuts = frames.position(first), frames.position(second)
    assert cuts == (len("".join(units[:first])), len("".join(units[:second])))
    output = middle.Frames.of(middle.rearranged(frames, form, *cuts), 4)
    assert "".join(middle.restored(output, form)) == text


def test_cuts_open_single_frames(monkeypatch):
    frames = middle.Frames.of(["word and " * 5000])
    opened = []
    monkeypatch.setattr(middle.Frames, "text", lambda self, k, f=middle.Frames.text: opened.append(k) or f(self, k))
    frames.position(9000)
    assert len(opened) == 1
    opened.clear()
    assert "".join(frames.read(9, 14)) == "word " and opened == [0]


def test_sql_on_benchmark_rows(spark):
    folder = "/root/testdata/sf0.001"
    pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    got = middle.op13_middle(spark, folder)
    want = con.sql(middle.ORACLE)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
