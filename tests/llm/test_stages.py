"""Near copies in the pipeline: one row of each SimHash group, against all pairs."""

import random
import time
import zlib

import corpus_pipeline
import numpy as np
import xxhash

from ledgerlens.llm import pii, quality, simhash

SCHEMA = "doc_id bigint, text string, row string, first int, key int, id string"


def _mark(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_stage_against_all_pairs(spark):
    r = random.Random(5)
    made = []
    for n in (30, 200, 600):
        for _ in range(15):
            base = [f"w{r.randrange(3000)}" for _ in range(n)]
            made += [" ".join(base)]
            made += [" ".join(f"n{r.randrange(99)}" if r.random() < share else w for w in base) for share in (0.003, 0.01, 0.1)]
    r.shuffle(made)
    rows = list(enumerate(made)) + [(900, None), (901, ""), (902, " \n"), (903, "w1 " * 50000), (904, "W1 " * 50000)]
    df = spark.createDataFrame([(d, t, "x", 1, 2, "y") for d, t in rows], SCHEMA).repartition(5)
    marks = {d: _mark(t) for d, t in rows}
    up = {d: d for d in marks}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(marks)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (marks[a] ^ marks[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    kept = corpus_pipeline.drop_near_copies(spark, df, "")
    assert kept.columns == df.columns
    assert sorted(x.doc_id for x in kept.collect()) == [d for d in ids if find(d) == d]


def test_only_rows_of_one_group_replace_each_other(spark):
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    rows = [(1, a), (1, b), (2, b), (3, a), (1, a), (None, a), (None, a)]
    df = spark.createDataFrame([(d, t, "x", 1, 2, "y") for d, t in rows], SCHEMA)
    got = sorted(((x.doc_id, x.text) for x in simhash.keep_one(df).collect()), key=repr)
    assert got == [(1, a), (1, b), (None, a), (None, a)]
    assert simhash.keep_one(df.limit(0)).count() == 0


def test_spans_of_a_long_list_of_contacts():
    r = random.Random(9)
    spans = [(s, r.randrange(4), s + r.randrange(1, 40)) for s in (r.randrange(5000) for _ in range(300))]
    taken = pii.Taken(spans[:150])
    for one in spans:
        assert taken.overlaps(one) == any(one[0] < end and start < one[2] for start, _, end in spans[:150])
    greedy, kept = pii.Taken(), []
    for one in spans:
        hit = any(one[0] < end and start < one[2] for start, _, end in kept)
        assert greedy.overlaps(one) == hit
        if not hit:
            kept.append(one)
            greedy.add(one)

    class Trees:
        def margin(self, x):
            return np.arange(len(x)) % 7 / 7

    text = "".join(f"name{i} at host{i}.org, call 0{i:09d} or +1 555 {i:07d}; 10.0.{i % 256}.1\n" for i in range(40_000))
    model = pii.Model(Trees(), lambda m: m, 0.5)
    begin = time.perf_counter()
    good, found = model.spans(text)
    assert len(good) >= 80_000 and set(good) <= set(found) and time.perf_counter() - begin < 60


def test_shape_of_a_whole_word():
    slots = quality.Hashed.slots
    assert slots("ab12-X") % quality.SLOTS == slots("xy77-Q") % quality.SLOTS
    long = "a1" * 300
    assert slots(long) % quality.SLOTS != slots(long + "-") % quality.SLOTS
    assert slots("x1" * 300) % quality.SLOTS == slots(long) % quality.SLOTS
    assert slots("") % quality.SLOTS == zlib.crc32(b"#") % quality.SLOTS
