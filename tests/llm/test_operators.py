"""Each operator against a brute-force version, and on rows that are null, empty, long or repeated."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import merkle, mixing, neighbours, packing, pii, quality, repeats, simhash, toxicity, warc

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, fp int"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()


def _text(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(["", "s", "ed"]) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    long = _text(1, 30000)
    base = _text(2, 400)
    made = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base.replace("alpha", "Alpha", 1), "en", "b"),
        (4, base + " tail", "en", None), (5, None, None, "a"), (6, "", "en", "a"), (7, long, "en", "b"),
        (8, long[50000:90000] + " other", "en", "b"), (9, "mail a.b@c.org call +1 (555) 123-4567 from 10.0.0.1 card 4111 1111 1111 1111", "en", "a"),
        (None, _text(3, 80), None, None), (1, base, "en", "a"), (10, "Äö ü\n\nzwei 中文", "de", "c"), (11, "x", "en", "c"),
    ]
    made += [(20 + i, _text(100 + i, 60 + i), "en", "a" if i % 3 else "c") for i in range(40)]
    return [(d, t, lang, s, -1, "clash", 0) for d, t, lang, s in made]


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents")
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def _naive_simhash(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_against_all_pairs(docs, rows, none):
    got = Counter((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect())
    marks = [(d, _naive_simhash(t)) for d, t, *_ in rows]
    root = list(range(len(marks)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i][1] ^ marks[j][1]).bit_count() <= 4:
                root[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (d, _) in enumerate(marks):
        groups[find(i)].append(d)
    first = {g: min((x for x in v if x is not None), default=None) for g, v in groups.items()}
    assert got == Counter((d, f"{m:016x}", first[find(i)]) for i, (d, m) in enumerate(marks))
    assert simhash.near_duplicates(none).count() == 0


def test_simhash_links_on_random_fingerprints(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(60)]
    marks = set(base)
    for b in base:
        for _ in range(8):
            x = b
            for bit in r.sample(range(64), r.randint(1, 6)):
                x ^= 1 << bit
            marks.add(x)
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    fps = spark.createDataFrame([(x,) for x in signed], "fp bigint")
    linked = {
        frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 4
    }
    got = {frozenset((x.a, x.b)) for x in simhash.links(fps).collect()}
    assert got <= linked

    def classes(pairs):
        up = {}

        def find(x):
            while up.get(x, x) != x:
                x = up[x]
            return x

        for a, b in map(tuple, pairs):
            up[find(a)] = find(b)
        out = defaultdict(set)
        for x in signed:
            out[find(x)].add(x)
        return {frozenset(v) for v in out.values()}

    assert classes(got) == classes(linked)
    for parts in (2, 3, 4):
        groups = simhash.bit_parts(10, np.eye(64) * 5, parts)
        assert sorted(b for g in groups for b in g) == list(range(64))
        assert sum(simhash.thresholds(1000, [len(g) for g in groups], [1e-5] * parts, 4)[1]) == 4 - parts + 1


def test_keep_one_row_of_each_group(docs, none):
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and simhash.keep_one(none).count() == 0
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and not {2, 3, 6} & set(ids) and None in ids and {5, 7, 20} <= set(ids)


def _naive_spans(text):
    import re

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(d := re.sub(r"\D", "", m)) <= 19 and pii.luhn(d)),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub(r"\D", "", m)) <= 15),
    ]
    found = [
        (m.start(), k, m.end()) for k, (_, rule, good) in enumerate(rules) for m in re.finditer(rule, text) if good(m.group())
    ]
    return sorted(found)


def test_strict_spans_equal_the_plain_patterns():
    r = random.Random(3)
    parts = ["a@b.c", "x@", "@y.z", "1.2.3.4", "1.2.3.4.5.6.7.8", "300.1.1.1", "+1 (555) 123-4567", "4111 1111 1111 1111",
             "4111111111111112", "+12", "..", "a.b@c", "é@ü.de", "q+w@e-r.t.u.i", " ", "-", "9" * 30, "٣٤"]
    for _ in range(3000):
        text = "".join(r.choice(parts) + r.choice(["", " ", ".", "@"]) for _ in range(r.randint(1, 8)))
        assert pii.strict(text)[0] == _naive_spans(text), text
    assert pii.strict("7" * 300_000)[0] == [] and pii.strict("a@" * 100_000)[0] == []


def test_personal_data_counts_and_masks(docs, none):
    model = pii.fit(docs)
    got = {r.doc_id: r for r in pii.find(docs, model).collect()}
    one = got[9]
    assert (one.n_email, one.n_ip, one.n_card, one.n_phone) == (1, 1, 1, 1)
    base = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in pii.strict(docs.where("doc_id = 9").first().text)[0])
    assert one.base_sha256 == hashlib.sha256(base.encode()).hexdigest() and set(base.split(",")) <= set(one.spans.split(","))
    assert got[5].spans == "" and pii.find(none, model).count() == 0
    clean = {r.doc_id: r for r in pii.redact(docs, model).collect()}
    assert clean[9].text == "mail [EMAIL] call [PHONE] from [IP] card [CARD]" and clean[9].n_chars == len(clean[9].text)
    assert clean[5].text is None and clean[20].score == "clash"


def test_packing_places_every_token_once(docs, rows, none):
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    pieces = packing.pack(docs.where("doc_id <> 1 or doc_id is null"), packing.tokenizer_path(), shard_chars=40_000).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for doc, text, *_ in rows:
        if doc == 1:
            continue
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        at = 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            at += p.length
            assert p.ids_crc32 == zlib.crc32(np.array(ids[p.start : at], "<u4").tobytes())
        assert at == len(ids)
    for held in by_sequence.values():
        at = 0
        for p in sorted(held, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 4096
    assert packing.pack(none, packing.tokenizer_path()).count() == 0


def test_assignment_is_balanced_and_tight():
    r = np.random.default_rng(1)
    sizes = r.integers(1, 1500, 4000)
    placed = packing.assign(sizes, 4096)
    fill, whole = Counter(), Counter()
    for piece, _, n, to in placed:
        fill[to] += n
        whole[piece] += n
    assert max(fill.values()) <= 4096 and [whole[i] for i in range(len(sizes))] == sizes.tolist()
    assert len(fill) == -(-int(sizes.sum()) // 4096) and packing.assign(np.zeros(0, np.int64), 4096) == []


@pytest.mark.parametrize("text", ["It's a <|endoftext|> test", "Ünïcödé ΣΑΣ İx ﬁ é 中文 ½", "a\tb\x1c\xa0c", "don't 'S O'Re", "  \r\n", "İ̇"])
def test_ids_equal_the_tokenizer(text):
    ids = packing.ids_of(packing.tokenizer_path())
    assert ids(text).tolist() == ids.tokenizer.encode(text, add_special_tokens=False).ids


def test_archive_round_trip(spark, tmp_path):
    long = "<p>" + "äöü" * 80_000
    pages = [(3, "u3", "same"), (1, "u1", "same"), (2, "u2\r\nX: y", long), (4, None, long), (5, "e", None), (6, "e", ""), (None, "n", "same"), (1, "u1", "same")]
    df = spark.createDataFrame([(*p, 1, "c") for p in pages], "page_id bigint, url string, html string, row_id int, payload string")
    got = warc.archived(df, str(tmp_path / "a")).collect()
    assert all(r.intact for r in got) and len(got) == len(pages)
    import base64

    want = Counter()
    first = {}
    for page, _, html in pages:
        body = (html or "").encode()
        if page is not None:
            first[body] = min(first.get(body, page), page)
    seen = set()
    for page, _, html in sorted(pages, key=lambda p: (p[0] is None, p[0] or 0)):
        body = (html or "").encode()
        answer = first[body] == page and body not in seen
        seen |= {body} if answer else set()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        want[(page, len(body), digest, "response" if answer else "revisit", None if answer else first[body])] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    chunks = spark.read.parquet(str(tmp_path / "a"))
    assert chunks.agg(F.max(F.length("data"))).first()[0] < warc.CHUNK + 2000
    name = chunks.where("chunks > 1").first().record_id
    record = b"".join(warc.payload_chunks(spark, str(tmp_path / "a"), name))
    head, _, rest = record.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\n") and rest == long.encode() + b"\r\n\r\n"
    assert warc.archived(df.limit(0), str(tmp_path / "b")).count() == 0


def _naive_repeats(texts):
    order = sorted(set(texts), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    seen, out = set(), {}
    for doc, key, text in order:
        data = text.encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 99):
            if data[s : s + 100] in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(data[s : s + 100])
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[doc, key] = (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def test_repeats_against_brute_force(spark, docs, none):
    texts = [(r.doc_id, r.k, r.t) for r in docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("k"), F.coalesce("text", F.lit("")).alias("t")).collect()]
    texts += [(100 + i, i, t) for i, t in enumerate(["ab" * 500, "a" * 1000, "x" + "ab" * 300, _text(2, 400)[:99], _text(2, 400)[:100]])]
    more = spark.createDataFrame([(d, t) for d, k, t in texts[-5:]], "doc_id bigint, text string")
    got = repeats.removed(docs.select("doc_id", "text").union(more))
    want = _naive_repeats([(d, k, t) for d, k, t in texts])
    found = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect())
    assert found == Counter((d, *want[d, k]) for d, k, _ in texts)
    assert repeats.removed(none).count() == 0
    left = {r.doc_id: r.text for r in repeats.without_repeats(docs).collect()}
    assert left[2] == "" and left[20] == _text(100, 60)


def test_mixing_stays_within_a_block_of_each_share(docs, none):
    out = mixing.mix(docs, weights={"a": 0.5, "b": 0.3, "c": 0.15, None: 0.05}, period=100, block=1).collect()
    assert len(out) == docs.count() and len({r.place for r in out}) == len(out)
    assert all(r.release <= r.slot < r.deadline for r in out)
    steady = sorted((r for r in out if r.balanced), key=lambda r: r.slot)
    ran = Counter()
    for t, r in enumerate(steady):
        assert r.slot == t
        ran[r.source] += 1
        for s, p in {(r.source, r.parts) for r in out}:
            assert abs(ran[s] - (t + 1) * p / 100) < 1
    assert mixing.mix(none).count() == 0
    mixed = mixing.in_mixed_order(docs)
    assert mixed.columns == docs.columns
    assert Counter(map(tuple, mixed.collect())) == Counter(map(tuple, docs.collect()))


def test_quality_separates_junk_from_prose(spark, none):
    good = [(i, _text(i, 120), "en") for i in range(200)]
    junk = [(1000 + i, " ".join(w + "%%%" for w in _text(i, 120).split()), "en") for i in range(30)]
    junk += [(2000 + i, _text(i, 120).upper().replace(" ", "!! "), "en") for i in range(20)]
    df = spark.createDataFrame([*good, *junk, (None, None, None), (5, "", "en")], "doc_id bigint, text string, votes string")
    labels = quality.weak_labels(df)
    out = quality.judge(df, labels, quality.fit(df, labels)).collect()
    assert len(out) == len(good) + len(junk) + 2
    kept = {r.doc_id for r in out if r.keep}
    assert {d for d, *_ in good} <= kept and len(kept & {d for d, *_ in junk}) <= 2
    assert quality.judge(none, labels, quality.fit(none, quality.weak_labels(none))).count() == 0
    assert quality.unpatterned(quality.pattern([1, 0, -1] * 3 + [1])) == [1, 0, -1] * 3 + [1]


def test_toxicity_on_held_out_rows(spark, none):
    bad = "you utter moron you pathetic loser"
    made = [(i, _text(i, 80) + (f" {bad} " if i % 5 == 0 else " ") + _text(-i, 40), int(i % 5 == 0)) for i in range(900)]
    df = spark.createDataFrame([(d, t) for d, t, _ in made] + [(5000, None), (5001, ""), (None, "x")], "doc_id bigint, text string")
    labels = spark.createDataFrame([(d, 1, y) for d, _, y in made] + [(3, 1, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(df, labels)
    out = toxicity.score(df, model).collect()
    truth = {d: y for d, _, y in made}
    held = [r for r in out if r.held_out and r.doc_id in truth]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert len(out) == len(made) + 3 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)
    kept = toxicity.keep_harmless(df, model)
    assert kept.columns == df.columns and kept.count() == sum(r.score < 0.5 for r in out)
    empty = toxicity.fit(none, labels.limit(0))
    assert toxicity.score(df, empty).count() == len(out) and toxicity.score(none, empty).count() == 0


def test_neighbours_recall_and_ties(spark):
    r = np.random.default_rng(2)
    x = r.normal(size=(1500, 16)).astype(np.float32)
    x[100:160] = x[100]
    made = [(i, [float(v) for v in x[i]], 0) for i in range(len(x))]
    odd = [(9000, None, 0), (9001, [0.0] * 16, 0), (9002, [float("nan")] * 16, 0), (9003, [1.0, None] * 8, 0), (9004, [1.0, 2.0], 0), (None, [1.0] * 16, 0)]
    df = spark.createDataFrame(made + odd, "vec_id bigint, embedding array<float>, hash int")
    got = defaultdict(list)
    for n in neighbours.nearest(df, F.col("vec_id") % 20 == 0, shard=600).orderBy("query_id", "rank").collect():
        got[n.query_id].append((n.vec_id, n.score))
    hits = 0
    full = x.astype(np.float64)
    for q in range(0, 1500, 20):
        value = full @ full[q]
        value[q] = -np.inf
        best = np.lexsort((np.arange(len(x)), -value))[:20]
        hits += len(set(best.tolist()) & {v for v, _ in got[q]})
        assert [s for _, s in got[q]] == pytest.approx(sorted((value[v] for v, _ in got[q]), reverse=True)) and len({v for v, _ in got[q]}) == 20
    assert hits / (75 * 20) >= 0.95 and len(got) == 75
    assert [v for v, _ in got[100]][:19] == list(range(101, 120)) or got[100][0][1] > value[101]
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_merkle_edits_and_order(docs, rows, none):
    got = merkle.with_edits(docs, block_chars=20_000).collect()
    assert len(got) == len(rows) and merkle.with_edits(none).count() == 0
    key = {(d, t): k for d, t, k in docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit("")))).collect()}
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), key[r[0], r[1]]))
    want = Counter()
    for one, after in zip(order, order[1:] + order[:1], strict=True):
        text, other = one[1] or "", after[1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        mark = merkle.fingerprint(text)
        want[(one[0], len(text), hashlib.sha256(edited.encode()).hexdigest(), mark, merkle.fingerprint(edited), merkle.likeness(mark, merkle.fingerprint(edited)), merkle.likeness(mark, merkle.fingerprint(other)))] += 1
    assert Counter(map(tuple, got)) == want
    single = merkle.with_edits(docs.where("doc_id = 7")).collect()
    assert len(single) == 1 and single[0].near_next == 1.0


def test_merkle_locates_an_edit():
    text = "\n\n".join("\n".join(_text(10 * s + p, 30) for p in range(4)) for s in range(3))
    lines = text.split("\n")
    lines[6] = lines[6] + " changed"  # section 1, paragraph 1
    a, b = merkle.fingerprint(text), merkle.fingerprint("\n".join(lines))
    assert merkle.differing(a, b) == [(1, 1)] and 0.8 < merkle.likeness(a, b) < 1
    assert merkle.fingerprint(text) == a and merkle.differing(a, a) == [] and merkle.likeness(a, a) == 1
    assert merkle.likeness(merkle.fingerprint(""), a) == 0 and merkle.fingerprint("a b") != merkle.fingerprint("a  b")


def test_pipeline_on_a_small_folder(spark, docs, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20, 40)], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    current = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, current, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
        path = f"{folder}/{name}"
        out.write.parquet(path)
        current = spark.read.parquet(path)
    assert current.count() >= 40 and corpus_pipeline.run(spark, folder).count() == current.count()
