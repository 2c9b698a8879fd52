"""The order of the mixing stage in the packed sequences."""

import random
from collections import Counter

import corpus_pipeline

from ledgerlens.llm import packing


def test_prefixes_of_sequences_keep_the_mix(spark, tmp_path, monkeypatch):
    shard_chars, length = 20_000, 256
    r = random.Random(4)
    words = [f"word{i}" for i in range(300)]
    # ids and files go by source: any order but the mixed one gives prefixes of a single source
    rows = [(i, " ".join(r.choices(words, k=r.randint(20, 400))), "abc"[i // 200]) for i in range(600)]
    pack = packing.pack
    monkeypatch.setattr(packing, "pack", lambda d, t, **o: pack(d, t, length, shard_chars, **o))
    monkeypatch.setattr(packing, "SHARD_CHARS", shard_chars)
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    mixed = corpus_pipeline.mix_sources(spark, docs, "")
    mixed.write.parquet(str(tmp_path / "mixed"))
    mixed = spark.read.parquet(str(tmp_path / "mixed"))
    out = corpus_pipeline.pack_sequences(spark, mixed, "").collect()

    source = {d: s for d, _, s in rows}
    total = sum(x.length for x in out)
    tokens = {x.doc_id: x.doc_tokens for x in out}
    assert total == sum(tokens.values()) and len(tokens) == 600
    share = Counter()
    for d, n in tokens.items():
        share[source[d]] += n / total
    ran, done = Counter(), 0
    largest = max(Counter(x.sequence_id >> 31 for x in out).values())
    by_sequence, of_shard = {}, Counter()
    for x in out:
        by_sequence.setdefault(x.sequence_id, []).append(x)
        of_shard[x.sequence_id >> 31] += x.length
    assert len(of_shard) > 20 and largest < len(out) / 10
    # a stretch, and the blocks of the mixing stage that may be begun: 16 documents of each source
    bound = max(of_shard.values()) + 3 * 16 * max(tokens.values())
    assert bound < total / 4
    for at in sorted(by_sequence):
        for x in by_sequence[at]:
            ran[source[x.doc_id]] += x.length
            done += x.length
        assert all(abs(ran[s] - done * p) <= bound for s, p in share.items())
