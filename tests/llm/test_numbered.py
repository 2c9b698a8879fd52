"""Rows keep their places where a later scan is split otherwise."""

from collections import Counter

import pytest

from ledgerlens.llm import mixing, warc

_SPLIT = ("spark.sql.leafNodeDefaultParallelism", "spark.sql.files.maxPartitionBytes")


@pytest.fixture
def other_splits(spark):
    """Makes scans planned later read their files in other splits."""

    def change():
        spark.conf.set(_SPLIT[0], "3")
        spark.conf.set(_SPLIT[1], "2k")

    yield change
    for key in _SPLIT:
        spark.conf.unset(key)


def test_mixed_rows_survive_other_splits(spark, tmp_path, monkeypatch, other_splits):
    path = str(tmp_path / "docs")
    rows = [(i, "abc"[i % 3], f"text {i} " * 5) for i in range(6000)]
    spark.createDataFrame(rows, "doc_id bigint, source string, text string").repartition(6).write.option(
        "parquet.block.size", 4096
    ).parquet(path)
    made = mixing.mix

    def late(docs, **options):
        places = made(docs, **options)
        other_splits()
        return places

    monkeypatch.setattr(mixing, "mix", late)
    mixed = mixing.in_mixed_order(spark.read.parquet(path)).collect()
    assert Counter((r.doc_id, r.source, r.text) for r in mixed) == Counter(rows)


def test_records_survive_other_splits(spark, tmp_path, monkeypatch, other_splits):
    path = str(tmp_path / "pages")
    rows = [(i, f"u{i}", f"<p>{i // 2}</p>" * 5) for i in range(6000)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(6).write.option(
        "parquet.block.size", 4096
    ).parquet(path)
    decide = warc._decide

    def late(pages, least):
        decided = decide(pages, least)
        other_splits()
        return decided

    monkeypatch.setattr(warc, "_decide", late)
    got = warc.archived(spark.read.parquet(path), str(tmp_path / "archive")).collect()
    assert all(r.intact for r in got)
    want = Counter((i, len(html), "revisit" if i % 2 else "response", i - 1 if i % 2 else None) for i, _, html in rows)
    assert Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in got) == want
