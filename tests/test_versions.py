"""Versioned tables, feeds of changes, marts kept from feeds, and deduplication in two ways."""

import os
import random
import shutil
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import versioned as v
from ledgerlens.plans import incremental
from ledgerlens.streaming import merge as streams

SCHEMA = "k bigint, valor bigint, seq int, ano int, mes string"
KEYS, PARTS = ["k"], ["ano", "mes"]


def _df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _table(spark, path, version=None):
    schema = _df(spark, []).schema
    return sorted(map(tuple, v.read(spark, path, schema, PARTS, version).collect()))


def _gone(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "k bigint")


def test_random_batches_against_a_dictionary(spark, tmp_path):
    path, r, model, states = str(tmp_path / "t"), random.Random(4), {}, []
    schema = _df(spark, []).schema
    for _ in range(5):
        rows = [(r.randrange(60), r.randrange(9), 0, r.choice([2020, 2021, None]), r.choice(["1", "a b/c"])) for _ in range(25)]
        rows = list({x[0]: x for x in rows}.values())
        gone = [r.randrange(60) for _ in range(8)]
        number = v.commit(spark, path, _df(spark, rows + [(None, 1, 1, 1, "1")]), KEYS, PARTS, deletes=_gone(spark, gone))
        for k in gone:
            model.pop(k, None)
        model.update({x[0]: x for x in rows})
        states.append(sorted(model.values(), key=lambda x: x[0]))
        assert number == len(states)
        assert sorted(_table_any(spark, path), key=lambda x: x[0]) == states[-1]
        assert v.commit(spark, path, _df(spark, rows), KEYS, PARTS) == number  # a replay makes no version
    for number, state in enumerate(states, 1):
        assert sorted(_table_any(spark, path, number), key=lambda x: x[0]) == state
    feed = v.changes(spark, path, schema)
    assert sorted(map(tuple, v.replayed(feed, KEYS).collect()), key=lambda x: x[0]) == states[-1]
    moved = {}  # adding and subtracting feed rows gives the totals of the table
    for x in v.signed(v.changes(spark, path, schema, since=2)).collect():
        moved[x.ano] = moved.get(x.ano, 0) + x._sign * x.valor
    for year in (2020, 2021, None):
        total = lambda s: sum(x[1] for x in s if x[3] == year)  # noqa: E731, B023
        assert moved.get(year, 0) == total(states[-1]) - total(states[1])
    v.reindex(spark, path, schema, KEYS, PARTS)
    v.vacuum(spark, path, PARTS)
    assert sorted(_table_any(spark, path), key=lambda x: x[0]) == states[-1]
    one = states[-1][0]
    changed = (one[0], 99, 0, 2030, "z")
    v.commit(spark, path, _df(spark, [changed]), KEYS, PARTS)
    assert sorted(_table_any(spark, path), key=lambda x: x[0]) == [changed, *states[-1][1:]]


def _table_any(spark, path, version=None):
    return [tuple(x) for x in v.read(spark, path, _df(spark, []).schema, PARTS, version).collect()]


def test_newer_stored_rows_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    v.commit(spark, path, _df(spark, [(1, 10, 5, 2020, "1"), (2, 20, 5, 2020, "1")]), KEYS, PARTS, sequence=["seq"])
    v.commit(spark, path, _df(spark, [(1, 11, 4, 2020, "1"), (2, 21, 6, 2021, "1")]), KEYS, PARTS, sequence=["seq"])
    assert _table(spark, path) == [(1, 10, 5, 2020, "1"), (2, 21, 6, 2021, "1")]


def test_a_batch_reads_and_rewrites_only_the_folders_it_hits(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = [(i, i, 0, 2020 + i % 10, str(i % 2)) for i in range(1000)]
    v.commit(spark, path, _df(spark, rows), KEYS, PARTS)
    read, files = v.read, []

    def seen(*args, **more):
        df = read(*args, **more)
        files.extend(df.inputFiles())
        return df

    monkeypatch.setattr(v, "read", seen)
    batch = [(i, -1, 0, 2023, "1") for i in range(3, 100, 10)]  # 1 %, all of one period, some move there
    v.commit(spark, path, _df(spark, [*batch, (4, 0, 0, 2023, "1")]), KEYS, PARTS)
    periods = {tuple(f.split("/")[-3:-1]) for f in files}
    assert periods == {("ano=2023", "mes=1"), ("ano=2024", "mes=0")}
    rewritten = {p for p, _, names in os.walk(f"{path}/rows/version=2") if any(n.endswith(".parquet") for n in names)}
    assert {tuple(p.split("/")[-2:]) for p in rewritten} == periods


@pytest.mark.parametrize("step", ["_index", "_by_period", "periods"])
def test_readers_and_crashes_between_steps(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    old = [(i, i, 0, 2020, str(i % 3)) for i in range(30)]
    v.commit(spark, path, _df(spark, old), KEYS, PARTS)
    whole, calls = getattr(v, step), []

    def dies(*args, **more):
        if step == "periods" and len(calls) < 2:  # reads come first, the manifest last
            calls.append(1)
            return whole(*args, **more)
        monkeypatch.setattr(v, step, whole)
        assert _table(spark, path) == old  # a reader now sees the table as it was
        raise RuntimeError("stopped")

    monkeypatch.setattr(v, step, dies)
    batch = [(i, 100, 0, 2021, "x") for i in range(5)]
    with pytest.raises(RuntimeError):
        v.commit(spark, path, _df(spark, batch), KEYS, PARTS)
    assert _table(spark, path) == old and v.newest(spark, path) == 1
    assert v.commit(spark, path, _df(spark, batch[:3]), KEYS, PARTS) == 2
    assert _table(spark, path) == batch[:3] + old[3:]
    assert len(_table(spark, path, 1)) == 30


def test_kept_totals_rewrite_only_touched_folders(spark, tmp_path):
    path = str(tmp_path / "totals")
    kept = incremental.Kept(["p"], ["p", "doc"], ["v"], buckets=8)

    def lines(rows):
        return spark.createDataFrame(rows, "p bigint, doc string, v double, _sign int").withColumn("v", F.col("v").cast("decimal(18,6)"))

    start = lines([(p, str(d) if d else None, 1.5, 1) for p in range(40) for d in range(3)])
    assert kept.apply(spark, path, start) == 1
    change = lines([(7, "1", 1.5, -1), (7, "1", 4.0, 1), (7, "2", 1.5, -1), (7, None, 2.0, 1), (8, "1", 1.5, -1), (8, "1", 1.5, 1)])
    assert kept.apply(spark, path, change) == 2
    got = {(x.p, x.doc): (x._rows, float(x.v)) for x in kept.read(spark, path, start).collect()}
    want = {(p, str(d) if d else None): (1, 1.5) for p in range(40) for d in range(3)}
    want[7, "1"], want[7, None] = (1, 4.0), (2, 3.5)
    del want[7, "2"]
    assert got == want
    holders = v.periods(spark, path, ["_bucket"])
    assert sorted(x._holder for x in holders).count(2) == 1 and len(holders) == 8
    assert kept.apply(spark, path, lines([(8, "1", 1.5, -1), (8, "1", 1.5, 1)])) == 2


DAY = "user bigint, dia timestamp, n bigint"


def _arrive(spark, folder, rows):
    spark.createDataFrame(rows, DAY).coalesce(1).write.mode("append").parquet(folder)


def _run(spark, base, progress):
    schema = spark.createDataFrame([], DAY).schema
    stream = streams.arriving_files(spark, f"{base}/in", schema, files_per_batch=1)
    run = streams.unique_two_ways(stream, f"{base}/out", f"{base}/offsets", ["user", "dia"], "dia", "2 days", ["dia"])
    run.awaitTermination()
    progress += [p["stateOperators"][0]["numRowsTotal"] for p in map(lambda p: __import__("json").loads(p.json), run.recentProgress) if p["stateOperators"]]
    return schema


def test_rows_take_one_of_two_ways(spark, tmp_path, monkeypatch):
    base, r, progress, looked = str(tmp_path), random.Random(2), [], []
    unknown = streams._unknown
    monkeypatch.setattr(streams, "_unknown", lambda *a: looked.append(a[-1]) or unknown(*a))
    day = lambda n: datetime(2024, 1, 1) + timedelta(days=n)
    sent = []

    def arrive(rows):
        sent.extend(rows)
        _arrive(spark, f"{base}/in", rows)

    for n in range(6):  # in order, with repeats inside a file and in the next one
        arrive([(r.randrange(40), day(n - r.randrange(2)), n) for _ in range(60)])
    _run(spark, base, progress)
    assert looked == []  # no late rows, no look at the table
    assert spark.conf.get(streams._PROVIDER) != streams._ROCKSDB
    arrive([(x[0], x[1], 90) for x in sent[:50]] + [(1000 + i, day(0), 90) for i in range(7)] + [(2000, day(6), 6)])
    arrive([(1000 + i, day(0), 91) for i in range(9)] + [(2000, day(6), 7), (2001, day(20), 7)])
    arrive([(2001, day(20), 8), (1, day(20), 8), (2000, day(6), 8)])
    schema = _run(spark, base, progress)  # restarted
    assert looked
    got = streams.unique_rows(spark, f"{base}/out", schema).collect()
    assert sorted((x.user, x.dia) for x in got) == sorted({(x[0], x[1]) for x in sent})
    assert max(progress) < len(got) * 0.8  # keys older than the border have left the state
    last = sorted(os.listdir(f"{base}/offsets/commits"), key=lambda n: (len(n), n))[-1]
    os.remove(f"{base}/offsets/commits/{last}")
    shutil.rmtree(f"{base}/offsets/commits/.{last}.crc", ignore_errors=True)
    _run(spark, base, progress)  # the last batch once more
    again = streams.unique_rows(spark, f"{base}/out", schema).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, got))


def test_stream_of_versions(spark, tmp_path):
    base = str(tmp_path)
    for n in range(3):
        _df(spark, [(k, n, n, 2020 + k % 2, "1") for k in range(n, 6)]).coalesce(1).write.mode("append").parquet(f"{base}/in")
    schema = _df(spark, []).schema
    stream = streams.arriving_files(spark, f"{base}/in", schema, files_per_batch=1)
    streams.commit_stream(stream, f"{base}/t", f"{base}/o", KEYS, PARTS, sequence=["seq"]).awaitTermination()
    assert v.newest(spark, f"{base}/t") == 3
    assert [x[1] for x in _table(spark, f"{base}/t")] == [0, 1, 2, 2, 2, 2]
