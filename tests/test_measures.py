"""Sketches against exact measures, heavy values, drifting documents, checked loads, kept histories."""

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import history, sketches, versioned
from ledgerlens.sources import checked, variants
from ledgerlens.streaming import histories


def test_distinct_counts_of_merged_sketches(spark):
    r = random.Random(1)
    rows = [(g, p, f"v{r.randrange(30000)}" if r.random() > 0.01 else None) for g in "ab" for p in range(5) for _ in range(9000)]
    rows += [("c", 0, None), ("d", 1, "x"), ("d", 2, "x")]
    df = spark.createDataFrame(rows, "g string, p int, v string")
    stored = sketches.distinct_sketches(df, ["g", "p"], ["v"])
    merged = sketches.merged_distinct(stored.where("p < 4"), ["g"], ["v"]).select("g", sketches.distinct_count("v").alias("n"))
    for x in merged.collect():
        exact = len({v for g, p, v in rows if g == x.g and p < 4 and v is not None})
        assert abs(x.n - exact) <= sketches.THETA_ERROR * exact
        assert x.g in "ab" or x.n == exact
    one, two = stored.where("g = 'a' and p = 0").select(F.col("v").alias("x")), stored.where("g = 'b' and p = 0").select(F.col("v").alias("y"))
    got = one.join(two, F.lit(True)).select(sketches.common_count("x", "y")).first()[0]
    a, b = ({v for g, p, v in rows if g == k and p == 0 and v} for k in "ab")
    assert abs(got - len(a & b)) <= sketches.THETA_ERROR * len(a | b)


@pytest.mark.parametrize("draw", [lambda r: r.paretovariate(0.6), lambda r: float(r.randrange(4)), lambda r: -r.random()])
def test_quantiles_of_merged_sketches(spark, draw):
    r = random.Random(2)
    rows = [(p % 2, p, draw(r)) for p in range(8) for _ in range(4000)]
    df = spark.createDataFrame(rows, "g int, p int, v double")
    merged = sketches.merged_quantiles(sketches.quantile_sketches(df, ["g", "p"], "v"), ["g"])
    shares = (0.01, 0.25, 0.5, 0.9, 0.999)
    names = [sketches.quantile("sketch", s).alias(f"q{i}") for i, s in enumerate(shares)]
    for x in merged.select("g", *names, sketches.percent_rank("sketch", F.lit(1.0)).alias("rank")).collect():
        values = sorted(v for g, _, v in rows if g == x.g)
        for i, s in enumerate(shares):
            below, upto = sum(v < x[f"q{i}"] for v in values), sum(v <= x[f"q{i}"] for v in values)
            assert below / len(values) - sketches.KLL_ERROR <= s <= upto / len(values) + sketches.KLL_ERROR
        assert abs(x["rank"] - sum(v <= 1.0 for v in values) / len(values)) <= sketches.KLL_ERROR


@pytest.mark.parametrize("width,n", [(8, 5), (64, 12), (1 << 16, 40), (4, 3)])
def test_heavy_values_miss_none(spark, width, n):
    r = random.Random(width)
    rows = [(min(int(r.paretovariate(0.7)), 3000),) for _ in range(20000)] + [(None,)] * 9000
    df = spark.createDataFrame(rows, "v int")
    counts = {}
    for (v,) in rows:
        if v is not None:
            counts[v] = counts.get(v, 0) + 1
    want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:n]
    assert [tuple(x) for x in sketches.heavy_values(df, "v", n, width=width).collect()] == want
    assert sketches.heavy_values(df.limit(0), "v", n).count() == 0
    few = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    assert [tuple(x) for x in sketches.heavy_values(few, "v", 10).collect()] == [(1, 2), (2, 1)]


def test_documents_that_drift(spark):
    texts = [{"id": 1, "corpo": {"quando": "2024-01-02T03:04:05"}}, {"id": "2", "corpo": {"s": {"quando": "x"}}}, {"id": 2.5}, {"id": [1]}]
    df = spark.createDataFrame([(json.dumps(t),) for t in texts] + [("{broken",), (None,)], "t string")
    docs = variants.parsed(df, "t").drop("t")
    fields = {"id": (["$.id"], "bigint"), "em": (["$.corpo.s.quando", "$.corpo.quando"], "timestamp_ntz")}
    got = sorted((tuple(x) for x in variants.typed(docs, "documento", fields).collect()), key=repr)
    when = datetime(2024, 1, 2, 3, 4, 5)
    assert got == sorted([(1, when), (2, None), (2, None), (None, None), (None, None), (None, None)], key=repr)
    report = {(x.caminho, x.tipo): (x.linhas, x.conforme) for x in variants.drift(docs, "documento", {"$.id": "BIGINT|DECIMAL"}).collect()}
    assert report == {
        ("$.id", "BIGINT"): (1, True), ("$.id", "STRING"): (1, False), ("$.id", "DECIMAL"): (1, True),
        ("$.id", "ARRAY<BIGINT>"): (1, False), ("$.id", "AUSENTE"): (2, False),
    }
    assert "VARIANT" in variants.common_schema(docs, "documento").first()[0]


def test_a_failing_batch_is_not_published(spark, tmp_path):
    path = str(tmp_path / "t")
    reads = spark.sparkContext.accumulator(0)
    rules = {"positivo": F.col("v") > 0, "curto": F.length("s") < 5}

    def batch(rows):
        def seen(parts):
            for part in parts:
                reads.add(len(part))
                yield part

        return spark.createDataFrame(rows, "v int, s string, ano int").mapInPandas(seen, "v int, s string, ano int")

    good = [(i, "a", 2020 + i % 2) for i in range(1, 20)] + [(None, None, 2020)]
    report = checked.load(batch([*good, (-1, "toolong", 2020)]), path, rules, 0.1, ["ano"])
    assert report == {"linhas": 21, "ruins": 1, "positivo": 1, "curto": 1, "lote": 1, "publicado": True}
    assert reads.value == 21  # one scan of the batch
    schema = spark.createDataFrame([], "v int, s string, ano int").schema
    held = lambda: sorted(map(tuple, checked.read(spark, path, schema).collect()), key=repr)
    assert held() == sorted(good, key=repr)
    report = checked.load(batch([(0, "a", 2020), (5, "a", 2020)]), path, rules, 0.1, ["ano"])
    assert not report["publicado"] and held() == sorted(good, key=repr)
    assert checked.load(batch([(7, "b", 2022)]), path, rules, 0.1, ["ano"])["publicado"]
    assert held() == sorted([*good, (7, "b", 2022)], key=repr)
    bad = sorted((x.v, tuple(x._regras), x.lote) for x in checked.quarantine(spark, path, schema).collect())
    assert bad == [(-1, ("positivo", "curto"), 1), (0, ("positivo",), 2)]


def test_history_of_late_rows_rewrites_only_their_folders(spark, tmp_path):
    r, path = random.Random(6), str(tmp_path / "h")
    start = datetime(2020, 1, 1)
    rows = [(k, start + timedelta(days=r.randrange(900)), r.choice("XYZ"), i) for i, k in enumerate(r.randrange(40) for _ in range(400))]
    rows += [(3, rows[0][1], "X", 1000), (None, start, "X", 1), (4, None, "X", 1)]
    log = spark.createDataFrame(rows, "k int, t timestamp_ntz, s string, seq int")
    args = (["k"], "t", ["s"], ["seq"])
    for part in (log.where("seq % 3 <> 0"), log.where("seq % 3 = 0 and k > 5")):
        histories.apply_rows(spark, path, part, *args, buckets=16)
    before = {x[histories.BUCKET]: x._holder for x in versioned.periods(spark, f"{path}/history", [histories.BUCKET])}
    late = log.where("seq % 3 = 0 and k <= 5")
    histories.apply_rows(spark, path, late, *args, buckets=16)
    after = {x[histories.BUCKET]: x._holder for x in versioned.periods(spark, f"{path}/history", [histories.BUCKET])}
    hit = {x[0] for x in late.select(F.pmod(F.xxhash64("k"), F.lit(16)).cast("int")).distinct().collect()}
    assert {b for b in after if after[b] != before.get(b)} <= hit < set(after)
    whole = history.scd2_build(log, ["k"], "t", ["s"], [F.col("seq").desc()])
    got = histories.history(spark, path, whole.schema)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    number = versioned.newest(spark, f"{path}/history")
    histories.apply_rows(spark, path, late, *args, buckets=16)  # a replay
    assert versioned.newest(spark, f"{path}/history") == number
