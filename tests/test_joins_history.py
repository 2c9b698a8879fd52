import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import intervals, history, joins, windows

DAY = datetime(2020, 1, 1)


def at(n, hours=0):
    return DAY + timedelta(days=n, hours=hours)


def brute(facts, versions):
    out = []
    for f, k, t in facts:
        hit = [v for v in versions if v[0] == k and v[2] <= t and (v[3] is None or t < v[3])]
        out += [(f, v[1]) for v in hit] or [(f, None)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("years", [(1990, 2030), (2021, 2021), (2022, 2024)])
def test_version_join_matches_brute_force(spark, years):
    """A crowded entity, an entity with gaps, an unknown entity, facts on every boundary."""
    rnd = random.Random(3)
    starts = sorted(rnd.sample(range(2000), 300))
    versions = [
        (1, f"a{i}", at(0, s), at(0, starts[i + 1]) if i + 1 < len(starts) else None)
        for i, s in enumerate(starts)
    ]
    versions += [(2, "b0", at(3), at(5)), (2, "b1", at(8), at(9, 5)), (3, "c0", at(1), None)]
    facts, n = [], 0
    for _, _, s, e in versions:
        for t in (s, s - timedelta(seconds=1), e):
            if t is not None:
                facts.append((n, 1 if n % 3 else rnd.choice([1, 2, 3, 4]), t))
                n += 1
    f = spark.createDataFrame(facts, "f int, k int, t timestamp_ntz")
    v = spark.createDataFrame(versions, "k int, name string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    got = joins.version_join(f, v, ["k"], "t", first_year=years[0], last_year=years[1])
    assert sorted((tuple(r) for r in got.select("f", "name").collect()), key=repr) == brute(facts, versions)
    assert set(got.columns) == {"f", "k", "t", "name", "valid_from", "valid_to"}


def test_range_join_has_no_nested_loop(spark, rows):
    days = spark.createDataFrame([("2019-01-31",), ("2019-02-01",), ("2023-01-31",), ("1990-01-01",)], "d string")
    terms = spark.createDataFrame([(55, "2015-02-01", "2019-01-31"), (56, "2019-02-01", "2023-01-31")], "n int, a string, b string")
    days = days.withColumn("d", F.col("d").cast("date"))
    terms = terms.withColumns({c: F.col(c).cast("date") for c in "ab"})
    got = intervals.range_join(days, terms, "d", "a", "b")
    assert "NestedLoop" not in got._jdf.queryExecution().toString()
    assert [n for _, n in rows(got.select(F.col("d").cast("string"), "n"))] == [None, 55, 56, 56]


def test_not_in_survives_null_keys(spark, rows):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(2,), (None,)], "k int")
    assert rows(joins.not_in(left, right, ["k"])) == [(1,)]


def test_group_stats_and_benchmark(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5)], "g string, v int")
    both = joins.with_group_stats(df, ["g"], {"m": F.sum("v")})
    assert rows(joins.with_benchmark(both, {"t": F.sum("v")})) == [("a", 1, 4, 9), ("a", 3, 4, 9), (None, 5, 5, 9)]


LOG = "k int, t timestamp_ntz, party string, msg int"


def versions_of(df):
    return sorted((r.k, r.party, r.valid_from, r.valid_to) for r in df.collect())


def test_scd2_collapses_runs_and_closes_versions(spark):
    log = [
        (1, at(0), "A", 1), (1, at(10), "A", 2), (1, at(400), "B", 3), (1, at(900), "A", 4),
        (2, at(5), "X", 5), (2, at(5), "Y", 6), (None, at(1), "Z", 7), (3, None, "Z", 8),
    ]
    got = history.scd2_build(spark.createDataFrame(log, LOG), ["k"], "t", ["party"], [F.col("msg").desc()])
    assert [(k, p, a, b) for k, p, a, b in versions_of(got)] == [
        (1, "A", at(0), at(400)), (1, "A", at(900), None), (1, "B", at(400), at(900)), (2, "Y", at(5), None),
    ]
    assert got.where("is_current <> (valid_to is null)").count() == 0


def test_scd2_late_row_splits_a_version(spark):
    stored = [(1, at(0), "A", 1), (1, at(50), "A", 2), (2, at(0), "Q", 3)]
    late = [(1, at(20), "B", 4)]
    log = spark.createDataFrame(stored, LOG)
    first = history.scd2_build(log, ["k"], "t", ["party"])
    got = history.scd2_apply(first, log, spark.createDataFrame(late, LOG), ["k"], "t", ["party"])
    whole = history.scd2_build(spark.createDataFrame(stored + late, LOG), ["k"], "t", ["party"])
    assert versions_of(got) == versions_of(whole)
    assert versions_of(got)[:3] == [
        (1, "A", at(0), at(20)), (1, "A", at(50), None), (1, "B", at(20), at(50)),
    ]


def test_versions_never_overlap(spark):
    rnd = random.Random(5)
    log = [(rnd.randrange(5), at(rnd.randrange(3000)), rnd.choice("ABC"), i) for i in range(600)]
    got = history.scd2_build(spark.createDataFrame(log, LOG), ["k"], "t", ["party"], [F.col("msg").desc()])
    per = {}
    for k, p, a, b in versions_of(got):
        per.setdefault(k, []).append((a, b, p))
    for spans in per.values():
        spans.sort()
        for (a, b, p), (a2, _, p2) in zip(spans, spans[1:]):
            assert b == a2 and p != p2
        assert spans[-1][1] is None


@pytest.mark.parametrize("unit", ["day", "month", "year"])
def test_previous_in_time_crosses_buckets(spark, unit):
    rnd = random.Random(9)
    times = rnd.sample(range(20000), 300)
    log = [(i % 2, at(0, t), i if i % 7 else None) for i, t in enumerate(times)]
    df = spark.createDataFrame(log, "k int, t timestamp_ntz, v int")
    got = {(r.k, r.t): r.before for r in windows.previous_in_time(df, ["k"], "t", "v", "before", unit=unit).collect()}
    for k in (0, 1):
        line = sorted((t, v) for kk, t, v in log if kk == k)
        for (_, before), (t, _) in zip([(None, None), *line], line):
            assert got[(k, t)] == before


def test_growth_needs_consecutive_years(spark, rows):
    df = spark.createDataFrame([(1, 2019, 100), (1, 2020, 150), (1, 2022, 300), (2, 2020, 0), (2, 2021, 5)], "k int, ano int, v int")
    got = windows.period_growth(df, ["k"], "ano", "v", "g", consecutive=True)
    assert rows(got, "k", "ano", "g") == [(1, 2020, 50.0), (2, 2021, None)]


def test_mode_ties_take_the_smallest(spark, rows):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, "a"), (2, "z")], "k int, v string")
    assert rows(windows.mode_of(df, ["k"], "v")) == [(1, "a"), (2, "z")]


def test_an_open_range_covers_every_later_day(spark):
    points = spark.sql("select explode(sequence(date'2018-12-30', date'2021-02-01')) as day")
    ranges = spark.sql(
        "select * from values (1, date'2019-01-01', date'2020-01-31'), (2, date'2020-02-01', null), "
        "(3, date'2030-01-01', null) as t(term, first, last)"
    )
    got = intervals.range_join(points, ranges, "day", "first", "last").groupBy("term").count().collect()
    assert {r["term"]: r["count"] for r in got} == {None: 2, 1: 396, 2: 367}
