"""Interval joins against brute force, from ranges of a second to ranges of a century."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import intervals

BASE = datetime(1890, 1, 1)


def _ranges(r, n):
    out = []
    for i in range(n):
        start = BASE + timedelta(seconds=r.randrange(130 * 365 * 86400))
        length = r.choice([0, 1, 59, 3600, 86400, 400 * 86400, 100 * 365 * 86400])
        out.append((i, r.randrange(4), start, None if r.random() < 0.1 else start + timedelta(seconds=length)))
    return [*out, (n, 1, None, BASE), (n + 1, 1, BASE + timedelta(days=9), BASE)]


@pytest.mark.parametrize("unit,closed", [("second", True), ("second", False), ("day", True)])
def test_points_in_ranges(spark, unit, closed):
    r = random.Random(1)
    ranges = _ranges(r, 150)
    points = [(i, r.randrange(5), r.choice(ranges)[2] or BASE) for i in range(200)]
    points += [(200 + i, r.randrange(4), BASE + timedelta(seconds=r.randrange(150 * 365 * 86400))) for i in range(200)]
    points += [(999, 1, None), (1000, None, BASE)]
    left = spark.createDataFrame(points, "p int, k int, t timestamp_ntz")
    right = spark.createDataFrame(ranges, "n int, k int, a timestamp_ntz, b timestamp_ntz")
    got = intervals.range_join(left, right, "t", "a", "b", "left", ["k"], unit, closed).select("p", "n").collect()
    want = []
    for p, k, t in points:
        hits = [
            n for n, k2, a, b in ranges
            if t and k == k2 and a and a <= t and (b is None or (t <= b if closed else t < b))
        ]
        want += [(p, n) for n in hits] or [(p, None)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("closed", [True, False])
def test_overlapping_ranges(spark, closed):
    r = random.Random(2)
    one, two = _ranges(r, 90), _ranges(r, 90)
    left = spark.createDataFrame(one, "n int, k int, a timestamp_ntz, b timestamp_ntz")
    right = spark.createDataFrame(two, "m int, k int, c timestamp_ntz, d timestamp_ntz")
    got = intervals.overlaps(left, right, ("a", "b"), ("c", "d"), ["k"], "second", closed).select("n", "m").collect()
    big = datetime(9999, 1, 1)

    def meet(a, b, c, d):
        b, d = b or big, d or big
        if a is None or c is None:
            return False
        if closed:
            return a <= b and c <= d and a <= d and c <= b
        return a < b and c < d and a < d and c < b

    want = [(n, m) for n, k, a, b in one for m, k2, c, d in two if k == k2 and meet(a, b, c, d)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_nodes_make_up_the_range(spark):
    cases = [(a, a + n) for a in (-70, -1, 0, 5, 64, 2**40 + 3) for n in (0, 1, 7, 63, 200)]
    df = spark.createDataFrame(cases, "a bigint, b bigint").select("a", "b", intervals.nodes(F.col("a"), F.col("b")).alias("n"))
    for x in df.collect():
        ticks = sorted(t for level, node in x.n for t in range(node << level, (node + 1) << level))
        assert ticks == list(range(x.a, x.b + 1))
        assert max(sum(level == one for level, _ in x.n) for one in range(50)) <= 2


def test_no_task_gathers_the_points(spark):
    r = random.Random(3)
    ranges = spark.createDataFrame(_ranges(r, 400), "n int, k int, a timestamp_ntz, b timestamp_ntz")
    points = spark.range(6000).select(
        F.expr("timestampadd(MINUTE, CAST(id * 10000 AS INT), TIMESTAMP_NTZ'1890-01-01 00:00:00')").alias("t")
    )
    seen = {}
    conf = {"spark.sql.shuffle.partitions": "211", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        plan = intervals.matches(points, ranges, "t", "a", "b", unit="second")
        rows = plan.groupBy(F.spark_partition_id().alias("p")).count().collect()
        seen = {x.p: x["count"] for x in rows}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert max(seen.values()) <= 0.05 * sum(seen.values())
    text = plan._jdf.queryExecution().toString()
    assert "NestedLoopJoin" not in text and "CartesianProduct" not in text
