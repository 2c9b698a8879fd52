import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import ordered
from ledgerlens.operators.windows import lorenz, top_share


@pytest.fixture(scope="module")
def members(spark):
    """One group holds a third of everything, values repeat, one group is a single row."""
    rnd = random.Random(7)
    data = [("hot", i, rnd.choice([5, 5, 5, 7, 11])) for i in range(400)]
    data += [(f"g{i % 40}", 1000 + i, rnd.randrange(50)) for i in range(800)]
    data += [("one", 9999, 3), (None, 10001, 4), (None, 10002, 6)]
    df = spark.createDataFrame(data, "g string, k long, v long").repartition(16)
    return data, df


def by_group(data):
    out = {}
    for g, k, v in data:
        out.setdefault(g, []).append((k, v))
    return out


def test_prefix_ranks_sums_and_totals(spark, members):
    data, df = members
    got = ordered.ordered_prefix(
        df, [F.col("v").desc(), F.col("k")], ["g"], sums={"run": "v"}, rank="r", rows="n",
        totals={"total": "v"},
    ).collect()
    assert len(got) == len(data)
    want = {}
    for g, items in by_group(data).items():
        run = 0
        for r, (k, v) in enumerate(sorted(items, key=lambda x: (-x[1], x[0])), 1):
            run += v
            want[k] = (r, run, len(items), sum(x[1] for x in items))
    assert {r.k: (r.r, r.run, r.n, r.total) for r in got} == want


def test_prefix_without_groups(spark, members):
    data, df = members
    got = ordered.ordered_prefix(df, [F.col("v"), F.col("k")], rank="r").collect()
    order = sorted(data, key=lambda x: (x[2], x[1]))
    assert [r.k for r in sorted(got, key=lambda r: r.r)] == [x[1] for x in order]
    assert sorted(r.r for r in got) == list(range(1, len(data) + 1))


def test_median_is_exact(spark, members):
    data, df = members
    got = {r.g: r.median for r in ordered.group_median(df, ["g"], "v").collect()}
    assert got == {g: median(v for _, v in items) for g, items in by_group(data).items()}


@pytest.mark.parametrize("form", ["", "dimension_"])
def test_global_ranks_agree_in_both_forms(spark, members, form):
    data, df = members
    rows, percents = getattr(ordered, f"{form}row_ranks"), getattr(ordered, f"{form}percent_ranks")
    got = percents(rows(df, {"r": [F.col("v").desc(), F.col("k")]}), {"p": "v"}).collect()
    order = [x[1] for x in sorted(data, key=lambda x: (-x[2], x[1]))]
    assert [r.k for r in sorted(got, key=lambda r: r.r)] == order
    n = len(data)
    for r in got[:50]:
        assert r.p == pytest.approx(sum(x[2] < r.v for x in data) / (n - 1))


@pytest.mark.parametrize("size, top", [(1, 1), (9, 1), (10, 1), (25, 2)])
def test_top_share_takes_at_least_one(spark, size, top):
    df = spark.createDataFrame([(2020, i, i + 1) for i in range(size)], "ano int, k int, v int")
    row = top_share(df, ["ano"], "v", ["k"]).first()
    values = sorted(range(1, size + 1), reverse=True)
    assert (row.total, row.top) == (size, top)
    assert row.concentracao == pytest.approx(sum(values[:top]) / sum(values) * 100)


def test_lorenz_ends_at_hundred(spark):
    df = spark.createDataFrame([(2020, 1, 50), (2020, 2, 30), (2020, 3, 20)], "ano int, k int, v int")
    got = sorted(tuple(r) for r in lorenz(df, ["ano"], "v", ["k"]).select(
        "posicao", "percentual_valor_acumulado").collect())
    assert got == [(1, 50.0), (2, 80.0), (3, 100.0)]
