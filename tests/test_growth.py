"""Steps whose work, memory and disk grow no faster than their input."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerlens import adapters as a
from ledgerlens import registry
from ledgerlens.operators import intervals, joins, lineage, versioned
from ledgerlens.plans import incremental, marts

FOLDER = "/root/testdata/sf0.001"


def day(n):
    return datetime(2020, 1, 1) + timedelta(days=n)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_version_join_moves_each_version_once(spark, rows):
    """An open version is one row however many years it lasts, and never lies whole at the driver."""
    facts = spark.createDataFrame(
        [(1, 1, day(5)), (2, 1, day(400)), (3, 1, day(9000)), (4, 2, day(5)), (5, None, day(5)), (6, 1, None)],
        "f int, k int, t timestamp_ntz",
    )
    versions = spark.createDataFrame(
        [(1, "a", day(0), day(400)), (1, "b", day(400), None), (None, "c", day(0), None)],
        "k int, name string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    got = joins.version_join(facts, versions, ["k"], "t")
    assert "explode" not in _plan(got) and "Broadcast" not in _plan(got)
    assert rows(got, "f", "name") == sorted([(1, "a"), (2, "b"), (3, "b"), (4, None), (5, None), (6, None)], key=repr)
    inner = joins.version_join(facts, versions, ["k"], "t", how="inner")
    assert rows(inner, "f", "name") == [(1, "a"), (2, "b"), (3, "b")]


def test_person_attributes_are_not_broadcast(spark):
    """Persons join finished totals and bills by shuffle: their table grows with the input."""
    persons = a.deputies(spark, FOLDER)
    spent = marts.spend_per_person(registry._expense_facts(spark, FOLDER), persons)
    joins_of_versions = [x for x in _plan(spent).splitlines() if "HashJoin" in x and "sk_deputado" in x]
    assert joins_of_versions == []


def test_buckets_grow_with_the_table():
    assert [registry._buckets(n) for n in (0, 4_000_000, 36_000_000)] == [16, 16, 144]


def test_first_version_is_written_once_and_not_joined(spark, rows, tmp_path, monkeypatch):
    """With nothing stored, the batch is neither copied nor compared; the table is the batch."""
    def fail(*_):
        raise AssertionError("the batch was copied")

    path, batch = str(tmp_path / "t"), spark.createDataFrame([(1, 2019, "a"), (1, 2019, "b"), (2, 2020, "c")], "k int, ano int, v string")
    with monkeypatch.context() as m:
        m.setattr(versioned, "materialize", fail)
        assert versioned.commit(spark, path, batch, ["k"], ["ano"], [F.col("v").desc()]) == 1
    assert rows(versioned.read(spark, path, batch.schema, ["ano"])) == [(1, 2019, "b"), (2, 2020, "c")]
    later = spark.createDataFrame([(2, 2021, "d")], batch.schema)
    assert versioned.commit(spark, path, later, ["k"], ["ano"], unique=True) == 2
    assert rows(versioned.read(spark, path, batch.schema, ["ano"])) == [(1, 2019, "b"), (2, 2021, "d")]


def test_overlaps_broadcast_neither_ranges_nor_their_nodes(spark, rows, tmp_path):
    """Stored ranges look small to Spark; their nodes are many times more rows than that."""
    path = str(tmp_path / "versions")
    versions = spark.createDataFrame(
        [(1, day(0), day(9)), (1, day(9), None), (2, day(40), day(60)), (3, day(-90), day(-80)), (4, None, day(3))],
        "k int, de timestamp_ntz, ate timestamp_ntz",
    )
    versions.write.parquet(path)
    terms = spark.createDataFrame([("a", day(-9), day(20)), ("b", day(21), day(50))], "term string, a timestamp_ntz, b timestamp_ntz")
    both = intervals.overlaps(spark.read.schema(versions.schema).parquet(path), terms, ("de", "ate"), ("a", "b"))
    assert "Broadcast" not in _plan(both)
    assert rows(both, "k", "de", "term") == sorted(
        [(1, day(0), "a"), (1, day(9), "a"), (1, day(9), "b"), (2, day(40), "b")], key=repr
    )


def test_a_commit_writes_every_row_once(spark, rows, tmp_path):
    """Feed and table share their files, the batch's copy goes, and the session's settings stay."""
    path, work = str(tmp_path / "t"), lineage.working_folder(spark).removeprefix("file:")
    schema = "k int, ano int, v string"

    def stored(version):
        return spark.read.parquet(f"{path}/rows/version={version}").count() if version in versions(path) else 0

    def versions(at):
        return [int(n.split("=")[1]) for n in os.listdir(f"{at}/rows")]

    def copies():
        return set(os.listdir(work)) if os.path.exists(work) else set()

    before = copies()
    first = spark.createDataFrame([(k, 2019 + k % 3, "a") for k in range(30)], schema)
    assert versioned.commit(spark, path, first, ["k"], ["ano"], few=True) == 1
    assert not os.path.exists(f"{path}/feed") and stored(1) == 30
    batch = spark.createDataFrame([(0, 2019, "b"), (3, 2020, "b"), (99, 2020, "b"), (6, 2019, "a")], schema)
    gone = spark.createDataFrame([(9,), (9,), (0,), (500,), (None,)], "k int")
    assert versioned.commit(spark, path, batch, ["k"], ["ano"], deletes=gone, few=True) == 2
    # two updated ones twice, one inserted, one deleted, 7 and 10 others of the two periods
    assert stored(2) == 2 * 2 + 1 + 1 + 7 + 10
    feed = versioned.changes(spark, path, first.schema, 1)
    assert rows(feed.groupBy(versioned.KIND).count()) == [("delete", 1), ("insert", 1), ("update_after", 2), ("update_before", 2)]
    want = {k: (k, 2019 + k % 3, "a") for k in range(30) if k != 9} | {0: (0, 2019, "b"), 3: (3, 2020, "b"), 99: (99, 2020, "b")}
    assert rows(versioned.read(spark, path, first.schema, ["ano"])) == sorted(want.values(), key=repr)
    assert copies() == before and spark.conf.get(lineage._SHORT) == "false"
    assert versioned.commit(spark, path, batch, ["k"], ["ano"], deletes=gone, few=True) == 2 and 3 not in versions(path)


def test_combined_rows_stay_in_the_folder_of_their_key(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, place int, n int"

    def add(new, old):
        n = new["n"] + F.coalesce(old["n"], F.lit(0))
        return F.when(n > 0, F.struct(new["k"].alias("k"), new["place"].alias("place"), n.alias("n")))

    def apply(*lines):
        batch = spark.createDataFrame([(k, k % 4, n) for k, n in lines], schema)
        return versioned.commit(spark, path, batch, ["k"], ["place"], unique=True, few=True, settled=True, combine=add)

    assert apply((1, 5), (2, 1), (3, -1), (5, 2)) == 1
    assert apply((1, -5), (2, 4), (6, 3), (7, -2), (5, 0)) == 2
    like = spark.createDataFrame([], schema).schema
    assert rows(versioned.read(spark, path, like, ["place"])) == [(2, 2, 5), (5, 1, 2), (6, 2, 3)]
    assert rows(versioned.read(spark, path, like, ["place"], 1)) == [(1, 1, 5), (2, 2, 1), (5, 1, 2)]
    assert rows(versioned.changes(spark, path, like, 1), "k", versioned.KIND, "n") == sorted(
        [(1, "delete", 5), (2, "update_before", 1), (2, "update_after", 5), (6, "insert", 3)], key=repr
    )
    assert not os.path.exists(f"{path}/keys")


def test_an_empty_period_name_loses_no_rows(spark, rows, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, p string, v int"
    for batch in ([(1, "", 1), (2, None, 1), (3, "x", 1)], [(1, "", 2), (4, "", 2)]):
        versioned.commit(spark, path, spark.createDataFrame(batch, schema), ["k"], ["p"])
    like = spark.createDataFrame([], schema).schema
    assert rows(versioned.read(spark, path, like, ["p"]), "k", "v") == [(1, 2), (2, 1), (3, 1), (4, 2)]


def test_kept_spending_is_dealt_once(spark):
    """Sums, first months and the person's version all work on totals that lie by person."""
    versions = a.deputies(spark, FOLDER)
    keys = ", ".join(
        f"{k} {t}" for k, t in zip(incremental.SPENDING.keys, ("bigint", "string", "bigint", "int", "timestamp_ntz"), strict=True)
    )
    sums = ", ".join(f"{c} decimal(38,6)" for c in incremental.SPENDING.sums)
    totals = spark.createDataFrame([], f"{keys}, {incremental.ROWS} bigint, {sums}")
    plan = _plan(incremental.spending(totals, versions))
    assert plan.count("Exchange hashpartitioning") == 2  # totals, and the versions


def test_keys_are_not_looked_up_when_all_periods_are_hit(spark, rows, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), "k int, ano int, v string"
    looked, located = [], versioned._located
    monkeypatch.setattr(versioned, "_located", lambda *x: looked.append(1) or located(*x))
    for batch in ([(1, 2019, "a"), (2, 2020, "a")], [(1, 2020, "b"), (3, 2019, "b")], [(3, 2020, "c")]):
        versioned.commit(spark, path, spark.createDataFrame(batch, schema), ["k"], ["ano"])
    assert len(looked) == 1  # the last batch names one period, and its key lies in the other
    like = spark.createDataFrame([], schema).schema
    assert rows(versioned.read(spark, path, like, ["ano"])) == [(1, 2020, "b"), (2, 2020, "a"), (3, 2020, "c")]
