"""Joins and groupings of stored buckets move no fact rows."""

import uuid

from ledgerlens import adapters as a
from ledgerlens import registry
from ledgerlens.plans import facts, marts, staging
from ledgerlens.sources import bucketed

FOLDER = "/root/testdata/sf0.001"


def _store(spark, df, key, folder):
    name = f"t_{uuid.uuid4().hex}"
    return bucketed.store(df, name, [key], 6, f"{folder}/{name}")


def _exchanges(df):
    """Shuffles in the plan of a query that has not run yet."""
    return [x.strip() for x in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange " in x and "Broadcast" not in x]


def test_spending_without_exchange(spark, tmp_path):
    people = _store(spark, a.deputy_versions(spark, FOLDER), "nk_deputado", tmp_path)
    documents = _store(spark, registry._expense_facts(spark, FOLDER), "nk_deputado", tmp_path)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = marts.spend_per_person(documents, people, by_key=True)
        assert _exchanges(df) == []
        plain = marts.spend_per_person(registry._expense_facts(spark, FOLDER), a.deputy_versions(spark, FOLDER))
        assert _exchanges(plain)
        assert sorted(map(str, df.collect())) == sorted(map(str, plain.select(*df.columns).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_votes_without_exchange_above_them(spark, tmp_path):
    votes = _store(spark, registry._votes(spark, FOLDER), "deputado_id", tmp_path)
    people = _store(spark, a.deputies(spark, FOLDER), "nk_deputado", tmp_path)
    calls = _store(spark, registry._roll_calls(spark, FOLDER), "id_votacao", tmp_path)
    lines = _store(spark, staging.guidances(a.guidances(spark, FOLDER)), "id_votacao", tmp_path)
    bills = registry._bills(spark, FOLDER)
    df = facts.vote_fact(votes, calls, lines, bills, people, by_key=True)
    assert _exchanges(df) == []
    plain = registry._vote_facts(spark, FOLDER)
    assert sorted(map(str, df.collect())) == sorted(map(str, plain.collect()))
