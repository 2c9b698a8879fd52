"""Queries against a second engine on the benchmark tables.

By default a spread of queries runs at the smallest scale; ORACLE=all runs every one.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from ledgerlens.oracle import oracle_queries
from ledgerlens.registry import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
SPREAD = (
    "json_path_extract", "period_landing", "clean_text", "party_and_category_rules", "calendar_terms",
    "mode_dimension", "scd2_incremental", "asof_version_join", "vote_tally", "bill_fact",
    "spend_by_entity_quota", "presence_loyalty", "discipline_cohesion", "state_switching",
    "spend_ranking", "kpi_list", "lorenz_curve", "yearly_outliers", "hhi", "upsert_periods",
    "dq_summary",
)
TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no benchmark tables here")
SQL = oracle_queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES) if os.environ.get("ORACLE") == "all" else SPREAD)
def test_same_rows(spark, duck, name):
    result = duck.sql(SQL[name])
    df = QUERIES[name](spark, FOLDER)
    names = sorted(df.columns)
    assert names == sorted(result.columns)
    kinds = dict(zip(result.columns, map(str, result.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema.fields} == kinds
    plan = df._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan and "PythonUDF" not in plan
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
    want = sorted((tuple(dict(zip(result.columns, r))[n] for n in names) for r in result.fetchall()), key=repr)
    assert got == want


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
