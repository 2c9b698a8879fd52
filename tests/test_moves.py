"""Rows move once, and only those that are needed; keys with long logs are still split."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from ledgerlens import adapters as a
from ledgerlens import registry
from ledgerlens.operators import history, intervals, joins, windows
from ledgerlens.plans import dimensions, marts

FOLDER = "/root/testdata/sf0.001"


def day(n):
    return datetime(2020, 1, 1) + timedelta(days=n)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _final_plan(df):
    """The plan as it was run."""
    df.collect()
    return _plan(df).split("Initial Plan")[0]


LOG = "k int, t timestamp_ntz, party string, msg int"
ROWS = [
    *[(1, day(40 * i), "ABAB"[i % 4] if i % 3 else "C", i) for i in range(12)],
    (2, day(0), "A", 1), (2, day(0), "B", 2), (2, day(90), "B", 3), (2, day(91), None, 4), (2, day(500), None, 5),
    (3, None, "A", 1), (None, day(3), "A", 1), (4, day(7), None, 1),
]


def test_versions_of_short_logs_are_built_without_a_join(spark, rows):
    """Only keys with a long log take the way over buckets; both ways give the same versions."""
    log = spark.createDataFrame(ROWS, LOG)

    def build(n):
        return history.scd2_build(log, ["k"], "t", ["party"], [F.col("msg").desc()], long_log=n)

    short = build(100)
    text = _final_plan(short)
    assert "SortMergeJoin" not in text and "_bucket" not in text
    want = rows(short)
    assert len(want) > 10 and rows(build(0)) == want and rows(build(5)) == want


def test_previous_row_of_short_and_long_logs(spark, rows):
    log = spark.createDataFrame(ROWS, LOG)

    def before(n):
        return rows(windows.previous_in_time(log, ["k"], "t", "party", "_before", ["msg"], rows=n))

    assert before(100) == before(0) == before(5)
    assert len(before(100)) == sum(k is not None and t is not None for k, t, _, _ in ROWS)


def test_averages_of_few_groups_do_not_move_the_rows(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 3), (None, 5)], "g string, v int")
    both = joins.with_group_stats(df, ["g"], {"m": F.max("v")}, few=True)
    assert "BroadcastHashJoin" in _plan(both)
    assert rows(both) == rows(joins.with_group_stats(df, ["g"], {"m": F.max("v")}))


def test_spending_moves_each_document_once(spark, rows):
    """After the join with the versions the documents stay where they are, and are not hashed one by one."""
    versions = a._deputy_versions(spark, FOLDER)
    spent = marts.spend_per_person(registry._expense_facts(spark, FOLDER), versions)
    text = _plan(spent)
    assert "hashpartitioning(sk_deputado" not in text
    assert not [x for x in text.splitlines() if "HashAggregate(keys" in x and "cod_documento" in x]


def test_document_counts_once_over_lines_and_months(spark):
    names = "nk_deputado, cod_documento, ano, mes, data_documento, valor_documento, valor_liquido, valor_glosa, faixa_valor"
    lines = [
        (1, 7, 2020, 1, day(5), 10, 9, 1, "ALTO"), (1, 7, 2020, 2, day(35), 20, 19, 1, "BAIXO"),
        (1, 7, 2020, 2, day(35), 20, 19, 1, None), (1, 8, 2020, 2, day(36), 5, 5, 0, "ALTO"),
        (1, None, 2020, 3, day(65), 1, 1, 0, "ALTO"), (2, 7, 2020, 1, day(5), 3, 3, 0, "MEDIO"),
        (1, 9, 2020, 1, day(6), 0, 0, 0, "ALTO"),
    ]
    kinds = ["int", "int", "int", "int", "timestamp_ntz", "int", "int", "int", "string"]
    df = spark.createDataFrame(lines, ", ".join(f"{n} {t}" for n, t in zip(names.split(", "), kinds)))
    money = {n: F.col(n).cast("decimal(18,6)") for n in ("valor_documento", "valor_liquido", "valor_glosa")}
    versions = spark.createDataFrame(
        [("s", 1, "n", "c", "PT", "SP", "T", "E", day(0), None)],
        "sk_deputado string, nk_deputado int, nome_deputado string, nome_civil string, sigla_partido string, "
        "sigla_uf string, condicao_eleitoral string, situacao string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    got = {r.deputado_id: r for r in marts.spend_per_person(df.withColumns(money), versions).collect()}
    one, two = got[1], got[2]
    assert (one.total_documentos, one.total_meses_atividade, one.valor_total_gasto) == (2, 3, 56)
    assert (one.gastos_valor_alto, one.gastos_valor_baixo, one.valor_medio_mensal) == (16, 20, 11.2)
    assert (one.nome_deputado, two.nome_deputado, two.sigla_uf) == ("n", "Deputado ID: 2", "N/A")
    assert (two.sk_deputado, two.total_documentos) == ("DEPUTADO_NAO_ENCONTRADO_2", 1)


def test_landed_documents_move_to_their_person_at_once(spark):
    """Distinct documents and the version join share one shuffle of the documents."""
    text = _plan(registry.spend_on_person_pipeline(spark, FOLDER))
    assert not [x for x in text.splitlines() if "hashpartitioning" in x and "cod_documento" in x.split("hashpartitioning")[1].split(")")[0]]


def test_person_log_is_cleaned_once(spark):
    """The versions count and read a stored log instead of cleaning and shuffling it for each of the two."""
    people = registry._people(spark, FOLDER)
    assert any("orders" in f for f in people[1].inputFiles())
    assert not any("orders" in f for f in dimensions.person_dimension(*people, registry.AS_OF).inputFiles())


def test_listing_is_filtered_before_names_are_joined(spark):
    """Year and party reach the documents before they move to kinds and suppliers."""
    plan = registry.detail_listing(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    joined = {k: next(i for i, x in enumerate(plan) if "Join" in x and k in x) for k in ("_part", "valid_from", "_supplier")}
    assert joined["valid_from"] > joined["_part"] and joined["valid_from"] > joined["_supplier"]


def test_ranges_are_cut_into_nodes_of_their_own_size(spark):
    """No more nodes for a second's precision: they cover the range and not much beside it."""
    cases = [(s, s + n) for s in (-70, 0, 5, 1_580_000_001) for n in (0, 1, 7, 86_399, 400 * 86_400, 10**10)]
    df = spark.createDataFrame(cases, "a bigint, b bigint")
    first, last = intervals.rounded(F.col("a"), F.col("b"))
    df = df.select("a", "b", first.alias("lo"), last.alias("hi"), intervals.nodes(first, last).alias("n"))
    for x in df.collect():
        length = x.b - x.a + 1
        assert x.lo <= x.a and x.b <= x.hi and x.hi - x.lo + 1 <= length * 3 // 2
        assert len(x.n) <= 8 and sum(1 << level for level, _ in x.n) == x.hi - x.lo + 1


def test_points_ask_for_few_levels(spark, rows):
    """Versions of months need no node of seconds, and the times decide at their ends."""
    points = spark.createDataFrame([(1, day(0)), (1, day(99)), (1, day(100)), (1, day(350)), (2, day(5))], "k int, t timestamp_ntz")
    ranges = spark.createDataFrame(
        [(1, "a", day(0), day(100)), (1, "b", day(100), day(300))], "k int, v string, s timestamp_ntz, e timestamp_ntz"
    )
    got = intervals.range_join(points, ranges, "t", "s", "e", "left", ["k"], "second", False)
    assert rows(got, "k", "t", "v") == sorted(
        [(1, day(0), "a"), (1, day(99), "a"), (1, day(100), "b"), (1, day(350), None), (2, day(5), None)], key=repr
    )
