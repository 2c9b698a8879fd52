from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import rules
from ledgerlens.operators import quality
from ledgerlens.plans import analyses, dimensions, explore, facts, marts, person, staging

EXPENSE = """deputado_id long, cod_documento long, ano int, mes int, cnpj_cpf_fornecedor string,
    data_documento timestamp_ntz, nome_fornecedor string, num_documento string, num_ressarcimento string,
    tipo_despesa string, tipo_documento string, url_documento string, valor_documento decimal(18,2),
    valor_liquido decimal(18,2), valor_glosa decimal(18,2)"""


def expense(doc, net=100, gross=None, cut=0, month=3, url="u", person_id=1, refund=None, when=None):
    gross = net if gross is None else gross
    when = when or datetime(2024, month, 5)
    gross, net, cut = (None if x is None else Decimal(x) for x in (gross, net, cut))
    return (person_id, doc, when.year, month, " 9 ", when, " loja ", " 1 ", refund, "tipo", "nf", url, gross, net, cut)


def test_expense_staging_and_fact(spark):
    data = [
        expense(1, 100, cut=0, month=3, url=" "), expense(1, 100, cut=0, month=3, url=" "),
        expense(2, 1000, 2000, 1000, month=4, refund="7"), expense(3, 5001, 10, 20, month=12, url=None),
        expense(4, 0, 0, 0), expense(5, -1, -1), expense(6, None, 5), expense(None, 5),
    ]
    staged = staging.expenses(spark.createDataFrame(data, EXPENSE))
    got = {r.cod_documento: r for r in facts.expense_fact(staged).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    assert (got[1].faixa_valor, got[1].trimestre, got[1].status_financeiro, got[1].tem_documento) == ("BAIXO", "T1", "SEM_GLOSA", False)
    assert (got[2].faixa_valor, got[2].trimestre, got[2].percentual_glosa, got[2].tem_ressarcimento) == ("MEDIO", "T2", 50.0, True)
    assert (got[3].faixa_valor, got[3].status_financeiro, got[3].ano_mes) == ("MUITO_ALTO", "INCONSISTENTE", "2024-12")
    assert got[4].percentual_glosa == 0.0 and got[1].nome_fornecedor == "LOJA"


VERSION = """sk_deputado string, nk_deputado long, nome_deputado string, nome_civil string, sigla_partido string,
    sigla_uf string, condicao_eleitoral string, situacao string, valid_from timestamp_ntz, valid_to timestamp_ntz"""


def test_spending_uses_the_version_of_the_day(spark):
    turn = datetime(2024, 6, 1)
    versions = spark.createDataFrame(
        [
            ("a", 1, "ANA", "ana", "PT", "SP", "TITULAR", "EXERCÍCIO", datetime(2024, 2, 1), turn),
            ("b", 1, "ANA", "ana", "PL", "SP", "TITULAR", "EXERCÍCIO", turn, None),
        ],
        VERSION,
    )
    docs = [
        expense(1, 100, when=datetime(2024, 1, 31), month=1), expense(2, 200, when=datetime(2024, 2, 1), month=2),
        expense(3, 300, when=turn, month=6), expense(4, 400, when=datetime(2025, 1, 1), month=1),
        expense(5, 500, person_id=8),
    ]
    fact = facts.expense_fact(staging.expenses(spark.createDataFrame(docs, EXPENSE)))
    got = {r.sk_deputado: r for r in marts.spend_per_person(fact, versions).collect()}
    assert {k: float(r.valor_total_liquido) for k, r in got.items()} == {
        "a": 200.0, "b": 700.0, marts.MISSING_PERSON + "1": 100.0, marts.MISSING_PERSON + "8": 500.0,
    }
    assert got["b"].total_meses_atividade == 2 and got["b"].sigla_partido == "PL"
    lost = got[marts.MISSING_PERSON + "8"]
    assert (lost.nome_deputado, lost.sigla_uf) == ("Deputado ID: 8", "N/A")
    assert marts.spend_per_person(fact, versions, require_version=True).count() == 2


def test_person_dimension_from_profile_and_log(spark):
    log = spark.createDataFrame(
        [
            (1, "1", "ana", "ana", "pt", "sp", 56, "exercício", "titular", "d", datetime(2020, 1, 1), "u", "p", "f"),
            (2, "1", "ana", "ana", "pl", "sp", 56, "exercício", "titular", "d", datetime(2022, 1, 1), "u", "p", "f"),
            (3, "2", "bob", "bob", "mdb", "rj", 56, "fim", "suplente", "d", datetime(2021, 1, 1), "u", "p", None),
            (4, "2", "bob", "bob", "mdb", "rj", 50, "fim", "suplente", "d", datetime(1979, 1, 1), "u", "p", None),
            (5, None, "x", "x", "x", "x", 1, "x", "x", "x", datetime(2021, 1, 1), "u", "p", None),
        ],
        """id long, deputado_id string, nome string, nome_eleitoral string, sigla_partido string, sigla_uf string,
        id_legislatura long, situacao string, condicao_eleitoral string, descricao_status string,
        data_hora timestamp_ntz, uri string, uri_partido string, url_foto string""",
    )
    profile = spark.createDataFrame(
        [(1, "1", "Ana S", date(1980, 12, 31), "m", "sp", "F", None, date(2024, 1, 1), "Ana", "Ana", "PSB", None, 57, None, "Exercício", "f", "e", "t", "g", "u")],
        """id long, cpf string, nome_civil string, data_nascimento date, municipio_nascimento string, uf_nascimento string,
        sexo string, redes_sociais string, ultimo_status_data date, ultimo_status_nome string,
        ultimo_status_nome_eleitoral string, ultimo_status_sigla_partido string, ultimo_status_sigla_uf string,
        ultimo_status_id_legislatura long, ultimo_status_condicao_eleitoral string, ultimo_status_situacao string,
        ultimo_status_url_foto string, ultimo_status_email_gabinete string, ultimo_status_telefone_gabinete string,
        ultimo_status_nome_gabinete string, uri string""",
    )
    people, history = staging.profiles(profile), staging.status_history(log)
    assert history.count() == 3
    dim = dimensions.person_dimension(people, history, "2025-01-01")
    got = sorted((r.nk_deputado, r.sigla_partido, r.is_current, r.em_exercicio, r.eh_titular) for r in dim.collect())
    assert got == [
        (1, "PL", False, True, True), (1, "PSB", True, True, False), (1, "PT", False, True, True), (2, "MDB", True, False, False),
    ]
    now = dim.where("sigla_partido = 'PSB'").first()
    assert (now.idade_atual, now.sexo_descricao, now.sigla_uf, now.tem_foto) == (45, "FEMININO", "SP", True)
    assert quality.duplicates(dim, ["sk_deputado"]).count() == 0
    current = dimensions.current_persons(people, history)
    assert sorted((r.deputado_id, r.fonte_origem) for r in current.collect()) == [(1, "detalhes"), (2, "historico")]
    both = staging.persons(people, history)
    assert sorted((r.deputado_id, r.cpf) for r in both.collect()) == [(1, "1"), (2, None)]


VOTE_FACT = """sk_deputado string, nk_deputado long, nk_votacao string, sigla_partido string, tipo_voto string,
    fidelidade_partidaria string, flag_tem_orientacao_partido boolean, ano_votacao int, sigla_tipo_proposicao string,
    flag_votacao_aprovada boolean, categoria_voto string"""


def test_cohesion_ignores_roll_calls_with_two_voters(spark):
    def vote(k, call, party, v):
        return ("s", k, call, party, v, "SEGUIU_ORIENTACAO", True, 2023, "PL", True, "POSICIONAMENTO")

    data = [vote(k, "v1", "PT", "SIM") for k in range(3)] + [vote(k, "v2", "PT", "NÃO" if k else "SIM") for k in range(2)]
    data += [vote(7, "v1", "PL", "SIM"), vote(8, "v1", "PL", "SIM")]
    got = marts.discipline(spark.createDataFrame(data, VOTE_FACT)).collect()
    assert [(r.sigla_partido, r.total_votacoes_analisadas, r.coesao_media_partido, r.votacoes_unanimes) for r in got] == [("PT", 1, 100.0, 1)]
    assert got[0].benchmark_coesao is None and got[0].flag_coesao_acima_benchmark is False


def test_roll_calls_held_during_a_version(spark):
    calls = spark.createDataFrame([(date(2024, 1, d),) for d in (1, 1, 5, 9)], "data_votacao date")
    versions = spark.createDataFrame(
        [
            ("all", datetime(2000, 1, 1), None), ("first", datetime(2000, 1, 1), datetime(2024, 1, 5)),
            ("mid", datetime(2024, 1, 2), datetime(2024, 1, 6)), ("late", datetime(2025, 1, 1), None),
            ("old", datetime(1999, 1, 1), datetime(2000, 1, 1)),
            ("until noon", datetime(2000, 1, 1), datetime(2024, 1, 5, 12)), ("since noon", datetime(2024, 1, 5, 12), None),
        ],
        "sk_deputado string, valid_from timestamp_ntz, valid_to timestamp_ntz",
    )
    got = {r.sk_deputado: r.votacoes_realizadas for r in marts.held_between(calls, versions).collect()}
    assert got == {"all": 4, "first": 2, "mid": 1, "late": 0, "old": 0, "until noon": 3, "since noon": 2}


def test_switching_counts_changes_over_the_whole_history(spark):
    at = [datetime(2019, 1, 1), datetime(2020, 1, 1), datetime(2023, 1, 1)]
    rows = [(1, "A", "SP", at[0], at[1]), (1, "B", "SP", at[1], at[2]), (1, "A", "SP", at[2], None), (2, "C", "SP", at[0], None)]
    df = spark.createDataFrame(rows, "deputado_id long, sigla_partido string, sigla_uf string, valid_from timestamp_ntz, valid_to timestamp_ntz")
    got = {r.deputado_id: r for r in marts.switching(df, "2024-01-01").collect()}
    assert (got[1].total_trocas_partido, got[1].partidos_distintos, got[1].historico_partidos) == (2, 2, "A → B")
    assert (got[1].trocas_2020, got[1].trocas_2023, got[1].partido_atual, got[1].dias_no_partido_atual) == (1, 1, "A", 365)
    assert got[2].classificacao_fidelidade == "Fiel ao Partido" and got[2].media_trocas_geral == 1.0


def test_activity_keeps_both_sides(spark, rows):
    votes = spark.createDataFrame([(1, "SIM", date(2024, 1, 1)), (1, "", date(2024, 1, 1))], "deputado_id long, tipo_voto string, data_votacao date")
    authors = spark.createDataFrame([(10, 2), (11, 2)], "proposicao_id long, deputado_autor_id long")
    bills = spark.createDataFrame([(10, "PL", "Aprovada"), (11, "PL", None)], "proposicao_id long, sigla_tipo string, ultimo_status_descricao_situacao string")
    got = rows(explore.activity(votes, authors, bills), "deputado_id", "total_votacoes", "ausencias", "proposicoes_criadas", "proposicoes_aprovadas", "score_atividade")
    assert got == [(1, 2, 1, 0, 0, 0.6), (2, 0, 0, 2, 1, 1.4)]


def test_quality_checks(spark, rows):
    df = spark.createDataFrame([(1, "a", 5), (1, None, -1), (2, "z", 7)], "k int, t string, v int")
    assert rows(quality.duplicates(df, ["k"])) == [(1, 2)]
    assert quality.duplicate_rows(df, ["k"]).count() == 2
    assert rows(quality.null_counts(df, ["k", "t"])) == [("k", 0), ("t", 1)]
    assert rows(quality.unexpected_values(df, "t", ["a"])) == [("z", 1)]
    parent = spark.createDataFrame([(1,), (None,)], "id int")
    assert rows(quality.orphans(df, parent, {"k": "id"}), "k") == [(2,)]
    assert rows(quality.rule_violations(df, {"positive": F.col("v") > 0})) == [("positive", 1)]
    assert rows(quality.summary({"u": quality.duplicates(df, ["k"])})) == [("u", 1, False)]
    with pytest.raises(ValueError, match="no such column"):
        quality.duplicates(df, ["id"])


def test_optional_filters_and_timeline(spark):
    df = spark.createDataFrame([(1, 2024, "PT"), (1, 2023, "PL"), (2, 2024, "PT")], "nk_deputado int, ano int, sigla_partido string")
    from ledgerlens.operators.rows import only

    assert only(df, nk_deputado=1).count() == 2
    assert only(df, nk_deputado=None, ano=2024, sigla_partido=None).count() == 2
    assert only(df, nk_deputado=[1, 2], sigla_partido="PT").count() == 2
    versions = spark.createDataFrame(
        [(1, "x", 57, datetime(2024, 1, 1)), (1, "x", 57, datetime(2024, 6, 1)), (1, "y", 57, datetime(2024, 7, 1))],
        "nk_deputado int, situacao string, id_legislatura int, valid_from timestamp_ntz",
    )
    assert person.timeline(versions, 1).count() == 2


def test_period_comparison_without_a_base_is_zero(spark, rows):
    df = spark.createDataFrame([("A", 2019, 10), ("A", 2024, 15), ("B", 2024, 5)], "sigla_partido string, ano int, valor_liquido int")
    assert rows(analyses.period_comparison(df), "sigla_partido", "variacao_percentual") == [("A", 50.0), ("B", 0.0)]


def test_distance_table_covers_all_regions():
    states = {s for members in rules.REGIONS.values() for s in members}
    assert states == set(rules.DISTANCE_TO_CAPITAL) and len(states) == 27
