from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import dates, keys, numeric, rules, text


def values(spark, column, data, schema):
    df = spark.createDataFrame([(x,) if not isinstance(x, tuple) else x for x in data], schema)
    return [r[0] for r in df.select(column.alias("out")).collect()]


def test_value_band_puts_limits_into_the_lower_band(spark):
    got = values(spark, rules.value_band("v"), [0.0, 100.0, 100.01, 1000.0, 5000.0, 5000.01, None], "v double")
    assert got == ["BAIXO", "BAIXO", "MEDIO", "MEDIO", "ALTO", "MUITO_ALTO", "MUITO_ALTO"]


def test_left_closed_band(spark):
    c = rules.band("v", rules.QUOTA_CUTS, rules.QUOTA_LABELS, False)
    assert values(spark, c, [29.9, 30.0, 50.0, 70.0, 90.0, None], "v double") == [
        "Muito Baixo", "Baixo", "Médio", "Alto", "Muito Alto", "Muito Baixo",
    ]


def test_bins_keep_null(spark):
    c = rules.bins("v", (10, 30), rules.BENCH_BIN_LABELS)
    assert values(spark, c, [10, 11, 30, 31, None], "v int") == [
        "Pequena (≤10)", "Média (11-30)", "Média (11-30)", "Grande (>30)", None,
    ]


@pytest.mark.parametrize(
    "tally, kind",
    [
        ((67, 33, 0), "MAIORIA_QUALIFICADA"), ((66, 34, 0), "MAIORIA_SIMPLES"),
        ((51, 49, 0), "MAIORIA_SIMPLES"), ((10, 10, 0), "EMPATE"), ((40, 50, 10), "MAIORIA_CONTRA"),
        ((0, 0, 0), "EMPATE"), ((None, 1, 1), "MAIORIA_CONTRA"),
    ],
)
def test_majority_tests_the_stricter_rule_first(spark, tally, kind):
    assert values(spark, rules.majority_kind("a", "b", "c"), [tally], "a int, b int, c int") == [kind]


def test_adherence(spark):
    data = [(" sim", "SIM"), ("NÃO", "SIM"), ("SIM", None), ("SIM", "liberado "), (None, "SIM")]
    assert values(spark, rules.adherence("v", "o"), data, "v string, o string") == [
        "SEGUIU_ORIENTACAO", "CONTRARIOU_ORIENTACAO", "SEM_ORIENTACAO", "VOTO_LIVRE", "INDEFINIDO",
    ]


def test_vote_weight_and_category(spark):
    data = ["sim ", "NAO", "Não", "Abstenção", "Obstrução", "Artigo 17"]
    assert values(spark, rules.vote_weight("v"), data, "v string") == [1, -1, -1, 0, 0, 0]
    assert values(spark, rules.vote_category("v"), data, "v string") == [
        "POSICIONAMENTO", "POSICIONAMENTO", "POSICIONAMENTO", "ABSTENCAO", "OBSTRUCAO", "OUTROS",
    ]


def test_guidance_and_bench(spark):
    assert values(spark, rules.guidance("v"), [" favorável", "N", "Livre", "Outra", None], "v string") == [
        "SIM", "NÃO", "LIBERADO", "OUTRA", None,
    ]
    long_names = ["PT", "Bloco da Maioria X", "Frente Parlamentar", "Liderança do Governo", "x", None]
    assert values(spark, rules.bench_kind("v"), long_names, "v string") == [
        "PARTIDO", "BLOCO", "FRENTE", "GOVERNO", "OUTRO", "OUTRO",
    ]


def test_bill_status_order(spark):
    data = [
        "Enviada ao Arquivo", "Tramitação Finalizada", "Transformado em Norma Jurídica", "Retirado",
        "Aguardando Parecer", "Tramitando em Conjunto", "?", None,
    ]
    assert values(spark, rules.bill_status("v"), data, "v string") == [
        "ARQUIVADA", "TRAMITACAO_FINALIZADA", "TRANSFORMADA_EM_LEI", "RETIRADA", "AGUARDANDO",
        "EM_TRAMITACAO", "OUTROS", "OUTROS",
    ]


def test_names_categories_and_places(spark):
    assert values(spark, rules.party_name("v"), ["pmdb", "DEM", "PT"], "v string") == ["MDB", "DEMOCRATAS", "PT"]
    kinds = ["Combustíveis", "COMBUSTÍVEL", "passagem aérea", "Locação", None]
    assert values(spark, rules.expense_category("v"), kinds, "v string") == [
        "OUTROS", "COMBUSTIVEL", "TRANSPORTE", "LOCACAO", "OUTROS",
    ]
    assert values(spark, rules.region("v"), ["SP", "AC", "XX", None], "v string") == [
        "Sudeste", "Norte", "Não identificado", "Não identificado",
    ]
    hours = [0, 5, 6, 11, 12, 17, 18, 23]
    assert values(spark, rules.day_period("v"), hours, "v int") == [
        "MADRUGADA", "MADRUGADA", "MANHÃ", "MANHÃ", "TARDE", "TARDE", "NOITE", "NOITE",
    ]
    growth = [11.0, 10.0, 0.0, -0.1, -10.0, -10.1, None]
    assert values(spark, rules.growth_class("v"), growth, "v double") == [
        "ALTO_CRESCIMENTO", "CRESCIMENTO_MODERADO", "CRESCIMENTO_MODERADO", "DECLINIO_MODERADO",
        "DECLINIO_MODERADO", "ALTO_DECLINIO", "ALTO_DECLINIO",
    ]
    sides = [(2022, "PL"), (2022, "PT"), (2023, "PT"), (2023, "PL")]
    assert values(spark, rules.government_side("a", "p"), sides, "a int, p string") == [
        "Base Governo (Bolsonaro)", "Oposição (Bolsonaro)", "Base Governo (Lula)", "Oposição (Lula)",
    ]


def test_surrogate_key_separates_null_from_text(spark):
    data = [(1, None), (1, ""), (1, "x")]
    got = values(spark, keys.surrogate_key("a", "b"), data, "a int, b string")
    assert len(set(got)) == 3 and all(len(k) == 32 for k in got)


def test_audit_hash_keeps_columns_apart(spark):
    got = values(spark, keys.audit_hash("a", "b"), [("ab", "c"), ("a", "bc")], "a string, b string")
    assert got[0] != got[1] and len(got[0]) == 64


def test_id_from_uri(spark):
    uris = ["https://x/proposicoes/123", "https://x/123/", "abc", None]
    assert values(spark, keys.id_from_uri("v"), uris, "v string") == [123, None, None, None]
    assert values(spark, keys.id_from_uri("v", "deputados"), uris[:1], "v string") == [None]


def test_date_differences_count_boundaries(spark):
    night = [(datetime(2023, 12, 31, 23, 59), datetime(2024, 1, 1, 0, 1))]
    schema = "a timestamp_ntz, b timestamp_ntz"
    assert values(spark, dates.years_between("a", "b"), night, schema) == [1]
    assert values(spark, dates.hours_between("a", "b"), night, schema) == [1]
    assert values(spark, dates.days_between("a", "b"), night, schema) == [1]


def test_calendar_labels(spark):
    assert values(spark, dates.quarter_label("m"), [3, 4, 12], "m int") == ["T1", "T2", "T4"]
    assert values(spark, dates.year_month("y", "m"), [(2024, 3)], "y int, m int") == ["2024-03"]
    assert values(spark, dates.month_short("m"), [1, 12, 13], "m int") == ["Jan", "Dez", None]
    sunday = [datetime(2024, 1, 7)]
    assert values(spark, dates.weekday_sunday_zero("d"), sunday, "d timestamp_ntz") == [0]


def test_rounding_and_ratios(spark):
    assert values(spark, numeric.round_to("v"), [1.005, 2.675, None], "v double") == [1.01, 2.68, None]
    assert values(spark, numeric.ratio("a", "b"), [(1, 0), (1, 2), (1, None)], "a int, b int") == [None, 0.5, None]
    assert values(spark, numeric.percent_or_zero("a", "b"), [(1, 0), (1, 3)], "a int, b int") == [0.0, 33.33]
    assert values(spark, numeric.currency("v"), [1234567.5], "v double") == ["R$ 1,234,567.50"]


def test_text_flags_are_never_null(spark):
    assert values(spark, text.filled("v"), ["a", " ", None], "v string") == [True, False, False]
    assert values(spark, text.contains_any("v", ["X"]), ["ax", None], "v string") == [True, False]
    assert values(spark, text.truthy("v"), ["true", " 1", "s", "no", None], "v string") == [
        True, True, True, False, False,
    ]
    assert values(spark, F.lit(1), ["a"], "v string") == [1]
