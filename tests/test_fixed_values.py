"""Limits and labels that the library and the SQL of ``oracle`` share, against written-out values."""

import pytest

from ledgerlens.functions import rules
from ledgerlens.functions.keys import NULL_IN_KEY

LADDERS = {
    "VALUE": ((100, 1000, 5000), ("BAIXO", "MEDIO", "ALTO", "MUITO_ALTO")),
    "QUOTA": ((30, 50, 70, 90), ("Muito Baixo", "Baixo", "Médio", "Alto", "Muito Alto")),
    "ACTIVITY": ((50, 100, 200), ("Pouco Ativo", "Moderadamente Ativo", "Ativo", "Muito Ativo")),
    "BENCH_SIZE": ((10, 20, 50), ("Micro", "Pequeno", "Médio", "Grande")),
    "COHESION": (
        (50, 65, 75, 85),
        ("Fragmentado", "Pouco Coeso", "Moderadamente Coeso", "Coeso", "Muito Coeso"),
    ),
    "CURRENT": (
        (180, 365, 730),
        ("Muito Recente", "Período Inicial", "Em Consolidação", "Estabilizado"),
    ),
    "EFFECTIVENESS": (
        (0.05, 0.15, 0.3),
        (
            "Muito Baixa Efetividade",
            "Baixa Efetividade",
            "Média Efetividade",
            "Alta Efetividade",
        ),
    ),
}


@pytest.mark.parametrize("name", sorted(LADDERS))
def test_ladders(name):
    assert (getattr(rules, f"{name}_CUTS"), getattr(rules, f"{name}_LABELS")) == LADDERS[name]


def test_single_values():
    assert rules.MONTHLY_QUOTA == 30416.83
    assert rules.ELECTION_YEARS == (2018, 2020, 2022, 2024)
    assert (rules.NEAR_STATES, rules.FAR_STATES) == (
        ("DF", "GO", "MG"),
        ("AM", "RR", "AP", "PA", "AC", "RO"),
    )
    assert rules.BENCH_BIN_LABELS == ("Pequena (≤10)", "Média (11-30)", "Grande (>30)")
    assert NULL_IN_KEY == "_dbt_utils_surrogate_key_null_"


def test_bill_status_is_decided_in_this_order():
    assert [name for name, _ in rules.BILL_STATUS_PATTERNS] == [
        "ARQUIVADA", "TRAMITACAO_FINALIZADA", "TRANSFORMADA_EM_LEI", "TRANSFORMADA_NOVA_PROP",
        "RETIRADA", "DEVOLVIDA", "VETADA", "PREJUDICADA", "SEM_EFICACIA", "AGUARDANDO", "EM_TRAMITACAO",
    ]
