"""Rule ladders: first match wins. Labels and limits below are fixed values of the domain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.functions.columns import as_col
from ledgerlens.functions.text import contains_any, standard


def classify(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Label of the first predicate that holds; the default when none does."""
    (first, label), *rest = rules
    ladder = F.when(first, _value(label))
    for predicate, label in rest:
        ladder = ladder.when(predicate, _value(label))
    return ladder.otherwise(_value(default))


def band(
    c: str | Column,
    cuts: Sequence[float],
    labels: Sequence[str],
    right_closed: bool = True,
) -> Column:
    """Numeric bands over ascending cuts, one label more than cuts.

    ``right_closed`` puts a value equal to a cut into the band below it. NULL gets the last
    label when right-closed and the first one otherwise, as an ELSE branch would.
    """
    value = as_col(c)
    if right_closed:
        return classify([(value <= k, v) for k, v in zip(cuts, labels)], labels[-1])
    downwards = list(zip(cuts, labels[1:]))[::-1]
    return classify([(value >= k, v) for k, v in downwards], labels[0])


def bins(c: str | Column, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed bins that leave NULL as NULL."""
    value = as_col(c)
    return F.when(value.isNotNull(), band(value, cuts, labels))


def lookup(c: str | Column, table: Mapping[object, object], default: object = None) -> Column:
    """Constant lookup as an expression; keep it to small fixed tables."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), as_col(c))
    return found if default is None else F.coalesce(found, _value(default))


def _value(x: object) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


# --- fixed values -----------------------------------------------------------------------

PARTY_ALIASES = {
    "AVANTE": ("AVANTE", "AVANTE-SP"),
    "CIDADANIA": ("CIDADANIA", "PPS"),
    "DEMOCRATAS": ("DEMOCRATAS", "DEM", "PFL"),
    "MDB": ("MDB", "PMDB"),
    "PATRIOTA": ("PATRIOTA", "PEN"),
    "PODE": ("PODE", "PTN"),
    "PP": ("PP", "PPB"),
    "PROS": ("PROS", "PRO"),
    "REPUBLICANOS": ("REPUBLICANOS", "PRB"),
    "SOLIDARIEDADE": ("SOLIDARIEDADE", "SD"),
    "UNIÃO": ("UNIÃO", "DEM-UNIÃO"),
}

EXPENSE_KEYWORDS = (
    ("COMBUSTIVEL", ("COMBUSTÍVEL", "COMBUSTIVEL")),
    ("TELEFONE", ("TELEFONE", "TELEFÔNICO")),
    ("HOSPEDAGEM", ("HOSPEDAGEM",)),
    ("ALIMENTACAO", ("ALIMENTAÇÃO", "ALIMENTACAO")),
    ("TRANSPORTE", ("PASSAGEM", "TRANSPORTE")),
    ("LOCACAO", ("LOCAÇÃO", "LOCACAO", "ALUGUEL")),
    ("SERVICOS", ("CONSULTORIA", "SERVIÇO", "SERVICO")),
    ("MATERIAL", ("MATERIAL", "SUPRIMENTO")),
    ("DIVULGACAO", ("DIVULGAÇÃO", "DIVULGACAO")),
)

STATUS_KEYWORDS = (
    ("APROVADA", ("APROVADA", "APROVADO")),
    ("REJEITADA", ("REJEITADA", "REJEITADO")),
    ("ARQUIVADA", ("ARQUIVADA", "ARQUIVADO")),
    ("EM_TRAMITACAO", ("TRAMITAÇÃO", "TRAMITACAO")),
    ("PRONTA_PAUTA", ("PAUTA",)),
    ("TRANSFORMADA_NORMA", ("NORMA", "LEI")),
)

BILL_STATUS_PATTERNS = (
    ("ARQUIVADA", ("%arquivad%", "%enviada ao arquivo%", "%remessa ao arquivo%")),
    ("TRAMITACAO_FINALIZADA", ("%tramitação finalizada%",)),
    ("TRANSFORMADA_EM_LEI", ("%transformado em norma%",)),
    ("TRANSFORMADA_NOVA_PROP", ("%transformado em nova proposi%",)),
    ("RETIRADA", ("%retirad%",)),
    ("DEVOLVIDA", ("%devolvid%",)),
    ("VETADA", ("%vetad%",)),
    ("PREJUDICADA", ("%prejudicial%",)),
    ("SEM_EFICACIA", ("%perdeu a eficácia%",)),
    ("AGUARDANDO", ("aguardando%", "%pronta para pauta%")),
    ("EM_TRAMITACAO", ("%tramit%", "%conjunto%")),
)

GUIDANCE_SYNONYMS = {
    "SIM": ("SIM", "S", "FAVORÁVEL", "FAVORAVEL"),
    "NÃO": ("NÃO", "NAO", "N", "CONTRÁRIO", "CONTRARIO"),
    "ABSTENÇÃO": ("ABSTENÇÃO", "ABSTENCAO", "ABSTER"),
    "OBSTRUÇÃO": ("OBSTRUÇÃO", "OBSTRUCAO", "OBSTRUIR"),
    "LIBERADO": ("LIBERADO", "LIVRE", "LIBERAL"),
}

BENCH_KEYWORDS = (
    ("BLOCO", ("%BLOCO%", "%BLOC%")),
    ("FRENTE", ("%FRENTE%", "%FRONT%")),
    ("GOVERNO", ("%GOVERNO%", "%GOV%")),
    ("OPOSIÇÃO", ("%OPOSIÇÃO%", "%OPOS%")),
)

REGIONS = {
    "Norte": ("AC", "AP", "AM", "PA", "RO", "RR", "TO"),
    "Nordeste": ("AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"),
    "Centro-Oeste": ("DF", "GO", "MT", "MS"),
    "Sudeste": ("ES", "MG", "RJ", "SP"),
    "Sul": ("PR", "RS", "SC"),
}

# Road distance to the capital in km.
DISTANCE_TO_CAPITAL = {
    "DF": 0, "GO": 200, "MT": 880, "MS": 1000,
    "MG": 400, "SP": 850, "RJ": 930, "ES": 950,
    "PR": 1050, "SC": 1200, "RS": 1500,
    "TO": 500, "PA": 1600, "AM": 1700, "RR": 1800, "AP": 1900, "AC": 2000, "RO": 1400,
    "MA": 1100, "PI": 800, "CE": 1400, "RN": 1500, "PB": 1500, "PE": 1300, "AL": 1200,
    "SE": 1100, "BA": 900,
}

NEAR_STATES = ("DF", "GO", "MG")
FAR_STATES = ("AM", "RR", "AP", "PA", "AC", "RO")
RICH_STATES = ("SP", "RJ", "MG", "RS", "PR", "SC", "DF")
POOR_STATES = ("MA", "PI", "AL", "PB", "RN", "SE", "TO", "AC", "RR", "AP")

GOVERNMENT_PARTIES_TO_2022 = ("PL", "REPUBLICANOS", "PP", "PSL", "NOVO")
GOVERNMENT_PARTIES_FROM_2023 = ("PT", "PSB", "PDT", "PCdoB", "PV", "PSOL", "REDE")

ELECTION_YEARS = (2018, 2020, 2022, 2024)
TRANSPORT_WORDS = ("PASSAG", "LOCOMO", "COMBUST", "TRANSPORT")
PUBLICITY_WORDS = ("DIVULGA",)
LARGE_PARTIES = ("PT", "PL", "PP", "MDB", "PSDB")
SMALL_PARTIES = ("NOVO", "PSOL", "REDE", "PDT")

MONTHLY_QUOTA = 30416.83

NO_VOTES = ("NÃO", "NAO")
VALUE_CUTS, VALUE_LABELS = (100, 1000, 5000), ("BAIXO", "MEDIO", "ALTO", "MUITO_ALTO")
QUOTA_CUTS = (30, 50, 70, 90)
QUOTA_LABELS = ("Muito Baixo", "Baixo", "Médio", "Alto", "Muito Alto")
SHARE_CUTS = (0.5, 0.7, 0.8, 0.9)
LOYALTY_LABELS = ("Rebelde", "Pouco Fiel", "Moderadamente Fiel", "Fiel", "Muito Fiel")
DISCIPLINE_LABELS = (
    "Indisciplinado", "Pouco Disciplinado", "Moderadamente Disciplinado",
    "Disciplinado", "Muito Disciplinado",
)
COHESION_CUTS = (50, 65, 75, 85)
COHESION_LABELS = ("Fragmentado", "Pouco Coeso", "Moderadamente Coeso", "Coeso", "Muito Coeso")
BENCH_SIZE_CUTS, BENCH_SIZE_LABELS = (10, 20, 50), ("Micro", "Pequeno", "Médio", "Grande")
ACTIVITY_CUTS = (50, 100, 200)
ACTIVITY_LABELS = ("Pouco Ativo", "Moderadamente Ativo", "Ativo", "Muito Ativo")
PRODUCTIVITY_CUTS = (5, 10, 20, 50)
PRODUCTIVITY_LABELS = ("Muito Baixo", "Baixo", "Moderado", "Produtivo", "Muito Produtivo")
EFFECTIVENESS_CUTS = (0.05, 0.15, 0.3)
EFFECTIVENESS_LABELS = (
    "Muito Baixa Efetividade", "Baixa Efetividade", "Média Efetividade", "Alta Efetividade",
)
STABILITY_CUTS = (180, 365, 730, 1095)
STABILITY_LABELS = ("Muito Instável", "Instável", "Moderado", "Estável", "Muito Estável")
CURRENT_CUTS = (180, 365, 730)
CURRENT_LABELS = ("Muito Recente", "Período Inicial", "Em Consolidação", "Estabilizado")
QUINTILE_CUTS = (0.2, 0.4, 0.6, 0.8)
SPEND_QUINTILES = ("Muito Econômico", "Econômico", "Moderado", "Alto Gasto", "Muito Alto Gasto")
PRODUCTIVITY_QUINTILES = (
    "Muito Baixa Produtividade", "Baixa Produtividade", "Moderado", "Produtivo",
    "Muito Produtivo",
)
PRESENCE_QUINTILES = (
    "Muito Baixa Presença", "Baixa Presença", "Presença Regular", "Boa Presença",
    "Excelente Presença",
)
BENCH_BIN_CUTS = (10, 30)
BENCH_BIN_LABELS = ("Pequena (≤10)", "Média (11-30)", "Grande (>30)")

# --- ladders over those values ----------------------------------------------------------


def _reverse(groups: Mapping[str, Sequence[str]]) -> dict[str, str]:
    return {member: name for name, members in groups.items() for member in members}


def _any_like(c: Column, patterns: Sequence[str]) -> Column:
    hit = c.ilike(patterns[0])
    for pattern in patterns[1:]:
        hit = hit | c.ilike(pattern)
    return hit


def party_name(c: str | Column) -> Column:
    """Current name of a party that was renamed; other names in upper case."""
    upper = F.upper(as_col(c))
    return lookup(upper, _reverse(PARTY_ALIASES), upper)


def expense_category(c: str | Column) -> Column:
    return classify([(contains_any(c, w), k) for k, w in EXPENSE_KEYWORDS], "OUTROS")


def standard_status(c: str | Column) -> Column:
    upper = F.upper(as_col(c))
    return classify([(contains_any(upper, w), k) for k, w in STATUS_KEYWORDS], upper)


def bill_status(c: str | Column) -> Column:
    text = as_col(c)
    return classify([(_any_like(text, p), k) for k, p in BILL_STATUS_PATTERNS], "OUTROS")


def guidance(c: str | Column) -> Column:
    text = standard(c)
    return lookup(text, _reverse(GUIDANCE_SYNONYMS), text)


def bench_kind(c: str | Column) -> Column:
    text = as_col(c)
    by_word = [(_any_like(text, p), k) for k, p in BENCH_KEYWORDS]
    return classify([(F.length(F.trim(text)).between(2, 10), "PARTIDO"), *by_word], "OUTRO")


def day_period(hour: str | Column) -> Column:
    h = as_col(hour)
    return classify(
        [(h.between(6, 11), "MANHÃ"), (h.between(12, 17), "TARDE"), (h.between(18, 23), "NOITE")],
        "MADRUGADA",
    )


def place_kind(internal: str | Column, external: str | Column) -> Column:
    return classify(
        [(as_col(internal).isNotNull(), "INTERNO"), (as_col(external).isNotNull(), "EXTERNO")],
        "NÃO_INFORMADO",
    )


def financial_status(document: str | Column, net: str | Column, disallowed: str | Column) -> Column:
    doc, cut = as_col(document), as_col(disallowed)
    return classify(
        [(as_col(net) > doc, "INCONSISTENTE"), (cut > doc, "GLOSA_ALTA"), (cut == 0, "SEM_GLOSA")],
        "NORMAL",
    )


def value_band(c: str | Column) -> Column:
    return band(c, VALUE_CUTS, VALUE_LABELS)


def majority_kind(yes: str | Column, no: str | Column, other: str | Column) -> Column:
    """The stricter two-thirds test comes first, otherwise it could never match."""
    y, n, o = as_col(yes), as_col(no), as_col(other)
    return classify(
        [
            (y > (y + n + o) * F.lit(0.66).cast("decimal(3,2)"), "MAIORIA_QUALIFICADA"),
            (y > n + o, "MAIORIA_SIMPLES"),
            (y == n, "EMPATE"),
        ],
        "MAIORIA_CONTRA",
    )


def vote_weight(vote: str | Column) -> Column:
    v = standard(vote)
    return classify([(v == "SIM", 1), (v.isin(*NO_VOTES), -1)], 0)


def vote_category(vote: str | Column) -> Column:
    v = standard(vote)
    return classify(
        [
            (v.isin("SIM", *NO_VOTES), "POSICIONAMENTO"),
            (v == "ABSTENÇÃO", "ABSTENCAO"),
            (v == "OBSTRUÇÃO", "OBSTRUCAO"),
        ],
        "OUTROS",
    )


def adherence(vote: str | Column, party_line: str | Column) -> Column:
    v, line = standard(vote), standard(party_line)
    return classify(
        [
            (line.isNull(), "SEM_ORIENTACAO"),
            (line == "LIBERADO", "VOTO_LIVRE"),
            (v == line, "SEGUIU_ORIENTACAO"),
            (v != line, "CONTRARIOU_ORIENTACAO"),
        ],
        "INDEFINIDO",
    )


def region(state: str | Column) -> Column:
    return lookup(state, _reverse(REGIONS), "Não identificado")


def distance(state: str | Column) -> Column:
    return lookup(state, DISTANCE_TO_CAPITAL)


def state_class(state: str | Column) -> Column:
    s = as_col(state)
    return classify([(s.isin(*RICH_STATES), "Rico"), (s.isin(*POOR_STATES), "Pobre")], "Médio")


def government_side(year: str | Column, party: str | Column) -> Column:
    y, p = as_col(year), as_col(party)
    early = y <= 2022
    return classify(
        [
            (early & p.isin(*GOVERNMENT_PARTIES_TO_2022), "Base Governo (Bolsonaro)"),
            (early, "Oposição (Bolsonaro)"),
            (p.isin(*GOVERNMENT_PARTIES_FROM_2023), "Base Governo (Lula)"),
        ],
        "Oposição (Lula)",
    )


def year_kind(year: str | Column, election_years: Sequence[int] = ELECTION_YEARS) -> Column:
    return classify([(as_col(year).isin(*election_years), "Eleitoral")], "Não-Eleitoral")


def party_size(party: str | Column) -> Column:
    p = as_col(party)
    return classify([(p.isin(*LARGE_PARTIES), "Grande"), (p.isin(*SMALL_PARTIES), "Pequeno")], "Médio")


def growth_class(pct: str | Column) -> Column:
    """Missing growth falls into the last class, as unmatched values do."""
    g = as_col(pct)
    return classify(
        [
            (g > 10, "ALTO_CRESCIMENTO"),
            (g.between(0, 10), "CRESCIMENTO_MODERADO"),
            (g.between(-10, 0), "DECLINIO_MODERADO"),
        ],
        "ALTO_DECLINIO",
    )
