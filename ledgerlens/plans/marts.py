"""Marts: spending, productivity, presence, discipline, switching and the party scorecard."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import dates, rules
from ledgerlens.functions.columns import count_where, mean_where, sum_where, truth
from ledgerlens.functions.keys import key_or_placeholder, surrogate_key
from ledgerlens.functions.numeric import (
    mean_rounded,
    percent,
    percent_or_zero,
    ratio,
    round_to,
)
from ledgerlens.functions.rules import band, classify
from ledgerlens.operators.aggregates import text_list
from ledgerlens.operators.history import stays
from ledgerlens.operators.joins import with_benchmark, with_group_stats
from ledgerlens.operators.lineage import materialize
from ledgerlens.operators.ordered import dimension_percent_ranks, dimension_row_ranks
from ledgerlens.operators.windows import previous_in_time
from ledgerlens.plans.facts import with_versions

RECENT_YEARS = (2023, 2022, 2021)
MISSING_PERSON = "DEPUTADO_NAO_ENCONTRADO_"

PERSON = (
    "sk_deputado", "deputado_id", "nome_deputado", "nome_civil", "sigla_partido", "sigla_uf",
    "condicao_eleitoral", "situacao",
)

VERSION = ("nk_deputado", "sk_deputado")
# result column, and the value band it sums
SPENDING_BANDS = {
    "gastos_valor_alto": "ALTO", "gastos_valor_medio": "MEDIO",
    "gastos_valor_baixo": "BAIXO", "gastos_valor_muito_alto": "MUITO_ALTO",
}


def _per_month(rows: DataFrame, *measures: Column) -> DataFrame:
    """Measures per version and month, with the documents that have their first line in it."""
    nth = F.row_number().over(Window.partitionBy(*VERSION, "cod_documento").orderBy("_month"))
    documents = count_where((F.col("_nth") == 1) & F.col("cod_documento").isNotNull())
    return rows.withColumn("_nth", nth).groupBy(*VERSION, "_month").agg(documents.alias("_docs"), *measures)


def _exact(c: str | Column) -> Column:
    """A rounded measure as a decimal, so that averages over it are exact."""
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,4)")


def spend_per_person(
    facts: DataFrame,
    versions: DataFrame,
    quota: float = rules.MONTHLY_QUOTA,
    require_version: bool = False,
    by_key: bool = False,
) -> DataFrame:
    """Spending per person version with use of the monthly quota.

    Documents without a valid version keep a placeholder, or are left out with
    ``require_version``. Only the version key travels with the documents; names and other
    attributes are joined to the finished totals. The documents are read and joined once and stay in
    the tasks of that join, one for each person: they are summed per month, where a document counts
    in its first one, then per version. No set of documents is held; one sort, which can spill, puts
    the lines of a document side by side. Where both tables are stored in buckets by person,
    ``by_key`` does all of it without moving a row.
    """
    joined = spending_lines(facts, versions, require_version, by_key)
    amount = F.col("valor_documento")
    monthly = _per_month(
        joined,
        F.count(F.lit(1)).alias("_rows"),
        F.sum(amount).alias("_doc"),
        F.sum("valor_liquido").alias("_net"),
        F.sum("valor_glosa").alias("_cut"),
        *[
            sum_where(F.col("faixa_valor") == label, amount, 0).alias(name)
            for name, label in SPENDING_BANDS.items()
        ],
        F.min("data_documento").alias("_first"),
        F.max("data_documento").alias("_last"),
    )
    return _spending_of_months(monthly, versions, quota)


def spending_lines(
    facts: DataFrame, versions: DataFrame, require_version: bool = False, by_key: bool = False
) -> DataFrame:
    """Documents with a positive amount beside the key of their person version and their month."""
    keys = versions.select("nk_deputado", "sk_deputado", "valid_from", "valid_to")
    joined = with_versions(
        facts.where(F.col("valor_documento") > 0), keys, "nk_deputado", "data_documento",
        "inner" if require_version else "left", by_key,
    )
    return joined.withColumns(
        {
            "sk_deputado": key_or_placeholder("sk_deputado", "nk_deputado", MISSING_PERSON),
            "_month": dates.month_index("ano", "mes"),
        }
    )


def spending_of_documents(
    merged: DataFrame, versions: DataFrame, quota: float = rules.MONTHLY_QUOTA
) -> DataFrame:
    """Spending per person version out of one row per version, document and month."""
    monthly = _per_month(
        merged,
        *[F.sum(c).alias(c) for c in ("_rows", "_doc", "_net", "_cut", *SPENDING_BANDS)],
        F.min("_first").alias("_first"),
        F.max("_last").alias("_last"),
    )
    return _spending_of_months(monthly, versions, quota)


def _spending_of_months(monthly: DataFrame, versions: DataFrame, quota: float) -> DataFrame:
    """Spending per person version out of one row per version and month."""
    version, bands = list(VERSION), SPENDING_BANDS
    known = monthly.groupBy(*version).agg(
        F.sum("_docs").alias("total_documentos"),
        F.count("_month").alias("total_meses_atividade"),
        F.sum("_doc").alias("valor_total_gasto"),
        F.sum("_net").alias("valor_total_liquido"),
        F.sum("_cut").alias("valor_total_glosa"),
        round_to(ratio(F.sum("_doc"), F.sum("_rows"))).alias("valor_medio_mensal"),
        round_to(ratio(F.sum("_net"), F.sum("_rows"))).alias("valor_liquido_medio_mensal"),
        percent(F.sum("_cut"), F.sum("_doc")).alias("percentual_glosa"),
        *[F.round(F.sum(name), 2).alias(name) for name in bands],
        F.min("_first").alias("primeira_despesa"),
        F.max("_last").alias("ultima_despesa"),
    )
    attributes = [c for c in PERSON if c not in ("sk_deputado", "deputado_id")]
    own = versions.select(
        F.col("nk_deputado").alias("_nk"), F.col("sk_deputado").alias("_sk"), *attributes
    ).hint("merge")  # as many as persons: not for the driver
    # the person is the only equal key, so that the totals stay in their tasks
    same = (F.col("nk_deputado") == F.col("_nk")) & F.col("sk_deputado").between(F.col("_sk"), F.col("_sk"))
    known = known.join(own, same, "left")
    known = known.select("sk_deputado", *[c for c in known.columns if c not in ("sk_deputado", "_nk", "_sk")])
    na = F.lit("N/A")
    limit = F.lit(quota) * F.col("total_meses_atividade").cast("double")
    use = F.col("percentual_uso_cota_mensal")
    return (
        known.withColumns(
            {
                "nome_deputado": key_or_placeholder("nome_deputado", "nk_deputado", "Deputado ID: "),
                **{c: F.coalesce(c, na) for c in attributes[1:]},
                "percentual_uso_cota_mensal": percent("valor_total_liquido", limit),
            }
        )
        .withColumnRenamed("nk_deputado", "deputado_id")
        .withColumns(
            {
                "sk_gastos_deputado": surrogate_key("sk_deputado"),
                "classificacao_uso_cota": band(use, rules.QUOTA_CUTS, rules.QUOTA_LABELS, False),
                "flag_baixa_glosa": truth(F.col("percentual_glosa") < 5),
                "flag_uso_eficiente": truth(use < 80),
            }
        )
    )


def spend_with_benchmarks(facts: DataFrame, versions: DataFrame) -> DataFrame:
    """Spending per person version beside the averages of its state and its party."""
    people = materialize(spend_per_person(facts, versions, require_version=True), "spending")

    def averages(of: str) -> dict[str, Column]:
        return {
            f"media_gastos_{of}": mean_rounded("valor_total_liquido"),
            f"media_uso_cota_{of}": mean_rounded(_exact("percentual_uso_cota_mensal")),
        }

    both = with_group_stats(people, ["sigla_uf"], averages("uf"), few=True)
    both = with_group_stats(both, ["sigla_partido"], averages("partido"), few=True)
    spent = F.col("valor_total_liquido").cast("double")

    def against(mean: str, of: str) -> Column:
        return classify([(spent > F.col(mean), f"Acima da Média {of}")], f"Abaixo da Média {of}")

    return both.withColumns(
        {
            "comparacao_uf": against("media_gastos_uf", "UF"),
            "comparacao_partido": against("media_gastos_partido", "Partido"),
        }
    )


def productivity(
    authors: DataFrame,
    bill_facts: DataFrame,
    persons: DataFrame,
    years: Sequence[int] = RECENT_YEARS,
) -> DataFrame:
    """Bills per person as first proponent, with success rates and peer averages."""
    joined = (
        authors.select("proposicao_id", "deputado_autor_id", "eh_proponente")
        .join(
            bill_facts.select(
                F.col("nk_proposicao").alias("proposicao_id"), "situacao_proposicao", "sigla_tipo",
                "total_votacoes", "dias_tramitacao", "data_apresentacao", "total_autores",
            ),
            "proposicao_id",
        )
        .withColumnRenamed("deputado_autor_id", "deputado_id")
    )
    first = truth(F.col("eh_proponente"))
    status, kind = F.col("situacao_proposicao"), F.col("sigla_tipo")
    kinds = {
        "projetos_lei": "PL", "propostas_emenda_constitucional": "PEC",
        "projetos_decreto_legislativo": "PDC", "projetos_lei_complementar": "PLP",
        "requerimentos": "REQ",
    }
    # aggregated per person id before the attributes are joined
    numbers = joined.groupBy("deputado_id").agg(
        count_where(first).alias("total_proposicoes"),
        count_where(first & status.isin("TRANSFORMADA_EM_LEI", "APROVADA")).alias(
            "proposicoes_aprovadas"
        ),
        count_where(first & (status == "REJEITADA")).alias("proposicoes_rejeitadas"),
        count_where(first & (status == "EM_TRAMITACAO")).alias("proposicoes_em_tramitacao"),
        count_where(first & (status == "ARQUIVADA")).alias("proposicoes_arquivadas"),
        *[count_where(first & (kind == code)).alias(name) for name, code in kinds.items()],
        count_where(first & (F.col("total_votacoes") > 0)).alias("proposicoes_votadas"),
        round_to(mean_where(first, "total_votacoes")).alias("media_votacoes_por_proposicao"),
        sum_where(first, "total_votacoes", 0).alias("total_votacoes_proposicoes"),
        round_to(mean_where(first, "dias_tramitacao")).alias("tempo_medio_tramitacao_dias"),
        F.min(F.when(first, F.col("data_apresentacao"))).alias("primeira_proposicao"),
        F.max(F.when(first, F.col("data_apresentacao"))).alias("ultima_proposicao"),
        *[
            count_where(first & (F.year("data_apresentacao") == y)).alias(f"proposicoes_{y}")
            for y in years
        ],
        F.count(F.lit(1)).alias("total_participacoes_proposicoes"),
        mean_rounded("total_autores").alias("media_coautores"),
    )
    people = persons.select(F.col("nk_deputado").alias("deputado_id"), *[c for c in PERSON if c != "deputado_id"])
    total, approved = F.col("total_proposicoes"), F.col("proposicoes_aprovadas")
    success = F.when(total > 0, ratio(approved, total))
    rated = numbers.join(people.hint("merge"), "deputado_id").withColumns(
        {
            "taxa_aprovacao_percentual": percent_or_zero(approved, total),
            "taxa_rejeicao_percentual": percent_or_zero("proposicoes_rejeitadas", total),
            "_success": F.coalesce(success * 100, F.lit(0.0)).cast("decimal(18,8)"),
        }
    )

    def averages(of: str) -> dict[str, Column]:
        return {
            f"media_proposicoes_{of}": mean_rounded("total_proposicoes"),
            f"taxa_aprovacao_media_{of}": mean_rounded("_success"),
        }

    rated = materialize(rated, "productivity")  # read by the rows and by both averages
    both = with_group_stats(rated, ["sigla_uf"], averages("uf"), few=True)
    both = with_group_stats(both, ["sigla_partido"], averages("partido"), few=True)
    share = total.cast("double")
    return both.drop("_success").withColumns(
        {
            "sk_produtividade_deputado": surrogate_key("sk_deputado"),
            "classificacao_produtividade": band(
                total, rules.PRODUCTIVITY_CUTS, rules.PRODUCTIVITY_LABELS, False
            ),
            "classificacao_efetividade": band(
                success, rules.EFFECTIVENESS_CUTS, rules.EFFECTIVENESS_LABELS, False
            ),
            "perfil_especializacao": classify(
                [
                    (F.col("projetos_lei") >= share * 0.5, "Especialista em Projetos de Lei"),
                    (F.col("propostas_emenda_constitucional") >= share * 0.3, "Especialista em PECs"),
                    (F.col("requerimentos") >= share * 0.5, "Especialista em Requerimentos"),
                ],
                "Generalista",
            ),
            "flag_acima_media_uf": truth(share > F.col("media_proposicoes_uf")),
            "flag_acima_media_partido": truth(share > F.col("media_proposicoes_partido")),
            "flag_alta_efetividade": truth(success > 0.2),
            "flag_colaborativo": truth(F.col("media_coautores") > 2),
        }
    )


def _vote_counts(years: Sequence[int]) -> dict[str, Column]:
    vote, line = F.col("tipo_voto"), F.col("fidelidade_partidaria")
    won, kind = F.col("flag_votacao_aprovada"), F.col("sigla_tipo_proposicao")
    counts = {
        "votos_sim": vote == "SIM",
        "votos_nao": vote.isin(*rules.NO_VOTES),
        "votos_abstencao": vote == "ABSTENÇÃO",
        "votos_obstrucao": vote == "OBSTRUÇÃO",
        "votos_seguiu_orientacao": line == "SEGUIU_ORIENTACAO",
        "votos_contrariou_orientacao": line == "CONTRARIOU_ORIENTACAO",
        "votos_sem_orientacao": line == "SEM_ORIENTACAO",
        "votos_livres": line == "VOTO_LIVRE",
        "votos_com_orientacao_disponivel": F.col("flag_tem_orientacao_partido"),
        **{f"votos_{y}": F.col("ano_votacao") == y for y in years},
        "votos_projetos_lei": kind == "PL",
        "votos_pec": kind == "PEC",
        "votos_medida_provisoria": kind == "MPV",
        "votos_com_posicionamento": F.col("categoria_voto") == "POSICIONAMENTO",
        "total_votos_lado_vencedor": (won & (vote == "SIM")) | (~won & vote.isin(*rules.NO_VOTES)),
    }
    return counts


def held_between(roll_calls: DataFrame, versions: DataFrame) -> DataFrame:
    """Roll calls held on the days on which each person version was valid.

    A roll call has a day but no hour, so a version that begins or ends within a day counts all
    roll calls of that day: whoever voted in one of them had it held. Roll calls are counted per
    day and summed along the calendar; a version then needs the sums at its two ends instead of a
    match with every roll call. The calendar has one row per day and is what is broadcast, not the
    versions.
    """
    daily = roll_calls.groupBy("data_votacao").agg(F.count(F.lit(1)).alias("_n"))
    span = daily.agg(
        F.min("data_votacao").alias("_lo"), F.max("data_votacao").alias("_hi")
    )
    days = span.select(
        F.explode(F.sequence(F.col("_lo"), F.date_add("_hi", 1))).alias("data_votacao")
    )
    up_to = Window.orderBy("data_votacao").rowsBetween(Window.unboundedPreceding, -1)
    before = days.join(daily, "data_votacao", "left").select(
        F.col("data_votacao").alias("_day"),
        F.coalesce(F.sum("_n").over(up_to), F.lit(0)).alias("_before"),
    )
    limits = with_benchmark(
        versions.select("sk_deputado", "valid_from", "valid_to"),
        {"_lo": F.min("data_votacao"), "_hi": F.max("data_votacao")},
        daily,
    )
    top = F.date_add("_hi", 1)
    last_day = F.expr("CAST(valid_to - INTERVAL '0.000001' SECOND AS DATE)")
    clipped = limits.select(
        "sk_deputado",
        F.least(F.greatest(F.col("valid_from").cast("date"), F.col("_lo")), top).alias("_from"),
        F.least(
            F.greatest(F.coalesce(F.date_add(last_day, 1), top), F.col("_lo")), top
        ).alias("_to"),
    )
    first = before.select(F.col("_day").alias("_from"), F.col("_before").alias("_a"))
    last = before.select(F.col("_day").alias("_to"), F.col("_before").alias("_b"))
    return (
        clipped.join(F.broadcast(first), "_from")
        .join(F.broadcast(last), "_to")
        .select("sk_deputado", (F.col("_b") - F.col("_a")).alias("votacoes_realizadas"))
    )


def presence(
    vote_facts: DataFrame,
    roll_calls: DataFrame,
    versions: DataFrame,
    years: Sequence[int] = RECENT_YEARS,
) -> DataFrame:
    """Participation and party loyalty per person version, with peer averages.

    Presence is the share of the roll calls held during the version that the person attended.
    """
    counts = _vote_counts(years)
    # votes are unique per (roll call, person), so attended roll calls are the rows themselves
    numbers = vote_facts.groupBy(
        "sk_deputado", F.col("nk_deputado").alias("deputado_id"), "nome_deputado",
        "sigla_partido", "sigla_uf", "condicao_eleitoral",
    ).agg(
        F.count("nk_votacao").alias("total_votacoes_participadas"),
        F.count(F.lit(1)).alias("total_votos_registrados"),
        *[count_where(p).alias(n) for n, p in counts.items()],
        F.min("data_votacao").alias("primeira_votacao"),
        F.max("data_votacao").alias("ultima_votacao"),
    )
    held = held_between(roll_calls, versions)
    total = F.col("total_votos_registrados")
    guided, followed = F.col("votos_com_orientacao_disponivel"), F.col("votos_seguiu_orientacao")
    loyalty = F.when(guided > 0, ratio(followed, guided))
    rated = numbers.join(held, "sk_deputado", "left").withColumns(
        {
            "taxa_presenca_percentual": percent(
                "total_votacoes_participadas", "votacoes_realizadas"
            ),
            "percentual_votos_sim": percent_or_zero("votos_sim", total),
            "percentual_votos_nao": percent_or_zero("votos_nao", total),
            "taxa_fidelidade_partidaria": percent_or_zero(followed, guided),
            "taxa_rebeldia_partidaria": percent_or_zero("votos_contrariou_orientacao", guided),
            "taxa_efetividade_politica": percent_or_zero(
                "total_votos_lado_vencedor", "votos_com_posicionamento"
            ),
            "_loyal": F.coalesce(loyalty * 100, F.lit(0.0)).cast("decimal(18,8)"),
        }
    )
    rated = materialize(rated, "presence")  # read by the rows and by both averages
    both = with_group_stats(
        rated, ["sigla_uf"], {"taxa_fidelidade_media_uf": mean_rounded("_loyal")}, few=True
    )
    both = with_group_stats(
        both, ["sigla_partido"], {"taxa_fidelidade_media_partido": mean_rounded("_loyal")}, few=True
    )
    return both.drop("_loyal").withColumns(
        {
            "sk_presenca_deputado": surrogate_key("sk_deputado"),
            "classificacao_fidelidade": band(loyalty, rules.SHARE_CUTS, rules.LOYALTY_LABELS, False),
            "classificacao_participacao": band(
                total, rules.ACTIVITY_CUTS, rules.ACTIVITY_LABELS, False
            ),
            "perfil_votacao": classify(
                [
                    (ratio("votos_abstencao", total) > 0.3, "Alto Abstencionista"),
                    (ratio("votos_obstrucao", total) > 0.2, "Alto Obstrucionista"),
                    (ratio(F.col("votos_sim") + F.col("votos_nao"), total) > 0.8, "Decisivo"),
                ],
                "Equilibrado",
            ),
            "flag_alta_fidelidade": truth(loyalty >= 0.85),
            "flag_participativo": truth(total >= 100),
            "flag_fidelidade_acima_media_uf": truth(
                loyalty > F.col("taxa_fidelidade_media_uf") / 100
            ),
            "flag_fidelidade_acima_media_partido": truth(
                loyalty > F.col("taxa_fidelidade_media_partido") / 100
            ),
        }
    )


def discipline(
    vote_facts: DataFrame,
    years: Sequence[int] = RECENT_YEARS,
    smallest_vote: int = 3,
    smallest_party: int = 3,
    benchmark_party: int = 5,
) -> DataFrame:
    """Party discipline and internal cohesion over all roll calls.

    Votes are counted per (party, roll call) once; both the party totals and the cohesion
    measures come from that table.
    """
    votes = vote_facts.where(F.col("sigla_partido").isNotNull())
    counts = _vote_counts(years)
    per_call = votes.groupBy("sigla_partido", "nk_votacao").agg(
        F.count(F.lit(1)).alias("_votes"),
        F.count_distinct("tipo_voto").alias("_kinds"),
        *[count_where(p).alias(n) for n, p in counts.items()],
    )
    majority = F.greatest("votos_sim", "votos_nao", "votos_abstencao", "votos_obstrucao")
    big_enough = F.col("_votes") >= smallest_vote
    cohesion = F.when(big_enough, percent(majority, "_votes"))
    rated = per_call.withColumn("_cohesion", cohesion)
    c = F.col("_cohesion")
    names = {
        "votos_seguiu_orientacao": "votos_fieis",
        "votos_contrariou_orientacao": "votos_rebeldes",
        "votos_com_orientacao_disponivel": "votos_com_orientacao",
        "votos_sim": "votos_sim_partido",
        "votos_nao": "votos_nao_partido",
        "votos_abstencao": "votos_abstencao_partido",
        "votos_obstrucao": "votos_obstrucao_partido",
    }
    skipped = ("votos_sem_orientacao", "votos_livres")
    parties = rated.groupBy("sigla_partido").agg(
        F.sum("_votes").alias("total_votos_partido"),
        F.count(F.lit(1)).alias("total_votacoes_partido"),
        *[F.sum(n).alias(names.get(n, n)) for n in counts if n not in skipped],
        F.count(c).alias("total_votacoes_analisadas"),
        mean_rounded(c.cast("decimal(18,4)")).alias("_mean"),
        round_to(F.stddev_samp(c)).alias("_std"),
        count_where(c >= 90).alias("votacoes_alta_coesao"),
        count_where(c < 60).alias("votacoes_baixa_coesao"),
        count_where(big_enough & (F.col("_kinds") == 1)).alias("votacoes_unanimes"),
    )
    members = (
        votes.select("sigla_partido", "nk_deputado").distinct()
        .groupBy("sigla_partido").agg(F.count(F.lit(1)).alias("total_deputados_partido"))
    )
    table = materialize(parties.join(members, "sigla_partido"), "parties")
    big = F.col("total_deputados_partido") >= benchmark_party
    loyal_share = ratio("votos_fieis", "votos_com_orientacao")
    bench = {
        "benchmark_fidelidade": mean_rounded(
            F.when(big, loyal_share * 100).cast("decimal(18,8)")
        ),
        "benchmark_coesao": mean_rounded(F.when(big, _exact("_mean"))),
    }
    guided, loyal = F.col("votos_com_orientacao"), F.col("votos_fieis")
    share = F.when(guided > 0, ratio(loyal, guided))
    mean_cohesion = F.col("coesao_media_partido")
    return (
        with_benchmark(table, bench)
        .where(F.col("total_deputados_partido") >= smallest_party)
        .withColumns(
            {
                "sk_fidelidade_partido": surrogate_key("sigla_partido"),
                "taxa_fidelidade_partidaria": percent_or_zero(loyal, guided),
                "taxa_rebeldia_partidaria": percent_or_zero("votos_rebeldes", guided),
                "coesao_media_partido": F.coalesce("_mean", F.lit(0.0)),
                "desvio_coesao": F.coalesce("_std", F.lit(0.0)),
                "percentual_alta_coesao": percent_or_zero(
                    "votacoes_alta_coesao", "total_votacoes_analisadas"
                ),
                "tendencia_posicionamento": classify(
                    [
                        (F.col("votos_sim_partido") > F.col("votos_nao_partido"), "GOVERNO"),
                        (F.col("votos_nao_partido") > F.col("votos_sim_partido"), "OPOSIÇÃO"),
                    ],
                    "NEUTRO",
                ),
                "taxa_efetividade_politica": percent_or_zero(
                    "total_votos_lado_vencedor", "votos_com_posicionamento"
                ),
                "classificacao_disciplina": band(
                    share, rules.SHARE_CUTS, rules.DISCIPLINE_LABELS, False
                ),
                "tamanho_bancada": band(
                    "total_deputados_partido", rules.BENCH_SIZE_CUTS, rules.BENCH_SIZE_LABELS, False
                ),
                "flag_alta_disciplina": truth(share >= 0.85),
                "flag_fidelidade_acima_benchmark": truth(
                    share > F.col("benchmark_fidelidade") / 100
                ),
            }
        )
        .drop("_mean", "_std")
        .withColumns(
            {
                "classificacao_coesao": band(
                    mean_cohesion, rules.COHESION_CUTS, rules.COHESION_LABELS, False
                ),
                "flag_alta_coesao": truth(mean_cohesion >= 80),
                "flag_coesao_acima_benchmark": truth(mean_cohesion > F.col("benchmark_coesao")),
            }
        )
    )


def switching(
    history: DataFrame,
    as_of: str,
    years: Sequence[int] = (2023, 2022, 2021, 2020, 2019),
) -> DataFrame:
    """Party switches per person over the whole version history, at ``as_of``.

    Needs ``deputado_id, sigla_partido, sigla_uf, valid_from, valid_to``. The previous party is
    taken from the full history before anything is filtered.
    """
    today = F.lit(as_of).cast("date")
    rows = previous_in_time(history, ["deputado_id"], "valid_from", "sigla_partido", "_before")
    changed = truth(F.col("_before") != F.col("sigla_partido"))
    rows = stays(rows, today, "_days").withColumn("_changed", changed)
    newest = F.max_by(F.struct("sigla_partido", "sigla_uf"), F.col("valid_from"))
    people = rows.groupBy("deputado_id").agg(
        newest.alias("_now"),
        F.count(F.lit(1)).alias("total_periodos_partidarios"),
        count_where(F.col("_changed")).alias("total_trocas_partido"),
        F.min("valid_from").alias("primeira_data_mandato"),
        F.max("valid_from").alias("ultima_mudanca_partido"),
        round_to(ratio(F.sum("_days"), F.count("_days")), 0).alias("dias_medio_por_partido"),
        F.max("_days").alias("maior_tempo_consecutivo_partido"),
        *[
            count_where(F.col("_changed") & (F.year("valid_from") == y)).alias(f"trocas_{y}")
            for y in years
        ],
    )
    listed = text_list(
        history, ["deputado_id"], "sigla_partido", "historico_partidos", " → ", "valid_from"
    )
    kinds = (
        history.select("deputado_id", "sigla_partido").dropna().distinct()
        .groupBy("deputado_id").agg(F.count(F.lit(1)).alias("partidos_distintos"))
    )
    table = (
        people.select(
            "*", F.col("_now.sigla_partido").alias("partido_atual"), F.col("_now.sigla_uf").alias("sigla_uf")
        )
        .drop("_now")
        .join(listed, "deputado_id", "left")
        .join(kinds, "deputado_id", "left")
        .withColumn(
            "dias_no_partido_atual",
            dates.days_between("ultima_mudanca_partido", today).cast("bigint"),
        )
    )
    table = materialize(table, "switching")
    n = F.col("total_trocas_partido")
    both = with_benchmark(
        table,
        {
            "media_trocas_geral": mean_rounded("total_trocas_partido"),
            "total_deputados_sem_troca": count_where(n == 0),
            "total_deputados_multiplas_trocas": count_where(n >= 3),
            "total_deputados_analisados": F.count(F.lit(1)),
        },
    )
    both = with_group_stats(
        both,
        ["sigla_uf"],
        {
            "media_trocas_uf": mean_rounded("total_trocas_partido"),
            "deputados_com_multiplas_trocas_uf": count_where(n >= 2),
        },
        few=True,
    )
    in_office = dates.years_between("primeira_data_mandato", today)
    days_in_office = dates.days_between("primeira_data_mandato", today)
    recent = F.col(f"trocas_{years[0]}") + F.col(f"trocas_{years[1]}")
    early = F.col(f"trocas_{years[-1]}") + F.col(f"trocas_{years[-2]}")
    most = n.cast("double") * 0.7
    mean_days = F.col("dias_medio_por_partido")
    return both.withColumns(
        {
            "sk_trocas_deputado": surrogate_key("deputado_id"),
            "trocas_por_ano_mandato": F.when(in_office > 0, round_to(ratio(n, in_office))).otherwise(
                F.lit(0.0)
            ),
            "percentual_maior_estabilidade": percent(
                "maior_tempo_consecutivo_partido", days_in_office
            ),
            "classificacao_fidelidade": classify(
                [
                    (n == 0, "Fiel ao Partido"),
                    (n == 1, "Uma Troca"),
                    (n == 2, "Duas Trocas"),
                    (n.between(3, 4), "Múltiplas Trocas"),
                ],
                "Muito Instável",
            ),
            "classificacao_estabilidade": band(
                mean_days, rules.STABILITY_CUTS, rules.STABILITY_LABELS, False
            ),
            "perfil_migracao": classify(
                [
                    (n == 0, "Sem Migração"),
                    (recent >= most, "Migração Recente"),
                    (early >= most, "Migração Início Mandato"),
                ],
                "Migração Distribuída",
            ),
            "status_partido_atual": band(
                "dias_no_partido_atual", rules.CURRENT_CUTS, rules.CURRENT_LABELS, False
            ),
            "flag_deputado_fiel": n == 0,
            "flag_multiplas_trocas": n >= 3,
            "flag_troca_recente": F.col(f"trocas_{years[0]}") > 0,
            "flag_acima_media_geral": truth(n > F.col("media_trocas_geral")),
            "flag_acima_media_uf": truth(n > F.col("media_trocas_uf")),
            "flag_alta_rotatividade": truth(mean_days < 365),
        }
    )


def scorecard(
    persons: DataFrame,
    spending: DataFrame,
    productive: DataFrame,
    present: DataFrame,
    disciplined: DataFrame,
    smallest_party: int = 3,
) -> DataFrame:
    """Parties compared over spending, productivity, presence and discipline.

    Weights of the score: economy 20, productivity 25, presence 20, loyalty 15, approval 20.
    """
    keyed = (
        persons.where(F.col("is_current"))
        .select("sk_deputado", "nk_deputado", "sigla_partido")
        .join(
            spending.select("sk_deputado", "valor_total_liquido", "percentual_uso_cota_mensal"),
            "sk_deputado", "left",
        )
        .join(
            productive.select(
                "sk_deputado", "total_proposicoes", "proposicoes_aprovadas",
                "taxa_aprovacao_percentual", "projetos_lei", "propostas_emenda_constitucional",
                "requerimentos",
            ),
            "sk_deputado", "left",
        )
        .join(
            present.select(
                "sk_deputado", "taxa_presenca_percentual", "taxa_fidelidade_partidaria",
                "taxa_rebeldia_partidaria",
            ),
            "sk_deputado", "left",
        )
    )

    def total(c: str) -> Column:
        return F.coalesce(F.sum(c), F.lit(0))

    def average(c: str) -> Column:
        return F.coalesce(mean_rounded(F.col(c).cast("decimal(24,6)")), F.lit(0.0))

    parties = keyed.groupBy("sigla_partido").agg(
        F.count_distinct("nk_deputado").alias("total_deputados"),
        total("valor_total_liquido").alias("gastos_totais_partido"),
        average("valor_total_liquido").alias("gastos_medio_por_deputado"),
        average("percentual_uso_cota_mensal").alias("uso_medio_cota_percentual"),
        total("total_proposicoes").alias("proposicoes_totais_partido"),
        total("proposicoes_aprovadas").alias("proposicoes_aprovadas_partido"),
        average("total_proposicoes").alias("proposicoes_media_por_deputado"),
        average("taxa_aprovacao_percentual").alias("taxa_aprovacao_media_partido"),
        average("taxa_presenca_percentual").alias("taxa_presenca_media_partido"),
        average("taxa_fidelidade_partidaria").alias("taxa_fidelidade_media_partido"),
        average("taxa_rebeldia_partidaria").alias("taxa_rebeldia_media_partido"),
        total("projetos_lei").alias("total_projetos_lei_partido"),
        total("propostas_emenda_constitucional").alias("total_pec_partido"),
        total("requerimentos").alias("total_requerimentos_partido"),
    )
    line = disciplined.select(
        "sigla_partido",
        F.col("taxa_fidelidade_partidaria").alias("fidelidade_partidaria_consolidada"),
        F.col("coesao_media_partido").alias("coesao_interna_partido"),
        F.col("classificacao_disciplina").alias("classificacao_disciplina_partido"),
        F.col("classificacao_coesao").alias("classificacao_coesao_partido"),
    )
    joined = (
        parties.where(F.col("total_deputados") >= smallest_party)
        .join(line, "sigla_partido", "left")
        .fillna(0.0, ["fidelidade_partidaria_consolidada", "coesao_interna_partido"])
        .fillna("Sem Dados", ["classificacao_disciplina_partido", "classificacao_coesao_partido"])
    )
    table = materialize(joined, "scorecard")
    tie = F.col("sigla_partido").asc()
    down = {
        "ranking_produtividade": "proposicoes_media_por_deputado",
        "ranking_efetividade": "taxa_aprovacao_media_partido",
        "ranking_presenca": "taxa_presenca_media_partido",
        "ranking_fidelidade": "fidelidade_partidaria_consolidada",
        "ranking_coesao": "coesao_interna_partido",
    }
    up = {
        "ranking_economia_gastos": "gastos_medio_por_deputado",
        "ranking_economia_cota": "uso_medio_cota_percentual",
    }
    orders = {n: [F.col(c).asc(), tie] for n, c in up.items()}
    orders |= {n: [F.col(c).desc(), tie] for n, c in down.items()}
    ranked = dimension_row_ranks(table, orders)  # one row per party
    ranked = dimension_percent_ranks(
        ranked,
        {
            "percentil_gastos": "gastos_medio_por_deputado",
            "percentil_produtividade": "proposicoes_media_por_deputado",
            "percentil_presenca": "taxa_presenca_media_partido",
            "percentil_fidelidade": "fidelidade_partidaria_consolidada",
        },
    )
    measures = {
        "benchmark_gastos_medio": "gastos_medio_por_deputado",
        "benchmark_produtividade": "proposicoes_media_por_deputado",
        "benchmark_presenca": "taxa_presenca_media_partido",
        "benchmark_efetividade": "taxa_aprovacao_media_partido",
        "benchmark_fidelidade": "fidelidade_partidaria_consolidada",
        "benchmark_coesao": "coesao_interna_partido",
    }
    both = with_benchmark(
        ranked, {n: mean_rounded(_exact(c)) for n, c in measures.items()}, table
    )

    def against(value: str, bench: str, below_first: bool = False) -> Column:
        v, b = F.col(value), F.col(bench)
        if below_first:
            return classify([(v < b, "Abaixo da Média")], "Acima da Média")
        return classify([(v > b, "Acima da Média")], "Abaixo da Média")

    bills = F.col("proposicoes_totais_partido").cast("double")
    score = (
        (1 - F.col("percentil_gastos")) * 20
        + F.col("percentil_produtividade") * 25
        + F.col("percentil_presenca") * 20
        + F.col("percentil_fidelidade") * 15
        + F.col("taxa_aprovacao_media_partido") / 100 * 20
    )
    spent = F.col("gastos_totais_partido").cast("double")
    cuts = rules.QUINTILE_CUTS
    tops = {
        "economia": "ranking_economia_gastos", "produtividade": "ranking_produtividade",
        "presenca": "ranking_presenca", "efetividade": "ranking_efetividade",
        "fidelidade": "ranking_fidelidade", "coesao": "ranking_coesao",
    }
    return both.withColumns(
        {
            "sk_eficiencia_partido": surrogate_key("sigla_partido"),
            "proposicoes_aprovadas_por_milhao_gasto": F.when(
                spent > 0, round_to(ratio("proposicoes_aprovadas_partido", spent / 1000000), 4)
            ).otherwise(F.lit(0.0)),
            "score_eficiencia_geral": round_to(score),
            "comparacao_gastos": against("gastos_medio_por_deputado", "benchmark_gastos_medio", True),
            "comparacao_produtividade": against(
                "proposicoes_media_por_deputado", "benchmark_produtividade"
            ),
            "comparacao_presenca": against("taxa_presenca_media_partido", "benchmark_presenca"),
            "comparacao_fidelidade": against(
                "fidelidade_partidaria_consolidada", "benchmark_fidelidade"
            ),
            "classificacao_gastos": band("percentil_gastos", cuts, rules.SPEND_QUINTILES),
            "classificacao_produtividade": band(
                "percentil_produtividade", cuts, rules.PRODUCTIVITY_QUINTILES, False
            ),
            "classificacao_presenca": band(
                "percentil_presenca", cuts, rules.PRESENCE_QUINTILES, False
            ),
            "classificacao_fidelidade_comparativa": band(
                "percentil_fidelidade", cuts, rules.LOYALTY_LABELS, False
            ),
            "perfil_atuacao": classify(
                [
                    (F.col("total_projetos_lei_partido") >= bills * 0.6, "Focado em Projetos de Lei"),
                    (F.col("total_pec_partido") >= bills * 0.3, "Focado em PECs"),
                    (F.col("total_requerimentos_partido") >= bills * 0.5, "Focado em Fiscalização"),
                ],
                "Atuação Diversificada",
            ),
            **{f"flag_top5_{n}": F.col(c) <= 5 for n, c in tops.items()},
        }
    )
