"""Exploration views and the list of headline metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.columns import count_where, truth
from ledgerlens.functions.numeric import percent, percent_or_zero, ratio, round_to
from ledgerlens.functions.rules import NO_VOTES, band, classify, growth_class
from ledgerlens.functions.text import filled
from ledgerlens.operators.aggregates import metric_list
from ledgerlens.operators.joins import full_outer
from ledgerlens.operators.lineage import materialize
from ledgerlens.operators.ordered import row_ranks
from ledgerlens.operators.windows import period_growth


def _like(c: str, *patterns: str):
    text = F.col(c)
    hit = F.lit(False)
    for p in patterns:
        hit = hit | text.ilike(p)
    return truth(hit)


def activity(votes: DataFrame, authors: DataFrame, bills: DataFrame) -> DataFrame:
    """Votes and bills per person side by side: score 0.3 per vote and 0.7 per bill.

    ``votes`` has ``deputado_id, tipo_voto, data_votacao``; ``authors`` and ``bills`` are staged.
    """
    vote = F.col("tipo_voto")
    voted = votes.groupBy("deputado_id").agg(
        F.count(F.lit(1)).alias("total_votacoes"),
        count_where(vote == "SIM").alias("votos_sim"),
        count_where(vote.isin(*NO_VOTES)).alias("votos_nao"),
        count_where(vote == "ABSTENÇÃO").alias("abstencoes"),
        count_where(~filled("tipo_voto")).alias("ausencias"),
        F.count_distinct("data_votacao").alias("dias_votacao_distintos"),
    )
    # a proposal passes with an approving text or by becoming law
    passed = _like("ultimo_status_descricao_situacao", "%aprovad%", "%transformado em norma%")
    written = (
        authors.select("proposicao_id", F.col("deputado_autor_id").alias("deputado_id"))
        .join(bills.select("proposicao_id", "sigla_tipo", passed.alias("_passed")), "proposicao_id")
        .groupBy("deputado_id")
        .agg(
            F.count(F.lit(1)).alias("proposicoes_criadas"),
            count_where(F.col("_passed")).alias("proposicoes_aprovadas"),
            F.count_distinct("sigla_tipo").alias("tipos_proposicao_criados"),
        )
    )
    counts = [c for c in (*voted.columns, *written.columns) if c != "deputado_id"]
    both = full_outer(voted, written, ["deputado_id"]).fillna(0, counts)
    n, bills_made = F.col("total_votacoes"), F.col("proposicoes_criadas")
    return both.where((n > 0) | (bills_made > 0)).withColumns(
        {
            "taxa_ausencia_percent": percent_or_zero("ausencias", n),
            "taxa_aprovacao_proposicoes": percent_or_zero("proposicoes_aprovadas", bills_made),
            "score_atividade": (
                (n * F.lit(0.3).cast("decimal(2,1)") + bills_made * F.lit(0.7).cast("decimal(2,1)"))
            ).cast("double"),
            "categoria_atividade": classify(
                [
                    ((n > 1000) & (bills_made > 10), "MUITO_ATIVO"),
                    ((n > 500) & (bills_made > 5), "ATIVO"),
                    ((n > 100) | (bills_made > 1), "MODERADO"),
                ],
                "BAIXA_ATIVIDADE",
            ),
        }
    )


def spend_ranking(expenses: DataFrame, at_least_years: int = 2) -> DataFrame:
    """Persons ranked by total spending, through one row per person and year."""
    yearly = (
        expenses.where(F.col("valor_liquido") > 0)
        .groupBy("deputado_id", "ano")
        .agg(
            F.count(F.lit(1)).alias("total_despesas"),
            F.sum("valor_liquido").alias("valor_total_liquido"),
            ratio(F.sum("valor_liquido"), F.count("valor_liquido")).alias("valor_medio_despesa"),
        )
    )
    return ranked_spenders(yearly, at_least_years)


def ranked_spenders(yearly: DataFrame, at_least_years: int = 2) -> DataFrame:
    """The ranking out of one row per person and year: documents, amount and mean document."""
    total = F.sum("valor_total_liquido")
    people = yearly.groupBy("deputado_id").agg(
        total.alias("total_gasto_periodo"),
        ratio(total, F.count(F.lit(1))).alias("media_anual"),
        F.count(F.lit(1)).alias("anos_atividade"),
        F.sum("total_despesas").alias("total_transacoes"),
        round_to(ratio(F.sum(F.col("valor_medio_despesa").cast("decimal(24,8)")), F.count(F.lit(1))), 4).alias(
            "valor_medio_geral"
        ),
    )
    kept = materialize(people.where(F.col("anos_atividade") >= at_least_years), "spenders")
    ranked = row_ranks(
        kept, {"ranking_gasto": [F.col("total_gasto_periodo").desc(), F.col("deputado_id").asc()]}
    )
    return ranked.withColumns(
        {
            "gasto_medio_por_ano": round_to(ratio("total_gasto_periodo", "anos_atividade")),
            "categoria_gasto": band(
                "total_gasto_periodo", (500000, 1000000), ("BAIXO_GASTO", "MEDIO_GASTO", "ALTO_GASTO")
            ),
        }
    )


def bills_over_time(bills: DataFrame, year: str = "ano") -> DataFrame:
    """Bills per year with outcome counts, growth and trend class; one row per year."""
    status = "ultimo_status_descricao_situacao"
    yearly = (
        bills.where(F.col(year).isNotNull())
        .groupBy(F.col(year).alias("ano"))
        .agg(
            F.count(F.lit(1)).alias("total_proposicoes"),
            F.count_distinct("sigla_tipo").alias("tipos_distintos"),
            count_where(_like(status, "%aprovad%", "%transformado em norma%")).alias("aprovadas"),
            count_where(_like(status, "%arquivad%")).alias("arquivadas"),
            count_where(_like(status, "%tramitand%")).alias("em_tramitacao"),
        )
    )
    w = Window.orderBy("ano")  # one row per calendar year
    grown = yearly.withColumn("_before", F.lag("total_proposicoes").over(w))
    growth = percent(F.col("total_proposicoes") - F.col("_before"), F.col("_before"))
    return grown.withColumns(
        {
            "taxa_aprovacao": percent("aprovadas", "total_proposicoes"),
            "crescimento_percentual": growth,
            "categoria_tendencia": growth_class(growth),
        }
    ).drop("_before")


def bill_types(bills: DataFrame) -> DataFrame:
    """Bills per type: count, numbers, years and share approved."""
    status = "ultimo_status_descricao_situacao"
    passed = count_where(_like(status, "%aprovad%", "%transformado em norma%"))
    return (
        bills.where(F.col("sigla_tipo").isNotNull())
        .groupBy(F.col("sigla_tipo").alias("tipo_proposicao"), "descricao_tipo")
        .agg(
            F.count(F.lit(1)).alias("total_proposicoes"),
            F.count_distinct("numero").alias("numeros_distintos"),
            F.min("ano").alias("ano_mais_antigo"),
            F.max("ano").alias("ano_mais_recente"),
            passed.alias("proposicoes_aprovadas"),
            count_where(_like(status, "%arquivad%")).alias("proposicoes_arquivadas"),
            percent(passed, F.count(F.lit(1))).alias("taxa_aprovacao_percent"),
        )
    )


def headline_metrics(vote_facts: DataFrame) -> DataFrame:
    """Eight headline metrics as (metric, value, description).

    Votes are first merged per roll call, with map-side sums, and persons to distinct ones, so no
    vote is multiplied for a distinct count. Approval and bill are attributes of the roll call, and
    the share of approved roll calls counts roll calls, not votes.
    """
    line, vote = F.col("fidelidade_partidaria"), F.col("tipo_voto")
    per_call = vote_facts.groupBy("nk_votacao").agg(
        F.count(F.lit(1)).alias("_votes"),
        count_where(line == "SEGUIU_ORIENTACAO").alias("_followed"),
        count_where(line.isin("SEGUIU_ORIENTACAO", "CONTRARIOU_ORIENTACAO")).alias("_judged"),
        count_where(vote == "SIM").alias("_yes"),
        count_where(vote.isin("SIM", *NO_VOTES)).alias("_sided"),
        F.max("flag_votacao_aprovada").alias("_approved"),
        F.max(F.when(F.col("flag_tem_proposicao_vinculada"), F.col("nk_proposicao"))).alias("_bill"),
        F.min("ano_votacao").alias("_from"),
        F.max("ano_votacao").alias("_to"),
    )
    persons = vote_facts.select("nk_deputado").distinct().agg(F.count("nk_deputado").alias("_n"))
    per_call = per_call.withColumn("_persons", persons.scalar())
    calls = F.count("nk_votacao")
    approved = count_where(F.col("_approved") & F.col("nk_votacao").isNotNull())

    def share(num, den, suffix="%"):
        return F.concat(percent(num, den).cast("decimal(12,2)").cast("string"), F.lit(suffix))

    years = F.concat_ws(" - ", F.min("_from").cast("string"), F.max("_to").cast("string"))
    return metric_list(
        per_call,
        {
            "Período Analisado": (years, "Anos com dados de votação"),
            "Total de Votos Individuais": (
                F.coalesce(F.sum("_votes"), F.lit(0)), "Votos registrados no sistema"
            ),
            "Deputados Únicos": (
                F.coalesce(F.max("_persons"), F.lit(0)), "Deputados com pelo menos 1 voto registrado"
            ),
            "Votações Únicas": (calls, "Votações nominais realizadas"),
            "Proposições Votadas": (
                F.count_distinct("_bill"), "Proposições que passaram por votação"
            ),
            "Taxa de Fidelidade Partidária": (
                share(F.sum("_followed"), F.sum("_judged")), "Percentual de votos que seguiram orientação partidária"
            ),
            "Taxa de Aprovação Média": (
                share(approved, calls), "Percentual de votações que foram aprovadas"
            ),
            "Votos SIM vs NÃO": (
                share(F.sum("_yes"), F.sum("_sided"), "% SIM"), "Proporção de votos favoráveis vs contrários"
            ),
        },
    )


def yearly_growth(facts: DataFrame, entity: list[str], value: str) -> DataFrame:
    """Total per entity and year with growth against its previous year on record."""
    yearly = facts.groupBy(*entity, "ano").agg(F.sum(value).alias("total"))
    grown = period_growth(yearly, entity, "ano", "total")
    return grown.withColumn("crescimento_percentual", round_to("crescimento_percentual")).drop(
        "_previous_period", "_previous_value"
    )
