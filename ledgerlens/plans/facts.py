"""Fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates, rules
from ledgerlens.functions.columns import count_where, pick_where, truth
from ledgerlens.functions.keys import surrogate_key
from ledgerlens.functions.numeric import percent, percent_or_zero
from ledgerlens.functions.text import filled, truthy
from ledgerlens.operators.joins import version_join, version_join_by_key
from ledgerlens.operators.rows import value_if

IMPRESSIVE_VOTE_COUNT = 300


def expense_fact(staged: DataFrame) -> DataFrame:
    """Expense documents with key, disallowed share, bands, period labels and flags."""
    return staged.withColumnRenamed("deputado_id", "nk_deputado").withColumns(
        {
            "sk_despesa": surrogate_key("nk_deputado", "cod_documento", "ano", "mes"),
            "percentual_glosa": percent_or_zero("valor_glosa", "valor_documento"),
            "status_financeiro": rules.financial_status(
                "valor_documento", "valor_liquido", "valor_glosa"
            ),
            "faixa_valor": rules.value_band("valor_liquido"),
            "ano_mes": dates.year_month("ano", "mes"),
            "trimestre": dates.quarter_label("mes"),
            "tem_documento": filled("url_documento"),
            "tem_ressarcimento": F.col("num_ressarcimento").isNotNull(),
        }
    )


def with_versions(
    facts: DataFrame, versions: DataFrame, key: str, at: str, how: str = "left", by_key: bool = False
) -> DataFrame:
    """Facts enriched by the person version valid at their time.

    ``by_key`` joins where the rows lie, for tables stored in buckets by person.
    """
    attributes = [c for c in versions.columns if c not in ("nk_deputado", "is_current")]
    renamed = versions.select(F.col("nk_deputado").alias(key), *attributes)
    join = version_join_by_key if by_key else version_join
    return join(facts, renamed, [key], at, how=how).drop("valid_from", "valid_to")


def vote_tallies(votes: DataFrame, versions: DataFrame) -> DataFrame:
    """Votes per roll call by kind, and the parties that voted yes or no.

    Votes are first counted per (roll call, party); that small table gives both the sums and the
    two party lists.
    """
    vote = F.col("tipo_voto")
    known = ("SIM", *rules.NO_VOTES, "ABSTENÇÃO", "OBSTRUÇÃO", "ARTIGO 17")
    counts = {
        "total_votos_registrados": F.lit(True),
        "votos_sim_detalhados": vote == "SIM",
        "votos_nao_detalhados": vote.isin(*rules.NO_VOTES),
        "votos_abstencao": vote == "ABSTENÇÃO",
        "votos_obstrucao": vote == "OBSTRUÇÃO",
        "votos_artigo17": vote == "ARTIGO 17",
        "votos_outros_detalhados": ~vote.isin(*known),
    }
    parties = versions.select("nk_deputado", "sigla_partido", "valid_from", "valid_to")
    by_party = (
        with_versions(votes, parties, "deputado_id", "data_registro_voto")
        .groupBy("id_votacao", "sigla_partido")
        .agg(*[count_where(p).alias(n) for n, p in counts.items()])
    )

    def parties_with(column: str):
        names = F.collect_list(F.when(F.col(column) > 0, F.col("sigla_partido")))
        text = F.array_join(F.array_sort(names), ", ")
        return F.when(F.size(names) > 0, text)

    return by_party.groupBy("id_votacao").agg(
        *[F.sum(n).alias(n) for n in counts],
        parties_with("votos_sim_detalhados").alias("partidos_favoraveis"),
        parties_with("votos_nao_detalhados").alias("partidos_contrarios"),
    )


def roll_call_fact(
    roll_calls: DataFrame, votes: DataFrame, versions: DataFrame, bills: DataFrame
) -> DataFrame:
    """Roll calls with official and counted tallies, parties for and against, and the bill."""
    tallies = vote_tallies(votes, versions)
    counted = [c for c in tallies.columns if c.startswith(("votos_", "total_votos"))]
    bill = bills.select(
        "proposicao_id",
        F.col("sigla_tipo").alias("proposicao_sigla_tipo"),
        F.col("numero").alias("proposicao_numero"),
        F.col("ano").alias("ano_proposicao"),
        F.col("descricao_tipo").alias("proposicao_descricao_tipo"),
        "ementa",
        F.col("ementa_detalhada").alias("proposicao_ementa_detalhada"),
        F.col("data_apresentacao").alias("proposicao_data_apresentacao"),
        F.col("ultimo_status_descricao_situacao").alias("proposicao_situacao_atual"),
        F.col("ultimo_status_apreciacao").alias("proposicao_apreciacao"),
        F.lit(True).alias("_bill"),
    )
    total = F.col("votos_sim") + F.col("votos_nao") + F.col("votos_outros")
    approved = truthy("aprovada")
    return (
        roll_calls.join(tallies, "id_votacao", "left")
        .join(bill, "proposicao_id", "left")
        .select(
            surrogate_key("id_votacao").alias("sk_votacao"),
            F.col("id_votacao").alias("nk_votacao"),
            F.col("proposicao_id").alias("nk_proposicao"),
            "data_votacao",
            F.col("descricao").alias("descricao_votacao"),
            approved.alias("aprovada"),
            "id_evento",
            "id_orgao",
            "sigla_orgao",
            F.col("uri").alias("uri_votacao"),
            "uri_evento",
            "uri_orgao",
            "votos_sim",
            "votos_nao",
            "votos_outros",
            total.alias("total_votos_oficiais"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counted],
            *[c for c in bill.columns if c not in ("proposicao_id", "ementa", "_bill")],
            F.coalesce("ementa", "proposicao_descricao").alias("proposicao_ementa"),
            "partidos_favoraveis",
            "partidos_contrarios",
            F.when(total != 0, percent("votos_sim", total)).alias("percentual_aprovacao"),
            F.when(F.col("votos_nao") + F.col("votos_outros") > 0, percent("votos_nao", total))
            .otherwise(F.lit(0.0))
            .alias("percentual_rejeicao"),
            F.when(approved, F.lit("APROVADA")).otherwise(F.lit("REJEITADA")).alias(
                "resultado_votacao"
            ),
            rules.majority_kind("votos_sim", "votos_nao", "votos_outros").alias("tipo_maioria"),
            "ano",
            "mes",
            dates.quarter_label("mes").alias("trimestre"),
            F.col("_bill").isNotNull().alias("tem_proposicao_vinculada"),
            truth(F.col("total_votos_registrados") > 0).alias("tem_votos_detalhados"),
            truth(F.col("votos_obstrucao") > 0).alias("teve_obstrucao"),
            truth(F.col("total_votos_registrados") >= IMPRESSIVE_VOTE_COUNT).alias(
                "eh_votacao_expressiva"
            ),
        )
    )


def vote_fact(
    votes: DataFrame,
    roll_calls: DataFrame,
    guidances: DataFrame,
    bills: DataFrame,
    versions: DataFrame,
    by_key: bool = False,
) -> DataFrame:
    """Individual votes with voter version, roll call, own party's guidance and bill.

    The guidance is matched on (roll call, party of the voter at the time), so a vote stays one
    row however many parties gave guidance.
    """
    call = roll_calls.select(
        "id_votacao",
        "data_votacao",
        F.col("descricao").alias("descricao_votacao"),
        F.col("aprovada").alias("votacao_aprovada"),
        F.col("proposicao_id").alias("nk_proposicao"),
        "id_orgao",
        "sigla_orgao",
    )
    line = (
        guidances.where((F.col("tipo_bancada") == "PARTIDO") & F.col("tem_orientacao"))
        .groupBy("id_votacao", F.col("sigla_bancada").alias("sigla_partido"))
        .agg(F.min("orientacao_padronizada").alias("orientacao_partido"))
    )
    bill = bills.select(
        F.col("proposicao_id").alias("nk_proposicao"),
        F.col("sigla_tipo").alias("sigla_tipo_proposicao"),
        F.col("numero").alias("numero_proposicao"),
        F.col("ano").alias("ano_proposicao"),
        "ementa",
        F.lit(True).alias("_bill"),
    )
    voter = versions.select(
        "sk_deputado", "nk_deputado", "nome_deputado", "sigla_partido", "sigla_uf",
        "condicao_eleitoral", "valid_from", "valid_to",
    )
    joined = (
        with_versions(
            votes.select("id_votacao", "deputado_id", "tipo_voto", "data_registro_voto"),
            voter, "deputado_id", "data_registro_voto", by_key=by_key,
        )
        .join(call, "id_votacao", "left")
        .join(line, ["id_votacao", "sigla_partido"], "left")
        .join(bill, "nk_proposicao", "left")
    )
    return joined.select(
        surrogate_key("id_votacao", "deputado_id").alias("sk_voto_individual"),
        F.col("id_votacao").alias("nk_votacao"),
        F.col("deputado_id").alias("nk_deputado"),
        "nk_proposicao",
        "sk_deputado",
        "nome_deputado",
        "sigla_partido",
        "sigla_uf",
        "condicao_eleitoral",
        "tipo_voto",
        "data_registro_voto",
        "data_votacao",
        "descricao_votacao",
        "votacao_aprovada",
        "id_orgao",
        "sigla_orgao",
        "orientacao_partido",
        rules.adherence("tipo_voto", "orientacao_partido").alias("fidelidade_partidaria"),
        "sigla_tipo_proposicao",
        "numero_proposicao",
        "ano_proposicao",
        "ementa",
        rules.vote_weight("tipo_voto").alias("peso_voto_numerico"),
        rules.vote_category("tipo_voto").alias("categoria_voto"),
        F.year("data_votacao").alias("ano_votacao"),
        F.month("data_votacao").alias("mes_votacao"),
        dates.quarter_label(F.month("data_votacao")).alias("trimestre_votacao"),
        truthy("votacao_aprovada").alias("flag_votacao_aprovada"),
        F.col("orientacao_partido").isNotNull().alias("flag_tem_orientacao_partido"),
        F.col("_bill").isNotNull().alias("flag_tem_proposicao_vinculada"),
    )


def bill_fact(
    bills: DataFrame,
    authors: DataFrame,
    topics: DataFrame,
    roll_calls: DataFrame,
    per_author: bool = False,
) -> DataFrame:
    """Bills with their authors, topics and votes, each side aggregated before it is joined.

    One row per bill; ``per_author`` gives one row per bill and author instead. Of several
    proponents the first signatory is shown, with all attributes from that one signature.
    """
    proponent = F.col("eh_proponente")
    grain = ["proposicao_id", "deputado_autor_id"] if per_author else ["proposicao_id"]
    signed = authors.groupBy(*grain).agg(
        F.count(F.lit(1)).alias("total_autores"),
        count_where(proponent).alias("total_proponentes"),
        pick_where(
            proponent,
            ["deputado_autor_id", "nome_autor", "sigla_partido_autor", "sigla_uf_autor"],
            ["ordem_assinatura"],
        ).alias("_first"),
    ).select(
        *grain,
        "total_autores",
        "total_proponentes",
        F.col("_first.deputado_autor_id").alias("deputado_proponente_id"),
        F.col("_first.nome_autor").alias("nome_proponente"),
        F.col("_first.sigla_partido_autor").alias("partido_proponente"),
        F.col("_first.sigla_uf_autor").alias("uf_proponente"),
    )
    author = F.col("deputado_autor_id") if per_author else F.col("deputado_proponente_id")
    labels = topics.groupBy("proposicao_id", "tema").agg(F.count(F.lit(1)).alias("_times"))
    themed = labels.groupBy("proposicao_id").agg(
        F.sum("_times").alias("total_temas"),
        F.array_join(F.array_sort(F.collect_list("tema")), ", ").alias("temas_proposicao"),
    )
    approved = truthy("aprovada")
    voted = (
        roll_calls.dropna(subset=["proposicao_id"])
        .groupBy("proposicao_id")
        .agg(
            F.count(F.lit(1)).alias("total_votacoes"),
            count_where(approved).alias("votacoes_aprovadas"),
            count_where(F.col("aprovada").isNotNull() & ~approved).alias("votacoes_rejeitadas"),
            F.max("data_votacao").alias("data_ultima_votacao"),
            F.sum("votos_sim").alias("total_votos_sim_historico"),
            F.sum("votos_nao").alias("total_votos_nao_historico"),
            F.sum("votos_outros").alias("total_votos_outros_historico"),
        )
    )
    joined = (
        bills.join(signed, "proposicao_id", "left")
        .join(themed, "proposicao_id", "left")
        .join(voted, "proposicao_id", "left")
    )
    zero = F.lit(0)
    has_votes = truth(F.col("total_votacoes") > 0)
    key = ["proposicao_id", "deputado_autor_id"] if per_author else ["proposicao_id"]
    return joined.select(
        surrogate_key(*key).alias("sk_proposicao"),
        F.col("proposicao_id").alias("nk_proposicao"),
        "sigla_tipo",
        "numero",
        value_if("ano", 0, F.year("data_apresentacao")).alias("ano"),
        "descricao_tipo",
        "ementa",
        "data_apresentacao",
        "ultimo_status_data_hora",
        "ultimo_status_descricao_situacao",
        author.alias("nk_deputado"),
        F.coalesce("total_autores", zero).alias("total_autores"),
        F.coalesce("total_proponentes", zero).alias("total_proponentes"),
        "deputado_proponente_id",
        "nome_proponente",
        "partido_proponente",
        "uf_proponente",
        F.coalesce("total_temas", zero).alias("total_temas"),
        "temas_proposicao",
        F.coalesce("total_votacoes", zero).alias("total_votacoes"),
        F.coalesce("votacoes_aprovadas", zero).alias("votacoes_aprovadas"),
        F.coalesce("votacoes_rejeitadas", zero).alias("votacoes_rejeitadas"),
        "data_ultima_votacao",
        "total_votos_sim_historico",
        "total_votos_nao_historico",
        "total_votos_outros_historico",
        rules.bill_status("ultimo_status_descricao_situacao").alias("situacao_proposicao"),
        F.when(has_votes, F.lit("COM_VOTACAO")).otherwise(F.lit("SEM_VOTACAO")).alias(
            "status_votacao"
        ),
        dates.days_between("data_apresentacao", "ultimo_status_data_hora").alias("dias_tramitacao"),
        F.year("data_apresentacao").alias("ano_apresentacao"),
        F.month("data_apresentacao").alias("mes_apresentacao"),
        F.col("deputado_proponente_id").isNotNull().alias("tem_deputado_proponente"),
        truth(F.col("total_temas") > 0).alias("tem_temas_classificados"),
        has_votes.alias("foi_votada"),
    )
