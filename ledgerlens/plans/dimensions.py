"""Dimensions and ranking views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions import dates
from ledgerlens.functions.keys import surrogate_key
from ledgerlens.functions.rules import classify
from ledgerlens.operators.history import prefer_first, scd2_build, version_flags
from ledgerlens.operators.intervals import range_join
from ledgerlens.operators.lineage import materialize
from ledgerlens.operators.ordered import ordered_prefix
from ledgerlens.operators.windows import mode_of


def calendar(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per day from first to last, both included."""
    span = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"))
    day = spark.range(1).select(F.explode(span).alias("data"))
    return day.withColumns(
        {
            "ano": F.year("data"),
            "mes": F.month("data"),
            "dia": F.day("data"),
            "trimestre": F.quarter("data"),
            "dia_semana": dates.weekday_sunday_zero("data"),
            "nome_mes": dates.month_name(F.month("data")),
            "sk_tempo": F.date_format("data", "yyyyMMdd").cast("int"),
        }
    )


def calendar_with_terms(days: DataFrame, terms: DataFrame) -> DataFrame:
    """Days with the legislative term that covers them, if any."""
    picked = terms.select("idLegislatura", "dataInicio", "dataFim", "anoEleicao")
    return range_join(days, picked, "data", "dataInicio", "dataFim").drop("dataInicio", "dataFim")


def topic_dimension(raw_topics: DataFrame) -> DataFrame:
    """One row per topic code: commonest label, highest relevance, rows behind it."""
    rows = raw_topics.dropna(subset=["cod_tema", "tema", "relevancia"])
    numbers = rows.groupBy("cod_tema").agg(
        F.max("relevancia").alias("relevancia"),
        F.count(F.lit(1)).alias("total_registros_origem"),
    )
    return mode_of(rows, ["cod_tema"], "tema").join(numbers, "cod_tema")


def supplier_dimension(expenses: DataFrame) -> DataFrame:
    """One row per supplier; the name on its newest document, first in the alphabet among equals."""
    by_name = expenses.dropna(subset=["cnpj_cpf_fornecedor"]).groupBy(
        F.col("cnpj_cpf_fornecedor").alias("nk_fornecedor"), "nome_fornecedor"
    ).agg(F.max("data_documento").alias("_seen"), F.min("data_documento").alias("_first"))
    newest = F.max("_seen")
    out = by_name.groupBy("nk_fornecedor").agg(
        F.min_by("nome_fornecedor", F.struct((-F.unix_micros(F.col("_seen").cast("timestamp"))), "nome_fornecedor")).alias(
            "nome_fornecedor"
        ),
        F.min("_first").alias("primeiro_documento"),
        newest.alias("ultimo_documento"),
    )
    return out.withColumn("sk_fornecedor", surrogate_key("nk_fornecedor"))


def expense_type_dimension(expenses: DataFrame) -> DataFrame:
    kinds = expenses.select("tipo_despesa").dropna().distinct()
    return kinds.withColumn("sk_tipo_despesa", surrogate_key("tipo_despesa"))


def person_log(profiles: DataFrame, history: DataFrame) -> DataFrame:
    """Status rows of all persons on one time line: the log, and the profile at its status date."""
    log = history.select(
        "deputado_id", "nome_deputado", "nome_eleitoral", "sigla_partido", "sigla_uf",
        "id_legislatura", "condicao_eleitoral", "situacao", "url_foto", "uri",
        F.lit("historico").alias("fonte_origem"),
        F.col("data_inicio_vigencia").alias("data_atualizacao"),
    )
    current = profiles.select(
        "deputado_id",
        F.col("ultimo_status_nome").alias("nome_deputado"),
        F.col("ultimo_status_nome_eleitoral").alias("nome_eleitoral"),
        F.coalesce("ultimo_status_sigla_partido", F.lit("SEM PARTIDO")).alias("sigla_partido"),
        F.coalesce("ultimo_status_sigla_uf", "uf_nascimento", F.lit("N/A")).alias("sigla_uf"),
        F.coalesce("ultimo_status_id_legislatura", F.lit(0)).alias("id_legislatura"),
        F.coalesce("ultimo_status_condicao_eleitoral", F.lit("N/A")).alias("condicao_eleitoral"),
        F.coalesce("ultimo_status_situacao", F.lit("N/A")).alias("situacao"),
        F.col("ultimo_status_url_foto").alias("url_foto"),
        "uri",
        F.lit("detalhes").alias("fonte_origem"),
        F.col("ultimo_status_data").cast("timestamp_ntz").alias("data_atualizacao"),
    )
    return current.unionByName(log)


def person_history(profiles: DataFrame, history: DataFrame) -> DataFrame:
    """Versions of all persons over their whole status log."""
    tracked = [
        "nome_deputado", "nome_eleitoral", "sigla_partido", "sigla_uf", "id_legislatura",
        "condicao_eleitoral", "situacao",
    ]
    log = materialize(person_log(profiles, history), "log")  # counted by person, then read
    order = [F.col("fonte_origem").asc(), F.col("sigla_partido").asc()]
    return scd2_build(log, ["deputado_id"], "data_atualizacao", tracked, order)


def person_dimension(profiles: DataFrame, history: DataFrame, as_of: str) -> DataFrame:
    """Version history with personal data, age at ``as_of`` and flags."""
    personal = profiles.select(
        "deputado_id", "cpf", "nome_civil", "data_nascimento", "municipio_nascimento",
        "uf_nascimento", "sexo", "redes_sociais",
        F.col("ultimo_status_email_gabinete").alias("email_gabinete"),
        F.col("ultimo_status_telefone_gabinete").alias("telefone_gabinete"),
        F.col("ultimo_status_nome_gabinete").alias("nome_gabinete"),
    )
    versions = person_history(profiles, history).join(personal, "deputado_id", "left")
    described = versions.withColumns(
        {
            "nome_civil": F.coalesce("nome_civil", "nome_deputado"),
            "idade_atual": age("data_nascimento", as_of),
            "sexo_descricao": sex_text("sexo"),
            "sk_deputado": surrogate_key("scd_id"),
        }
    )
    return version_flags(described).withColumnRenamed("deputado_id", "nk_deputado")


def current_persons(profiles: DataFrame, history: DataFrame) -> DataFrame:
    """One row per person: the profile, or the newest status row where no profile exists."""
    from ledgerlens.operators.windows import latest

    newest = latest(history, ["deputado_id"], [F.col("data_inicio_vigencia").desc()])
    return prefer_first(
        person_log(profiles, history.limit(0)),
        person_log(profiles.limit(0), newest),
        ["deputado_id"],
    )


def age(birth: str | Column, as_of: str) -> Column:
    return dates.years_between(birth, F.lit(as_of).cast("date"))


def sex_text(c: str) -> Column:
    return classify([(F.col(c) == "M", "MASCULINO"), (F.col(c) == "F", "FEMININO")], "NÃO INFORMADO")


def person_ranking(expenses: DataFrame) -> DataFrame:
    """Yearly totals per person with ranks in the year and within (year, state)."""
    totals = expenses.groupBy("ano", "deputado_id", "nome_deputado", "sigla_partido", "sigla_uf").agg(
        F.sum("valor_liquido").alias("total_gasto"), F.count(F.lit(1)).alias("qtd_despesas")
    )
    order = [F.col("total_gasto").desc(), F.col("deputado_id").asc()]
    in_year = ordered_prefix(totals, order, ["ano"], rank="ranking_gasto_ano")
    return ordered_prefix(in_year, order, ["ano", "sigla_uf"], rank="ranking_gasto_uf")


def party_ranking(expenses: DataFrame) -> DataFrame:
    """Yearly totals per party with the rank in the year; a handful of rows per year."""
    totals = expenses.groupBy("ano", "sigla_partido").agg(
        F.sum("valor_liquido").alias("total_gasto_partido"),
        F.count_distinct("deputado_id").alias("qtd_deputados"),
    )
    w = Window.partitionBy("ano").orderBy(F.col("total_gasto_partido").desc(), "sigla_partido")
    return totals.withColumn("ranking_partido_ano", F.row_number().over(w))
