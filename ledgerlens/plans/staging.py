"""Cleaned views over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import dates, rules
from ledgerlens.functions.keys import id_from_uri
from ledgerlens.functions.numeric import money
from ledgerlens.functions.text import filled, standard
from ledgerlens.operators.joins import not_in
from ledgerlens.operators.windows import latest

EARLIEST_HISTORY = "1980-01-01 00:00:00"
EARLIEST_DATE = "2000-01-01"

# Lineage labels carried in the results.
FROM_PROFILES = "camara_deputados_detalhes"
FROM_STATUS_LOG = "camara_deputado_historico"
FROM_MEETINGS = "camara_eventos"


def expenses(raw: DataFrame) -> DataFrame:
    """Distinct documents with key, date and non-negative exact amounts; texts trimmed."""
    changes = {"cnpj_cpf_fornecedor": F.trim("cnpj_cpf_fornecedor"), "num_documento": F.trim("num_documento")}
    for name in ("nome_fornecedor", "tipo_despesa", "tipo_documento"):
        if name in raw.columns:
            changes[name] = standard(name)
    for field in raw.schema.fields:
        if field.name.startswith("valor_") and isinstance(field.dataType, T.DoubleType):
            changes[field.name] = money(field.name)
    return (
        raw.dropna(subset=["deputado_id", "cod_documento", "data_documento"])
        .where((F.col("valor_documento") >= 0) & (F.col("valor_liquido") >= 0))
        .withColumns(changes)
        .distinct()
    )


def status_history(raw: DataFrame) -> DataFrame:
    """Status log, one row per person and instant."""
    texts = (
        "condicao_eleitoral", "descricao_status", "nome_eleitoral", "sigla_partido", "sigla_uf",
        "situacao",
    )
    rows = (
        raw.withColumn("deputado_id", F.col("deputado_id").try_cast("bigint"))
        .dropna(subset=["deputado_id", "data_hora"])
        .where(F.col("data_hora") > F.lit(EARLIEST_HISTORY).cast("timestamp_ntz"))
        .withColumns({n: standard(n) for n in texts})
        .withColumn("nome_deputado", standard("nome"))
        .withColumnRenamed("data_hora", "data_inicio_vigencia")
        .drop("nome")
    )
    order = [F.col("id").desc_nulls_last(), *[F.col(n).asc_nulls_last() for n in texts]]
    return latest(rows, ["deputado_id", "data_inicio_vigencia"], order)


def profiles(raw: DataFrame) -> DataFrame:
    """Current profiles of persons."""
    upper = (
        "cpf", "nome_civil", "municipio_nascimento", "uf_nascimento", "sexo", "ultimo_status_nome",
        "ultimo_status_nome_eleitoral", "ultimo_status_sigla_partido", "ultimo_status_sigla_uf",
        "ultimo_status_condicao_eleitoral", "ultimo_status_situacao",
        "ultimo_status_nome_gabinete",
    )
    return (
        raw.dropna(subset=["id"])
        .withColumns({n: standard(n) for n in upper})
        .withColumnRenamed("id", "deputado_id")
    )


def persons(profile: DataFrame, history: DataFrame) -> DataFrame:
    """Profiles plus status rows of persons without a profile; missing attributes are NULL."""
    first = profile.dropna(subset=["cpf"]).withColumn("fonte_dado", F.lit(FROM_PROFILES))
    log = history.where(
        F.col("data_inicio_vigencia") >= F.lit(EARLIEST_DATE).cast("timestamp_ntz")
    ).select(
        "deputado_id",
        F.col("nome_deputado").alias("nome_civil"),
        F.col("data_inicio_vigencia").cast("date").alias("ultimo_status_data"),
        F.col("nome_deputado").alias("ultimo_status_nome"),
        F.col("nome_eleitoral").alias("ultimo_status_nome_eleitoral"),
        F.col("sigla_partido").alias("ultimo_status_sigla_partido"),
        F.col("sigla_uf").alias("ultimo_status_sigla_uf"),
        F.col("id_legislatura").alias("ultimo_status_id_legislatura"),
        F.col("condicao_eleitoral").alias("ultimo_status_condicao_eleitoral"),
        F.col("situacao").alias("ultimo_status_situacao"),
        F.col("url_foto").alias("ultimo_status_url_foto"),
        "uri",
        F.lit(FROM_STATUS_LOG).alias("fonte_dado"),
    ).distinct()
    return first.unionByName(not_in(log, first, ["deputado_id"]), allowMissingColumns=True)


def meetings(raw: DataFrame, as_of: str) -> DataFrame:
    """Scheduled meetings from 2000 up to one year after ``as_of``."""
    start, end = F.col("data_hora_inicio"), F.col("data_hora_fim")
    limit = F.add_months(F.lit(as_of).cast("date"), 12).cast("timestamp_ntz")
    kept = raw.dropna(subset=["id", "data_hora_inicio"]).where(
        (start >= F.lit(EARLIEST_DATE).cast("timestamp_ntz")) & (start <= limit)
    )
    return kept.select(
        F.col("id").alias("id_evento"),
        standard("descricao").alias("descricao"),
        standard("descricao_tipo").alias("descricao_tipo"),
        start,
        end,
        start.cast("date").alias("data_inicio"),
        end.cast("date").alias("data_fim"),
        F.year(start).alias("ano_inicio"),
        F.month(start).alias("mes_inicio"),
        F.day(start).alias("dia_inicio"),
        F.hour(start).alias("hora_inicio"),
        dates.hours_between(start, end).alias("duracao_horas"),
        rules.day_period(F.hour(start)).alias("periodo_dia"),
        standard("local_camara_nome").alias("local_camara_nome"),
        standard("local_externo").alias("local_externo"),
        rules.place_kind("local_camara_nome", "local_externo").alias("tipo_local"),
        standard("situacao").alias("situacao"),
        F.trim("uri").alias("uri"),
        F.trim("url_documento_pauta").alias("url_documento_pauta"),
        F.col("url_documento_pauta").isNotNull().alias("tem_documento_pauta"),
        F.lit(FROM_MEETINGS).alias("fonte_dado"),
    ).distinct()


def guidances(raw: DataFrame) -> DataFrame:
    """Party guidance with standard wording, kind of bench and fill flags."""
    return raw.dropna(subset=["id_votacao"]).withColumns(
        {
            "orientacao_padronizada": rules.guidance("orientacao"),
            "tipo_bancada": rules.bench_kind("sigla_bancada"),
            "tem_orientacao": filled("orientacao"),
            "tem_uri_votacao": filled("uri_votacao"),
            "tem_uri_bancada": filled("uri_bancada"),
        }
    )


def bills(raw: DataFrame) -> DataFrame:
    """Bills with typed numbers and times; status columns keep their names."""
    types = {"id": "bigint", "numero": "bigint", "ano": "int", "data_apresentacao": "timestamp_ntz",
             "status_data_hora": "timestamp_ntz"}
    typed = raw.dropna(subset=["id"]).withColumns({n: F.col(n).try_cast(t) for n, t in types.items()})
    return typed.withColumnsRenamed(
        {
            "id": "proposicao_id",
            "status_data_hora": "ultimo_status_data_hora",
            "status_descricao_situacao": "ultimo_status_descricao_situacao",
            "status_apreciacao": "ultimo_status_apreciacao",
            "status_sigla_orgao": "ultimo_status_sigla_orgao",
        }
    )


def authors(raw: DataFrame) -> DataFrame:
    return raw.dropna(subset=["id_proposicao", "id_deputado_autor"]).withColumnsRenamed(
        {
            "id_proposicao": "proposicao_id",
            "id_deputado_autor": "deputado_autor_id",
            "proponente": "eh_proponente",
        }
    )


def topics(raw: DataFrame) -> DataFrame:
    """Topics with the bill id taken from the end of the URI."""
    return raw.dropna(subset=["uri_proposicao", "cod_tema"]).withColumn(
        "proposicao_id", id_from_uri("uri_proposicao")
    )


def roll_calls(raw: DataFrame) -> DataFrame:
    return (
        raw.dropna(subset=["id", "data"])
        .where(F.col("data") >= F.lit(EARLIEST_DATE).cast("date"))
        .select(
            F.trim("id").alias("id_votacao"),
            F.col("data").alias("data_votacao"),
            standard("descricao").alias("descricao"),
            F.col("aprovacao").alias("aprovada"),
            "id_evento",
            "id_orgao",
            standard("sigla_orgao").alias("sigla_orgao"),
            F.trim("ultima_apresentacao_proposicao_descricao").alias("proposicao_descricao"),
            F.col("ultima_apresentacao_proposicao_id").alias("proposicao_id"),
            F.trim("uri").alias("uri"),
            F.trim("uri_evento").alias("uri_evento"),
            F.trim("uri_orgao").alias("uri_orgao"),
            "votos_sim",
            "votos_nao",
            "votos_outros",
            F.year("data").alias("ano"),
            F.month("data").alias("mes"),
        )
    )


def votes(raw: DataFrame) -> DataFrame:
    return (
        raw.dropna(subset=["id_votacao", "deputado_id", "tipo_voto", "data_registro_voto"])
        .withColumns(
            {
                "id_votacao": F.trim("id_votacao"),
                "tipo_voto": standard("tipo_voto"),
                "ano": F.year("data_registro_voto"),
                "mes": F.month("data_registro_voto"),
            }
        )
        .where(F.col("ano") >= 2000)
    )
