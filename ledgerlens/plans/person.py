"""Reports about one person (or all of them): totals, evolution, suppliers, details."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import dates
from ledgerlens.functions.numeric import mean, ratio
from ledgerlens.operators.rows import only
from ledgerlens.operators.windows import largest, latest, top_n


def selector(facts: DataFrame, versions: DataFrame) -> DataFrame:
    """Persons with documents: newest attributes, totals, years and number of terms.

    ``facts`` carry ``nk_deputado``; totals and attributes are two aggregations joined on the
    person, never a window over the documents.
    """
    totals = facts.groupBy("nk_deputado").agg(
        F.count("cod_documento").alias("total_despesas"),
        F.sum("valor_liquido").alias("total_valor"),
        F.min("ano").alias("primeiro_ano_despesa"),
        F.max("ano").alias("ultimo_ano_despesa"),
    )
    newest = latest(versions, ["nk_deputado"], [F.col("valid_from").desc()])
    terms = versions.groupBy("nk_deputado").agg(
        F.count_distinct("id_legislatura").alias("qtd_legislaturas")
    )
    return (
        totals.join(
            newest.select("nk_deputado", "nome_deputado", "sigla_partido", "sigla_uf", "is_current"),
            "nk_deputado",
        )
        .join(terms, "nk_deputado")
        .withColumn(
            "status_mandato",
            F.when(F.col("is_current"), F.lit("🟢 Ativo")).otherwise(F.lit("⚪ Ex-Deputado")),
        )
    )


def indicators(facts: DataFrame, person: int | Sequence[int] | None = None) -> DataFrame:
    """Headline numbers per person over documents that carry the person version."""
    keys = ["nk_deputado", "ano", "mes", "sigla_partido", "sigla_uf", "id_legislatura"]
    rows = only(facts, nk_deputado=person).groupBy(*keys).agg(
        F.sum("valor_liquido").alias("_sum"),
        F.count("valor_liquido").alias("_n"),
        F.count("cod_documento").alias("_docs"),
    )
    totals = rows.groupBy("nk_deputado").agg(
        F.sum("_sum").alias("total_gasto"),
        F.sum("_docs").alias("total_despesas"),
        F.count_distinct(dates.month_index("ano", "mes")).alias("meses_atividade"),
        ratio(F.sum("_sum"), F.sum("_n")).alias("media_por_despesa"),
        F.min("ano").alias("primeiro_ano"),
        F.max("ano").alias("ultimo_ano"),
        F.count_distinct("sigla_partido").alias("qtd_partidos"),
        F.count_distinct("sigla_uf").alias("qtd_ufs"),
        F.count_distinct("id_legislatura").alias("qtd_legislaturas"),
    )
    return totals.withColumns(
        {
            "media_mensal": F.coalesce(ratio("total_gasto", "meses_atividade"), F.lit(0.0)),
            "anos_periodo": F.col("ultimo_ano") - F.col("primeiro_ano") + 1,
        }
    )


def monthly_evolution(facts: DataFrame, person: int | Sequence[int] | None = None) -> DataFrame:
    """Spending per month with the party, state and term of that time."""
    rows = only(facts, nk_deputado=person)
    keys = ["nk_deputado", "ano", "mes", "sigla_partido", "sigla_uf", "id_legislatura"]
    monthly = rows.groupBy(*keys).agg(
        F.sum("valor_liquido").alias("gasto_mensal"), F.count("cod_documento").alias("despesas_mes")
    )
    return monthly.withColumns(
        {
            "trimestre": F.ceil(F.col("mes") / 3),
            "nome_mes": dates.month_name("mes"),
            "mes_abrev": dates.month_short("mes"),
        }
    )


def by_type_and_year(facts: DataFrame, person: int | Sequence[int] | None = None) -> DataFrame:
    return (
        only(facts, nk_deputado=person)
        .groupBy("tipo_despesa", "ano")
        .agg(
            F.sum("valor_liquido").alias("total_gasto"),
            F.count("cod_documento").alias("qtd_despesas"),
            mean("valor_liquido").alias("valor_medio"),
        )
    )


def by_type(facts: DataFrame, person: int | Sequence[int] | None = None, year: int | None = None) -> DataFrame:
    return (
        only(facts, nk_deputado=person, ano=year)
        .groupBy("tipo_despesa")
        .agg(
            F.sum("valor_liquido").alias("total_gasto"),
            F.count("cod_documento").alias("qtd_transacoes"),
        )
    )


def _supplier_totals(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return facts.groupBy(*keys, "nome_fornecedor").agg(
        F.sum("valor_liquido").alias("total_gasto"),
        F.count("cod_documento").alias("qtd_transacoes"),
        mean("valor_liquido").alias("ticket_medio"),
    )


def top_suppliers(
    facts: DataFrame,
    person: int | Sequence[int] | None = None,
    year: int | None = None,
    n: int = 15,
) -> DataFrame:
    """Largest suppliers by spending, for all persons or the given ones."""
    totals = _supplier_totals(only(facts, nk_deputado=person, ano=year), [])
    return largest(totals, [F.col("total_gasto").desc(), F.col("nome_fornecedor").asc()], n)


def top_suppliers_each(facts: DataFrame, n: int = 15, year: int | None = None) -> DataFrame:
    """Largest suppliers of every person."""
    totals = _supplier_totals(only(facts, ano=year), ["nk_deputado"])
    order = [F.col("total_gasto").desc(), F.col("nome_fornecedor").asc()]
    return top_n(totals, ["nk_deputado"], order, n, "posicao")


def details(
    facts: DataFrame,
    person: int | Sequence[int] | None = None,
    year: int | None = None,
    party: str | None = None,
) -> DataFrame:
    """Filtered documents with the version context; sort only when exporting."""
    rows = only(facts, nk_deputado=person, ano=year, sigla_partido=party)
    return rows.select(
        "nk_deputado", "ano", dates.month_name("mes").alias("nome_mes"), "sigla_partido",
        "sigla_uf", "id_legislatura", "tipo_despesa", "nome_fornecedor", "data_documento",
        "num_documento", "tipo_documento", "valor_documento", "valor_liquido", "valor_glosa",
        "url_documento",
    )


def period_summary(rows: DataFrame) -> DataFrame:
    """Totals of a detail listing per party, state and term."""
    return rows.groupBy("sigla_partido", "sigla_uf", "id_legislatura").agg(
        F.sum("valor_liquido").alias("valor_liquido"),
        F.count("valor_documento").alias("documentos"),
    )


def timeline(versions: DataFrame, person: int | Sequence[int] | None = None) -> DataFrame:
    """Versions of a person, one per (year, situation, term): the newest of each."""
    rows = only(versions, nk_deputado=person).withColumn("ano", F.year("valid_from"))
    return latest(
        rows, ["nk_deputado", "ano", "situacao", "id_legislatura"], [F.col("valid_from").desc()]
    )
