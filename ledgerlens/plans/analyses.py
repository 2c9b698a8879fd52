"""Spending analyses: regions, concentration, seasons, growth, suppliers, elections, outliers.

All take expense rows with ``deputado_id, sigla_partido, sigla_uf, ano, mes, valor_liquido`` and,
where named, ``tipo_despesa``, ``nome_fornecedor``, ``cod_documento``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions import rules
from ledgerlens.functions.columns import count_where, sum_where, truth
from ledgerlens.functions.numeric import growth_percent, mean, percent, ratio, round_to
from ledgerlens.functions.text import contains_any
from ledgerlens.operators.aggregates import herfindahl, main_part, trend, value_counts
from ledgerlens.operators.joins import common_keys, with_benchmark, with_group_stats
from ledgerlens.operators.lineage import materialize
from ledgerlens.operators.ordered import group_median, middle_mean, ordered_prefix
from ledgerlens.operators.windows import (
    largest,
    lorenz,
    period_growth,
    pivot_sum,
    share_of,
    top_n,
    top_share,
)

AMOUNT = "valor_liquido"


def _exact(c: str | Column, scale: int = 8) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(f"decimal(28,{scale})")


def overview(expenses: DataFrame) -> DataFrame:
    """One row: persons, states, parties, documents, amount, first and last year."""
    merged = expenses.groupBy("deputado_id", "sigla_uf", "sigla_partido", "ano").agg(
        F.sum(AMOUNT).alias("_sum"), F.count("cod_documento").alias("_n")
    )
    return merged.agg(
        F.count_distinct("deputado_id").alias("total_deputados"),
        F.count_distinct("sigla_uf").alias("total_ufs"),
        F.count_distinct("sigla_partido").alias("total_partidos"),
        F.sum("_n").alias("total_despesas"),
        F.sum("_sum").alias("valor_total"),
        F.min("ano").alias("ano_inicio"),
        F.max("ano").alias("ano_fim"),
    )


def yearly_person_totals(expenses: DataFrame, *attributes: str) -> DataFrame:
    return expenses.groupBy("deputado_id", *attributes, "ano").agg(
        F.sum(AMOUNT).alias("gasto_total")
    )


# --- regions ----------------------------------------------------------------------------


def regional_gap(expenses: DataFrame, base: str = "Sul") -> DataFrame:
    """Mean yearly spending per person by region and the gap to a base region in percent."""
    people = yearly_person_totals(expenses, "sigla_uf").withColumn("regiao", rules.region("sigla_uf"))
    yearly = people.groupBy("regiao", "ano").agg(mean("gasto_total").alias("media_anual"))
    regions = yearly.groupBy("regiao").agg(
        mean(_exact("media_anual")).alias("gasto_medio"),
        F.count(F.lit(1)).alias("anos"),
        round_to(F.stddev_samp("media_anual")).alias("desvio"),
    )
    bench = {"gasto_base": F.max(F.when(F.col("regiao") == base, F.col("gasto_medio")))}
    return with_benchmark(regions, bench).select(
        "regiao",
        round_to("gasto_medio").alias("gasto_medio"),
        "anos",
        "desvio",
        round_to(growth_percent("gasto_medio", "gasto_base")).alias("diferenca_percentual"),
    )


# --- concentration ----------------------------------------------------------------------


def spend_concentration(expenses: DataFrame, share: float = 0.1) -> DataFrame:
    """Per year: share of all spending held by the top tenth of persons."""
    return top_share(
        yearly_person_totals(expenses), ["ano"], "gasto_total", ["deputado_id"], share,
        rows="total_deputados", picked="top_10_percent",
    )


def lorenz_curve(expenses: DataFrame, newest_only: bool = False) -> DataFrame:
    """Cumulative shares per year, largest spender first; optionally only the newest year."""
    people = yearly_person_totals(expenses)
    if newest_only:
        newest = people.agg(F.max("ano").alias("_newest")).scalar()
        people = people.where(F.col("ano") == newest)
    return lorenz(people, ["ano"], "gasto_total", ["deputado_id"])


# --- seasons ----------------------------------------------------------------------------


def _by_quarter(expenses: DataFrame) -> DataFrame:
    return expenses.groupBy("ano", F.ceil(F.col("mes") / 3).cast("int").alias("trimestre")).agg(
        F.sum(AMOUNT).alias("total_gasto"), F.count(F.lit(1)).alias("qtd_despesas")
    )


def fourth_against_first_quarter(expenses: DataFrame) -> DataFrame:
    """Per year with both quarters: spending in Q1 and Q4 and the change in percent."""
    quarters = _by_quarter(expenses)
    wide = quarters.groupBy("ano").agg(
        F.max(F.when(F.col("trimestre") == 1, F.col("total_gasto"))).alias("t1_gasto"),
        F.max(F.when(F.col("trimestre") == 4, F.col("total_gasto"))).alias("t4_gasto"),
    )
    both = wide.where(F.col("t1_gasto").isNotNull() & F.col("t4_gasto").isNotNull())
    return both.withColumn("variacao", round_to(growth_percent("t4_gasto", "t1_gasto")))


def month_table(expenses: DataFrame) -> DataFrame:
    """Years down, months across, spending in the cells, 0 for an empty month."""
    return pivot_sum(expenses, ["ano"], "mes", {m: f"mes_{m:02d}" for m in range(1, 13)}, AMOUNT)


def quarter_trend(expenses: DataFrame) -> DataFrame:
    """Spending per person by quarter, and per year whether it never fell.

    Persons are counted through (year, quarter, person) totals.
    """
    quarter = F.ceil(F.col("mes") / 3).cast("int").alias("trimestre")
    people = expenses.groupBy("ano", quarter, "deputado_id").agg(
        F.sum(AMOUNT).alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    per = people.groupBy("ano", "trimestre").agg(
        F.count(F.lit(1)).alias("qtd_deputados"),
        F.sum("_sum").alias("total_gasto"),
        ratio(F.sum("_sum"), F.count(F.lit(1))).alias("gasto_medio_deputado"),
        ratio(F.sum("_sum"), F.sum("_n")).alias("valor_medio_despesa"),
    )
    w = Window.partitionBy("ano").orderBy("trimestre")
    value = F.col("gasto_medio_deputado")
    steps = per.withColumn("_step", value - F.lag(value).over(w))
    years = steps.groupBy("ano").agg(
        F.count(F.lit(1)).alias("trimestres"),
        truth(F.min("_step") >= 0).alias("tendencia_crescente"),
        F.max(F.when(F.col("trimestre") == 1, value)).alias("_q1"),
        F.max(F.when(F.col("trimestre") == 4, value)).alias("_q4"),
    )
    yearly = years.select(
        "ano", "trimestres", "tendencia_crescente",
        round_to(growth_percent("_q4", "_q1")).alias("crescimento_t4_t1"),
    )
    return per.join(yearly, "ano")


# --- growth -----------------------------------------------------------------------------


def _growth_cases(expenses: DataFrame, at_least_months: int) -> DataFrame:
    monthly = expenses.groupBy("deputado_id", "ano", "mes").agg(F.sum(AMOUNT).alias("_m"))
    yearly = (
        monthly.groupBy("deputado_id", "ano")
        .agg(F.sum("_m").alias("gasto_anual"), F.count(F.lit(1)).alias("meses_com_dados"))
        .where(F.col("meses_com_dados") >= at_least_months)
    )
    return period_growth(
        yearly, ["deputado_id"], "ano", "gasto_anual", "crescimento_percentual", consecutive=True,
        previous_period="ano_base", previous_value="gasto_ano_base",
    )


def consecutive_growth(expenses: DataFrame, at_least_months: int = 6) -> DataFrame:
    """Growth of persons from one year to the very next: mean, median, deviation, big moves."""
    cases = materialize(
        _growth_cases(expenses, at_least_months).withColumn(
            "crescimento_percentual", _exact("crescimento_percentual")
        ),
        "growth",
    )
    g = F.col("crescimento_percentual")
    stats = cases.groupBy("ano_base", F.col("ano").alias("ano_comparacao")).agg(
        round_to(mean(g)).alias("media"),
        round_to(F.stddev_samp(g.cast("double"))).alias("desvio"),
        F.count(g).alias("casos"),
        count_where(g > 10).alias("acima_de_10"),
        count_where(g < -10).alias("abaixo_de_10"),
    )
    middle = group_median(cases, ["ano_base"], "crescimento_percentual", "mediana")
    return stats.join(
        middle.withColumn("mediana", round_to("mediana")), "ano_base", "left"
    )


def growth_overall(
    expenses: DataFrame, at_least_months: int = 6, limit: float = 10
) -> DataFrame:
    """One row over all cases of growth to the very next year: mean, cases above and below the limit
    with their shares, and whether the mean reaches it."""
    g = _exact("crescimento_percentual")
    cases = _growth_cases(expenses, at_least_months).select(g.alias("_g"))
    n, up, down = F.count("_g"), count_where(F.col("_g") > limit), count_where(F.col("_g") < -limit)
    one = cases.agg(mean(F.col("_g")).alias("_mean"), n.alias("casos"), up.alias("acima"), down.alias("abaixo"))
    return one.select(
        round_to("_mean").alias("media_geral"), "casos", "acima", "abaixo",
        percent("acima", "casos").alias("percentual_acima"), percent("abaixo", "casos").alias("percentual_abaixo"),
        F.coalesce(F.col("_mean") >= limit, F.lit(False)).alias("confirmada"),
    )


def strongest_growth(expenses: DataFrame, n: int = 10, at_least_months: int = 6) -> DataFrame:
    cases = _growth_cases(expenses, at_least_months).where(
        F.col("crescimento_percentual").isNotNull()
    )
    order = [F.col("crescimento_percentual").desc(), F.col("deputado_id").asc(), F.col("ano").asc()]
    return largest(cases, order, n)


# --- parties ----------------------------------------------------------------------------


def party_years(expenses: DataFrame, smallest: int = 3) -> DataFrame:
    """Per party and year: persons, spending, spending per person and per document."""
    people = expenses.groupBy("sigla_partido", "ano", "deputado_id").agg(
        F.sum(AMOUNT).alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    persons = F.count(F.lit(1))
    parties = people.groupBy("sigla_partido", "ano").agg(
        persons.alias("qtd_deputados"),
        F.sum("_sum").alias("gasto_total_partido"),
        ratio(F.sum("_sum"), persons).alias("gasto_medio_por_deputado"),
        ratio(F.sum("_sum"), F.sum("_n")).alias("valor_medio_despesa"),
    )
    return parties.where(F.col("qtd_deputados") >= smallest)


def bench_size_bins(expenses: DataFrame, cuts: Sequence[int] = rules.BENCH_BIN_CUTS) -> DataFrame:
    """Per year and size class of a bench: mean size and mean spending per person."""
    sized = party_years(expenses).withColumn(
        "tamanho_bancada", rules.bins("qtd_deputados", cuts, rules.BENCH_BIN_LABELS)
    )
    return sized.groupBy("ano", "tamanho_bancada").agg(
        F.count(F.lit(1)).alias("partidos"),
        round_to(mean("qtd_deputados")).alias("bancada_media"),
        round_to(mean(_exact("gasto_medio_por_deputado"))).alias("gasto_medio_por_deputado"),
    )


def bench_size_trend(expenses: DataFrame) -> DataFrame:
    """Fit and correlation of bench size against spending per person."""
    return trend(party_years(expenses), "qtd_deputados", "gasto_medio_por_deputado")


def party_evolution(expenses: DataFrame, n: int = 5) -> DataFrame:
    """The n biggest parties per year: spending, growth, share among them and volatility."""
    yearly = materialize(
        expenses.groupBy("sigla_partido", "ano").agg(F.sum(AMOUNT).alias("total_gasto")), "parties"
    )
    totals = yearly.groupBy("sigla_partido").agg(F.sum("total_gasto").alias("total_geral"))
    best = largest(totals, [F.col("total_geral").desc(), F.col("sigla_partido").asc()], n)
    picked = yearly.join(best, "sigla_partido")
    grown = period_growth(picked, ["sigla_partido"], "ano", "total_gasto")
    shared = share_of(grown, ["ano"], "total_gasto", "participacao_ano")
    spread = with_group_stats(
        shared, ["sigla_partido"], {"volatilidade": round_to(F.stddev_samp(F.col("total_gasto").cast("double")))}
    )
    whole = with_benchmark(spread, {"_all": F.sum("total_geral")}, totals)
    return whole.select(
        "sigla_partido",
        "ano",
        "total_gasto",
        round_to("crescimento_percentual").alias("crescimento_percentual"),
        round_to("participacao_ano").alias("participacao_ano"),
        "volatilidade",
        percent("total_geral", "_all").alias("participacao_total"),
    )


def party_overview(expenses: DataFrame) -> DataFrame:
    people = expenses.groupBy("sigla_partido", "deputado_id").agg(
        F.sum(AMOUNT).alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    return people.groupBy("sigla_partido").agg(
        F.sum("_sum").alias("total_gasto"),
        F.count(F.lit(1)).alias("qtd_deputados"),
        F.sum("_n").alias("qtd_docs"),
        round_to(ratio(F.sum("_sum"), F.count(F.lit(1)))).alias("gasto_per_capita"),
    )


def government_side(expenses: DataFrame) -> DataFrame:
    """Spending per year of government and opposition parties."""
    side = rules.government_side("ano", "sigla_partido").alias("classificacao_governo")
    people = expenses.groupBy("ano", side, "deputado_id").agg(
        F.sum(AMOUNT).alias("_sum"), F.count(F.lit(1)).alias("_n")
    )
    return people.groupBy("ano", "classificacao_governo").agg(
        F.sum("_sum").alias("total_gasto"),
        round_to(ratio(F.sum("_sum"), F.sum("_n"))).alias("gasto_medio"),
        F.sum("_n").alias("qtd_docs"),
        F.count(F.lit(1)).alias("qtd_deputados"),
        round_to(ratio(F.sum("_sum"), F.count(F.lit(1)))).alias("gasto_per_capita"),
    )


def period_comparison(
    expenses: DataFrame,
    parties: Sequence[str] | None = None,
    first: Sequence[int] = (2019, 2020, 2021, 2022),
    second: Sequence[int] = (2023, 2024, 2025),
) -> DataFrame:
    """Spending of parties in two periods and the change in percent, 0 without a base."""
    rows = expenses if parties is None else expenses.where(F.col("sigla_partido").isin(*parties))
    both = rows.groupBy("sigla_partido").agg(
        sum_where(F.col("ano").isin(*first), AMOUNT, 0).alias("periodo_1"),
        sum_where(F.col("ano").isin(*second), AMOUNT, 0).alias("periodo_2"),
    )
    change = F.when(F.col("periodo_1") > 0, round_to(growth_percent("periodo_2", "periodo_1")))
    return both.withColumn("variacao_percentual", F.coalesce(change, F.lit(0.0)))


# --- suppliers --------------------------------------------------------------------------


def supplier_concentration(
    expenses: DataFrame, parties: Sequence[str] | None = None, share: float = 0.1, at_least: int = 3
) -> DataFrame:
    """Per party and year: share of spending that the top tenth of suppliers receives."""
    rows = expenses if parties is None else expenses.where(F.col("sigla_partido").isin(*parties))
    suppliers = (
        rows.where(F.col("cnpj_cpf_fornecedor").isNotNull())
        .groupBy("sigla_partido", "ano", "cnpj_cpf_fornecedor")
        .agg(F.sum(AMOUNT).alias("valor_total_fornecedor"))
    )
    return top_share(
        suppliers, ["sigla_partido", "ano"], "valor_total_fornecedor", ["cnpj_cpf_fornecedor"],
        share, at_least, rows="total_fornecedores", picked="top_fornecedores", out="concentracao_pct",
    )


def supplier_reach(expenses: DataFrame, n: int | None = None) -> DataFrame:
    """Suppliers by amount: how many parties, states and persons they serve.

    Rows are merged per (supplier, party, state, person) before the distinct counts.
    """
    merged = (
        expenses.where(F.col("nome_fornecedor").isNotNull())
        .groupBy("nome_fornecedor", "sigla_partido", "sigla_uf", "deputado_id")
        .agg(F.sum(AMOUNT).alias("_sum"), F.count("cod_documento").alias("_n"))
    )
    reach = merged.groupBy("nome_fornecedor").agg(
        F.sum("_sum").alias("total_valor"),
        F.count_distinct("sigla_partido").alias("qtd_partidos"),
        F.count_distinct("sigla_uf").alias("qtd_ufs"),
        F.count_distinct("deputado_id").alias("qtd_deputados"),
        F.sum("_n").alias("qtd_notas"),
    )
    order = [F.col("total_valor").desc(), F.col("nome_fornecedor").asc()]
    return reach if n is None else largest(reach, order, n)


def supplier_focus(expenses: DataFrame, part: str = "sigla_partido") -> DataFrame:
    """Per supplier: its main party (or state), the share of it, and the concentration index."""
    rows = expenses.where(F.col("nome_fornecedor").isNotNull())
    merged = rows.groupBy("nome_fornecedor", part).agg(F.sum(AMOUNT).alias("_sum"))
    main = main_part(merged, ["nome_fornecedor"], part, "_sum", "principal", "concentracao")
    index = herfindahl(merged, ["nome_fornecedor"], part, "_sum")
    return main.join(index, "nome_fornecedor").withColumns(
        {
            "concentracao": round_to("concentracao"),
            "indice_concentracao": round_to("indice_concentracao"),
        }
    )


# --- elections --------------------------------------------------------------------------


def election_year_effect(
    expenses: DataFrame,
    words: Sequence[str] = rules.PUBLICITY_WORDS,
    years: Sequence[int] = rules.ELECTION_YEARS,
) -> DataFrame:
    """Mean yearly spending on matching kinds per party in election and other years."""
    yearly = (
        expenses.where(contains_any("tipo_despesa", words))
        .groupBy("sigla_partido", "ano")
        .agg(F.sum(AMOUNT).alias("valor_total"))
    )
    in_election = F.col("ano").isin(*years)
    parties = yearly.groupBy("sigla_partido").agg(
        F.coalesce(mean(F.when(in_election, F.col("valor_total"))), F.lit(0.0)).alias("eleitoral"),
        F.coalesce(mean(F.when(~in_election, F.col("valor_total"))), F.lit(0.0)).alias(
            "nao_eleitoral"
        ),
    )
    return parties.select(
        "sigla_partido",
        rules.party_size("sigla_partido").alias("porte"),
        round_to("eleitoral").alias("eleitoral"),
        round_to("nao_eleitoral").alias("nao_eleitoral"),
        F.coalesce(round_to(growth_percent("eleitoral", "nao_eleitoral")), F.lit(0.0)).alias(
            "variacao_pct"
        ),
    )


def election_types(
    expenses: DataFrame, years: Sequence[int] = rules.ELECTION_YEARS
) -> DataFrame:
    """Kinds of expense that occur in both sorts of years, with the change in percent."""
    in_election = F.col("ano").isin(*years)
    kind = "tipo_despesa"
    merged = expenses.groupBy(kind, in_election.alias("_e")).agg(F.sum(AMOUNT).alias("_sum"))
    first = merged.where(F.col("_e")).select(kind, F.col("_sum").alias("eleitoral"))
    other = merged.where(~F.col("_e")).select(kind, F.col("_sum").alias("nao_eleitoral"))
    both = common_keys(first, other, [kind]).where(F.col("nao_eleitoral") > 0)
    return both.withColumn(
        "crescimento_percentual", round_to(growth_percent("eleitoral", "nao_eleitoral"))
    )


def election_months(expenses: DataFrame, years: Sequence[int] = rules.ELECTION_YEARS) -> DataFrame:
    """Mean spending per month of the year in election and other years."""
    monthly = expenses.groupBy("ano", "mes").agg(F.sum(AMOUNT).alias("_sum"))
    in_election = F.col("ano").isin(*years)
    per = monthly.groupBy("mes").agg(
        round_to(mean(F.when(in_election, F.col("_sum")))).alias("eleitoral"),
        round_to(mean(F.when(~in_election, F.col("_sum")))).alias("nao_eleitoral"),
    )
    return per.withColumn("variacao", round_to(growth_percent("eleitoral", "nao_eleitoral")))


def election_yearly_mean(
    expenses: DataFrame, years: Sequence[int] = rules.ELECTION_YEARS
) -> DataFrame:
    """One row: spending per election year on record against other years."""
    yearly = expenses.groupBy("ano").agg(F.sum(AMOUNT).alias("_sum"))
    e = F.col("ano").isin(*years)
    one = yearly.agg(
        mean(F.when(e, F.col("_sum"))).alias("media_eleitoral"),
        mean(F.when(~e, F.col("_sum"))).alias("media_nao_eleitoral"),
    )
    change = round_to(growth_percent("media_eleitoral", "media_nao_eleitoral"))
    return one.select(
        round_to("media_eleitoral").alias("media_eleitoral"),
        round_to("media_nao_eleitoral").alias("media_nao_eleitoral"),
        change.alias("variacao_percentual"),
        truth(change > 10).alias("aumento_confirmado"),
    )


# --- transport --------------------------------------------------------------------------


def transport_by_state(
    expenses: DataFrame, words: Sequence[str] = rules.TRANSPORT_WORDS
) -> DataFrame:
    """Mean yearly transport spending per person by state, with region and distance."""
    people = (
        expenses.where(contains_any("tipo_despesa", words))
        .groupBy("sigla_uf", "deputado_id", "ano")
        .agg(F.sum(AMOUNT).alias("_sum"))
    )
    return people.groupBy("sigla_uf").agg(mean("_sum").alias("valor_transporte")).select(
        "sigla_uf",
        rules.region("sigla_uf").alias("regiao"),
        rules.distance("sigla_uf").alias("distancia"),
        round_to("valor_transporte").alias("valor_transporte"),
    )


def transport_against_distance(
    expenses: DataFrame, words: Sequence[str] = rules.TRANSPORT_WORDS
) -> DataFrame:
    """One row: fit and correlation of distance and transport spending, near against far."""
    people = materialize(
        expenses.where(contains_any("tipo_despesa", words))
        .groupBy("sigla_uf", "deputado_id", "ano")
        .agg(F.sum(AMOUNT).alias("_sum")),
        "transport",
    )
    near, far = F.col("sigla_uf").isin(*rules.NEAR_STATES), F.col("sigla_uf").isin(*rules.FAR_STATES)
    ends = people.agg(
        round_to(mean(F.when(near, F.col("_sum")))).alias("gasto_proximos"),
        round_to(mean(F.when(far, F.col("_sum")))).alias("gasto_distantes"),
    )
    states = (
        people.groupBy("sigla_uf").agg(mean("_sum").alias("valor"))
        .withColumn("distancia", rules.distance("sigla_uf"))
    )
    line = trend(states, "distancia", "valor")
    pair = line.agg(F.first(F.struct("*")).alias("_line"))
    return ends.select(
        "*", pair.scalar().alias("_line"),
        round_to(growth_percent("gasto_distantes", "gasto_proximos")).alias("diferenca_pct"),
    ).select(
        "gasto_proximos", "gasto_distantes", "diferenca_pct",
        round_to("_line.inclinacao", 4).alias("inclinacao"),
        round_to("_line.intercepto", 4).alias("intercepto"),
        round_to("_line.correlacao", 6).alias("correlacao"),
    )


# --- rankings and outliers --------------------------------------------------------------


def top_by_state_class(expenses: DataFrame, n: int = 50) -> DataFrame:
    """Per year: how many of the n biggest spenders come from rich, middle and poor states."""
    people = yearly_person_totals(expenses, "sigla_uf")
    top = top_n(people, ["ano"], [F.col("gasto_total").desc(), F.col("deputado_id").asc()], n)
    kind = rules.state_class("sigla_uf")
    total = F.count(F.lit(1))
    return top.groupBy("ano").agg(
        total.alias("total_top"),
        count_where(kind == "Rico").alias("ricos"),
        count_where(kind == "Médio").alias("medios"),
        count_where(kind == "Pobre").alias("pobres"),
        percent(count_where(kind == "Rico"), total).alias("pct_ricos"),
        percent(count_where(kind == "Pobre"), total).alias("pct_pobres"),
    )


def yearly_outliers(expenses: DataFrame, n: int = 5) -> DataFrame:
    """The n biggest spenders per year with multiple of the mean, z-score and median.

    One ordered pass per year yields rank, size and median.
    """
    people = expenses.groupBy("deputado_id", "sigla_partido", "sigla_uf", "ano").agg(
        F.sum(AMOUNT).alias("gasto_total"), F.count("cod_documento").alias("qtd_despesas")
    )
    order = [
        F.col("gasto_total").desc(), F.col("deputado_id").asc(),
        F.col("sigla_partido").asc(), F.col("sigla_uf").asc(),
    ]
    ranked = ordered_prefix(people, order, ["ano"], rank="ranking", rows="_rows")
    spent = F.col("gasto_total").cast("double")
    stats = ranked.groupBy("ano").agg(
        mean("gasto_total").alias("_mean"),
        middle_mean("ranking", "_rows", "gasto_total").alias("_median"),
        F.stddev_samp(spent).alias("_std"),
    )
    top = ranked.where(F.col("ranking") <= n).join(stats, "ano")
    return top.select(
        "ano", "ranking", "deputado_id", "sigla_partido", "sigla_uf", "gasto_total", "qtd_despesas",
        round_to("_mean").alias("media_ano"),
        round_to("_median").alias("mediana_ano"),
        round_to("_std").alias("desvio_ano"),
        round_to(ratio("gasto_total", "_mean"), 4).alias("multiplo_media"),
        round_to(F.coalesce(ratio(spent - F.col("_mean"), "_std"), F.lit(0.0)), 4).alias(
            "desvios_padrao"
        ),
    )


def outlier_summary(outliers: DataFrame) -> dict[str, DataFrame]:
    """Who recurs among the outliers, their parties and states, and the biggest multiple."""
    biggest = largest(
        outliers, [F.col("multiplo_media").desc(), F.col("ano").asc(), F.col("ranking").asc()], 1
    )
    people = value_counts(outliers, ["deputado_id"])
    return {
        "recorrentes": people.where(F.col("quantidade") > 1),
        "partidos": value_counts(outliers, ["sigla_partido"]),
        "ufs": value_counts(outliers, ["sigla_uf"]),
        "maior": biggest,
    }


def recurrent_top(
    expenses: DataFrame, n: int = 10, at_least_years: int = 3
) -> DataFrame:
    """Persons among the n biggest spenders in several years, with their whole spending."""
    people = materialize(yearly_person_totals(expenses), "people")
    order = [F.col("gasto_total").desc(), F.col("deputado_id").asc()]
    often = (
        top_n(people, ["ano"], order, n).groupBy("deputado_id")
        .agg(F.count(F.lit(1)).alias("anos_no_top")).where(F.col("anos_no_top") >= at_least_years)
    )
    totals = people.groupBy("deputado_id").agg(F.sum("gasto_total").alias("total_gasto"))
    return often.join(totals, "deputado_id")


def largest_documents(expenses: DataFrame, n: int = 5) -> DataFrame:
    """The n largest documents of every year; each task keeps n rows per year."""
    order = [F.col(AMOUNT).desc(), F.col("cod_documento").asc(), F.col("cod_lote").asc(),
             F.col("cnpj_cpf_fornecedor").asc()]
    return top_n(expenses, ["ano"], order, n, "rn").select(
        "ano", "rn", "deputado_id", "sigla_partido", "sigla_uf", "cod_documento", AMOUNT,
        "tipo_despesa", "data_documento",
    )


def top_spenders(expenses: DataFrame, n: int = 50) -> DataFrame:
    """The n biggest spenders over the whole period, with documents and years."""
    people = expenses.groupBy("deputado_id", "sigla_partido", "sigla_uf").agg(
        F.sum(AMOUNT).alias("total_gasto"),
        F.count("cod_documento").alias("qtd_docs"),
        F.min("ano").alias("ano_inicio"),
        F.max("ano").alias("ano_fim"),
    )
    return largest(people, [F.col("total_gasto").desc(), F.col("deputado_id").asc()], n)


def documents_against_amount(expenses: DataFrame, n: int = 50) -> DataFrame:
    """One row: straight-line fit of documents and amount over the biggest spenders."""
    line = trend(top_spenders(expenses, n), "qtd_docs", "total_gasto")
    return line.select(
        round_to("inclinacao", 4).alias("inclinacao"),
        round_to("intercepto", 4).alias("intercepto"),
        round_to("correlacao", 6).alias("correlacao"),
    )


# --- kinds of expense -------------------------------------------------------------------


def type_profile(expenses: DataFrame) -> DataFrame:
    """Per kind: amount, mean, documents, persons and parties (diversity and efficiency)."""
    merged = (
        expenses.where(F.col("tipo_despesa").isNotNull())
        .groupBy("tipo_despesa", "sigla_partido", "deputado_id")
        .agg(F.sum(AMOUNT).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    )
    return merged.groupBy("tipo_despesa").agg(
        F.sum("_sum").alias("total_valor"),
        round_to(ratio(F.sum("_sum"), F.sum("_n"))).alias("valor_medio"),
        F.sum("_n").alias("qtd_docs"),
        F.count_distinct("deputado_id").alias("qtd_deputados"),
        F.count_distinct("sigla_partido").alias("qtd_partidos"),
    )


def type_seasons(expenses: DataFrame) -> DataFrame:
    """Per kind: the months with the highest and the lowest mean document."""
    monthly = (
        expenses.where(F.col("tipo_despesa").isNotNull())
        .groupBy("tipo_despesa", "mes").agg(mean(AMOUNT).alias("_mean"))
    )
    high = F.max_by(F.struct("mes", "_mean"), F.struct("_mean", (-F.col("mes")).alias("_m")))
    low = F.min_by(F.struct("mes", "_mean"), F.struct("_mean", "mes"))
    return monthly.groupBy("tipo_despesa").agg(high.alias("_h"), low.alias("_l")).select(
        "tipo_despesa",
        F.col("_h.mes").alias("mes_maior"),
        round_to("_h._mean").alias("valor_maior"),
        F.col("_l.mes").alias("mes_menor"),
        round_to("_l._mean").alias("valor_menor"),
    )


def type_evolution(expenses: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Years down, the given kinds across."""
    return pivot_sum(expenses, ["ano"], "tipo_despesa", columns, AMOUNT)


def top_type_evolution(expenses: DataFrame, n: int = 5) -> DataFrame:
    """Years down, the ``n`` kinds with the largest total across: name and amount of each place.

    The kinds are chosen by their totals, ties by name, and their places pivoted, so the columns
    are known before the kinds are. A year without a kind has 0.
    """
    merged = (
        expenses.where(F.col("tipo_despesa").isNotNull())
        .groupBy("tipo_despesa", "ano").agg(F.sum(AMOUNT).alias("_v"))
    )
    totals = merged.groupBy("tipo_despesa").agg(F.sum("_v").alias("_total"))
    best = largest(totals, [F.col("_total").desc(), F.col("tipo_despesa").asc()], n)
    place = F.row_number().over(Window.orderBy(F.col("_total").desc(), "tipo_despesa"))  # n rows
    ranked = best.select("tipo_despesa", place.alias("_place"))
    rows = merged.join(F.broadcast(ranked), "tipo_despesa")
    names = ranked.agg(
        *[F.max(F.when(F.col("_place") == i, F.col("tipo_despesa"))).alias(f"nome_{i}") for i in range(1, n + 1)]
    )
    amounts = rows.groupBy("ano").agg(
        *[sum_where(F.col("_place") == i, F.col("_v"), 0).alias(f"tipo_{i}") for i in range(1, n + 1)]
    )
    return with_benchmark(amounts, {f"nome_{i}": F.max(f"nome_{i}") for i in range(1, n + 1)}, names)


def type_party_shares(expenses: DataFrame, n: int = 5) -> DataFrame:
    """Per kind: the parties that spend most on it and their share."""
    merged = (
        expenses.where(F.col("tipo_despesa").isNotNull())
        .groupBy("tipo_despesa", "sigla_partido").agg(F.sum(AMOUNT).alias("valor"))
    )
    shared = share_of(merged, ["tipo_despesa"], "valor", "percentual")
    top = top_n(
        shared, ["tipo_despesa"], [F.col("valor").desc(), F.col("sigla_partido").asc()], n, "posicao"
    )
    return top.withColumn("percentual", round_to("percentual"))
