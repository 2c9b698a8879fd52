"""The benchmark tables seen as expense, person, bill and vote records.

Amounts become exact decimals, dates move 24 years forward (1995-2001 becomes 2019-2025), market
segments and order priorities stand for parties, nations for states, part types for kinds of
expense, and the hours of the event log for roll calls.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerlens.functions.columns import as_col
from ledgerlens.functions.keys import surrogate_key
from ledgerlens.functions.rules import lookup
from ledgerlens.operators.history import scd2_build
from ledgerlens.operators.lineage import new_path
from ledgerlens.operators.windows import latest, mode_of

# Codes that the benchmark values stand for.
PARTY_OF_SEGMENT = {
    "AUTOMOBILE": "PT", "BUILDING": "PL", "FURNITURE": "NOVO", "HOUSEHOLD": "PSOL",
    "MACHINERY": "MDB",
}
PARTY_OF_PRIORITY = {
    "1-URGENT": "PT", "2-HIGH": "PL", "3-MEDIUM": "NOVO", "4-NOT SPECIFIED": "PSOL",
    "5-LOW": "MDB",
}
PARTIES = ("PT", "PL", "NOVO", "PSOL", "MDB")
BILL_TYPE_OF_PRIORITY = {
    "1-URGENT": "PL", "2-HIGH": "PEC", "3-MEDIUM": "REQ", "4-NOT SPECIFIED": "PDC", "5-LOW": "PLP",
}
STATUS_TEXT = {
    "P": "Tramitando em Conjunto", "F": "Transformado em Norma Jurídica", "O": "Arquivada",
}
KIND_OF_PART = {
    "PROMO": "Divulgação da Atividade Parlamentar", "ECONOMY": "Passagens Aéreas",
    "LARGE": "Combustíveis e Lubrificantes", "MEDIUM": "Telefonia", "SMALL": "Hospedagem",
    "STANDARD": "Locação de Veículos",
}
STATE_OF_NATION = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA", "PB",
    "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SP",
)
VOTE_OF_EVENT = {
    "view": " Sim", "click": "Não", "error": "Obstrução", "signup": "Abstenção ",
    "purchase": "Artigo 17",
}
YEARS = tuple(range(2019, 2026))
DEPUTIES_SINCE = "2000-01-01 00:00:00"


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Typed scan; the schema is read from the file footer once and given from then on."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _forward(c: str) -> Column:
    return F.expr(f"{c} + INTERVAL '24' YEAR")


def _state(nation: str | Column) -> Column:
    return F.try_element_at(
        F.array(*[F.lit(s) for s in STATE_OF_NATION]), as_col(nation).cast("int") + 1
    )


def _millionths(units: Column) -> Column:
    one = F.lit("0.000001").cast("decimal(6,6)")
    return (units.cast("decimal(18,0)") * one).cast("decimal(18,6)")


def expenses(
    spark: SparkSession,
    sf_dir: str,
    supplier_name: bool = False,
    kind: bool = False,
    person: bool = False,
) -> DataFrame:
    """Expense documents. Supplier name, kind and static person attributes are joined on demand."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    # amounts in whole millionths first: the source doubles hold two decimals exactly
    cents = F.rint(F.col("l_extendedprice") * 100).cast("bigint")
    off = F.rint(F.col("l_discount") * 100).cast("bigint")
    when = _forward("o_orderdate")
    df = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    extra = []
    if supplier_name:
        df = df.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        extra.append(F.col("s_name").alias("nome_fornecedor"))
    if kind:
        df = df.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        extra.append(lookup("p_type", KIND_OF_PART).alias("tipo_despesa"))
    if person:
        df = df.join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        extra += [
            F.col("c_name").alias("nome_deputado"),
            lookup("c_mktsegment", PARTY_OF_SEGMENT).alias("sigla_partido"),
            _state("c_nationkey").alias("sigla_uf"),
        ]
    return df.select(
        F.col("o_custkey").alias("deputado_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("cod_documento"),
        F.year(when).alias("ano"),
        F.month(when).alias("mes"),
        F.col("l_suppkey").cast("string").alias("cnpj_cpf_fornecedor"),
        F.col("l_partkey").alias("cod_lote"),
        (F.col("l_linenumber") % 3).cast("bigint").alias("cod_tipo_documento"),
        when.alias("data_documento"),
        F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias(
            "num_documento"
        ),
        F.when(F.col("l_returnflag") == "R", F.col("l_orderkey").cast("string")).alias(
            "num_ressarcimento"
        ),
        F.col("l_linenumber").cast("bigint").alias("parcela"),
        F.col("l_linestatus").alias("tipo_documento"),
        F.when(F.col("l_returnflag") == "N", F.lit(" "))
        .when(F.col("l_returnflag") == "R", F.concat(F.lit("https://doc/"), F.col("l_orderkey")))
        .alias("url_documento"),
        _millionths(cents * 500).alias("valor_documento"),
        _millionths(cents * 5 * off).alias("valor_glosa"),
        _millionths(cents * 5 * (100 - off)).alias("valor_liquido"),
        *extra,
    )


def with_names(
    documents: DataFrame, spark: SparkSession, sf_dir: str, supplier_name: bool = False, kind: bool = False
) -> DataFrame:
    """Documents of :func:`expenses` with supplier name and kind, joined after they were filtered."""
    if supplier_name:
        names = table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").cast("string").alias("_supplier"), F.col("s_name").alias("nome_fornecedor")
        )
        documents = documents.join(names, F.col("cnpj_cpf_fornecedor") == F.col("_supplier")).drop("_supplier")
    if kind:
        kinds = table(spark, sf_dir, "part").select(
            F.col("p_partkey").alias("_part"), lookup("p_type", KIND_OF_PART).alias("tipo_despesa")
        )
        documents = documents.join(kinds, F.col("cod_lote") == F.col("_part")).drop("_part")
    return documents


def deputies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One open version per person."""
    since = F.lit(DEPUTIES_SINCE).cast("timestamp_ntz")
    return table(spark, sf_dir, "customer").select(
        surrogate_key("c_custkey", since).alias("sk_deputado"),
        F.col("c_custkey").alias("nk_deputado"),
        F.upper("c_name").alias("nome_deputado"),
        F.col("c_name").alias("nome_civil"),
        lookup("c_mktsegment", PARTY_OF_SEGMENT).alias("sigla_partido"),
        _state("c_nationkey").alias("sigla_uf"),
        F.when(F.col("c_custkey") % 10 == 0, F.lit("SUPLENTE")).otherwise(F.lit("TITULAR")).alias(
            "condicao_eleitoral"
        ),
        F.lit("EXERCÍCIO").alias("situacao"),
        (F.lit(50) + F.col("c_custkey") % 8).alias("id_legislatura"),
        since.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status messages of every person: party at a time, with the message number."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("deputado_id"),
        _forward("o_orderdate").alias("data_hora"),
        lookup("o_orderpriority", PARTY_OF_PRIORITY).alias("sigla_partido"),
        F.col("o_orderkey").alias("mensagem"),
    )


def party_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Party versions per person out of the status log."""
    return scd2_build(
        status_log(spark, sf_dir), ["deputado_id"], "data_hora", ["sigla_partido"],
        [F.col("mensagem").desc()],
    ).drop("mensagem")


_STORED: dict[tuple[str, str], tuple[str, StructType]] = {}


def deputy_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The person dimension, built on first use and then read as a stored table."""
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _STORED:
        path, built = new_path(spark, "versions"), _deputy_versions(spark, sf_dir)
        built.write.parquet(path)
        _STORED[place] = (path, built.schema)
    path, schema = _STORED[place]
    return spark.read.schema(schema).parquet(path)


def _deputy_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Party versions with the static attributes of the person."""
    static = deputies(spark, sf_dir).select(
        "nk_deputado", "nome_deputado", "nome_civil", "sigla_uf", "condicao_eleitoral", "situacao",
        "id_legislatura",
    )
    versions = party_history(spark, sf_dir).withColumnsRenamed(
        {"deputado_id": "nk_deputado", "scd_id": "sk_deputado"}
    )
    return versions.join(static.hint("merge"), "nk_deputado", "left")  # as many as persons: not for the driver


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed profiles: one per person; those in debt have no tax number, some no party or state."""
    k = F.col("c_custkey")
    number = k.cast("string")
    born = F.to_date(F.lit("1950-01-01")) + (k % 15000).cast("int")
    state = _state(k % 25)
    return table(spark, sf_dir, "customer").select(
        k.alias("id"),
        F.when(F.col("c_acctbal") >= 0, F.lpad(number, 11, "0")).alias("cpf"),
        F.concat(F.lit(" "), F.lower("c_name")).alias("nome_civil"),
        born.alias("data_nascimento"),
        F.lit("belém").alias("municipio_nascimento"),
        _state("c_nationkey").alias("uf_nascimento"),
        F.when(k % 3 == 0, F.lit("m")).when(k % 3 == 1, F.lit("f")).alias("sexo"),
        F.lit(None).cast("string").alias("redes_sociais"),
        (F.to_date(F.lit("2019-01-01")) + (k % 2400).cast("int")).alias("ultimo_status_data"),
        F.concat(F.lit("pessoa "), number).alias("ultimo_status_nome"),
        F.concat(F.lit("urna "), number).alias("ultimo_status_nome_eleitoral"),
        F.when(k % 13 != 0, F.lower(lookup("c_mktsegment", PARTY_OF_SEGMENT))).alias("ultimo_status_sigla_partido"),
        F.when(k % 17 != 0, state).alias("ultimo_status_sigla_uf"),
        F.when(k % 19 != 0, F.lit(50) + k % 8).alias("ultimo_status_id_legislatura"),
        F.when(k % 10 == 0, F.lit("suplente")).otherwise(F.lit("titular")).alias("ultimo_status_condicao_eleitoral"),
        F.when(k % 7 != 0, F.lit("exercício")).alias("ultimo_status_situacao"),
        F.when(k % 4 != 0, F.concat(F.lit("https://f/"), number)).alias("ultimo_status_url_foto"),
        F.when(k % 5 != 0, F.concat(number, F.lit("@camara"))).alias("ultimo_status_email_gabinete"),
        F.concat(F.lit("61 "), number).alias("ultimo_status_telefone_gabinete"),
        F.concat(F.lit("sala "), number).alias("ultimo_status_nome_gabinete"),
        F.concat(F.lit("https://d/"), number).alias("uri"),
    )


def raw_status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed status messages: one per order, with several a day for some persons."""
    k = F.col("o_custkey")
    number = k.cast("string")
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        number.alias("deputado_id"),
        F.concat(F.lit("pessoa "), number).alias("nome"),
        F.concat(F.lit("urna "), number).alias("nome_eleitoral"),
        F.concat(F.lower(lookup("o_orderpriority", PARTY_OF_PRIORITY)), F.lit(" ")).alias("sigla_partido"),
        _state(k % 25).alias("sigla_uf"),
        (F.lit(50) + k % 8).alias("id_legislatura"),
        F.when(F.col("o_orderstatus") == "P", F.lit("licença")).otherwise(F.lit("exercício")).alias("situacao"),
        F.when(k % 10 == 0, F.lit("suplente")).otherwise(F.lit("titular")).alias("condicao_eleitoral"),
        F.lit("alteração").alias("descricao_status"),
        _forward("o_orderdate").alias("data_hora"),
        F.concat(F.lit("https://d/"), number).alias("uri"),
        F.lit("https://p").alias("uri_partido"),
        F.when(F.col("o_orderkey") % 3 != 0, F.lit("https://f")).alias("url_foto"),
    )


def _roll_call_id(ts: str) -> Column:
    return F.date_format(F.date_trunc("hour", F.col(ts)), "yyyyMMddHH")


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Individual votes; the last one of a person in a roll call counts."""
    raw = table(spark, sf_dir, "events").select(
        _roll_call_id("ts").alias("id_votacao"),
        F.col("user_id").alias("deputado_id"),
        lookup("event_type", VOTE_OF_EVENT).alias("tipo_voto"),
        F.col("ts").alias("data_registro_voto"),
        "event_id",
    )
    order = [F.col("data_registro_voto").desc(), F.col("event_id").desc()]
    return latest(raw, ["id_votacao", "deputado_id"], order).drop("event_id")


def roll_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Official tally per hour of the event log, linked to a bill by its running number."""
    hour = F.date_trunc("hour", F.col("ts")).cast("timestamp_ntz")
    kind = F.col("event_type")
    tally = (
        table(spark, sf_dir, "events")
        .groupBy(hour.alias("hora"))
        .agg(
            F.count_if(kind == "view").alias("votos_sim"),
            F.count_if(kind == "click").alias("votos_nao"),
            F.count_if(kind.isin("error", "signup", "purchase")).alias("votos_outros"),
        )
    )
    number = F.timestamp_diff("HOUR", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'"), F.col("hora"))
    return tally.select(
        F.date_format("hora", "yyyyMMddHH").alias("id"),
        F.col("hora").cast("date").alias("data"),
        F.concat(F.lit("Votação "), F.date_format("hora", "yyyyMMddHH")).alias("descricao"),
        (F.col("votos_sim") > F.col("votos_nao")).cast("bigint").alias("aprovacao"),
        number.alias("id_evento"),
        F.lit(180).cast("bigint").alias("id_orgao"),
        F.lit("plen").alias("sigla_orgao"),
        F.lit("matéria").alias("ultima_apresentacao_proposicao_descricao"),
        number.alias("ultima_apresentacao_proposicao_id"),
        F.concat(F.lit("https://v/"), F.date_format("hora", "yyyyMMddHH")).alias("uri"),
        F.lit(None).cast("string").alias("uri_evento"),
        F.lit(None).cast("string").alias("uri_orgao"),
        "votos_sim",
        "votos_nao",
        "votos_outros",
    )


def guidances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Party line per roll call: the most frequent vote; free or missing at some hours."""
    votes_by_party = (
        table(spark, sf_dir, "events")
        .join(table(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"))
        .select(
            _roll_call_id("ts").alias("id_votacao"),
            lookup("c_mktsegment", PARTY_OF_SEGMENT).alias("sigla_bancada"),
            "event_type",
        )
    )
    line = mode_of(votes_by_party, ["id_votacao", "sigla_bancada"], "event_type")
    hour = F.substring("id_votacao", 9, 2).cast("int")
    return line.select(
        "id_votacao",
        F.lit(None).cast("string").alias("descricao"),
        F.when(hour % 6 == 0, F.lit("Liberado"))
        .when(hour % 11 == 5, F.lit(" "))
        .otherwise(lookup("event_type", VOTE_OF_EVENT))
        .alias("orientacao"),
        "sigla_bancada",
        F.lit("plen").alias("sigla_orgao"),
        F.lit(None).cast("string").alias("uri_bancada"),
        F.concat(F.lit("https://v/"), F.col("id_votacao")).alias("uri_votacao"),
    )


def bills(spark: SparkSession, sf_dir: str) -> DataFrame:
    presented = _forward("o_orderdate")
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        key.alias("id"),
        lookup("o_orderpriority", BILL_TYPE_OF_PRIORITY).alias("sigla_tipo"),
        key.alias("numero"),
        F.when(key % 7 == 0, F.lit(0)).otherwise(F.year(presented)).alias("ano"),
        F.concat(F.lit("Tipo "), lookup("o_orderpriority", BILL_TYPE_OF_PRIORITY)).alias(
            "descricao_tipo"
        ),
        F.concat(F.lit("Ementa "), key.cast("string")).alias("ementa"),
        F.lit(None).cast("string").alias("ementa_detalhada"),
        F.lit(None).cast("string").alias("keywords"),
        presented.alias("data_apresentacao"),
        F.lit("Plenário").alias("status_apreciacao"),
        F.expr("o_orderdate + INTERVAL '24' YEAR + make_dt_interval(int(o_orderkey % 400))").alias(
            "status_data_hora"
        ),
        F.when(key % 11 == 0, F.lit("Pronta para Pauta"))
        .when(key % 11 == 1, F.lit("Retirado pelo Autor"))
        .when(key % 11 == 2, F.lit("Vetado totalmente"))
        .otherwise(lookup("o_orderstatus", STATUS_TEXT))
        .alias("status_descricao_situacao"),
        F.lit("PLEN").alias("status_sigla_orgao"),
    )


def authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signatures under bills: suppliers of an order sign it, line 1 as proponent."""
    supplier = table(spark, sf_dir, "supplier")
    return (
        table(spark, sf_dir, "lineitem")
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_orderkey").alias("id_proposicao"),
            F.col("l_suppkey").alias("id_deputado_autor"),
            F.col("s_name").alias("nome_autor"),
            F.lit("Deputado").alias("tipo_autor"),
            F.lit(None).cast("string").alias("sigla_partido_autor"),
            _state("s_nationkey").alias("sigla_uf_autor"),
            F.lit(10000).cast("bigint").alias("cod_tipo_autor"),
            (F.col("l_linenumber") == 1).alias("proponente"),
            F.col("l_linenumber").cast("bigint").alias("ordem_assinatura"),
            F.lit(None).cast("string").alias("uri_autor"),
            F.lit(None).cast("string").alias("uri_partido_autor"),
            F.concat(F.lit("https://p/"), F.col("l_orderkey")).alias("uri_proposicao"),
        )
    )


def topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return (
        table(spark, sf_dir, "lineitem")
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.lit(None).cast("string").alias("sigla_tipo"),
            F.col("l_orderkey").alias("numero"),
            F.lit(None).cast("int").alias("ano"),
            F.col("p_size").cast("bigint").alias("cod_tema"),
            F.col("p_type").alias("tema"),
            F.col("l_quantity").cast("bigint").alias("relevancia"),
            F.concat(F.lit("https://p/proposicoes/"), F.col("l_orderkey")).alias("uri_proposicao"),
        )
    )


def meetings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled meetings out of the event log; length from the JSON text, place by parity."""
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.concat(F.lit(" reunião "), F.col("event_type")).alias("descricao"),
        F.col("event_type").alias("descricao_tipo"),
        F.col("ts").alias("data_hora_inicio"),
        F.when(F.col("event_id") % 5 != 0, F.expr("ts + make_dt_interval(0, 0, int(get_json_object(props, '$.k')))")).alias(
            "data_hora_fim"
        ),
        F.when(k % 3 == 0, F.lit("plenário")).alias("local_camara_nome"),
        F.when(k % 3 == 1, F.lit("praça")).alias("local_externo"),
        F.when(k > 50, F.lit("encerrada")).otherwise(F.lit("agendada ")).alias("situacao"),
        F.concat(F.lit(" https://e/"), F.col("event_id")).alias("uri"),
        F.when(k % 2 == 0, F.concat(F.lit("https://e/"), F.col("event_id"))).alias(
            "url_documento_pauta"
        ),
    )
