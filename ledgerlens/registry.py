"""Every product and operator as a named query over the benchmark tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens import adapters as a
from ledgerlens.functions import dates, keys, numeric, rules, text
from ledgerlens.operators import (
    aggregates, history, intervals, joins, quality, rows, sketches, upsert, versioned, windows,
)
from ledgerlens.operators.lineage import materialize, new_path
from ledgerlens.operators.ordered import group_median
from ledgerlens.plans import analyses, dimensions, explore, facts, incremental, marts, person, staging
from ledgerlens.sources import bucketed, checked, periods, readers, variants, writers
from ledgerlens.streaming import histories
from ledgerlens.streaming import merge as streams

AS_OF = "2025-12-31"

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types every engine prints alike: whole numbers, doubles, text and booleans."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(spark, sf_dir))

    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


# --- tables shared by several queries ---------------------------------------------------


def _expense_facts(spark: SparkSession, d: str, **more: bool) -> DataFrame:
    return facts.expense_fact(a.expenses(spark, d, **more))


def _votes(spark: SparkSession, d: str) -> DataFrame:
    return staging.votes(a.votes(spark, d))


def _roll_calls(spark: SparkSession, d: str) -> DataFrame:
    return staging.roll_calls(a.roll_calls(spark, d))


def _bills(spark: SparkSession, d: str) -> DataFrame:
    return staging.bills(a.bills(spark, d))


def _vote_facts(spark: SparkSession, d: str) -> DataFrame:
    return facts.vote_fact(
        _votes(spark, d), _roll_calls(spark, d), staging.guidances(a.guidances(spark, d)),
        _bills(spark, d), a.deputies(spark, d),
    )


def _bill_facts(spark: SparkSession, d: str, per_author: bool = False) -> DataFrame:
    return facts.bill_fact(
        _bills(spark, d), staging.authors(a.authors(spark, d)), staging.topics(a.topics(spark, d)),
        _roll_calls(spark, d), per_author,
    )


def _with_person_version(spark: SparkSession, d: str, **names: bool) -> DataFrame:
    """Documents with their person version, and then with the asked names: filters on year and party
    reach the documents before they move to suppliers and kinds."""
    keep = ("nk_deputado", "sigla_partido", "sigla_uf", "id_legislatura", "valid_from", "valid_to")
    base = a.expenses(spark, d).withColumnRenamed("deputado_id", "nk_deputado")
    versions = a.deputy_versions(spark, d).select(*keep)
    return a.with_names(
        facts.with_versions(base, versions, "nk_deputado", "data_documento", "inner"), spark, d, **names
    )


# --- sources, cleaning, keys ------------------------------------------------------------


@query
def json_path_extract(spark: SparkSession, d: str) -> DataFrame:
    """JSON text to typed columns, and a safe cast of a nested path."""
    events = a.table(spark, d, "events")
    nested = readers.json_fields(events, "props", "k string").select(
        "event_id", F.struct(F.col("k").alias("valor"), F.col("event_type").alias("tipo")).alias("corpo")
    )
    return readers.project(
        nested,
        {"event_id": ("event_id", "bigint"), "k": ("corpo.valor", "bigint"), "tipo": ("corpo.tipo", "string")},
    )


@query
def json_array_flatten(spark: SparkSession, d: str) -> DataFrame:
    """JSON documents with an array of rows, written by the query and flattened again."""
    item = F.struct(
        F.col("l_orderkey").alias("codDocumento"), F.col("l_linenumber").alias("parcela"),
        F.col("l_extendedprice").alias("valorDocumento"),
    )
    path = new_path(spark, "documents")
    lines = a.table(spark, d, "lineitem")
    lines.groupBy("l_linenumber", "l_orderkey").agg(F.collect_list(item).alias("dados")).select(
        F.col("l_linenumber").alias("deputado"), "dados"
    ).write.partitionBy("deputado").json(path)
    schema = T.StructType.fromDDL(
        "dados array<struct<codDocumento: bigint, parcela: int, valorDocumento: double>>"
    )
    documents = spark.read.schema(schema).json(path)
    tagged = readers.with_file_context(documents, deputado_id="deputado=")
    flat = tagged.select("deputado_id", F.inline("dados"))
    return flat.groupBy("deputado_id").agg(
        F.count(F.lit(1)).alias("linhas"),
        F.sum("codDocumento").alias("soma_documentos"),
        F.sum(F.col("valorDocumento").cast("decimal(18,2)")).alias("valor"),
    )


@query
def align_by_name(spark: SparkSession, d: str) -> DataFrame:
    """Columns matched by name in any case; a missing one becomes NULL, a surplus one goes."""
    orders = a.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("COD_DOCUMENTO"), F.col("o_custkey").cast("string").alias("Deputado_Id"),
        F.col("o_totalprice").alias("sobra"),
    )
    wanted = T.StructType.fromDDL("deputado_id bigint, cod_documento bigint, parcela bigint")
    return readers.align(orders, wanted)


@query
def period_landing(spark: SparkSession, d: str) -> DataFrame:
    """Documents without refund landed by year and month, two months replaced by all their documents:
    rows per period before and after."""
    path = new_path(spark, "landing")
    docs = a.expenses(spark, d).select("cod_documento", "valor_documento", "num_ressarcimento", "ano", "mes")
    writers.append(docs.where(F.col("num_ressarcimento").isNull()), path, ["ano", "mes"])
    before = materialize(spark.read.schema(docs.schema).parquet(path), "before")
    writers.replace_periods(periods.in_periods(docs, [(2020, 1), (2020, 2)]), path)
    return writers.compare_periods(before, spark.read.schema(docs.schema).parquet(path))


@query
def timestamped_landing(spark: SparkSession, d: str) -> DataFrame:
    """Two loads of the same months side by side, one file per month each, told apart by their stamp."""
    path = new_path(spark, "landing")
    docs = a.expenses(spark, d).select("cod_documento", "num_ressarcimento", "ano", "mes")
    writers.land_period_files(docs.where(F.col("num_ressarcimento").isNull()), path, "despesas", "20250101_030000")
    writers.land_period_files(docs, path, "despesas", "20250102_030000")
    landed = spark.read.schema(docs.schema).option("recursiveFileLookup", "true").parquet(path)
    names = F.col("_metadata.file_path")
    loads = landed.select(
        F.regexp_extract(names, "despesas-([0-9_]+)/", 1).alias("carga"),
        F.regexp_extract(names, "ano=([0-9]+)", 1).cast("int").alias("ano"),
        F.regexp_extract(names, "mes=([0-9]+)", 1).cast("int").alias("mes"),
        names.alias("arquivo"),
    )
    return loads.groupBy("carga", "ano", "mes").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_distinct("arquivo").alias("arquivos")
    )


@query
def seed_table(spark: SparkSession, d: str) -> DataFrame:
    """Kinds of parts written as a quoted seed file and read with the column types of the contract."""
    source = new_path(spark, "seed")
    kinds = a.table(spark, d, "part").groupBy("p_type").agg(
        F.min("p_partkey").alias("codCategoria"), F.count(F.lit(1)).alias("codSubCategoria")
    )
    kinds.select(
        "codCategoria", F.concat("p_type", F.lit("; parte")).alias("categoria"), "codSubCategoria",
        F.when(F.col("p_type") != "PROMO", F.lower("p_type")).alias("subCategoria"),
    ).write.csv(source, sep=";", header=True, quoteAll=True)
    return readers.read_seed(spark, source, "categorias")


@query
def nested_rows_flatten(spark: SparkSession, d: str) -> DataFrame:
    """Rows with records inside records as flat columns named by their path."""
    pages = a.table(spark, d, "pages")
    nested = pages.select(
        "page_id",
        F.struct(
            F.col("url"),
            F.struct(F.length("html").alias("tamanho"), F.md5("html").alias("resumo")).alias("corpo"),
        ).alias("pagina"),
    )
    path = new_path(spark, "nested")
    nested.write.json(path)
    return readers.flatten(spark.read.schema(nested.schema).json(path))


@query
def json_latest_merge(spark: SparkSession, d: str) -> DataFrame:
    """JSON documents with several records per key: the newest record of each key is merged into a
    table that holds the open orders."""
    source, path = new_path(spark, "json"), new_path(spark, "orders")
    orders = a.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("pessoa"), F.col("o_orderstatus").alias("situacao"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dia"), F.year("o_orderdate").alias("ano"),
    )
    versioned.commit(spark, path, orders.where(F.col("situacao") == "O"), ["id"], ["ano"])
    # each order once as ordered and once as settled a day later
    settled = orders.withColumns(
        {"situacao": F.lit("S"), "dia": F.date_format(F.date_add(F.to_date("dia"), 1), "yyyy-MM-dd")}
    )
    _as_documents(orders.unionByName(settled), ["ano"]).write.json(source)
    wanted = T.StructType([T.StructField("dados", T.ArrayType(orders.schema))])
    rows_ = readers.read_json_documents(spark, source, wanted, whole_file=False).select(*orders.columns)
    versioned.commit(spark, path, rows_, ["id"], ["ano"], order_by=[F.col("dia").desc()])
    return versioned.read(spark, path, orders.schema, ["ano"])


def _as_documents(df: DataFrame, by: list[str], rows_each: int = 500) -> DataFrame:
    """Rows as documents ``{"dados": [...]}`` of some ``rows_each`` rows of a group, however large the
    group: rows are dealt by hash to as many documents as the group's row count asks for."""
    counted = df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / F.lit(rows_each)).alias("_docs"))
    dealt = df.join(counted, by).withColumn("_doc", F.pmod(F.xxhash64(*df.columns), F.col("_docs")))
    item = F.struct(*df.columns)
    return dealt.groupBy(*by, "_doc").agg(F.collect_list(item).alias("dados")).select("dados")


@query
def rows_per_file(spark: SparkSession, d: str) -> DataFrame:
    audit = writers.rows_per_file(a.table(spark, d, "lineitem"))
    return audit.select(F.regexp_extract("arquivo", "([a-z]+)[.]parquet$", 1).alias("arquivo"), "linhas")


@query
def clean_text(spark: SparkSession, d: str) -> DataFrame:
    """Upper-cased trimmed text, fill flag, length test and literal search over whole texts."""
    docs = a.table(spark, d, "documents")
    return docs.select(
        "doc_id",
        F.md5(text.standard("text")).alias("texto_md5"),
        text.filled("text").alias("preenchido"),
        F.length(F.trim("lang")).between(2, 10).alias("lang_valida"),
        text.contains_any("text", ["LICENSE", "EMAIL"]).alias("contem"),
        F.col("source").ilike("%a%").alias("fonte_a"),
    )


@query
def meetings(spark: SparkSession, d: str) -> DataFrame:
    """Meetings with calendar parts, length, day period, place and document flags."""
    return staging.meetings(a.meetings(spark, d), "2024-01-20")


@query
def party_and_category_rules(spark: SparkSession, d: str) -> DataFrame:
    """Keyword and alias ladders over the kinds, nations and states of the expenses."""
    base = a.expenses(spark, d, kind=True, person=True)
    bills = a.bills(spark, d).select("id", "status_descricao_situacao")
    kinds = base.groupBy("tipo_despesa", "sigla_uf", "sigla_partido").agg(F.count(F.lit(1)).alias("n"))
    rated = kinds.select(
        rules.expense_category("tipo_despesa").alias("categoria"),
        rules.region("sigla_uf").alias("regiao"),
        rules.state_class("sigla_uf").alias("classe_uf"),
        rules.party_name(F.concat(F.lit("P"), F.col("sigla_partido"))).alias("partido"),
        "n",
    )
    left = rated.groupBy("categoria", "regiao", "classe_uf", "partido").agg(F.sum("n").alias("n"))
    status = bills.groupBy(
        rules.standard_status("status_descricao_situacao").alias("categoria"),
        rules.bill_status("status_descricao_situacao").alias("regiao"),
    ).agg(F.count(F.lit(1)).alias("n"))
    return rows.union_padded(left, status)


@query
def guidance_rules(spark: SparkSession, d: str) -> DataFrame:
    g = staging.guidances(a.guidances(spark, d))
    return g.select(
        "id_votacao", "sigla_bancada", "orientacao_padronizada", "tipo_bancada", "tem_orientacao",
        "tem_uri_votacao", "tem_uri_bancada",
    )


@query
def surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    lines = a.table(spark, d, "lineitem")
    flagged = F.when(F.col("l_returnflag") == "R", F.col("l_linestatus"))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        keys.surrogate_key("l_orderkey", "l_linenumber", flagged).alias("sk"),
        keys.audit_hash("l_partkey", flagged, "l_suppkey").alias("hash_auditoria"),
    )


@query
def uri_tail_id(spark: SparkSession, d: str) -> DataFrame:
    pages = a.table(spark, d, "pages")
    return pages.select(
        "page_id", keys.id_from_uri("url").alias("id_final"),
        keys.id_from_uri("url", "en").alias("id_recurso"),
        keys.number_after("url", "page=").alias("pagina"),
    )


@query
def expense_staging(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned documents, exact duplicates removed."""
    staged = staging.expenses(a.expenses(spark, d, supplier_name=True, kind=True))
    return staged.groupBy("tipo_despesa", "nome_fornecedor", "ano").agg(
        F.count(F.lit(1)).alias("n"), F.sum("valor_liquido").alias("valor")
    )


# --- dimensions -------------------------------------------------------------------------


@query
def calendar_terms(spark: SparkSession, d: str) -> DataFrame:
    """Calendar over the span of the documents with the covering term and documents per day."""
    orders = a.table(spark, d, "orders").select(F.expr("date(o_orderdate + INTERVAL '24' YEAR)").alias("data"))
    lo, hi = orders.agg(F.min("data"), F.max("data")).first()
    days = dimensions.calendar_with_terms(dimensions.calendar(spark, str(lo), str(hi)), _terms(spark))
    daily = orders.groupBy("data").agg(F.count(F.lit(1)).alias("n"))
    return days.join(daily, "data", "left").withColumn("n", F.coalesce("n", F.lit(0)))


def _terms(spark: SparkSession) -> DataFrame:
    terms = spark.createDataFrame(TERMS, "idLegislatura int, dataInicio string, dataFim string, anoEleicao int")
    return terms.withColumns({c: F.col(c).cast("date") for c in ("dataInicio", "dataFim")})


# The legislative terms that the documents fall into.
TERMS = [
    (55, "2015-02-01", "2019-01-31", 2014),
    (56, "2019-02-01", "2023-01-31", 2018),
    (57, "2023-02-01", "2027-01-31", 2022),
]


@query
def mode_dimension(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.topic_dimension(a.topics(spark, d))


@query
def supplier_dimension(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.supplier_dimension(a.expenses(spark, d, supplier_name=True))


@query
def expense_type_dimension(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.expense_type_dimension(a.expenses(spark, d, kind=True))


@query
def person_ranking(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.person_ranking(a.expenses(spark, d, person=True))


@query
def party_ranking(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.party_ranking(a.expenses(spark, d, person=True))


# --- history and joins ------------------------------------------------------------------


@query
def latest_wins_dedup(spark: SparkSession, d: str) -> DataFrame:
    lines = a.table(spark, d, "lineitem")
    order = [F.col("l_shipdate").desc(), F.col("l_partkey").desc(), F.col("l_suppkey").desc()]
    return windows.latest(lines, ["l_orderkey", "l_linenumber"], order).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"
    )


@query
def scd2_history(spark: SparkSession, d: str) -> DataFrame:
    return a.party_history(spark, d)


@query
def scd2_incremental(spark: SparkSession, d: str) -> DataFrame:
    """History built up to a date, then continued with the later messages and every 5th of the
    earlier ones, which arrive late."""
    log = a.status_log(spark, d)
    newer = F.col("data_hora") >= F.expr("TIMESTAMP_NTZ'2023-01-01 00:00:00'")
    late = (F.col("mensagem") % 5 == 0) | newer
    key, tracked, tie = ["deputado_id"], ["sigla_partido"], [F.col("mensagem").desc()]
    stored = log.where(~late)
    first = history.scd2_build(stored, key, "data_hora", tracked, tie)
    # the message number decides at one instant, whichever arrived first
    one = windows.latest(log, [*key, "data_hora"], tie)
    changes = one.where(late).unionByName(
        one.where(~late).join(log.where(late).select(*key, "data_hora").distinct(), [*key, "data_hora"], "left_semi")
    )
    return history.scd2_apply(first, stored, changes, key, "data_hora", tracked, tie).drop("mensagem")


@query
def asof_version_join(spark: SparkSession, d: str) -> DataFrame:
    """Each document with the party its person had at the shipping date."""
    lines = a.table(spark, d, "lineitem").join(
        a.table(spark, d, "orders").select("o_orderkey", "o_custkey"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    docs = lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("o_custkey").alias("deputado_id"),
        F.expr("l_shipdate + INTERVAL '24' YEAR - INTERVAL '200' DAY").alias("quando"),
    )
    versions = a.deputy_versions(spark, d).select(
        F.col("nk_deputado").alias("deputado_id"), "sigla_partido", "valid_from", "valid_to"
    )
    return joins.version_join(docs, versions, ["deputado_id"], "quando").drop("valid_to")


@query
def safe_anti(spark: SparkSession, d: str) -> DataFrame:
    """Persons without an urgent order; NULL keys on the excluded side do no harm."""
    customers = a.table(spark, d, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    excluded = a.table(spark, d, "orders").select(
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_custkey")).alias("k")
    )
    return joins.not_in(customers, excluded, ["k"])


@query
def union_null_pad(spark: SparkSession, d: str) -> DataFrame:
    """Two sources of one entity: persons with orders come from there, all others from the list of
    persons; columns that a source lacks are NULL."""
    first = a.table(spark, d, "orders").groupBy(F.col("o_custkey").alias("chave")).agg(
        F.count(F.lit(1)).alias("pedidos")
    )
    second = a.table(spark, d, "customer").select(F.col("c_custkey").alias("chave"), F.col("c_name").alias("nome"))
    return history.prefer_first(first, second, ["chave"])


def _people(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return staging.profiles(a.profiles(spark, d)), staging.status_history(a.raw_status_log(spark, d))


@query
def status_history(spark: SparkSession, d: str) -> DataFrame:
    return _people(spark, d)[1]


@query
def persons_from_two_sources(spark: SparkSession, d: str) -> DataFrame:
    """Profiles with a tax number, and the status rows of everyone else."""
    return staging.persons(*_people(spark, d))


@query
def person_dimension(spark: SparkSession, d: str) -> DataFrame:
    return dimensions.person_dimension(*_people(spark, d), AS_OF)


@query
def current_persons(spark: SparkSession, d: str) -> DataFrame:
    profiles, log = _people(spark, d)
    return dimensions.current_persons(profiles.dropna(subset=["cpf"]), log)


@query
def status_listing(spark: SparkSession, d: str) -> DataFrame:
    """Timeline of every person: one version per year, situation and term."""
    return person.timeline(a.deputy_versions(spark, d)).select(
        "nk_deputado", "ano", "situacao", "id_legislatura", "sigla_partido", "valid_from"
    )


@query
def version_term_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Days that every person version shares with every legislative term it reaches into."""
    versions = a.deputy_versions(spark, d).select(
        "nk_deputado", "sigla_partido", F.to_date("valid_from").alias("de"), F.to_date("valid_to").alias("ate")
    )
    both = intervals.overlaps(versions, _terms(spark), ("de", "ate"), ("dataInicio", "dataFim"))
    until = F.least(F.coalesce("ate", "dataFim"), F.col("dataFim"))
    return both.select(
        "nk_deputado", "sigla_partido", "de", "idLegislatura",
        (F.datediff(until, F.greatest("de", "dataInicio")) + 1).alias("dias"),
    )


@query
def documents_in_versions(spark: SparkSession, d: str) -> DataFrame:
    """Documents per person version, matched to the second by dyadic nodes of each person's time."""
    docs = a.expenses(spark, d).select("deputado_id", "data_documento", "valor_liquido")
    versions = a.deputy_versions(spark, d).select(
        F.col("nk_deputado").alias("deputado_id"), "sigla_partido", "valid_from", "valid_to"
    )
    joined = intervals.range_join(
        docs, versions, "data_documento", "valid_from", "valid_to", on=["deputado_id"], unit="second", closed=False
    )
    return joined.groupBy("deputado_id", "sigla_partido", "valid_from").agg(
        F.count(F.lit(1)).alias("documentos"), F.sum("valor_liquido").alias("valor")
    )


@query
def scd2_stream(spark: SparkSession, d: str) -> DataFrame:
    """The history kept while the log arrives three times, the low priorities after all others."""
    log = a.status_log(spark, d)
    late = F.col("sigla_partido") == a.PARTY_OF_PRIORITY["5-LOW"]
    newer = F.col("data_hora") >= F.expr("TIMESTAMP_NTZ'2023-01-01 00:00:00'")
    folder, path = new_path(spark, "arrivals"), new_path(spark, "histories")
    offsets = new_path(spark, "offsets")
    for rows_of_arrival in (~late & ~newer, ~late & newer, late):
        log.where(rows_of_arrival).write.mode("append").parquet(folder)  # as many files as tasks
        run = histories.history_stream(
            streams.arriving_files(spark, folder, log.schema), path, offsets,
            ["deputado_id"], "data_hora", ["sigla_partido"], ["mensagem"], 8,
        )
        run.awaitTermination()
    schema = history.scd2_build(log, ["deputado_id"], "data_hora", ["sigla_partido"]).schema
    return histories.history(spark, path, schema).drop("mensagem")


# --- facts ------------------------------------------------------------------------------


@query
def expense_fact_derived(spark: SparkSession, d: str) -> DataFrame:
    return _expense_facts(spark, d)


@query
def vote_tally(spark: SparkSession, d: str) -> DataFrame:
    return facts.roll_call_fact(
        _roll_calls(spark, d), _votes(spark, d), a.deputies(spark, d), _bills(spark, d)
    )


@query
def vote_adherence(spark: SparkSession, d: str) -> DataFrame:
    return _vote_facts(spark, d)


@query
def bill_fact(spark: SparkSession, d: str) -> DataFrame:
    return _bill_facts(spark, d)


@query
def bill_fact_per_author(spark: SparkSession, d: str) -> DataFrame:
    return _bill_facts(spark, d, per_author=True)


# --- marts ------------------------------------------------------------------------------


@query
def spend_by_entity_quota(spark: SparkSession, d: str) -> DataFrame:
    return marts.spend_per_person(_expense_facts(spark, d), a.deputy_versions(spark, d))


@query
def spend_on_person_pipeline(spark: SparkSession, d: str) -> DataFrame:
    """Spending from landed records on: cleaned documents, versions out of profiles and status log."""
    people = dimensions.person_dimension(*_people(spark, d), AS_OF)
    landed = a.expenses(spark, d).repartition("deputado_id")  # the one move of the documents to their person
    documents = facts.expense_fact(staging.expenses(landed))
    people = people.select("nk_deputado", "valid_from", "valid_to", *[c for c in marts.PERSON if c != "deputado_id"])
    return marts.spend_per_person(documents, materialize(people, "people"))


BUCKETS, ROWS_PER_BUCKET = 16, 250_000


def _buckets(rows: int) -> int:
    """Buckets of a table with so many rows: one task handles one bucket, however large the table."""
    return max(BUCKETS, -(-rows // ROWS_PER_BUCKET))


def _bucketed(spark: SparkSession, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    path = new_path(spark, name)
    return bucketed.store(df, path.rsplit("/", 1)[1].replace("-", "_"), [key], buckets, path)


@query
def spend_on_buckets(spark: SparkSession, d: str) -> DataFrame:
    """The same out of documents and versions that are stored in buckets by person."""
    n = _buckets(a.table(spark, d, "lineitem").count())
    documents = _bucketed(spark, _expense_facts(spark, d), "documents", "nk_deputado", n)
    people = _bucketed(spark, a.deputy_versions(spark, d), "people", "nk_deputado", n)
    return marts.spend_per_person(documents, people, by_key=True)


@query
def votes_on_buckets(spark: SparkSession, d: str) -> DataFrame:
    """Votes with version, roll call, guidance and bill out of votes stored in buckets by person."""
    n = _buckets(a.table(spark, d, "events").count())
    cast = _bucketed(spark, _votes(spark, d), "votes", "deputado_id", n)
    people = _bucketed(spark, a.deputies(spark, d), "people", "nk_deputado", n)
    return facts.vote_fact(
        cast, _roll_calls(spark, d), staging.guidances(a.guidances(spark, d)), _bills(spark, d), people, by_key=True
    )


@query
def spend_vs_state_segment_avg(spark: SparkSession, d: str) -> DataFrame:
    return marts.spend_with_benchmarks(_expense_facts(spark, d), a.deputy_versions(spark, d))


def _productivity(spark: SparkSession, d: str) -> DataFrame:
    return marts.productivity(
        staging.authors(a.authors(spark, d)), _bill_facts(spark, d), a.deputies(spark, d)
    )


@query
def productivity(spark: SparkSession, d: str) -> DataFrame:
    return _productivity(spark, d)


@query
def presence_loyalty(spark: SparkSession, d: str) -> DataFrame:
    return marts.presence(_vote_facts(spark, d), _roll_calls(spark, d), a.deputies(spark, d))


@query
def presence_on_versions(spark: SparkSession, d: str) -> DataFrame:
    """Presence of persons who change their party: each version against the roll calls of its days."""
    people = a.deputy_versions(spark, d)
    votes = facts.vote_fact(
        _votes(spark, d), _roll_calls(spark, d), staging.guidances(a.guidances(spark, d)),
        _bills(spark, d), people,
    )
    return marts.presence(votes, _roll_calls(spark, d), people)


@query
def discipline_cohesion(spark: SparkSession, d: str) -> DataFrame:
    return marts.discipline(materialize(_vote_facts(spark, d), "votes"))


@query
def state_switching(spark: SparkSession, d: str) -> DataFrame:
    return marts.switching(a.deputy_versions(spark, d).withColumnRenamed("nk_deputado", "deputado_id"), AS_OF)


@query
def efficiency_scorecard(spark: SparkSession, d: str) -> DataFrame:
    people = a.deputies(spark, d)
    votes = materialize(_vote_facts(spark, d), "votes")
    return marts.scorecard(
        people,
        marts.spend_per_person(_expense_facts(spark, d), people),
        _productivity(spark, d),
        marts.presence(votes, _roll_calls(spark, d), people),
        marts.discipline(votes),
    )


# --- exploration ------------------------------------------------------------------------


@query
def activity_full_outer(spark: SparkSession, d: str) -> DataFrame:
    votes = _votes(spark, d).withColumn("data_votacao", F.col("data_registro_voto").cast("date"))
    return explore.activity(votes, staging.authors(a.authors(spark, d)), _bills(spark, d))


@query
def spend_ranking(spark: SparkSession, d: str) -> DataFrame:
    return explore.spend_ranking(a.expenses(spark, d))


@query
def yearly_growth_lag(spark: SparkSession, d: str) -> DataFrame:
    bills = _bills(spark, d)
    return explore.bills_over_time(
        bills.withColumn("ano", rows.value_if("ano", 0, F.year("data_apresentacao")))
    )


@query
def entity_yearly_growth(spark: SparkSession, d: str) -> DataFrame:
    return explore.yearly_growth(a.expenses(spark, d), ["deputado_id"], "valor_liquido")


@query
def type_profile(spark: SparkSession, d: str) -> DataFrame:
    return explore.bill_types(_bills(spark, d))


@query
def kpi_list(spark: SparkSession, d: str) -> DataFrame:
    return explore.headline_metrics(_vote_facts(spark, d))


# --- person reports ---------------------------------------------------------------------


@query
def entity_selector(spark: SparkSession, d: str) -> DataFrame:
    docs = a.expenses(spark, d).withColumnRenamed("deputado_id", "nk_deputado")
    return person.selector(docs, a.deputy_versions(spark, d))


@query
def entity_kpis(spark: SparkSession, d: str) -> DataFrame:
    return person.indicators(_with_person_version(spark, d))


@query
def monthly_evolution(spark: SparkSession, d: str) -> DataFrame:
    return person.monthly_evolution(_with_person_version(spark, d))


@query
def top15_suppliers(spark: SparkSession, d: str) -> DataFrame:
    docs = a.expenses(spark, d, supplier_name=True).withColumnRenamed("deputado_id", "nk_deputado")
    return person.top_suppliers(docs)


@query
def top_suppliers_per_person(spark: SparkSession, d: str) -> DataFrame:
    docs = a.expenses(spark, d, supplier_name=True).withColumnRenamed("deputado_id", "nk_deputado")
    return person.top_suppliers_each(docs, 3)


@query
def type_by_year(spark: SparkSession, d: str) -> DataFrame:
    docs = a.expenses(spark, d, kind=True).withColumnRenamed("deputado_id", "nk_deputado")
    return person.by_type_and_year(docs)


@query
def detail_listing(spark: SparkSession, d: str) -> DataFrame:
    docs = _with_person_version(spark, d, supplier_name=True, kind=True)
    return person.details(docs, year=2022, party="PT")


@query
def type_totals(spark: SparkSession, d: str) -> DataFrame:
    docs = a.expenses(spark, d, kind=True).withColumnRenamed("deputado_id", "nk_deputado")
    return person.by_type(docs)


@query
def detail_summary(spark: SparkSession, d: str) -> DataFrame:
    docs = _with_person_version(spark, d, supplier_name=True, kind=True)
    return person.period_summary(person.details(docs))


# --- analyses ---------------------------------------------------------------------------


def _analysis(name: str, fn, **needs: bool) -> None:
    def run(spark: SparkSession, d: str) -> DataFrame:
        return fn(a.expenses(spark, d, **needs))

    run.__name__, run.__doc__ = name, fn.__doc__
    query(run)


_analysis("data_overview", analyses.overview, person=True)
_analysis("regional_gap", analyses.regional_gap, person=True)
_analysis("pareto_top10pct", analyses.spend_concentration)
_analysis("lorenz_curve", analyses.lorenz_curve)
_analysis("seasonality_q4_q1", analyses.fourth_against_first_quarter)
_analysis("month_year_pivot", analyses.month_table)
_analysis("consecutive_growth", lambda e: analyses.consecutive_growth(e, at_least_months=2))
_analysis("growth_overall", lambda e: analyses.growth_overall(e, at_least_months=2))
_analysis("strongest_growth", lambda e: analyses.strongest_growth(e, at_least_months=2))
_analysis("bench_bins", lambda e: analyses.bench_size_bins(e, (270, 300)), person=True)
_analysis("corr_bench_spend", lambda e: _rounded_trend(analyses.bench_size_trend(e)), person=True)
_analysis("supplier_concentration", analyses.supplier_concentration, person=True)
_analysis("cycle_vs_offcycle", analyses.election_year_effect, person=True, kind=True)
_analysis("election_types", analyses.election_types, kind=True)
_analysis("election_months", analyses.election_months)
_analysis("election_yearly_mean", analyses.election_yearly_mean)
_analysis("keyword_category_distance", analyses.transport_by_state, person=True, kind=True)
_analysis("transport_trend", analyses.transport_against_distance, person=True, kind=True)
_analysis("class_share_top50", analyses.top_by_state_class, person=True)
_analysis("quarter_trend", analyses.quarter_trend)
_analysis("yearly_outliers", analyses.yearly_outliers, person=True)
_analysis("recurrent_top10", lambda e: analyses.recurrent_top(e, at_least_years=2))
_analysis("top5_docs", analyses.largest_documents, person=True, kind=True)
_analysis("government_sides", analyses.government_side, person=True)
_analysis("period_alignment", analyses.period_comparison, person=True)
_analysis("supplier_reach", analyses.supplier_reach, person=True, supplier_name=True)
_analysis("hhi", analyses.supplier_focus, person=True, supplier_name=True)
_analysis("hhi_states", lambda e: analyses.supplier_focus(e, "sigla_uf"), person=True, supplier_name=True)
_analysis("docs_value_trend", analyses.documents_against_amount, person=True)
_analysis("market_share_volatility", lambda e: analyses.party_evolution(e, 3), person=True)
_analysis("party_overview", analyses.party_overview, person=True)
_analysis("expense_type_diversity", analyses.type_profile, person=True, kind=True)
_analysis("expense_type_seasons", analyses.type_seasons, kind=True)
_analysis("top_type_evolution", analyses.top_type_evolution, kind=True)
_analysis("expense_type_parties", analyses.type_party_shares, person=True, kind=True)
_analysis(
    "expense_type_evolution",
    lambda e: analyses.type_evolution(
        e, {k: f"tipo_{i}" for i, k in enumerate(sorted(a.KIND_OF_PART.values()), 1)}
    ),
    kind=True,
)


def _rounded_trend(line: DataFrame) -> DataFrame:
    return line.select(
        numeric.round_to("inclinacao", 4).alias("inclinacao"),
        numeric.round_to("intercepto", 4).alias("intercepto"),
        numeric.round_to("correlacao", 6).alias("correlacao"),
    )


@query
def outlier_parties(spark: SparkSession, d: str) -> DataFrame:
    top = analyses.yearly_outliers(a.expenses(spark, d, person=True))
    return analyses.outlier_summary(top)["partidos"]


@query
def outlier_states(spark: SparkSession, d: str) -> DataFrame:
    top = analyses.yearly_outliers(a.expenses(spark, d, person=True))
    return analyses.outlier_summary(top)["ufs"]


@query
def outlier_recurrent(spark: SparkSession, d: str) -> DataFrame:
    top = analyses.yearly_outliers(a.expenses(spark, d, person=True))
    return analyses.outlier_summary(top)["recorrentes"]


@query
def outlier_biggest(spark: SparkSession, d: str) -> DataFrame:
    top = analyses.yearly_outliers(a.expenses(spark, d, person=True))
    return analyses.outlier_summary(top)["maior"]


@query
def filter_values(spark: SparkSession, d: str) -> DataFrame:
    """Values that a filter by state and party offers."""
    return rows.distinct_values(a.expenses(spark, d, person=True), "sigla_uf", "sigla_partido")


@query
def median_by_state(spark: SparkSession, d: str) -> DataFrame:
    """Exact median document per state."""
    docs = a.expenses(spark, d, person=True)
    return group_median(docs, ["sigla_uf"], "valor_liquido", "mediana")


@query
def party_list_per_year(spark: SparkSession, d: str) -> DataFrame:
    docs = a.expenses(spark, d, person=True)
    return aggregates.text_list(docs, ["ano", "sigla_uf"], "sigla_partido", "partidos")


# --- measures that merge ----------------------------------------------------------------

_COUNTED = ["deputado_id", "cnpj_cpf_fornecedor", "cod_documento"]


def _stored_sketches(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    docs = a.expenses(spark, d, person=True)
    return docs, materialize(sketches.distinct_sketches(docs, ["ano", "sigla_uf"], _COUNTED), "sketches")


@query
def distinct_by_sketch(spark: SparkSession, d: str) -> DataFrame:
    """Distinct persons, suppliers and documents per state over 2020 to 2024, out of yearly
    sketches, each within the stated error of the exact count."""
    docs, stored = _stored_sketches(spark, d)
    span = F.col("ano").between(2020, 2024)
    merged = sketches.merged_distinct(stored.where(span), ["sigla_uf"], _COUNTED)
    estimates = merged.select("sigla_uf", *[sketches.distinct_count(c).alias(f"_{c}") for c in _COUNTED])
    exact = docs.where(span).groupBy("sigla_uf").agg(*[F.count_distinct(c).alias(c) for c in _COUNTED])
    return exact.join(estimates, "sigla_uf").select(
        "sigla_uf", *_COUNTED, *[sketches.within(f"_{c}", c).alias(f"{c}_dentro") for c in _COUNTED]
    )


@query
def common_suppliers_by_sketch(spark: SparkSession, d: str) -> DataFrame:
    """Suppliers that a state paid both in 2020 and in 2021, out of stored sketches."""
    docs, stored = _stored_sketches(spark, d)
    supplier = "cnpj_cpf_fornecedor"
    year = lambda y: stored.where(F.col("ano") == y).select("sigla_uf", F.col(supplier).alias(f"s{y}"))
    both = year(2020).join(year(2021), "sigla_uf").select(
        "sigla_uf", sketches.common_count("s2020", "s2021").alias("_comuns"),
        sketches.distinct_count(F.theta_union("s2020", "s2021")).alias("_todos"),
    )
    pairs = docs.where(F.col("ano").isin(2020, 2021)).groupBy("sigla_uf", supplier).agg(
        F.count_distinct("ano").alias("anos")
    )
    exact = pairs.groupBy("sigla_uf").agg(F.count_if(F.col("anos") == 2).alias("comuns"))
    return exact.join(both, "sigla_uf").select(
        "sigla_uf", "comuns", sketches.within("_comuns", "comuns", "_todos").alias("dentro")
    )


@query
def quantiles_by_sketch(spark: SparkSession, d: str) -> DataFrame:
    """Median and ninth decile of a state's documents out of yearly sketches: whether their true
    rank, a span where values tie, is within the stated error."""
    docs = a.expenses(spark, d, person=True)
    stored = materialize(sketches.quantile_sketches(docs, ["ano", "sigla_uf"], "valor_liquido"), "sketches")
    merged = sketches.merged_quantiles(stored, ["sigla_uf"])
    found = merged.select(
        "sigla_uf", sketches.quantile("sketch", 0.5).alias("_q5"), sketches.quantile("sketch", 0.9).alias("_q9")
    )
    value = F.col("valor_liquido").cast("double")
    ranked = docs.join(found, "sigla_uf").groupBy("sigla_uf").agg(
        F.count(F.lit(1)).alias("documentos"),
        *[F.count_if(value < F.col(q)).alias(f"{q}_below") for q in ("_q5", "_q9")],
        *[F.count_if(value <= F.col(q)).alias(f"{q}_upto") for q in ("_q5", "_q9")],
    )

    def close(q: str, share: float) -> F.Column:
        n, slack = F.col("documentos"), sketches.KLL_ERROR
        return (F.col(f"{q}_below") <= n * (share + slack)) & (F.col(f"{q}_upto") >= n * (share - slack))

    return ranked.select(
        "sigla_uf", "documentos", close("_q5", 0.5).alias("mediana_dentro"), close("_q9", 0.9).alias("decil_dentro")
    )


@query
def heavy_suppliers(spark: SparkSession, d: str) -> DataFrame:
    """The ten suppliers with the most documents, found without a count per supplier."""
    return sketches.heavy_values(a.expenses(spark, d), "cnpj_cpf_fornecedor", 10)


# --- loading ----------------------------------------------------------------------------


def _versions_of_documents(spark: SparkSession, d: str) -> DataFrame:
    lines = a.table(spark, d, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_extendedprice").cast("decimal(12,2)").alias("valor"), "l_returnflag",
        F.year("l_shipdate").alias("ano"),
    )


@query
def upsert_merge(spark: SparkSession, d: str) -> DataFrame:
    """Documents of one return flag as the table, the others as one batch with repeated keys."""
    docs = _versions_of_documents(spark, d)
    order = [F.col(c).desc() for c in ("l_partkey", "l_suppkey", "valor", "ano", "l_returnflag")]
    key = ["l_orderkey", "l_linenumber"]
    target = windows.latest(docs.where(F.col("l_returnflag") == "N"), key, order)
    return upsert.merge_rows(target, docs.where(F.col("l_returnflag") != "N"), key, order)


@query
def upsert_periods(spark: SparkSession, d: str) -> DataFrame:
    """The same merge on folders by year: rows move between folders, the table is read back."""
    docs = _versions_of_documents(spark, d)
    order = [F.col(c).desc() for c in ("l_partkey", "l_suppkey", "valor", "ano", "l_returnflag")]
    key, path = ["l_orderkey", "l_linenumber"], new_path(spark, "table")
    for flags in (["N"], ["A", "R"]):
        batch = docs.where(F.col("l_returnflag").isin(*flags))
        upsert.upsert(spark, path, batch, key, ["ano"], order)
    return spark.read.schema(docs.schema).parquet(path)


@query
def stream_upsert_equals_batch(spark: SparkSession, d: str) -> DataFrame:
    """The event log arriving in four files, merged per person and type: the newest event stays."""
    events = a.table(spark, d, "events").select(
        "user_id", "event_type", "event_id", "ts", F.date_format("ts", "yyyy-MM-dd").alias("dia")
    )
    folder, path = new_path(spark, "arrivals"), new_path(spark, "table")
    events.repartition(4, "event_id").write.parquet(folder)
    stream = streams.arriving_files(spark, folder, events.schema, files_per_batch=1)
    run = streams.merge_stream(
        stream, path, new_path(spark, "offsets"), ["user_id", "event_type"], ["dia"],
        sequence=["ts", "event_id"],
    )
    run.awaitTermination()
    return spark.read.schema(events.schema).parquet(path)


@query
def stream_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Repeated (person, type, day) dropped while streaming."""
    events = a.table(spark, d, "events").select(
        "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"),
        F.date_format("ts", "yyyy-MM-dd").alias("dia"),
    )
    folder, path = new_path(spark, "arrivals"), new_path(spark, "unique")
    events.repartition(2, "user_id", "ts").write.parquet(folder)
    stream = streams.arriving_files(spark, folder, events.schema, files_per_batch=1)
    run = streams.append_unique(
        stream, path, new_path(spark, "offsets"), ["user_id", "event_type", "dia"], ["dia"]
    )
    run.awaitTermination()
    return spark.read.schema(events.schema).parquet(path).select("user_id", "event_type", "dia")


def _order_batches(spark: SparkSession, d: str) -> list[tuple[DataFrame, DataFrame | None]]:
    """Three batches over all orders: open and finished ones; finished ones with another price and
    the pending ones; pending ones a year later, while urgent orders go."""
    orders = a.table(spark, d, "orders").withColumns(
        {"o_totalprice": F.col("o_totalprice").cast("decimal(12,2)"), "ano": F.year("o_orderdate")}
    )
    status = F.col("o_orderstatus")
    corrected = orders.where(status == "F").withColumn("o_totalprice", (F.col("o_totalprice") + 1).cast("decimal(12,2)"))
    moved = orders.where(status == "P").withColumn("ano", F.col("ano") + 1)
    return [
        (orders.where(status != "P"), None),
        (corrected.unionByName(orders.where(status == "P")), None),
        (moved, orders.where((F.col("o_orderpriority") == "1-URGENT") & (status != "P")).select("o_orderkey")),
    ]


def _order_versions(spark: SparkSession, d: str) -> tuple[str, T.StructType]:
    path, schema = new_path(spark, "orders"), None
    for batch, gone in _order_batches(spark, d):
        schema = batch.schema
        versioned.commit(spark, path, batch, ["o_orderkey"], ["ano"], deletes=gone)
    return path, schema


@query
def versioned_table(spark: SparkSession, d: str) -> DataFrame:
    """Orders after inserts, corrections, moves to another period and deletions, by key."""
    path, schema = _order_versions(spark, d)
    return versioned.read(spark, path, schema, ["ano"])


@query
def version_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The same table as it was after its second batch, read when the third is done."""
    path, schema = _order_versions(spark, d)
    return versioned.read(spark, path, schema, ["ano"], version=2)


@query
def change_feed(spark: SparkSession, d: str) -> DataFrame:
    """Rows changed since the first version, before and after."""
    path, schema = _order_versions(spark, d)
    return versioned.changes(spark, path, schema, since=1)


@query
def change_feed_replay(spark: SparkSession, d: str) -> DataFrame:
    """The table rebuilt from its feed alone."""
    path, schema = _order_versions(spark, d)
    return versioned.replayed(versioned.changes(spark, path, schema), ["o_orderkey"])


def _document_batches(spark: SparkSession, d: str) -> list[tuple[DataFrame, DataFrame | None]]:
    """Three batches over all documents: those not refunded; the refunded ones, and those without an
    address with twice the amounts; the seventh lines of all documents go."""
    docs, read = a.expenses(spark, d), incremental.READ
    amounts = ("valor_documento", "valor_glosa", "valor_liquido")
    doubled = [(F.col(c) * 2).cast("decimal(18,6)").alias(c) if c in amounts else F.col(c) for c in read]
    # a document may be refunded and without an address: it stands once for each
    second = F.array(
        F.when(F.col("num_ressarcimento").isNotNull(), F.struct(*read)),
        F.when(F.col("url_documento").isNull(), F.struct(*doubled)),
    )
    return [
        (docs.where(F.col("num_ressarcimento").isNull()).select(*read), None),
        (
            docs.where(F.col("num_ressarcimento").isNotNull() | F.col("url_documento").isNull())
            .select(F.explode(F.array_compact(second)).alias("_d")).select("_d.*"),
            None,
        ),
        (docs.limit(0).select(*read), docs.where(F.col("parcela") == 7)),
    ]


def _commit_documents(spark: SparkSession, table: str, batch: DataFrame, gone: DataFrame | None) -> DataFrame:
    """The rows that one batch changes; of several rows of a document and part the largest counts."""
    key = ["cod_documento", "cod_lote", "cnpj_cpf_fornecedor"]
    largest = [F.col("valor_documento").desc(), F.col("valor_glosa").desc()]
    now = versioned.commit(spark, table, batch, key, ["ano"], order_by=largest, deletes=gone, few=True)
    return versioned.changes(spark, table, batch.schema, now - 1, now)


@query
def incremental_spending(spark: SparkSession, d: str) -> DataFrame:
    """Spending per person version kept up to date through corrections and deletions."""
    people = a.deputy_versions(spark, d)
    table, totals, like = new_path(spark, "documents"), new_path(spark, "totals"), None
    for batch, gone in _document_batches(spark, d):
        like = incremental.spending_lines(_commit_documents(spark, table, batch, gone), people)
        incremental.SPENDING.apply(spark, totals, like)
    return incremental.spending(incremental.SPENDING.read(spark, totals, like), people)


@query
def incremental_ranking(spark: SparkSession, d: str) -> DataFrame:
    """Ranking of spenders kept up to date through corrections and deletions."""
    table, totals, like = new_path(spark, "documents"), new_path(spark, "totals"), None
    for batch, gone in _document_batches(spark, d):
        like = incremental.yearly_lines(_commit_documents(spark, table, batch, gone))
        incremental.YEARLY.apply(spark, totals, like)
    return incremental.ranking(incremental.YEARLY.read(spark, totals, like))


@query
def stream_two_way_dedup(spark: SparkSession, d: str) -> DataFrame:
    """Unique (person, type, day) of a stream in which errors of each week arrive two arrivals late, and
    purchases twice, the second time at the end; the query is stopped and started in between."""
    events = a.table(spark, d, "events").select(
        "user_id", "event_type", F.date_trunc("day", F.col("ts").cast("timestamp")).alias("dia")
    )
    week = F.floor((F.dayofmonth("dia") - 1) / 7)
    error, folder = F.col("event_type") == "error", new_path(spark, "arrivals")
    path, offsets = new_path(spark, "unique"), new_path(spark, "offsets")
    for n in range(7):
        rows = events.where(((week == n) & ~error) | ((week == n - 2) & error))
        if n == 6:
            rows = rows.unionByName(events.where(F.col("event_type") == "purchase"))
        rows.write.mode("append").parquet(folder)  # as many files as tasks, one batch for each arrival
        stream = streams.arriving_files(spark, folder, events.schema)
        run = streams.unique_two_ways(
            stream, path, offsets, ["user_id", "event_type", "dia"], "dia", "3 days"
        )
        run.awaitTermination()
    return streams.unique_rows(spark, path, events.schema).withColumn("dia", F.date_format("dia", "yyyy-MM-dd"))


@query
def full_refresh_audit(spark: SparkSession, d: str) -> DataFrame:
    """A table of half years refreshed with whole years: rows per period before and after."""
    path = new_path(spark, "refresh")
    docs = a.expenses(spark, d).select("cod_documento", "ano", "mes")
    writers.overwrite(docs.where(F.col("mes") <= 6), path, ["ano", "mes"])
    before = materialize(spark.read.schema(docs.schema).parquet(path), "before")
    writers.overwrite(docs, path, ["ano", "mes"])
    return writers.compare_periods(before, spark.read.schema(docs.schema).parquet(path))


@query
def sliding_reload(spark: SparkSession, d: str) -> DataFrame:
    """A table without refunded documents whose current and previous month are loaded in full; the
    previous month has become empty at the source."""
    path = new_path(spark, "sliding")
    docs = a.expenses(spark, d).select("cod_documento", "num_ressarcimento", "ano", "mes")
    writers.overwrite(docs.where(F.col("num_ressarcimento").isNull()), path, ["ano", "mes"])
    months = periods.current_and_previous(date(2020, 1, 15))
    source = docs.where((F.col("ano") != 2019) | (F.col("mes") != 12))
    writers.reload_periods(source, path, months)
    return writers.rows_per_period(spark.read.schema(docs.schema).parquet(path))


@query
def months_to_load(spark: SparkSession, d: str) -> DataFrame:
    """Months of the work list that a table of half years does not hold."""
    held = a.expenses(spark, d).where(F.col("mes") <= 6)
    wanted = periods.work_list(date(2020, 12, 31), full=True, first=2016)
    return periods.missing_periods(spark, wanted, held)


@query
def rows_since_newest_year(spark: SparkSession, d: str) -> DataFrame:
    """Documents from the newest year of a table onwards, counted per year."""
    docs = a.expenses(spark, d)
    fresh = periods.since_last(docs, docs.where(F.col("ano") <= 2019))
    return fresh.groupBy("ano").agg(F.count(F.lit(1)).alias("linhas"))


@query
def delimited_landing(spark: SparkSession, d: str) -> DataFrame:
    """Delimited text with repeated rows and dotted names, landed as Parquet."""
    source = new_path(spark, "delimited")
    lines = a.table(spark, d, "lineitem").select("l_returnflag", "l_linenumber", "l_partkey")
    dotted = lines.toDF("linha.estado", "linha.numero", "peca")
    dotted.write.csv(source, sep=";", header=True)
    return writers.land_csv(spark, source, new_path(spark, "landed"), dotted.schema)


@query
def malformed_lines(spark: SparkSession, d: str) -> DataFrame:
    """Delimited text read without the lines whose number is not one."""
    source = new_path(spark, "delimited")
    number = F.col("l_linenumber")
    a.table(spark, d, "lineitem").select(
        "l_orderkey", F.when(number == 3, F.lit("x")).otherwise(number.cast("string")).alias("linha")
    ).write.csv(source, sep=";", header=True)
    wanted = T.StructType.fromDDL("l_orderkey bigint, linha int")
    return readers.read_delimited(spark, source, wanted)


@query
def sorted_listing(spark: SparkSession, d: str) -> DataFrame:
    """Documents exported as a listing, largest first, and read again with their place in it."""
    target = new_path(spark, "listing")
    docs = a.expenses(spark, d, person=True).select(
        "ano", "sigla_uf", "cod_documento", "valor_liquido", "cod_lote", "cnpj_cpf_fornecedor"
    )
    order = [F.col("ano").desc(), F.col("sigla_uf").asc(), F.col("valor_liquido").desc()]
    writers.export_csv(docs, target, [*order, "cod_documento", "cod_lote", "cnpj_cpf_fornecedor"], ";")
    return readers.listing_rows(readers.read_delimited(spark, target, docs.schema))


@query
def json_documents(spark: SparkSession, d: str) -> DataFrame:
    """JSON documents of many rows each, read row by row."""
    source = new_path(spark, "json")
    orders = a.table(spark, d, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("situacao"), F.year("o_orderdate").alias("ano")
    )
    _as_documents(orders, ["ano"]).write.json(source)
    wanted = T.StructType.fromDDL("dados array<struct<id: bigint, situacao: string>>")
    return readers.read_json_documents(spark, source, wanted, whole_file=False).drop("arquivo")


def _drifting(spark: SparkSession, d: str) -> DataFrame:
    """Events as JSON text whose fields change type or move between levels by kind of event, landed
    and read again."""
    e = a.table(spark, d, "events").withColumn("quando", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    moment, value = F.col("quando"), F.col("value")
    shapes = {
        "view": F.struct("event_id", value.alias("valor"), F.struct(moment.alias("data")).alias("corpo")),
        "click": F.struct(
            F.col("event_id").cast("string").alias("event_id"), value.cast("string").alias("valor"),
            F.struct(moment.alias("data")).alias("corpo"),
        ),
        "error": F.struct(
            "event_id", F.struct(value.alias("valor"), F.struct(moment.alias("data")).alias("status")).alias("corpo")
        ),
        "signup": F.struct("event_id", F.lit(True).alias("valor"), F.struct(F.lit("n/d").alias("data")).alias("corpo")),
        "purchase": F.struct("event_id", F.floor(value).alias("valor"), moment.alias("corpo")),
    }
    text = F.coalesce(*[F.when(F.col("event_type") == k, F.to_json(s)) for k, s in shapes.items()])
    folder = new_path(spark, "json")
    e.select(text.alias("value")).write.text(folder)
    return variants.parsed(spark.read.text(folder), "value").drop("value")


@query
def variant_fields(spark: SparkSession, d: str) -> DataFrame:
    """Typed table out of such documents, with a safe timestamp from one, two or three levels."""
    rows_ = variants.typed(
        _drifting(spark, d), "documento",
        {
            "event_id": (["$.event_id"], "bigint"),
            "valor": (["$.valor", "$.corpo.valor"], "double"),
            "data_hora": (["$.corpo.status.data", "$.corpo.data", "$.corpo"], "timestamp_ntz"),
        },
    )
    return rows_.withColumn("data_hora", F.date_format("data_hora", "yyyy-MM-dd HH:mm:ss"))


@query
def variant_drift(spark: SparkSession, d: str) -> DataFrame:
    """Types found per path against those expected."""
    expected = {"$.event_id": "BIGINT", "$.valor": "DECIMAL|DOUBLE|BIGINT", "$.corpo.data": "STRING", "$.corpo.status.data": "AUSENTE"}
    found = variants.drift(_drifting(spark, d), "documento", expected)
    # a number with decimals may be written as whole one
    numeric_ = F.when(F.col("tipo").isin("DECIMAL", "DOUBLE", "BIGINT") & (F.col("caminho") == "$.valor"), F.lit("NUMERO"))
    return found.groupBy("caminho", F.coalesce(numeric_, F.col("tipo")).alias("tipo"), "conforme").agg(
        F.sum("linhas").alias("linhas")
    )


@query
def checked_load(spark: SparkSession, d: str) -> DataFrame:
    """Lines loaded by return flag under a rule; the refunded ones break a stricter one too often to
    be published. Rows that readers see, and rows in quarantine by rule."""
    path = new_path(spark, "checked")
    lines = a.table(spark, d, "lineitem").select("l_orderkey", "l_quantity", "l_discount", "l_returnflag")
    for flag, most in (("N", 49), ("R", 25), ("A", 49)):
        checked.load(
            lines.where(F.col("l_returnflag") == flag), path,
            {"quantidade": F.col("l_quantity") < most, "desconto": F.col("l_discount") <= 0.1}, 0.2,
        )
    seen = checked.read(spark, path, lines.schema).groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("linhas"))
    bad = checked.quarantine(spark, path, lines.schema).select("l_returnflag", F.explode("_regras").alias("regra"))
    counted = bad.groupBy("l_returnflag", "regra").agg(F.count(F.lit(1)).alias("linhas"))
    return rows.union_padded(seen, counted)


@query
def coerced_rows(spark: SparkSession, d: str) -> DataFrame:
    """Text that is no number becomes NULL; source, load time and request stand beside each row."""
    events = a.table(spark, d, "events")
    raw = events.select(
        "event_id", F.when(F.col("event_id") % 3 == 0, F.lit("n/d")).otherwise(F.col("event_id").cast("string")).alias("numero")
    )
    typed = rows.stamp(rows.coerce(raw, {"numero": "bigint"}), "eventos", AS_OF)
    return readers.with_context(typed, legislatura=57)


# --- data quality -----------------------------------------------------------------------


@query
def dq_unique(spark: SparkSession, d: str) -> DataFrame:
    return quality.duplicates(a.table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dq_duplicate_rows(spark: SparkSession, d: str) -> DataFrame:
    lines = a.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return quality.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])


@query
def dq_not_null(spark: SparkSession, d: str) -> DataFrame:
    docs = a.expenses(spark, d)
    return quality.null_counts(docs, ["deputado_id", "num_ressarcimento", "url_documento", "parcela"])


@query
def dq_accepted(spark: SparkSession, d: str) -> DataFrame:
    return quality.unexpected_values(a.table(spark, d, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


@query
def dq_relationship(spark: SparkSession, d: str) -> DataFrame:
    """Documents of persons that never voted."""
    orders = a.table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return quality.orphans(orders, a.table(spark, d, "events"), {"o_custkey": "user_id"})


@query
def dq_freshness(spark: SparkSession, d: str) -> DataFrame:
    return quality.staleness(a.table(spark, d, "events"), "ts", "2024-03-01")


@query
def dq_summary(spark: SparkSession, d: str) -> DataFrame:
    lines, orders = a.table(spark, d, "lineitem"), a.table(spark, d, "orders")
    broken = quality.rule_violations(
        lines, {"quantidade_alta": F.col("l_quantity") < 40, "desconto": F.col("l_discount") <= 0.1}
    )
    return quality.summary(
        {
            "linhas_repetidas": quality.duplicates(lines, ["l_orderkey", "l_linenumber"]),
            "pedidos_unicos": quality.duplicates(orders, ["o_orderkey"]),
            "regras": broken.where(F.col("violacoes") > 0),
            "linhas_sem_pedido": quality.orphans(lines, orders, {"l_orderkey": "o_orderkey"}),
        }
    )


@query
def dates_and_formats(spark: SparkSession, d: str) -> DataFrame:
    """Date differences by boundaries, labels and currency text per line."""
    lines = a.table(spark, d, "lineitem").join(
        a.table(spark, d, "orders").select("o_orderkey", "o_orderdate"),
        F.col("l_orderkey") == F.col("o_orderkey"),
    )
    return lines.groupBy(
        dates.years_between("o_orderdate", "l_shipdate").alias("anos"),
        dates.quarter_label(F.month("l_shipdate")).alias("trimestre"),
        dates.year_month(F.year("l_shipdate"), F.month("l_shipdate")).alias("ano_mes"),
        dates.month_short(F.month("l_shipdate")).alias("mes_abrev"),
        dates.weekday_sunday_zero("l_shipdate").alias("dia_semana"),
    ).agg(
        F.sum(dates.days_between("o_orderdate", "l_shipdate")).alias("dias"),
        numeric.currency(F.sum(F.col("l_extendedprice").cast("decimal(12,2)"))).alias("valor"),
    )
