"""The same queries as plain SQL for a second engine, written from the definitions.

Numbers that are rounded go through a decimal first, as in the library, so that both engines
round the same value. Rule limits and labels come from the fixed values in ``functions.rules``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from ledgerlens import adapters as a
from ledgerlens.functions import dates, rules
from ledgerlens.functions.keys import NULL_IN_KEY
from ledgerlens.registry import AS_OF, TERMS

# --- SQL text helpers -------------------------------------------------------------------


def q(value: object) -> str:
    return "'" + str(value).replace("'", "''") + "'"


def inlist(values: Sequence[object]) -> str:
    return "(" + ", ".join(q(v) if isinstance(v, str) else str(v) for v in values) + ")"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def txt(x: str) -> str:
    return f"CAST({x} AS VARCHAR)"


def rnd(x: str, s: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(28,8)), {s}) AS DOUBLE)"


def ratio(n: str, d: str) -> str:
    return f"({dbl(n)} / nullif({dbl(d)}, 0))"


def pct(n: str, d: str, s: int = 2) -> str:
    return rnd(f"{ratio(n, d)} * 100", s)


def pct0(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN {pct(n, d)} ELSE 0.0 END"


def avg(x: str, s: int = 2) -> str:
    return rnd(ratio(f"sum({x})", f"count({x})"), s)


def case(pairs: Sequence[tuple[str, str]], default: str) -> str:
    whens = " ".join(f"WHEN {p} THEN {q(v)}" for p, v in pairs)
    return f"CASE {whens} ELSE {default} END"


def pick(c: str, table: Mapping[str, str]) -> str:
    return case([(f"{c} = {q(k)}", v) for k, v in table.items()], "NULL")


def upto(x: str, cuts: Sequence[float], labels: Sequence[str]) -> str:
    return case([(f"{x} <= {c}", v) for c, v in zip(cuts, labels)], q(labels[-1]))


def since(x: str, cuts: Sequence[float], labels: Sequence[str]) -> str:
    rows = [(f"{x} >= {c}", v) for c, v in zip(cuts, labels[1:])]
    return case(rows[::-1], q(labels[0]))


def like(x: str, patterns: Sequence[str]) -> str:
    return "(" + " OR ".join(f"{x} ILIKE {q(p)}" for p in patterns) + ")"


def has(x: str, words: Sequence[str]) -> str:
    return "(" + " OR ".join(f"contains(upper({x}), {q(w)})" for w in words) + ")"


def key(*parts: str) -> str:
    texts = ", ".join(f"coalesce({txt(p)}, {q(NULL_IN_KEY)})" for p in parts)
    return f"md5(concat_ws('-', {texts}))"


def members(groups: Mapping[str, Sequence[str]], c: str) -> list[tuple[str, str]]:
    return [(f"{c} IN {inlist(m)}", name) for name, m in groups.items()]


# --- benchmark tables as domain tables --------------------------------------------------

STATE = "([" + ", ".join(q(s) for s in a.STATE_OF_NATION) + "])"
HOUR_ID = "strftime(ts, '%Y%m%d%H')"

CTE = {
    "docs": f"""docs AS (
        SELECT o.o_custkey AS deputado_id, l.l_orderkey * 10 + l.l_linenumber AS cod_documento,
          l.*, o.o_orderdate + INTERVAL 24 YEAR AS quando,
          year(o.o_orderdate) + 24 AS ano, month(o.o_orderdate) AS mes,
          CAST(l.l_suppkey AS VARCHAR) AS cnpj,
          CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(0.05 AS DECIMAL(3,2)) AS doc,
          CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(0.05 AS DECIMAL(3,2))
            * CAST(l.l_discount AS DECIMAL(4,2)) AS cut
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "exp": f"""exp AS (
        SELECT d.*, doc - cut AS net, c.c_name AS nome, s.s_name AS fornecedor,
          {pick('c.c_mktsegment', a.PARTY_OF_SEGMENT)} AS partido,
          {STATE}[c.c_nationkey + 1] AS uf, {pick('p.p_type', a.KIND_OF_PART)} AS tipo
        FROM docs d JOIN customer c ON d.deputado_id = c.c_custkey
        JOIN supplier s ON d.l_suppkey = s.s_suppkey JOIN part p ON d.l_partkey = p.p_partkey)""",
    "log": f"""log AS (
        SELECT o_custkey AS k, o_orderdate + INTERVAL 24 YEAR AS t, o_orderkey AS msg,
          {pick('o_orderpriority', a.PARTY_OF_PRIORITY)} AS party FROM orders)""",
    "ver": """one AS (SELECT k, t, max_by(party, msg) AS party, max(msg) AS msg FROM log GROUP BY k, t),
      marked AS (SELECT *, lag(party) OVER (PARTITION BY k ORDER BY t) AS before FROM one),
      ver AS (SELECT k, t AS t0, lead(t) OVER (PARTITION BY k ORDER BY t) AS t1, party
        FROM marked WHERE before IS NULL OR before <> party)""",
    "dep": f"""dep AS (
        SELECT c_custkey AS k, {key('c_custkey', f"TIMESTAMP '{a.DEPUTIES_SINCE}'")} AS sk,
          upper(c_name) AS nome, c_name AS civil,
          {pick('c_mktsegment', a.PARTY_OF_SEGMENT)} AS partido,
          {STATE}[c_nationkey + 1] AS uf,
          CASE WHEN c_custkey % 10 = 0 THEN 'SUPLENTE' ELSE 'TITULAR' END AS condicao,
          'EXERCÍCIO' AS situacao, 50 + c_custkey % 8 AS leg FROM customer)""",
    "voto": f"""voto AS (
        SELECT id_votacao, user_id AS k, ts,
          upper(trim({pick('event_type', a.VOTE_OF_EVENT)})) AS voto
        FROM (SELECT *, {HOUR_ID} AS id_votacao, row_number() OVER (
            PARTITION BY {HOUR_ID}, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1)""",
    "vota": f"""vota AS (
        SELECT {HOUR_ID} AS id_votacao, CAST(min(ts) AS DATE) AS dia,
          date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', date_trunc('hour', min(ts))) AS prop,
          count(*) FILTER (event_type = 'view') AS sim,
          count(*) FILTER (event_type = 'click') AS nao,
          count(*) FILTER (event_type IN ('error', 'signup', 'purchase')) AS outros,
          count(*) FILTER (event_type = 'view') > count(*) FILTER (event_type = 'click') AS aprovada
        FROM events GROUP BY {HOUR_ID})""",
    "orient": f"""contagem AS (
        SELECT {HOUR_ID} AS id_votacao, dep.partido, event_type, count(*) AS n
        FROM events JOIN dep ON user_id = dep.k GROUP BY ALL),
      linha AS (SELECT id_votacao, partido, event_type FROM (
          SELECT *, row_number() OVER (PARTITION BY id_votacao, partido ORDER BY n DESC, event_type) AS rn
          FROM contagem) WHERE rn = 1),
      orient AS (SELECT id_votacao, partido,
          CASE WHEN CAST(substr(id_votacao, 9, 2) AS INT) % 6 = 0 THEN 'LIBERADO'
               WHEN CAST(substr(id_votacao, 9, 2) AS INT) % 11 = 5 THEN ''
               ELSE upper(trim({pick('event_type', a.VOTE_OF_EVENT)})) END AS linha FROM linha)""",
    "bill": f"""bill AS (
        SELECT o_orderkey AS id, {pick('o_orderpriority', a.BILL_TYPE_OF_PRIORITY)} AS tipo,
          CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE year(o_orderdate) + 24 END AS ano0,
          year(o_orderdate) + 24 AS ano1, o_orderdate + INTERVAL 24 YEAR AS quando,
          o_orderdate + INTERVAL 24 YEAR + to_days(CAST(o_orderkey % 400 AS INT)) AS status_em,
          CASE o_orderkey % 11 WHEN 0 THEN 'Pronta para Pauta' WHEN 1 THEN 'Retirado pelo Autor'
            WHEN 2 THEN 'Vetado totalmente' ELSE {pick('o_orderstatus', a.STATUS_TEXT)} END AS texto
        FROM orders)""",
    "fvoto": f"""fvoto AS (
        SELECT v.id_votacao, v.k, v.voto, v.ts, d.sk, d.nome, d.partido, d.uf, d.condicao, a.dia,
          a.aprovada, a.prop, b.tipo AS btipo, b.ano0 AS bano, b.id IS NOT NULL AS tem_prop,
          nullif(o.linha, '') AS linha,
          CASE WHEN nullif(o.linha, '') IS NULL THEN 'SEM_ORIENTACAO'
               WHEN o.linha = 'LIBERADO' THEN 'VOTO_LIVRE'
               WHEN o.linha = v.voto THEN 'SEGUIU_ORIENTACAO' ELSE 'CONTRARIOU_ORIENTACAO' END AS fid,
          v.voto IN ('SIM', 'NÃO', 'NAO') AS posicao
        FROM voto v LEFT JOIN dep d ON v.k = d.k LEFT JOIN vota a USING (id_votacao)
        LEFT JOIN orient o ON o.id_votacao = v.id_votacao AND o.partido = d.partido
        LEFT JOIN bill b ON b.id = a.prop)""",
    "autor": """autor AS (SELECT l_orderkey AS id, l_suppkey AS k, l_linenumber = 1 AS prim, s_name AS nome,
          s_nationkey AS nation FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)""",
}
_NEEDS = {
    "exp": ["docs"], "ver": ["log"], "orient": ["dep"],
    "fvoto": ["dep", "voto", "vota", "orient", "bill"],
}


def sql(names: str, body: str) -> str:
    """WITH clause over the named tables and what they need, then the query."""
    chosen: list[str] = []

    def add(name: str) -> None:
        for need in _NEEDS.get(name, []):
            add(need)
        if name not in chosen:
            chosen.append(name)

    for name in names.split():
        add(name)
    rest = body.strip()
    head = ",\n      ".join(CTE[n] for n in chosen)
    if not head:
        return rest
    if rest.startswith("WITH "):
        return f"WITH {head},\n      {rest[5:]}"
    return f"WITH {head}\n      {rest}"


SQL: dict[str, str] = {}


def oracle_queries() -> dict[str, str]:
    return dict(SQL)


# --- sources, cleaning, keys ------------------------------------------------------------

SQL["json_path_extract"] = """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS tipo
FROM events"""

SQL["json_array_flatten"] = """
SELECT CAST(l_linenumber AS BIGINT) AS deputado_id, count(*) AS linhas,
  CAST(sum(l_orderkey) AS BIGINT) AS soma_documentos,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS valor
FROM lineitem GROUP BY l_linenumber"""

SQL["align_by_name"] = """
SELECT CAST(o_custkey AS BIGINT) AS deputado_id, o_orderkey AS cod_documento,
  CAST(NULL AS BIGINT) AS parcela FROM orders"""

SQL["period_landing"] = sql("docs", """
SELECT ano, CAST(mes AS BIGINT) AS mes, count(*) FILTER (l_returnflag <> 'R') AS antes,
  count(*) FILTER (l_returnflag <> 'R' OR (ano = 2020 AND mes <= 2)) AS depois,
  count(*) FILTER (l_returnflag = 'R' AND ano = 2020 AND mes <= 2) AS diferenca FROM docs GROUP BY ano, mes""")
SQL["timestamped_landing"] = sql("docs", """
SELECT '20250101_030000' AS carga, ano, CAST(mes AS BIGINT) AS mes, count(*) AS linhas, CAST(1 AS BIGINT) AS arquivos
FROM docs WHERE l_returnflag <> 'R' GROUP BY ano, mes
UNION ALL SELECT '20250102_030000', ano, mes, count(*), 1 FROM docs GROUP BY ano, mes""")
SQL["seed_table"] = """
SELECT min(p_partkey) AS "codCategoria", p_type || '; parte' AS categoria, count(*) AS "codSubCategoria",
  CASE WHEN p_type <> 'PROMO' THEN lower(p_type) END AS "subCategoria" FROM part GROUP BY p_type"""
SQL["nested_rows_flatten"] = """
SELECT page_id, url AS pagina_url, CAST(length(html) AS BIGINT) AS pagina_corpo_tamanho, md5(html) AS pagina_corpo_resumo FROM pages"""
SQL["json_latest_merge"] = """
SELECT o_orderkey AS id, o_custkey AS pessoa, 'S' AS situacao, strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS dia,
  year(o_orderdate) AS ano FROM orders"""

SQL["rows_per_file"] = "SELECT 'lineitem' AS arquivo, count(*) AS linhas FROM lineitem"

SQL["clean_text"] = """
SELECT doc_id, md5(upper(replace(trim(text, ' '), 'ß', 'ss'))) AS texto_md5, coalesce(trim(text, ' ') <> '', FALSE) AS preenchido,
  length(trim(lang)) BETWEEN 2 AND 10 AS lang_valida,
  coalesce(contains(upper(text), 'LICENSE') OR contains(upper(text), 'EMAIL'), FALSE) AS contem,
  source ILIKE '%a%' AS fonte_a
FROM documents"""

SQL["meetings"] = f"""
WITH e AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events
  WHERE ts <= TIMESTAMP '2025-01-20 00:00:00'),
 f AS (SELECT *, CASE WHEN event_id % 5 <> 0 THEN ts + to_minutes(k) END AS fim FROM e)
SELECT DISTINCT event_id AS id_evento, upper('reunião ' || event_type) AS descricao,
  upper(event_type) AS descricao_tipo, {txt('ts')} AS data_hora_inicio, {txt('fim')} AS data_hora_fim,
  {txt('CAST(ts AS DATE)')} AS data_inicio, {txt('CAST(fim AS DATE)')} AS data_fim,
  year(ts) AS ano_inicio, month(ts) AS mes_inicio, day(ts) AS dia_inicio, hour(ts) AS hora_inicio,
  date_diff('hour', ts, fim) AS duracao_horas,
  CASE WHEN hour(ts) >= 18 THEN 'NOITE' WHEN hour(ts) >= 12 THEN 'TARDE'
       WHEN hour(ts) >= 6 THEN 'MANHÃ' ELSE 'MADRUGADA' END AS periodo_dia,
  CASE WHEN k % 3 = 0 THEN 'PLENÁRIO' END AS local_camara_nome,
  CASE WHEN k % 3 = 1 THEN 'PRAÇA' END AS local_externo,
  ['INTERNO', 'EXTERNO', 'NÃO_INFORMADO'][k % 3 + 1] AS tipo_local,
  CASE WHEN k > 50 THEN 'ENCERRADA' ELSE 'AGENDADA' END AS situacao,
  'https://e/' || event_id AS uri,
  CASE WHEN k % 2 = 0 THEN 'https://e/' || event_id END AS url_documento_pauta,
  k % 2 = 0 AS tem_documento_pauta, 'camara_eventos' AS fonte_dado
FROM f"""

_aliases = members(rules.PARTY_ALIASES, "upper('P' || partido)")
_regions = members(rules.REGIONS, "uf")
SQL["party_and_category_rules"] = sql("exp bill", f"""
SELECT {case([(has('tipo', w), k) for k, w in rules.EXPENSE_KEYWORDS], "'OUTROS'")} AS categoria,
  {case(_regions, "'Não identificado'")} AS regiao,
  {case([(f'uf IN {inlist(rules.RICH_STATES)}', 'Rico'),
         (f'uf IN {inlist(rules.POOR_STATES)}', 'Pobre')], "'Médio'")} AS classe_uf,
  {case(_aliases, "upper('P' || partido)")} AS partido, count(*) AS n
FROM exp GROUP BY ALL
UNION ALL
SELECT {case([(has('texto', w), k) for k, w in rules.STATUS_KEYWORDS], 'upper(texto)')},
  {case([(like('texto', p), k) for k, p in rules.BILL_STATUS_PATTERNS], "'OUTROS'")},
  NULL, NULL, count(*)
FROM bill GROUP BY ALL""")

SQL["guidance_rules"] = sql("orient", """
SELECT id_votacao, partido AS sigla_bancada, linha AS orientacao_padronizada,
  'PARTIDO' AS tipo_bancada, linha <> '' AS tem_orientacao, TRUE AS tem_uri_votacao,
  FALSE AS tem_uri_bancada FROM orient""")

_flagged = "CASE WHEN l_returnflag = 'R' THEN l_linestatus END"
SQL["surrogate_key"] = f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  {key('l_orderkey', 'l_linenumber', _flagged)} AS sk,
  sha256(concat_ws('|', {txt('l_partkey')}, coalesce({_flagged}, 'NULL'), {txt('l_suppkey')}))
    AS hash_auditoria
FROM lineitem"""

SQL["uri_tail_id"] = """
SELECT page_id, TRY_CAST(nullif(regexp_extract(url, '([0-9]+)$', 1), '') AS BIGINT) AS id_final,
  TRY_CAST(nullif(regexp_extract(url, '/en/([0-9]+)$', 1), '') AS BIGINT) AS id_recurso,
  TRY_CAST(nullif(regexp_extract(url, 'page=([0-9]+)', 1), '') AS BIGINT) AS pagina
FROM pages"""

SQL["expense_staging"] = sql("exp", f"""
WITH u AS (SELECT DISTINCT deputado_id, cod_documento, ano, mes, l_suppkey, l_partkey, l_linenumber,
    l_orderkey, quando, l_returnflag, l_linestatus, doc, cut, net, fornecedor, tipo FROM exp)
SELECT upper(tipo) AS tipo_despesa, upper(fornecedor) AS nome_fornecedor, ano, count(*) AS n,
  {dbl('sum(net)')} AS valor
FROM u GROUP BY ALL""")

# --- dimensions -------------------------------------------------------------------------

_terms = " UNION ALL ".join(
    f"SELECT {i} AS leg, DATE {q(lo)} AS de, DATE {q(hi)} AS ate, {y} AS eleicao" for i, lo, hi, y in TERMS
)
_months = "([" + ", ".join(q(m) for m in dates.MONTH_NAMES) + "])"
SQL["calendar_terms"] = f"""
WITH d AS (SELECT CAST(o_orderdate + INTERVAL 24 YEAR AS DATE) AS dia, count(*) AS n FROM orders GROUP BY 1),
  terms AS ({_terms}),
  cal AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS dia
    FROM (SELECT CAST(min(dia) AS TIMESTAMP) AS lo, CAST(max(dia) AS TIMESTAMP) AS hi FROM d))
SELECT {txt('cal.dia')} AS data, year(cal.dia) AS ano, month(cal.dia) AS mes, day(cal.dia) AS dia,
  quarter(cal.dia) AS trimestre, dayofweek(cal.dia) AS dia_semana,
  {_months}[month(cal.dia)] AS nome_mes,
  CAST(strftime(cal.dia, '%Y%m%d') AS BIGINT) AS sk_tempo,
  CAST(leg AS BIGINT) AS "idLegislatura", CAST(eleicao AS BIGINT) AS "anoEleicao", coalesce(n, 0) AS n
FROM cal LEFT JOIN d USING (dia) LEFT JOIN terms ON cal.dia BETWEEN de AND ate"""

SQL["mode_dimension"] = """
WITH t AS (SELECT CAST(p_size AS BIGINT) AS cod_tema, p_type AS tema, CAST(l_quantity AS BIGINT) AS rel
    FROM lineitem JOIN part ON l_partkey = p_partkey),
  c AS (SELECT cod_tema, tema, count(*) AS n, max(rel) AS m FROM t GROUP BY ALL),
  r AS (SELECT *, row_number() OVER (PARTITION BY cod_tema ORDER BY n DESC, tema) AS rn,
    max(m) OVER (PARTITION BY cod_tema) AS relevancia, sum(n) OVER (PARTITION BY cod_tema) AS total FROM c)
SELECT cod_tema, tema, relevancia, CAST(total AS BIGINT) AS total_registros_origem FROM r WHERE rn = 1"""

SQL["supplier_dimension"] = sql("exp", f"""
SELECT cnpj AS nk_fornecedor, min(fornecedor) AS nome_fornecedor, {txt('min(quando)')} AS primeiro_documento,
  {txt('max(quando)')} AS ultimo_documento, {key('cnpj')} AS sk_fornecedor
FROM exp GROUP BY cnpj""")

SQL["expense_type_dimension"] = sql("exp", f"""
SELECT tipo AS tipo_despesa, {key('tipo')} AS sk_tipo_despesa FROM exp GROUP BY tipo""")

SQL["person_ranking"] = sql("exp", f"""
WITH t AS (SELECT ano, deputado_id, nome AS nome_deputado, partido AS sigla_partido, uf AS sigla_uf,
    sum(net) AS s, count(*) AS qtd_despesas FROM exp GROUP BY ALL)
SELECT ano, deputado_id, nome_deputado, sigla_partido, sigla_uf, {dbl('s')} AS total_gasto, qtd_despesas,
  row_number() OVER (PARTITION BY ano ORDER BY s DESC, deputado_id) AS ranking_gasto_ano,
  row_number() OVER (PARTITION BY ano, sigla_uf ORDER BY s DESC, deputado_id) AS ranking_gasto_uf
FROM t""")

SQL["party_ranking"] = sql("exp", f"""
WITH t AS (SELECT ano, partido AS sigla_partido, sum(net) AS s, count(DISTINCT deputado_id) AS qtd_deputados
    FROM exp GROUP BY ALL)
SELECT ano, sigla_partido, {dbl('s')} AS total_gasto_partido, qtd_deputados,
  row_number() OVER (PARTITION BY ano ORDER BY s DESC, sigla_partido) AS ranking_partido_ano FROM t""")

# --- history and joins ------------------------------------------------------------------

SQL["latest_wins_dedup"] = f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  {txt('l_shipdate')} AS l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem) WHERE rn = 1"""

_history = f"""
SELECT {key('k', 't0')} AS scd_id, k AS deputado_id, party AS sigla_partido, {txt('t0')} AS valid_from,
  {txt('t1')} AS valid_to, t1 IS NULL AS is_current FROM ver"""
SQL["scd2_history"] = sql("ver", _history)
SQL["scd2_incremental"] = sql("ver", _history)

SQL["asof_version_join"] = sql("ver", f"""
WITH f AS (SELECT l.*, o_custkey AS k, l_shipdate + INTERVAL 24 YEAR - INTERVAL 200 DAY AS quando
    FROM lineitem l JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  f.k AS deputado_id, {txt('quando')} AS quando, party AS sigla_partido, {txt('t0')} AS valid_from
FROM f LEFT JOIN ver ON f.k = ver.k AND quando >= t0 AND (t1 IS NULL OR quando < t1)""")

SQL["safe_anti"] = """
SELECT c_custkey AS k, c_name FROM customer WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')"""

SQL["union_null_pad"] = """
SELECT o_custkey AS chave, count(*) AS pedidos, CAST(NULL AS VARCHAR) AS nome FROM orders GROUP BY o_custkey
UNION ALL SELECT c_custkey, NULL, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)"""

CTE["pessoa"] = f"""pessoa AS (SELECT c_custkey AS k, CASE WHEN c_acctbal >= 0 THEN lpad(CAST(c_custkey AS VARCHAR), 11, '0') END AS cpf,
          upper(c_name) AS civil, DATE '1950-01-01' + CAST(c_custkey % 15000 AS INT) AS nasc,
          {STATE}[c_nationkey + 1] AS uf_nasc, CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' END AS sexo,
          DATE '2019-01-01' + CAST(c_custkey % 2400 AS INT) AS em, 'PESSOA ' || c_custkey AS nome, 'URNA ' || c_custkey AS urna,
          CASE WHEN c_custkey % 13 <> 0 THEN {pick('c_mktsegment', a.PARTY_OF_SEGMENT)} END AS partido,
          CASE WHEN c_custkey % 17 <> 0 THEN {STATE}[c_custkey % 25 + 1] END AS uf,
          CASE WHEN c_custkey % 19 <> 0 THEN 50 + c_custkey % 8 END AS leg,
          CASE WHEN c_custkey % 10 = 0 THEN 'SUPLENTE' ELSE 'TITULAR' END AS condicao,
          CASE WHEN c_custkey % 7 <> 0 THEN 'EXERCÍCIO' END AS situacao,
          CASE WHEN c_custkey % 4 <> 0 THEN 'https://f/' || c_custkey END AS foto,
          CASE WHEN c_custkey % 5 <> 0 THEN c_custkey || '@camara' END AS email, '61 ' || c_custkey AS fone,
          'SALA ' || c_custkey AS sala, 'https://d/' || c_custkey AS uri FROM customer)"""
CTE["hist"] = f"""hist AS (SELECT o_orderkey AS id, o_custkey AS k, 'PESSOA ' || o_custkey AS nome, 'URNA ' || o_custkey AS urna,
          {pick('o_orderpriority', a.PARTY_OF_PRIORITY)} AS partido, {STATE}[o_custkey % 25 + 1] AS uf, 50 + o_custkey % 8 AS leg,
          CASE WHEN o_orderstatus = 'P' THEN 'LICENÇA' ELSE 'EXERCÍCIO' END AS situacao,
          CASE WHEN o_custkey % 10 = 0 THEN 'SUPLENTE' ELSE 'TITULAR' END AS condicao,
          o_orderdate + INTERVAL 24 YEAR AS t, 'https://d/' || o_custkey AS uri,
          CASE WHEN o_orderkey % 3 <> 0 THEN 'https://f' END AS foto
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) AS rn FROM orders)
        WHERE rn = 1)"""
CTE["linha_do_tempo"] = """linha_do_tempo AS (SELECT k, nome, urna, partido, uf, leg, condicao, situacao, foto, uri, 'historico' AS fonte, t FROM hist
        UNION ALL SELECT k, nome, urna, coalesce(partido, 'SEM PARTIDO'), coalesce(uf, uf_nasc, 'N/A'), coalesce(leg, 0),
          coalesce(condicao, 'N/A'), coalesce(situacao, 'N/A'), foto, uri, 'detalhes', CAST(em AS TIMESTAMP) FROM pessoa)"""
_NEEDS["linha_do_tempo"] = ["pessoa", "hist"]

SQL["status_history"] = sql("hist", f"""
SELECT id, k AS deputado_id, urna AS nome_eleitoral, partido AS sigla_partido, uf AS sigla_uf, leg AS id_legislatura,
  situacao, condicao AS condicao_eleitoral, 'ALTERAÇÃO' AS descricao_status, {txt('t')} AS data_inicio_vigencia, uri,
  'https://p' AS uri_partido, foto AS url_foto, nome AS nome_deputado FROM hist""")
_none = ", ".join(
    f"CAST(NULL AS VARCHAR) AS {c}" for c in
    ("municipio_nascimento", "uf_nascimento", "sexo", "redes_sociais", "ultimo_status_email_gabinete",
     "ultimo_status_telefone_gabinete", "ultimo_status_nome_gabinete", "data_nascimento", "cpf")
)
SQL["persons_from_two_sources"] = sql("pessoa hist", f"""
SELECT k AS deputado_id, civil AS nome_civil, {txt('em')} AS ultimo_status_data, nome AS ultimo_status_nome,
  urna AS ultimo_status_nome_eleitoral, partido AS ultimo_status_sigla_partido, uf AS ultimo_status_sigla_uf,
  leg AS ultimo_status_id_legislatura, condicao AS ultimo_status_condicao_eleitoral,
  situacao AS ultimo_status_situacao, foto AS ultimo_status_url_foto, uri, 'camara_deputados_detalhes' AS fonte_dado,
  'BELÉM' AS municipio_nascimento, uf_nasc AS uf_nascimento, sexo, CAST(NULL AS VARCHAR) AS redes_sociais,
  email AS ultimo_status_email_gabinete, fone AS ultimo_status_telefone_gabinete, sala AS ultimo_status_nome_gabinete,
  {txt('nasc')} AS data_nascimento, cpf FROM pessoa WHERE cpf IS NOT NULL
UNION ALL SELECT DISTINCT k, nome, {txt('CAST(t AS DATE)')}, nome, urna, partido, uf, leg, condicao, situacao, foto, uri,
  'camara_deputado_historico', {_none} FROM hist WHERE k NOT IN (SELECT k FROM pessoa WHERE cpf IS NOT NULL)""")
CTE["v"] = """um AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k, t ORDER BY fonte, partido) AS rn FROM linha_do_tempo)
    WHERE rn = 1),
 igual AS (SELECT *, row(nome, urna, partido, uf, leg, condicao, situacao) AS estado FROM um),
 antes AS (SELECT *, lag(estado) OVER (PARTITION BY k ORDER BY t) AS anterior FROM igual),
 v AS (SELECT *, lead(t) OVER (PARTITION BY k ORDER BY t) AS t1 FROM antes WHERE anterior IS NULL OR anterior <> estado)"""
_NEEDS["v"] = ["linha_do_tempo"]
SQL["person_dimension"] = sql("v", f"""
SELECT {key('v.k', 'v.t')} AS scd_id, v.k AS nk_deputado, v.nome AS nome_deputado, v.urna AS nome_eleitoral,
  v.partido AS sigla_partido, v.uf AS sigla_uf, v.leg AS id_legislatura, v.condicao AS condicao_eleitoral,
  v.situacao AS situacao, v.foto AS url_foto, v.uri AS uri, fonte AS fonte_origem, {txt('v.t')} AS valid_from,
  {txt('t1')} AS valid_to, t1 IS NULL AS is_current, cpf, coalesce(civil, v.nome) AS nome_civil,
  {txt('nasc')} AS data_nascimento, 'BELÉM' AS municipio_nascimento, uf_nasc AS uf_nascimento, sexo,
  CAST(NULL AS VARCHAR) AS redes_sociais, email AS email_gabinete, fone AS telefone_gabinete, sala AS nome_gabinete,
  year(DATE {q(AS_OF)}) - year(nasc) AS idade_atual,
  CASE sexo WHEN 'M' THEN 'MASCULINO' WHEN 'F' THEN 'FEMININO' ELSE 'NÃO INFORMADO' END AS sexo_descricao,
  {key(key('v.k', 'v.t'))} AS sk_deputado, v.situacao LIKE '%EXERC%' AS em_exercicio, v.condicao = 'TITULAR' AS eh_titular,
  v.foto IS NOT NULL AS tem_foto, email IS NOT NULL AS tem_email_gabinete
FROM v LEFT JOIN pessoa p ON p.k = v.k""")
SQL["current_persons"] = sql("linha_do_tempo", f"""
SELECT l.k AS deputado_id, l.nome AS nome_deputado, l.urna AS nome_eleitoral, l.partido AS sigla_partido, l.uf AS sigla_uf,
  l.leg AS id_legislatura, l.condicao AS condicao_eleitoral, l.situacao, l.foto AS url_foto, l.uri, fonte AS fonte_origem,
  {txt('t')} AS data_atualizacao
FROM linha_do_tempo l JOIN pessoa p ON p.k = l.k
WHERE (fonte = 'detalhes' AND cpf IS NOT NULL) OR (fonte = 'historico' AND cpf IS NULL
  AND t = (SELECT max(h.t) FROM hist h WHERE h.k = l.k))""")

SQL["status_listing"] = sql("ver dep", f"""
SELECT nk_deputado, ano, situacao, id_legislatura, sigla_partido, {txt('t0')} AS valid_from FROM (
  SELECT ver.k AS nk_deputado, year(t0) AS ano, situacao, leg AS id_legislatura, party AS sigla_partido, t0,
    row_number() OVER (PARTITION BY ver.k, year(t0) ORDER BY t0 DESC) AS rn
  FROM ver LEFT JOIN dep ON ver.k = dep.k) WHERE rn = 1""")

# --- facts ------------------------------------------------------------------------------

_quarter = "'T' || CAST((mes + 2) // 3 AS VARCHAR)"
_status = "CASE WHEN net > doc THEN 'INCONSISTENTE' WHEN cut > doc THEN 'GLOSA_ALTA' " \
    "WHEN cut = 0 THEN 'SEM_GLOSA' ELSE 'NORMAL' END"
SQL["expense_fact_derived"] = sql("exp", f"""
SELECT {key('deputado_id', 'cod_documento', 'ano', 'mes')} AS sk_despesa, deputado_id AS nk_deputado,
  cod_documento, l_partkey AS cod_lote, cnpj AS cnpj_cpf_fornecedor, strftime(quando, '%Y-%m') AS ano_mes,
  {_quarter} AS trimestre, {dbl('doc')} AS valor_documento, {dbl('net')} AS valor_liquido,
  {dbl('cut')} AS valor_glosa, {pct0('cut', 'doc')} AS percentual_glosa, {_status} AS status_financeiro,
  {upto('net', rules.VALUE_CUTS, rules.VALUE_LABELS)} AS faixa_valor,
  l_returnflag = 'R' AS tem_documento, l_returnflag = 'R' AS tem_ressarcimento, ano, CAST(mes AS BIGINT) AS mes,
  CAST(l_linenumber % 3 AS BIGINT) AS cod_tipo_documento, {txt('quando')} AS data_documento,
  l_orderkey || '/' || l_linenumber AS num_documento,
  CASE WHEN l_returnflag = 'R' THEN CAST(l_orderkey AS VARCHAR) END AS num_ressarcimento,
  CAST(l_linenumber AS BIGINT) AS parcela, l_linestatus AS tipo_documento,
  CASE l_returnflag WHEN 'N' THEN ' ' WHEN 'R' THEN 'https://doc/' || l_orderkey END AS url_documento
FROM exp""")

_parties = lambda cond: f"string_agg(DISTINCT partido, ', ' ORDER BY partido) FILTER ({cond})"
SQL["vote_tally"] = sql("dep voto vota bill", f"""
WITH t AS (SELECT id_votacao, count(*) AS n, count(*) FILTER (voto = 'SIM') AS s,
    count(*) FILTER (voto IN ('NÃO', 'NAO')) AS no, count(*) FILTER (voto = 'ABSTENÇÃO') AS ab,
    count(*) FILTER (voto = 'OBSTRUÇÃO') AS ob, count(*) FILTER (voto = 'ARTIGO 17') AS art,
    {_parties("voto = 'SIM'")} AS pro, {_parties("voto IN ('NÃO', 'NAO')")} AS contra
  FROM voto LEFT JOIN dep USING (k) GROUP BY id_votacao),
 v AS (SELECT *, sim + nao + outros AS total FROM vota)
SELECT {key('v.id_votacao')} AS sk_votacao, v.id_votacao AS nk_votacao, prop AS nk_proposicao,
  {txt('dia')} AS data_votacao, upper('Votação ' || v.id_votacao) AS descricao_votacao, aprovada,
  prop AS id_evento, CAST(180 AS BIGINT) AS id_orgao, 'PLEN' AS sigla_orgao,
  'https://v/' || v.id_votacao AS uri_votacao, sim AS votos_sim, nao AS votos_nao, outros AS votos_outros,
  total AS total_votos_oficiais, coalesce(n, 0) AS total_votos_registrados,
  coalesce(s, 0) AS votos_sim_detalhados, coalesce(no, 0) AS votos_nao_detalhados,
  coalesce(ab, 0) AS votos_abstencao, coalesce(ob, 0) AS votos_obstrucao,
  coalesce(art, 0) AS votos_artigo17, CAST(0 AS BIGINT) AS votos_outros_detalhados,
  tipo AS proposicao_sigla_tipo, b.id AS proposicao_numero, ano0 AS ano_proposicao,
  'Tipo ' || tipo AS proposicao_descricao_tipo, {txt('quando')} AS proposicao_data_apresentacao,
  texto AS proposicao_situacao_atual, CASE WHEN b.id IS NOT NULL THEN 'Plenário' END AS proposicao_apreciacao,
  coalesce('Ementa ' || b.id, 'matéria') AS proposicao_ementa,
  pro AS partidos_favoraveis, contra AS partidos_contrarios,
  {pct('sim', 'total')} AS percentual_aprovacao,
  CASE WHEN nao + outros > 0 THEN {pct('nao', 'total')} ELSE 0.0 END AS percentual_rejeicao,
  CASE WHEN aprovada THEN 'APROVADA' ELSE 'REJEITADA' END AS resultado_votacao,
  CASE WHEN sim * 100 > total * 66 THEN 'MAIORIA_QUALIFICADA' WHEN sim > nao + outros THEN 'MAIORIA_SIMPLES'
    WHEN sim = nao THEN 'EMPATE' ELSE 'MAIORIA_CONTRA' END AS tipo_maioria,
  year(dia) AS ano, month(dia) AS mes, 'T' || quarter(dia) AS trimestre,
  b.id IS NOT NULL AS tem_proposicao_vinculada, coalesce(n, 0) > 0 AS tem_votos_detalhados,
  coalesce(ob, 0) > 0 AS teve_obstrucao, coalesce(n, 0) >= 300 AS eh_votacao_expressiva,
  CAST(NULL AS VARCHAR) AS uri_evento, CAST(NULL AS VARCHAR) AS uri_orgao, CAST(NULL AS VARCHAR) AS proposicao_ementa_detalhada
FROM v LEFT JOIN t USING (id_votacao) LEFT JOIN bill b ON b.id = prop""")

SQL["vote_adherence"] = sql("fvoto", f"""
SELECT {key('id_votacao', 'k')} AS sk_voto_individual, id_votacao AS nk_votacao, k AS nk_deputado,
  prop AS nk_proposicao, partido AS sigla_partido, voto AS tipo_voto, linha AS orientacao_partido,
  fid AS fidelidade_partidaria,
  CAST(CASE voto WHEN 'SIM' THEN 1 WHEN 'NÃO' THEN -1 ELSE 0 END AS BIGINT) AS peso_voto_numerico,
  CASE WHEN posicao THEN 'POSICIONAMENTO' WHEN voto = 'ABSTENÇÃO' THEN 'ABSTENCAO'
    WHEN voto = 'OBSTRUÇÃO' THEN 'OBSTRUCAO' ELSE 'OUTROS' END AS categoria_voto,
  year(dia) AS ano_votacao, month(dia) AS mes_votacao, 'T' || quarter(dia) AS trimestre_votacao,
  aprovada AS flag_votacao_aprovada, linha IS NOT NULL AS flag_tem_orientacao_partido,
  tem_prop AS flag_tem_proposicao_vinculada, sk AS sk_deputado, nome AS nome_deputado, uf AS sigla_uf,
  condicao AS condicao_eleitoral, {txt('ts')} AS data_registro_voto, {txt('dia')} AS data_votacao,
  upper('Votação ' || id_votacao) AS descricao_votacao, CAST(aprovada AS BIGINT) AS votacao_aprovada,
  CAST(180 AS BIGINT) AS id_orgao, 'PLEN' AS sigla_orgao, btipo AS sigla_tipo_proposicao,
  CASE WHEN tem_prop THEN prop END AS numero_proposicao, bano AS ano_proposicao,
  CASE WHEN tem_prop THEN 'Ementa ' || prop END AS ementa
FROM fvoto""")

_bill_status = case([(like('texto', p), k) for k, p in rules.BILL_STATUS_PATTERNS], "'OUTROS'")
_signed = f"""au AS (SELECT id, count(*) AS n, count(*) FILTER (prim) AS np, min(k) FILTER (prim) AS pk,
    arg_min(nome, k) FILTER (prim) AS pn, arg_min({STATE}[nation + 1], k) FILTER (prim) AS pu FROM autor GROUP BY id)"""
SQL["bill_fact"] = sql("bill autor vota", f"""
WITH {_signed},
  te AS (SELECT l_orderkey AS id, count(*) AS n, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) AS lista
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1),
  vo AS (SELECT prop, count(*) AS n, count(*) FILTER (aprovada) AS ok, count(*) FILTER (NOT aprovada) AS no,
    max(dia) AS dia, sum(sim) AS s, sum(nao) AS c, sum(outros) AS x FROM vota GROUP BY prop)
SELECT {key('b.id')} AS sk_proposicao, b.id AS nk_proposicao, tipo AS sigla_tipo, b.id AS numero, ano1 AS ano,
  'Tipo ' || tipo AS descricao_tipo, 'Ementa ' || b.id AS ementa, {txt('quando')} AS data_apresentacao,
  {txt('status_em')} AS ultimo_status_data_hora, texto AS ultimo_status_descricao_situacao,
  pk AS nk_deputado, coalesce(au.n, 0) AS total_autores, coalesce(np, 0) AS total_proponentes,
  pk AS deputado_proponente_id, pn AS nome_proponente, pu AS uf_proponente,
  coalesce(te.n, 0) AS total_temas, lista AS temas_proposicao, coalesce(vo.n, 0) AS total_votacoes,
  coalesce(ok, 0) AS votacoes_aprovadas, coalesce(no, 0) AS votacoes_rejeitadas,
  {txt('dia')} AS data_ultima_votacao, {big('s')} AS total_votos_sim_historico,
  {big('c')} AS total_votos_nao_historico, {big('x')} AS total_votos_outros_historico,
  {_bill_status} AS situacao_proposicao,
  CASE WHEN vo.n > 0 THEN 'COM_VOTACAO' ELSE 'SEM_VOTACAO' END AS status_votacao,
  b.id % 400 AS dias_tramitacao, ano1 AS ano_apresentacao, month(quando) AS mes_apresentacao,
  pk IS NOT NULL AS tem_deputado_proponente, coalesce(te.n, 0) > 0 AS tem_temas_classificados,
  coalesce(vo.n, 0) > 0 AS foi_votada, CAST(NULL AS VARCHAR) AS partido_proponente
FROM bill b LEFT JOIN au ON au.id = b.id LEFT JOIN te ON te.id = b.id LEFT JOIN vo ON vo.prop = b.id""")

SQL["bill_fact_per_author"] = (
    SQL["bill_fact"]
    .replace(key("b.id"), key("b.id", "au.k"))
    .replace("pk AS nk_deputado", "au.k AS nk_deputado")
    .replace("au AS (SELECT id, count(*)", "au AS (SELECT id, k, count(*)")
    .replace("FROM autor GROUP BY id)", "FROM autor GROUP BY id, k)")
)

# --- marts ------------------------------------------------------------------------------

_quota = f"CAST({rules.MONTHLY_QUOTA} AS DOUBLE) * CAST(meses AS DOUBLE)"


def _spend(join: str) -> str:
    bands = ", ".join(
        f"round(coalesce(sum(doc) FILTER (faixa = {q(b)}), 0), 2) AS v_{b.lower()}" for b in rules.VALUE_LABELS
    )
    return f"""
 f AS (SELECT *, {upto('net', rules.VALUE_CUTS, rules.VALUE_LABELS)} AS faixa FROM exp WHERE doc > 0),
 g AS (SELECT f.deputado_id, ver.t0, ver.party, count(DISTINCT cod_documento) AS documentos,
    count(DISTINCT ano * 12 + mes) AS meses, sum(doc) AS d, sum(net) AS n, sum(cut) AS c,
    {avg('doc')} AS md, {avg('net')} AS mn, {bands}, min(quando) AS primeira, max(quando) AS ultima
  FROM f {join} ver ON f.deputado_id = ver.k AND quando >= t0 AND (t1 IS NULL OR quando < t1)
  GROUP BY f.deputado_id, ver.t0, ver.party),
 h AS (SELECT *, {pct('c', 'd')} AS glosa, {pct('n', _quota)} AS uso,
    CASE WHEN t0 IS NULL THEN 'DEPUTADO_NAO_ENCONTRADO_' || deputado_id ELSE {key('deputado_id', 't0')} END AS sk
  FROM g)"""


_spending = f"""
WITH {_spend('LEFT JOIN')}
SELECT h.sk AS sk_deputado, deputado_id,
  CASE WHEN t0 IS NULL THEN 'Deputado ID: ' || deputado_id ELSE dep.nome END AS nome_deputado,
  CASE WHEN t0 IS NULL THEN 'N/A' ELSE civil END AS nome_civil, coalesce(party, 'N/A') AS sigla_partido,
  CASE WHEN t0 IS NULL THEN 'N/A' ELSE uf END AS sigla_uf,
  CASE WHEN t0 IS NULL THEN 'N/A' ELSE condicao END AS condicao_eleitoral,
  CASE WHEN t0 IS NULL THEN 'N/A' ELSE dep.situacao END AS situacao,
  documentos AS total_documentos, meses AS total_meses_atividade, {dbl('d')} AS valor_total_gasto,
  {dbl('n')} AS valor_total_liquido, {dbl('c')} AS valor_total_glosa, md AS valor_medio_mensal,
  mn AS valor_liquido_medio_mensal, glosa AS percentual_glosa, {dbl('v_alto')} AS gastos_valor_alto,
  {dbl('v_medio')} AS gastos_valor_medio, {dbl('v_baixo')} AS gastos_valor_baixo,
  {dbl('v_muito_alto')} AS gastos_valor_muito_alto, {txt('primeira')} AS primeira_despesa,
  {txt('ultima')} AS ultima_despesa, uso AS percentual_uso_cota_mensal, {key('h.sk')} AS sk_gastos_deputado,
  {since('uso', rules.QUOTA_CUTS, rules.QUOTA_LABELS)} AS classificacao_uso_cota,
  coalesce(glosa < 5, FALSE) AS flag_baixa_glosa, coalesce(uso < 80, FALSE) AS flag_uso_eficiente
FROM h LEFT JOIN dep ON h.deputado_id = dep.k"""
SQL["spend_by_entity_quota"] = sql("exp ver dep", _spending)

CTE["versoes"] = """ver AS (SELECT k, t AS t0, t1, partido AS party FROM v),
      dep AS (SELECT v.k, t AS t0, v.nome, coalesce(civil, v.nome) AS civil, v.uf, v.condicao, v.situacao
        FROM v LEFT JOIN pessoa ON pessoa.k = v.k)"""
_NEEDS["versoes"] = ["v"]
SQL["spend_on_person_pipeline"] = sql(
    "exp versoes",
    _spending.replace(key("deputado_id", "t0"), key(key("deputado_id", "t0")))
    .replace("h.deputado_id = dep.k", "h.deputado_id = dep.k AND h.t0 = dep.t0")
    .replace("t0 IS NULL", "h.t0 IS NULL").replace("CASE WHEN h.t0 IS NULL THEN 'DEPUTADO_NAO", "CASE WHEN t0 IS NULL THEN 'DEPUTADO_NAO"),
)

SQL["spend_vs_state_segment_avg"] = sql("exp ver dep", f"""
WITH p AS ({_spending.replace("LEFT JOIN ver", "JOIN ver")}),
 u AS (SELECT sigla_uf, {avg('CAST(valor_total_liquido AS DECIMAL(28,6))')} AS media_gastos_uf,
    {avg('CAST(percentual_uso_cota_mensal AS DECIMAL(18,4))')} AS media_uso_cota_uf FROM p GROUP BY sigla_uf),
 t AS (SELECT sigla_partido, {avg('CAST(valor_total_liquido AS DECIMAL(28,6))')} AS media_gastos_partido,
    {avg('CAST(percentual_uso_cota_mensal AS DECIMAL(18,4))')} AS media_uso_cota_partido FROM p GROUP BY sigla_partido)
SELECT p.*, media_gastos_uf, media_uso_cota_uf, media_gastos_partido, media_uso_cota_partido,
  CASE WHEN valor_total_liquido > media_gastos_uf THEN 'Acima da Média UF' ELSE 'Abaixo da Média UF' END AS comparacao_uf,
  CASE WHEN valor_total_liquido > media_gastos_partido THEN 'Acima da Média Partido' ELSE 'Abaixo da Média Partido' END
    AS comparacao_partido
FROM p JOIN u USING (sigla_uf) JOIN t USING (sigla_partido)""")

_won = "tipo IS NOT NULL"
_kinds = {
    "projetos_lei": "PL", "propostas_emenda_constitucional": "PEC",
    "projetos_decreto_legislativo": "PDC", "projetos_lei_complementar": "PLP", "requerimentos": "REQ",
}
_prod_ctes = f"""{_signed},
 vo AS (SELECT prop, count(*) AS nv FROM vota GROUP BY prop),
 j AS (SELECT x.k, x.prim, b.tipo, b.quando, b.id % 400 AS dias, coalesce(vo.nv, 0) AS nv, au.n AS na,
    {_bill_status} AS st
  FROM autor x JOIN bill b ON x.id = b.id JOIN au ON au.id = b.id LEFT JOIN vo ON vo.prop = b.id),
 pr AS (SELECT k, count(*) FILTER (prim) AS total,
    count(*) FILTER (prim AND st IN ('TRANSFORMADA_EM_LEI', 'APROVADA')) AS ok,
    count(*) FILTER (prim AND st = 'REJEITADA') AS rej, count(*) FILTER (prim AND st = 'EM_TRAMITACAO') AS tram,
    count(*) FILTER (prim AND st = 'ARQUIVADA') AS arq,
    {", ".join(f"count(*) FILTER (prim AND tipo = {q(c)}) AS {n}" for n, c in _kinds.items())},
    count(*) FILTER (prim AND nv > 0) AS votadas, {avg('CASE WHEN prim THEN nv END')} AS mv,
    {big('coalesce(sum(nv) FILTER (prim), 0)')} AS tv, {avg('CASE WHEN prim THEN dias END')} AS md,
    min(quando) FILTER (prim) AS p0, max(quando) FILTER (prim) AS p1,
    {", ".join(f"count(*) FILTER (prim AND year(quando) = {y}) AS proposicoes_{y}" for y in (2023, 2022, 2021))},
    count(*) AS part, {avg('na')} AS mc FROM j GROUP BY k),
 pp AS (SELECT pr.*, dep.* EXCLUDE (k), CASE WHEN total > 0 THEN {ratio('ok', 'total')} END AS suc,
    CAST(coalesce(CASE WHEN total > 0 THEN {ratio('ok', 'total')} * 100 END, 0) AS DECIMAL(18,8)) AS s8,
    {pct0('ok', 'total')} AS taxa_ok
  FROM pr JOIN dep USING (k))"""
SQL["productivity"] = sql("dep bill autor vota", f"""
WITH {_prod_ctes},
 pu AS (SELECT uf, {avg('total')} AS mu, {avg('s8')} AS su FROM pp GROUP BY uf),
 pt AS (SELECT partido, {avg('total')} AS mp, {avg('s8')} AS sp FROM pp GROUP BY partido)
SELECT k AS deputado_id, sk AS sk_deputado, nome AS nome_deputado, civil AS nome_civil,
  pp.partido AS sigla_partido, pp.uf AS sigla_uf, condicao AS condicao_eleitoral, situacao,
  total AS total_proposicoes, ok AS proposicoes_aprovadas, rej AS proposicoes_rejeitadas,
  tram AS proposicoes_em_tramitacao, arq AS proposicoes_arquivadas, {", ".join(_kinds)},
  votadas AS proposicoes_votadas, mv AS media_votacoes_por_proposicao, tv AS total_votacoes_proposicoes,
  md AS tempo_medio_tramitacao_dias, {txt('p0')} AS primeira_proposicao, {txt('p1')} AS ultima_proposicao,
  proposicoes_2023, proposicoes_2022, proposicoes_2021, part AS total_participacoes_proposicoes,
  mc AS media_coautores, taxa_ok AS taxa_aprovacao_percentual, {pct0('rej', 'total')} AS taxa_rejeicao_percentual,
  mu AS media_proposicoes_uf, su AS taxa_aprovacao_media_uf, mp AS media_proposicoes_partido,
  sp AS taxa_aprovacao_media_partido, {key('sk')} AS sk_produtividade_deputado,
  {since('total', rules.PRODUCTIVITY_CUTS, rules.PRODUCTIVITY_LABELS)} AS classificacao_produtividade,
  {since('suc', rules.EFFECTIVENESS_CUTS, rules.EFFECTIVENESS_LABELS)} AS classificacao_efetividade,
  CASE WHEN projetos_lei >= {dbl('total')} * 0.5 THEN 'Especialista em Projetos de Lei'
    WHEN propostas_emenda_constitucional >= {dbl('total')} * CAST(0.3 AS DOUBLE) THEN 'Especialista em PECs'
    WHEN requerimentos >= {dbl('total')} * 0.5 THEN 'Especialista em Requerimentos'
    ELSE 'Generalista' END AS perfil_especializacao,
  total > mu AS flag_acima_media_uf, total > mp AS flag_acima_media_partido,
  coalesce(suc > 0.2, FALSE) AS flag_alta_efetividade, mc > 2 AS flag_colaborativo
FROM pp JOIN pu ON pu.uf = pp.uf JOIN pt ON pt.partido = pp.partido""")

_vote_counts = """count(*) AS n, count(DISTINCT id_votacao) AS calls,
    count(*) FILTER (voto = 'SIM') AS s, count(*) FILTER (voto = 'NÃO') AS nn,
    count(*) FILTER (voto = 'ABSTENÇÃO') AS ab, count(*) FILTER (voto = 'OBSTRUÇÃO') AS ob,
    count(*) FILTER (fid = 'SEGUIU_ORIENTACAO') AS fiel, count(*) FILTER (fid = 'CONTRARIOU_ORIENTACAO') AS reb,
    count(*) FILTER (fid = 'SEM_ORIENTACAO') AS sem, count(*) FILTER (fid = 'VOTO_LIVRE') AS livre,
    count(linha) AS orientados, count(*) FILTER (year(dia) = 2023) AS votos_2023,
    count(*) FILTER (year(dia) = 2022) AS votos_2022, count(*) FILTER (year(dia) = 2021) AS votos_2021,
    count(*) FILTER (btipo = 'PL') AS pl, count(*) FILTER (btipo = 'PEC') AS pec,
    count(*) FILTER (btipo = 'MPV') AS mpv, count(*) FILTER (posicao) AS pos,
    count(*) FILTER ((aprovada AND voto = 'SIM') OR (NOT aprovada AND voto = 'NÃO')) AS venc"""
_pres_ctes = f"""pe AS (SELECT sk, k, nome, partido, uf, condicao, {_vote_counts}, min(dia) AS d0, max(dia) AS d1
  FROM fvoto GROUP BY sk, k, nome, partido, uf, condicao),
 pf AS (SELECT *, (SELECT count(*) FROM vota) AS realizadas,
    CASE WHEN orientados > 0 THEN {ratio('fiel', 'orientados')} END AS leal,
    CAST(coalesce(CASE WHEN orientados > 0 THEN {ratio('fiel', 'orientados')} * 100 END, 0) AS DECIMAL(18,8)) AS l8,
    {pct('calls', '(SELECT count(*) FROM vota)')} AS pres, {pct0('fiel', 'orientados')} AS taxa_fiel,
    {pct0('reb', 'orientados')} AS taxa_reb FROM pe)"""
_presence = f"""
WITH {_pres_ctes},
 xu AS (SELECT uf, {avg('l8')} AS mu FROM pf GROUP BY uf),
 xp AS (SELECT partido, {avg('l8')} AS mp FROM pf GROUP BY partido)
SELECT sk AS sk_deputado, k AS deputado_id, nome AS nome_deputado, pf.partido AS sigla_partido,
  pf.uf AS sigla_uf, condicao AS condicao_eleitoral, calls AS total_votacoes_participadas,
  n AS total_votos_registrados, s AS votos_sim, nn AS votos_nao, ab AS votos_abstencao,
  ob AS votos_obstrucao, fiel AS votos_seguiu_orientacao, reb AS votos_contrariou_orientacao,
  sem AS votos_sem_orientacao, livre AS votos_livres, orientados AS votos_com_orientacao_disponivel,
  votos_2023, votos_2022, votos_2021, pl AS votos_projetos_lei, pec AS votos_pec,
  mpv AS votos_medida_provisoria, pos AS votos_com_posicionamento, venc AS total_votos_lado_vencedor,
  {txt('d0')} AS primeira_votacao, {txt('d1')} AS ultima_votacao, realizadas AS votacoes_realizadas,
  pres AS taxa_presenca_percentual, {pct0('s', 'n')} AS percentual_votos_sim,
  {pct0('nn', 'n')} AS percentual_votos_nao, taxa_fiel AS taxa_fidelidade_partidaria,
  taxa_reb AS taxa_rebeldia_partidaria, {pct0('venc', 'pos')} AS taxa_efetividade_politica,
  mu AS taxa_fidelidade_media_uf, mp AS taxa_fidelidade_media_partido, {key('sk')} AS sk_presenca_deputado,
  {since('leal', rules.SHARE_CUTS, rules.LOYALTY_LABELS)} AS classificacao_fidelidade,
  {since('n', rules.ACTIVITY_CUTS, rules.ACTIVITY_LABELS)} AS classificacao_participacao,
  CASE WHEN {ratio('ab', 'n')} > 0.3 THEN 'Alto Abstencionista'
    WHEN {ratio('ob', 'n')} > 0.2 THEN 'Alto Obstrucionista'
    WHEN {ratio('(s + nn)', 'n')} > 0.8 THEN 'Decisivo' ELSE 'Equilibrado' END AS perfil_votacao,
  coalesce(leal >= 0.85, FALSE) AS flag_alta_fidelidade, n >= 100 AS flag_participativo,
  coalesce(leal > mu / 100, FALSE) AS flag_fidelidade_acima_media_uf,
  coalesce(leal > mp / 100, FALSE) AS flag_fidelidade_acima_media_partido
FROM pf JOIN xu ON xu.uf IS NOT DISTINCT FROM pf.uf JOIN xp ON xp.partido IS NOT DISTINCT FROM pf.partido"""
SQL["presence_loyalty"] = sql("fvoto", _presence)

CTE["fvoto_versao"] = CTE["fvoto"].replace(
    "LEFT JOIN dep d ON v.k = d.k", "LEFT JOIN dv d ON v.k = d.k AND v.ts >= d.t0 AND (d.t1 IS NULL OR v.ts < d.t1)"
)
CTE["dv"] = f"""dv AS (SELECT ver.k, t0, t1, {key('ver.k', 't0')} AS sk, nome, party AS partido, uf, condicao
        FROM ver LEFT JOIN dep ON ver.k = dep.k)"""
CTE["durante"] = """durante AS (SELECT dv.sk, count(vota.dia) AS realizadas FROM dv LEFT JOIN vota
          ON dia >= CAST(t0 AS DATE) AND (t1 IS NULL OR CAST(dia AS TIMESTAMP) < t1) GROUP BY dv.sk)"""
_NEEDS |= {"dv": ["ver", "dep"], "fvoto_versao": ["dv", "voto", "vota", "orient", "bill"], "durante": ["dv", "vota"]}
_held = "(SELECT realizadas FROM durante WHERE durante.sk = pe.sk)"
SQL["presence_on_versions"] = sql(
    "fvoto_versao durante", _presence.replace("(SELECT count(*) FROM vota)", _held)
)

_disc_ctes = f"""ca AS (SELECT partido, id_votacao, count(*) AS n, count(DISTINCT voto) AS tipos,
    CASE WHEN count(*) >= 3 THEN {pct('''greatest(count(*) FILTER (voto = 'SIM'), count(*) FILTER (voto = 'NÃO'),
      count(*) FILTER (voto = 'ABSTENÇÃO'), count(*) FILTER (voto = 'OBSTRUÇÃO'))''', 'count(*)')} END AS co
  FROM fvoto WHERE partido IS NOT NULL GROUP BY partido, id_votacao),
 cm AS (SELECT partido, count(co) AS an, coalesce({avg('CAST(co AS DECIMAL(18,4))')}, 0) AS media,
    coalesce({rnd('stddev_samp(co)')}, 0) AS desvio, count(*) FILTER (co >= 90) AS alta,
    count(*) FILTER (co < 60) AS baixa, count(*) FILTER (co IS NOT NULL AND tipos = 1) AS unanimes
  FROM ca GROUP BY partido),
 di AS (SELECT v.*, cm.* EXCLUDE (partido), CASE WHEN orientados > 0 THEN {ratio('fiel', 'orientados')} END AS leal
  FROM (SELECT partido, count(DISTINCT k) AS deps, {_vote_counts} FROM fvoto WHERE partido IS NOT NULL
    GROUP BY partido) v JOIN cm USING (partido)),
 be AS (SELECT {avg('CAST(leal * 100 AS DECIMAL(18,8))')} AS bf,
    {avg('CAST(CASE WHEN an > 0 THEN media END AS DECIMAL(18,4))')} AS bc FROM di WHERE deps >= 5)"""
_disc_class = since("leal", rules.SHARE_CUTS, rules.DISCIPLINE_LABELS)
_cohe_class = since("media", rules.COHESION_CUTS, rules.COHESION_LABELS)
SQL["discipline_cohesion"] = sql("fvoto", f"""
WITH {_disc_ctes}
SELECT partido AS sigla_partido, n AS total_votos_partido, calls AS total_votacoes_partido,
  s AS votos_sim_partido, nn AS votos_nao_partido, ab AS votos_abstencao_partido,
  ob AS votos_obstrucao_partido, fiel AS votos_fieis, reb AS votos_rebeldes,
  orientados AS votos_com_orientacao, votos_2023, votos_2022, votos_2021, pl AS votos_projetos_lei,
  pec AS votos_pec, mpv AS votos_medida_provisoria, pos AS votos_com_posicionamento,
  venc AS total_votos_lado_vencedor, an AS total_votacoes_analisadas, alta AS votacoes_alta_coesao,
  baixa AS votacoes_baixa_coesao, unanimes AS votacoes_unanimes, deps AS total_deputados_partido,
  bf AS benchmark_fidelidade, bc AS benchmark_coesao, {key('partido')} AS sk_fidelidade_partido,
  {pct0('fiel', 'orientados')} AS taxa_fidelidade_partidaria, {pct0('reb', 'orientados')} AS taxa_rebeldia_partidaria,
  media AS coesao_media_partido, desvio AS desvio_coesao, {pct0('alta', 'an')} AS percentual_alta_coesao,
  CASE WHEN s > nn THEN 'GOVERNO' WHEN nn > s THEN 'OPOSIÇÃO' ELSE 'NEUTRO' END AS tendencia_posicionamento,
  {pct0('venc', 'pos')} AS taxa_efetividade_politica, {_disc_class} AS classificacao_disciplina,
  {since('deps', rules.BENCH_SIZE_CUTS, rules.BENCH_SIZE_LABELS)} AS tamanho_bancada,
  coalesce(leal >= 0.85, FALSE) AS flag_alta_disciplina,
  coalesce(leal > bf / 100, FALSE) AS flag_fidelidade_acima_benchmark, {_cohe_class} AS classificacao_coesao,
  media >= 80 AS flag_alta_coesao, coalesce(media > bc, FALSE) AS flag_coesao_acima_benchmark
FROM di, be WHERE deps >= 3""")

_today = f"DATE {q(AS_OF)}"
_swap_years = (2023, 2022, 2021, 2020, 2019)
SQL["state_switching"] = sql("ver dep", f"""
WITH h AS (SELECT ver.*, dep.uf, lag(party) OVER w IS NOT NULL AND lag(party) OVER w <> party AS troca,
    date_diff('day', CAST(t0 AS DATE), CAST(coalesce(CAST(t1 AS DATE), {_today}) AS DATE)) AS dias
  FROM ver LEFT JOIN dep USING (k) WINDOW w AS (PARTITION BY ver.k ORDER BY t0)),
 ordem AS (SELECT k, string_agg(party, ' → ' ORDER BY p0, party) AS lista, count(*) AS distintos
  FROM (SELECT k, party, min(t0) AS p0 FROM ver GROUP BY k, party) GROUP BY k),
 g AS (SELECT k, max_by(party, t0) AS atual, max_by(uf, t0) AS uf, count(*) AS periodos,
    count(*) FILTER (troca) AS trocas, min(t0) AS p0, max(t0) AS p1, {avg('dias', 0)} AS md, max(dias) AS mx,
    {", ".join(f"count(*) FILTER (troca AND year(t0) = {y}) AS trocas_{y}" for y in _swap_years)}
  FROM h GROUP BY k),
 x AS (SELECT g.*, lista, distintos, date_diff('day', CAST(p1 AS DATE), {_today}) AS dd,
    date_diff('year', p0, CAST({_today} AS TIMESTAMP)) AS anos, date_diff('day', CAST(p0 AS DATE), {_today}) AS total
  FROM g JOIN ordem USING (k)),
 e AS (SELECT {avg('trocas')} AS mg, count(*) FILTER (trocas = 0) AS sem, count(*) FILTER (trocas >= 3) AS mult,
    count(*) AS n FROM x),
 u AS (SELECT uf, {avg('trocas')} AS mu, count(*) FILTER (trocas >= 2) AS m2 FROM x GROUP BY uf)
SELECT k AS deputado_id, periodos AS total_periodos_partidarios, trocas AS total_trocas_partido,
  {txt('p0')} AS primeira_data_mandato, {txt('p1')} AS ultima_mudanca_partido, md AS dias_medio_por_partido,
  mx AS maior_tempo_consecutivo_partido, {", ".join(f"trocas_{y}" for y in _swap_years)}, atual AS partido_atual,
  x.uf AS sigla_uf, lista AS historico_partidos, distintos AS partidos_distintos, dd AS dias_no_partido_atual,
  mg AS media_trocas_geral, sem AS total_deputados_sem_troca, mult AS total_deputados_multiplas_trocas,
  n AS total_deputados_analisados, mu AS media_trocas_uf, m2 AS deputados_com_multiplas_trocas_uf,
  {key('k')} AS sk_trocas_deputado,
  CASE WHEN anos > 0 THEN {rnd(ratio('trocas', 'anos'))} ELSE 0.0 END AS trocas_por_ano_mandato,
  {pct('mx', 'total')} AS percentual_maior_estabilidade,
  CASE WHEN trocas = 0 THEN 'Fiel ao Partido' WHEN trocas = 1 THEN 'Uma Troca' WHEN trocas = 2 THEN 'Duas Trocas'
    WHEN trocas <= 4 THEN 'Múltiplas Trocas' ELSE 'Muito Instável' END AS classificacao_fidelidade,
  {since('md', rules.STABILITY_CUTS, rules.STABILITY_LABELS)} AS classificacao_estabilidade,
  CASE WHEN trocas = 0 THEN 'Sem Migração'
    WHEN trocas_2023 + trocas_2022 >= {dbl('trocas')} * CAST(0.7 AS DOUBLE) THEN 'Migração Recente'
    WHEN trocas_2019 + trocas_2020 >= {dbl('trocas')} * CAST(0.7 AS DOUBLE) THEN 'Migração Início Mandato'
    ELSE 'Migração Distribuída' END AS perfil_migracao,
  {since('dd', rules.CURRENT_CUTS, rules.CURRENT_LABELS)} AS status_partido_atual,
  trocas = 0 AS flag_deputado_fiel, trocas >= 3 AS flag_multiplas_trocas, trocas_2023 > 0 AS flag_troca_recente,
  trocas > mg AS flag_acima_media_geral, trocas > mu AS flag_acima_media_uf, md < 365 AS flag_alta_rotatividade
FROM x JOIN u ON u.uf = x.uf, e""")

_d24 = lambda c: f"coalesce({avg(f'CAST({c} AS DECIMAL(24,6))')}, 0)"
_score_cuts = rules.QUINTILE_CUTS
_tie = "sigla_partido"
_vs = lambda v, b: f"CASE WHEN {v} > {b} THEN 'Acima da Média' ELSE 'Abaixo da Média' END"
SQL["efficiency_scorecard"] = sql("exp fvoto bill autor vota", f"""
WITH g AS (SELECT deputado_id, sum(net) AS n, count(DISTINCT ano * 12 + mes) AS meses FROM exp WHERE doc > 0
    GROUP BY deputado_id),
 sp AS (SELECT deputado_id, n, {pct('n', _quota)} AS uso FROM g),
 {_prod_ctes}, {_pres_ctes}, {_disc_ctes},
 o AS (SELECT dep.partido AS sigla_partido, count(DISTINCT dep.k) AS total_deputados,
    coalesce(sum(sp.n), 0) AS gastos, {_d24('sp.n')} AS gm, {_d24('uso')} AS um,
    {big('coalesce(sum(pp.total), 0)')} AS props, {big('coalesce(sum(pp.ok), 0)')} AS aprov, {_d24('pp.total')} AS pm,
    {_d24('taxa_ok')} AS tm, {_d24('pres')} AS prm, {_d24('taxa_fiel')} AS fm, {_d24('taxa_reb')} AS rm,
    {big('coalesce(sum(projetos_lei), 0)')} AS npl, {big('coalesce(sum(propostas_emenda_constitucional), 0)')} AS npec,
    {big('coalesce(sum(requerimentos), 0)')} AS nreq
  FROM dep LEFT JOIN sp ON sp.deputado_id = dep.k LEFT JOIN pp ON pp.k = dep.k LEFT JOIN pf ON pf.k = dep.k
  GROUP BY dep.partido HAVING count(DISTINCT dep.k) >= 3),
 l AS (SELECT o.*, coalesce({pct0('fiel', 'orientados')}, 0) AS fc, coalesce(media, 0) AS cc,
    coalesce({_disc_class}, 'Sem Dados') AS cd, coalesce({_cohe_class}, 'Sem Dados') AS ck, di.partido AS dp
  FROM o LEFT JOIN (SELECT * FROM di WHERE deps >= 3) di ON di.partido = o.sigla_partido),
 r AS (SELECT *, row_number() OVER (ORDER BY gm, {_tie}) AS rg, row_number() OVER (ORDER BY um, {_tie}) AS ru,
    row_number() OVER (ORDER BY pm DESC, {_tie}) AS rp, row_number() OVER (ORDER BY tm DESC, {_tie}) AS rt,
    row_number() OVER (ORDER BY prm DESC, {_tie}) AS rpr, row_number() OVER (ORDER BY fc DESC, {_tie}) AS rf,
    row_number() OVER (ORDER BY cc DESC, {_tie}) AS rc, percent_rank() OVER (ORDER BY gm) AS qg,
    percent_rank() OVER (ORDER BY pm) AS qp, percent_rank() OVER (ORDER BY prm) AS qpr,
    percent_rank() OVER (ORDER BY fc) AS qf FROM l),
 b AS (SELECT {", ".join(f"{avg(f'CAST({c} AS DECIMAL(18,4))')} AS b_{c}" for c in ('gm', 'pm', 'prm', 'tm', 'fc', 'cc'))}
  FROM l)
SELECT sigla_partido, total_deputados, {dbl('gastos')} AS gastos_totais_partido,
  {dbl('gm')} AS gastos_medio_por_deputado, {dbl('um')} AS uso_medio_cota_percentual,
  props AS proposicoes_totais_partido, aprov AS proposicoes_aprovadas_partido,
  {dbl('pm')} AS proposicoes_media_por_deputado, {dbl('tm')} AS taxa_aprovacao_media_partido,
  {dbl('prm')} AS taxa_presenca_media_partido, {dbl('fm')} AS taxa_fidelidade_media_partido,
  {dbl('rm')} AS taxa_rebeldia_media_partido, npl AS total_projetos_lei_partido, npec AS total_pec_partido,
  nreq AS total_requerimentos_partido, {dbl('fc')} AS fidelidade_partidaria_consolidada,
  {dbl('cc')} AS coesao_interna_partido, CASE WHEN dp IS NULL THEN 'Sem Dados' ELSE cd END AS classificacao_disciplina_partido,
  CASE WHEN dp IS NULL THEN 'Sem Dados' ELSE ck END AS classificacao_coesao_partido,
  rg AS ranking_economia_gastos, ru AS ranking_economia_cota, rp AS ranking_produtividade,
  rt AS ranking_efetividade, rpr AS ranking_presenca, rf AS ranking_fidelidade, rc AS ranking_coesao,
  qg AS percentil_gastos, qp AS percentil_produtividade, qpr AS percentil_presenca, qf AS percentil_fidelidade,
  b_gm AS benchmark_gastos_medio, b_pm AS benchmark_produtividade, b_prm AS benchmark_presenca,
  b_tm AS benchmark_efetividade, b_fc AS benchmark_fidelidade, b_cc AS benchmark_coesao,
  {key('sigla_partido')} AS sk_eficiencia_partido,
  CASE WHEN gastos > 0 THEN {rnd(ratio('aprov', f"({dbl('gastos')} / 1000000)"), 4)} ELSE 0.0 END
    AS proposicoes_aprovadas_por_milhao_gasto,
  {rnd('(1 - qg) * 20 + qp * 25 + qpr * 20 + qf * 15 + tm / 100 * 20')} AS score_eficiencia_geral,
  CASE WHEN gm < b_gm THEN 'Abaixo da Média' ELSE 'Acima da Média' END AS comparacao_gastos,
  {_vs('pm', 'b_pm')} AS comparacao_produtividade, {_vs('prm', 'b_prm')} AS comparacao_presenca,
  {_vs('fc', 'b_fc')} AS comparacao_fidelidade, {upto('qg', _score_cuts, rules.SPEND_QUINTILES)} AS classificacao_gastos,
  {since('qp', _score_cuts, rules.PRODUCTIVITY_QUINTILES)} AS classificacao_produtividade,
  {since('qpr', _score_cuts, rules.PRESENCE_QUINTILES)} AS classificacao_presenca,
  {since('qf', _score_cuts, rules.LOYALTY_LABELS)} AS classificacao_fidelidade_comparativa,
  CASE WHEN npl >= {dbl('props')} * CAST(0.6 AS DOUBLE) THEN 'Focado em Projetos de Lei'
    WHEN npec >= {dbl('props')} * CAST(0.3 AS DOUBLE) THEN 'Focado em PECs'
    WHEN nreq >= {dbl('props')} * 0.5 THEN 'Focado em Fiscalização' ELSE 'Atuação Diversificada' END AS perfil_atuacao,
  rg <= 5 AS flag_top5_economia, rp <= 5 AS flag_top5_produtividade, rpr <= 5 AS flag_top5_presenca,
  rt <= 5 AS flag_top5_efetividade, rf <= 5 AS flag_top5_fidelidade, rc <= 5 AS flag_top5_coesao
FROM r, b""")

# --- exploration ------------------------------------------------------------------------

_passed = like("texto", ["%aprovad%", "%transformado em norma%"])
SQL["activity_full_outer"] = sql("voto bill autor", f"""
WITH v AS (SELECT k, count(*) AS n, count(*) FILTER (voto = 'SIM') AS s, count(*) FILTER (voto = 'NÃO') AS c,
    count(*) FILTER (voto = 'ABSTENÇÃO') AS ab, count(*) FILTER (trim(voto) = '') AS au,
    count(DISTINCT CAST(ts AS DATE)) AS dias FROM voto GROUP BY k),
 p AS (SELECT k, count(*) AS m, count(*) FILTER ({_passed}) AS ok, count(DISTINCT tipo) AS tipos
    FROM autor JOIN bill USING (id) GROUP BY k),
 x AS (SELECT coalesce(v.k, p.k) AS k, coalesce(n, 0) AS n, coalesce(s, 0) AS s, coalesce(c, 0) AS c,
    coalesce(ab, 0) AS ab, coalesce(au, 0) AS au, coalesce(dias, 0) AS dias, coalesce(m, 0) AS m,
    coalesce(ok, 0) AS ok, coalesce(tipos, 0) AS tipos FROM v FULL JOIN p ON v.k = p.k)
SELECT k AS deputado_id, n AS total_votacoes, s AS votos_sim, c AS votos_nao, ab AS abstencoes, au AS ausencias,
  dias AS dias_votacao_distintos, m AS proposicoes_criadas, ok AS proposicoes_aprovadas,
  tipos AS tipos_proposicao_criados, {pct0('au', 'n')} AS taxa_ausencia_percent,
  {pct0('ok', 'm')} AS taxa_aprovacao_proposicoes, CAST(n * 0.3 + m * 0.7 AS DOUBLE) AS score_atividade,
  CASE WHEN n > 1000 AND m > 10 THEN 'MUITO_ATIVO' WHEN n > 500 AND m > 5 THEN 'ATIVO'
    WHEN n > 100 OR m > 1 THEN 'MODERADO' ELSE 'BAIXA_ATIVIDADE' END AS categoria_atividade
FROM x WHERE n > 0 OR m > 0""")

SQL["spend_ranking"] = sql("exp", f"""
WITH y AS (SELECT deputado_id, ano, count(*) AS c, sum(net) AS s, {ratio('sum(net)', 'count(net)')} AS m
    FROM exp WHERE net > 0 GROUP BY deputado_id, ano),
 p AS (SELECT deputado_id, sum(s) AS total, count(*) AS anos, sum(c) AS trans,
    {rnd(ratio('sum(CAST(m AS DECIMAL(24,8)))', 'count(*)'), 4)} AS vm FROM y GROUP BY 1 HAVING count(*) >= 2)
SELECT deputado_id, {dbl('total')} AS total_gasto_periodo, {ratio('total', 'anos')} AS media_anual,
  anos AS anos_atividade, {big('trans')} AS total_transacoes, vm AS valor_medio_geral,
  row_number() OVER (ORDER BY total DESC, deputado_id) AS ranking_gasto,
  {rnd(ratio('total', 'anos'))} AS gasto_medio_por_ano,
  CASE WHEN total > 1000000 THEN 'ALTO_GASTO' WHEN total > 500000 THEN 'MEDIO_GASTO' ELSE 'BAIXO_GASTO' END
    AS categoria_gasto
FROM p""")

SQL["yearly_growth_lag"] = sql("bill", f"""
WITH y AS (SELECT ano1 AS ano, count(*) AS n, count(DISTINCT tipo) AS t, count(*) FILTER ({_passed}) AS ok,
    count(*) FILTER (texto ILIKE '%arquivad%') AS arq, count(*) FILTER (texto ILIKE '%tramitand%') AS tr
    FROM bill GROUP BY ano1),
 z AS (SELECT *, lag(n) OVER (ORDER BY ano) AS a FROM y),
 w AS (SELECT *, {pct('(n - a)', 'a')} AS g FROM z)
SELECT ano, n AS total_proposicoes, t AS tipos_distintos, ok AS aprovadas, arq AS arquivadas, tr AS em_tramitacao,
  {pct('ok', 'n')} AS taxa_aprovacao, g AS crescimento_percentual,
  CASE WHEN g > 10 THEN 'ALTO_CRESCIMENTO' WHEN g BETWEEN 0 AND 10 THEN 'CRESCIMENTO_MODERADO'
    WHEN g BETWEEN -10 AND 0 THEN 'DECLINIO_MODERADO' ELSE 'ALTO_DECLINIO' END AS categoria_tendencia
FROM w""")

_grow = lambda c, p: f"{ratio(f'({c} - {p})', p)} * 100"
SQL["entity_yearly_growth"] = sql("exp", f"""
WITH y AS (SELECT deputado_id, ano, sum(net) AS s FROM exp GROUP BY ALL),
 z AS (SELECT *, lag(s) OVER (PARTITION BY deputado_id ORDER BY ano) AS p FROM y)
SELECT deputado_id, ano, {dbl('s')} AS total, {rnd(_grow('s', 'p'))} AS crescimento_percentual FROM z""")

SQL["type_profile"] = sql("bill", f"""
SELECT tipo AS tipo_proposicao, 'Tipo ' || tipo AS descricao_tipo, count(*) AS total_proposicoes,
  count(DISTINCT id) AS numeros_distintos, min(ano0) AS ano_mais_antigo, max(ano0) AS ano_mais_recente,
  count(*) FILTER ({_passed}) AS proposicoes_aprovadas, count(*) FILTER (texto ILIKE '%arquivad%')
    AS proposicoes_arquivadas, {pct(f'count(*) FILTER ({_passed})', 'count(*)')} AS taxa_aprovacao_percent
FROM bill GROUP BY tipo""")

_share = lambda n, d, s="%": f"CAST(round(CAST({ratio(n, d)} * 100 AS DECIMAL(28,8)), 2) AS DECIMAL(12,2)) || '{s}'"
SQL["kpi_list"] = sql("fvoto", f"""
WITH k AS (SELECT min(year(dia)) || ' - ' || max(year(dia)) AS m0, {txt('count(*)')} AS m1,
    {txt('count(DISTINCT k)')} AS m2, {txt('count(DISTINCT id_votacao)')} AS m3,
    {txt('count(DISTINCT prop) FILTER (tem_prop)')} AS m4,
    {_share("count(*) FILTER (fid = 'SEGUIU_ORIENTACAO')", "count(*) FILTER (fid IN ('SEGUIU_ORIENTACAO', 'CONTRARIOU_ORIENTACAO'))")} AS m5,
    {_share("count(DISTINCT id_votacao) FILTER (aprovada)", "count(DISTINCT id_votacao)")} AS m6,
    {_share("count(*) FILTER (voto = 'SIM')", "count(*) FILTER (posicao)", "% SIM")} AS m7 FROM fvoto)
SELECT 'Período Analisado' AS metrica, m0 AS valor, 'Anos com dados de votação' AS descricao FROM k
UNION ALL SELECT 'Total de Votos Individuais', m1, 'Votos registrados no sistema' FROM k
UNION ALL SELECT 'Deputados Únicos', m2, 'Deputados com pelo menos 1 voto registrado' FROM k
UNION ALL SELECT 'Votações Únicas', m3, 'Votações nominais realizadas' FROM k
UNION ALL SELECT 'Proposições Votadas', m4, 'Proposições que passaram por votação' FROM k
UNION ALL SELECT 'Taxa de Fidelidade Partidária', m5, 'Percentual de votos que seguiram orientação partidária' FROM k
UNION ALL SELECT 'Taxa de Aprovação Média', m6, 'Percentual de votações que foram aprovadas' FROM k
UNION ALL SELECT 'Votos SIM vs NÃO', m7, 'Proporção de votos favoráveis vs contrários' FROM k""")

# --- person reports ---------------------------------------------------------------------

SQL["entity_selector"] = sql("exp ver dep", f"""
WITH t AS (SELECT deputado_id AS k, count(*) AS n, sum(net) AS s, min(ano) AS a0, max(ano) AS a1 FROM exp GROUP BY 1),
 c AS (SELECT k, max_by(party, t0) AS party FROM ver GROUP BY k)
SELECT t.k AS nk_deputado, n AS total_despesas, {dbl('s')} AS total_valor, a0 AS primeiro_ano_despesa,
  a1 AS ultimo_ano_despesa, nome AS nome_deputado, party AS sigla_partido, uf AS sigla_uf, TRUE AS is_current,
  CAST(1 AS BIGINT) AS qtd_legislaturas, '🟢 Ativo' AS status_mandato
FROM t JOIN c ON c.k = t.k JOIN dep ON dep.k = t.k""")

CTE["pv"] = """pv AS (SELECT exp.*, ver.party, dep.uf AS duf, dep.leg FROM exp
        JOIN ver ON exp.deputado_id = ver.k AND quando >= t0 AND (t1 IS NULL OR quando < t1)
        LEFT JOIN dep ON dep.k = exp.deputado_id)"""
_NEEDS["pv"] = ["exp", "ver", "dep"]

SQL["entity_kpis"] = sql("pv", f"""
WITH g AS (SELECT deputado_id AS k, sum(net) AS s, count(*) AS n, count(DISTINCT ano * 12 + mes) AS m,
    {ratio('sum(net)', 'count(net)')} AS md, min(ano) AS a0, max(ano) AS a1, count(DISTINCT party) AS qp,
    count(DISTINCT duf) AS qu, count(DISTINCT leg) AS ql FROM pv GROUP BY 1)
SELECT k AS nk_deputado, {dbl('s')} AS total_gasto, n AS total_despesas, m AS meses_atividade,
  md AS media_por_despesa, a0 AS primeiro_ano, a1 AS ultimo_ano, qp AS qtd_partidos, qu AS qtd_ufs,
  ql AS qtd_legislaturas, {ratio('s', 'm')} AS media_mensal, a1 - a0 + 1 AS anos_periodo FROM g""")

SQL["monthly_evolution"] = sql("pv", f"""
SELECT deputado_id AS nk_deputado, ano, mes, party AS sigla_partido, duf AS sigla_uf, leg AS id_legislatura,
  {dbl('sum(net)')} AS gasto_mensal, count(*) AS despesas_mes, CAST((mes + 2) // 3 AS BIGINT) AS trimestre,
  {_months}[mes] AS nome_mes, substr({_months}[mes], 1, 3) AS mes_abrev
FROM pv GROUP BY ALL""")

_supp = f"{dbl('sum(net)')} AS total_gasto, count(*) AS qtd_transacoes, {ratio('sum(net)', 'count(net)')} AS ticket_medio"
SQL["top15_suppliers"] = sql("exp", f"""
SELECT fornecedor AS nome_fornecedor, {_supp} FROM exp GROUP BY fornecedor
ORDER BY sum(net) DESC, fornecedor LIMIT 15""")

SQL["top_suppliers_per_person"] = sql("exp", f"""
SELECT * FROM (SELECT deputado_id AS nk_deputado, fornecedor AS nome_fornecedor, {_supp},
    row_number() OVER (PARTITION BY deputado_id ORDER BY sum(net) DESC, fornecedor) AS posicao
  FROM exp GROUP BY deputado_id, fornecedor) WHERE posicao <= 3""")

SQL["type_by_year"] = sql("exp", f"""
SELECT tipo AS tipo_despesa, ano, {dbl('sum(net)')} AS total_gasto, count(*) AS qtd_despesas,
  {ratio('sum(net)', 'count(net)')} AS valor_medio FROM exp GROUP BY tipo, ano""")

SQL["type_totals"] = sql("exp", f"""
SELECT tipo AS tipo_despesa, {dbl('sum(net)')} AS total_gasto, count(*) AS qtd_transacoes FROM exp GROUP BY tipo""")

SQL["detail_listing"] = sql("pv", f"""
SELECT deputado_id AS nk_deputado, ano, {_months}[mes] AS nome_mes, party AS sigla_partido, duf AS sigla_uf,
  leg AS id_legislatura, tipo AS tipo_despesa, fornecedor AS nome_fornecedor, {txt('quando')} AS data_documento,
  l_orderkey || '/' || l_linenumber AS num_documento, l_linestatus AS tipo_documento,
  CASE l_returnflag WHEN 'N' THEN ' ' WHEN 'R' THEN 'https://doc/' || l_orderkey END AS url_documento,
  {dbl('doc')} AS valor_documento, {dbl('net')} AS valor_liquido, {dbl('cut')} AS valor_glosa
FROM pv WHERE ano = 2022 AND party = 'PT'""")

SQL["detail_summary"] = sql("pv", f"""
SELECT party AS sigla_partido, duf AS sigla_uf, leg AS id_legislatura, {dbl('sum(net)')} AS valor_liquido,
  count(doc) AS documentos FROM pv GROUP BY ALL""")

# --- analyses ---------------------------------------------------------------------------

SQL["data_overview"] = sql("exp", f"""
SELECT count(DISTINCT deputado_id) AS total_deputados, count(DISTINCT uf) AS total_ufs,
  count(DISTINCT partido) AS total_partidos, count(*) AS total_despesas, {dbl('sum(net)')} AS valor_total,
  min(ano) AS ano_inicio, max(ano) AS ano_fim FROM exp""")

_mean = lambda x: ratio(f"sum({x})", f"count({x})")
_m8 = lambda x: _mean(f"CAST({x} AS DECIMAL(28,8))")
SQL["regional_gap"] = sql("exp", f"""
WITH p AS (SELECT {case(_regions, "'Não identificado'")} AS regiao, ano, deputado_id, uf, sum(net) AS s
    FROM exp GROUP BY ALL),
 y AS (SELECT regiao, ano, {_mean('s')} AS m FROM p GROUP BY ALL),
 r AS (SELECT regiao, {_m8('m')} AS g, count(*) AS anos, {rnd('stddev_samp(m)')} AS desvio FROM y GROUP BY regiao),
 b AS (SELECT g AS base FROM r WHERE regiao = 'Sul')
SELECT regiao, {rnd('g')} AS gasto_medio, anos, desvio, {rnd(_grow('g', 'base'))} AS diferenca_percentual
FROM r LEFT JOIN b ON TRUE""")


def _top_share(by: str, member: str, names: Sequence[str], least: int) -> str:
    out, n, k = names
    return f"""
WITH p AS (SELECT {by}, {member} AS m, sum(net) AS s FROM exp GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY s DESC, m) AS rn,
    count(*) OVER (PARTITION BY {by}) AS n FROM p),
 t AS (SELECT *, greatest({least}, n // 10) AS k FROM r)
SELECT {by}, max(n) AS {n}, {big('max(k)')} AS {k},
  {ratio('sum(s) FILTER (rn <= k)', 'sum(s)')} * 100 AS {out} FROM t GROUP BY {by}"""


SQL["pareto_top10pct"] = sql("exp", _top_share("ano", "deputado_id", ("concentracao", "total_deputados", "top_10_percent"), 1))
SQL["supplier_concentration"] = sql("exp", _top_share(
    "partido, ano", "cnpj", ("concentracao_pct", "total_fornecedores", "top_fornecedores"), 3
)).replace("SELECT partido, ano, max(n)", "SELECT partido AS sigla_partido, ano, max(n)")

SQL["lorenz_curve"] = sql("exp", f"""
WITH p AS (SELECT deputado_id, ano, sum(net) AS s FROM exp GROUP BY ALL),
 r AS (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY ano) AS n, sum(s) OVER (PARTITION BY ano) AS t,
    sum(s) OVER (PARTITION BY ano ORDER BY s DESC, deputado_id ROWS UNBOUNDED PRECEDING) AS c
  FROM p WINDOW w AS (PARTITION BY ano ORDER BY s DESC, deputado_id))
SELECT deputado_id, ano, {dbl('s')} AS gasto_total, rn AS posicao, {ratio('rn', 'n')} * 100 AS percentual_membros,
  {ratio('c', 't')} * 100 AS percentual_valor_acumulado FROM r""")

SQL["seasonality_q4_q1"] = sql("exp", f"""
WITH y AS (SELECT ano, sum(net) FILTER (mes <= 3) AS a, sum(net) FILTER (mes >= 10) AS b FROM exp GROUP BY ano)
SELECT ano, {dbl('a')} AS t1_gasto, {dbl('b')} AS t4_gasto, {rnd(_grow('b', 'a'))} AS variacao
FROM y WHERE a IS NOT NULL AND b IS NOT NULL""")

SQL["month_year_pivot"] = sql("exp", f"""
SELECT ano, {", ".join(f"{dbl(f'coalesce(sum(net) FILTER (mes = {m}), 0)')} AS mes_{m:02d}" for m in range(1, 13))}
FROM exp GROUP BY ano""")

_cases = f"""y AS (SELECT deputado_id, ano, sum(net) AS s, count(DISTINCT mes) AS m FROM exp GROUP BY ALL HAVING count(DISTINCT mes) >= 2),
 z AS (SELECT *, lag(ano) OVER w AS a0, lag(s) OVER w AS s0 FROM y WINDOW w AS (PARTITION BY deputado_id ORDER BY ano)),
 g AS (SELECT *, CAST({_grow('s', 's0')} AS DECIMAL(28,8)) AS g, {_grow('s', 's0')} AS gd FROM z WHERE ano - a0 = 1)"""
SQL["consecutive_growth"] = sql("exp", f"""
WITH {_cases}
SELECT a0 AS ano_base, ano AS ano_comparacao, {avg('g')} AS media, {rnd('stddev_samp(CAST(g AS DOUBLE))')} AS desvio,
  count(g) AS casos, count(*) FILTER (g > 10) AS acima_de_10, count(*) FILTER (g < -10) AS abaixo_de_10,
  {rnd('median(CAST(g AS DOUBLE))')} AS mediana
FROM g GROUP BY a0, ano""")
SQL["growth_overall"] = sql("exp", f"""
WITH {_cases},
 o AS (SELECT {avg('g', 8)} AS m8, {avg('g')} AS m, count(g) AS n, count(*) FILTER (g > 10) AS a, count(*) FILTER (g < -10) AS b FROM g)
SELECT m AS media_geral, n AS casos, a AS acima, b AS abaixo, {pct('a', 'n')} AS percentual_acima,
  {pct('b', 'n')} AS percentual_abaixo, coalesce(m8 >= 10, FALSE) AS confirmada FROM o""")
SQL["top_type_evolution"] = sql("exp", f"""
WITH r AS (SELECT tipo, row_number() OVER (ORDER BY sum(net) DESC, tipo) AS p FROM exp WHERE tipo IS NOT NULL GROUP BY tipo)
SELECT ano, {", ".join(f"{dbl(f'coalesce(sum(net) FILTER (p = {i}), 0)')} AS tipo_{i}" for i in range(1, 6))},
  {", ".join(f"(SELECT tipo FROM r WHERE p = {i}) AS nome_{i}" for i in range(1, 6))}
FROM exp JOIN r USING (tipo) WHERE p <= 5 GROUP BY ano""")
SQL["strongest_growth"] = sql("exp", f"""
WITH {_cases}
SELECT deputado_id, ano, {dbl('s')} AS gasto_anual, m AS meses_com_dados, a0 AS ano_base,
  {dbl('s0')} AS gasto_ano_base, gd AS crescimento_percentual
FROM g WHERE gd IS NOT NULL ORDER BY gd DESC, deputado_id, ano LIMIT 10""")

_bench = f"""p AS (SELECT partido, ano, count(DISTINCT deputado_id) AS q, sum(net) AS s,
    {ratio('sum(net)', 'count(DISTINCT deputado_id)')} AS m FROM exp GROUP BY ALL HAVING count(DISTINCT deputado_id) >= 3)"""
SQL["bench_bins"] = sql("exp", f"""
WITH {_bench}
SELECT ano, {upto('q', (270, 300), rules.BENCH_BIN_LABELS)} AS tamanho_bancada, count(*) AS partidos,
  {avg('q')} AS bancada_media, {rnd(_m8('m'))} AS gasto_medio_por_deputado FROM p GROUP BY ALL""")
SQL["corr_bench_spend"] = sql("exp", f"""
WITH {_bench}
SELECT {rnd('regr_slope(m, q)', 4)} AS inclinacao, {rnd('regr_intercept(m, q)', 4)} AS intercepto,
  {rnd('corr(m, q)', 6)} AS correlacao FROM p""")

_e = f"ano IN {inlist(rules.ELECTION_YEARS)}"
SQL["cycle_vs_offcycle"] = sql("exp", f"""
WITH y AS (SELECT partido, ano, sum(net) AS s FROM exp WHERE {has('tipo', rules.PUBLICITY_WORDS)} GROUP BY ALL),
 p AS (SELECT partido, coalesce({_mean(f'CASE WHEN {_e} THEN s END')}, 0) AS e,
    coalesce({_mean(f'CASE WHEN NOT {_e} THEN s END')}, 0) AS n FROM y GROUP BY partido)
SELECT partido AS sigla_partido, CASE WHEN partido IN {inlist(rules.LARGE_PARTIES)} THEN 'Grande'
    WHEN partido IN {inlist(rules.SMALL_PARTIES)} THEN 'Pequeno' ELSE 'Médio' END AS porte,
  {rnd('e')} AS eleitoral, {rnd('n')} AS nao_eleitoral, coalesce({rnd(_grow('e', 'n'))}, 0) AS variacao_pct FROM p""")
SQL["election_types"] = sql("exp", f"""
WITH p AS (SELECT tipo, sum(net) FILTER ({_e}) AS e, sum(net) FILTER (NOT {_e}) AS n FROM exp GROUP BY tipo)
SELECT tipo AS tipo_despesa, {dbl('e')} AS eleitoral, {dbl('n')} AS nao_eleitoral,
  {rnd(_grow('e', 'n'))} AS crescimento_percentual FROM p WHERE e IS NOT NULL AND n > 0""")
SQL["election_months"] = sql("exp", f"""
WITH m AS (SELECT ano, mes, sum(net) AS s FROM exp GROUP BY ALL),
 p AS (SELECT mes, {avg(f'CASE WHEN {_e} THEN s END')} AS e, {avg(f'CASE WHEN NOT {_e} THEN s END')} AS n FROM m GROUP BY mes)
SELECT mes, e AS eleitoral, n AS nao_eleitoral, {rnd(_grow('e', 'n'))} AS variacao FROM p""")
SQL["election_yearly_mean"] = sql("exp", f"""
WITH y AS (SELECT ano, sum(net) AS s FROM exp GROUP BY ano),
 p AS (SELECT {_mean(f'CASE WHEN {_e} THEN s END')} AS e, {_mean(f'CASE WHEN NOT {_e} THEN s END')} AS n FROM y)
SELECT {rnd('e')} AS media_eleitoral, {rnd('n')} AS media_nao_eleitoral, {rnd(_grow('e', 'n'))} AS variacao_percentual,
  coalesce({rnd(_grow('e', 'n'))} > 10, FALSE) AS aumento_confirmado FROM p""")

_dist = "CASE uf " + " ".join(f"WHEN {q(k)} THEN {v}" for k, v in rules.DISTANCE_TO_CAPITAL.items()) + " END"
_transport = f"p AS (SELECT uf, deputado_id, ano, sum(net) AS s FROM exp WHERE {has('tipo', rules.TRANSPORT_WORDS)} GROUP BY ALL)"
SQL["keyword_category_distance"] = sql("exp", f"""
WITH {_transport}
SELECT uf AS sigla_uf, {case(_regions, "'Não identificado'")} AS regiao, {big(_dist)} AS distancia,
  {avg('s')} AS valor_transporte FROM p GROUP BY uf""")
SQL["transport_trend"] = sql("exp", f"""
WITH {_transport},
 e AS (SELECT {avg(f'CASE WHEN uf IN {inlist(rules.NEAR_STATES)} THEN s END')} AS a,
    {avg(f'CASE WHEN uf IN {inlist(rules.FAR_STATES)} THEN s END')} AS b FROM p),
 u AS (SELECT CAST({_dist} AS DOUBLE) AS d, {_mean('s')} AS v FROM p GROUP BY uf),
 l AS (SELECT {rnd('regr_slope(v, d)', 4)} AS i, {rnd('regr_intercept(v, d)', 4)} AS c, {rnd('corr(v, d)', 6)} AS r FROM u)
SELECT a AS gasto_proximos, b AS gasto_distantes, {rnd(_grow('b', 'a'))} AS diferenca_pct, i AS inclinacao,
  c AS intercepto, r AS correlacao FROM e, l""")

_rich, _poor = f"uf IN {inlist(rules.RICH_STATES)}", f"uf IN {inlist(rules.POOR_STATES)}"
SQL["class_share_top50"] = sql("exp", f"""
WITH p AS (SELECT ano, deputado_id, uf, sum(net) AS s FROM exp GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY ano ORDER BY s DESC, deputado_id) AS rn FROM p)
SELECT ano, count(*) AS total_top, count(*) FILTER ({_rich}) AS ricos,
  count(*) FILTER (NOT {_rich} AND NOT {_poor}) AS medios, count(*) FILTER ({_poor}) AS pobres,
  {pct(f'count(*) FILTER ({_rich})', 'count(*)')} AS pct_ricos, {pct(f'count(*) FILTER ({_poor})', 'count(*)')} AS pct_pobres
FROM r WHERE rn <= 50 GROUP BY ano""")

SQL["quarter_trend"] = sql("exp", f"""
WITH p AS (SELECT ano, CAST((mes + 2) // 3 AS BIGINT) AS tri, count(DISTINCT deputado_id) AS q, sum(net) AS s,
    {ratio('sum(net)', 'count(DISTINCT deputado_id)')} AS g, {ratio('sum(net)', 'count(*)')} AS v FROM exp GROUP BY 1, 2),
 l AS (SELECT *, g - lag(g) OVER (PARTITION BY ano ORDER BY tri) AS passo FROM p),
 y AS (SELECT ano, count(*) AS n, coalesce(min(passo) >= 0, FALSE) AS sobe, max(g) FILTER (tri = 1) AS q1,
    max(g) FILTER (tri = 4) AS q4 FROM l GROUP BY ano)
SELECT p.ano, tri AS trimestre, q AS qtd_deputados, {dbl('s')} AS total_gasto, g AS gasto_medio_deputado,
  v AS valor_medio_despesa, n AS trimestres, sobe AS tendencia_crescente, {rnd(_grow('q4', 'q1'))} AS crescimento_t4_t1
FROM p JOIN y ON y.ano = p.ano""")

_outliers = f"""p AS (SELECT ano, deputado_id, partido, uf, sum(net) AS s, count(*) AS n FROM exp GROUP BY ALL),
 st AS (SELECT ano, {_mean('s')} AS m, median({dbl('s')}) AS md, stddev_samp({dbl('s')}) AS sd FROM p GROUP BY ano),
 r AS (SELECT *, row_number() OVER (PARTITION BY ano ORDER BY s DESC, deputado_id) AS rn FROM p)"""
_yearly = f"""
SELECT r.ano, rn AS ranking, deputado_id, partido AS sigla_partido, uf AS sigla_uf, {dbl('s')} AS gasto_total,
  n AS qtd_despesas, {rnd('m')} AS media_ano, {rnd('md')} AS mediana_ano, {rnd('sd')} AS desvio_ano,
  {rnd(ratio('s', 'm'), 4)} AS multiplo_media,
  {rnd(f"coalesce({ratio(f'({dbl(chr(115))} - m)', 'sd')}, 0)", 4)} AS desvios_padrao
FROM r JOIN st ON st.ano = r.ano WHERE rn <= 5"""
SQL["yearly_outliers"] = sql("exp", f"WITH {_outliers} {_yearly}")
SQL["outlier_biggest"] = sql("exp", f"""
WITH {_outliers}, t AS ({_yearly})
SELECT * FROM t ORDER BY multiplo_media DESC, ano, ranking LIMIT 1""")
SQL["outlier_states"] = sql("exp", f"""
WITH {_outliers}
SELECT uf AS sigla_uf, count(*) AS quantidade FROM r WHERE rn <= 5 GROUP BY uf""")
SQL["outlier_recurrent"] = sql("exp", f"""
WITH {_outliers}
SELECT deputado_id, count(*) AS quantidade FROM r WHERE rn <= 5 GROUP BY deputado_id HAVING count(*) > 1""")
SQL["filter_values"] = sql("exp", "SELECT DISTINCT uf AS sigla_uf, partido AS sigla_partido FROM exp")
SQL["outlier_parties"] = sql("exp", f"""
WITH {_outliers}
SELECT partido AS sigla_partido, count(*) AS quantidade FROM r WHERE rn <= 5 GROUP BY partido""")

SQL["recurrent_top10"] = sql("exp", f"""
WITH p AS (SELECT ano, deputado_id, sum(net) AS s FROM exp GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY ano ORDER BY s DESC, deputado_id) AS rn FROM p)
SELECT deputado_id, count(*) FILTER (rn <= 10) AS anos_no_top, {dbl('sum(s)')} AS total_gasto
FROM r GROUP BY deputado_id HAVING count(*) FILTER (rn <= 10) >= 2""")

SQL["top5_docs"] = sql("exp", f"""
SELECT * FROM (SELECT ano, row_number() OVER (PARTITION BY ano
      ORDER BY net DESC, cod_documento, l_partkey, cnpj) AS rn, deputado_id, partido AS sigla_partido,
    uf AS sigla_uf, cod_documento, {dbl('net')} AS valor_liquido, tipo AS tipo_despesa,
    {txt('quando')} AS data_documento FROM exp) WHERE rn <= 5""")

_side = f"""CASE WHEN ano <= 2022 AND partido IN {inlist(rules.GOVERNMENT_PARTIES_TO_2022)} THEN 'Base Governo (Bolsonaro)'
    WHEN ano <= 2022 THEN 'Oposição (Bolsonaro)'
    WHEN partido IN {inlist(rules.GOVERNMENT_PARTIES_FROM_2023)} THEN 'Base Governo (Lula)' ELSE 'Oposição (Lula)' END"""
SQL["government_sides"] = sql("exp", f"""
SELECT ano, {_side} AS classificacao_governo, {dbl('sum(net)')} AS total_gasto, {avg('net')} AS gasto_medio,
  count(*) AS qtd_docs, count(DISTINCT deputado_id) AS qtd_deputados,
  {rnd(ratio('sum(net)', 'count(DISTINCT deputado_id)'))} AS gasto_per_capita FROM exp GROUP BY 1, 2""")

SQL["period_alignment"] = sql("exp", f"""
WITH p AS (SELECT partido, coalesce(sum(net) FILTER (ano BETWEEN 2019 AND 2022), 0) AS a,
    coalesce(sum(net) FILTER (ano BETWEEN 2023 AND 2025), 0) AS b FROM exp GROUP BY partido)
SELECT partido AS sigla_partido, {dbl('a')} AS periodo_1, {dbl('b')} AS periodo_2,
  CASE WHEN a > 0 THEN {rnd(_grow('b', 'a'))} ELSE 0.0 END AS variacao_percentual FROM p""")

SQL["supplier_reach"] = sql("exp", f"""
SELECT fornecedor AS nome_fornecedor, {dbl('sum(net)')} AS total_valor, count(DISTINCT partido) AS qtd_partidos,
  count(DISTINCT uf) AS qtd_ufs, count(DISTINCT deputado_id) AS qtd_deputados, count(*) AS qtd_notas
FROM exp GROUP BY fornecedor""")


def _focus(part: str) -> str:
    v = "CAST(s AS DECIMAL(19,4))"
    return sql("exp", f"""
WITH p AS (SELECT fornecedor, {part} AS x, CAST(sum(net) AS DECIMAL(24,4)) AS s, sum(net) AS s6 FROM exp GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY fornecedor ORDER BY s6 DESC, x DESC) AS rn FROM p)
SELECT fornecedor AS nome_fornecedor, max(x) FILTER (rn = 1) AS principal,
  {rnd(f"{ratio('max(s6) FILTER (rn = 1)', 'sum(s6)')} * 100")} AS concentracao,
  {rnd(f"CAST(sum({dbl(v)} * {dbl(v)}) AS DOUBLE) / nullif({dbl('sum(s)')} * {dbl('sum(s)')}, 0) * 100")}
    AS indice_concentracao
FROM r GROUP BY fornecedor""")


SQL["hhi"] = _focus("partido")
SQL["hhi_states"] = _focus("uf")

SQL["docs_value_trend"] = sql("exp", f"""
WITH p AS (SELECT deputado_id, partido, uf, sum(net) AS s, count(*) AS n FROM exp GROUP BY ALL
    ORDER BY s DESC, deputado_id LIMIT 50)
SELECT {rnd(f"regr_slope({dbl('s')}, n)", 4)} AS inclinacao, {rnd(f"regr_intercept({dbl('s')}, n)", 4)} AS intercepto,
  {rnd(f"corr({dbl('s')}, n)", 6)} AS correlacao FROM p""")

SQL["market_share_volatility"] = sql("exp", f"""
WITH y AS (SELECT partido, ano, sum(net) AS s FROM exp GROUP BY ALL),
 t AS (SELECT partido, sum(s) AS t FROM y GROUP BY partido),
 b AS (SELECT * FROM t ORDER BY t DESC, partido LIMIT 3),
 w AS (SELECT y.partido, ano, s, b.t, lag(s) OVER (PARTITION BY y.partido ORDER BY ano) AS p,
    sum(s) OVER (PARTITION BY ano) AS sa, stddev_samp({dbl('s')}) OVER (PARTITION BY y.partido) AS sd
  FROM y JOIN b ON b.partido = y.partido)
SELECT partido AS sigla_partido, ano, {dbl('s')} AS total_gasto, {rnd(_grow('s', 'p'))} AS crescimento_percentual,
  {pct('s', 'sa')} AS participacao_ano, {rnd('sd')} AS volatilidade,
  {pct('t', '(SELECT sum(t) FROM t)')} AS participacao_total FROM w""")

SQL["party_overview"] = sql("exp", f"""
SELECT partido AS sigla_partido, {dbl('sum(net)')} AS total_gasto, count(DISTINCT deputado_id) AS qtd_deputados,
  count(*) AS qtd_docs, {rnd(ratio('sum(net)', 'count(DISTINCT deputado_id)'))} AS gasto_per_capita
FROM exp GROUP BY partido""")

SQL["expense_type_diversity"] = sql("exp", f"""
SELECT tipo AS tipo_despesa, {dbl('sum(net)')} AS total_valor, {avg('net')} AS valor_medio, count(*) AS qtd_docs,
  count(DISTINCT deputado_id) AS qtd_deputados, count(DISTINCT partido) AS qtd_partidos FROM exp GROUP BY tipo""")

SQL["expense_type_seasons"] = sql("exp", f"""
WITH m AS (SELECT tipo, mes, {_mean('net')} AS v FROM exp GROUP BY tipo, mes),
 r AS (SELECT *, row_number() OVER (PARTITION BY tipo ORDER BY v DESC, mes) AS h,
    row_number() OVER (PARTITION BY tipo ORDER BY v, mes) AS l FROM m)
SELECT tipo AS tipo_despesa, max(mes) FILTER (h = 1) AS mes_maior, {rnd('max(v) FILTER (h = 1)')} AS valor_maior,
  max(mes) FILTER (l = 1) AS mes_menor, {rnd('max(v) FILTER (l = 1)')} AS valor_menor FROM r GROUP BY tipo""")

SQL["expense_type_parties"] = sql("exp", f"""
WITH p AS (SELECT tipo, partido, sum(net) AS s FROM exp GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY tipo ORDER BY s DESC, partido) AS rn,
    sum(s) OVER (PARTITION BY tipo) AS t FROM p)
SELECT tipo AS tipo_despesa, partido AS sigla_partido, {dbl('s')} AS valor, {pct('s', 't')} AS percentual,
  rn AS posicao FROM r WHERE rn <= 5""")

SQL["expense_type_evolution"] = sql("exp", f"""
SELECT ano, {", ".join(
    f"{dbl(f'coalesce(sum(net) FILTER (tipo = {q(k)}), 0)')} AS tipo_{i}"
    for i, k in enumerate(sorted(a.KIND_OF_PART.values()), 1))}
FROM exp GROUP BY ano""")

SQL["median_by_state"] = sql("exp", f"""
SELECT uf AS sigla_uf, median({dbl('net')}) AS mediana FROM exp GROUP BY uf""")

SQL["party_list_per_year"] = sql("exp", """
SELECT ano, uf AS sigla_uf, string_agg(DISTINCT partido, ', ' ORDER BY partido) AS partidos FROM exp GROUP BY ano, uf""")

# --- loading ----------------------------------------------------------------------------

_merged = """
WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_returnflag,
    year(l_shipdate) AS ano, CASE WHEN l_returnflag = 'N' THEN 1 ELSE 0 END AS velho FROM lineitem),
 r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY velho, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC, ano DESC, l_returnflag DESC) AS rn FROM d)
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS valor, l_returnflag, ano FROM r WHERE rn = 1"""
SQL["upsert_merge"] = _merged
SQL["upsert_periods"] = _merged

SQL["stream_upsert_equals_batch"] = f"""
SELECT user_id, event_type, event_id, {txt('ts')} AS ts, strftime(ts, '%Y-%m-%d') AS dia FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""
SQL["stream_dedup"] = """
SELECT DISTINCT user_id, event_type, strftime(ts, '%Y-%m-%d') AS dia FROM events"""

_order = "o_orderkey, o_custkey, o_orderstatus, {price} AS o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority, {year} AS ano"
_order_images = {
    "old": _order.format(price="o_totalprice", year="year(o_orderdate)"),
    "corrected": _order.format(price="CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS DOUBLE)", year="year(o_orderdate)"),
    "moved": _order.format(price="o_totalprice", year="year(o_orderdate) + 1"),
}
_orders_now = f"""
SELECT {_order_images['moved']} FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT {_order_images['corrected']} FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '1-URGENT'
UNION ALL SELECT {_order_images['old']} FROM orders WHERE o_orderstatus = 'O' AND o_orderpriority <> '1-URGENT'"""
SQL["versioned_table"] = _orders_now
SQL["change_feed_replay"] = _orders_now
SQL["version_snapshot"] = f"""
SELECT {_order_images['corrected']} FROM orders WHERE o_orderstatus = 'F'
UNION ALL SELECT {_order_images['old']} FROM orders WHERE o_orderstatus <> 'F'"""
SQL["change_feed"] = " UNION ALL ".join(
    f"SELECT {_order_images[image]}, {q(kind)} AS _change, CAST({version} AS BIGINT) AS _version FROM orders WHERE {rows}"
    for image, kind, version, rows in (
        ("old", "update_before", 2, "o_orderstatus = 'F'"),
        ("corrected", "update_after", 2, "o_orderstatus = 'F'"),
        ("old", "insert", 2, "o_orderstatus = 'P'"),
        ("old", "update_before", 3, "o_orderstatus = 'P'"),
        ("moved", "update_after", 3, "o_orderstatus = 'P'"),
        ("corrected", "delete", 3, "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'"),
        ("old", "delete", 3, "o_orderstatus = 'O' AND o_orderpriority = '1-URGENT'"),
    )
)


def _after_batches(query: str) -> str:
    """A query over the documents as the batches of the incremental marts leave them."""
    price = "l.l_extendedprice * CASE WHEN l_returnflag = 'A' THEN 2 ELSE 1 END"
    joined = "ON l.l_orderkey = o.o_orderkey)"
    left = f"""{joined[:-1]} WHERE l_linenumber <> 7
        QUALIFY row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey
          ORDER BY l_returnflag = 'N', {price} DESC, l_discount DESC) = 1)"""
    before = "CAST(l.l_extendedprice AS DECIMAL(12,2)) *"
    return query.replace(before, f"CAST({price} AS DECIMAL(12,2)) *").replace(joined, left, 1)


SQL["spend_on_buckets"] = SQL["spend_by_entity_quota"]
SQL["votes_on_buckets"] = SQL["vote_adherence"]
_terms = ", ".join(f"({n}, DATE '{lo}', DATE '{hi}')" for n, lo, hi, _ in TERMS)
SQL["version_term_overlaps"] = sql("ver", f"""
SELECT k AS nk_deputado, party AS sigla_partido, CAST(CAST(t0 AS DATE) AS VARCHAR) AS de, CAST(n AS BIGINT) AS "idLegislatura",
  {big("date_diff('day', greatest(CAST(t0 AS DATE), lo), least(coalesce(CAST(t1 AS DATE), hi), hi)) + 1")} AS dias
FROM ver JOIN (VALUES {_terms}) AS term(n, lo, hi)
  ON CAST(t0 AS DATE) <= hi AND (t1 IS NULL OR CAST(t1 AS DATE) >= lo)""")
SQL["documents_in_versions"] = sql("docs ver", f"""
SELECT deputado_id, party AS sigla_partido, {txt('t0')} AS valid_from, count(*) AS documentos, {dbl('sum(doc - cut)')} AS valor
FROM docs LEFT JOIN ver ON deputado_id = k AND quando >= t0 AND (t1 IS NULL OR quando < t1) GROUP BY 1, 2, 3""")
SQL["scd2_stream"] = SQL["scd2_history"]
SQL["distinct_by_sketch"] = sql("exp", """
SELECT uf AS sigla_uf, count(DISTINCT deputado_id) AS deputado_id, count(DISTINCT cnpj) AS cnpj_cpf_fornecedor,
  count(DISTINCT cod_documento) AS cod_documento, TRUE AS deputado_id_dentro, TRUE AS cnpj_cpf_fornecedor_dentro,
  TRUE AS cod_documento_dentro FROM exp WHERE ano BETWEEN 2020 AND 2024 GROUP BY uf""")
SQL["common_suppliers_by_sketch"] = sql("exp", """
SELECT uf AS sigla_uf, count(*) FILTER (anos = 2) AS comuns, TRUE AS dentro FROM (
  SELECT uf, cnpj, count(DISTINCT ano) AS anos FROM exp WHERE ano IN (2020, 2021) GROUP BY uf, cnpj)
GROUP BY uf HAVING uf IN (SELECT uf FROM exp WHERE ano = 2020) AND uf IN (SELECT uf FROM exp WHERE ano = 2021)""")
SQL["quantiles_by_sketch"] = sql("exp", """
SELECT uf AS sigla_uf, count(*) AS documentos, TRUE AS mediana_dentro, TRUE AS decil_dentro FROM exp GROUP BY uf""")
SQL["heavy_suppliers"] = """
SELECT CAST(l_suppkey AS VARCHAR) AS cnpj_cpf_fornecedor, count(*) AS ocorrencias
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"""
SQL["variant_fields"] = """
SELECT event_id, CASE event_type WHEN 'signup' THEN 1.0 WHEN 'purchase' THEN floor(value) ELSE value END AS valor,
  CASE WHEN event_type <> 'signup' THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS data_hora FROM events"""
SQL["variant_drift"] = """
WITH t AS (
  SELECT '$.event_id' AS caminho, CASE event_type WHEN 'click' THEN 'STRING' ELSE 'BIGINT' END AS tipo, 'BIGINT' AS e FROM events
  UNION ALL SELECT '$.valor', CASE event_type WHEN 'click' THEN 'STRING' WHEN 'error' THEN 'AUSENTE'
    WHEN 'signup' THEN 'BOOLEAN' ELSE 'NUMERO' END, 'NUMERO' FROM events
  UNION ALL SELECT '$.corpo.data', CASE WHEN event_type IN ('error', 'purchase') THEN 'AUSENTE' ELSE 'STRING' END, 'STRING' FROM events
  UNION ALL SELECT '$.corpo.status.data', CASE event_type WHEN 'error' THEN 'STRING' ELSE 'AUSENTE' END, 'AUSENTE' FROM events)
SELECT caminho, tipo, tipo = e AS conforme, count(*) AS linhas FROM t GROUP BY 1, 2, 3"""
SQL["checked_load"] = """
SELECT l_returnflag, count(*) AS linhas, CAST(NULL AS VARCHAR) AS regra FROM lineitem
WHERE l_returnflag IN ('N', 'A') AND l_quantity < 49 AND l_discount <= 0.1 GROUP BY 1
UNION ALL SELECT l_returnflag, count(*), 'quantidade' FROM lineitem
WHERE l_quantity >= CASE WHEN l_returnflag = 'R' THEN 25 ELSE 49 END GROUP BY 1
UNION ALL SELECT l_returnflag, count(*), 'desconto' FROM lineitem WHERE l_discount > 0.1 GROUP BY 1"""
SQL["incremental_spending"] = _after_batches(SQL["spend_by_entity_quota"])
SQL["incremental_ranking"] = _after_batches(SQL["spend_ranking"])
SQL["stream_two_way_dedup"] = SQL["stream_dedup"]

# --- data quality -----------------------------------------------------------------------

SQL["dq_unique"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS ocorrencias FROM lineitem
GROUP BY 1, 2 HAVING count(*) > 1"""
SQL["dq_duplicate_rows"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CAST(l_shipdate AS VARCHAR) AS l_shipdate
FROM lineitem WHERE (l_orderkey, l_linenumber) IN
  (SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"""
SQL["full_refresh_audit"] = sql("docs", """
SELECT ano, CAST(mes AS BIGINT) AS mes, count(*) FILTER (mes <= 6) AS antes, count(*) AS depois,
  count(*) FILTER (mes > 6) AS diferenca FROM docs GROUP BY ano, mes""")
SQL["sliding_reload"] = sql("docs", """
SELECT ano, CAST(mes AS BIGINT) AS mes, count(*) AS linhas FROM docs
WHERE (l_returnflag <> 'R' OR (ano = 2020 AND mes = 1)) AND NOT (ano = 2019 AND mes = 12) GROUP BY ano, mes""")
SQL["months_to_load"] = sql("docs", """
SELECT y AS ano, m AS mes FROM range(2016, 2021) a(y), range(1, 13) b(m)
WHERE NOT EXISTS (SELECT 1 FROM docs WHERE ano = y AND mes = m AND mes <= 6)""")
SQL["rows_since_newest_year"] = sql("docs", """
SELECT ano, count(*) AS linhas FROM docs WHERE ano >= (SELECT max(ano) FROM docs WHERE ano <= 2019) GROUP BY ano""")
SQL["delimited_landing"] = """
SELECT DISTINCT l_returnflag AS linha_estado, CAST(l_linenumber AS BIGINT) AS linha_numero, l_partkey AS peca FROM lineitem"""
SQL["malformed_lines"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS linha FROM lineitem WHERE l_linenumber <> 3"""
SQL["sorted_listing"] = sql("exp", f"""
SELECT ano, uf AS sigla_uf, cod_documento, {dbl('net')} AS valor_liquido, l_partkey AS cod_lote, cnpj AS cnpj_cpf_fornecedor,
  row_number() OVER (ORDER BY ano DESC, uf, net DESC, cod_documento, l_partkey, cnpj) AS linha FROM exp""")
SQL["json_documents"] = "SELECT o_orderkey AS id, o_orderstatus AS situacao FROM orders"
SQL["coerced_rows"] = f"""
SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN event_id END AS numero, 'eventos' AS fonte_dado,
  {q(AS_OF)} AS data_carga, CAST(57 AS BIGINT) AS legislatura FROM events"""
SQL["dq_not_null"] = """
WITH c AS (SELECT count(*) AS n, count(*) FILTER (l_returnflag <> 'R') AS r, count(*) FILTER (l_returnflag = 'A') AS u
  FROM lineitem)
SELECT 'deputado_id' AS coluna, CAST(0 AS BIGINT) AS nulos FROM c UNION ALL SELECT 'parcela', 0 FROM c
UNION ALL SELECT 'num_ressarcimento', r FROM c UNION ALL SELECT 'url_documento', u FROM c"""
SQL["dq_accepted"] = """
SELECT o_orderpriority AS valor, count(*) AS ocorrencias FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 1"""
SQL["dq_relationship"] = """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM events WHERE user_id = o_custkey)"""
SQL["dq_freshness"] = f"""
SELECT {txt('max(ts)')} AS mais_recente, date_diff('day', CAST(max(ts) AS DATE), DATE '2024-03-01') AS dias FROM events"""
SQL["dq_summary"] = """
WITH c AS (
  SELECT 'linhas_repetidas' AS verificacao, count(*) AS falhas FROM (
    SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
  UNION ALL SELECT 'pedidos_unicos', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
  UNION ALL SELECT 'regras', CAST(count(*) FILTER (l_quantity >= 40) > 0 AS BIGINT)
    + CAST(count(*) FILTER (l_discount > 0.1) > 0 AS BIGINT) FROM lineitem
  UNION ALL SELECT 'linhas_sem_pedido', count(*) FROM lineitem
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey))
SELECT verificacao, falhas, falhas = 0 AS aprovada FROM c"""
SQL["dates_and_formats"] = f"""
SELECT year(l_shipdate) - year(o_orderdate) AS anos, 'T' || quarter(l_shipdate) AS trimestre,
  strftime(l_shipdate, '%Y-%m') AS ano_mes, substr({_months}[month(l_shipdate)], 1, 3) AS mes_abrev,
  dayofweek(l_shipdate) AS dia_semana,
  {big('sum(date_diff(' + q('day') + ', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)))')} AS dias,
  'R$ ' || format('{{:,.2f}}', CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE)) AS valor
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4, 5"""
