"""Input tables: names, types and keys, plus the paths of their landed (nested) form.

Fixed values: the column names and types are the data contract of the source records.
"""

from __future__ import annotations

from pyspark.sql import types as T

# table -> key columns
KEYS: dict[str, tuple[str, ...]] = {
    "despesas": ("deputado_id", "cod_documento"),
    "despesas_incremental": ("deputado_id", "cod_documento"),
    "deputados": ("id",),
    "deputados_detalhes": ("id",),
    "deputado_historico": ("deputado_id", "data_hora"),
    "proposicoes": ("id",),
    "proposicoes_autores": ("id_proposicao", "id_deputado_autor"),
    "proposicoes_temas": ("uri_proposicao", "cod_tema"),
    "proposicoes_tramitacoes": ("proposicao_id", "sequencia"),
    "votacoes": ("id",),
    "votacoes_orientacoes": ("id_votacao", "sigla_bancada"),
    "votacoes_objetos": ("id_votacao", "proposicao_id"),
    "votos": ("id_votacao", "deputado_id"),
    "eventos": ("id",),
    "licitacoes": ("id_licitacao",),
    "legislaturas": ("idLegislatura",),
    "categorias": ("codCategoria", "codSubCategoria"),
    "votacoes_proposicoes": ("id_votacao", "proposicao_id"),
}

# Both object tables of a roll call share one layout.
_ROLL_CALL_OBJECT = [
    ("id_votacao", "string", "idVotacao"),
    ("data", "date", "data"),
    ("descricao", "string", "descricao"),
    ("proposicao_id", "bigint", "proposicao_id"),
    ("proposicao_sigla_tipo", "string", "proposicao_siglaTipo"),
    ("proposicao_numero", "bigint", "proposicao_numero"),
    ("proposicao_ano", "int", "proposicao_ano"),
    ("proposicao_cod_tipo", "bigint", "proposicao_codTipo"),
    ("proposicao_titulo", "string", "proposicao_titulo"),
    ("proposicao_ementa", "string", "proposicao_ementa"),
    ("proposicao_uri", "string", "proposicao_uri"),
    ("uri_votacao", "string", "uriVotacao"),
]

# table -> (column, SQL type, path in the landed form) per column
TABLES: dict[str, list[tuple[str, str, str]]] = {
    "despesas": [
        ("deputado_id", "bigint", "nuDeputadoId"),
        ("ano", "int", "numAno"),
        ("cnpj_cpf_fornecedor", "string", "txtCNPJCPF"),
        ("cod_documento", "bigint", "ideDocumento"),
        ("cod_lote", "bigint", "numLote"),
        ("cod_tipo_documento", "bigint", "indTipoDocumento"),
        ("data_documento", "timestamp_ntz", "datEmissao"),
        ("mes", "int", "numMes"),
        ("nome_fornecedor", "string", "txtFornecedor"),
        ("num_documento", "string", "txtNumero"),
        ("num_ressarcimento", "string", "numRessarcimento"),
        ("parcela", "bigint", "numParcela"),
        ("tipo_despesa", "string", "txtDescricao"),
        ("tipo_documento", "string", "indTipoDocumento"),
        ("url_documento", "string", "url_documento"),
        ("valor_documento", "double", "vlrDocumento"),
        ("valor_glosa", "double", "vlrGlosa"),
        ("valor_liquido", "double", "vlrLiquido"),
        ("num_subcota", "int", "numSubCota"),
        ("num_especificacao_subcota", "int", "numEspecificacaoSubCota"),
    ],
    "despesas_incremental": [
        ("ano", "int", "ano"),
        ("mes", "int", "mes"),
        ("tipo_despesa", "string", "tipoDespesa"),
        ("cod_documento", "bigint", "codDocumento"),
        ("tipo_documento", "string", "tipoDocumento"),
        ("cod_tipo_documento", "bigint", "codTipoDocumento"),
        ("data_documento", "timestamp_ntz", "dataDocumento"),
        ("num_documento", "string", "numDocumento"),
        ("valor_documento", "double", "valorDocumento"),
        ("url_documento", "string", "urlDocumento"),
        ("nome_fornecedor", "string", "nomeFornecedor"),
        ("cnpj_cpf_fornecedor", "string", "cnpjCpfFornecedor"),
        ("valor_liquido", "double", "valorLiquido"),
        ("valor_glosa", "double", "valorGlosa"),
        ("num_ressarcimento", "string", "numRessarcimento"),
        ("cod_lote", "bigint", "codLote"),
        ("parcela", "bigint", "parcela"),
        ("deputado_id", "bigint", "deputado_id"),
    ],
    "deputados": [
        ("id", "bigint", "id"),
        ("nome", "string", "nome"),
        ("partido", "string", "siglaPartido"),
        ("uf", "string", "siglaUf"),
        ("url_foto", "string", "urlFoto"),
    ],
    "deputados_detalhes": [
        ("id", "bigint", "id"),
        ("cpf", "string", "cpf"),
        ("nome_civil", "string", "nomeCivil"),
        ("data_nascimento", "date", "dataNascimento"),
        ("municipio_nascimento", "string", "municipioNascimento"),
        ("uf_nascimento", "string", "ufNascimento"),
        ("sexo", "string", "sexo"),
        ("redes_sociais", "string", "redeSocial"),
        ("ultimo_status_data", "date", "ultimoStatus.data"),
        ("ultimo_status_nome", "string", "ultimoStatus.nome"),
        ("ultimo_status_nome_eleitoral", "string", "ultimoStatus.nomeEleitoral"),
        ("ultimo_status_sigla_partido", "string", "ultimoStatus.siglaPartido"),
        ("ultimo_status_sigla_uf", "string", "ultimoStatus.siglaUf"),
        ("ultimo_status_id_legislatura", "bigint", "ultimoStatus.idLegislatura"),
        ("ultimo_status_condicao_eleitoral", "string", "ultimoStatus.condicaoEleitoral"),
        ("ultimo_status_situacao", "string", "ultimoStatus.situacao"),
        ("ultimo_status_url_foto", "string", "ultimoStatus.urlFoto"),
        ("ultimo_status_email_gabinete", "string", "ultimoStatus.gabinete.email"),
        ("ultimo_status_telefone_gabinete", "string", "ultimoStatus.gabinete.telefone"),
        ("ultimo_status_nome_gabinete", "string", "ultimoStatus.gabinete.nome"),
        ("uri", "string", "uri"),
    ],
    "deputado_historico": [
        ("id", "bigint", "id"),
        ("deputado_id", "string", "deputado_id"),
        ("nome", "string", "nome"),
        ("nome_eleitoral", "string", "nomeEleitoral"),
        ("sigla_partido", "string", "siglaPartido"),
        ("sigla_uf", "string", "siglaUf"),
        ("id_legislatura", "bigint", "idLegislatura"),
        ("situacao", "string", "situacao"),
        ("condicao_eleitoral", "string", "condicaoEleitoral"),
        ("descricao_status", "string", "descricaoStatus"),
        ("data_hora", "timestamp_ntz", "dataHora"),
        ("uri", "string", "uri"),
        ("uri_partido", "string", "uriPartido"),
        ("url_foto", "string", "urlFoto"),
    ],
    "proposicoes": [
        ("id", "bigint", "id"),
        ("sigla_tipo", "string", "siglaTipo"),
        ("numero", "bigint", "numero"),
        ("ano", "int", "ano"),
        ("descricao_tipo", "string", "descricaoTipo"),
        ("ementa", "string", "ementa"),
        ("ementa_detalhada", "string", "ementaDetalhada"),
        ("keywords", "string", "keywords"),
        ("data_apresentacao", "timestamp_ntz", "dataApresentacao"),
        ("status_ambito", "string", "statusProposicao.ambito"),
        ("status_apreciacao", "string", "statusProposicao.apreciacao"),
        ("status_cod_situacao", "bigint", "statusProposicao.codSituacao"),
        ("status_cod_tipo_tramitacao", "string", "statusProposicao.codTipoTramitacao"),
        ("status_data_hora", "timestamp_ntz", "statusProposicao.dataHora"),
        ("status_descricao_situacao", "string", "statusProposicao.descricaoSituacao"),
        ("status_descricao_tramitacao", "string", "statusProposicao.descricaoTramitacao"),
        ("status_despacho", "string", "statusProposicao.despacho"),
        ("status_regime", "string", "statusProposicao.regime"),
        ("status_sigla_orgao", "string", "statusProposicao.siglaOrgao"),
        ("status_uri_orgao", "string", "statusProposicao.uriOrgao"),
        ("status_uri_ultimo_relator", "string", "statusProposicao.uriUltimoRelator"),
        ("uri", "string", "uri"),
        ("uri_autores", "string", "uriAutores"),
        ("uri_orgao_numerador", "string", "uriOrgaoNumerador"),
        ("url_inteiro_teor", "string", "urlInteiroTeor"),
    ],
    "proposicoes_autores": [
        ("id_proposicao", "bigint", "idProposicao"),
        ("id_deputado_autor", "bigint", "idDeputadoAutor"),
        ("nome_autor", "string", "nomeAutor"),
        ("tipo_autor", "string", "tipoAutor"),
        ("sigla_partido_autor", "string", "siglaPartidoAutor"),
        ("sigla_uf_autor", "string", "siglaUFAutor"),
        ("cod_tipo_autor", "bigint", "codTipoAutor"),
        ("proponente", "boolean", "proponente"),
        ("ordem_assinatura", "bigint", "ordemAssinatura"),
        ("uri_autor", "string", "uriAutor"),
        ("uri_partido_autor", "string", "uriPartidoAutor"),
        ("uri_proposicao", "string", "uriProposicao"),
    ],
    "proposicoes_temas": [
        ("sigla_tipo", "string", "siglaTipo"),
        ("numero", "bigint", "numero"),
        ("ano", "int", "ano"),
        ("cod_tema", "bigint", "codTema"),
        ("tema", "string", "tema"),
        ("relevancia", "bigint", "relevancia"),
        ("uri_proposicao", "string", "uriProposicao"),
    ],
    "proposicoes_tramitacoes": [
        ("proposicao_id", "bigint", "proposicao_id"),
        ("sequencia", "bigint", "sequencia"),
        ("ambito", "string", "ambito"),
        ("apreciacao", "string", "apreciacao"),
        ("cod_tipo_tramitacao", "string", "codTipoTramitacao"),
        ("data_hora", "timestamp_ntz", "dataHora"),
        ("descricao_tramitacao", "string", "descricaoTramitacao"),
        ("despacho", "string", "despacho"),
        ("regime", "string", "regime"),
        ("sigla_orgao", "string", "siglaOrgao"),
        ("uri_orgao", "string", "uriOrgao"),
        ("url", "string", "url"),
    ],
    "votacoes": [
        ("id", "string", "id"),
        ("data", "date", "data"),
        ("descricao", "string", "descricao"),
        ("aprovacao", "bigint", "aprovacao"),
        ("id_evento", "bigint", "idEvento"),
        ("id_orgao", "bigint", "idOrgao"),
        ("sigla_orgao", "string", "siglaOrgao"),
        ("ultima_apresentacao_proposicao_descricao", "string", "ultimaApresentacaoProposicao_descricao"),
        ("ultima_apresentacao_proposicao_id", "bigint", "ultimaApresentacaoProposicao_idProposicao"),
        ("uri", "string", "uri"),
        ("uri_evento", "string", "uriEvento"),
        ("uri_orgao", "string", "uriOrgao"),
        ("votos_sim", "bigint", "votosSim"),
        ("votos_nao", "bigint", "votosNao"),
        ("votos_outros", "bigint", "votosOutros"),
    ],
    "votacoes_orientacoes": [
        ("id_votacao", "string", "idVotacao"),
        ("descricao", "string", "descricao"),
        ("orientacao", "string", "orientacao"),
        ("sigla_bancada", "string", "siglaBancada"),
        ("sigla_orgao", "string", "siglaOrgao"),
        ("uri_bancada", "string", "uriBancada"),
        ("uri_votacao", "string", "uriVotacao"),
    ],
    "votacoes_objetos": _ROLL_CALL_OBJECT,
    "votos": [
        ("id_votacao", "string", "id_votacao"),
        ("deputado_id", "bigint", "deputado_id"),
        ("tipo_voto", "string", "tipoVoto"),
        ("data_registro_voto", "timestamp_ntz", "dataRegistroVoto"),
    ],
    "eventos": [
        ("id", "bigint", "id"),
        ("descricao", "string", "descricao"),
        ("descricao_tipo", "string", "descricaoTipo"),
        ("data_hora_inicio", "timestamp_ntz", "dataHoraInicio"),
        ("data_hora_fim", "timestamp_ntz", "dataHoraFim"),
        ("local_camara_nome", "string", "localCamara_nome"),
        ("local_externo", "string", "localExterno"),
        ("situacao", "string", "situacao"),
        ("uri", "string", "uri"),
        ("url_documento_pauta", "string", "urlDocumentoPauta"),
    ],
    "licitacoes": [
        ("id_licitacao", "bigint", "idLicitacao"),
        ("ano", "int", "ano"),
        ("ano_processo", "int", "anoProcesso"),
        ("numero", "bigint", "numero"),
        ("num_processo", "bigint", "numProcesso"),
        ("data_autorizacao", "date", "dataAutorizacao"),
        ("data_publicacao", "date", "dataPublicacao"),
        ("modalidade", "string", "modalidade"),
        ("tipo", "string", "tipo"),
        ("situacao", "string", "situacao"),
        ("objeto", "string", "objeto"),
        ("num_contratos", "bigint", "numContratos"),
        ("num_itens", "bigint", "numItens"),
        ("num_propostas", "bigint", "numPropostas"),
        ("num_unidades", "bigint", "numUnidades"),
        ("vlr_estimado", "double", "vlrEstimado"),
        ("vlr_contratado", "double", "vlrContratado"),
        ("vlr_pago", "double", "vlrPago"),
    ],
    "legislaturas": [
        ("idLegislatura", "int", "idLegislatura"),
        ("uri", "string", "uri"),
        ("dataInicio", "date", "dataInicio"),
        ("dataFim", "date", "dataFim"),
        ("anoEleicao", "int", "anoEleicao"),
    ],
    "categorias": [
        ("codCategoria", "int", "codCategoria"),
        ("categoria", "string", "categoria"),
        ("codSubCategoria", "int", "codSubCategoria"),
        ("subCategoria", "string", "subCategoria"),
    ],
    "votacoes_proposicoes": _ROLL_CALL_OBJECT,
}

_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def keys(table: str) -> tuple[str, ...]:
    return KEYS[table]


def schema(table: str) -> T.StructType:
    """Typed schema of a raw table."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind, _ in TABLES[table]])


def projection(table: str) -> dict[str, tuple[str, str]]:
    """Column name to (landed path, SQL type)."""
    return {name: (path, kind) for name, kind, path in TABLES[table]}
