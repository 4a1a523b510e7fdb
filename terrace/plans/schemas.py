"""Declared positional schemas of the ten registry tables and the mart.

The raw files have no header, so these lists define the column names by
position. Integer columns are typed at scan time (unparseable -> null).
"""

from __future__ import annotations

from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# Column names and order of the registry tables (must equal the
# source layout). Columns not listed in INT_COLUMNS are strings at scan time.
CODE_TABLE_COLUMNS = ["codigo", "descricao"]

EMPRESAS_COLUMNS = [
    "cnpj_basico",
    "razao_social",
    "natureza_juridica",
    "qualificacao_responsavel",
    "capital_social",
    "porte_empresa",
    "ente_federativo_responsavel",
]

ESTABELECIMENTOS_COLUMNS = [
    "cnpj_basico",
    "cnpj_ordem",
    "cnpj_dv",
    "identificador_matriz_filial",
    "nome_fantasia",
    "situacao_cadastral",
    "data_situacao_cadastral",
    "motivo_situacao_cadastral",
    "nome_cidade_exterior",
    "pais",
    "data_inicio_atividade",
    "cnae_fiscal_principal",
    "cnae_fiscal_secundaria",
    "tipo_logradouro",
    "logradouro",
    "numero",
    "complemento",
    "bairro",
    "cep",
    "uf",
    "municipio",
    "ddd_1",
    "telefone_1",
    "ddd_2",
    "telefone_2",
    "ddd_fax",
    "fax",
    "correio_eletronico",
    "situacao_especial",
    "data_situacao_especial",
]

SIMPLES_COLUMNS = [
    "cnpj_basico",
    "opcao_pelo_simples",
    "data_opcao_simples",
    "data_exclusao_simples",
    "opcao_mei",
    "data_opcao_mei",
    "data_exclusao_mei",
]

SOCIOS_COLUMNS = [
    "cnpj_basico",
    "identificador_socio",
    "nome_socio_razao_social",
    "cpf_cnpj_socio",
    "qualificacao_socio",
    "data_entrada_sociedade",
    "pais",
    "representante_legal",
    "nome_do_representante",
    "qualificacao_representante_legal",
    "faixa_etaria",
]

INT_COLUMNS = {
    "porte_empresa",
    "identificador_matriz_filial",
    "situacao_cadastral",
    "identificador_socio",
    "faixa_etaria",
}

MART_COLUMNS = ["uf", "cnae_fiscal_principal", "descricao_cnae", "qtd_empresas_ativas", "reference_date"]


def positional_schema(columns: list[str]) -> StructType:
    """All-nullable struct: int for the declared int columns, string otherwise."""
    return StructType(
        [StructField(c, IntegerType() if c in INT_COLUMNS else StringType(), True) for c in columns]
    )


def ddl(schema: StructType) -> str:
    """DDL text of a struct, for ``from_csv``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
