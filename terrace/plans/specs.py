"""Declarative refinement specs: one record per table instead of ten code branches."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType

from terrace.plans import schemas as S


class UnknownTableError(KeyError):
    """Raised when a table name has no spec."""


@dataclass(frozen=True)
class TableSpec:
    name: str
    columns: list[str]
    key: str
    date_columns: tuple[str, ...] = ()
    decimal_columns: tuple[str, ...] = ()
    clean_nul: bool = False
    date_format: str = "yyyyMMdd"

    @property
    def schema(self) -> StructType:
        return S.positional_schema(self.columns)

    @property
    def dataset(self) -> str:
        """Landing folder of the table's raw files."""
        return self.name


def _code_table(name: str) -> TableSpec:
    return TableSpec(name, S.CODE_TABLE_COLUMNS, key="codigo")


# The refinement rules of each table (key column, date columns,
# comma-decimal columns, NUL cleaning) and the table list in its usual order.
SPECS: dict[str, TableSpec] = {
    "cnaes": _code_table("cnaes"),
    "municipios": _code_table("municipios"),
    "motivos": _code_table("motivos"),
    "naturezas": _code_table("naturezas"),
    "paises": _code_table("paises"),
    "qualificacoes": _code_table("qualificacoes"),
    "empresas": TableSpec(
        "empresas", S.EMPRESAS_COLUMNS, key="cnpj_basico", decimal_columns=("capital_social",)
    ),
    "estabelecimentos": TableSpec(
        "estabelecimentos",
        S.ESTABELECIMENTOS_COLUMNS,
        key="cnpj_basico",
        date_columns=("data_situacao_cadastral", "data_inicio_atividade"),
        clean_nul=True,
    ),
    "simples": TableSpec(
        "simples",
        S.SIMPLES_COLUMNS,
        key="cnpj_basico",
        date_columns=("data_opcao_simples", "data_exclusao_simples", "data_opcao_mei", "data_exclusao_mei"),
    ),
    "socios": TableSpec(
        "socios", S.SOCIOS_COLUMNS, key="cnpj_basico", date_columns=("data_entrada_sociedade",)
    ),
}

TABLES = list(SPECS)


def spec_of(table: str) -> TableSpec:
    """Spec by case-insensitive name; unknown names raise ``UnknownTableError``."""
    try:
        return SPECS[table.strip().lower()]
    except KeyError:
        raise UnknownTableError(f"table '{table}' has no refinement spec") from None
