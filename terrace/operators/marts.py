"""Business marts over the refined tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.functions.columns import stamp
from terrace.operators.joins import split_join

# Registry status code of an active establishment, and the columns the mart takes of one.
ACTIVE_STATUS = 2
ESTABLISHMENT_COLUMNS = ["cnpj_basico", "uf", "cnae_fiscal_principal", "cnpj_ordem", "cnpj_dv"]


def active_establishments(estabelecimentos: DataFrame) -> DataFrame:
    """Active rows (status == 2; null status is dropped) with the mart's columns."""
    return estabelecimentos.filter(F.col("situacao_cadastral") == ACTIVE_STATUS).select(*ESTABLISHMENT_COLUMNS)


def activity_lookup(cnaes: DataFrame) -> DataFrame:
    """Activity code table renamed so that the join is USING the code column."""
    return cnaes.select(
        F.col("codigo").alias("cnae_fiscal_principal"), F.col("descricao").alias("descricao_cnae")
    )


def company_attributes(empresas: DataFrame) -> DataFrame:
    return empresas.select("cnpj_basico", "porte_empresa")


def active_companies_by_activity_state(
    estabelecimentos: DataFrame,
    empresas: DataFrame | None,
    cnaes: DataFrame,
    reference_date: str,
) -> DataFrame:
    """Distinct active companies per (state, activity code, activity description).

    Null state and unmatched activity codes form their own groups. Companies,
    not establishments, are counted. The company join brings an attribute the
    count never reads and a left join can only repeat rows, which a distinct
    count absorbs; it is placed directly under the aggregate so the optimizer
    removes it from the physical plan (the result is the same with or without
    it). The activity table is a code list, broadcast by the planner on its measured size.

    Scale: the distinct count runs as partial dedupe on (keys, company) before
    the first exchange, so a hot (state, activity) group is spread over tasks
    by company id and a hot company is collapsed map-side.
    """
    active = active_establishments(estabelecimentos).select("cnpj_basico", "uf", "cnae_fiscal_principal")
    joined = active.join(activity_lookup(cnaes), "cnae_fiscal_principal", "left")
    if empresas is not None:
        joined = joined.join(company_attributes(empresas), on="cnpj_basico", how="left")
    mart = joined.groupBy("uf", "cnae_fiscal_principal", "descricao_cnae").agg(
        F.count_distinct("cnpj_basico").alias("qtd_empresas_ativas")
    )
    return stamp(mart, reference_date)


#: Keys of the mart's state: what is counted by, before the activity's description is looked up.
STATE_KEYS = ["uf", "cnae_fiscal_principal"]


def active_companies_from_counts(counts: DataFrame, cnaes: DataFrame, reference_date: str) -> DataFrame:
    """The mart from distinct counts by ``STATE_KEYS`` (``qtd_empresas_ativas``), kept in states of parts (files, dates)."""
    named = counts.join(activity_lookup(cnaes), "cnae_fiscal_principal", "left")
    return stamp(named.select("uf", "cnae_fiscal_principal", "descricao_cnae", "qtd_empresas_ativas"), reference_date)


def active_companies_joined(
    estabelecimentos: DataFrame,
    empresas: DataFrame,
    cnaes: DataFrame,
    keys: list | None = None,
) -> DataFrame:
    """Row-level chain of both left joins (company first, then activity), before aggregation.

    Companies with a large share of the establishments are split over several tasks (``keys``,
    or found by a pass over the company column). The activity table is a code list, which the
    planner broadcasts by its size.
    """
    active = active_establishments(estabelecimentos)
    with_company = split_join(active, company_attributes(empresas), "cnpj_basico", "left", keys)
    return with_company.join(activity_lookup(cnaes), "cnae_fiscal_principal", "left")
