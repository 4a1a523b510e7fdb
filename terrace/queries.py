"""Query catalogue: Spark side (``QUERIES``) and an independent SQL oracle (``ORACLES``).

Every query reads the driver's tables (or lines Spark derives from them row by
row) and runs over whole tables. Output column names are identical on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from terrace import adapters as A
from terrace.functions import columns as C
from terrace.operators import landing as L
from terrace.operators import marts
from terrace.operators import quality as Q
from terrace.operators import selection as SEL
from terrace.operators.distinct_state import StateStore
from terrace.operators.footer_counts import footer_counts
from terrace.operators.joins import split_join
from terrace.operators.refine import clean_strings, refine
from terrace.plans.specs import spec_of
from terrace.session import fresh_dir
from terrace.sources import links as LK  # noqa: N812
from terrace.sources import ziplines
from terrace.sources.raw import parse_lines
from terrace.sources.store import SnapshotStore

# Fixed value: snapshot date the registry pipeline stamps by default.
REFERENCE_DATE = "2026-01-11"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


def refined(spark: SparkSession, sf_dir: str, table: str, stamped: bool = True) -> DataFrame:
    """Adapter lines -> parse with the declared schema -> refine (-> stamp)."""
    spec = spec_of(table)
    df = refine(parse_lines(A.RAW_ADAPTERS[table](spark, sf_dir), spec.schema), spec)
    return C.stamp(df, REFERENCE_DATE) if stamped else df


# ---------------------------------------------------------------------------------------
# SQL of the refined tables, written directly from the adapter rules.

RD = f"'{REFERENCE_DATE}'"


def _lp(expr: str, n: int) -> str:
    return f"lpad(cast({expr} as varchar), {n}, '0')"


SQL_CODE_TABLES = {
    "cnaes": f"select {_lp('n_nationkey', 7)} as codigo, n_name as descricao from nation",
    "paises": f"select {_lp('n_nationkey', 3)} as codigo, n_name as descricao from nation",
    "motivos": f"select {_lp('r_regionkey', 2)} as codigo, r_name as descricao from region",
    "municipios": f"select {_lp('s_suppkey', 4)} as codigo, s_name as descricao from supplier",
    "naturezas": f"select {_lp('p_partkey', 6)} as codigo, p_name as descricao from part",
    "qualificacoes": "select substr(o_orderpriority, 1, 1) as codigo, substr(o_orderpriority, 3) as descricao "
    "from (select distinct o_orderpriority from orders)",
}

SQL_EMPRESAS = f"""
select {_lp('c_custkey', 8)} as cnpj_basico,
       c_name as razao_social,
       {_lp('c_nationkey', 4)} as natureza_juridica,
       c_mktsegment as qualificacao_responsavel,
       case when c_custkey % 11 = 0 then null else cast(cast(c_acctbal as decimal(18,2)) as double) end as capital_social,
       case when c_custkey % 13 = 0 then null else c_nationkey end as porte_empresa,
       case when c_nationkey = 0 then 'BR' else '"' end as ente_federativo_responsavel
from customer"""

SQL_ESTABELECIMENTOS = f"""
select case when o_orderkey % 17 = 0 then cast(90000000 + o_custkey as varchar) else {_lp('o_custkey', 8)} end as cnpj_basico,
       {_lp('o_orderkey % 10000', 4)} as cnpj_ordem,
       {_lp('o_orderkey % 97', 2)} as cnpj_dv,
       case when o_orderkey % 4 = 0 then 1 else 2 end as identificador_matriz_filial,
       case when o_orderkey % 5 = 0 then 'LOJA ' || cast(o_orderkey as varchar) || ' X'
            else 'LOJA ' || cast(o_orderkey as varchar) end as nome_fantasia,
       case o_orderstatus when 'F' then 2 when 'O' then 8 end as situacao_cadastral,
       case when o_orderkey % 7 = 0 then null else cast(o_orderdate as date) end as data_situacao_cadastral,
       {_lp('o_orderkey % 60', 2)} as motivo_situacao_cadastral,
       cast(null as varchar) as nome_cidade_exterior,
       case when o_custkey % 10 = 0 then '105' end as pais,
       case when o_orderkey % 9 = 0 then null else cast(o_orderdate as date) end as data_inicio_atividade,
       {_lp('o_orderkey % 30', 7)} as cnae_fiscal_principal,
       {_lp('o_orderkey % 7', 7)} || ',' || {_lp('o_orderkey % 11', 7)} as cnae_fiscal_secundaria,
       'RUA' as tipo_logradouro,
       'RUA ' || cast(o_custkey as varchar) as logradouro,
       cast(o_orderkey % 1000 as varchar) as numero,
       cast(null as varchar) as complemento,
       'CENTRO' as bairro,
       {_lp('o_custkey % 100000', 8)} as cep,
       nullif(substr(o_orderpriority, 3), 'LOW') as uf,
       {_lp('o_custkey % 5000', 4)} as municipio,
       '11' as ddd_1,
       {_lp('o_orderkey % 100000000', 8)} as telefone_1,
       cast(null as varchar) as ddd_2,
       cast(null as varchar) as telefone_2,
       cast(null as varchar) as ddd_fax,
       cast(null as varchar) as fax,
       'contato' || cast(o_custkey as varchar) || '@example.com' as correio_eletronico,
       cast(null as varchar) as situacao_especial,
       '"' as data_situacao_especial
from orders"""

SQL_SIMPLES = f"""
select {_lp('o_orderkey', 8)} as cnpj_basico,
       case when o_orderstatus = 'F' then 'S' else 'N' end as opcao_pelo_simples,
       cast(o_orderdate as date) as data_opcao_simples,
       case when o_orderstatus = 'O' then cast(o_orderdate as date) end as data_exclusao_simples,
       case when o_orderkey % 3 = 0 then 'S' else 'N' end as opcao_mei,
       case when o_orderkey % 3 = 0 then cast(o_orderdate as date) end as data_opcao_mei,
       cast(null as date) as data_exclusao_mei
from orders"""

SQL_SOCIOS = f"""
select {_lp('l_orderkey', 8)} as cnpj_basico,
       l_linenumber as identificador_socio,
       'SOCIO ' || cast(l_partkey as varchar) as nome_socio_razao_social,
       '***' || {_lp('l_suppkey % 1000000', 6)} || '**' as cpf_cnpj_socio,
       {_lp('l_linenumber', 2)} as qualificacao_socio,
       cast(l_shipdate as date) as data_entrada_sociedade,
       cast(null as varchar) as pais,
       '***000000**' as representante_legal,
       cast(null as varchar) as nome_do_representante,
       '00' as qualificacao_representante_legal,
       cast(l_linenumber % 10 as integer) as faixa_etaria
from lineitem"""

SQL_REFINED = dict(SQL_CODE_TABLES)
SQL_REFINED.update(
    empresas=SQL_EMPRESAS, estabelecimentos=SQL_ESTABELECIMENTOS, simples=SQL_SIMPLES, socios=SQL_SOCIOS
)


def _stamped_sql(table: str) -> str:
    return f"select *, {RD} as reference_date from ({SQL_REFINED[table]})"


for _t in SQL_REFINED:
    def _mk(t):
        def q(spark, sf_dir):
            return refined(spark, sf_dir, t)

        q.__name__ = f"refine_{t}"
        return q

    register(f"refine_{_t}", _stamped_sql(_t))(_mk(_t))


# ---------------------------------------------------------------------------------------
# Mart and its parts (filter, projection, lookups, joins, distinct count)

SQL_ACTIVE = f"""
select cnpj_basico, uf, cnae_fiscal_principal, cnpj_ordem, cnpj_dv
from ({SQL_ESTABELECIMENTOS}) where situacao_cadastral = 2"""

SQL_LOOKUP = "select codigo as cnae_fiscal_principal, descricao as descricao_cnae from (" + SQL_CODE_TABLES["cnaes"] + ")"

SQL_MART = f"""
with a as ({SQL_ACTIVE}), l as ({SQL_LOOKUP})
select a.uf, a.cnae_fiscal_principal, l.descricao_cnae,
       count(distinct a.cnpj_basico) as qtd_empresas_ativas, {RD} as reference_date
from a left join l on a.cnae_fiscal_principal = l.cnae_fiscal_principal
group by a.uf, a.cnae_fiscal_principal, l.descricao_cnae"""


def landed(spark: SparkSession, sf_dir: str, table: str, stamped: bool = True) -> DataFrame:
    """As production does: lines landed as text, then scanned (the scan takes columns and filters) and refined."""
    root, spec = fresh_dir(spark, f"landed-{table}"), spec_of(table)
    L.land(A.RAW_ADAPTERS[table](spark, sf_dir).withColumn("dataset", F.lit(spec.dataset)), root, REFERENCE_DATE)
    df = refine(L.scan_landed(spark, root, spec.dataset, REFERENCE_DATE, spec.schema), spec)
    return C.stamp(df, REFERENCE_DATE) if stamped else df


def mart_inputs(spark: SparkSession, sf_dir: str):
    return tuple(landed(spark, sf_dir, t) for t in ("estabelecimentos", "empresas", "cnaes"))


@register("active_by_activity_state", SQL_MART)
def q_active_by_activity_state(spark, sf_dir):
    est, emp, cnaes = mart_inputs(spark, sf_dir)
    return marts.active_companies_by_activity_state(est, emp, cnaes, REFERENCE_DATE)


@register("mart_row_count", f"select count(*) as rows_gold from ({SQL_MART})")
def q_mart_row_count(spark, sf_dir):
    return q_active_by_activity_state(spark, sf_dir).agg(F.count(F.lit(1)).alias("rows_gold"))


@register(
    "active_filter",
    f"select cnpj_basico, cnpj_ordem, cnpj_dv, situacao_cadastral from ({SQL_ESTABELECIMENTOS}) "
    "where situacao_cadastral = 2",
)
def q_active_filter(spark, sf_dir):
    est = landed(spark, sf_dir, "estabelecimentos", stamped=False)
    return est.filter(F.col("situacao_cadastral") == marts.ACTIVE_STATUS).select(
        "cnpj_basico", "cnpj_ordem", "cnpj_dv", "situacao_cadastral"
    )


@register("project_active", SQL_ACTIVE)
def q_project_active(spark, sf_dir):
    return marts.active_establishments(landed(spark, sf_dir, "estabelecimentos", stamped=False))


@register("stamp_reference_date", f"select *, {RD} as reference_date from ({SQL_ACTIVE})")
def q_stamp_reference_date(spark, sf_dir):
    return C.stamp(q_project_active(spark, sf_dir), REFERENCE_DATE)


@register("activity_lookup", SQL_LOOKUP)
def q_activity_lookup(spark, sf_dir):
    return marts.activity_lookup(landed(spark, sf_dir, "cnaes", stamped=False))


SQL_COMPANY_SIDE = f"select cnpj_basico, porte_empresa from ({SQL_EMPRESAS})"


def company_side(spark, sf_dir):
    """All companies; the establishments adapter plants ids that none of them has."""
    return landed(spark, sf_dir, "empresas", stamped=False)


@register(
    "left_join_company",
    f"select a.*, c.porte_empresa from ({SQL_ACTIVE}) a left join ({SQL_COMPANY_SIDE}) c using (cnpj_basico)",
)
def q_left_join_company(spark, sf_dir):
    active = marts.active_establishments(landed(spark, sf_dir, "estabelecimentos", stamped=False))
    return split_join(active, marts.company_attributes(company_side(spark, sf_dir)), "cnpj_basico", "left")


SQL_HEAVY = f"""
with e as (select case when l_orderkey % 5 < 2 then {_lp('1', 8)} else {_lp('l_orderkey', 8)} end as cnpj_basico, l_orderkey, l_linenumber from lineitem)
select e.*, c.porte_empresa from e left join ({SQL_COMPANY_SIDE}) c using (cnpj_basico)"""


@register("left_join_heavy_key", SQL_HEAVY)
def q_left_join_heavy_key(spark, sf_dir):
    """One company holds two fifths of all rows; no other key holds a hundredth."""
    li = A.table(spark, sf_dir, "lineitem", ["l_orderkey", "l_linenumber"])
    company = F.when(F.col("l_orderkey") % 5 < 2, A.pad(F.lit(1), 8)).otherwise(A.pad("l_orderkey", 8))
    rows = li.select(company.alias("cnpj_basico"), "l_orderkey", "l_linenumber")
    return split_join(rows, marts.company_attributes(company_side(spark, sf_dir)), "cnpj_basico", "left")


@register(
    "left_join_lookup",
    f"select a.*, l.descricao_cnae from ({SQL_ACTIVE}) a left join ({SQL_LOOKUP}) l using (cnae_fiscal_principal)",
)
def q_left_join_lookup(spark, sf_dir):
    active = marts.active_establishments(landed(spark, sf_dir, "estabelecimentos", stamped=False))
    lookup = marts.activity_lookup(landed(spark, sf_dir, "cnaes", stamped=False))
    return active.join(lookup, "cnae_fiscal_principal", "left")


@register(
    "left_join_chain",
    f"""select a.*, c.porte_empresa, l.descricao_cnae
        from ({SQL_ACTIVE}) a left join ({SQL_COMPANY_SIDE}) c using (cnpj_basico)
        left join ({SQL_LOOKUP}) l using (cnae_fiscal_principal)""",
)
def q_left_join_chain(spark, sf_dir):
    est = landed(spark, sf_dir, "estabelecimentos", stamped=False)
    cnaes = landed(spark, sf_dir, "cnaes", stamped=False)
    return marts.active_companies_joined(est, company_side(spark, sf_dir), cnaes)


@register(
    "distinct_count",
    f"select situacao_cadastral, count(distinct cnpj_basico) as qtd_empresas "
    f"from ({SQL_ESTABELECIMENTOS}) group by situacao_cadastral",
)
def q_distinct_count(spark, sf_dir):
    est = landed(spark, sf_dir, "estabelecimentos", stamped=False)
    return est.groupBy("situacao_cadastral").agg(F.count_distinct("cnpj_basico").alias("qtd_empresas"))


def put_overlapping_parts(store: StateStore, rows, number) -> None:
    """Two parts that share a third of the rows and cover all; one of them is put twice, first with values that must go."""
    third = F.pmod(number, F.lit(3))
    store.put("a", rows.filter(third != 0))
    store.put("b", rows.withColumn(store.column, F.concat(store.column, F.lit("z"))))
    store.put("b", rows.filter(third != 1))


@register(
    "distinct_state",
    f"select situacao_cadastral, count(distinct cnpj_basico) as qtd_empresas "
    f"from ({SQL_ESTABELECIMENTOS}) group by situacao_cadastral",
)
def q_distinct_state(spark, sf_dir):
    est = landed(spark, sf_dir, "estabelecimentos", stamped=False).select("situacao_cadastral", "cnpj_basico", "cnpj_ordem")
    store = StateStore(spark, fresh_dir(spark, "distinct-state"), ["situacao_cadastral"], "cnpj_basico")
    put_overlapping_parts(store, est, F.col("cnpj_ordem").cast("int"))
    return store.counts("qtd_empresas")


@register("mart_from_states", SQL_MART)
def q_mart_from_states(spark, sf_dir):
    active = marts.active_establishments(landed(spark, sf_dir, "estabelecimentos", stamped=False))
    store = StateStore(spark, fresh_dir(spark, "mart-state"), marts.STATE_KEYS, "cnpj_basico")
    put_overlapping_parts(store, active, F.col("cnpj_ordem").cast("int"))
    cnaes = landed(spark, sf_dir, "cnaes", stamped=False)
    return marts.active_companies_from_counts(store.counts("qtd_empresas_ativas"), cnaes, REFERENCE_DATE)


# ---------------------------------------------------------------------------------------
# Scan semantics and scalar functions

RAW_SCAN_SCHEMA = StructType(
    [StructField("id", StringType()), StructField("name", StringType()), StructField("nation", IntegerType())]
)


@register(
    "raw_scan",
    "select cast(c_custkey as varchar) as id, c_name || ';' || c_mktsegment as name, c_nationkey as nation from customer",
)
def q_raw_scan(spark, sf_dir):
    c = A.table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_mktsegment", "c_nationkey"])
    line = F.concat(
        F.lit('"'), F.col("c_custkey"), F.lit('";"'), F.col("c_name"), F.lit(";"), F.col("c_mktsegment"),
        F.lit('";'), F.col("c_nationkey"),
    ).alias("value")
    return parse_lines(c.select(line), RAW_SCAN_SCHEMA)


LENIENT_INT_SCHEMA = StructType([StructField("id", StringType()), StructField("porte_empresa", IntegerType())])


@register(
    "lenient_int",
    f"""select {_lp('c_custkey', 8)} as id,
           case when c_custkey % 13 = 0 or c_custkey % 17 = 0 or c_custkey % 19 = 0 or c_custkey % 23 = 0
                then null else c_nationkey end as porte_empresa
        from customer""",
)
def q_lenient_int(spark, sf_dir):
    c = A.table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    k = F.col("c_custkey")
    val = (
        F.when(k % 13 == 0, F.lit("X"))
        .when(k % 17 == 0, F.concat(F.lit(" "), F.col("c_nationkey")))
        .when(k % 19 == 0, F.concat(F.col("c_nationkey"), F.lit(".0")))
        .when(k % 23 == 0, F.lit("2147483648"))
        .otherwise(A.pad("c_nationkey", 2))
    )
    return parse_lines(c.select(A.raw_line(A.pad(k, 8), val)), LENIENT_INT_SCHEMA)


@register(
    "lenient_date",
    """select o_orderkey,
           case when o_orderkey % 7 = 0 or o_orderkey % 11 = 0 or o_orderkey % 13 = 0 or o_orderkey % 17 = 0
                then null else cast(o_orderdate as date) end as data_situacao_cadastral
        from orders""",
)
def q_lenient_date(spark, sf_dir):
    o = A.table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    k = F.col("o_orderkey")
    text = (
        F.when(k % 7 == 0, F.lit("00000000"))
        .when(k % 11 == 0, F.lit("20260230"))
        .when(k % 13 == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(k % 17 == 0, F.concat(A.ymd("o_orderdate"), F.lit(" ")))
        .otherwise(A.ymd("o_orderdate"))
    )
    return o.select(k, C.lenient_date(text).alias("data_situacao_cadastral"))


@register(
    "comma_decimal",
    """select c_custkey,
           case when c_custkey % 11 = 0 or c_custkey % 7 = 0 then null
                else cast(cast(c_acctbal as decimal(18,2)) as double) end as capital_social
        from customer""",
)
def q_comma_decimal(spark, sf_dir):
    c = A.table(spark, sf_dir, "customer", ["c_custkey", "c_acctbal"])
    k = F.col("c_custkey")
    text = (
        F.when(k % 11 == 0, F.concat(F.lit("1."), A.capital_text("c_acctbal")))
        .when(k % 7 == 0, F.lit(""))
        .when(k % 5 == 0, F.concat(F.lit(" "), A.capital_text("c_acctbal"), F.lit(" ")))
        .otherwise(A.capital_text("c_acctbal"))
    )
    return c.select(k, C.comma_decimal(text).alias("capital_social"))


@register("clean_nul", "select p_partkey, p_name, p_brand, p_type, p_size from part")
def q_clean_nul(spark, sf_dir):
    p = A.table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    dirty = p.select(
        "p_partkey",
        F.regexp_replace("p_name", " ", C.nul()).alias("p_name"),
        F.regexp_replace("p_brand", "#", C.nul()).alias("p_brand"),
        "p_type",
        "p_size",
    )
    cleaned = clean_strings(dirty)
    return cleaned.select(
        "p_partkey", "p_name", F.translate("p_brand", " ", "#").alias("p_brand"), "p_type", "p_size"
    )


@register(
    "date_parts",
    "select o_orderkey, strftime(o_orderdate, '%Y') as year, strftime(o_orderdate, '%m') as month, "
    "strftime(o_orderdate, '%d') as day from orders",
)
def q_date_parts(spark, sf_dir):
    o = A.table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    y, m, d = C.date_parts(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", y.alias("year"), m.alias("month"), d.alias("day"))


@register(
    "landing_key",
    """select o_orderkey,
           'cnpj/empresas/' || strftime(o_orderdate, 'year=%Y/month=%m/day=%d') || '/K'
           || cast(o_orderkey as varchar) || '.EMPRECSV' as landing_key
        from orders""",
)
def q_landing_key(spark, sf_dir):
    o = A.table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    zip_name = F.concat(F.lit("Empresas"), F.col("o_orderkey") % 10, F.lit(".zip"))
    member = F.concat(F.lit("K"), F.col("o_orderkey"), F.lit(".EMPRECSV"))
    return o.select(
        "o_orderkey", C.landing_key(F.lit("cnpj"), C.dataset_name(zip_name), F.col("o_orderdate"), member).alias("landing_key")
    )


# ---------------------------------------------------------------------------------------
# Index pages: links, URL resolution, names, selection


def sq(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


# The SQL side reads links on its own: comments and script text go first, then the
# quoted, single-quoted or bare href of each <a> tag, with the named references.
_HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""
_QUOTES = r"""^["']|["']$"""
_REFERENCES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]
_SKIPPED = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
_DECODE = f"regexp_replace(v, {sq(_QUOTES)}, '', 'g')"
for _src, _dst in _REFERENCES:
    _DECODE = f"replace({_DECODE}, {sq(_src)}, {sq(_dst)})"

SQL_LINKS = f"""
select page_id, url, cast(generate_subscripts(hrefs, 1) - 1 as bigint) as pos, unnest(hrefs) as href
from (select page_id, url,
             list_filter(list_transform(regexp_extract_all(regexp_replace(html, {sq(_SKIPPED)}, '', 'g'), {sq(_HREF)}, 1), lambda v: {_DECODE}),
                         lambda x: x <> '') as hrefs
      from pages)"""


def sql_resolve(base: str, href: str) -> str:
    h = f"regexp_replace(regexp_replace({href}, '^[\\x00-\\x20]+', ''), '[\\t\\r\\n]', '', 'g')"
    return f"""(case when regexp_matches({h}, '^[A-Za-z][A-Za-z0-9+.\\-]*:') then {h}
      when starts_with({h}, '//') then regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.\\-]*:)', 1) || {h}
      when starts_with({h}, '/') then regexp_extract({base}, '^([A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*)', 1) || {h}
      else regexp_replace(regexp_replace({base}, '[?#].*$', ''), '[^/]*$', '') || {h} end)"""


def page_links(spark, sf_dir):
    return LK.extract_links(A.table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


@register("link_extract", f"select page_id, pos, href from ({SQL_LINKS})")
def q_link_extract(spark, sf_dir):
    return page_links(spark, sf_dir).select("page_id", "pos", "href")


@register("link_resolve", f"select page_id, pos, href, {sql_resolve('url', 'href')} as resolved_url from ({SQL_LINKS})")
def q_link_resolve(spark, sf_dir):
    return page_links(spark, sf_dir).select("page_id", "pos", "href", C.resolve_url("url", "href").alias("resolved_url"))


# Dot segments put in front of the crawled paths, by position, and a fold over the segments on the SQL side.
DOTTED = ["../", "./", "a/../", "../../b/./", "/c/../"]

SQL_DOTTED = f"select page_id, url, pos, case pos % 5 {' '.join(f'when {i} then {sq(d)}' for i, d in enumerate(DOTTED))} end || ltrim(href, '/') as href from ({SQL_LINKS})"

SQL_RESOLVED_DOTS = f"""
with d as (select *, regexp_extract(url, '^([A-Za-z]+://[^/?#]*)', 1) as site, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) as base from ({SQL_DOTTED})),
p as (select *, regexp_extract(href, '^([^?#]*)', 1) as path, regexp_extract(href, '^[^?#]*(.*)$', 1) as more from d),
w as (select *, string_split(case when starts_with(path, '/') then path else regexp_replace(base, '[^/]*$', '') || path end, '/') as raw from p),
g as (select *, case when raw[1] = '' then raw else list_concat([''], raw) end as s from w),
f as (select *, list_reduce(list_prepend([]::varchar[], list_transform(s, lambda x: [x])),
                            lambda a, x: case x[1] when '..' then a[1 : len(a) - 1] when '.' then a else list_concat(a, x) end) as kept from g)
select page_id, pos, href, site || case when starts_with(r, '/') then '' else '/' end || r || more as resolved_url
from (select *, array_to_string(case when s[len(s)] in ('.', '..') then list_concat(kept, ['']) else kept end, '/') as r from f)"""


@register("link_resolve_dots", SQL_RESOLVED_DOTS)
def q_link_resolve_dots(spark, sf_dir):
    pos = F.col("pos") % 5
    before = F.get(F.array(*map(F.lit, DOTTED)), pos.cast("int"))
    links = page_links(spark, sf_dir).withColumn("href", F.concat(before, F.ltrim("href", F.lit("/"))))
    return links.select("page_id", "pos", "href", C.resolve_url("url", "href").alias("resolved_url"))


@register("link_basename", f"select page_id, pos, regexp_extract(href, '[^/]*$') as file_name from ({SQL_LINKS})")
def q_link_basename(spark, sf_dir):
    return page_links(spark, sf_dir).select("page_id", "pos", C.basename("href").alias("file_name"))


def _zipped_href(pos, href):
    """Even positions get an upper-case archive suffix (the crawled pages link no archives)."""
    return F.when(pos % 2 == 0, F.concat(href, F.lit(".ZIP"))).otherwise(href)


SQL_ZIPPED = f"select page_id, pos, case when pos % 2 = 0 then href || '.ZIP' else href end as href from ({SQL_LINKS})"


@register(
    "zip_link_filter",
    f"select page_id, pos, href, regexp_extract(href, '[^/]*$') as zip_name from ({SQL_ZIPPED}) where lower(href) like '%.zip'",
)
def q_zip_link_filter(spark, sf_dir):
    links = page_links(spark, sf_dir)
    z = links.select("page_id", "pos", _zipped_href(F.col("pos"), F.col("href")).alias("href"))
    return z.filter(C.is_zip_link("href")).select("page_id", "pos", "href", C.basename("href").alias("zip_name"))


@register(
    "dataset_name",
    f"""select page_id, pos, lower(regexp_replace(replace(nm, '.zip', ''), '[0-9]+$', '')) as dataset
        from (select page_id, pos, regexp_extract(href, '[^/]*$') || cast(pos as varchar)
                     || case when pos % 2 = 0 then '.zip' else '.ZIP' end as nm from ({SQL_LINKS}))""",
)
def q_dataset_name(spark, sf_dir):
    links = page_links(spark, sf_dir)
    name = F.concat(
        C.basename("href"), F.col("pos").cast("string"), F.when(F.col("pos") % 2 == 0, F.lit(".zip")).otherwise(F.lit(".ZIP"))
    )
    return links.select("page_id", "pos", C.dataset_name(name).alias("dataset"))


@register(
    "split_list",
    """select c_custkey, cast(generate_subscripts(items, 1) - 1 as bigint) as pos, unnest(items) as item
       from (select c_custkey,
                    list_filter(list_transform(string_split(' ' || c_mktsegment || ' , ,' || c_name || ',,'
                                                            || c_mktsegment || ' ', ','), lambda x: trim(x)),
                                lambda x: x <> '') as items
             from customer)""",
)
def q_split_list(spark, sf_dir):
    c = A.table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment", "c_name"])
    spec = F.concat(
        F.lit(" "), F.col("c_mktsegment"), F.lit(" , ,"), F.col("c_name"), F.lit(",,"), F.col("c_mktsegment"), F.lit(" ")
    )
    return c.select("c_custkey", F.posexplode(C.split_list(spec)).alias("pos", "item")).withColumn(
        "pos", F.col("pos").cast("bigint")
    ).select("c_custkey", "pos", "item")


@register(
    "topk_per_group",
    """select p_brand, p_partkey, p_size, cast(rank as integer) as rank from (
         select p_brand, p_partkey, p_size, row_number() over (partition by p_brand order by p_size, p_partkey) as rank
         from part) where rank <= 3""",
)
def q_topk_per_group(spark, sf_dir):
    p = A.table(spark, sf_dir, "part", ["p_brand", "p_partkey", "p_size"])
    return SEL.top_per_group(p, ["p_brand"], [F.col("p_size"), F.col("p_partkey")], 3)


@register(
    "dedupe_last",
    """select user_id, event_id, event_type, value from (
         select *, row_number() over (partition by user_id order by event_id desc) as rn from events) where rn = 1""",
)
def q_dedupe_last(spark, sf_dir):
    e = A.table(spark, sf_dir, "events", ["user_id", "event_id", "event_type", "value"])
    return SEL.last_per_key(e, ["user_id"], F.col("event_id"))


# Filters as the configuration string lists them (blank items are dropped).
SELECT_FILTERS = "Alpha, Beta,,Gamma, Epsilon1 ,Nada"
SELECT_MAX_FILES = 3

SQL_INDEX_LINKS = """
select cast(s_nationkey as bigint) as page_id,
       'http://idx' || cast(s_nationkey as varchar) || '.example.org/arquivos/2026-01-11/' as url,
       s_suppkey as pos,
       case s_suppkey % 8
         when 0 then '/files/Alpha' || cast(100000 - s_suppkey as varchar) || '.zip'
         when 1 then 'beta' || lpad(cast(s_suppkey % 7 as varchar), 2, '0') || '.ZIP'
         when 2 then 'x/Gamma.zip'
         when 3 then 'GAMMA' || cast(s_suppkey as varchar) || '.zip'
         when 4 then 'Delta' || cast(s_suppkey as varchar) || '.zip?x=1'
         when 5 then 'https://mirror.example.org/d/alpha0' || cast(s_suppkey as varchar) || '.zip'
         when 6 then 'Epsilon' || cast(s_suppkey as varchar) || '.zip'
         else ' Beta' || cast(s_suppkey % 5 as varchar) || '.zip' end as href
from supplier"""

SQL_SELECT_FILES = f"""
with l as ({SQL_INDEX_LINKS}),
z as (select *, regexp_extract(href, '[^/]*$') as fname, regexp_extract(trim(href), '[^/]*$') as sname
      from l where lower(href) like '%.zip'),
f as (select cast(generate_subscripts(items, 1) - 1 as integer) as filter_pos, unnest(items) as dataset_filter
      from (select list_filter(list_transform(string_split({sq(SELECT_FILTERS)}, ','), lambda x: trim(x)), lambda x: x <> '') as items)),
ex as (select z.page_id, f.filter_pos, max(z.pos) as pos
       from z join f on lower(z.fname) = lower(f.dataset_filter) || '.zip' group by z.page_id, f.filter_pos),
num as (select z.page_id, f.filter_pos, z.pos,
               cast(substr(z.sname, length(f.dataset_filter) + 1, length(z.sname) - length(f.dataset_filter) - 4) as hugeint) as sfx
        from z join f on lower(substr(z.sname, 1, length(f.dataset_filter))) = lower(f.dataset_filter)
         and regexp_full_match(lower(substr(z.sname, length(f.dataset_filter) + 1)), '[0-9]+\\.zip')),
nr as (select page_id, filter_pos, pos, row_number() over (partition by page_id, filter_pos order by sfx, pos) as rk
       from num where not exists (select 1 from ex where ex.page_id = num.page_id and ex.filter_pos = num.filter_pos)),
sel as (select page_id, filter_pos, 1 as rk, pos from ex
        union all select page_id, filter_pos, rk, pos from nr where rk <= {SELECT_MAX_FILES})
select sel.page_id, f.dataset_filter, sel.filter_pos, cast(sel.rk as integer) as rank, sel.pos,
       z.fname as zip_name, {sql_resolve('z.url', 'z.href')} as zip_url,
       lower(regexp_replace(replace(z.fname, '.zip', ''), '[0-9]+$', '')) as dataset, {RD} as reference_date
from sel join f using (filter_pos) join z on z.page_id = sel.page_id and z.pos = sel.pos"""


def q_selection(spark, sf_dir):
    links = A.index_links(spark, sf_dir)
    filters = SEL.filter_table(spark, SELECT_FILTERS)
    return SEL.select_files(links, filters, SELECT_MAX_FILES, REFERENCE_DATE)


register("select_files", SQL_SELECT_FILES)(q_selection)


@register(
    "gate_selection",
    f"""select p.page_id, count(s.page_id) as n_selected, count(s.page_id) > 0 as passed
        from (select distinct cast(s_nationkey as bigint) as page_id from supplier) p
        left join ({SQL_SELECT_FILES}) s on s.page_id = p.page_id group by p.page_id""",
)
def q_gate_selection(spark, sf_dir):
    return SEL.selection_report(A.index_links(spark, sf_dir), q_selection(spark, sf_dir))


# ---------------------------------------------------------------------------------------
# Archives: manifest and gates

LANDING_BUCKET = "bronze"

SQL_ARCHIVE_REPORT = """
with m as (select 'Socios' || cast(l_orderkey as varchar) || '.zip' as zip_name,
                  case when l_quantity > 10 then cast(l_quantity * 1000 as bigint) else 0 end as file_size,
                  false as is_dir from lineitem
           union all select 'Socios' || cast(o_orderkey as varchar) || '.zip', 0, true from orders)
select zip_name, count(*) filter (where not is_dir) as n_files,
       count(*) filter (where not is_dir and file_size > 0) as n_non_empty
from m group by zip_name"""


@register(
    "gate_archive",
    f"""select zip_name, n_files, n_non_empty, n_files > 0 as has_files, n_non_empty > 0 as has_non_empty,
               n_files > 0 and n_non_empty > 0 as passed from ({SQL_ARCHIVE_REPORT})""",
)
def q_gate_archive(spark, sf_dir):
    return L.archive_report(A.archive_members(spark, sf_dir))


# Members of the landed archives, as the adapter makes them; the landing plants two faults: nothing of archive 3
# arrives, and of archive 5 the lines of one member that begin an order whose key 8 divides are lost.
SQL_MEMBERS = """
select 'Socios' || cast(l_orderkey % 40 as varchar) || '.zip' as zip_name, 'dados/K' || cast(l_linenumber as varchar) || '.SOCIOCSV' as member,
       l_orderkey % 40 as archive_no, l_orderkey, l_linenumber,
       length(cast(l_orderkey as varchar) || ';' || cast(l_linenumber as varchar) || ';S#') as n_chars
from lineitem where l_quantity > 10"""

SQL_LANDED = f"""
select zip_name, member, archive_no, count(*) as lines, cast(sum(n_chars + 2) as bigint) as listed_bytes, cast(sum(n_chars + 2) as bigint) as expected_bytes,
       cast(sum(case when archive_no = 5 and l_linenumber = 2 and (l_orderkey // 40) % 8 = 0 then 0 else n_chars + 2 end) as bigint) as kept_bytes
from ({SQL_MEMBERS}) group by all"""

SQL_LANDED_REPORT = f"""
select 'socios' as dataset, zip_name, member, listed_bytes, case when archive_no <> 3 then listed_bytes end as read_bytes,
       case when archive_no <> 3 then lines end as lines, case when archive_no <> 3 then expected_bytes end as expected_bytes,
       case when archive_no <> 3 and kept_bytes > 0 then kept_bytes end as landed_bytes,
       case when archive_no = 3 or kept_bytes = 0 then 'not landed' when kept_bytes < expected_bytes then 'stored short' else 'whole' end as state,
       archive_no <> 3 and kept_bytes = expected_bytes as passed
from ({SQL_LANDED})"""


def landed_members(spark, sf_dir):
    """Archives of line items listed, packed, read and landed (with the planted faults), and the report on it."""
    folder, root = fresh_dir(spark, "member-archives"), fresh_dir(spark, "member-landing")
    A.write_member_archives(A.socios_members(spark, sf_dir), folder, "Socios", 40, 3)
    path = fresh_dir(spark, "member-listing")
    ziplines.read_listing(spark, folder).write.parquet(path)
    listing = spark.read.parquet(path)
    datasets = listing.select("archive", C.dataset_name("zip_name").alias("dataset")).distinct()
    rows = ziplines.read_counted(spark, listing).join(datasets, "archive").filter(~F.col("zip_name").startswith("Socios3."))
    order = F.split("value", ";")[0].try_cast("long")
    lost = (F.col("zip_name") == "Socios5.zip") & F.col("member").endswith("K2.SOCIOCSV") & (F.floor(order / 40) % 8 == 0)
    L.land(rows.filter(~F.coalesce(lost, F.lit(False))), root, REFERENCE_DATE)
    return L.landed_report(spark, listing, datasets, root, REFERENCE_DATE)


@register("landing_report", SQL_LANDED_REPORT)
def q_landing_report(spark, sf_dir):
    return landed_members(spark, sf_dir)


@register(
    "landing_manifest",
    f"""select zip_name, dataset, cast(count(*) as varchar) as uploaded_files, '{LANDING_BUCKET}' as bucket
        from ({SQL_LANDED_REPORT}) where state = 'whole' group by zip_name, dataset""",
)
def q_landing_manifest(spark, sf_dir):
    return L.manifest(landed_members(spark, sf_dir), LANDING_BUCKET)


# ---------------------------------------------------------------------------------------
# Quality reports

def _sql_report(table: str, sql: str, required: str | None) -> str:
    parts = [
        f"""select '{table}' as table_name, 'not_empty' as check_name, cast(null as varchar) as column_name,
                   count(*) as n_rows, cast(case when count(*) > 0 then 0 else 1 end as bigint) as n_violations,
                   count(*) > 0 as passed from ({sql})"""
    ]
    if required:
        parts.append(
            f"""select '{table}', 'required_not_null', '{required}', count(*),
                       count(*) filter (where {required} is null), count(*) filter (where {required} is null) = 0
                from ({sql})"""
        )
    return " union all ".join(parts)


@register(
    "gate_not_empty",
    _sql_report("estabelecimentos_ativos", SQL_ACTIVE, None)
    + " union all "
    + _sql_report("estabelecimentos_baixados", f"select * from ({SQL_ESTABELECIMENTOS}) where situacao_cadastral = 3", None),
)
def q_gate_not_empty(spark, sf_dir):
    est = landed(spark, sf_dir, "estabelecimentos", stamped=False)
    active = Q.quality_report(marts.active_establishments(est), "estabelecimentos_ativos", None)
    closed = Q.quality_report(est.filter(F.col("situacao_cadastral") == 3), "estabelecimentos_baixados", None)
    return active.unionByName(closed)


GATE_REQUIRED_CASES = [(t, spec_of(t).key) for t in SQL_REFINED] + [("estabelecimentos", "pais")]


@register(
    "gate_required",
    " union all ".join(_sql_report(t, SQL_REFINED[t], key) for t, key in GATE_REQUIRED_CASES),
)
def q_gate_required(spark, sf_dir):
    """One aggregate per table covers all of its required columns (a table is read once); a case of a
    table is its ``not_empty`` row and one column's, so the former stands once for every case."""
    columns: dict[str, list[str]] = {}
    for t, key in GATE_REQUIRED_CASES:
        columns.setdefault(t, []).append(key)
    out = None
    for t, keys in columns.items():
        rep = Q.quality_report(refined(spark, sf_dir, t, stamped=False), t, keys)
        times = F.when(F.col("column_name").isNull(), F.lit(len(keys))).otherwise(F.lit(1))
        rep = rep.withColumn("case", F.explode(F.sequence(F.lit(1), times))).drop("case")
        out = rep if out is None else out.unionByName(rep)
    return out


# ---------------------------------------------------------------------------------------
# Files on the shared scratch folder: partitioned write + pruned read, landing, store, archives



DATED_SCHEMA = StructType([StructField(n, StringType()) for n in ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")])


def landed_orders(spark, sf_dir):
    """Every order landed under its own date; returns the scan of all dates."""
    root = fresh_dir(spark, "partition_scan")
    o = A.table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"])
    line = F.concat_ws(";", "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("string"))
    L.land(o.select(line.alias("value"), F.lit("orders").alias("dataset"), "o_orderdate"), root, None, date_col="o_orderdate")
    return L.scan_dates(spark, root, "orders", DATED_SCHEMA)


def _typed_orders(rows):
    whole = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double"}
    return rows.withColumns({c: F.col(c).cast(t) for c, t in whole.items()})


@register(
    "partition_scan",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders "
    "where year(o_orderdate) = 1996 and month(o_orderdate) = 3",
)
def q_partition_scan(spark, sf_dir):
    march = landed_orders(spark, sf_dir).filter("year = '1996' and month = '03'")
    return _typed_orders(march.drop("year", "month", "day"))


@register(
    "partition_scan_date",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice from orders where cast(o_orderdate as date) = date '1996-03-01'",
)
def q_partition_scan_date(spark, sf_dir):
    return _typed_orders(L.on_date(landed_orders(spark, sf_dir), "1996-03-01"))


@register("land_incremental", _stamped_sql("empresas"))
def q_land_incremental(spark, sf_dir):
    """Members landed one after the other for one date, one of them twice: all stay, none repeats."""
    root, spec = fresh_dir(spark, "incremental"), spec_of("empresas")
    lines = A.raw_empresas(spark, sf_dir).withColumns({"dataset": F.lit(spec.dataset), "zip_name": F.lit("Empresas.zip")})
    half = F.pmod(F.xxhash64("value"), F.lit(2)).cast("string")
    for part in ("0", "1", "0"):
        L.land(lines.filter(half == part).withColumn("member", F.lit(f"part{part}.csv")), root, REFERENCE_DATE)
    return C.stamp(refine(L.scan_landed(spark, root, spec.dataset, REFERENCE_DATE, spec.schema), spec), REFERENCE_DATE)


@register("landed_roundtrip", _stamped_sql("estabelecimentos"))
def q_landed_roundtrip(spark, sf_dir):
    root = fresh_dir(spark, "landed")
    lines = A.raw_estabelecimentos(spark, sf_dir).withColumn("dataset", F.lit("estabelecimentos")).unionByName(
        A.raw_cnaes(spark, sf_dir).withColumn("dataset", F.lit("cnaes"))
    )
    L.land(lines, root, REFERENCE_DATE)
    spec = spec_of("estabelecimentos")
    raw = L.scan_landed(spark, root, spec.dataset, REFERENCE_DATE, spec.schema)
    return C.stamp(refine(raw, spec), REFERENCE_DATE)


@register("store_roundtrip", _stamped_sql("empresas"))
def q_store_roundtrip(spark, sf_dir):
    store = SnapshotStore(spark, fresh_dir(spark, "store"))
    spec = spec_of("empresas")
    store.publish(refined(spark, sf_dir, "cnaes"), "empresas", required="codigo")  # an older snapshot, other schema
    store.publish(refined(spark, sf_dir, "empresas"), "empresas", required=spec.key)
    return store.read("empresas")


@register(
    "snapshot_counts",
    f"select count(*) as n_rows, count(*) - count(cnpj_basico) as n_null_cnpj_basico, count(*) - count(uf) as n_null_uf, "
    f"count(*) - count(pais) as n_null_pais, count(*) - count(data_inicio_atividade) as n_null_data_inicio_atividade from ({SQL_ESTABELECIMENTOS})",
)
def q_snapshot_counts(spark, sf_dir):
    store = SnapshotStore(spark, fresh_dir(spark, "counted"))
    spec = spec_of("estabelecimentos")
    store.publish(refined(spark, sf_dir, spec.name), spec.name, required=spec.key)
    return footer_counts(spark, store.current(spec.name), [spec.key, "uf", "pais", "data_inicio_atividade"])


@register("zip_members", _stamped_sql("empresas"))
def q_zip_members(spark, sf_dir):
    folder = fresh_dir(spark, "archives")
    paths = A.write_archives(A.raw_empresas(spark, sf_dir), folder, "Empresas")
    lines = ziplines.read_lines(spark, paths)
    spec = spec_of("empresas")
    return C.stamp(refine(parse_lines(lines, spec.schema), spec), REFERENCE_DATE)
