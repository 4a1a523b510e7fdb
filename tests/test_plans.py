"""Physical-plan properties the design relies on."""

import os

from conftest import plan_text
from pyspark.sql import functions as F

from terrace.operators import marts
from terrace.queries import REFERENCE_DATE, refined

SF = "/root/testdata/sf0.001"


def write_refined(spark, scratch):
    paths = {}
    for t in ("estabelecimentos", "empresas", "cnaes"):
        paths[t] = os.path.join(scratch, t)
        refined(spark, SF, t).write.parquet(paths[t])
    return {t: spark.read.parquet(p) for t, p in paths.items()}


def test_mart_plan_over_parquet(spark, scratch):
    tabs = write_refined(spark, scratch)
    mart = marts.active_companies_by_activity_state(tabs["estabelecimentos"], tabs["empresas"], tabs["cnaes"], REFERENCE_DATE)
    plan = plan_text(mart)
    # the company join cannot change a distinct count of a left-joined key: it is removed
    assert os.path.join(scratch, "empresas") not in plan
    assert os.path.join(scratch, "estabelecimentos") in plan
    assert sum(1 for line in plan.splitlines() if line.startswith("(") and "Scan parquet" in line) == 2
    # the active filter and the column pruning reach the scan
    assert "PushedFilters: [IsNotNull(situacao_cadastral), EqualTo(situacao_cadastral,2)]" in plan
    assert "ReadSchema: struct<cnpj_basico:string,situacao_cadastral:int,cnae_fiscal_principal:string,uf:string>" in plan
    # proven-small lookup is broadcast; the distinct count is pre-aggregated on (keys, company)
    assert "BroadcastHashJoin LeftOuter BuildRight" in plan
    assert "hashpartitioning(uf#" in plan and plan.count("Exchange") >= 2
    assert mart.count() > 0


def test_join_orders_give_same_mart(spark, scratch):
    tabs = write_refined(spark, scratch)
    emp = tabs["empresas"]
    dup_companies = emp.unionByName(emp)  # duplicated company rows must not change the counts
    a = marts.active_companies_by_activity_state(tabs["estabelecimentos"], dup_companies, tabs["cnaes"], REFERENCE_DATE)
    b = marts.active_companies_by_activity_state(tabs["estabelecimentos"], None, tabs["cnaes"], REFERENCE_DATE)
    active = marts.active_establishments(tabs["estabelecimentos"])
    c = (
        active.join(marts.company_attributes(dup_companies), "cnpj_basico", "left")
        .join(marts.activity_lookup(tabs["cnaes"]), "cnae_fiscal_principal", "left")
        .groupBy("uf", "cnae_fiscal_principal", "descricao_cnae")
        .agg(F.count_distinct("cnpj_basico").alias("qtd_empresas_ativas"))
        .withColumn("reference_date", F.lit(REFERENCE_DATE))
    )
    rows = [sorted(map(tuple, x.collect()), key=repr) for x in (a, b, c)]
    assert rows[0] == rows[1] == rows[2]


def test_refine_is_a_narrow_map(spark):
    plan = plan_text(refined(spark, "/root/testdata/sf0.01", "socios"))
    assert "from_csv" in plan
    assert "Exchange hashpartitioning" not in plan  # no shuffle at all


def test_selection_and_dedupe_limit_groups_before_shuffle(spark):
    from terrace.queries import q_dedupe_last, q_selection

    for df in (q_selection(spark, SF), q_dedupe_last(spark, SF)):
        plan = plan_text(df, "simple")
        assert "WindowGroupLimit" in plan and "Partial" in plan


def test_refinement_from_landed_text_is_map_only_with_gates_on_the_write(spark, scratch):
    """The production refinement: byte-range CSV scan -> typed projection -> gate metrics, no shuffle."""
    from terrace import adapters as A
    from terrace.functions.columns import stamp
    from terrace.operators import landing as L
    from terrace.operators.quality import observe_gates
    from terrace.operators.refine import refine
    from terrace.plans.specs import spec_of

    root = os.path.join(scratch, "landed")
    L.land(A.raw_estabelecimentos(spark, SF).withColumn("dataset", F.lit("estabelecimentos")), root, REFERENCE_DATE)
    spec = spec_of("estabelecimentos")
    df = stamp(refine(L.scan_landed(spark, root, spec.dataset, REFERENCE_DATE, spec.schema), spec), REFERENCE_DATE)
    gated, obs = observe_gates(df, spec.name, spec.key)
    plan = plan_text(gated)
    assert "Scan csv" in plan and "CollectMetrics" in plan
    assert "Exchange" not in plan
    gated.write.format("noop").mode("overwrite").save()
    assert obs.get["n_rows"] == spark.read.parquet(f"{SF}/orders.parquet").count() and obs.get["n_null_key"] == 0


def test_catalogue_has_one_scan_per_table_and_no_python(spark):
    from terrace.queries import QUERIES

    for name, scans in [("active_filter", 1), ("project_active", 1), ("left_join_company", 2), ("active_by_activity_state", 2)]:
        plan = plan_text(QUERIES[name](spark, SF), "simple")
        assert plan.count("FileScan csv") == scans and "from_csv" not in plan, name
        assert "MapInArrow" not in plan, name
