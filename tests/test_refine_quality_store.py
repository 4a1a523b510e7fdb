"""Refinement specs, quality gates and the snapshot store."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, IntegerType, StringType

from terrace.functions.columns import nul, stamp
from terrace.operators import quality as Q
from terrace.operators.refine import clean_strings, refine
from terrace.plans import schemas as S
from terrace.plans.specs import SPECS, TABLES, UnknownTableError, spec_of
from terrace.sources.raw import parse_lines
from terrace.sources.store import SnapshotStore


def test_specs_cover_ten_tables():
    assert TABLES == ["cnaes", "municipios", "motivos", "naturezas", "paises", "qualificacoes",
                      "empresas", "estabelecimentos", "simples", "socios"]
    assert len(spec_of("estabelecimentos").columns) == 30
    assert spec_of(" Socios ").name == "socios"
    with pytest.raises(UnknownTableError):
        spec_of("nada")


def test_refined_schema_types(spark):
    for name, spec in SPECS.items():
        lines = spark.createDataFrame([], "value string")
        out = stamp(refine(parse_lines(lines, spec.schema), spec), "2026-01-11")
        assert out.columns == spec.columns + ["reference_date"]
        types = {f.name: type(f.dataType) for f in out.schema.fields}
        for c in spec.columns:
            want = (DateType if c in spec.date_columns else DoubleType if c in spec.decimal_columns
                    else IntegerType if c in S.INT_COLUMNS else StringType)
            assert types[c] is want, (name, c)
    assert "data_situacao_especial" not in spec_of("estabelecimentos").date_columns


def test_nul_in_date_gives_null_not_repaired_date(spark):
    spec = spec_of("estabelecimentos")
    fields = ["00000001"] + [""] * 29
    fields[4] = "LOJA#X"
    fields[5] = "02"
    fields[6] = "2026#111"
    fields[10] = "20260111"
    line = ";".join(f'"{v}"' for v in fields)
    df = spark.createDataFrame([(line,)], "value string").select(F.regexp_replace("value", "#", nul()).alias("value"))
    r = refine(parse_lines(df, spec.schema), spec).first()
    assert r["data_situacao_cadastral"] is None
    assert r["data_inicio_atividade"] == dt.date(2026, 1, 11)
    assert r["nome_fantasia"] == "LOJA X"
    assert r["situacao_cadastral"] == 2
    assert r["data_situacao_especial"] == '"'


def test_empresas_capital_and_porte(spark):
    spec = spec_of("empresas")
    lines = ['"1";"A";"2135";"50";"1000,00";"01";""', '"2";"B";"2135";"50";"1.234,56";"X";"BR"']
    out = {r["cnpj_basico"]: r for r in refine(parse_lines(spark.createDataFrame([(v,) for v in lines], "value string"), spec.schema), spec).collect()}
    assert out["1"]["capital_social"] == 1000.0 and out["1"]["porte_empresa"] == 1
    assert out["1"]["ente_federativo_responsavel"] == '"'
    assert out["2"]["capital_social"] is None and out["2"]["porte_empresa"] is None


def test_clean_strings_only_touches_strings(spark):
    df = spark.createDataFrame([("a#b", 1)], "s string, n int").select(F.regexp_replace("s", "#", nul()).alias("s"), "n")
    out = clean_strings(df)
    assert out.schema == df.schema and tuple(out.first()) == ("a b", 1)


def test_quality_report_and_enforce(spark):
    df = spark.createDataFrame([("1",), (None,), ("3",)], "k string")
    rows = {r["check_name"]: r.asDict() for r in Q.quality_report(df, "t", "k").collect()}
    assert rows["not_empty"]["passed"] and rows["not_empty"]["n_rows"] == 3
    assert rows["required_not_null"]["n_violations"] == 1 and not rows["required_not_null"]["passed"]
    with pytest.raises(Q.QualityError, match="required_not_null"):
        Q.enforce(Q.quality_report(df, "t", "k"))
    empty = df.filter("false")
    with pytest.raises(Q.QualityError, match="not_empty"):
        Q.enforce(Q.quality_report(empty, "t", None))
    with pytest.raises(Q.QualityError):
        Q.gate_not_empty(empty, "t")


def test_store_publish_replaces_schema_and_failed_gate_keeps_old(spark, scratch):
    store = SnapshotStore(spark, os.path.join(scratch, "silver"))
    first = spark.createDataFrame([("1", "a"), ("2", "b")], "codigo string, descricao string")
    m = store.publish(first, "cnaes", required="codigo")
    assert m["n_rows"] == 2 and m["n_null_key"] == 0
    second = spark.createDataFrame([("9", 1.5)], "codigo string, other double")
    store.publish(second, "cnaes", required="codigo")
    back = store.read("cnaes")
    assert back.columns == ["codigo", "other"] and back.count() == 1
    bad = spark.createDataFrame([(None, 2.0)], "codigo string, other double")
    with pytest.raises(Q.QualityError):
        store.publish(bad, "cnaes", required="codigo")
    with pytest.raises(Q.QualityError):
        store.publish(bad.filter("false"), "cnaes", required="codigo")
    assert [tuple(r) for r in store.read("cnaes").collect()] == [("9", 1.5)]
    # the failed version is gone, the two published ones are there
    assert len([d for d in os.listdir(os.path.join(scratch, "silver", "cnaes")) if d.startswith("v-")]) == 2


def test_reference_date_warning(spark, scratch):
    from terrace.plans.pipeline import warn_on_snapshot_dates

    store = SnapshotStore(spark, os.path.join(scratch, "s"))
    store.publish(spark.createDataFrame([("1", "2026-01-10")], "codigo string, reference_date string"), "cnaes")
    rep = Q.reference_date_report(store.read("cnaes"), "cnaes", "2026-01-11").first()
    assert rep["matches"] is False and rep["n_rows"] == 1
    with pytest.warns(UserWarning, match="another reference date"):
        warn_on_snapshot_dates(store, ["cnaes"], "2026-01-11")


def test_store_reader_opened_before_a_publish_keeps_its_rows(spark, scratch):
    store = SnapshotStore(spark, os.path.join(scratch, "silver"))
    kind = "codigo string, descricao string"
    assert not store.exists("cnaes")
    store.publish(spark.createDataFrame([("1", "old")], kind), "cnaes", required="codigo")
    opened = store.read("cnaes")
    store.publish(spark.createDataFrame([("1", "new"), ("2", "new")], kind), "cnaes", required="codigo")
    assert [r["descricao"] for r in opened.collect()] == ["old"]
    # a version whose publish never happened (driver lost after the write) is not read
    spark.createDataFrame([("9", "unchecked")], kind).write.parquet(f"{store.path('cnaes')}/v-feed")
    assert sorted(r["descricao"] for r in store.read("cnaes").collect()) == ["new", "new"]
    assert len(store.drop_old("cnaes")) == 1 and len(store.marks("cnaes")) == 1
    assert store.read("cnaes").count() == 2
