"""Every registered query against its SQL oracle (DuckDB, in-process) on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from terrace import queries as catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(catalogue.QUERIES)


def norm(v):
    if v is None:
        return "<null>"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}"
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, bool):
        return str(v).lower()
    return str(v)


def canon(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def test_every_query_has_an_oracle():
    from terrace.queries import ORACLES, QUERIES

    assert set(ORACLES) == set(QUERIES) and set(ORACLES) <= set(entry_mod.oracle_sql())


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["uf", "cnae_fiscal_principal", "descricao_cnae", "qtd_empresas_ativas", "reference_date"]
    assert df.count() > 0


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(entry_mod.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = canon(cols, cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want
