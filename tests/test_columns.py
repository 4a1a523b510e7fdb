"""Scalar column functions on the edge values of the registry format."""

from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from terrace.functions import columns as C


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {typ}")
    return [r["o"] for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


def test_comma_decimal(spark):
    vals = ["1000,00", "0,00", "-3,1", " 5,5 ", "1.234,56", "1,2,3", "abc", "", None]
    assert one_col(spark, vals, C.comma_decimal) == [1000.0, 0.0, -3.1, 5.5, None, None, None, None, None]


def test_lenient_date(spark):
    import datetime as dt

    vals = ["20260111", "99991231", "19000101", "00000000", "0", "", "20260230", "2026-01-11", "202601",
            "202601110", " 20260111", "20260111 ", None]
    got = one_col(spark, vals, C.lenient_date)
    assert got[:3] == [dt.date(2026, 1, 11), dt.date(9999, 12, 31), dt.date(1900, 1, 1)]
    assert got[3:] == [None] * 10


def test_lenient_int_like_scan(spark):
    vals = ["02", "7", "-3", "x", " 2", "2.0", "2147483648", ""]
    assert one_col(spark, vals, C.lenient_int) == [2, 7, -3, None, None, None, None, None]


def test_clean_nul(spark):
    df = spark.createDataFrame([("a#b##",)], "v string").select(F.regexp_replace("v", "#", C.nul()).alias("v"))
    assert df.select(C.clean_nul("v").alias("o")).first()["o"] == "a b  "


@pytest.mark.parametrize(
    "name,parity,strict",
    [
        ("Empresas0.zip", "empresas", "empresas"),
        ("x/Estabelecimentos12.zip", "estabelecimentos", "estabelecimentos"),
        ("Cnaes.zip", "cnaes", "cnaes"),
        ("EMPRESAS0.ZIP", "empresas0.zip", "empresas"),
        ("a.zip.zip", "a", "a.zip"),
    ],
)
def test_dataset_name(spark, name, parity, strict):
    assert one_col(spark, [name], C.dataset_name) == [parity]
    assert one_col(spark, [name], lambda c: C.dataset_name(c, strict_suffix=True)) == [strict]


def test_basename_and_zip_suffix(spark):
    vals = ["/x/Cnaes.zip", "Empresas2.zip", "q/Empresas3.zip?x=1", "notes.txt", "a/b/", "S.ZIP"]
    assert one_col(spark, vals, C.basename) == ["Cnaes.zip", "Empresas2.zip", "Empresas3.zip?x=1", "notes.txt", "", "S.ZIP"]
    assert one_col(spark, vals, C.is_zip_link) == [True, True, False, False, False, True]


def test_split_list(spark):
    got = one_col(spark, ["Cnaes, Empresas,,Socios", " a , a ,", "", None], C.split_list)
    assert got == [["Cnaes", "Empresas", "Socios"], ["a", "a"], [], None]


@pytest.mark.parametrize(
    "base,href",
    [
        ("https://h.example/arquivos/2026-01-11/", "Empresas0.zip"),
        ("https://h.example/arquivos/2026-01-11/", "/x/Cnaes.zip"),
        ("https://h.example/arquivos/2026-01-11/index.html?x=1", "a/b.zip"),
        ("https://h.example/arquivos/", "https://mirror.example/c.zip"),
        ("https://h.example/arquivos/", "//cdn.example/c.zip"),
        ("http://h.example", "/c.zip"),
        ("https://h.example/arquivos/", " Beta3.zip"),
        ("https://h.example/a/b", "c.zip"),
    ],
)
def test_resolve_url_matches_urljoin(spark, base, href):
    df = spark.createDataFrame([(base, href)], "b string, h string")
    assert df.select(C.resolve_url("b", "h").alias("o")).first()["o"] == urljoin(base, href)


def test_date_parts_and_landing_key(spark):
    df = spark.createDataFrame([("2026-01-11",)], "d string")
    y, m, d = C.date_parts(F.col("d"))
    assert tuple(df.select(y, m, d).first()) == ("2026", "01", "11")
    key = df.select(C.landing_key(F.lit("cnpj"), F.lit("empresas"), F.to_date("d"), F.lit("K.CSV")).alias("k")).first()["k"]
    assert key == "cnpj/empresas/year=2026/month=01/day=11/K.CSV"


def test_date_parts_strict(spark):
    df = spark.createDataFrame([("2026-13-45",)], "d string")
    with pytest.raises(Exception):
        df.select(*C.date_parts(F.col("d"))).collect()


@pytest.mark.parametrize("base, href", [
    ("http://h", "x.zip"), ("http://h?q=1", "x.zip"), ("http://h/a/b/", "../x.zip"), ("http://h/a/b", "./x.zip"),
    ("http://h/a/b", "/c/../x.zip"), ("http://h/a/b", "?x.zip"), ("http://h/a/b", "HTTP:x.zip"), ("http://h/a/b", "//o/x"),
])
def test_resolve_url_normalises_like_urljoin(spark, base, href):
    from urllib.parse import urljoin

    df = spark.createDataFrame([(base, href), (base, None)], "b string, h string")
    assert [r["o"] for r in df.select(C.resolve_url("b", "h").alias("o")).collect()] == [urljoin(base, href), None]


BASES = ["http://h", "http://h/a/b/", "https://h.example/d/index.html?x=1#f", "/local/dir/f", "", "file:///tmp/x/", "s3a://b/k/",
         "HTTP://H/a//b/c;p?q", "http://h/a;x/b;y", "mailto:x@y", "//h/p", "http://h//", "svn://h/a/b;c", " http://h/a/", "http://h/../x/y", "http:"]
HREFS = ["x.zip", "../x.zip", "./x.zip", "/c/../x.zip", "?x", "HTTP:x.zip", "//o/../x", "", "..", ".", "../../../x", "a/./b/../c", "/", "/..", "a//b",
         "https://m/c.zip", " Beta3.zip", "a\tb\n.zip", "#frag", "x?", "x;p", "x;", "..;p", "x;p/y", "javascript:void(0)", "a:b", "1:b", "x?y/../z#k?z",
         "...", "a/..", "http:", "http:/x", ";p", "file:x", "svn:x;y", "\x01 x", "//", "///x", "x/?q;r", "é/ü b.zip"]


def test_resolve_url_equals_urljoin_on_every_pair(spark):
    from conftest import plan_text

    rows = [(b, h, urljoin(b, h)) for b in BASES for h in HREFS]
    df = spark.createDataFrame(rows, "b string, h string, w string").withColumn("o", C.resolve_url("b", "h"))
    assert [tuple(r) for r in df.filter(~F.col("o").eqNullSafe(F.col("w"))).collect()] == []
    assert "EvalPython" not in plan_text(df)
