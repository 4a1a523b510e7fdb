"""Archive selection against a brute-force model of the rules, plus top-k / dedupe."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from terrace.operators import selection as SEL

FIXTURE_LINKS = [
    "/x/Cnaes.zip", "Empresas10.zip", "Empresas2.zip", "Empresas0.ZIP", "EMPRESAS1.zip", "Socios.zip",
    "Socios0.zip", "notes.txt", "cnaes.zip", "Empresas2.zip", "Simples.ZIP", "Empresas00.zip", "q/Empresas3.zip?x=1",
]
FIXTURE_FILTERS = "Cnaes, Empresas,,Socios,Simples,Nada"


def model(hrefs, filters, n):
    """Expected (filter, position) pairs, straight from the rule text."""
    zips = [(i, h) for i, h in enumerate(hrefs) if h.lower().endswith(".zip")]
    out = []
    for f in filters:
        exact = [i for i, h in zips if h.rsplit("/", 1)[-1].lower() == f.lower() + ".zip"]
        if exact:
            out.append((f, max(exact)))
            continue
        series = []
        for i, h in zips:
            m = re.fullmatch(re.escape(f) + r"([0-9]+)\.zip", h.strip().rsplit("/", 1)[-1], flags=re.I)
            if m:
                series.append((int(m.group(1)), i))
        out += [(f, i) for _, i in sorted(series)[:n]]
    return out


def run_selection(spark, cases, filters, n):
    rows = [(cid, "http://idx.example/d/", pos, h) for cid, hrefs in enumerate(cases) for pos, h in enumerate(hrefs)]
    links = spark.createDataFrame(rows, "page_id long, url string, pos long, href string")
    sel = SEL.select_files(links, SEL.filter_table(spark, filters), n, "2026-01-11")
    got = {}
    for r in sel.collect():
        got.setdefault(r["page_id"], []).append((r["dataset_filter"], r["pos"]))
    return got


def names(hrefs, pairs):
    return [(f, hrefs[i]) for f, i in pairs]


@pytest.mark.parametrize("n", [1, 3, 6])
def test_fixture_selection(spark, n):
    filters = [f.strip() for f in FIXTURE_FILTERS.split(",") if f.strip()]
    got = run_selection(spark, [FIXTURE_LINKS], FIXTURE_FILTERS, n)[0]
    assert Counter(got) == Counter(model(FIXTURE_LINKS, filters, n))
    picked = Counter(h for _, h in names(FIXTURE_LINKS, got))
    if n == 1:
        assert picked == Counter(["cnaes.zip", "Empresas0.ZIP", "Socios.zip", "Simples.ZIP"])
    if n == 6:
        assert picked["Empresas2.zip"] == 2 and picked["Empresas10.zip"] == 1


def test_random_link_lists(spark):
    rnd = random.Random(7)
    parts = ["Empresas", "EMPRESAS", "empresas", "Socios", "X1", "x", "Cnaes", "Simples"]
    cases = []
    for _ in range(200):
        hrefs = []
        for _ in range(rnd.randint(0, 12)):
            stem = rnd.choice(parts)
            num = rnd.choice(["", "0", "1", "2", "10", "01", "12", "007", "99999999999999999999999"])
            suffix = rnd.choice([".zip", ".ZIP", ".zip", ".txt", ".zip?x=1"])
            prefix = rnd.choice(["", "", "a/", "/b/c/", "https://m.example/z/", " "])
            hrefs.append(prefix + stem + num + suffix)
        cases.append(hrefs)
    filters = ["Empresas", "Socios", "X1", "X", "Cnaes", "Nada"]
    for n in (0, 2):
        got = run_selection(spark, cases, filters, n)
        for cid, hrefs in enumerate(cases):
            assert Counter(got.get(cid, [])) == Counter(model(hrefs, filters, n)), (n, hrefs)


def test_negative_max_files_rejected(spark):
    links = spark.createDataFrame([(0, "u", 0, "a.zip")], "page_id long, url string, pos long, href string")
    with pytest.raises(ValueError):
        SEL.select_files(links, SEL.filter_table(spark, ["a"]), -1)


def test_selection_records_and_gate(spark):
    links = spark.createDataFrame(
        [(0, "https://h.example/arq/2026-01-11/", 0, "Empresas0.zip"), (1, "https://h.example/x/", 0, "other.zip")],
        "page_id long, url string, pos long, href string",
    )
    sel = SEL.select_files(links, SEL.filter_table(spark, "Empresas"), 1, "2026-01-11")
    r = sel.first()
    assert (r["zip_name"], r["zip_url"], r["dataset"], r["reference_date"]) == (
        "Empresas0.zip", "https://h.example/arq/2026-01-11/Empresas0.zip", "empresas", "2026-01-11")
    rep = {x["page_id"]: x["passed"] for x in SEL.selection_report(links, sel).collect()}
    assert rep == {0: True, 1: False}
    SEL.enforce_selection(sel)
    with pytest.raises(SEL.SelectionError):
        SEL.enforce_selection(sel.filter(F.lit(False)))


def test_top_per_group_plans_partial_limit(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id"))
    top = SEL.top_per_group(df, ["g"], [F.col("id").desc()], 2)
    assert sorted((r["g"], r["id"]) for r in top.collect()) == [(0, 996), (0, 999), (1, 994), (1, 997), (2, 995), (2, 998)]
    from conftest import plan_text

    plan = plan_text(top)
    assert "WindowGroupLimit" in plan


def test_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("b", 2, "z"), ("a", 2, "w")], "k string, p int, v string")
    got = sorted(tuple(r) for r in SEL.last_per_key(df, ["k"], F.col("p")).collect())
    assert got == [("a", 3, "y"), ("b", 2, "z")]
