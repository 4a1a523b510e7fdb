"""Link extraction from raw HTML pages."""

from terrace.sources.links import extract_links

HTML = """<html><body>
<a href="Empresas0.zip">one</a>
<A HREF='Socios.zip'>two</A>
<a class="x" href=Cnaes.zip>three</a>
<a href="">empty</a>
<a name="anchor">no href</a>
<a data-href="fake.zip">not an href</a>
<abbr href="nope.zip">abbr</abbr>
<a title="t" href="q?a=1&amp;b=2">amp</a>
<a
  href="/multi/line.zip">multi-line tag</a>
</body></html>"""


def test_extract_links(spark):
    pages = spark.createDataFrame([(7, "https://h.example/d/", HTML)], "page_id long, url string, html string")
    rows = [(r["page_id"], r["pos"], r["href"]) for r in extract_links(pages).orderBy("pos").collect()]
    assert rows == [
        (7, 0, "Empresas0.zip"),
        (7, 1, "Socios.zip"),
        (7, 2, "Cnaes.zip"),
        (7, 3, "q?a=1&b=2"),
        (7, 4, "/multi/line.zip"),
    ]
    assert dict(extract_links(pages).dtypes)["pos"] == "bigint"


def test_links_follow_html_rules(spark):
    html = (
        '<!-- <a href="hidden.zip">x</a> --><script>var a = "<a href=\'s.zip\'>";</script>'
        '<a title="a > b" href="q.zip">q</a><a/href="slash.zip">s</a><a href="d&#x2E;zip">d</a><a href="caf&eacute;.zip">e</a>'
    )
    pages = spark.createDataFrame([(1, "https://h/", html), (2, "https://h/", None)], "page_id long, url string, html string")
    rows = [r["href"] for r in extract_links(pages).orderBy("page_id", "pos").collect()]
    assert rows == ["q.zip", "slash.zip", "d.zip", "caf\u00e9.zip"]
