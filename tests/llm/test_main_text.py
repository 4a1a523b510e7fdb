"""Main text of pages: the method's parts, awkward pages, and the table's cases."""

import pytest

from terrace.llm import main_text as T

LONG = "This is a long paragraph of the article, number {}, and it goes on for a while so that it has some weight in the windows."
BODY = "".join(f"<p>{LONG.format(i)}</p>" for i in range(3))
TEXT = "\n".join(LONG.format(i) for i in range(3))
NOISE = LONG.format(99)

PAGES = {
    "marked parts of a page and of its article": (
        f"""<html><head><title>{NOISE}</title><style>p {{}}</style></head><body class="single no-sidebar"><header><h1>Site</h1><p>{NOISE}</p></header>
        <nav><ul><li><a href="/">{NOISE}</a></ul></nav><main><article class=post><header><h1>Title</h1></header>{BODY}<aside>{NOISE}</aside>
        <div class="ad-slot">{NOISE}</div><p class=notice>{NOISE}</p><form><label>{NOISE}</label><button>Go</button></form><p>The end.</p>
        <section id="reader-comments"><h2>Comments</h2><p>{NOISE}</p></section></article></main>
        <div id="cookie-notice">{NOISE}</div><script>document.write("<p>{NOISE}</p>")</script><footer>{NOISE}</footer></body></html>""",
        f"Title\n{TEXT}\nThe end.",
    ),
    "no article element, containers by class": (
        f"""<body><div id=header>{NOISE}</div><div class="mainMenu"><a href=a>One</a></div><div id=content><h1>Title</h1>{BODY}
        <div class=advert>{NOISE}</div><p>Short.</p><ul><li>one<li>two</ul></div><div id="sidebar">{NOISE}</div><div class="footer">{NOISE}</div>""",
        f"Title\n{TEXT}\nShort.\none\ntwo",
    ),
    "nothing marked: surge and dive alone": (
        f"""<body><div><div><a href=a>Home</a> <a href=b>About us and all the rest of it, here and there</a></div></div><div><div>Welcome</div></div>
        <div><div><h2>Title</h2>{BODY}<p>End.</p></div></div><div><div>Copyright 2020 by us</div></div></body>""",
        f"Title\n{TEXT}\nEnd.",
    ),
    "broken markup and references": (
        """<article><h1>T &amp;amp; &am</h1><p>a<b>b</b> \t c<br>d<p>e &lt;b&gt; &copy &nbsp; x<script>var t='</article>'</script> y<!-- <p>no</p> -->
        <table><tr><td>1<td>2<tr><td>3</table><div>z""",
        "T &amp; &am\nab c d\ne <b> © x y\n1 2\n3\nz",
    ),
    "quotes that never close, a tag cut off": ("""<article><p class="x>hello</p><p>more "text"</p><a hre""", 'hello\nmore "text"'),
    "a comment that never ends": ("<article><p>seen</p><!-- <p>hidden</p></article>", "seen"),
    "only a menu": ("<nav>x</nav>", ""),
    "plain text": ("just text\nand more", "just text and more"),
    "a reply is no article": ("<article><p>Intro</p></article><article class=comment><p>reply</p></article>", "Intro"),
    "short article": ("<div class=ad>" + NOISE + "</div><article><h1>Hi</h1><p>Yo.</p></article>", "Hi\nYo."),
}


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, want = PAGES[name]
    assert T.main_text(page) == want


def test_windows_surges_and_dives():
    lengths = T.np.array([0, 0, 5, 0, 0, 0, 40, 50, 0, 30, 0, 0, 0, 3])
    sums = T.window_sums(lengths)
    # the sum of three lines that end at i, as a plain loop says
    padded = [0, 0, *lengths.tolist(), 0, 0]
    assert sums.tolist()[: len(padded) - 2] == [sum(padded[i : i + 3]) for i in range(len(padded) - 2)]
    assert T.surges(lengths, 0.2) == [(6, 9)]
    assert T.surges(lengths, 0.0) == [(2, 2), (6, 9), (13, 13)]


def test_names_that_mark():
    assert all(map(T.marked, ("ad", "adBox", "site-header", "cookie_banner", "article-comments", "main-menu", "widget")))
    assert not any(map(T.marked, ("post-header", "has-sidebar content", "no-ads", "shared", "header-image article", "gradient", "")))


def test_extract_of_a_table(spark):
    kind = "page_id long, url string, html string, text string, n_chars long"
    long = "<article>" + "<p>é word</p>" * 20_000 + "</article>"
    rows = [(1, "u", PAGES["short article"][0]), (1, "u", PAGES["short article"][0]), (None, None, None), (2, None, ""), (3, "v", long)]
    got = T.extract(spark.createDataFrame([(*r, "clash", 9) for r in rows], kind))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    want = [(1, "u", "Hi\nYo.", 6), (1, "u", "Hi\nYo.", 6), (None, None, "", 0), (2, None, "", 0), (3, "v", "\n".join(["é word"] * 20_000), 7 * 20_000 - 1)]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert T.extract(spark.createDataFrame([], kind)).collect() == []
