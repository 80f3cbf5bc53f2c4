"""Main text of web pages: elements, templates counted per host, and hard inputs."""

import os
import sys
import time

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
pytest.importorskip("terrier.llm")

from terrier.llm import htmltext as ht  # noqa: E402

ARTICLE = "<article><h1>Title</h1><p>One <b>two</b>three.</p><p>Four&nbsp;five &lt;six&gt;</p></article>"


@pytest.mark.parametrize("html, want", [
    (None, ""), ("", ""), (" \n ", ""), ("plain  text\n here", "plain text here"), ("1 < 2 & 3 &amp; 4", "1 < 2 & 3 & 4"),
    (f"<html><head><title>T</title><style>p{{}}</style></head><body><nav><a>Home</a></nav>{ARTICLE}<footer>f</footer></body></html>",
     "Title One twothree. Four five <six>"),
    ("<article><p>a<script>var t='</p></article>';</script>b</p></article>", "ab"),
    ("<article><p>a<p>b<br>c<li>d<li>e</article>f", "a b c d e"),
    ("<article><p><b>a<br><p>b</p></article>", "a b"),
    ("<article><p title='x > y'>a</p><p title=\"it's > b\">b</p></article>", "a b"),
    ("<article><p>a<!-- <p>no</p> --></p><!-- > -->b</article>", "a b"),
    ("<article><p>a</p></article><!-- open <p>b", "a"), ("<article><p>a</p><p", "a"),
    ("<article><p>a</p><aside>x</aside><form><input>y</form><div class='ad-box'>z</div><div id=cookieNotice>n</div></article>", "a"),
    ("<article><div class='post no-sidebar'><p>a</p></div></article>", "a"),
    ("<article><p>a</p><section class=comments><article class=comment>c</article></section></article>", "a"),
    ("<body><div class=comments><article>c</article></div><div id=x><h1>T</h1><p>a</p></div>", "T a"),
    ("<header>Site</header><div id=content><h1>T</h1><p>a</p></div><div class=sidebar>s</div>", "T a"),
    ("<article><header><h1>T</h1></header><p>a</p><footer>f</footer></article>", "T a"),
    ("<main><p>a</p></main><p>b</p>", "a"), ("<div role=main>a</div>b", "a"),
    ("<article>a</article><article>b</article>c", "a b"),
    ("<article><p hidden>x</p><p style='display: none'>y</p><p>a</p></article>", "a"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a b c"),
    ("<article><p>&eacute;&#233;&#x41;&amp</p></article>", "ééA&"),
    ("<ARTICLE><P>a</P></ARTICLE>", "a"),
])
def test_elements(html, want):
    assert ht.main_text(html) == want


def page(i, body, host="site.example"):
    return (i, f"http://{host}/p/{i}", body)


def unique(i):
    return f"<div><p>Page number {i * 'x'} tells of {hash(str(i)) % 9 * 'y'} and of nothing else at all, number {'i' * i}.</p></div>"


@pytest.fixture
def site(spark):
    """A site without semantic elements: a bar and a notice on every page, under plain names."""
    rows = [page(i, f"<body><div class=q1><ul><li>Home<li>News</ul></div>{unique(i)}<div class=z9>All rights {2000 + i}</div></body>") for i in range(1, 21)]
    rows += [page(100 + i, f"<body>{unique(3)}<p>Copied once more.</p></body>", "copies.example") for i in range(30)]
    rows += [page(200 + i, f"<body><article><p>Shared line of many articles.</p><p>Own {'o' * i}</p></article></body>", "shared.example") for i in range(20)]
    rows += [(300, None, "<div class=q1><ul><li>Home<li>News</ul></div>"), (301, "nohost", None), (1, "http://site.example/p/1", rows[0][2])]
    return spark.createDataFrame([(*r, "clash", 5) for r in rows], "page_id long, url string, html string, text string, host int")


@pytest.mark.parametrize("few", [500_000, 0])
def test_templates_of_a_host_are_deleted(site, few):
    got = {r.page_id: r for r in ht.extract(site, few=few).collect()}
    assert ht.extract(site, few=few).count() == site.count()
    for i in range(1, 21):
        assert got[i].text.startswith("Page number") and got[i].text.endswith(f"number {'i' * i}."), got[i].text
        assert got[i].n_chars == len(got[i].text)
    assert all(got[100 + i].text.endswith("Copied once more.") and "Page number" in got[100 + i].text for i in range(30))
    assert all(got[200 + i].text == f"Shared line of many articles. Own {'o' * i}".strip() for i in range(20))
    assert got[300].text == "Home News" and (got[301].text, got[301].n_chars) == ("", 0)


def test_templates_equal_brute_force(site):
    """Counts of Spark against counts of all pages in one process."""
    least, share = 5, 0.005
    by_host, pages = {}, {}
    for r in site.select("url", "html", ht.host().alias("h")).collect():
        if r.h is not None:
            found, context = ht.subtrees(r.html)
            pages[r.h] = pages.get(r.h, 0) + 1
            for d in found:
                by_host.setdefault((r.h, d), []).append(context)
    want = {k for k, c in by_host.items() if len(c) >= max(least, share * pages[k[0]]) and 2 * max(map(c.count, c)) <= len(c)}
    got = {tuple(r) for r in ht.site_templates(site, least, share).collect()}
    assert got == want and len(want) >= 3


def test_hosts(spark):
    rows = [("http://A.b/x", "a.b"), ("https://a.b?x", "a.b"), ("x://a.b#f", "a.b"), ("a.b/x", None), (None, None), ("http:///x", None), ("http://a.b", "a.b")]
    got = spark.createDataFrame(rows, "url string, want string")
    out = got.select(ht.host().alias("h"), ht.F.xxhash64("want").alias("w"), "want").collect()
    assert all((r.h == r.w) if r.want else r.h is None for r in out)


def test_empty_table(spark):
    out = ht.extract(spark.createDataFrame([], "page_id long, url string, html string"))
    assert out.count() == 0 and out.columns == ["page_id", "url", "text", "n_chars"]


@pytest.mark.parametrize("html", [
    "<div>" * 100_000, "<a " * 100_000, "<p title=\"x " * 50_000 + ">", "<b><p>x</b>" * 50_000, "<!-- " * 100_000,
    "<script " * 50_000 + ">", "<i>" * 50_000 + "</b></i>" * 50_000, "<article>" + "<p>word " * 100_000, "x" * 5_000_000, "<li>" * 50_000 + "</ul>" * 50_000])
def test_long_pages_take_linear_time(html):
    started = time.time()
    ht.main_text(html, {1})
    ht.subtrees(html)
    assert time.time() - started < 20
