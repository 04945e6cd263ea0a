import html
import re

import pytest

from tidemark.llm import html_text, queries

SIDE = "page_id long, url string, html string, text string, row int"


def text(source):
    return " ".join("".join(s[2] for s in html_text.Page(source).segments()).split())


@pytest.mark.parametrize(
    "source, wanted",
    [
        (None, ""),
        ("", ""),
        ("plain &amp; simple &lt;b&gt;", "plain & simple <b>"),
        ("<p>a<b>b</b>c<p>d &eacute;&#x41;&#66;&nbsp;\n e</p>", "abc d éAB e"),
        ("a < b > c <> d", "a < b > c <> d"),
        ("<article><h1>T</h1><p>x<br>y</article><footer>z</footer>", "T x y"),
        ("<head><title>t</title></head><body><header>h</header><main><header><h1>H</h1></header>m<aside>s</aside></main></body>", "H m"),
        ("<script>var t='</p><p>';</script>x<style>p{}</style><!-- c > d -->y<noscript>n</noscript>", "xy"),
        ("<article>a<div class='ad box'>no</div><div id=comments-list><p>no</p></div>b</article>", "a b"),
        ("<nav><ul><li>m<li>n</ul></nav><div class='x'>keep</div><form>f<input></form>", "keep"),
        ("<div role=navigation>m</div><div hidden>h</div><div style='display: none'>d</div><p>p", "p"),
        ("<article>one<p>two<a href='x>y'>three</a></p></article><div>out</div>", "one twothree"),
        ("<div class=sidebar>s</div><div class='post-content'><p>in</p></div><div>out</div>", "in"),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", "a b c d"),
        ("<p>open <b>bold<br><p>next</article> stray</b> <i", "open bold next stray"),
        ("<textarea>t</textarea><script>never closed <p>x", ""),
        ("<article class='comment'>c</article><article>real</article>", "real"),
        ("<div class='side-bar'>s</div><div id=ads2>a</div><div class='pop_up box'>p</div><div class=sideways>keep</div>", "keep"),
    ],
)
def test_pages(source, wanted):
    assert text(source) == wanted


@pytest.mark.parametrize(
    "source, wanted",
    [
        ("<div class='site has-sidebar'><header>h</header><article><header><h1>T</h1></header>long text</article><div class=ads>a</div></div>", "T long text"),
        ("<article class='post has-comments'>the text<div class=comments>c</div></article>", "the text"),
        ("<article class='hentry category-search tag-social'><p>the text</p></article>", "the text"),
        ("<form id=aspnetForm><input><nav>m</nav><article>the text<form>f</form></article></form>", "the text"),
        ("<div class='layout--sidebar-right'><main>the text</main><div class=sidebar>s</div></div>", "the text"),
        ("<div class=sidebar><article>teaser</article></div><div><p>all of the body</p></div>", "all of the body"),
        ("<div id=comments><article class=comment-body>a comment longer than all else</article></div><article>real</article>", "real"),
        ("<div><p>the body</p></div><div id=comments><article>a comment longer than the body</article></div>", "the body"),
        ("<div><p>the body</p></div><article class=comment-body>a comment longer than the body</article>", "the body"),
        ("<aside><article>never, however long it may be</article></aside><p>p", "p"),
    ],
)
def test_names_do_not_take_the_article(source, wanted):
    assert text(source) == wanted


def site(i, body):
    return f"<html><body><div><span>Our site</span><a>Home</a></div>{body}<div>Bottom line {i % 2}</div></body></html>"


def test_templates_of_a_host(spark):
    rows = [(i, f"http://a.org/{i}", site(i, f"<div><p>Story number {i}.</p><p>Told once {i * 7}.</p></div>"), "t", 0) for i in range(12)]
    rows += [(100 + i, f"http://b.org/{i}", site(0, "<div><p>Same page.</p></div>"), "t", 0) for i in range(9)]
    rows += [(200, "http://c.org/", site(0, "<div><p>Alone.</p></div>"), "t", 0), (201, None, site(0, "<p>No host</p>"), None, 0)]
    rows += [(300 + i, f"http://d.org/{i}", f"<article><p>Shared words.</p><div>Sign here</div><p>Own {i}.</p></article>", "", 0) for i in range(20)]
    rows += [(400, "http://a.org/x", None, None, None), (None, "http://a.org/y", "", None, None), (401, "http://e.org", "<p>" + "w " * 300_000, "", 0)]
    pages = spark.createDataFrame(rows + rows[:2], SIDE)
    table = html_text.extract(pages).collect()
    assert len(table) == len(rows) + 2
    got = {r.page_id: r.text for r in table}
    assert all(got[i] == f"Story number {i}. Told once {i * 7}." for i in range(12))
    assert all(got[100 + i] == "Our siteHome Same page. Bottom line 0" for i in range(9))
    assert got[200] == "Our siteHome Alone. Bottom line 0" and got[201] == "Our siteHome No host Bottom line 0"
    assert all(got[300 + i] == f"Shared words. Own {i}." for i in range(20))
    assert got[400] == got[None] == "" and len(got[401]) == 599_999
    assert all(r.n_chars == len(r.text) for r in table)
    assert html_text.extract(pages.limit(0)).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_articles_of_the_table(spark, sf):
    root = f"/root/testdata/{sf}"
    pages = {r.page_id: r for r in spark.read.parquet(f"{root}/pages.parquet").collect()}
    got = queries.op1_html(spark, root).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search("<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        assert r.text == " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))
