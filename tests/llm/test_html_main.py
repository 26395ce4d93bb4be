"""Main text of pages: markup, regions, and templates of a site."""

import html
import re

import pytest

from tabulon.llm import html_main
from tabulon.sources.tables import read_table


def text(page):
    return " ".join(b[0] for b in html_main.page_blocks(page))


@pytest.mark.parametrize("page, expected", [
    (None, ""), ("", ""), ("   ", ""), ("<br><br>", ""), ("just text", "just text"),
    ("<p>a <b>b</b>c<p>d&amp;e &#233; &nbsp; f", "a bc d&e é f"),
    ("<article><h1>T</h1><p>x<br>y</p></article><footer>f</footer>", "T x y"),
    ("<script>var t='</p>';</script><style>p{}</style><p>x</p><SCRIPT>y</script>z", "x z"),
    ("<nav>menu<article><p>kept</p></article>", "kept"),
    ("<header>h</header><main><header><h1>t</h1></header><p>b</p></main><aside>s</aside>", "t b"),
    ("<article>a<form>f<input></form>b<div class='ad-slot'>ad</div></article>", "a b"),
    ("<article class=post>text</article><section id=comments><article class=comment>no</article>"
     "</section>", "text"),
    ("<body class='with-sidebar'><div class=sidebar>s</div><div id=content>c</div></body>", "c"),
    ("<div role=navigation>n</div><div>body</div><div class='cookieNotice'>c</div>", "body"),
    ("<!-- <p>no</p> --><p title='a>b'>yes</p><!doctype x><?pi?>", "yes"),
    ("<ul><li>one<li>two</ul><table><tr><td>1<td>2</table>", "one two 1 2"),
    ("<p>a < b and c</p>", "a < b and c"),
    ("<p hidden>h</p><div style='display:none'>n</div>shown", "shown"),
    ("<textarea>t</textarea><p>x</p><noscript><p>n</p></noscript>", "x"),
    ("</div></p></article>x", "x"),
    # Names that may as well be the article's own do not count inside it.
    ("<article><p>a</p><section class=discussion><p>b</p></section></article>", "a b"),
    ("<main><div class='search-results-analysis'>c</div><div class=form>d</div></main>", "c d"),
    ("<article><div class='ad-hoc'>e</div><div class='ad-slot-2'>no</div></article>", "e"),
    ("<article>f<div id=comments>no</div><div class='share-buttons'>no</div></article>", "f"),
    ("<div class=discussion>no</div><p>g</p>", "g"),
])
def test_pages(page, expected):
    assert text(page) == expected


def test_deep_and_long_pages():
    assert text("<div>" * 50_000 + "x") == "x"
    assert len(text("<p>word " * 100_000).split()) == 100_000
    assert text("<" * 5000) == "<" * 5000
    assert text("<p title=\"" + "x" * 100_000).startswith("<p title=")


def test_table(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    found = {r["page_id"]: r for r in html_main.main_text(pages).collect()}
    assert len(found) == pages.count()
    for r in pages.collect():
        inner = re.search("<article>(.*?)(</article>|$)", r["html"], re.S)[1]
        inner = re.sub("<[^>]*>", "", re.sub("</?(p|br|h1)>", " ", inner))
        want = " ".join(html.unescape(inner).split())
        assert found[r["page_id"]]["text"] == want
        assert found[r["page_id"]]["n_chars"] == len(want)


def site(n, host="http://a.example/", body="<div>Boiler plate of the site</div>"):
    return [(i, f"{host}{i}", f"{body}<div><p>own text {i}</p><p>shared sentence</p></div>")
            for i in range(n)]


def test_templates_of_a_site_go(spark):
    rows = site(8) + [(100 + i, f"http://b.example/{i}", h) for i, _, h in site(3)]
    rows += [(200 + i, "http://c.example/", "<div>copy</div><p>of one page</p>")
             for i in range(9)]
    rows += [(300, None, "<p>no host</p>"), (301, "mailto:x", None), (302, "http://a.example", "")]
    found = {r["page_id"]: (r["text"], r["n_removed"]) for r in html_main.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert len(found) == len(rows)
    assert all(found[i] == (f"own text {i}", 2) for i in range(8))       # on most pages
    assert all("Boiler plate" in found[100 + i][0] for i in range(3))    # on too few pages
    assert all(found[200 + i][0] == "copy of one page" for i in range(9))
    assert found[300][0] == "no host" and found[301][0] == "" and found[302][0] == ""


def extract(spark, rows):
    return {r["page_id"]: (r["text"], r["n_removed"]) for r in html_main.main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_counted_subtrees_decide(spark):
    """Boxes in neutral tags without telling names: inside articles and without any region, on
    all pages and in one section of a large host; the same boxes stay on a small host."""
    def page(i, box, article=True):
        own = f"<p>own text {i}</p><div><p>a box of {i}</p></div><p>the same sentence</p>"
        main = f"<article>{own}<div><p>{box}</p></div></article>" if article else (
            f"<div><span>{box}</span></div><section>{own}</section>")
        return f"<div><a href=/>home</a></div>{main}<div>end of page</div>"

    rows = [(i, f"http://big.example/{i}", page(i, "Read more" if i % 10 else f"once {i}"))
            for i in range(80)]
    rows += [(100 + i, f"http://loose.example/{i}",
              page(i, "On sale" if i < 6 else f"once {i}", False)) for i in range(200)]
    rows += [(400 + i, f"http://small.example/{i}", page(i, "Read more")) for i in range(4)]
    found = extract(spark, rows)
    for i in range(80):
        more = "" if i % 10 else f" once {i}"
        text, n = found[i]
        assert text == f"own text {i} a box of {i} the same sentence{more}"
        assert n == 2 + (i % 10 > 0)                      # two boxes around, one inside
    for i in range(200):
        box = "" if i < 6 else f"once {i} "
        # Without a region the sentence of every page goes too.
        assert found[100 + i][0] == f"{box}own text {i} a box of {i}"
    for i in range(4):
        assert found[400 + i] == (f"own text {i} a box of {i} the same sentence Read more", 0)


def test_menus_of_the_table_are_counted(spark, sf_dir):
    """Elements around the article that recur are templates; the text does not change."""
    from pyspark.sql import functions as F

    pages = read_table(spark, sf_dir, "pages")
    one = pages.withColumn("url", F.lit("http://one.example/"))
    text = {r["page_id"]: r["text"] for r in html_main.main_text(pages).collect()}
    copies = one
    for k in range(1, 6):
        copies = copies.unionByName(one.select(
            (F.col("page_id") + 10_000 * k).alias("page_id"), "url",
            F.regexp_replace("html", "</h1>", f" copy {k}</h1>").alias("html")))
    found = {r["page_id"]: r for r in html_main.main_text(copies).collect()}
    assert all(found[i]["text"] == t for i, t in text.items())
    assert all(r["n_removed"] >= 3 for r in found.values())      # menu, advert and footer


def test_sentences_inside_articles_stay(spark):
    rows = [(i, u, f"<article>{h}</article>") for i, u, h in site(8)]
    found = html_main.main_text(spark.createDataFrame(
        rows, "page_id long, url string, html string")).collect()
    for r in found:
        assert r["text"] == f"own text {r['page_id']} shared sentence"


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame(site(2), "page_id long, url string, html string")
    assert html_main.main_text(df.where("false")).count() == 0
    more = df.selectExpr("*", "1 as host", "'t' as text", "2 as _row", "3 as blocks")
    assert {r["text"] for r in html_main.main_text(more).collect()} == {
        f"Boiler plate of the site own text {i} shared sentence" for i in range(2)}
