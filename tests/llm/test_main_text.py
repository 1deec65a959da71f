import html
import re

import pytest
from pyspark.sql import functions as F

from stayscope.llm import main_text, page_labels, queries

TREE = main_text.trained()


def text(source):
    return main_text.main_texts([source], TREE)[0]


def words(n, start=0):
    return " ".join(f"w{start + i}" for i in range(n))


#: Layouts that no labelled page has; main text is marked.
HELD_OUT = [
    """<html><head><title>T</title><style>p{}</style></head><body class="home"><header class="top"><p>Site</p></header>
    <nav class="primary"><a href=1>Home</a><a href=2>News</a></nav><div class="layout"><article id="a1">
    <h1>§Title here</h1><p>§First <b>bold</b>, <i>then</i> more.</p><p>§Short.</p><div class="advert">Buy this now</div>
    <h2>§Sub</h2><p>§Another paragraph with <a href=x>a link</a> inside it.</p><ul><li>§One</li><li>§Two</li></ul></article>
    <aside class="right"><p>Most read today is this other thing</p></aside></div><section id="comments"><h3>Comments</h3>
    <p>I liked this text a lot and read it twice on my way home today</p></section><footer>Imprint</footer></body></html>""",
    """<div class="cookieConsent"><p>This site uses cookies to do things with data that you may not like at all, ok?</p></div>
    <div id="navBar"><ul><li><a>One</a><li><a>Two</a></ul></div><div role="main"><h1>§Head</h1><p>§A<br>B<p>§Unclosed para
    <p>§Next one</div><div class="related-posts"><h4>Related</h4><p>Another story which is not part of this one</p></div>
    <form action=/s><input name=q><label>Search</label><select><option>x</select></form>""",
    """<main><section class="entry-content"><p>§only</p><p>§"""
    + words(50)
    + """</p></section><section class="comments-list"><article><p>"""
    + words(60)
    + """</p></article></section></main>""",
    "<div><a href=1>Home</a> <a href=2>About us</a> <a href=3>Contact</a></div><h1>§Some plain old page title</h1>"
    + "".join(f"<p>§{words(n)}</p>" for n in (40, 55, 30, 61))
    + "<div><a href=4>Next page</a></div><p>&copy; 2020 Someone</p>",
    """<nav>a b c</nav><article><p>§Cookies are small, subscribe to nothing, all rights reserved.</p><p>§x</p>""",
]


@pytest.mark.parametrize("source", HELD_OUT)
def test_unseen_layouts(source):
    plain = source.replace("§", "")
    want = [" ".join(re.sub(r"<br>", " ", re.sub(r"</?(b|i|a)\b[^>]*>", "", x)).split())
            for x in re.findall(r"§((?:[^<]|<(?:/?(?:b|i|a)\b[^>]*|br)>)*)", source)]
    assert text(plain) == " ".join(want)


def test_words_and_links_of_neighbours_decide_where_markup_says_nothing():
    rows, labels = main_text.labelled_blocks([page_labels.expand(p) for p in page_labels.PLAIN])
    assert (TREE.predict(rows) == labels).mean() >= 0.95


def test_labelled_pages_held_out_one_by_one():
    right = total = 0
    for i, page in enumerate(page_labels.MARKED):
        rest = [page_labels.expand(p) for k, p in enumerate([*page_labels.MARKED, *page_labels.PLAIN]) if k != i]
        tree = main_text.Tree(*main_text.labelled_blocks(rest))
        rows, labels = main_text.labelled_blocks([page_labels.expand(page)])
        right, total = right + (tree.predict(rows) == labels).sum(), total + len(labels)
    assert right >= 0.9 * total


@pytest.mark.parametrize(
    ("inner", "want"),
    [
        ("a&amp;b &lt;p&gt; &eacute;&#233;&#xE9; &nbsp; x&nbsp;y", "a&b <p> ééé x y"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("a<!-- > <p> -->b<script>'</p>'</script>c", "abc"),
        ("a<SCRIPT>x</ScRiPt >b<style>c</style>", "ab"),
        ('<span title="a > b">in</span>side', "inside"),
        ("tab\tand\n new  line", "tab and new line"),
        ("<p>one</p>\n\n<p>  </p><p>two</p>", "one two"),
        ("&am &amp &a", "&am & &a"),
        ("cut <a href='x", "cut"),
        ("x</div></p></b></section> y", "x y"),
        ("<textarea>no</textarea>yes<noscript>no</noscript>", "yes"),
    ],
)
def test_decoding(inner, want):
    assert text(f"<nav>n</nav><article>{inner}</article>") == want or text(f"<nav>n</nav><article>{inner}") == want


def test_nothing_of_a_long_page_is_dropped():
    many = "".join(f"<p>{words(1 + i % 9, i)}</p>" for i in range(30_000))
    want = re.sub("<p>|</p>", " ", many).split()
    assert text(f"<nav><a>x</a></nav><article>{many}</article><footer>f</footer>").split() == want


def test_hostile_markup_stays_linear():
    for piece in ("<a '", '<p "', "<!--", "<div>", "</p", "<script>", "&", "<x <y "):
        text("<article><p>kept</p>" + piece * 20_000)


def test_rows(spark, tmp_path):
    page = "<nav>m</nav><article><p>é text</p></article>"
    rows = [(1, "u", page), (1, "u", page), (2, None, None), (None, "v", ""), (3, "w", "<nav>only a menu</nav>")]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = queries.op13_html_extraction(spark, str(tmp_path))
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.schema["n_chars"].dataType.simpleString() == "bigint"
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        [(1, "u", "é text", 6), (1, "u", "é text", 6), (2, None, "", 0), (None, "v", "", 0), (3, "w", "", 0)], key=str
    )


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "<article>a</article>", "old", 7)], "t int, html string, text string, n_chars int")
    found = main_text.extract(docs.withColumn("o0", F.lit(3)))
    assert [r.asDict() for r in found.collect()] == [{"t": 1, "text": "a", "n_chars": 1, "o0": 3}]
    assert main_text.extract(docs.limit(0)).collect() == []


def test_every_page_of_the_table(spark):
    """All pages of the test table have one article; its text is what is to be found."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    sources = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in queries.op13_html_extraction(spark, "/root/testdata/sf0.001").collect():
        source = sources[r["page_id"]]
        inner = source[source.index("<article>") : source.index("</article>")]
        plain = re.sub(r"</?b>", "", inner)
        assert r["text"] == " ".join(html.unescape(re.sub(r"<[^>]*>", " ", plain)).split())
