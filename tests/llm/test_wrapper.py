import re

import pytest
from pyspark.sql import functions as F

from sylvan.llm import wrapper as W
from sylvan.llm.queries import op4_html_extract

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<header>Site name</header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- x --><div class="ad">Buy &amp; save</div>
<aside class="sidebar">Side</aside><div class="cookie-notice">We use cookies</div><article><h1>Title {n}</h1>
<p>First   text &lt;{n}&gt;<br>after {n}<p>Second <b>bo</b>ld&nbsp;{n}</p><div>Share this page</div><form><input>Send</form>
<ul><li>one {n}<li>two</ul></article><section id="comments"><article class="comment">Nice!</article></section>
<footer>&copy; host</footer></body></html>"""


def expected(n, share=False):
    return f"Title {n} First text <{n}> after {n} Second bold {n} {'Share this page ' if share else ''}one {n}{' two' if share else ''}"


def frame(spark, pages):
    return spark.createDataFrame([(*p, 1, "x") for p in pages], "page_id long, url string, html string, host int, seed string")


def test_constant_nodes_go(spark):
    many = [(i, "http://site.example/p", PAGE.format(n=f"{i} and {i * 7}")) for i in range(12)]
    got = {r.page_id: r for r in W.extract(frame(spark, many)).collect()}
    # 'Share this page' and the item 'two' are alike on every page of the host: template
    for i in range(12):
        assert got[i].text == expected(f"{i} and {i * 7}") and got[i].n_chars == len(got[i].text)
    few = {r.page_id: r.text for r in W.extract(frame(spark, many[:3])).collect()}
    assert few == {i: expected(f"{i} and {i * 7}", share=True) for i in range(3)}


def test_copies_do_not_make_a_template(spark):
    copies = [(i, "http://site.example/p", PAGE.format(n="same")) for i in range(20)]
    assert {r.text for r in W.extract(frame(spark, copies)).collect()} == {expected("same", share=True)}


def test_odd_rows(spark):
    pages = [
        (1, "http://a/x", None), (2, "http://a/x", ""), (3, None, "<p>no host"), (None, "", "plain &amp text"),
        (4, "http://a/x", "<article><p>cut in the mid"), (5, "http://a/x", "<body><div>a<!-- open"), (6, "http://a/x", "<a href='x"),
        (7, "http://a/x", "<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000), (7, "http://a/x", "</p></div>stray<br/>end &copy; &#x41;"),
        (8, "http://b/", "<main><p>in main</p></main><p>outside"), (9, "http://b/", "<article>" + "<p>long words here" * 20_000 + "</article>"),
    ]
    got = sorted(((r.page_id, r.text[:40], r.n_chars) for r in W.extract(frame(spark, pages)).collect()), key=repr)
    want = [
        (1, "", 0), (2, "", 0), (3, "no host", 7), (None, "plain & text", 12), (4, "cut in the mid", 14), (5, "a", 1), (6, "", 0),
        (7, "deep", 4), (7, "stray end © A", 13), (8, "in main", 7), (9, ("long words here " * 3)[:40], 20_000 * 16 - 1),
    ]
    assert got == sorted(want, key=repr)
    assert W.extract(frame(spark, pages).filter("1 = 0")).count() == 0


def test_simple_tree_matching():
    m = W.Matcher()
    a, b = m.tree("<div><p>x</p><ul><li>1<li>2</ul></div>"), m.tree("<div><h1>t</h1><p>y</p><ul><li>1</ul><p>z</p></div>")
    pairs = [(p.tag, q.tag) for p, q in m.align(a, b)]
    assert sorted(pairs) == sorted([("#root",) * 2, ("div",) * 2, ("p",) * 2, ("#text",) * 2, ("ul",) * 2, ("li",) * 2, ("#text",) * 2])
    assert m.score(a, b) == len(pairs) == m.score(b, a)


def _brute_score(a, b):
    if a.tag != b.tag:
        return 0
    x, y = ([k for k in n.kids if k.tag != "#blank"] for n in (a, b))
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, p in enumerate(x):
        for j, q in enumerate(y):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + _brute_score(p, q))
    return 1 + best[-1][-1]


def test_matching_against_plain_dynamic_programming(spark):
    pages = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(12).collect()]
    m = W.Matcher()
    trees = [m.tree(p) for p in pages]
    for a in trees:
        for b in trees[:4]:
            assert m.score(a, b) == _brute_score(a, b) == sum(1 for _ in m.align(a, b))


def test_query_gives_the_article(spark):
    """The synthetic pages have one article without template text: its markup stripped is the answer."""
    import html

    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = op4_html_extract(spark, sf).collect()
    assert len(got) == len(pages)
    for r in got:
        body = re.search(r"(?s)<article>(.*?)(?:</article>|$)", pages[r.page_id])
        parts = re.split(r"<(?:/?(?:p|h1)|br)>", re.sub(r"<[^>]*$", "", body[1]) if body else "")
        want = " ".join(filter(None, (" ".join(html.unescape(re.sub("<[^>]+>", "", p)).split()) for p in parts)))
        assert (r.text, r.n_chars) == (want, len(want))


def test_hosts(spark):
    urls = {"http://A.b:80/x": "a.b", "https://u@h.c/": "h.c", "no url": "", None: "", "ftp://x.y?z": "x.y"}
    df = spark.createDataFrame([(u,) for u in urls], "u string").select("u", W.host(F.col("u")).alias("h"))
    assert {r.u: r.h for r in df.collect()} == urls


@pytest.mark.parametrize("cls,kept", [("comment-list", False), ("post-body", True), ("main-nav", False), ("loading", True), ("ad-slot", False)])
def test_class_words(cls, kept):
    assert W.main_text(W.parse(f'<div class="{cls}">t</div>'), set()) == ("t" if kept else "")


LONG = "Words of the article that vary from page to page and make up nearly all of what the page says to its readers."


@pytest.mark.parametrize("page", [
    '<div class="with-sidebar"><p>{}</p></div>', '<main class="no-comments"><p>{}</p></main>', "<form><div>{}</div></form>",
    '<article class="post hentry category-social"><p>{}</p></article>', '<article title="The hidden costs"><p>{}</p></article>',
    '<form id="page"><nav>Menu</nav><article>{}</article></form>', '<div class="sidebar"><main>{}</main></div>',
    '<div class="sidebar"><article>{}</article></div>', '<article class="social">{}</article>', '<main class="widget">{}</main>',
    '<article><div data-note="hidden" title="display: none">{}</div></article>',
])
def test_names_take_no_article(page):
    for text in ("Few words", LONG):
        assert W.main_text(W.parse(page.format(text)), set()) == text


def test_named_element_with_most_of_the_text_stays():
    assert W.main_text(W.parse(f'<div class="menu">{LONG}</div><div>More</div>'), set()) == f"{LONG} More"
    extras = '<div class="comments">Nice</div><p hidden>h</p><p style="display: none">n</p><form>Send</form><p aria-hidden=true>a</p>'
    assert W.main_text(W.parse(f"<p>{LONG}</p>{extras}"), set()) == LONG
    related = '<div class="related"><article>Teaser</article></div>'
    assert W.main_text(W.parse(f"<article>{LONG}</article>{related}"), set()) == LONG


def _texts(spark, pages):
    return {r.page_id: r.text for r in W.extract(frame(spark, pages)).collect()}


def test_layouts_have_templates_of_their_own(spark):
    one = "<body><div class='blog'><article><h1>T {n}</h1><p>Story of {n} and {m}</p><p>Share it</p></article></div></body>"
    two = "<body><main class='shop'><table><tr><td>Item {n} at {m}</td></tr></table><section>Call us</section></main></body>"
    error = "<body><div class='error'><p>Gone {n}</p></div></body>"
    made = [(i, (one, one, one, two, two)[i % 5] if i else error, i * 37 + 5) for i in range(40)]
    pages = [(i, "http://mixed.example/", page.format(n=f"n{m}", m=f"m{m}")) for i, page, m in made]
    want = {i: f"T n{m} Story of n{m} and m{m}" if page == one else f"Item n{m} at m{m}" if page == two else f"Gone n{m}" for i, page, m in made}
    assert _texts(spark, pages) == want


def test_template_that_the_reference_lacks(spark):
    page = "<body><article><p>Story of {n}, of {n} again</p>{more}</article></body>"
    ids = spark.range(20).selectExpr("id", "xxhash64(id) as h").orderBy("h").collect()
    first = ids[0].id
    pages = [(i, "http://a/", page.format(n=f"n{i}", more="" if i == first else "<p>Share it</p>")) for i in range(20)]
    assert _texts(spark, pages) == {i: f"Story of n{i}, of n{i} again" for i in range(20)}
    # near copies of one another that differ from the reference keep their common text
    copies = [(i, "http://a/", page.format(n="x", more=f"<p>A long text {'on the same words ' * 9}</p><p>Seen {i}</p>")) for i in range(20)]
    copies[first] = pages[first]
    got = _texts(spark, copies)
    assert all("A long text" in got[i] and f"Seen {i}" in got[i] for i in range(20) if i != first)


COMMENTS = " ".join(f"Reader {i} says that this is a very long answer to what was written above." for i in range(20))


@pytest.mark.parametrize("page", [
    '<article><p>{}</p><section id="comments">{c}</section></article>', '<main><p>{}</p><ol class="commentlist"><li>{c}</li></ol></main>',
    '<main><p>{}</p><div class="article-comments"><p>{c}</p></div></main>', '<main><p>{}</p><div class="sidebar-widget-area">{c}</div></main>',
    '<div class="post"><p>{}</p></div><div id="disqus_thread">{c}</div>', '<article><p>{}</p><div class="comment-list"><article>{c}</article></div></article>',
    '<p>{}</p><div class="user-comments"><article class="entry">{c}</article></div>', '<div class="sidebar"><p>{}</p></div><div id="comments">{c}</div>',
    '<main><p>{}</p><div class="related">{c}</div><form>{c}</form></main>',
])
def test_long_comments_under_an_article_go(page):
    assert W.main_text(W.parse(page.format(LONG, c=COMMENTS)), set()) == LONG


def test_forms_between_paragraphs_go():
    page = "<p>First short one.</p><form><p>Sign up now for the letter</p></form><p>Second.</p>"
    assert W.main_text(W.parse(page), set()) == "First short one. Second."
    assert W.main_text(W.parse(f"<h1>Title</h1><form>{LONG}</form>"), set()) == f"Title {LONG}"
    assert W.main_text(W.parse(f'<div id="comments"><p>{COMMENTS}</p></div>'), set()) == ""


def test_hosts_whose_comments_are_longer_than_their_articles(spark):
    layouts = [
        "<body><nav>Home</nav><article><h1>T {n}</h1><p>Post of {n}.</p><section class='comments'>{c}</section></article></body>",
        "<body><div class='page'><main><p>Post of {n}.</p><ol class='commentlist'>{c}</ol></main><footer>f</footer></div></body>",
        "<body><div class='content'><p>Post of {n}.</p></div><div id='comments' class='comments-area'>{c}</div></body>",
    ]
    pages, want = [], {}
    for i in range(60):
        k = i % 3
        said = "".join(f"<li><p>Reader {j} of {i * 31 + j} thinks {'so ' * (j % 7 + 3)}</p></li>" for j in range(i % 9 + 2))
        n = f"n{i * 13}"
        pages.append((i, f"http://host{k}.example/{i}", layouts[k].format(n=n, c=said)))
        want[i] = f"T {n} Post of {n}." if k == 0 else f"Post of {n}."
    assert _texts(spark, pages) == want
