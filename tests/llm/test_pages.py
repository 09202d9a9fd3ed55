import html
import random
import re
import time

from tidemill.llm import html_text, queries

PAGE = """<!doctype html><html><head><title>t</title><style>p{}</style></head><body>
<header><h1>Site name</h1></header><div id="cookie-notice">We use cookies for many good reasons, as you may know</div>
<ul class="menu"><li><a href="/">Home</a><li><a href="/a">About us</a></ul>
<div class="wrap"><div class="post"><h2>Title &amp; more</h2><p>First para with some words &lt;ok&gt;.
<p>Second&nbsp;  para<br>line two <a href="x>y">a link</a> more.<ul><li>item one is here</li><li>item two too</li></ul>
<div class="ads">Buy now buy now</div><script>if (a < b) document.write("<p>no</p>")</script><p>Last para of the text, it ends.</p>
</div><aside>Related things to see</aside><section id="comments"><p>Great post, thanks for all of this, really!</p></section></div>
<form>Subscribe to our news <input name=q></form><footer>All rights reserved by us and others and so on</footer></body></html>"""

TEXT = "Title & more\n\nFirst para with some words <ok>.\n\nSecond para line two a link more.\n\nitem one is here\n\nitem two too\n\nLast para of the text, it ends."


def test_a_page_without_labels():
    assert html_text.main_text(PAGE, html_text.DEFAULT) == TEXT


def test_the_pages(spark):
    """Against the text of the article element, cut out by pattern."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").toPandas()
    got = {r["page_id"]: r for r in queries.op5_main_text(spark, "/root/testdata/sf0.01").collect()}
    for page in pages.itertuples():
        body = re.search("<article>(.*?)</article>", page.html, re.S)[1].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", body))
        want = "\n\n".join(b for b in blocks if b)
        assert (got[page.page_id]["text"], got[page.page_id]["n_chars"]) == (want, len(want))


def test_the_pages_without_their_label(spark):
    """Weights learned on the pages find the same text where article is a div."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").toPandas()["html"].tolist()
    weights = html_text.learn(pages)
    for page in pages:
        renamed = page.replace("<article>", "<div>").replace("</article>", "</div>")
        assert html_text.main_text(renamed, weights) == html_text.main_text(page, weights) != ""


def test_weights_decide_on_pages_with_a_label():
    """A label adds to the score and does not settle it."""
    long_text = " ".join(f"word{i}" for i in range(60))
    teaser = f"<body><div><p>{long_text}</p></div><hr><hr><hr><article><p>Read this too</p></article></body>"
    dear = html_text.Weights(tags={"hr": -6.0})
    assert html_text.main_text(teaser, dear) == long_text
    # Of two texts of one length the labelled one is taken, and the title outside with it.
    other = " ".join(f"other{i}" for i in range(60))
    page = f"<div><p>{other}</p></div>" + "<hr>" * 15 + f"<h1>A title of five words</h1><article><p>{long_text}</p></article>"
    assert html_text.main_text(page, dear) == f"A title of five words\n\n{long_text}"
    # Links that end an article are worth what such words were worth on labelled pages.
    links = f"<article><p>{long_text}</p>" + '<ul><li><a href="/">more</a></li></ul>' * 3 + "</article>"
    assert html_text.main_text(links, html_text.Weights(weak=0.02)) == long_text


def test_content_in_a_marked_wrapper():
    """Marked elements that hold the page, and headings of the content, are read."""
    words = " ".join(f"word{i}" for i in range(80))
    other = " ".join(f"other{i}" for i in range(300))
    line = "<footer>All rights reserved</footer><div><p>Made by us</p></div>"
    read = lambda page: html_text.main_text(page, html_text.DEFAULT)
    wrappers = ("<div class='layout has-sidebar'>", "<div id='page' class='menu-open'>", "<div class='search-result'>", "<div class='search'>", "<div id='nav-page'>", "<div class='ad-page'>", "<form id=aspnetForm>", "<header>")
    for start in wrappers:
        end = f"</{html_text._PART.findall(start)[0]}>"
        inner = f"<h1>The title</h1><article><p>{words}</p></article>"
        assert words in read(f"<body>{start}{inner}{end}{line}</body>"), start
        # The label is not what brings it back.
        assert words in read(f"<body>{start}{inner.replace('article', 'div')}{end}{line}</body>"), start
    # More comments than text, a menu or a form beside it, stay what they are.
    comments = f"<section id='comments'><p>{other}</p></section>"
    assert read(f"<div class='search'><p>{words}</p></div>{comments}") == words
    assert read(f"<div><p>{words}</p></div>{comments}") == words
    menu = "<div class='menu'>" + "<li><a href='/'>one more link</a></li>" * 60 + "</div>"
    assert read(f"{menu}<form>Log in here</form><div><p>{words}</p></div>") == words
    for head in ("<div class='entry-header'><h1>The title</h1></div>", "<header><h1>The title</h1></header>"):
        assert read(f"<header>Site name</header><article>{head}<p>{words}</p><form>Ask us</form></article>") == f"The title\n\n{words}"
    # Marked elements side by side and one within the other, and many of them.
    assert read(f"<form><div class=menu><p>{words}</p></div></form><form><p>few words</p></form>{line}") == words
    assert read("<div class=ad>" * 3000 + "deep") == "deep"


def test_best_stretch():
    assert html_text.best_stretch([-1, 2, -1, 3, -5, 3]) == (1, 4)
    assert html_text.best_stretch([]) == (0, 0)
    assert html_text.best_stretch([-1.0, -2.0]) == (0, 0)


def test_best_stretch_against_all_stretches():
    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.randint(-4, 4) for _ in range(rng.randint(0, 14))]
        sums = {(a, b): sum(scores[a:b]) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)}
        first, end = html_text.best_stretch(scores)
        assert sum(scores[first:end]) == max([0, *sums.values()])


def test_long_broken_pages_are_read_in_one_go():
    """Ten times the page takes about ten times as long, not a hundred times."""
    broken = ["<a ", "</p>", "<b \"> x \"", "<a '\">", "<!x", "<div class='", "<p <b>", "<a title=\"x", "<? ", "<"]
    for piece in broken:
        start = time.perf_counter()
        html_text.main_text("<div>" * 5000 + piece * (500_000 // len(piece)), html_text.DEFAULT)
        assert time.perf_counter() - start < 10, piece
    read = lambda page: html_text.main_text(page, html_text.DEFAULT)
    # A broken tag ends where the next one starts; quotes may hold signs of tags.
    assert read("<div>some words here <a href=x <b>more</b> of them</div>") == "some words here more of them"
    assert read("<div title='a < b > c' id=\"x>y\">some words</div>") == "some words"
    assert read("<div>one < two, <3 and 4 > 3</div>") == "one < two, <3 and 4 > 3"


def test_odd_pages(spark):
    long_page = "<article><p>" + "word " * 100_000 + "</article>"
    rows = [(1, None), (2, ""), (3, "<"), (4, "<div><p>unclosed <b>text"), (5, "plain & text &copy"), (6, long_page), (6, long_page), (None, "<p>x</p>"), (7, '<div class="ad"><p>only marked</p></div>'), (8, "<script>x"), (9, "a<!-- b"), (10, "<p>" * 20000 + "deep")]
    pages = spark.createDataFrame(rows, "page_id int, html string").selectExpr("*", "1 as pulled", "2 as Text", "3 as n_chars")
    weights = html_text.fit_sample(pages)
    out = html_text.extract(pages, weights)
    assert out.columns == ["page_id", "html", "pulled", "text", "n_chars"]
    got = {r["page_id"]: r["text"] for r in out.collect()}
    assert [got[i] for i in (1, 2, 8)] == ["", "", ""]
    assert (got[4], got[5], got[7], got[9], got[10]) == ("unclosed text", "plain & text ©", "only marked", "a", "deep")
    assert len(got[6]) == 499_999 and got[None] == "x"
    assert html_text.extract(pages.limit(0), weights).count() == 0
    assert html_text.fit_sample(pages.limit(0)) == html_text.DEFAULT
