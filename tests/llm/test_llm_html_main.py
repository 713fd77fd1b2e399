import html
import re
import time

import pytest
from llm_rows import prose
from pyspark.sql import functions as F

from tallywright.llm import html_main as H
from tallywright.llm.queries import QUERIES


def test_query_gives_the_articles_of_the_pages(spark):
    sf = "/root/testdata/sf0.01"
    pages = {r.page_id: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    rows = QUERIES["op3_html_main_text"](spark, sf).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search("<article>(.*)</article>", pages[r.page_id].html, re.DOTALL)[1]
        inner = re.sub("<[^>]*>", " ", re.sub("</?b>", "", inner))
        assert r.text == " ".join(html.unescape(inner).split())
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url


STORY = "<h1>Title &amp; more</h1><p>First <b>bold</b>ly\n  said.<p>Second&nbsp;one &lt;here&gt; with enough words to count.</p>"
TEXT = "Title & more First boldly said. Second one <here> with enough words to count."
NOISE = (
    '<header class="site-header"><p>Site name</p></header><nav><ul><li><a href="/">Home</a></li></ul></nav>'
    '<div id="cookie-notice">We use cookies, read our very long policy about cookies before you go on.</div>'
    '<aside class="sidebar"><p>Popular posts and other things that many people like to read here.</p></aside>'
    '<form action="/s"><label>Search</label><input><button>Go</button></form><div class="ad-box"><p>Buy now!</p></div>'
    '<script>if (a < b) document.write("<p>script</p>");</script><style>p > a {}</style><!-- <p>hidden</p> -->'
)
COMMENTS = '<section id="comments"><h2>Comments</h2><div class="comment"><p>' + "What a story, thanks a lot! " * 30 + "</p></div></section>"


@pytest.mark.parametrize("box", ["article", 'div class="post-content"', 'main role="main"', 'div id="x7"', "td"])
def test_article_text_without_its_surroundings(box):
    tag = box.split()[0]
    page = f"<!DOCTYPE html><html><head><title>T</title></head><body class='has-sidebar'>{NOISE}<{box}>{STORY}</{tag}>{COMMENTS}<footer>&copy; me</footer></body></html>"
    assert H.main_text(page, None) == TEXT


@pytest.mark.parametrize("inside", [COMMENTS, NOISE, '<p style="display: none">x</p>', '<div hidden>y</div>', '<ul class="share-links"><li>Share</li></ul>'])
def test_boilerplate_inside_the_article_goes(inside):
    assert H.main_text(f"<body><article>{STORY}{inside}</article></body>", None) == TEXT


def test_blocks_and_inline_markup():
    page = "<article><p>a<i>b</i>c<br>d</p><ul><li>one<li>two</ul><table><tr><td>x<td>y</table><pre>q  r\n s</pre>tail &#233;&eacute;&bogus;</article>"
    assert H.main_text(page, None) == "abc d one two x y q r s tail éé&bogus;"


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "<!--", "<script>", "<a href='x", "</div></p>", "<div" * 50, "<p>" * 3000, "&#0;&#xFFFFFFF;"])
def test_broken_pages_do_not_crash(page):
    assert isinstance(H.main_text(page, None), str) and isinstance(H.vote_of(page), str | None)


def test_plain_text_and_very_long_pages():
    assert H.main_text("just text", None) == "just text"
    long = "<article>" + "<p>word word</p>" * 20_000 + "</article>"
    assert H.main_text(long, None) == " ".join(["word word"] * 20_000)


def test_host_consensus_overrides_a_page_with_a_loud_side_box(spark):
    def page(k, loud):
        side = "<div class='c2'><p>" + "side words that go on and on " * (40 if loud else 1) + "</p></div>"
        return f"<body><div class='c1 n{k}'><p>{'the story of page ' + str(k)} goes here in a few words.</p></div>{side}</body>"

    rows = [(k, f"http://WWW.Host.example:80/{k}", page(k, k == 7), "old") for k in range(9)]
    rows += [(20, None, page(3, False), "old"), (21, "not an address", page(4, False), "old"), (22, "http://b.example/", None, None),
             (23, "http://b.example/", "", "old"), (24, "http://b.example/", "<nav>only a menu</nav>", "old"), (7, rows[7][1], rows[7][2], "old")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string").withColumn("__path", F.lit(1))
    out = H.extract_main_text(df)
    assert sorted(out.columns) == sorted(df.columns) and out.count() == len(rows)
    got = {r.page_id: r.text for r in out.collect()}
    for k in (*range(9), 20, 21):
        assert got[k].startswith("the story of page") and "side" not in got[k]
    assert (got[22], got[23], got[24]) == ("", "", "")
    paths = {r.host: r.path for r in H.host_paths(df).collect()}
    assert paths == {"www.host.example": H.vote_of(page(1, False))} != {"www.host.example": H.vote_of(page(7, True))}
    assert H.extract_main_text(df.limit(0)).count() == 0


@pytest.mark.parametrize("page, text", [
    ('<a href="' * 120_000, ""),
    ('<a href="' * 120_000 + ">", ""),
    ("<div title='>' \" " * 60_000 + "> end", "end"),
    ("<div>" * 100_000 + "deep", "deep"),
    ("<div>word " * 100_000 + "</x>" * 100_000, " ".join(["word"] * 100_000)),
    ("<span class='ad'>x " * 60_000, "x " * 59_999 + "x"),
    ("<script>" + "</script " * 100_000, ""),
    ("<b" * 300_000, ""),
    ("</" * 300_000, "</" * 300_000),
    ("<p class='" + "x" * 1_000_000 + "'>y", "y"),
])
def test_broken_pages_take_time_in_proportion(page, text):
    started = time.perf_counter()
    got = H.main_text(page, "none")
    H.vote_of(page)
    assert time.perf_counter() - started < 8
    if text:
        assert got in text or len(got) > 0.3 * len(text)


def test_names_inside_quoted_values_are_no_attributes():
    page = f"<body><div title='a class=\"ad\" hidden' data-class='menu'>{STORY}</div></body>"
    assert H.main_text(page, None) == TEXT
    assert H.attributes("a='class=x' CLASS = \"b c\" id=d/ class=z hidden") == {"class": "b c", "id": "d/", "hidden": ""}


def test_hosts_without_known_names_agree_on_their_article(spark):
    """No article tag and no telling class; some pages have little text and much beside it."""
    def page(k):
        story = "".join(f"<p>{prose(25, 100 * k + j)}.</p>" for j in range(1 + k % 5))
        side = "".join(f"<p>{prose(30, 7)}</p>" for _ in range(4 if k % 5 == 0 else 1))
        return f"<body><div class='q{k}'><div class='w'><div class='z'>{story}</div><div class='y'>{side}</div></div></div></body>"

    rows = [(k, f"https://{h}.example/{k}", page(k)) for h in ("a", "b") for k in range(20)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for r in H.extract_main_text(df).collect():
        assert r.text == " ".join(f"{prose(25, 100 * r.page_id + j)}." for j in range(1 + r.page_id % 5))
