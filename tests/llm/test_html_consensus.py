"""Main text of web pages against hand-made pages and an extraction by the standard library's parser."""

import html
import time
from html.parser import HTMLParser

import pytest

from siftlake.llm import queries
from siftlake.llm.html_consensus import PATH_CHARS, Page, extract, host_paths

SCHEMA = "page_id long, url string, html string, host string, paths string, text string, n_chars int"
NEWS = """<!doctype html><html><head><title>T &lt; x</title><meta name=a><script>if (a<b) document.write("<p>no</p>")</script></head><body class="has-sidebar cookie">
<header id=top><img src=logo.png><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></ul></nav>
<div class="cookie-notice">We use cookies. Really many of them, and we tell you at length about it.</div>
<div id="wrap"><div class="content post-{n}"><h1>Title  {n}</h1>
<p class=byline>By A.&nbsp;Writer<p>First &amp; <b>bold<i> words</b></i>, <a href=x>a link</a>.<br>Same block.
<div class="ad-slot3">Buy now!</div><p>Second<!-- hidden > --> para<script>x="</p>"</script>graph with &eacute; &#233; &#x1F600; &unknown; R&D.</p>
<ul><li>one<li>two <ul><li>inner</ul></ul><form action=/s><p>Your mail <input name=q><button>Go</button></form>
<blockquote>Quoted.</blockquote><table><tr><td>a<td>b<tr><th>c</table><div class="share-buttons"><a>Tweet</a></div>
<section id="comments"><article class="comment"><p>First!</p><p>A very long reader comment, longer than the whole article above. {more}</p></article></section></div>
<div class="sidebar"><p>Popular: {more}</p></div></div><footer><p>&copy; all</footer></body></html>"""
NEWS_TEXT = ["Title {n}", "By A. Writer", "First & bold words, a link. Same block.", "Second paragraph with é é 😀 &unknown; R&D.",
             "one", "two", "inner", "Quoted.", "a", "b", "c"]


def news(n, more="word " * 10):
    return NEWS.replace("{n}", str(n)).replace("{more}", more), "\n\n".join(NEWS_TEXT).replace("{n}", str(n))


def extracted(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, "h", "p", "t", 1) for r in rows], SCHEMA).repartition(parts)
    out = extract(df)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = out.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    return {r["page_id"]: r["text"] for r in got}


def test_article_without_the_rest():
    source, want = news(7)
    assert Page(source).main_text([]) == want


def test_article_elements_and_their_headers():
    source = """<body><header><p>Site header</p></header><main><article><header><h1>Head<wbr>line</h1><p>Shared 5 times</p></header><p>Body one.</p>
      <aside>Pull quote</aside><figure><img><figcaption>Caption.</figcaption></figure><p hidden>gone</p><p style="display : none">gone</p><p>Body two.</p>
      <div role=complementary>gone</div><footer>Tags</footer></article><div class="related"><article><h2>Other</h2><p>Teaser</p></article></div></main></body>"""
    assert Page(source).main_text([]) == "Headline\n\nBody one.\n\nCaption.\n\nBody two."


def test_a_form_around_the_page_and_plain_pages():
    body = "<form id=aspnet><div class=menu>M</div><div><h1>H</h1><p>" + "Text of it. " * 20 + "</p></div></form>"
    assert Page(body).main_text([]) == "H\n\n" + ("Text of it. " * 20).strip()
    assert Page("just text\n\nwithout  tags").main_text([]) == "just text without tags"
    assert Page("<p>a<p>b").main_text([]) == "a\n\nb"
    assert Page("").main_text([]) == "" == Page("<nav>x</nav>").main_text([])


def test_hosts_agree_on_their_path(spark):
    rows, want = [], {}
    for n in range(12):
        source, want[n] = news(n)
        rows.append((n, f"https://Paper.example/{n}", source))
    # Alone, this page's best container is a list of teasers; its host knows better.
    odd = "<body><div id=wrap><div class='content post-99'><p>Short.</p></div><div class=teasers>" + "<p>Teaser text of another page, long enough.</p>" * 9 + "</div></div></body>"
    rows += [(50, "http://paper.example/odd?x", odd), (51, "http://other.example/", odd), (52, None, odd), (53, "nowhere", odd)]
    got = extracted(spark, rows)
    assert {n: got[n] for n in want} == want
    assert got[50] == "Short."
    assert {got[n] for n in (51, 52, 53)} == {"\n\n".join(["Teaser text of another page, long enough."] * 9)}


def test_two_templates_of_a_host(spark):
    one, two = "<body><div class=story><h1>A</h1><p>Alpha text, long.</p></div><div class=col9>Buy</div></body>", "<body><section class=x1><h1>B</h1><p>Beta text, long.</p></section><p>tail</body>"
    rows = [(i, "http://h/", one if i % 3 else two) for i in range(30)]
    got = extracted(spark, rows)
    assert {got[i] for i in range(30) if i % 3} == {"A\n\nAlpha text, long."} and {got[i] for i in range(0, 30, 3)} == {"B\n\nBeta text, long."}


def test_hosts_beyond_a_broadcast_give_the_same(spark, monkeypatch):
    rows = [(n, f"http://h{n % 5 if n % 2 else 0}/", news(n)[0]) for n in range(40)]
    want = extracted(spark, rows)
    monkeypatch.setattr("siftlake.llm.html_consensus.BROADCAST_CHARS", 0)
    assert extracted(spark, rows) == want


def test_odd_rows(spark):
    source, text = news(1)
    rows = [(None, "http://a/", source), (1, "http://a/", None), (2, "http://a/", ""), (3, None, None), (4, "http://a/", source), (4, "http://a/", source), (5, "http://a/", "<" * 50)]
    df = spark.createDataFrame([(*r, "h", "p", "t", 1) for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in extract(df).collect()), key=str)
    long = "<" * 50
    want = [(None, "http://a/", text, len(text)), (1, "http://a/", "", 0), (2, "http://a/", "", 0), (3, None, "", 0), *[(4, "http://a/", text, len(text))] * 2, (5, "http://a/", long, 50)]
    assert got == sorted(want, key=str)
    assert extract(df.limit(0)).isEmpty() and host_paths(df.limit(0)).isEmpty()


class Article(HTMLParser):
    """What stands in the article element, broken at paragraphs and headings."""

    def __init__(self):
        super().__init__()
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside |= tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        if tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        self.inside &= tag != "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_the_query_on_the_given_pages(spark):
    folder = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in queries.op13_html_consensus(spark, folder).collect()}
    assert len(got) == len(pages)
    for page in pages:
        parser = Article()
        parser.feed(page["html"])
        parser.close()
        text = "\n\n".join(x for x in (" ".join(b.split()) for b in parser.blocks) if x)
        assert got[page["page_id"]] == (page["url"], text, len(text))


@pytest.mark.parametrize("part", ["<!--", "<script", "<a ", "<a href=", "<p a='", "&", "&#9", "<", "</", "<!-", "<b class=ad>", "x <div>", "<td>", "<p><b>", "<button><p>"])
def test_long_input_takes_time_in_proportion(part):
    def spent(times):
        start = time.process_time()
        Page(part * times).main_text([])
        return time.process_time() - start

    assert spent(40_000) < 12 * spent(10_000) + 0.5


def test_paths_are_bounded_and_references_decoded():
    page = Page("<div class='abcdefgh12 zz3'>" * 300 + "&#" + "9" * 6000 + ";&amp &lt;&notit; &#0;&#65;")
    assert max(map(len, page.path)) <= PATH_CHARS and page.path[2] == ">div.abcdefgh#.zz#>div.abcdefgh#.zz#"
    assert page.main_text([]) == "�& <" + html.unescape("&notit;") + " �A"
