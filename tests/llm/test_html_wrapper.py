"""Main text extraction: wrappers, boilerplate, mended markup, edge cases."""

import pytest

from wardflow.llm import html_wrapper as H

PAGE = """<!DOCTYPE html><html lang="en"><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body class="has-sidebar">
<header><nav><ul><li>Menu</ul></nav><h2>Site</h2></header><!-- note -->
<div class="{wrap}"><h1>Title &amp; more {n}</h1><p class="x1">First&nbsp;line<br>goes   on {n}<p>Second <b>bold<i>er</i></b> &lt;one&gt;
<div class="ad">Buy {n}</div><ul><li>item a<li>item b</ul><div class="share-buttons">Share</div>
<section id="comments"><p>A reader said</p></section><form><input>Send</form></div>
<aside>Related {n}</aside><footer>End</footer></body></html>"""
TEXT = "Title & more {n}\n\nFirst line goes on {n}\n\nSecond bolder <one>\n\nitem a\n\nitem b"


@pytest.fixture
def pages(spark):
    return lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string, host string, text string, path string")


@pytest.mark.parametrize("wrap", ["content", "post-12 hentry", ""])
def test_text_of_one_page(wrap):
    assert H.main_text(PAGE.format(wrap=wrap, n=1), None) == TEXT.format(n=1)


def test_article_is_preferred():
    page = "<body><div><p>Long teaser text around the article, longer than it is.</p></div><article><h1>A</h1><p>b</article><article class=comment><p>no</article>"
    assert H.main_text(page, None) == "A\n\nb"


def test_unclosed_and_odd_markup():
    for page, text in {
        "<article><p><b>Title<br><p>One</p><p>Two</article><footer>f": "Title\n\nOne\n\nTwo",
        "<article><p>a < b &copy &#169; &#x41;</p></article": "a < b © © A",
        "<article><p>x</p><!-- open": "x",
        "plain text": "plain text",
        "<article><table><tr><td>1<td>2<tr><td>3</table>tail</article>": "1\n\n2\n\n3\n\ntail",
        "<ARTICLE><P>Up</P></ARTICLE>": "Up",
        "<article><header><h1>H</h1></header><p>t</p><footer>by</footer></article>": "H\n\nt",
        "<article><div hidden>h</div><p style='display: none'>n</p><p>v</p></article>": "v",
    }.items():
        assert H.main_text(page, None) == text, page


def test_alignment_gives_optional_and_repeated_groups():
    one, two = (H.wrapper_of(H.parsed(f"<body><h1>a</h1>{x}<p>c</p></body>")) for x in ("<p>b</p><p>d</p>", "<img><table><tr><td>1</table>"))
    assert H.written(H.aligned(one, two)) == "html(body(h1(#) img? table(tr(td(#)))? p(#)+))"


def test_alternating_items_fold():
    page = "<body>" + "<h2>t</h2><p>x</p>" * 50 + "</body>"
    assert H.count(H.wrapper_of(H.parsed(page))) < 10


def test_hosts_share_a_wrapper(pages):
    rows = [(k, f"http://Site.example/{k}", PAGE.format(wrap="content", n=k), "x", "x", "x") for k in range(12)]
    rows.append((99, "http://site.example/odd", "<body><p>Only this</p></body>", "x", "x", "x"))
    found = {r["page_id"]: r for r in H.extracted(pages(rows)).collect()}
    assert all(found[k]["text"] == TEXT.format(n=k) and found[k]["n_chars"] == len(found[k]["text"]) for k in range(12))
    assert found[99]["text"] == "Only this"
    wrappers = H.wrappers(pages(rows)).collect()
    assert [w["host"] for w in wrappers] == ["site.example"] and "li(#)+" in wrappers[0]["expression"]


def test_edges(pages):
    long = "<article>" + "<p>w x</p>" * 20000 + "</article>"
    deep = "<article>" + "<div>" * 300 + "deep" + "</div>" * 300 + "</article>"
    rows = [(1, None, None), (2, "", ""), (None, "nonsense", "<p>a"), (3, "http://h/1", long), (3, "http://h/1", long), (4, "http://[bad", deep)]
    found = sorted(((r["page_id"] or 0, r["n_chars"]) for r in H.extracted(pages([(*r, None, None, None) for r in rows])).collect()))
    assert found == [(0, 1), (1, 0), (2, 0), (3, 20000 * 5 - 2), (3, 20000 * 5 - 2), (4, 4)]
    assert H.extracted(pages([])).count() == 0


def test_classes_and_ids_of_content_keep_its_text():
    for page, text in {
        '<article><h2 id="social-policy">a</h2><section id="related-work">b</section><p id="notice">c</p><p class="share-price">d</p></article>': "a\n\nb\n\nc\n\nd",
        '<article class="post comments-open"><p>t</p></article><div>x</div>': "t",
        '<main class="with-sidebar"><p>t</p></main><div>longer than it</div>': "t",
        '<div class="content-sidebar-wrap"><p>t t t t</p></div><div class="sidebar">x</div>': "t t t t",
        '<article><pre class="alert">a</pre><table id="menu"><tr><td>b</table><blockquote class="comment">c</blockquote></article>': "a\n\nb\n\nc",
        '<div class="notice"><p>all there is</p></div>': "all there is",
        '<main><article class="post"><p>t</article><article class="comment"><p>a comment</article></main>': "t",
        '<article><p>t<div class="related-posts">x</div><article class="comment">y</article></article>': "t",
    }.items():
        assert H.main_text(page, None) == text, page


def test_marks_in_articles_need_the_hosts_pages(pages):
    page = "<article><h1>T</h1><p>w {}</p>{}<div class='ad'>Buy</div></article>"
    rows = [(k, "http://h/1", page.format(k, "<section id='notice'>kept</section>" if k == 7 else ""), "x", "x", "x") for k in range(12)]
    found = {r["page_id"]: r["text"] for r in H.extracted(pages(rows)).collect()}
    assert found[7] == "T\n\nw 7\n\nkept" and found[8] == "T\n\nw 8"


def test_thousands_of_nested_elements(pages):
    deep = "<article><p>start</p>" + "<font>" * 5000 + "deep</article>"
    divs = "<article><h1>T</h1>" + "<div>" * 5000 + "low" + "</div>" * 5000 + "</article>"
    rows = [(k, "http://h/1", p, "x", "x", "x") for k, p in enumerate([deep, divs, deep, "<article><h1>T</h1><p>flat</p></article>"])]
    found = {r["page_id"]: r["text"] for r in H.extracted(pages(rows)).collect()}
    assert found == {0: "start\n\ndeep", 1: "T\n\nlow", 2: "start\n\ndeep", 3: "T\n\nflat"}
    one = H.wrapper_of(H.parsed(divs))
    assert H.written(H.from_json(H.to_json(one))) == H.written(one)


def test_given_pages(spark, sf_dir):
    """All given pages have one article; its paragraphs by a plain split."""
    import html
    import re

    found = {r["page_id"]: r["text"] for r in H.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet")).collect()}
    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
        texts = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", p)).split()) for p in parts]
        assert found[r["page_id"]] == "\n\n".join(t for t in texts if t)
