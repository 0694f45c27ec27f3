"""Page text on hand-made pages."""

import pytest

from bidtrail.llm import templates
from bidtrail.llm.templates import Page

SCHEMA = "page_id bigint, url string, html string, template int"


def text(source, template=()):
    return Page(source).text(set(template))


def test_own_text_only():
    source = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
    <header>Site</header><nav><ul><li><a href="/">Home</a></ul></nav><!-- note --><div class="ad">Buy</div>
    <div id="cookie-notice">We use</div><article><h1>Head &amp; more</h1><p>One <b>bo</b>ld
    line.<br><p>Two&nbsp;&#233;<form><input>Mail</form><aside>Side</aside><section class="comments"><p>First!</p></section></article>
    <footer>&copy; me</footer></body></html>"""
    assert text(source) == "Head & more One bold line. Two é"


def test_unclosed_and_cut_off():
    assert text("<article><p><b>bold<p>next<br>line <i>x</i>y</article> tail") == "bold next line xy"
    assert text("<article><p>some text</p><p cla") == "some text"
    assert text("<article><p>a &lt;b&gt; &am") == "a <b> &am"
    assert text("<article>a<script>never closed <p>b") == "a"
    assert text("") == "" and text("plain  words") == "plain words"
    assert text("<nav>" * 3000 + "x" + "</nav>" * 3000 + "y") == "y"


def test_without_article_main_or_body_counts():
    assert text("<body><header>h</header><main><p>in</p></main><p>out</p></body>") == "in"
    assert text("<body><header>h</header><p>in</p><div role='navigation'>n</div></body>") == "in"
    assert text("<article><header><h1>title</h1></header>x</article><article class='comment'>y</article><article>z</article>") == "title x z"


def test_template_of_a_host_goes_and_repeated_paragraphs_stay(spark):
    def page(i, host, box, own):
        return (i, f"https://{host}/en/{i}", f"<body><div><span>{box}</span></div><p>{own}</p><div>only {i}</div></body>", 1)

    def article(i, box, own):
        return (i, f"https://c.example/{i}", f"<article><div><b>{box}</b></div><p>{own}</p></article>", 1)

    rows = [page(i, "A.example", "Box of a", f"text {i}") for i in range(6)]
    rows += [page(10 + i, "b.example", f"Box {i}", f"text {i}") for i in range(6)]
    rows += [article(20 + i, "Box of c", "same words") for i in range(5)]
    rows += [(30, None, "<p>no url</p>", 1), (31, "x", None, 1), (32, "http://d.example", "", 1), (None, "https://a.example/", rows[0][2], 1), rows[1]]
    got = {}
    for r in templates.extract(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect():
        got.setdefault(r["page_id"], []).append((r["text"], r["n_chars"]))
    for i in range(6):
        assert {t for t, _ in got[i]} == {f"text {i} only {i}"}
        assert got[10 + i] == [(f"Box {i} text {i} only {10 + i}", 20)]
    assert len(got[1]) == 2 and all(got[20 + i] == [("same words", 10)] for i in range(5))
    assert got[30] == [("no url", 6)] and got[31] == [("", 0)] and got[32] == [("", 0)] and got[None] == [("text 0 only 0", 13)]


def test_empty_table(spark):
    assert templates.extract(spark.createDataFrame([], SCHEMA)).collect() == []


def test_copies_of_a_page_keep_their_text(spark):
    def wrapped(url, own):
        return f"https://{url}", f"<body><div class='menu-box'><b>Top</b></div><div><b>Site box</b></div><div id=wrap><article><p>{own}</p></article></div></body>"

    def whole(url, own):
        return url, f"<article><div><p>{own}</p></div></article>"

    def bare(url, own):
        return url, f"<body><div><b>Site box</b></div><div id=wrap><p>{own}</p><p>more {own}</p></div></body>"

    rows = [wrapped(f"w.example/{i}", "copied words") for i in range(4)]
    rows += [whole(u, "one page") for u in ("http://v.example/a", "https://v.example/a", "https://v.example/a?page=2", "https://v.example/a#top")]
    rows += [whole(f"https://u.example/{i}", "other paths") for i in range(4)]
    rows += [bare(f"https://b.example/c{i}", "copied") for i in range(5)] + [bare(f"https://b.example/{i}", f"own {i}") for i in range(4)]
    pages = spark.createDataFrame([(i, u, h, 1) for i, (u, h) in enumerate(rows)], SCHEMA).repartition(3)
    got = {r["page_id"]: r["text"] for r in templates.extract(pages).collect()}
    assert [got[i] for i in range(12)] == ["copied words"] * 4 + ["one page"] * 4 + ["other paths"] * 4
    assert [got[i] for i in range(12, 21)] == ["copied more copied"] * 5 + [f"own {i} more own {i}" for i in range(4)]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ('<div class="layout with-sidebar"><div class="sidebar">side</div><article><p>main text</p></article></div>', "main text"),
        ('<div class="has-banner"><div class="banner">buy</div><main><p>main text</p></main></div>', "main text"),
        ('<form id="page"><article><p>main text</p><form>mail me</form></article></form>', "main text"),
        ('<article><p>main text</p></article><section id="comments"><article class="comment"><p>first!</p></article></section>', "main text"),
    ],
)
def test_what_holds_an_article_is_not_dropped(html, want):
    assert text(html) == want
