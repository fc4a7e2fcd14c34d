import html
import itertools
import re
from pathlib import Path

import pytest

from peerwatch.llm.html_text import Model, _layouts, _parts, main_text, parse, train

FOLDER = "/root/testdata/sf0.01"


def plain(page):
    """The text of the article by a different way: cut at block tags, then remove what is left of tags."""
    inner = re.search(r"<article>(.*?)</article>", page, re.S)
    blocks = re.split(r"</?(?:p|h1)>", inner[1]) if inner else []
    texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks]
    return "\n".join(t for t in texts if t)


@pytest.fixture(scope="module")
def model():
    made = Model()
    for layout in _layouts("A title", ["First long paragraph of some words in the article. " * 3, "Short."], ["menu words", "other words"]):
        for _ in range(40):
            made.learn(layout)
    return made.finish()


@pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver's tables")
def test_whole_table(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    learned = train(spark, pages)
    got = {r.page_id: r for r in main_text(pages, learned).collect()}
    for r in pages.collect():
        assert got[r.page_id].text == plain(r.html) and got[r.page_id].n_chars == len(plain(r.html)) and got[r.page_id].url == r.url


def test_marginals_are_exact(model):
    nodes, _ = parse('<body><div class="post"><p>one two three</p><ul><li>x</li></ul></div><aside><p>side</p></aside></body>')
    from peerwatch.llm.html_text import place, seen

    total, on = 0.0, [0.0] * len(nodes)
    for labels in itertools.product((0, 1), repeat=len(nodes)):
        p = 1e-9 if labels[0] else 1.0
        for i in range(1, len(nodes)):
            s = model.chances.get(place(nodes[nodes[i].parent]), model.chances[""])
            p *= s[2 * labels[nodes[i].parent] + labels[i]] * (model.odds(seen(nodes[i])) if labels[i] else 1.0)
        total += p
        for i, y in enumerate(labels):
            on[i] += p * y
    assert model.marginals(nodes) == pytest.approx([o / total for o in on])


def test_other_designs(model):
    page = """<div class="site-header"><a href=/>Home</a><p>Welcome to this site</p></div><div class='cookie-consent'><p>We use cookies, as all do</p></div>
    <div id=content><h1>Title &amp; more</h1><p>Some text\n with <b>bold</b> words<br>and a break &#233;<p>Short.<script>if (a < b) "<p>no</p>"</script>
    <ol><li>point<li>other point</ol><div class="comments"><p>A reader wrote this, at some length, too</p></div></div>
    <div class="sidebar"><p>Other things that are long enough to be text as well.</p></div><form><p>Sign up</p></form><footer>(c)</footer>"""
    assert model.text(page) == "Title & more\nSome text with bold words and a break é\nShort.\npoint\nother point"


def test_broken_markup_and_long_pages(model):
    for page in ("", "<", "<p", "<p>a<p>b</div></div>", "<!-- open", "<script>x", "<a b='>", "&#xFFFFFF;&bogus;", "<ul><li>" * 3_000, "<div>" * 5_000 + "x", "a < b > c"):
        model.text(page)
    model.text("<article>" + "<p>word word</p>" * 20_000 + "</article>")


def test_defined_results(spark):
    pages = spark.createDataFrame([(1, "u", None, 1), (2, None, "", 1), (2, None, "", 1), (None, "u", "<article><p>Some text here</p></article>", 1)], "page_id long, url string, html string, n_chars int")
    got = main_text(pages, train(spark, pages)).collect()
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in got) == [(0, "Some text here", 14), (1, "", 0), (2, "", 0), (2, "", 0)]
    assert main_text(pages.limit(0), train(spark, pages.limit(0))).count() == 0
    assert _parts("<p>no article</p>") is None


def test_scripts_do_not_cut_a_block(model):
    page = "<article><p>one two <script>x('<p>')</script>three<noscript><img src=a> no</noscript> four<p>next <style>p {}</style>block</article>"
    assert model.text(page) == "one two three four\nnext block"


def test_open_elements_end_with_their_block(model):
    words = "Some words that are long enough to be read as text of the page."
    for opened in ("<noscript>no", "<button>no", "<select><option>no", "<svg><path>", "<object><div>no</div>", "<video><source src=a>"):
        page = f"<body><article><div>{opened}</div><p>{words}</p></article></body>"
        assert model.text(page) == words, opened
    assert model.text(f"<body><article><svg><g><title>no</title></g><p>{words}</p></article></body>") == words
    nested = f"<article><object><div>no<object>no</object>no</div>no</object><template><p>no</p></template><p>{words}</p></article>"
    assert model.text(nested) == words


def test_heads_without_end(model):
    for head in ("<head>", "<head><title>no</title>", "<head><script>if (a < b) '<p>no</p>'</script><meta charset=x>", "<head><style>no</style></head>"):
        for body in ("<body>", ""):
            assert model.text(f"<html>{head}{body}<article><p>Some words.</p></article>") == "Some words."


def test_headline_in_the_header_of_the_article(model):
    page = "<body><header><p>Name of the site</p></header><article><header><h1>Title of it</h1></header><p>Some words of the article, at some length.</p></article></body>"
    assert model.text(page) == "Title of it\nSome words of the article, at some length."


def test_pages_are_learned_as_they_are():
    """A design that no layout has: counts by hand, and the words of a name that only the page shows as content."""
    page = "<body><nav><p>a</p></nav><article class=widget><dl><dt>t<dd>d</dl><aside><p>x</p></aside></article></body>"
    learned = Model()
    learned.learn_article(page)
    # Content: article, dl, dt, dd.  The rest: body, nav, its p, aside, its p.
    assert learned.total == [5, 4]
    assert learned.views[0][1] == {"article": 1, "list": 1, "item": 2} and learned.views[1][1] == {"side": 1, "none": 3}
    assert learned.steps["side"].tolist() == [[0.5, 0.5], [1.5, 1.5]]
    learned.learn_article(page + page.replace("body", "div"))  # two articles say nothing about one
    assert learned.total == [5, 4]


def test_ties_are_content(monkeypatch, model):
    monkeypatch.setattr(Model, "marginals", lambda self, nodes: [0.5] * len(nodes))
    assert model.text("<p>one</p><p>two</p>") == "one\ntwo"
