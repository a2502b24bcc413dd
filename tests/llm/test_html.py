import itertools
import random

import pytest

from aerolith.llm import html_extract as H
from aerolith.llm import html_pages


def cost(labels, odds, links):
    return sum(max(-o, 0) if x else max(o, 0) for x, o in zip(labels, odds, strict=True)) + sum(w for a, b, w in links if labels[a] != labels[b])


def test_cut_against_all_labellings():
    rng = random.Random(1)
    for _ in range(200):
        n = rng.randint(1, 8)
        odds = [rng.choice([0.0, rng.uniform(-3, 3)]) for _ in range(n)]
        links = [(a, b, rng.choice([0.0, rng.uniform(0, 3)])) for a in range(n) for b in range(a) if rng.random() < 0.5]
        best = min(cost(x, odds, links) for x in itertools.product([False, True], repeat=n))
        assert cost(H.min_cut(odds, links), odds, links) == pytest.approx(best)


PAGE = """<html><head><title>T &amp; x</title><style>p{}</style></head><body class="page-with-sidebar"><header class="site-header"><a href="/">Home</a><p>A long slogan that reads like a sentence, for the site.</p></header>
<div class="cookie-notice"><p>We use cookies to make this site work for you. Accept all of them now, please.</p></div><script>if (a < b) { document.write("<p>no</p>") }</script>
<main><article><header><h1>Head &quot;line&quot;</h1></header><p>First   paragraph\n of text&nbsp;with an <a href="x">inline link</a> &lt;more&gt;.</p><ul><li>one item<li>two <b>item</b></ul><!-- <p>gone</p> -->
<aside>Side box text that is long enough to be a paragraph. Yes.</aside><div class="advert"><p>Buy this now, it is really a long text about a product.</p></div><blockquote>A quote.</blockquote></article>
<section id="comments"><article class="comment"><p>I am a reader and I comment at length on this article here.</p></article></section></main>
<form><p>Your name, please, and what you think of it all.</p><textarea>abc</textarea></form><div id="sidebar"><ul><li><a>x</a></li></ul></div><footer><p>(c) 2024 Some company. All rights reserved.</p></footer></body></html>"""


def test_article_alone():
    assert H.main_text(PAGE).split("\n") == ['Head "line"', "First paragraph of text with an inline link <more>.", "one item", "two item", "A quote."]


def test_page_without_article():
    page = '<div id="content"><h2>Title</h2><p>No article tag here, but long enough paragraphs of prose to be read as main content.</p><p>Short.</p></div><div class="menu"><a>a</a> <a>b</a></div>'
    assert H.main_text(page).split("\n")[0] == "Title" and H.main_text(page).endswith("Short.")


@pytest.mark.parametrize(
    ("page", "text"),
    [(None, ""), ("", ""), ("plain text", "plain text"), ("<p>a &am", "a &am"), ("<p>text here<foo", "text here"), ("<article><p>open <b>bold", "open bold"), ("</div></p><p>x y</p>", "x y"), ('<p title="a > b">text</p>', "text"), ("<p>1 < 2 and 3</p>", "1 < 2 and 3"), ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"), ("<script>", ""), ("<!-- open <p>x</p>", "")],
)
def test_broken_pages(page, text):
    assert H.main_text(page) == text


def test_long_page():
    page = "<article>" + "".join(f"<p>paragraph number {k}.</p>" for k in range(5000)) + "</article><footer>f</footer>"
    assert H.main_text(page).count("\n") == 4999


def test_operator(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "z"), (1, "u", PAGE, "z"), (None, None, None, "z")], "page_id long, url string, html string, text string")
    rows = H.extract(df).collect()
    assert len(rows) == 3 and rows[0].text == rows[1].text and rows[0].n_chars == len(rows[0].text) and (rows[2].text, rows[2].n_chars) == ("", 0)
    assert H.extract(df.limit(0)).count() == 0


def scores(seed, shapes):
    n = cut = alone = changed = 0
    for page, truth in html_pages.pages(seed, 240, shapes):
        found = H.labelled(page)
        assert [t for t, _, _ in found] == [t for t, _ in truth]
        n += len(truth)
        cut += sum(c == y for (_, c, _), (_, y) in zip(found, truth, strict=True))
        alone += sum(c == y for (_, _, c), (_, y) in zip(found, truth, strict=True))
        changed += sum(c != a for _, c, a in found)
    return cut / n, alone / n, changed


def test_held_out_accuracy_with_and_without_the_cut():
    cut, alone, changed = scores(4711, None)
    print(f"held out: with the cut {cut:.4f}, without {alone:.4f}, labels changed {changed}")
    assert cut >= 0.99 and cut > alone + 0.002 and changed >= 30


@pytest.mark.parametrize("shape", html_pages.SHAPES)
def test_held_out_accuracy_of_each_shape(shape):
    cut, alone, _ = scores(815, [shape])
    assert cut >= 0.985 and cut >= alone


INSIDE = "<nav><ul><li><a>Start</a></li><li><a>News</a></li></ul></nav><article>{}<p>A first paragraph of some length that says what the whole article is about.</p><p>And a second one, which goes on about it for a while.</p></article><footer>(c) some company</footer>"


@pytest.mark.parametrize(
    ("part", "text"),
    [
        ('<div class="entry-header"><h1>The headline</h1></div>', "The headline"),
        ('<section class="side-effects"><p>Headache was seen in some of the patients who took it.</p></section>', "Headache was seen in some of the patients who took it."),
        ('<div class="legal-history"><p>The law of 1901 was changed twice before it was repealed.</p></div>', "The law of 1901 was changed twice before it was repealed."),
        ("<p>It follows that <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds.</p>", "It follows that x=1 holds."),
    ],
)
def test_names_inside_an_article_lose_nothing(part, text):
    lines = H.main_text(INSIDE.format(part)).split("\n")
    assert lines == [text, "A first paragraph of some length that says what the whole article is about.", "And a second one, which goes on about it for a while."]


@pytest.mark.parametrize("wrapper", ['class="page has-sidebar"', 'id="search-results-layout" class="with-comments"', 'class="nav-open has-ads"'])
def test_wrappers_say_nothing(wrapper):
    page = f"<div {wrapper}>{INSIDE.format('<h1>Title</h1>')}</div>"
    assert H.main_text(page).split("\n") == ["Title", "A first paragraph of some length that says what the whole article is about.", "And a second one, which goes on about it for a while."]


def test_the_model_is_the_same_on_every_call():
    first = H.model()
    H.model.cache_clear()
    assert H.model() == first
