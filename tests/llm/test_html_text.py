from __future__ import annotations

import pytest

from emberline.llm.html_text import content_key, extract_text, main_text, parse, subtree_hashes

SCHEMA = "page_id long, url string, html string, text string, host string, hash long"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "t", "h", 1) for i, u, h in rows], SCHEMA)


def page(body, extra=""):
    return (
        "<!DOCTYPE html><html><head><title>T</title><script>var t='</p><article>';</script></head><body>"
        "<header><a href=/>Home</a></header><nav><ul><li>A<li>B</ul></nav><!-- <p>no</p> -->"
        f"{extra}{body}<footer>&copy; x</footer></body></html>"
    )


def test_article_without_surroundings():
    html = page(
        '<article><h1>Head &amp; tail</h1><p><b>First<br>line<p>Second\n\t &lt;x&gt; &#233;&nbsp;y</p><div class="share-buttons">no</div>'
        '<form><input value=1>no</form><aside>no</aside><ul><li>one<li>two</ul><style>p{}</style><section id="comments"><p>no</p></section></article>',
        '<div class="ad">Buy</div><div id="cookie-notice">Accept</div>',
    )
    assert main_text(html) == "Head & tail\n\nFirst line\n\nSecond <x> é y\n\none\n\ntwo"


def test_pages_without_article_and_broken_markup():
    assert main_text("<p>a<p>b<div>c</p>d<table><tr><td>e<td>f</table>") == "a\n\nb\n\nc\n\nd\n\ne\n\nf"
    assert main_text('<div role="navigation">no</div>plain &am <b>x</i> y') == "plain &am x y"
    assert main_text("text <a hre") == "text"
    assert main_text("3 < 4 > 2") == "3 < 4 > 2"
    assert main_text("<article><p>open") == "open"
    for empty in (None, "", "  ", "<script>x", "<!-- open", "<"):
        assert main_text(empty) in ("", "<")


def test_deep_and_long_pages():
    assert main_text("<div>" * 30_000 + "deep" + "</div>" * 30_000) == "deep"
    assert main_text("<article><p>" + "word " * 200_000 + "</article>").count("word") == 200_000


def test_words_of_class_names_are_whole():
    assert main_text('<div class="header-image-free adequate">kept</div><div class="x">also</div>') == "also"
    assert main_text('<div class="adequate shadow">kept</div>') == "kept"


def test_names_of_the_frame_are_no_noise():
    for body in ("no-sidebar", "has-sidebar cookie-consent", "sidebar"):
        assert main_text(f'<html class="has-banner"><body class="{body}"><p>kept</p><div class="sidebar">no</div></body></html>') == "kept"
    assert main_text('<div id="page-with-sidebar"><p>kept</p></div>') == "kept"
    assert main_text('<div class="layout-sidebar"><article class="post share-enabled"><p>kept</p></article><p>no</p></div>') == "kept"
    assert main_text('<div class="sidebar-layout"><main id="menu-page"><p>kept</p></main></div>') == "kept"
    assert main_text('<p>kept</p><div id="comments"><article><p>no</p></article></div>') == "kept"


def test_templates_are_counted_per_host_over_different_pages(spark):
    menu = "<div><p>Our shop</p><div>Call us</div></div>"
    rows = [(i, f"http://shop.example/{i}", f"<body>{menu}<div><p>Item {i} is here</p></div></body>") for i in range(8)]
    rows += [(100 + i, "http://copy.example/x", "<body><div><p>One story</p></div></body>") for i in range(8)]
    rows += [(200 + i, f"http://paper.example/{i}", f"<article><p>License line</p><p>Text {i}</p></article>") for i in range(8)]
    rows += [(300, None, f"<body>{menu}<div>x</div></body>"), (None, "not a url", None), (301, "http://shop.example/0", rows[0][2]), (301, "http://shop.example/0", rows[0][2])]
    got = sorted(extract_text(pages(spark, rows)).collect(), key=lambda r: (r.page_id is None, r.page_id))
    texts = {r.page_id: r.text for r in got}
    assert all(texts[i] == f"Item {i} is here" for i in range(8))
    assert all(texts[100 + i] == "One story" for i in range(8))
    assert all(texts[200 + i] == f"License line\n\nText {i}" for i in range(8))
    assert texts[300] == "Our shop\n\nCall us\n\nx" and texts[None] == "" and texts[301] == "Item 0 is here"
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)


def test_what_recurs_inside_articles_is_kept(spark):
    table = "<table><tr><th>Year</th><td>{0}</td></tr><tr><td>Yes</td></tr></table><ul><li>Salt</li><li>{0}</li></ul>"
    box = "<div><div>Follow us</div></div>"
    rows = []
    for i in range(20):
        some = "<div>Set in a div</div>" if i < 6 else ""
        rows.append((i, f"http://food.example/{i}", f"<article><p>Text {i}</p>{some}{table.format(i)}{box}</article>"))
    texts = {r.page_id: r.text.split("\n\n") for r in extract_text(pages(spark, rows)).collect()}
    for i in range(20):
        assert texts[i] == [f"Text {i}", *(["Set in a div"] if i < 6 else []), "Year", str(i), "Yes", "Salt", str(i)]


def test_empty_table(spark):
    assert extract_text(pages(spark, [])).collect() == []


def test_hashes_see_content_and_structure():
    a, b, c = (parse(f"<div><span>{t}</span></div>") for t in ("x  y", "x y", "z"))
    assert set(subtree_hashes(a).values()) == set(subtree_hashes(b).values()) != set(subtree_hashes(c).values())
    assert content_key(parse("<article>a</article><p>1")) == content_key(parse("<p>2<article>a</article>"))


@pytest.mark.parametrize(
    ("inner", "want"),
    [
        ('<table><tr class="header"><th>Year</th><th>Sum</th></tr><tr><td>1</td><td>2</td></tr></table>', "Year\n\nSum\n\n1\n\n2"),
        ('<h2 class="section-header">Results</h2><p>Text.</p>', "Results\n\nText."),
        ('<div class="article-header"><h1>Title</h1></div><p>Text.</p>', "Title\n\nText."),
        ('<div class="related-work"><p>Others.</p></div>', "Others."),
        ('<div class="alert"><p>Care.</p></div>', "Care."),
        ('<p>See <span class="search-term">this</span> now.</p>', "See this now."),
        ("<p data-x=it's>Hello. Don't go.</p><p>Next.</p>", "Hello. Don't go.\n\nNext."),
        ("<p title=\"a>b\" data-y='c>d'>Quoted.</p>", "Quoted."),
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> be.</p>", "Let x=2 be."),
        ('<p>One.</p><div class="comments"><p>Me too!</p></div><ul class="share"><li>Tweet</li></ul><div class="ad">Buy</div>', "One."),
        ('<ul class="menu"><li class="nav-item">Soup</li></ul><p class="notice">Open.</p>', "Soup\n\nOpen."),
    ],
)
def test_names_do_not_remove_parts_of_an_article(inner, want):
    for root in ("article", "main"):
        assert main_text(f"<body><{root}>{inner}</{root}></body>") == want


def test_headings_and_tables_outside_an_article_keep_their_text():
    assert main_text('<body><h2 class="section-header">Results</h2><table class="widget"><tr class="header"><th>Year</th></tr></table></body>') == "Results\n\nYear"
