"""Main text of pages: templates with boilerplate of all kinds, a plain reading of the given pages, densities by their definition."""

import html
import math
import re
import time

import pytest
from conftest import SF_SMALL

from starmart.llm import queries
from starmart.llm.main_text import Tree, extract, main_text

PARAS = [f"Word{k} of the real story goes on and on here, once more." * (1 + k % 3) for k in range(8)]
BODY = "".join(f"<p>{p}</p>" for p in PARAS)
TEXT = " ".join(PARAS)
LONG_COMMENT = "<p>" + "I think this is a long comment. " * 40 + "</p>"

CASES = {
    "all kinds": (
        "<body class='with-sidebar'><header><h1>Site</h1><a href=/>Home</a></header><nav><a>x</a></nav>"
        "<div class='cookie-notice'><p>We use cookies to make this site better for you and for others.</p></div>"
        f"<div id='content'><article><header><h1>Title</h1></header>{BODY}<form><label>Mail</label><input><button>Go</button></form><aside>See also</aside></article>"
        f"<section class='comments'><div class='comment'>{LONG_COMMENT}</div></section></div>"
        "<div class='sidebar'><ul><li><a>1</a><li><a>2</a></ul></div><footer>c</footer>",
        "Title " + TEXT,
    ),
    "divs": (f"<body><div id='header'>Site name</div><div id='wrap'><div id='main'><h1>Title</h1><div class='text'>{BODY}</div></div><div id='sidebar'><p>Some text</p></div></div><div id='footer'>foot</div>", "Title " + TEXT),
    "table": (f"<table><tr><td><a href=1>Menu one</a><br><a href=2>Menu two</a><br><a href=2>Menu three</a></td><td><h1>T</h1>{BODY}</td></tr></table><div>Copyright 2020</div>", "T " + TEXT),
    "unmarked links": (f"<div><a href=1>{'link text ' * 30}</a></div><div>{BODY}</div>", TEXT),
    "no markup": ("Just text<br>and more &amp; more", "Just text and more & more"),
    "boilerplate only": ("<nav>a</nav>", ""),
    "unclosed": ("<article><h1>A<p>b<b>c<p>d</article><footer>f", "A bc d"),
    "class around the article": ("<div class='sidebar-page'><main><article><p>Hello there</p></article></main></div><div class=ad>buy</div>", "Hello there"),
    "comment articles": (f"<main><article><p>Short.</p></article><article class=comment>{LONG_COMMENT}</article></main>", "Short."),
    "attributes": ("<article><p title='a>b' data-x=\"</article>\">ok <a href='x>y'>link</a></p><!-- <p>no</p> --><script>'<p>'</script></article>", "ok link"),
    "references": ("<p>&lt;b&gt; &#233;&#x65E5; &nbsp; x&hellip; &unknown; &am", "<b> é日 x… &unknown; &am"),
    "inline script": ("<p>one<script>x</script>two <span class=ad>buy</span>three</p>", "onetwo three"),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_templates(name):
    page, want = CASES[name]
    assert main_text(page) == want


def test_query_against_a_plain_reading(spark):
    """The given pages hold their text in one article element."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = queries.QUERIES["op13_main_text"](spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        own = pages[r.page_id].html.split("<article>")[1].split("</article>")[0]
        want = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", own)).split())
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, want, len(want))


def test_awkward_rows(spark):
    rows = [(1, "u", None, "own", 1.5), (1, "u", None, "own", 1.5), (None, None, "", None, None), (2, "u", "<p>x</p>", "own", None), (3, "u", "<p>" + "long text " * 200_000 + "</p>", "own", 1.0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, density double")
    got = extract(df).collect()
    assert sorted((r.page_id or 0, r.n_chars, r.density) for r in got if r.page_id != 3 and r.page_id != 2) == [(0, 0, None), (1, 0, 1.5), (1, 0, 1.5)]
    assert {r.page_id: r.n_chars for r in got}[3] == 1_999_999 and {r.page_id: r.text for r in got}[2] == "x"
    assert extract(df.limit(0)).collect() == []


def test_densities_by_definition():
    page = "<body><div><p>aaaa aaaa <a href=1>bb</a></p><p>cccccc</p></div><ul><li><a>dd</a></li><li><a>ee</a></li></ul></body>"
    tree = Tree(page)
    density, total = tree.measure()

    def below(k):
        return [j for j in range(len(tree.parent)) if j == k or (tree.parent[j] >= 0 and _under(tree, j, k))]

    share = tree.link_chars[0] / tree.chars[0]
    assert (tree.chars[0], tree.link_chars[0]) == (20, 6)
    for k in range(len(tree.parent)):
        blocks = [j for j in below(k) if tree.text[j]]
        c = sum(len(re.sub(r"\s", "", tree.text[j])) for j in blocks)
        links, t, m = tree.link_chars[k], max(1, tree.tags[k]), max(1, tree.link_tags[k])
        base = max(math.e, math.log(c * links / max(1, c - links) + share * c + math.e))
        assert tree.chars[k] == c and density[k] == pytest.approx(max(0, c / t * math.log(c * t / (max(1, links) * m)) / math.log(base)))
        assert total[k] == pytest.approx(sum(density[j] for j in range(len(tree.parent)) if tree.parent[j] == k))
    assert tree.main() == "aaaa aaaa bb cccccc"


def _under(tree, j, k):
    while j > k:
        j = tree.parent[j]
    return j == k


@pytest.mark.parametrize("page", ["<b>" * 60_000, "<div>" * 60_000 + "x", "</b>" * 60_000, "<ul>" + "<li>x" * 30_000, "<a href='" * 30_000, "<!--" * 30_000, "<script>" * 30_000, "<a =" * 30_000, '<a b="' * 30_001, "<p>" + "<b></p>" * 30_000])
def test_linear_time(page):
    began = time.monotonic()
    main_text(page)
    assert time.monotonic() - began < 10
