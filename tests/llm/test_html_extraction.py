"""Main text of pages: planted pages, the given ones by a plain reading of their article, cuts by enumeration."""

import html
import itertools
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlab.llm import html_extraction
from reviewlab.llm.html_blocks import page_blocks

PROSE = [f"Sentence {i} of the article tells, in some detail, what happened on day {i}." for i in range(6)]


def paragraphs(lines):
    return "".join(f"<p>{line}</p>" for line in lines)


PAGES = {
    "plain": (f"<html><body><h1>Title</h1>{paragraphs(PROSE)}</body></html>", ["Title", *PROSE]),
    "semantic": (
        "<head><title>No</title><style>p{}</style></head><header><a href=/>Site</a><nav><a href=1>One</a> <a href=2>Two</a></nav>"
        f"</header><main><article><header><h1>Title</h1></header>{paragraphs(PROSE)}<aside><p>{PROSE[0]} Aside.</p></aside>"
        "<div class='advert'>Buy now, only today, a very good thing.</div><form><label>Your mail</label><button>Go</button></form>"
        f"<ul><li>First point</li><li>Second point</li></ul></article><section id=comments><article class=comment><p>{PROSE[1]}"
        "</p></article></section></main><footer>&copy; Site</footer>",
        ["Title", *PROSE, "First point", "Second point"],
    ),
    "divs": (
        "<body class='has-sidebar'><div class='top-menu'><ul><li><a href=1>Home</a><li><a href=2>News</a></ul></div>"
        f"<div id='cookie-notice'><p>{PROSE[2]} We use cookies.</p></div><div class='content-sidebar-wrap'><div class='post-content'>"
        f"<h1>Title</h1>{paragraphs(PROSE)}</div><div class='sidebar'><p>{PROSE[3]} Elsewhere.</p></div></div>"
        f"<div class='commentList'><div><p>{PROSE[4]} I agree.</p></div></div><div id=footer>Imprint | Contact</div>",
        ["Title", *PROSE],
    ),
    "one form around all": (
        f"<form id='aspnetForm'><div class=nav-open><article>{paragraphs(PROSE)}</article></div><input><button>Send</button></form>", PROSE
    ),
    "ill-formed": (
        f"<article><p><b>{PROSE[0]}<br><p>{PROSE[1]}<div>{PROSE[2]}</span></div></section><p title='a>b'>{PROSE[3]}</article><nav>x",
        PROSE[:4],
    ),
    "references": ("<article><p>a&amp;b &lt;i&gt; &#233;&#x41; &nbsp; x&am\n\t y &copy z</p></article>", ["a&b <i> éA x&am y © z"]),
    "scripts": (
        "<article><script>var t='</p><p>no</p>';</script><!-- <p>no</p> --><p>One two.</p><noscript>no</noscript><template><p>no</p></template>"
        "<p hidden>no</p><div style='display: none'><p>no</p></div><textarea>no</textarea><p>Three.</p><SCRIPT>no</SCRIPT></article><script>no",
        ["One two.", "Three."],
    ),
    "inline": ("<article><p>one<b>two</b><br>three <a href='x>y'>four</a></p>five</article>", ["onetwo three four", "five"]),
    "table": ("<article><table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e</dl></article>", ["a", "b", "c", "d", "e"]),
    "less than": ("<article><p>a < b and 3<4, <3</p></article>", ["a < b and 3<4, <3"]),
    "parts of an article": (
        "<div id=main class='col has-sidebar'><div class='post-header'><h1>Title</h1></div>"
        f"{paragraphs(PROSE[:3])}<div class='article-share'>Tell your friends about it.</div>{paragraphs(PROSE[3:])}"
        "<div class='post-footer'>Filed under things.</div></div><div class='footer-content'><p>All rights are reserved, always.</p></div>"
        f"<div class='sidebar'><div class='post'><p>{PROSE[0]} Teaser.</p></div></div>",
        ["Title", *PROSE],
    ),
    "words around the article": (
        f"<div class='site menu-main-content'><div class='content'>{paragraphs(PROSE)}</div></div><div class='cookie-content'>{paragraphs(PROSE[:1])}</div>",
        PROSE,
    ),
    "only menu": ("<nav><p>Long prose in the menu, with commas, and a full stop.</p></nav>", []),
    "empty": ("", []), "null": (None, []), "tags": ("<div><br></div><p", []),
}


@pytest.mark.parametrize("name", PAGES)
def test_planted_pages(name):
    page, lines = PAGES[name]
    assert html_extraction.main_text(page) == "\n".join(lines)


def test_given_pages(spark, sf):
    """The article element of the synthetic pages, read by cutting at block tags."""
    rows = html_extraction.extract_main_text(spark.read.parquet(f"{sf}/pages.parquet")).collect()
    assert len({r.page_id for r in rows}) == len(rows) > 0
    for r in rows:
        inner = r.html.partition("<article>")[2].partition("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inner)]
        assert r.text == "\n".join([b for b in blocks if b])
        assert r.n_chars == len(r.text)


def test_odd_rows(spark):
    long = "<article>" + "".join(f"<p>Block {i} of a very long page.</p><ul><li>x</li></ul>" for i in range(30_000)) + "</article>"
    rows = [(1, "u", None, 1), (2, None, "", 2), (3, "u", PAGES["divs"][0], 3), (3, "u", PAGES["divs"][0], 3), (None, "u", long, 4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, _text int").withColumnsRenamed({"_text": "n_chars"})
    found = html_extraction.extract_main_text(pages)
    assert found.columns == ["page_id", "url", "html", "text", "n_chars"]
    texts = {r.page_id: r.text for r in found.collect()}
    assert texts[1] == texts[2] == "" and texts[3] == "\n".join(PAGES["divs"][1]) and texts[None].count("\n") == 59_999
    assert found.count() == 5 and html_extraction.extract_main_text(pages.limit(0)).count() == 0


def cut_cost(costs, edges, labels):
    own = sum(c if c > 0 and not kept else -c if c < 0 and kept else 0 for c, kept in zip(costs, labels))
    return own + sum(c for i, j, c in edges if labels[i] != labels[j])


@settings(max_examples=150, deadline=None)
@given(st.data())
def test_minimum_cut_equals_enumeration(data):
    n = data.draw(st.integers(1, 8))
    costs = data.draw(st.lists(st.integers(-9, 9), min_size=n, max_size=n))
    ends = st.tuples(st.integers(0, n - 1), st.integers(0, n - 1), st.integers(0, 9)).filter(lambda e: e[0] != e[1])
    edges = data.draw(st.lists(ends, max_size=14)) if n > 1 else []
    found = html_extraction.minimum_cut(costs, edges)
    best = min(itertools.product([False, True], repeat=n), key=lambda x: (cut_cost(costs, edges, x), -sum(x)))
    assert cut_cost(costs, edges, found) == cut_cost(costs, edges, best) and sum(found) == sum(best)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(
    ["<p>", "</p>", "<div class='ad'>", "<div>", "</div>", "<article>", "</article>", "<b", ">", "text ", "&amp;", "<td>", "<table>", "</table>",
     "<select>", "</select>", "<a href='x'>", "</a>", "<!--", "-->", "<script>", "</script>", "<li>", "<ul>", "</ul>", "\"", "'", "<head>", "<body>"]
), max_size=40))
def test_any_markup_is_read(parts):
    text = html_extraction.main_text("".join(parts))
    assert text == "\n".join([line for line in text.split("\n") if line])
    for block in page_blocks("".join(parts)):
        assert block.text and block.near >= 0


def test_classifier_learns_from_named_places():
    rng = np.random.default_rng(1)
    rows = np.column_stack([np.ones(2000), rng.normal(size=(2000, 2))])
    wanted = (rows[:, 1] - rows[:, 2] + 0.3 * rng.normal(size=2000) > 1).astype(float)
    weights = html_extraction.fit_logistic(rows, wanted)
    assert (((rows @ weights) > 0) == wanted).mean() > 0.9 and weights[1] > 0 > weights[2]
