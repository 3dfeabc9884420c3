import itertools
import random
import re

import pytest

from notepairs.llm import mincut_html as M

PAGES = {
    "<html><body><nav><a href='/'>Home</a></nav><article><h1>Title</h1><p>First &amp; last\n line.</p><p>Second<br>half.</p></article>"
    "<footer>&copy; us</footer></body></html>": "Title First & last line. Second half.",
    "<div class='menu'>Menu</div><div class='content'><p>Long enough text of the page, said well.</p><div class='ad'>Buy now! It is really cheap today.</div>"
    "<p>More of it.</p></div>": "Long enough text of the page, said well. More of it.",
    "<article><p>Body text is here.</p><form><input><label>Mail</label><button>Send</button></form><section id='comments'><p>I disagree with you, sir.</p></section>"
    "<script>var a = '</p>';</script><style>p {}</style><!-- no --></article><aside>Side text, also long enough to count.</aside>": "Body text is here.",
    "<main><header><h1>Head</h1></header><p>One <b>bo</b>ld w<i>or</i>d.<p>Two.<ul><li>Item one.<li>Item two.</ul></main>": "Head One bold word. Two. Item one. Item two.",
    "<article><p title='a > b'>Quoted &#65;&#x42;&nbsp;C.</p><div class='cookie-notice'>We use cookies to serve you better.</div></article>": "Quoted AB C.",
    "<p>Unclosed <b>text goes on and on, until the end of the page.": "Unclosed text goes on and on, until the end of the page.",
    "": "", "<nav><a>x</a></nav>": "", "plain words without any markup at all, but a full sentence.": "plain words without any markup at all, but a full sentence.",
    "<article><p>1 < 2 and 3 > 2 &lt;ok&gt;.</p></article>": "1 < 2 and 3 > 2 <ok>.", "<!-- never closed <p>text</p>": "",
}


@pytest.mark.parametrize("page", list(PAGES))
def test_pages(page):
    assert M.main_text(page) == PAGES[page]


BODY = "<p>The first paragraph of the article is long enough, and it says what it has to say.</p><p>The second one goes on about it, with some more words to read.</p>"
TEXT = "The first paragraph of the article is long enough, and it says what it has to say. The second one goes on about it, with some more words to read."
REST = "<div class='sidebar'>A side text of some length, which is not the article at all.</div><footer>All rights reserved.</footer>"
WHOLE = [
    f"<svg class=i />{BODY}", f"<svg viewBox='0 0 1 1'/><p></p>{BODY}", f"<svg><title>Icon</title><path d='M0 0'/></svg>{BODY}", f"<object data='x.swf'>{BODY}", f"<math/>{BODY}",
    f"<article class='post category-legal'>{BODY}</article>{REST}", f"<div class='content no-sidebar'>{BODY}</div>{REST}", f"<div class='has-comments'>{BODY}</div>{REST}",
    f"<div class='content-sidebar-wrap'><main>{BODY}</main>{REST}</div>", f"<div class='content-sidebar-wrap'><div>{BODY}</div>{REST}</div>", f"<div class='tag-ads with-banner post'>{BODY}</div>{REST}",
    f"<div id='page' class='site-header-fixed'><article>{BODY}</article>{REST}</div>", f"<article>{BODY}<div id='post-comments'><p>I read this twice and do not agree with any word of it, my dear sir.</p></div></article>{REST}",
    f"<article>{BODY}<p class='share'>Share this page</p></article>", f"<main>{BODY}<div class='promo'>Buy two of these today, and get the third one for nothing at all.</div></main>",
    f"<div>{BODY}</div><select><option>One<option>Two</select>", f"<select><option>One<option>Two<div>{BODY}</div>",
]


@pytest.mark.parametrize("page", WHOLE)
def test_articles_survive_names_and_broken_markup(page):
    assert M.main_text(page) == TEXT


@pytest.mark.parametrize("name", ["related-work", "legal", "side-effects", "article-share-tools", "search-methods"])
def test_prose_outweighs_hints(name):
    prose = "This section belongs to the article as its words show, since it is written out in full sentences that go on for quite a while and are about what the others are about, with no link in any of them, to the end."
    page = f"<article>{BODY}<div class='{name}'>{prose}</div>{BODY}</article>"
    assert M.main_text(page) == f"{TEXT} {prose} {TEXT}"


def test_remarks_of_most_words_still_go():
    remarks = "".join(f"<p>Remark number {i} of a reader, who has a lot to say about all of this today.</p>" for i in range(20))
    assert M.main_text(f"<article>{BODY}</article><section class='comments-area'>{remarks}</section>") == TEXT


def test_pages_are_labelled_by_a_minimum_cut(monkeypatch):
    """Every labelling of the blocks of small pages costs at least as much as the one that is taken."""
    seen = []
    cut = M.min_cut
    monkeypatch.setattr(M, "min_cut", lambda gains, edges: seen.append((gains, edges, cut(gains, edges))) or seen[-1][2])
    rng = random.Random(8)
    for _ in range(60):
        parts = rng.choices([BODY, "<p>Short</p>", "<p class='tags'>one, two</p>", "<div class='ad'>Buy it now.</div>", "<ul><li><a href=x>Link</a></ul>", "<article><h2>Head</h2><p>Text.</p></article>"], k=4)
        M.main_text("<div>".join(parts))
    assert any(len(set(side)) == 2 for _, _, side in seen)
    for gains, edges, side in seen:
        if len(gains) <= 10:
            assert cost(gains, edges, side) == pytest.approx(min(cost(gains, edges, s) for s in itertools.product((False, True), repeat=len(gains))))


def cost(gains, edges, side):
    return sum(max(g, 0) for g, s in zip(gains, side) if not s) + sum(max(-g, 0) for g, s in zip(gains, side) if s) + sum(w for a, b, w in edges if side[a] != side[b])


def test_cuts_are_minimal():
    rng = random.Random(5)
    for _ in range(300):
        n = rng.randint(1, 8)
        gains = [rng.choice((-1, 1)) * rng.random() * 4 for _ in range(n)]
        edges = [(i, i + 1, rng.random() * 3) for i in range(n - 1)] + [(rng.randrange(n), rng.randrange(n), rng.random()) for _ in range(3)]
        edges = [e for e in edges if e[0] != e[1]]
        best = min(cost(gains, edges, side) for side in itertools.product((False, True), repeat=n))
        assert cost(gains, edges, M.min_cut(gains, edges)) == pytest.approx(best)


def test_neighbours_decide_weak_blocks():
    lone = "<div><div><p>Yes</p></div></div>"
    inside = "<div><p>A long paragraph of text that says a lot of things, one after another.</p><p>Yes</p><p>A long paragraph of text that says a lot more things.</p></div>"
    assert "Yes" in M.main_text(inside) and M.main_text(lone) == ""


def test_table_of_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in M.extract(pages).collect()}
    for page in pages.collect():
        inner = re.sub(r"<[^>]+>", " ", re.search("<article>(.*?)</article>", page.html, re.S)[1])
        row = got[page.page_id]
        assert row.text.split() == M.html.unescape(inner).split() and row.n_chars == len(row.text) and row.url == page.url
    odd = spark.createDataFrame([(None, None, None, "x"), (1, "u", "", "y"), (1, "u", "<p>Deep.</p>" + "<div>" * 3000 + "text", "z")], "page_id long, url string, html string, text string")
    assert sorted(r.n_chars for r in M.extract(odd).collect())[:2] == [0, 0]
    assert M.extract(odd.limit(0)).count() == 0
