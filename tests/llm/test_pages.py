"""Main text of pages: markup, entities, boilerplate, broken pages; the cut against all labellings."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sparkprep.llm import pages as module
from sparkprep.llm.pages import extract_pages, main_text, minimum_cut

PROSE = "This sentence is long enough to be a part of the article, as anyone can see."

CASES = [
    (None, ""),
    ("", ""),
    ("   ", ""),
    ("<html><head><title>T</title></head><body></body></html>", ""),
    (f"<article><h1>A &amp; B&nbsp;&#39;c&#x27;</h1><p>{PROSE}</article>", f"A & B 'c'\n{PROSE}"),
    (f"<article><p><b>One\n  two<br><p>{PROSE}</p></article>", f"One two\n{PROSE}"),
    (f"<nav><a href=/>Home</a></nav><article><p>{PROSE}</p></article><footer>&copy; x</footer>", PROSE),
    (f"<article><p>{PROSE}</p><section class='comments'><p>{PROSE} I agree.</p></section></article>", PROSE),
    (f"<div id=content><p>{PROSE}</p></div><div class='sidebar'><p>{PROSE}</p></div>", PROSE),
    (f"<article><p>{PROSE}</p><script>var t='</p><p>no';</script><style>p{{}}</style><!-- <p>no --></article>", PROSE),
    (f"<main><p>{PROSE}</p><form><label>Mail</label><input></form><aside>Buy</aside></main>", PROSE),
    (f"<div class='cookie-notice'>{PROSE}</div><article><p>{PROSE}</p><div class='ad'>{PROSE}</div></article>", PROSE),
    (f"<article><p>{PROSE}</p><p>&lt;b&gt; stays &amp;amp;</p>", f"{PROSE}\n<b> stays &amp;"),
    ("<article><p>Short.</p><p>Ok</p></article>", "Short.\nOk"),
    (f"<article><ul><li>one<li>two</ul><table><tr><td>a<td>b</table><p>{PROSE}", f"one\ntwo\na\nb\n{PROSE}"),
    (f"<article><p title='a > b'>{PROSE}</p", PROSE),
]


@pytest.mark.parametrize(("page", "text"), CASES)
def test_cases(page, text):
    assert main_text(page or "") == text


def test_long_page():
    page = "<article>" + f"<p>{PROSE}</p><div>x" * 20_000
    assert main_text(page).count(PROSE) == 20_000


def test_minimum_cut_is_the_cheapest():
    rng = random.Random(2)
    for _ in range(150):
        n = rng.randint(1, 7)
        scores = [rng.uniform(-2, 2) for _ in range(n)]
        edges = {(i, j): rng.uniform(0, 1.5) for i in range(n) for j in range(i + 1, n) if rng.random() < 0.5}

        def cost(side):
            terminals = sum(max(s, 0) if not x else max(-s, 0) for s, x in zip(scores, side))
            return terminals + sum(w for (i, j), w in edges.items() if side[i] != side[j])

        best = min(cost(side) for side in itertools.product([False, True], repeat=n))
        assert cost(minimum_cut(scores, edges)) == pytest.approx(best)


def test_extract(spark):
    rows = [(i, None if i == 1 else f"u{i}", p, "x", i) for i, (p, _) in enumerate(CASES)] + [(0, "u0", None, "x", 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    done = extract_pages(pages)
    assert done.columns == ["page_id", "url", "text", "n_chars"] and done.count() == len(rows)
    for r in done.collect():
        assert r["text"] == CASES[r["page_id"]][1] and r["n_chars"] == len(r["text"])
    assert extract_pages(pages.limit(0)).count() == 0


def test_pages_of_the_table(spark, small):
    """The article element of every page, cut out by patterns."""
    from sparkprep.llm.common import read

    pages = read(spark, small, "pages")
    inner = F.regexp_extract("html", r"(?s)<article>(.*?)</article>", 1)
    import html

    want = {}
    for r in pages.select("page_id", inner.alias("t")).collect():
        parts = r["t"].replace("<b>", "").replace("</b>", "").replace("<br>", " ")
        for tag in ("<p>", "</p>", "<h1>", "</h1>"):
            parts = parts.replace(tag, "\0")
        want[r["page_id"]] = "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts.split("\0")) if x)
    assert {r["page_id"]: r["text"] for r in extract_pages(pages).collect()} == want


WRAPPED = [
    (f"<div class='content-sidebar-wrap'><p>{PROSE}</p></div>", PROSE),
    (f"<main class='has-sidebar'><p>{PROSE}</p></main>", PROSE),
    (f"<main class='search'><p>{PROSE}</p></main>", PROSE),
    (f"<div id='content' class='with-sidebar'><p>{PROSE}</p></div>", PROSE),
    (f"<article class='share-price-report'><p>{PROSE}</p></article>", PROSE),
    (f"<div class='share-price-report'><p>{PROSE} {PROSE} {PROSE}</p></div>", f"{PROSE} {PROSE} {PROSE}"),
    (f"<div class='sidebar-container'><main><p>{PROSE}</p></main></div>", PROSE),
    (f"<div class='sidebar'><article><p>{PROSE}</p></article></div>", PROSE),
    (f"<div class='notice'><p>{' '.join([PROSE] * 9)}</p></div>", " ".join([PROSE] * 9)),
    (f"<article><p>{PROSE}</p><div class='comment-list'><p>{PROSE} {PROSE} {PROSE}</p></div></article>", PROSE),
    (f"<main><p>{PROSE}</p><div id=comments><article class='comment'><p>{PROSE}</p></article></div></main>", PROSE),
    (f"<article><p>{PROSE}</p></article><div class='site-footer'><p>{PROSE}</p></div><div class='main-nav'>{PROSE}</div>", PROSE),
    (f"<div class='related-posts'><article><a href=x>{PROSE}</a></article></div><article><p>{PROSE}</p></article>", PROSE),
]


@pytest.mark.parametrize(("page", "text"), WRAPPED)
def test_marked_wrappers(page, text):
    assert main_text(page) == text


OTHER = "Another text of the page that is long enough to look like an article but is none of it."
ARTICLE = f"<article><h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p>"
TEXT = f"Title\n{PROSE}\n{PROSE}"
BOILERPLATE = [
    f"{ARTICLE}</article><article class=comment><p>{OTHER}</p></article>",
    f"{ARTICLE}</article><article class='teaser'><h2>More</h2><p>{OTHER}</p></article>",
    f"{ARTICLE}</article><h3>3 Comments</h3><ol><li><p>{OTHER}</p></li><li><p>{OTHER}</p></li></ol>",
    f"{ARTICLE}<h2>Comments (2)</h2><div><p>{OTHER}</p></div><p>{OTHER}</p></article>",
    f"{ARTICLE}<div><h3>Leave a comment</h3><p>{OTHER}</p></div></article>",
    f"{ARTICLE}<section><h4>Kommentare</h4><p>{OTHER}</p></section></article>",
    f"{ARTICLE}<div class='alert alert-info'><p>{OTHER}</p></div></article>",
    f"<div class='alert alert-info'>{OTHER}</div>{ARTICLE}</article>",
    f"{ARTICLE}<div role='alert'><p>{OTHER}</p></div></article>",
    f"{ARTICLE}<div class='adsbygoogle'><p>{OTHER}</p></div></article>",
    f"{ARTICLE}<section class='related-articles'><p>{OTHER}</p></section></article>",
    f"{ARTICLE}<div class='related-stories'><h3>Read on</h3><p>{OTHER}</p></div></article>",
]


@pytest.mark.parametrize("page", BOILERPLATE)
def test_comments_notices_and_adverts_go(page):
    assert main_text(page) == TEXT


KEPT = [
    (f"<article><h1>Comments</h1><p>{PROSE}</p></article>", f"Comments\n{PROSE}"),
    (f"<article><h2>Comments on the law</h2><p>{PROSE}</p></article>", f"Comments on the law\n{PROSE}"),
    (f"<article><p>{PROSE}</p><h3>3 comments</h3><p>{OTHER}</p><h2>Sources</h2><p>{PROSE}</p></article>", f"{PROSE}\nSources\n{PROSE}"),
    (f"<div><h3>Discussion</h3><p>{OTHER}</p></div>{ARTICLE}</article>", TEXT),
    (f"<article class='news-item'><p>{PROSE}</p></article>", PROSE),
    (f"<article class='red-alert-report'><p>{PROSE}</p></article>", PROSE),
]


@pytest.mark.parametrize(("page", "text"), KEPT)
def test_headings_and_names_that_only_look_alike(page, text):
    assert main_text(page) == text


def test_the_cut_decides_short_blocks_between_long_ones(monkeypatch):
    """Without edges the short blocks of a page without an article element are lost."""
    long = f"{PROSE} {PROSE}"
    page = f"<div><p>{long}</p><div>Fig one two</div><p>{long}</p><div>Fig three</div><div>{PROSE[:-1]}</div><p>{long}</p></div>"
    with_edges, flows = main_text(page), []
    flow = module._flow
    monkeypatch.setattr(module, "_flow", lambda *a: flows.append(1) or flow(*a))
    assert main_text(page) == with_edges and "Fig one two" in with_edges
    monkeypatch.setattr(module, "_closeness", lambda a, b: 0.0)
    assert "Fig one two" not in main_text(page) and long in main_text(page)
    # Two short neighbours hold each other: only the flow tells that dropping both is cheaper.
    near = {(0, 1): 0.6, (1, 2): 0.6, (2, 3): 0.6}
    assert minimum_cut([4.0, -0.5, -0.4, 4.0], near) == [True] * 4
    assert minimum_cut([4.0, -0.9, -0.9, 4.0], near) == [True, False, False, True] and flows
