"""Main texts against the planted articles of generated pages and a second, regular-expression reading of the given pages."""

from __future__ import annotations

import html
import re

import duckdb
import pytest

from tidemark.llm.main_text import Page, doubtful, extract

ARTICLE = ["Title &amp; more", "First  paragraph\nwith <b>bold</b> and <a href='/x'>a link</a> in it, long enough.", "Second one &lt;3", "<ul><li>one</li><li>two"]
TEXT = "Title & more\nFirst paragraph with bold and a link in it, long enough.\nSecond one <3\none\ntwo"


def page(body: str) -> str:
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}"


def article(tag: str) -> str:
    inner = f"<h1>{ARTICLE[0]}</h1><p>{ARTICLE[1]}<p>{ARTICLE[2]}</p>{ARTICLE[3]}</ul>"
    return f"<{tag}>{inner}</{tag.split()[0]}>"


NOISE = (
    "<nav><ul><li><a href='/'>Home</a></li></ul></nav><header>Site name</header><div class='cookie-notice'>We use cookies</div>"
    "<script>var t='</p>';</script><form><p>Search</p></form><!-- ad --><div class='ad'>Buy this</div>"
)
AFTER = (
    "<section id='comments'><h2>Comments</h2><p>A reader says a lot of things here, more than the article does itself, on and on "
    "and on.</p></section><aside>See also</aside><div class='sidebar'>Links</div><footer>&copy; nobody</footer></body></html>"
)


def test_noise_is_left_out():
    for tag in ("article", "main", "div class='post-12 body'", "section"):
        assert alone(page(NOISE + article(tag) + AFTER)) == TEXT, tag


def alone(source: str) -> str:
    """Text of a page by its own proposal, as far as it goes past links only."""
    found = Page(source)
    end = 0
    for i, left in found.chain():
        if left is not None:
            break
        end = i
    return found.main_text(found.containers[end]["path"])


PARAGRAPH = "<p>A sentence of the article that goes on for some time, as they do.</p>"
BODY = PARAGRAPH * 12


@pytest.mark.parametrize(
    "body",
    [
        f"<main><h1>Title</h1><p>Opening words.</p><div class='body'>{BODY}</div></main>",
        f"<div class='content-sidebar-wrap'><div class='entry'><h1>Title</h1><p>Opening words.</p>{BODY}</div></div>",
        f"<h1>Title</h1><p>Opening words.</p><table><tr><td>{BODY}</td></tr></table>",
        f"<div class='main-sidebar-container'><main><h1>Title</h1><p>Opening words.</p><section>{BODY}</section></main></div>",
        f"<div id='left-sidebar-content'><h1>Title</h1><p>Opening words.</p>{BODY}<div class='sidebar'><p>Other things</p></div></div>",
        f"<div class='post'><div class='post-header-block'><p>By the way</p></div><h1>Title</h1><p>Opening words.</p><div>{BODY}</div></div>",
        f"<center><h1>Title</h1><p>Opening words.</p><div>{BODY}</div></center><div class='comments'>{BODY * 3}</div>",
        f"<div><h1>Title</h1></div><div><p>Opening words.</p></div><div><div>{BODY}</div></div>",
        f"<div class='widget-area'><ul><li><a href='/'>Elsewhere</a></li></ul></div><main><h1>Title</h1><p>Opening words.</p><div>{BODY}</div></main>",
        f"<section><h1>Title</h1><p>Opening words.</p></section><section>{BODY}</section>",
        f"<div class='related'><article><p>Teaser</p></article></div><article><h1>Title</h1><p>Opening words.</p><div>{BODY}</div></article>",
        f"<ul><li><a href='/a'>One link</a></li><li><a href='/b'>Another link</a></li></ul><div><h1>Title</h1><p>Opening words.</p><div>{BODY}</div></div>",
        f"<h1>Title</h1><p>Opening words.</p><div><ol class='comment-list'><li><article>{BODY * 2}</article></li></ol></div><div>{BODY}</div>",
    ],
)
def test_whole_articles_stay(body):
    text = alone(page(NOISE + body + "</body></html>"))
    lines = text.split("\n")
    assert lines.count("Title") == 1 and lines.count("Opening words.") == 1, text
    assert sum(line.startswith("A sentence of the article") for line in lines) == 12
    assert "Other things" not in text and "Teaser" not in text and "By the way" not in text


def test_formulas_stay():
    formula = "<p>As <math><mi>a</mi><mo>=</mo><msup><mi>b</mi><mn>2</mn></msup><annotation>a=b^2</annotation></math> shows.</p>"
    assert alone(page(f"<main>{formula}</main>")) == "As a=b2 shows."


def test_host_consensus_corrects_single_pages(spark):
    """A long unnamed side column beats a short article alone, but not with the votes of the host."""
    side = "<div class='k7'>" + "<p>Unnamed column with many words in it for all to read. </p>" * 6 + "</div>"
    short = "<div class='side k'><p>x</p></div>"
    rows = [(i, f"http://Host.example/p{i}", page(short + article(f"div class='post-{i}'") + AFTER), 0) for i in range(8)]
    rows += [(8, "http://host.example/p8", page(side + article("div class='post-8'") + AFTER), 0)]
    assert alone(rows[8][2]) != TEXT
    rows += [(9, "http://host.example/p9", None, 0), (10, None, "", 0), (11, None, "just text", 0), (0, rows[0][1], rows[0][2], 0), (None, "x", "<p>a<p>b", 0)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, n_chars int")
    got = sorted(((r.page_id, r.text, r.n_chars) for r in extract(df).collect()), key=str)
    want = [(i, TEXT, len(TEXT)) for i in [0, *range(9)]] + [(9, "", 0), (10, "", 0), (11, "just text", 9), (None, "a\nb", 3)]
    assert got == sorted(want, key=str)
    assert extract(df.limit(0)).count() == 0


def test_given_pages_against_regular_expressions(spark):
    path = "/root/testdata/sf0.001/pages.parquet"
    found = {r.page_id: r.text for r in extract(spark.read.parquet(path)).collect()}
    rows = duckdb.sql(f"SELECT page_id, html FROM '{path}'").fetchall()
    assert len(found) == len(rows)
    for page_id, source in rows:
        inner = re.search(r"<article>(.*?)</article>", source, re.S).group(1)
        blocks = re.split(r"</?(?:p|h1|ul|li)\b[^>]*>", inner)
        texts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks]
        assert found[page_id] == "\n".join(t for t in texts if t), page_id


def test_hostile_markup_stays_linear():
    deep = Page("<div class='a'>" * 5000 + "deep" + "</b>" * 5000)
    assert deep.main_text(deep.containers[deep.chain()[-1][0]]["path"]) == "deep"
    assert not doubtful("body", {"class": "no-ads sidebar"}) and not doubtful("div", {"class": "content-with-sidebar"})
