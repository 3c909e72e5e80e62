"""Main text of pages, and wrappers."""

from __future__ import annotations

import html
import json
import re

import pytest

from parcelscope.llm import wrappers
from parcelscope.llm.shipping import ship
from parcelscope.llm.text import table

PAGE = """<html><head><title>t</title></head><body><header>Site</header><nav><ul><li>menu</ul></nav>
<div class="cookie-notice">We use cookies</div><article><header><h1>Head &amp; line</h1></header><p>One<br>two <b>bold</b>
<p>Three <span class=ad-slot>BUY</span> &eacute;&#33; a < b<script>var x = "</p><p>no";</script><ul><li>i<li>ii</ul>
<aside>side</aside><form><p>mail</form><table><tr><td>c1<td>c2</table><section id=comments><p>first!</section></article>
<div id="sidebar"><p>side</p></div><footer>&copy; x</footer></body>"""


def test_article():
    assert wrappers.main_text(PAGE).split("\n") == ["Head & line", "One two bold", "Three é! a < b", "i", "ii", "c1", "c2"]


@pytest.mark.parametrize("page,text", [
    ("", ""), ("plain", "plain"), ("<article></article>", ""), ("<p>a</b>b", "ab"), ("<article><p>x &am", "x &am"),
    ("<article>&nbsp; a\n\tb </article>", "a b"), ("<article><!-- <p>no</p> --><p>yes", "yes"), ("<main><article>a</article><p>b</main>", "a"),
    ("<article><a title=it's>x</a></article>", "x"), ("<article><p>a</article><article><p>b</article>", "a\nb"),
    ("<article><script>never closed", ""), ("<title>open<article>a</article>", "a"), ("<article><p hidden>b</p>a", "b\na"),
    ("<p hidden>no</p>a", "a"), ("<main><nav>n</nav><h1>Title</h1><p>Intro</p><div>x</div><article>a</article><p>b</main>", "Title\nIntro\na"),
])
def test_odd_pages(page, text):
    assert wrappers.main_text(page) == text


@pytest.mark.parametrize("page,text", [
    ("<article class='post has-comments'><p>a</article>", "a"), ("<article class=comments><p>a</article>", "a"),
    ("<div class='layout with-sidebar'><article>a</article></div>", "a"), ("<div class='layout with-sidebar'><p>a</div>", "a"),
    ("<div class=overlay><main>a</main></div><div class=ad>b</div>", "a"), ("<form><main>a</main></form>", "a"),
    ("<article>a</article><div class=related><article>b</article></div>", "a"), ("<article><h2 id='related-work'>a</h2>b</article>", "a\nb"),
    ("<article><section id='feedback-control'>a</section><section id='ad-hoc-queries'>b</section></article>", "a\nb"),
    ("<article>a <math><mi>x</mi></math> <svg><title>t</title><text>y</text></svg></article>", "a x y"),
    ("<article>a<div class=notice>n</div><div class=related-links>r</div><section id=comments>c</section></article>", "a\nn"),
])
def test_marks_take_no_article_away(page, text):
    assert wrappers.main_text(page) == text


@pytest.mark.parametrize("mark", [
    "class=post-comments", "class=reader-comments", "class='x article-comments'", "class=user-comments", "id=comment-list", "id=comments",
    "class=comment-section", "class=ad-slot-top", "class=sponsored-content", "class=in-article-ad", "class='inline-ad-box'", "class=adBanner",
])
def test_comments_and_adverts_inside_an_article(mark):
    assert wrappers.main_text(f"<article><p>a</p><div {mark}><p>no</p></div>b</article>") == "a\nb"


@pytest.mark.parametrize("mark", [
    "class=ad-hoc-note", "id=ad-hoc", "class=no-comments", "class=has-comments", "class=commentary", "class=download", "id=comment-on-x-and-y",
    "class=address", "class=shadow-box", "class=header-text",
])
def test_marks_that_only_look_like_it(mark):
    name = "h2" if "comment-on" in mark else "div"
    assert wrappers.main_text(f"<article><p>a</p><{name} {mark}><p>yes</p></{name}>b</article>").replace("\n\n", "\n") == "a\nyes\nb"


def deep(n, inner="<p>x</p>y", tag="div"):
    return f"<{tag}>" * n + inner + f"</{tag}>" * n


@pytest.mark.parametrize("tag,n", [
    *[(tag, n) for tag in ("div", "section", "blockquote", "article", "span", "b", "ul", "nav", "main") for n in (100, 150, 1_500)],
    ("div", 100_000), ("article", 30_000), ("nav", 30_000),
])
def test_deep_nesting(tag, n):
    page = f"<article>a{deep(n, '<p>x</p>y', tag)}z</article>"
    text = wrappers.main_text(page, wrapper([page, page.replace(">x<", ">u<")]))
    want = {"nav": "a\nz", "span": "a\nx\nyz", "b": "a\nx\nyz"}.get(tag, "a\nx\ny\nz")
    assert text == want


def test_deep_nesting_with_text_on_the_way():
    for n in (90, 5_000):
        page = "<article>" + "".join(f"<div>{i}<div>in {i}</div>then {i}" for i in range(n)) + "</article>"
        assert wrappers.main_text(page).split("\n") == [line for i in range(n) for line in (f"{i}", f"in {i}", f"then {i}")]
    hidden = "<div>" * 500 + "<nav>no<p>no</p></nav><form>no</form><p>yes</p><article>main</article>"
    assert wrappers.main_text(hidden.replace("<article>main</article>", "")) == "yes"


def test_stray_tags_in_deep_pages_take_no_time():
    page = "<div>" * 20_000 + "</span></p><li>a" * 20_000
    assert wrappers.main_text(page).count("a") == 20_000


def test_one_deep_page_fails_no_task(spark):
    ship(spark)
    rows = [(1, "http://a.b/1", f"<article>{deep(1_500)}</article>"), (2, "http://a.b/2", "<article><p>fine</article>"), (3, "http://a.b/3", deep(100_000))]
    got = wrappers.with_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {1: "x\ny", 2: "fine", 3: "x\ny"}


def test_a_notice_that_the_host_repeats_is_left_out_of_articles():
    page = lambda i: f"<article><p>text {i}<div class=notice>same</div><div class=alert>own {i}</div></article>"
    assert wrappers.main_text(page(1), wrapper([page(i) for i in range(3)])) == "text 1\nown 1"


def unmarked(i, note="All rights reserved"):
    body = "".join(f"<p>paragraph {i} {k} of the text</p>" for k in range(i % 3 + 1))
    extra = "<div class=box>Picture of the day</div>" if i % 2 else ""
    return f"<body><div>Name of the site</div><div class=c><h1>Title {i}</h1>{extra}{body}<p>{note}</p></div><div>{note}</div></body>"


def wrapper(pages):
    known = None
    for page in pages:
        known = wrappers.fold(known, wrappers._from_page(page))
    return known


def test_wrapper_has_slots_options_and_repeats():
    known = wrapper([unmarked(i) for i in range(6)])
    content = known["c"][1]["c"] if known["c"][1]["k"] == "div.c" else known["c"][0]["c"]
    kinds = {c["k"]: c for c in content}
    assert kinds["h1"]["c"][0]["t"] is None
    assert kinds["div.box"]["o"] == 1 and kinds["div.box"]["c"][0]["t"] is not None
    assert kinds["p"]["r"] == 1


def test_wrappers_fold_in_any_order():
    pages = [unmarked(i) for i in range(8)]
    left = wrapper(pages)
    halves = wrappers.fold(wrapper(pages[:3]), wrapper(pages[3:]))
    assert json.dumps(halves, sort_keys=True) == json.dumps(left, sort_keys=True)


def test_template_texts_drop_out_of_unmarked_pages():
    known = wrapper([unmarked(i) for i in range(6)])
    lines = wrappers.main_text(unmarked(3), known).split("\n")
    assert lines[0] == "Title 3" and "paragraph 3 0 of the text" in lines
    assert "Name of the site" not in lines and "Picture of the day" not in lines


def test_an_article_that_the_host_repeats_is_template():
    page = lambda i: f"<article><h1>Title {i}</h1><p>same</p></article><article class=club><p>Join our club</article>"
    known = wrapper([page(i) for i in range(3)])
    assert wrappers.main_text(page(1), known) == "Title 1\nsame"
    assert wrappers.main_text(page(1)) == "Title 1\nsame\nJoin our club"
    alike = wrapper([f"<div>{i}</div><article><p>all alike</article>" for i in range(3)])
    assert wrappers.main_text("<div>1</div><article><p>all alike</article>", alike) == "all alike"


def test_pages_that_repeat_in_full_keep_their_text():
    known = wrapper([unmarked(2)] * 3)
    assert "paragraph 2 1 of the text" in wrappers.main_text(unmarked(2), known)


def plain_text(page):
    start = page.index("<article>") + 9
    end = page.find("</article>", start)
    blocks = re.split("</?(?:h1|p)>", page[start : end if end >= 0 else len(page)])
    lines = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in blocks]
    return "\n".join(x for x in lines if x)


def test_documents(spark):
    ship(spark)
    pages = table(spark, "/root/testdata/sf0.001", "pages")
    rows = wrappers.with_main_text(pages.selectExpr("*", "1 AS text", "2 AS _host")).collect()
    assert len(rows) == pages.count()
    assert all(r["text"] == plain_text(r["html"]) for r in rows)


def test_null_and_repeated_rows(spark):
    ship(spark)
    rows = [(1, None, None), (2, "http://a.b/", ""), (3, "http://a.b/", "<p>x"), (3, "http://a.b/", "<p>x"), (None, "no host", "<p>y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted(((r["page_id"], r["text"]) for r in wrappers.with_main_text(pages).collect()), key=str)
    assert got == [(1, ""), (2, ""), (3, "x"), (3, "x"), (None, "y")]
    assert wrappers.with_main_text(pages.limit(0)).count() == 0


def test_many_wrappers_of_a_host_meet(spark, monkeypatch):
    ship(spark)
    rows = [(i, f"http://h{i % 2}.net/x", unmarked(i)) for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, host string, html string").repartition(7)
    found = {r["host"]: json.loads(r["wrapper"]) for r in wrappers.wrappers(pages).collect()}
    assert len(found) == 2 and all("one" not in w for w in found.values())
