"""Wrapper inference and extraction: expressions match the pages they come from, furniture goes, odd pages don't crash."""

import html
import json
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexloom.llm import wrappers as w


def tokens(e):
    """Raw token stream of a parsed page."""
    out = ""
    for k in e.kids:
        if isinstance(k, tuple):
            out += "#;"
        elif k.drop:
            out += f"{k.name}!;"
        else:
            name = f"{k.name}*" if k.article else k.name
            out += f"<{name};{tokens(k)}/{name};"
    return out


def pattern(items):
    out = ""
    for t, q, held, _ in items:
        if t == "#" or t[-1] == "!":
            body = re.escape(t + ";")
        elif t[0] == "(":
            body = pattern(held)
        else:
            body = re.escape(f"<{t};") + pattern(held) + re.escape(f"/{t};")
        out += f"(?:{body}){q}"
    return out


def inferred(pages):
    now = None
    for p in pages:
        items = w._bare(w.expression(w.parse(p))[0])
        now = w.align(now, items) if now is not None else items
    return now


def wrapper_of(pages):
    return w._dump(len(pages), inferred(pages))


PIECES = ["<p>", "</p>", "<div>", "</div>", "<h2>", "</h2>", "<li>", "<ul>", "</ul>", "text ", "more", "<b>", "</b>", "<nav>", "</nav>", "<article>", "</article>", "<td>", "<tr>", "<table>", "</table>", "<br>", "<a href=x>", "</a>", "<dt>", "<dd>"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=30).map("".join), min_size=1, max_size=4))
def test_wrapper_matches_its_pages(pages):
    held = inferred(pages)
    for p in pages:
        assert re.fullmatch(pattern(held), tokens(w._settle(w.parse(p))))
        items, texts = w.expression(w.parse(p))
        seen = []
        w._located(held, items, lambda slot, by, article, repeated: seen.append(by is not None))
        assert all(seen)


@settings(max_examples=300, deadline=None)
@given(st.text("<>/!-=\"' apdivscrtl&;#\n", max_size=80))
def test_any_string_is_a_page(text):
    assert isinstance(w.main_text(text), str)


def test_groups_and_options():
    one = "<h2>a</h2><p>b</p><h2>c</h2><p>d</p><p>e</p>"
    assert inferred([one])[0][:2] == ["(h2 p", "+"] and [(i[0], i[1]) for i in inferred([one])[0][2]] == [("h2", ""), ("p", "+")]
    assert [i[:2] for i in inferred([one, "<h2>x</h2><p>y</p><hr><div>z</div>"])] == [["(h2 p", "+"], ["div", "?"]]
    assert [i[:2] for i in inferred(["<p>a</p>", "<p>x</p><p>b</p>", "<div>c</div>"])] == [["p", "*"], ["div", "?"]]
    fixed, varied = inferred(["<div>same</div><div>one</div>", "<div>same</div><div>two</div>"])
    assert fixed[2][0][3][1] != 0 and varied[2][0][3][1] == 0


BODY = "<h1>Title &amp; more</h1><p>First  para\n graph.<p>Second <b>bold</b><i>er</i><br>line &eacute;&#x41;&nbsp;&amp<ul><li>one<li>two</ul><table><tr><td>c1<td>c2</table>"
TEXT = "Title & more\n\nFirst para graph.\n\nSecond bolder line éA &\n\none\n\ntwo\n\nc1\n\nc2"
AROUND = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style><script>var t="</p><article>no</article>";</script></head><body class="has-sidebar">
<header>Site <a href=/>Home</a></header><nav><ul><li><a href=/a>Menu</a></ul></nav><!-- <article>x</article> --><div class="cookie-notice">We use cookies</div>
<div id="sidebar-left"><p>Side</div><div class='ad' title="a > b">Buy</div><{tag}>{body}<aside>Aside</aside><div class="share-buttons">Share</div>
<form action=x>Name <input><textarea>t</textarea><button>Send</button></form><footer>By</footer></{tag}>
<section class="comments"><article class="comment"><p>Nice!</article></section><div role="complementary">Related</div><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize("tag", ["article", "main", 'div role="main"', 'div itemprop="articleBody"'])
def test_furniture_goes(tag):
    page = AROUND.format(tag=tag, body=BODY)
    assert w.main_text(page) == w.main_text(page, wrapper_of([page] * 4)) == TEXT
    assert w.main_text(page[:page.index("<aside>")]) == TEXT


def test_header_of_an_article_stays():
    assert w.main_text("<header>site</header><article><header><h1>t</h1></header><p>x</article>") == "t\n\nx"


def test_inline_furniture():
    assert w.main_text('<article><p>a <span class="share">Share <span>this</span></span>b</p><p>c <a class="promo">open<p>d</article>') == "a b\n\nc\n\nd"


def test_names_do_not_hide_the_only_article():
    assert w.main_text('<div class="page with-sidebar"><div class="menu">m</div><article><p>x</p></article></div>') == "x"
    assert w.main_text('<div class="comments"><article>y</article></div><p>z') == "z"


def page(i, note="Sign our petition today"):
    links = "".join(f"<li><a href=/{j}>Link {j} {i}</a></li>" for j in range(4))
    return f"<html><body><ul>{links}</ul><div><h1>Head {i}</h1><p>Words of page {i}.</p>{'<p>More words.</p>' * (i % 3)}</div><div>{note}</div></body></html>"


def test_pages_without_article_element():
    pages = [page(i) for i in range(6)]
    held = wrapper_of(pages)
    for i, p in enumerate(pages):
        assert w.main_text(p, held) == "\n\n".join([f"Head {i}", f"Words of page {i}.", *["More words."] * (i % 3)])
    assert w.main_text(pages[0]).startswith("Link 0 0") or "Head 0" in w.main_text(pages[0])
    assert "Sign our petition" in w.main_text(pages[0], wrapper_of(pages[:1] * 5))  # nothing varies, so nothing is known to be template
    assert w.main_text("just words, no tags", held) == "just words, no tags"


def test_long_and_deep_pages():
    deep = "<div>" * 50_000 + "core" + "</div>" * 50_000 + "<p>after"
    assert w.main_text(deep) == "core\n\nafter"
    assert w.main_text("<nav>" * 20_000 + "x" + "</nav>" * 20_000 + "<p>after") == "after"
    many = "<article>" + "".join(f"<p>t{i}" for i in range(20_000)) + "</article>"
    assert w.main_text(many, wrapper_of([many])) == "\n\n".join(f"t{i}" for i in range(20_000))
    odd = "".join(f"<{'h2' if i % 7 % 2 else 'div'}>{i}</{'h2' if i % 7 % 2 else 'div'}><dl>" for i in range(3000))
    assert w.main_text(odd).split("\n\n") == [str(i) for i in range(3000)]
    assert w.main_text("<a href=\"" * 20_000 + "x") == "" and w.main_text("<!--" * 20_000) == ""
    assert w.main_text("a < b & c > d &lt;p&gt; 1<2") == "a < b & c > d <p> 1<2"


def test_tables(spark):
    rows = [(1, "http://a.example/x", AROUND.format(tag="article", body=BODY), 5), (2, "http://a.example/y", None, 6), (3, None, "<article>z</article>", None), (None, "no scheme", "", 1),
            (1, "http://a.example/x", AROUND.format(tag="article", body=BODY), 5), (4, "HTTP://B.example", f"<p>{html.escape('<q> &amp;')}", 2)] + [(10 + i, "http://hot.example/p", page(i), 0) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, Text long").withColumn("_wrapper", F.lit("x"))
    out = w.extract(pages.repartition(7), text="Text")
    assert out.columns == ["page_id", "url", "_wrapper", "Text", "n_chars"]
    found = sorted((r["page_id"] or 0, r["Text"], r["n_chars"]) for r in out.collect())
    want = {0: "", 1: TEXT, 2: "", 3: "z", 4: "<q> &amp;"}
    assert [f for f in found if f[0] < 10] == [(i, want[i], len(want[i])) for i in (0, 1, 1, 2, 3, 4)]
    assert {t for i, t, _ in found if i == 12} == {"Head 2\n\nWords of page 2.\n\nMore words.\n\nMore words."}
    assert w.extract(pages.limit(0)).count() == 0
    held = w.infer(pages)
    assert {r["host"]: json.loads(r["wrapper"])[0] for r in held.collect()} == {"a.example": 3, "": 2, "b.example": 1, "hot.example": 60}
    assert w.extract(pages.filter("page_id = 4"), held.limit(0)).first()["text"] == "<q> &amp;"
