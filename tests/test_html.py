"""The tokeniser and the anchors of pages (SC10)."""
import random

from claimlake.plans.catalogue import FORM_PAGES, MARKUP_PAGES
from claimlake.sources.html import END, START, TEXT, anchors_of, page_anchors, tokens


def test_stated_pages(spark):
    stated = [*FORM_PAGES, *MARKUP_PAGES]
    pages = spark.createDataFrame([(k, "https://x.org/p", html) for k, (html, _) in enumerate(stated)], "page_id long, url string, html string")
    got = {}
    for r in page_anchors(pages).collect():
        got.setdefault(r.page_id, []).append((r.href, r.text, r.child1))
    assert got == {k: found for k, (_, found) in enumerate(stated)}


def test_comments():
    for comment in ("<!-- <a href=/x>x</a> -->", "<!--><!-->", "<!--->", "<!-- a -- b --!>", "<!---- <a href=/x> ---->", "<!DOCTYPE html>", "<?php <a ?>", "</ bogus <a >"):
        assert anchors_of(f'{comment}<a href="/y">y</a>') == [("/y", "y", None)], comment
    assert anchors_of('<a href="/y">y</a><!-- <a href="/x">x</a>') == [("/y", "y", None)]


def test_raw_text():
    page = '<script><!-- <a href="/1">1</a> </script-x> </SCRIPT\n><title><a href="/2"></title><a href="/3">3</a><style><a href="/4">'
    assert anchors_of(page) == [("/3", "3", None)]
    assert anchors_of('<a href="/a"><textarea><b></textarea>after<b>x</b></a>') == [("/a", None, "after")]


def test_attributes():
    assert anchors_of("<a title='x>y' data-href=/no href = /v/ class=c>t</a>") == [("/v/", "t", None)]
    assert anchors_of('<a href="/1" href="/2">t</a><a HREF>none</a><a =x href=/3>u</a>') == [("/1", "t", None), ("/3", "u", None)]
    assert anchors_of('<a href="/open>t</a>') == [] and anchors_of("<a href=/x") == [] and anchors_of("<a href=/x   ") == []
    assert anchors_of('<a href="">t</a>') == [("", "t", None)]


def test_stack():
    assert anchors_of('<a href="/1"><div><div></div><div><br></div></div>tail</a>') == [("/1", None, "tail")]
    assert anchors_of('<a href="/1"><div><p>x</div>tail</a>') == [("/1", None, "tail")]
    assert anchors_of('<a href="/1"><b></i></b>one</i>two</a>') == [("/1", None, "one")]
    assert anchors_of('<a href="/1"></i>text</a>') == [("/1", "text", None)]
    assert anchors_of('<a href="/1"><b>x</b><i>y</i>z</a>') == [("/1", None, None)]


def test_tokens_are_the_page():
    assert [(k, v) for k, v, _, _ in tokens("a<B x=1>c</b >d < e")] == [(TEXT, "a"), (START, "b"), (TEXT, "c"), (END, "b"), (TEXT, "d <"), (TEXT, " e")]


def test_any_bytes_are_read_in_one_pass():
    rng = random.Random(4)
    for _ in range(300):
        page = "".join(rng.choice(["<a href=/x>", "</a>", "<!--", "-->", "<b>", "</b>", "text", "<", ">", '"', "'", "=", "<script>", "</script>", "/", " "])
                       for _ in range(rng.randint(0, 40)))
        for _, _, child in anchors_of(page):
            assert child is None or child
    deep = "<a href=/d>" + "<b>" * 100_000 + "</i>" * 100_000 + "</b>" * 100_000 + "end</a>"
    assert anchors_of(deep) == [("/d", None, "end")]
    assert anchors_of("<a href='/x'>" * 50_000 + '<a title="' * 20_000)[:1] == [("/x", None, None)]


def test_null_pages_and_clashing_columns(spark):
    pages = spark.createDataFrame([(1, None, "u", "h"), (2, "<a href=/x>t</a>", "u", "h")], "id int, body string, text string, _href string")
    got = page_anchors(pages, "body", ["id", "_href"]).collect()
    assert [tuple(r) for r in got] == [(2, "h", "/x", "t", None)]
