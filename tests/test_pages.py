"""Pages cut by one pattern say what the parser says."""

import random

import pytest

from quadrat.operators import pages as H

PLAIN = ["<table>", "<table id='example' title='x,1'>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<td>a &amp; b</td>", "<TH class=\"c\">x</TH>", "<th>",
         "<a href=\"x&lt;y\">", "</a >", "text & more", "&amp", " ", "<br>", "<div>", "</div>"]
ODD = ["<br/>", "<img src=x>", "a<b", "<!-- c -->", "<script>if(a<b)</script>", "<td a=\"1\"b=\"2\">", "<td/>", "</td a=\"1\">", "<title>", "<a href=\"", "<"]


def _parsed(text, within):
    page = H._Page(within)
    page.feed(text)
    page.close()
    return page.rows, [(h, "".join(t), raw) for h, t, raw in page.links]


def _read(text, within):
    page = H._Page(within)
    page.read(text)
    return page.rows, [(h, "".join(t), raw) for h, t, raw in page.links]


@pytest.mark.parametrize("within", [None, ("table", "id", "example"), ("td", "class", "c")])
def test_read_equals_parser(within):
    draw = random.Random(3)
    for bits in (PLAIN, PLAIN + ODD):
        for _ in range(1500):
            text = "".join(draw.choice(bits) for _ in range(draw.randint(0, 30)))
            assert _read(text, within) == _parsed(text, within), text


def test_plain_page_needs_no_parser(monkeypatch):
    def refuse(self, text):
        raise AssertionError("the slow parser was called")

    monkeypatch.setattr(H._Page, "feed", refuse)
    rows, links = _read("<html><table id='e' title='x,7'><tr><th>N</th></tr><tr><td> a\n b</td><td><a href=\"u\">v</a></td></tr></table></html>", ("table", "id", "e"))
    assert rows == [(0, 0, ["N"], ["N"], "e", "x,7"), (0, 1, ["a b", "v"], ["N"], "e", "x,7")]
    assert links == [("u", "v", "<a href=\"u\">")]


def test_pages_without_key_or_rows(spark):
    pages = spark.createDataFrame([(None, "<table><tr><td>1</td></tr></table>"), (2**60 + 1, None), (2**60 + 3, "<a href='x'>y</a>")], "page bigint, html string")
    found = H.parse_pages(pages, "page", "html").select("page", "table_no", "cells", "link_no", "href").collect()
    assert sorted(map(tuple, found), key=str) == sorted([(None, 0, ["1"], None, None), (2**60 + 3, None, None, 0, "x")], key=str)
