from __future__ import annotations

import random
from html import unescape
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from odflux.operators import links

PAGE = """<html><!-- <a href="/comment">x</a> --><script>s = '<a href="/script">';</script>
<style>a[href="/style"] { }</style><body>
<a href="/one/2012.xlsx">1</a> <A class="c>d" HREF='/two/2013.xlsx'>2</A>
<a id=3 href=/three/2012b.xlsx>3</a> <a name="none">4</a> <a data-href="/data">5</a>
<abbr href="/abbr">6</abbr> <a
  href="/six?a=1&amp;b=2013">7</a> <a href="/one/2012.xlsx">again</a></body></html>"""


def pages(spark):
    return spark.createDataFrame([(1, "u", PAGE), (2, "v", None), (3, "w", "no links")], "page_id long, url string, html string")


def test_only_real_anchors_in_document_order(spark):
    found = links.harvest_links(pages(spark)).orderBy("page_id", "pos").collect()
    assert [r["href"] for r in found] == [
        "/one/2012.xlsx", "/two/2013.xlsx", "/three/2012b.xlsx", "/six?a=1&b=2013", "/one/2012.xlsx",
    ]


def test_substring_is_literal(spark):
    assert links.harvest_links(pages(spark), "e/2012.").count() == 2
    assert links.harvest_links(pages(spark), "e/.*").count() == 0


def test_first_link_of_each_year(spark):
    found = links.with_year(links.with_url(links.harvest_links(pages(spark)), "https://h"))
    first = links.first_link_per_year(found).collect()
    assert [(r["year"], r["link_url"]) for r in first] == [(2012, "https://h/one/2012.xlsx"), (2013, "https://h/two/2013.xlsx")]


def test_a_very_long_page_is_read_whole(spark):
    html = F.concat(F.lit("<p>"), F.repeat(F.lit("x <b>y</b> "), 200_000), F.lit('<a href="/end">e</a>'))
    long = spark.range(1).select(F.col("id").alias("page_id"), html.alias("html"))
    assert [r["href"] for r in links.harvest_links(long).collect()] == ["/end"]


class Anchors(HTMLParser):
    """Hrefs by the parser of the standard library."""

    def __init__(self):
        super().__init__()
        self.hrefs = []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and "href" in dict(attrs):
            self.hrefs.append(dict(attrs)["href"] or "")

    handle_startendtag = handle_starttag


def parsed(html: str) -> list[str]:
    parser = Anchors()
    parser.feed(html)
    parser.close()
    return parser.hrefs


def harvested(spark, htmls: list[str]) -> list[list[str]]:
    df = spark.createDataFrame(list(enumerate(htmls)), "page_id long, html string")
    found = [[] for _ in htmls]
    for row in links.harvest_links(df).orderBy("page_id", "pos").collect():
        found[row["page_id"]].append(row["href"])
    return found


PIECES = [
    '<a href="/x">', "<A HREF='/y'>", "<a href=/z/?q=1>", '<a  id="k>" href = "/w" >', "<a href>", "<a name=n>", '<a href="/1" href="/2">',
    '<a/href="/slash"/>', '<img alt="<a href=/no>">', "<b title='<a href=/no2>'>", "</a>", "<!-- <a href=/c> -->", "<!doctype html>",
    "<script>'<a href=/s>'</script>", "<STYLE a=b>a<a href=/t></style >", "<?php <a href=/p>", "text", " < b ", "a > b", "<br/>", "\n",
    '<a href="/e?a=1&amp;b=&#50;&#x33;&copy;=4&lt;&nosuch;&eacute">', '<a href="&#128;&#0;&#1114112;&#xD800;&#x1F600;">', "<abbr href=/ab>",
    '<a href="new\nline">', "<a x=it's href=/quote>", '<a title="it\'s" href=/q2>', "<a ==x href=/eq>",
]


def test_pages_of_pieces_equal_a_parser(spark):
    rng = random.Random(4)
    htmls = ["".join(rng.choice(PIECES) for _ in range(rng.randint(1, 12))) for _ in range(400)] + PIECES
    for html, found in zip(htmls, harvested(spark, htmls)):
        assert found == parsed(html), html


def test_markup_that_does_not_end(spark):
    open_ones = {
        '<a href="/1"><!-- open <a href="/2"> </a>': ["/1"],
        '<a href="/1"><!--> <a href="/2"> <!---> <a href="/3"><!-- a --!> <a href="/4">': ["/1", "/2", "/3", "/4"],
        '<a href="/1"><script> <a href="/2"> </scrip>': ["/1"],
        '<a href="/1"><a href="/2': ["/1"],
        '<a href="/1"><style>x</styles><a href="/2"></style><a href="/3">': ["/1", "/3"],
        '<a href="/1"></ <a href="/2"> <a href="/3">': ["/1", "/3"],
    }
    assert harvested(spark, list(open_ones)) == list(open_ones.values())


@pytest.mark.parametrize("text", ["&#38;&#x26;&#X26;", "&#38&#x26 &amp&lt", "&notit; &notin; &not", "&unknown; & &; &#; &#x;", "&Aacute;&zwnj;&NotEqualTilde;", "&#0038;&#x0000026;", "é&eacute;漢&#28450;"])
def test_references_equal_the_library(spark, text):
    # Within a longer name, a name without a semicolon is none in an attribute.
    expected = "&notit; \u2209 \u00ac" if "&notit" in text else unescape(text)
    assert harvested(spark, [f'<a href="{text}">']) == [[expected]]


def test_a_name_before_an_equals_sign_is_none(spark):
    assert harvested(spark, ['<a href="?a=1&copy=2&lt;=&para">']) == [["?a=1&copy=2<=\u00b6"]]


def test_a_tag_of_very_many_attributes(spark):
    many = " ".join(f'a{k}="v>{k}"' for k in range(30_000))
    assert harvested(spark, [f'<a {many} href="/far">', "<" * 50_000 + '<a href="/x">', "<a " + '"' * 9999]) == [["/far"], ["/x"], []]
