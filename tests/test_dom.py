"""The markup lexer and selection, against a walk over Python's own parser where that reads markup alike."""

import random
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from parcelflow.functions import dom, markup


def values(spark, pages, build):
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string").select("i", dom.tokens("html").alias("t"))
    return [r.v for r in df.select("i", build("t").alias("v")).orderBy("i").collect()]


def test_comments_scripts_nesting_and_quotes(spark):
    pages = [
        "<!-- <h1>old</h1> --><h1>new</h1>", "<script>'<h1>no</h1>'</script><h1>yes</h1>", "<style>h1{}</style><!DOCTYPE x><h1 a='>'>a<b>c</b></h1 >",
        "<h1>open", "</h1><h1>x</h1>", "<h1></h1>", "", None, "a < b <h1>1 &lt; 2 &#8364;</h1>", "<H1 CLASS=x>up</H1>", "<h10>no</h10>",
    ]
    assert values(spark, pages, lambda t: dom.select_text(t, "h1")) == [
        "new", "yes", "ac", "open", "x", None, None, None, "1 < 2 €", "up", None
    ]
    assert values(spark, ["<div>a<div>b</div>c</div>d"], lambda t: dom.select_texts(t, "div")) == [["abc", "b"]]
    assert values(spark, ["</div></div><div>a</div><div>b<div>c</div>"], lambda t: dom.select_texts(t, "div")) == [["a", "bc", "c"]]
    assert values(spark, ["<p>a<p>b</p><p>c"], lambda t: dom.select_texts(t, "p")) == [["a", "b", "c"]]
    assert values(spark, ["<title>a <b> &amp; c</title><img src=x><br>"], lambda t: dom.select_text(t, "title")) == ["a <b> & c"]


def test_selectors(spark):
    page = (
        "<div class='row wide' data-id=1>x</div><div class=\"rows\">y</div><div class='row' title=\"class='wide'\">z</div>"
        "<div class='statsValue'>$5</div><span data-rf-test-id=\"abp-streetLine\">1 Main</span><input disabled value=a/b>"
    )
    pick = lambda s: values(spark, [page], lambda t: dom.select_texts(t, s))[0]
    assert pick("div.row") == ["x", "z"] and pick("div.row.wide") == ["x"] and pick("div[title]") == ["z"]
    assert pick('div[data-id="1"]') == ["x"] and pick("div.statsValue") == ["$5"] and pick("div[data-id=2]") == []
    assert pick('span[data-rf-test-id="abp-streetLine"]') == ["1 Main"]
    opening = lambda t: dom.select(t, "input")[0]["opening"]
    for name, want in (("disabled", ""), ("value", "a/b"), ("checked", None)):
        assert values(spark, [page], lambda t: dom.attribute(opening(t), name)) == [want]
    for bad in ("", "div p", "div[", ".x", "div > a"):
        with pytest.raises(ValueError):
            dom.parse(bad)


def test_links(spark):
    pages = ["<!-- <a href='/old'>x</a> --><a data-x='1>0' href='/n'>go</a>", "<a title=\" href='/bad'\" href=/good>", "<abbr href='/no'>", "<a\nHREF = \"/x?a=1&amp;b\">", "<a name=x>"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, h string")
    got = [r.v for r in df.select("i", markup.links("h").alias("v")).orderBy("i").collect()]
    assert got == [["/n"], ["/good"], [], ["/x?a=1&b"], []]


def test_value_beside_a_label(spark):
    row = "<div class='Row'><span class='Row--header'>{}</span><div><span class='Row--content'> {} </span></div></div>"
    page = row.format("Taxes", "$1") + row.format("HOA dues", "$2") + row.format("HOA dues", "$3")
    beside = lambda label: values(spark, [page], lambda t: dom.value_beside(t, "div.Row", "span.Row--header", "span.Row--content", label))[0]
    assert beside("HOA") == "$2" and beside("Taxes") == "$1" and beside("Rent") is None


class Walk(HTMLParser):
    """Texts of all elements of one name, by a stack of that name."""

    def __init__(self, tag):
        super().__init__(convert_charrefs=True)
        self.tag, self.stack, self.out = tag, [], []

    def handle_starttag(self, tag, attrs):
        if tag == self.tag:
            self.out.append("")
            self.stack.append(len(self.out) - 1)

    def handle_endtag(self, tag):
        if tag == self.tag and self.stack:
            self.stack.pop()

    def handle_data(self, data):
        for i in self.stack:
            self.out[i] += data


def test_random_nesting(spark):
    """Elements in each other, stray and missing closing tags, comments, more tags than one chunk holds."""
    rng = random.Random(4)
    pages = []
    for size in [5, 20, 60, 200, 700]:
        parts = [rng.choice(["<div>", "<div class='a'>", "</div>", "</div>", "x", "y ", "<b>", "</b>", "<!-- <div> -->", "<ul><li>"]) for _ in range(size)]
        pages.append("".join(parts))
    want = []
    for page in pages:
        walk = Walk("div")
        walk.feed(page)
        want.append([t.strip() or None for t in walk.out])
    assert values(spark, pages, lambda t: dom.select_texts(t, "div")) == want


def test_tokens_are_the_page(spark):
    pages = ["a<b c='>'>d</b><!-- e", "< <<a <b", "<a href='x>no end", "<script>x", "<textarea><p></textarea>é"]
    assert ["".join(t) for t in values(spark, pages, F.col)] == pages


def test_a_page_of_a_megabyte(spark):
    pages = ["<div>" * 3000 + "x" + "</div>" * 3000 + "<p>" + "y" * 1_000_000 + "</p><a " + "z='1' " * 50_000 + ">"]
    assert values(spark, pages, lambda t: dom.select_text(t, "div")) == ["x"]
    assert values(spark, pages, lambda t: dom.select_text(t, "p")) == ["y" * 1_000_000]


def test_kept_spans_select_alike(spark):
    """Selectors over spans that are kept give what they give alone, also where tags are more than are folded at a time."""
    pages = ["<div class=a>1<div class='b a'>2</div></div></div><DIV class=b>3", "<div class=a>" * 300 + "x" + "</div>" * 300, "<p>", "", None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string").select("i", dom.tokens("html").alias("t"))
    kept = df.select("i", "t", dom.spans("t", "div").alias("at"))
    got = kept.select(dom.select_texts("t", "div.a", "at").alias("a"), dom.select_texts("t", "div.b", "at").alias("b")).orderBy("i").collect()
    assert [r.a and (r.a[0], len(r.a)) for r in got] == [("12", 2), ("x", 300), [], [], None]
    assert [r.b for r in got] == [["2", "3"], [], [], [], None]
