"""Scalar rules on hand-written edge rows, against plain Python where it is short."""

import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import Row, functions as F

from parcelflow.functions import contact, lexicon, locality, logs, markup, money, text


def values(spark, inputs, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r.out for r in df.select("i", expr(F.col("v")).alias("out")).orderBy("i").collect()]


def test_normalize_key(spark):
    got = values(spark, ["12 Main St. #4", "Ávila-Straße 7", "--", "", None], text.normalize_key)
    assert got == ["12mainst4", "ávilastraße7", "", "", None]


def test_slugs(spark):
    assert values(spark, ["a  b--c_d", "ü/1"], text.sanitize_identifier) == ["a_b_c_d", "ü_1"]
    assert values(spark, ["Tampa, FL"], text.location_slug) == ["Tampa__FL"]
    assert values(spark, ["1 A/B, x|y"], text.file_slug) == ["1_AB_xy"]
    assert values(spark, [" call (555) 123 ", "one"], text.last_token) == ["123", "one"]
    assert values(spark, ["u#a#b", "u"], lambda c: text.replace_fragment(c, "z")) == ["u#z", "u#z"]


def test_clean_numeric(spark):
    raw = ["", "—", "not found", "Not Found", "N/A", "$1,250.50", "abc", None, "nan", "inf", " 7 ", "1e400", "-3", "1_000", "5d", "--"]
    assert values(spark, raw, money.clean_numeric) == [0, 0, 0, 0, 0, 1250.5, 0, 0, 0, 0, 7, 0, -3, 0, 0, 0]
    assert values(spark, ["1e30", "$2.345"], lambda c: money.clean_money(c).cast("string")) == ["0.00", "2.35"]
    odd = ["\t$5\r", "\xa0$7", "$9,007,199,254,740,993.01", "N/A\r", "1e3", "5e-3"]
    assert values(spark, odd, lambda c: money.clean_money(c).cast("string")) == ["5.00", "7.00", "9007199254740993.01", "0.00", "1000.00", "0.01"]
    assert values(spark, odd[:2], money.clean_numeric) == [5, 7]


def test_term_length_counts_like_the_loop(spark):
    def loop(price, payment):
        price, payment = Decimal(str(price)), Decimal(str(payment))
        left, target, n = price * Decimal("0.9"), price * Decimal("0.7"), 0
        while left > target and payment > 0:
            left -= payment
            n += 1
        return n

    rng = random.Random(7)
    rows = [(round(rng.uniform(-1e4, 9e5), 2), round(rng.uniform(-50, 4000), 2)) for _ in range(3000)]
    rows += [(0.0, 10.0), (100000.0, 0.0), (100000.0, 20000.0), (100.0, 1e9)]
    rows += [(333000.0, 266.40), (500.0, 100.0), (500.0, 33.33), (1.0, 0.1), (1e9, 0.01 * 2**20)]  # exact divisions among them
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, p double, m double")
    got = [r.t for r in df.select("i", money.term_length("p", "m").alias("t")).orderBy("i").collect()]
    assert got == [loop(*r) for r in rows]


def test_format_phone(spark):
    raw = ["555-1234", "(813) 555-0000", "1 813 555 0000", "44 813 555 0000", "tel", "", None]
    want = ["N/A", "813-555-0000", "+1-813-555-0000", "+44-813-555-0000", "N/A", "N/A", "N/A"]
    assert values(spark, raw, contact.format_phone) == want
    assert values(spark, [["(813)", "555", "0000"]], contact.join_phone_parts, "array<string>") == ["813-555-0000"]


def test_contacts(spark):
    assert values(spark, ["813-555-0000", "N/A", "", None], contact.has_contact) == [True, False, False, False]
    assert values(spark, ["N/A\r", "\xa0", "\u3000—\t"], contact.has_contact) == [False, False, False]
    mails = values(spark, ["a", "b", "a"], contact.placeholder_contact)
    assert mails[0] == mails[2] != mails[1] and mails[0].endswith("@example.com")
    raw = ["1 Main St", "Main St", "Undisclosed Address 5", None]
    assert values(spark, raw, contact.valid_address) == [True, False, False, None]


def test_sentinels(spark):
    raw = ["N/A", " Not found ", "None", "—", "", "x", None]
    assert values(spark, raw, text.sentinel_to_null) == [None, None, None, None, None, "x", None]


def test_split_locality(spark):
    raw = [" Tampa , FL 33601 ", "Tampa", "Tampa, FL", "Tampa, FL 33601, USA"]
    got = values(spark, raw, locality.split_locality)
    nf = locality.NOT_FOUND
    assert got == [Row("Tampa", "FL", "33601"), Row(nf, nf, nf), Row("Tampa", "FL", None), Row("Tampa", "FL", "33601")]
    lines = spark.createDataFrame([(" 1 A ", "T ", "FL", "01234"), (None, "T", None, "1")], "a string, c string, s string, z string")
    assert [r[0] for r in lines.select(locality.contact_line("a", "c", "s", "z")).collect()] == ["1 A, T FL 01234", "T 1"]


def test_context_is_clamped(spark):
    got = values(spark, ["Deal! " + "x" * 40, "y" * 40 + " a DEAL", "none", None], lambda c: text.keyword_context(c, "Deal"))
    assert got == ["deal! " + "x" * 28, "y" * 27 + " a deal", None, None]


@pytest.mark.parametrize("keyword", ["ab", "a.b", "a"])
def test_all_contexts_like_finditer(spark, keyword):
    rng = random.Random(3)
    docs = ["".join(rng.choice("ab. ") for _ in range(rng.randint(0, 150))) for _ in range(200)]

    def want(doc):
        return [doc[max(0, m.start() - 30):m.end() + 30] for m in re.finditer(re.escape(keyword), doc)]

    assert values(spark, docs, lambda c: text.keyword_contexts(c, keyword)) == [want(d) for d in docs]
    assert values(spark, docs, lambda c: text.keyword_count(c, keyword)) == [len(want(d)) for d in docs]


def test_first_keyword_like_the_loop(spark):
    lex = lexicon.LISTING_LEXICON
    rng = random.Random(5)
    words = sorted({s for _, _, _, s in lexicon.lexicon_rows(lex)} | {"nice", "house", "careful", "wholesale"})
    docs = [" ".join(rng.choice(words).title() for _ in range(rng.randint(0, 3))) for _ in range(400)]

    def want(doc):
        for keyword, synonyms in lex.items():
            for s in synonyms:
                if s.lower() in doc.lower():
                    return keyword, s.lower()
        return None

    got = values(spark, docs, lambda c: lexicon.first_keyword(c, lex))
    assert [tuple(g) if g else None for g in got] == [want(d) for d in docs]
    hits = values(spark, docs, lambda c: lexicon.keyword_hits(c, lex))
    assert [[(h.priority, h.synonym) for h in g] for g in hits] == [
        [(i, s) for i, _, _, s in lexicon.lexicon_rows(lex) if s in d.lower()] for d in docs
    ]


def test_lexicon_size():
    assert len(lexicon.LISTING_LEXICON) == 38
    assert len(lexicon.lexicon_rows(lexicon.LISTING_LEXICON)) == 136
    assert (len(lexicon.FALSE_POSITIVE_PHRASES), len(lexicon.NEGATING_PHRASES)) == (24, 21)


def test_amounts(spark):
    raw = ["HOA dues $ 1,250.99", "hoa DUES\n$7", "HOA dues 12", "HOA dues $,", "HOA dues $99999999999", None]
    assert values(spark, raw, lambda c: markup.labelled_amount(c, "HOA dues")) == [1250, 7, None, None, None, None]
    assert values(spark, ["Est. $1,900 per month", "est.1900 PER month", "x"], markup.rent_amount) == [1900, 1900, None]


def test_markup(spark):
    html = '<h1 class="x"> A\nB </h1><a class="k" href="/1">x</a><A href="/2">y</A><a href="">z</a>'
    assert values(spark, [html], lambda c: markup.tag_text(c, "H1")) == ["A\nB"]
    assert values(spark, [html], markup.links) == [["/1", "/2", ""]]
    odd = """<a\n href='/x?a=1&amp;b=2'>q</a><a href=/bare>b</a><abbr href="/no">n</abbr><a data-href="/no" href = " /s ">s</a><A HREF="&#233;&#x;&#8364;">e</A>"""
    assert values(spark, [odd], markup.links) == [["/x?a=1&b=2", "/bare", "/s", "é&#x;€"]]
    text_of = lambda c: markup.tag_text(c, "h1")
    nested = ["<h1><span>12 Main</span> &amp; Co</h1>", "<h1>&nbsp;a &amp;lt; b&#38;#39;\t</h1>", "<h10>no</h10><H1 >yes</H1 >", "<h1><b></b> </h1>"]
    assert values(spark, nested, text_of) == ["12 Main & Co", "a &lt; b&#39;", "yes", None]
    base = "https://h.example/a/b.html?q=1#f"
    links = ["http://o/x", "//o/y", "/z", "c", "?r=2", "#g", "", "mailto:a@b"]
    want = ["http://o/x", "https://o/y", "https://h.example/z", "https://h.example/a/c", "https://h.example/a/b.html?r=2",
            "https://h.example/a/b.html?q=1#g", "https://h.example/a/b.html?q=1", "mailto:a@b"]
    assert values(spark, links, lambda c: markup.absolute_link(c, F.lit(base))) == want
    assert values(spark, ["c", "/d"], lambda c: markup.absolute_link(c, F.lit("http://h"))) == ["http://h/c", "http://h/d"]
    two = lambda c: markup.first_of(markup.tag_text(c, "h2"), markup.tag_text(c, "h1"))
    assert values(spark, [html, "<p>"], two) == ["A\nB", "N/A"]
    assert values(spark, ["https://a.example:80/x?y#z", "no url", None], markup.url_host) == ["a.example", None, None]


def test_log_lines(spark):
    raw = ["2024-08-01 10:00:00 - INFO - a - b", "2024-08-01 - INFO - a", ""]
    got = values(spark, raw, logs.parse_log_line)
    assert (str(got[0].ts), got[0].level, got[0].message) == ("2024-08-01 10:00:00", "INFO", "a - b")
    assert got[1:] == [None, None]
    assert values(spark, ["INFO", "ERROR", "odd"], lambda c: logs.level_below(c, "ERROR")) == [True, False, None]
    assert values(spark, ["Remote response: x", "fine"], logs.is_noise) == [True, False]


def test_motivated_status_like_the_loop(spark):
    lex = {"Deal": ["Bargain", "Deal"], "Free": ["free", "deal of the day"]}
    rng = random.Random(9)
    words = ["bargain", "DEAL", "free", "House", "of the day", "ideal", "x" * 33]
    docs = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 6))) for _ in range(300)] + [None]

    def want(doc):
        low = (doc or "").lower()
        for keyword, synonyms in lex.items():
            for s in synonyms:
                at = low.find(s.lower())
                if at >= 0:
                    return True, keyword, s.lower(), low[max(0, at - 30):at + len(s) + 30]
        return False, None, None, None

    got = values(spark, docs, lambda c: lexicon.motivated_status(c, lex))
    assert [tuple(g) for g in got] == [want(d) for d in docs]


def test_plain_context(spark):
    raw = ["a great deal", "an ideal home", "No longer a deal", None]
    assert values(spark, raw, lexicon.plain_context) == [True, False, False, None]
