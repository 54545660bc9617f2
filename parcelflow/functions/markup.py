"""Field extraction from page markup and recognised text."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from parcelflow.functions import dom
from parcelflow.functions.text import as_col

# The labels of the monthly cost table, and the words around the rent.
COST_COLUMNS = {
    "Principal and interest": "principal_and_interest", "Property taxes": "property_taxes", "HOA dues": "hoa_fee",
    "Homeowners insurance": "insurance",
}
COST_LABELS = list(COST_COLUMNS)
RENT_BEFORE, RENT_AFTER = "Est.", "per month"
def first_match(c: Column | str, pattern: str, group: int = 1) -> Column:
    """Like ``regexp_extract``, but null without a match."""
    return F.nullif(F.regexp_extract(as_col(c), pattern, group), F.lit(""))


def _amount(c: Column | str, pattern: str) -> Column:
    digits = F.replace(F.regexp_extract(as_col(c), pattern, 1), F.lit(","), F.lit(""))
    # A failed cast is costly, so an empty text becomes null before it.
    return F.nullif(digits, F.lit("")).try_cast("int")


def labelled_amount(c: Column | str, label: str) -> Column:
    """Whole dollars behind ``label`` and a dollar sign; null without a match."""
    return _amount(c, rf"(?i){re.escape(label)}\s*[$]\s*([0-9,]+)")


def rent_amount(c: Column | str) -> Column:
    """Whole dollars between the words of the rent line; the dollar sign may be missing."""
    return _amount(c, rf"(?i){re.escape(RENT_BEFORE)}\s*[$]?([0-9,]+)\s*{re.escape(RENT_AFTER)}")


def links(html: Column | str) -> Column:
    """All href values of ``a`` elements in page order, decoded; comments and scripts hold none."""
    anchors = F.filter(dom.tokens(html), lambda t: t.rlike(r"(?i)^<a[\s/]"))
    return F.array_compact(F.transform(anchors, lambda t: dom.attribute(t, "href")))


def absolute_link(link: Column | str, page_url: Column | str) -> Column:
    """A link as a browser resolves it against the URL of its page; dot segments are kept."""
    href, base = as_col(link), F.regexp_replace(as_col(page_url), r"[?#].*$", "")
    origin = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/]*", 0)
    scheme = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.\-]*:", 0)
    folder = F.when(base == origin, F.concat(origin, F.lit("/"))).otherwise(F.regexp_replace(base, r"[^/]*$", ""))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, href))
        .when(href.startswith("?"), F.concat(base, href))
        .when((href == "") | href.startswith("#"), F.concat(F.regexp_replace(as_col(page_url), "#.*$", ""), href))
        .otherwise(F.concat(folder, href))
    )


def tag_text(html: Column | str, tag: str) -> Column:
    """Text of the first ``tag`` element: inner tags removed, references decoded, trimmed; null when absent or empty."""
    return dom.select_text(dom.tokens(html), tag.lower())


def first_of(*strategies: Column, default: str = "N/A") -> Column:
    """The first strategy that found something."""
    return F.coalesce(*strategies, F.lit(default))


def url_host(url: Column | str) -> Column:
    return F.try_parse_url(as_col(url), F.lit("HOST"))
