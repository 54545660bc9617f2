"""Keys, slugs, sentinels and keyword windows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, functions as F

# The characters that count as blank at the ends of a text.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# Texts that stand for a missing value.
SENTINELS = ("", "—", "N/A", "Not found", "not found", "None", "nan")


def as_col(x: Column | str) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def strip(c: Column | str) -> Column:
    """A text without blanks of any kind at its ends."""
    return F.btrim(as_col(c), F.lit(BLANKS))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once per row, however often the body uses it.

    A named column does not do: the optimizer puts its expression back into every branch of a
    condition, and a filter on the result is pushed below it.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def normalize_key(c: Column | str) -> Column:
    """Letters and digits of any script, lower-cased; null stays null."""
    return F.lower(F.regexp_replace(as_col(c), r"[^\p{L}\p{N}]", ""))


def sanitize_identifier(c: Column | str) -> Column:
    """Each run of other characters becomes one underscore."""
    return F.regexp_replace(as_col(c), r"[^\p{L}\p{N}_]+", "_")


def location_slug(c: Column | str) -> Column:
    return F.translate(as_col(c), " ,", "__")


def file_slug(c: Column | str) -> Column:
    """Spaces become underscores; commas, slashes and bars are dropped."""
    return F.translate(as_col(c), " ,/|", "_")


def last_token(c: Column | str) -> Column:
    return F.element_at(F.split(strip(c), " "), -1)


def replace_fragment(url: Column | str, fragment: str) -> Column:
    return F.concat(F.substring_index(as_col(url), "#", 1), F.lit(f"#{fragment}"))


def page_url(base: Column | str, zip_code: Column | str, filters: Column | str, page: Column | str) -> Column:
    return F.concat(as_col(base), strip(zip_code), as_col(filters), F.lit("/page-"), as_col(page).cast("string"))


def composite_key(*cols: Column | str) -> Column:
    """Parts joined by underscores; a null part counts as empty, so positions are kept."""
    return F.concat_ws("_", *[F.coalesce(as_col(c).cast("string"), F.lit("")) for c in cols])


def sentinel_to_null(c: Column | str, sentinels: tuple[str, ...] = SENTINELS) -> Column:
    col = as_col(c)
    return F.when(strip(col).isin(*sentinels), None).otherwise(col)


def contains_ci(c: Column | str, term: str) -> Column:
    """Substring test in any case: 'care' is found in 'Careful'."""
    return F.lower(as_col(c)).contains(term.lower())


def contains_any(c: Column | str, terms: list[str]) -> Column:
    col = as_col(c)
    hit = F.lit(False)
    for term in terms:
        hit = hit | col.contains(term)
    return hit


def keyword_context(c: Column | str, keyword: str, window: int = 30) -> Column:
    """The first hit with up to ``window`` characters on both sides, lower-cased; null without a hit."""
    word = keyword.lower()

    def cut(text: Column) -> Column:
        at = F.locate(word, text)
        start = F.greatest(F.lit(1), at - window)
        return F.when(at > 0, F.substring(text, start, at + len(word) + window - start))

    return let(F.lower(as_col(c)), cut)


def _pieces(text: Column, word: str) -> Column:
    return F.split(text, re.escape(word), -1)


def keyword_count(c: Column | str, keyword: str) -> Column:
    return (F.size(_pieces(F.lower(as_col(c)), keyword.lower())) - 1).cast("bigint")


def keyword_contexts(c: Column | str, keyword: str, window: int = 30) -> Column:
    """One context per hit, in text order.

    The text is cut at the keyword. Each cut is at least one character wide, so the
    ``window`` neighbouring pieces on a side always hold enough text for that side.
    """
    word = keyword.lower()

    def contexts(pieces: Column) -> Column:
        def context(i: Column) -> Column:
            first = F.greatest(F.lit(1), i - window)
            left = F.array_join(F.slice(pieces, first, i - first + 1), word)
            right = F.array_join(F.slice(pieces, i + 1, F.lit(window + 1)), word)
            return F.concat(F.right(left, F.lit(window)), F.lit(word), F.left(right, F.lit(window)))

        hits = F.size(pieces) - 1
        return F.when(hits > 0, F.transform(F.sequence(F.lit(1), hits), context)).otherwise(
            F.array().cast("array<string>")
        )

    return let(_pieces(F.lower(as_col(c)), word), contexts)
