"""Keyword lexicons: an ordered list of keywords, each with an ordered list of synonyms.

A lexicon is configuration, in code or read with ``scan_lexicon`` and ``lexicon_of``. Its distinct synonyms are looked for in one
pass over the texts (``search``), so no row is multiplied and the cost does not grow with their number.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.functions.search import find_words
from parcelflow.functions.text import as_col, contains_any

Lexicon = dict[str, list[str]]

# Keyword -> synonyms. The order decides which keyword wins.
LISTING_LEXICON: Lexicon = {
    "Motivated": ["Motivated", "Driven", "Eager", "Keen", "Anxious", "Determined"],
    "TLC": ["TLC", "Tender Loving Care", "Care", "Attention"],
    "Fixer Upper": ["Fixer Upper", "Fixer", "Renovation Needed", "Needs Repair"],
    "Seller Finance": ["Seller Finance", "Owner Finance", "Seller Financing", "Owner Financing"],
    "Reduced": ["Reduced", "Price Reduction", "Lowered", "Discounted"],
    "Investment": ["Investment", "Investor", "Opportunity", "Profit", "Return"],
    "Urgent": ["Urgent", "Immediate", "Must Sell", "Hurry"],
    "Must Sell": ["Must Sell", "Need to Sell", "Desperate Sale", "Must Be Sold"],
    "Quick Sale": ["Quick Sale", "Fast Sale", "Immediate Sale", "Rapid Sale"],
    "Immediate": ["Immediate", "Urgent", "Instant", "Prompt"],
    "Discounted": ["Discounted", "Price Cut", "Reduced Price", "Marked Down"],
    "Foreclosure": ["Foreclosure", "Bank Owned", "Repossession", "Foreclosed"],
    "Auction": ["Auction", "Sale", "Public Sale"],
    "Bank Owned": ["Bank Owned", "Foreclosure", "Repossession"],
    "As-Is": ["As-Is", "No Repairs", "Needs Work", "Sold As-Is"],
    "Needs Work": ["Needs Work", "Fixer Upper", "Requires Repair", "Handyman Special"],
    "Price Drop": ["Price Drop", "Reduced Price", "Price Cut", "Lowered Price"],
    "Bargain": ["Bargain", "Deal", "Good Buy", "Discount"],
    "Deal": ["Deal", "Bargain", "Offer", "Agreement"],
    "Distressed": ["Distressed", "Troubled", "Under Duress", "In Need"],
    "Fire Sale": ["Fire Sale", "Urgent Sale", "Quick Sale"],
    "Under Market Value": ["Under Market Value", "Below Market Value", "Undervalued"],
    "Liquidation": ["Liquidation", "Sale", "Clearance"],
    "Short Sale": ["Short Sale", "Quick Sale", "Urgent Sale"],
    "Pre-Foreclosure": ["Pre-Foreclosure", "Foreclosure Imminent", "Pre-Repo"],
    "Rehab": ["Rehab", "Renovation", "Restoration", "Repair"],
    "Handyman Special": ["Handyman Special", "Needs Work", "Fixer Upper"],
    "Investor Special": ["Investor Special", "Investment Opportunity", "Investor Deal"],
    "Must Go": ["Must Go", "Urgent Sale", "Immediate Sale"],
    "Owner Financing": ["Owner Financing", "Seller Financing", "Owner Finance"],
    "No Reserve": ["No Reserve", "Auction", "Unreserved"],
    "Estate Sale": ["Estate Sale", "Inherited", "Family Sale"],
    "Relocation": ["Relocation", "Moving", "Transfer"],
    "Fix and Flip": ["Fix and Flip", "Renovation", "Flip Opportunity"],
    "Move-in Ready": ["Move-in Ready", "Turnkey", "Ready to Move In"],
    "Turnkey": ["Turnkey", "Move-in Ready", "Fully Furnished"],
    "Sweat Equity": ["Sweat Equity", "Value Add", "Investment Potential"],
    "Priced to Sell": ["Priced to Sell", "Reduced Price", "Must Sell Price"],
}

# Phrases that make a keyword hit worthless (an optional filter, off by default).
FALSE_POSITIVE_PHRASES = [
    "ideal", "providing", "enjoying", "outdoors", "perfect", "beautiful",
    "charming", "spacious", "newly renovated", "gorgeous", "lovely",
    "magnificent", "pristine", "immaculate", "stunning", "picturesque",
    "breathtaking", "exquisite", "serene", "peaceful", "tranquil",
    "well-maintained", "move-in ready", "no need for",
]
NEGATING_PHRASES = [
    "not", "no longer", "never", "none", "nothing", "without", "isn't",
    "wasn't", "weren't", "doesn't", "don't", "didn't", "haven't", "hasn't",
    "hadn't", "won't", "wouldn't", "can't", "couldn't", "shouldn't", "mustn't",
]


def lexicon_rows(lexicon: Lexicon) -> list[tuple[int, str, int, str]]:
    """(priority, keyword, synonym position, lower-cased synonym), both counts from 0."""
    return [
        (i, keyword, j, synonym.lower())
        for i, (keyword, synonyms) in enumerate(lexicon.items())
        for j, synonym in enumerate(synonyms)
    ]


#: More synonyms than this are no configuration.
MAX_SYNONYMS = 200_000


def lexicon_of(rows: DataFrame, most: int = MAX_SYNONYMS) -> Lexicon:
    """The lexicon in rows of ``scan_lexicon``, in their order; more than ``most`` rows are an error, and so is none.

    Blank synonyms are left out; a keyword that comes twice goes on where it came first.
    """
    found = rows.select("priority", "keyword", "synonym_pos", "synonym").orderBy("priority", "synonym_pos").limit(most + 1).collect()
    if not 0 < len(found) <= most:
        raise ValueError(f"a lexicon of 1 to {most} synonyms is wanted, not {'more' if found else 'none'}")
    lexicon: Lexicon = {}
    for row in found:
        lexicon.setdefault(row["keyword"], []).extend([row["synonym"]] if (row["synonym"] or "").strip() else [])
    return lexicon


# Priority and position lead, so that sorted entries are in lexicon order.
ENTRY = ("priority", "synonym_pos", "keyword", "synonym")
ENTRIES_SCHEMA = "array<array<struct<priority: int, synonym_pos: int, keyword: string, synonym: string>>>"


def entries_by_synonym(lexicon: Lexicon) -> dict[str, list[tuple[int, int, str, str]]]:
    """The entries of each distinct synonym; synonyms in the order of their first entry."""
    entries: dict[str, list[tuple[int, int, str, str]]] = {}
    for i, keyword, j, synonym in lexicon_rows(lexicon):
        entries.setdefault(synonym, []).append((i, j, keyword, synonym))
    return entries


def _known(lexicon: Lexicon, first_only: bool) -> Column:
    """A constant, which the optimizer parses once: the entries of each synonym by its number."""
    entries = [[dict(zip(ENTRY, e)) for e in (es[:1] if first_only else es)] for es in entries_by_synonym(lexicon).values()]
    return F.from_json(F.lit(json.dumps(entries)), ENTRIES_SCHEMA)


def _found(text: Column, lexicon: Lexicon) -> Column:
    return find_words(F.lower(text), list(entries_by_synonym(lexicon)))


def keyword_hits(text: Column | str, lexicon: Lexicon) -> Column:
    """All lexicon entries found in a text in any case, in lexicon order."""
    known = _known(lexicon, False)
    return F.array_sort(F.flatten(F.transform(_found(as_col(text), lexicon), lambda f: F.get(known, f["id"]))))


def first_keyword(text: Column | str, lexicon: Lexicon) -> Column:
    """Keyword and synonym of the first lexicon entry found in a text in any case; null without a hit.

    Synonyms are numbered by their first entry, so the smallest number found is the first hit.
    """
    entry = F.get(F.get(_known(lexicon, True), F.get(_found(as_col(text), lexicon), F.lit(0))["id"]), F.lit(0))
    return F.when(entry.isNotNull(), F.struct(entry["keyword"].alias("keyword"), entry["synonym"].alias("synonym")))


def motivated_status(text: Column | str, lexicon: Lexicon = LISTING_LEXICON, window: int = 30) -> Column:
    """Struct of motivated, keyword, synonym and the context of the synonym's first occurrence."""
    text = as_col(text)
    first = F.get(_found(text, lexicon), F.lit(0))
    entry = F.get(F.get(_known(lexicon, True), first["id"]), F.lit(0))
    start = F.greatest(F.lit(1), first["at"] - window)
    return F.struct(
        entry.isNotNull().alias("motivated"), entry["keyword"].alias("keyword"), entry["synonym"].alias("synonym"),
        F.substring(F.lower(text), start, first["at"] + F.length(entry["synonym"]) + window - start).alias("context"),
    )


def plain_context(context: Column | str, phrases: list[str] | None = None) -> Column:
    """Whether a context is free of negating and worthless phrases, found as parts of the text.

    An optional filter: by default no hit is dropped for its context.
    """
    return ~contains_any(F.lower(as_col(context)), FALSE_POSITIVE_PHRASES + NEGATING_PHRASES if phrases is None else phrases)
