"""Phones, placeholders and address validity."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parcelflow.functions.text import as_col, contains_ci, sentinel_to_null

MISSING = "N/A"


def format_phone(c: Column | str) -> Column:
    """Ten digits as ddd-ddd-dddd, more as +cc-ddd-ddd-dddd, anything else as N/A."""
    digits = F.regexp_replace(as_col(c), "[^0-9]", "")
    # Each step leaves what an earlier one has formatted alone.
    long = F.regexp_replace(digits, "^([0-9]+)([0-9]{3})([0-9]{3})([0-9]{4})$", r"+$1-$2-$3-$4")
    ten = F.regexp_replace(long, "^([0-9]{3})([0-9]{3})([0-9]{4})$", "$1-$2-$3")
    return F.coalesce(F.regexp_replace(ten, "^[0-9]*$", MISSING), F.lit(MISSING))


def join_phone_parts(parts: Column | str) -> Column:
    """The same format for a phone that arrives as an array of parts."""
    return format_phone(F.array_join(as_col(parts), "-"))


def has_contact(c: Column | str) -> Column:
    return sentinel_to_null(c).isNotNull()


def placeholder_contact(key: Column | str) -> Column:
    """A mail address at a reserved domain, the same for the same key in every run."""
    return F.concat(F.substring(F.sha2(as_col(key).cast("string"), 256), 1, 32), F.lit("@example.com"))


def contact_or_placeholder(phone: Column | str, key: Column | str) -> Column:
    return F.when(~has_contact(phone), placeholder_contact(key))


def valid_address(c: Column | str, blocked: str = "undisclosed address") -> Column:
    return as_col(c).rlike("[0-9]") & ~contains_ci(c, blocked)
