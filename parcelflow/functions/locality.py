"""City, state and ZIP; address lines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parcelflow.functions.text import as_col, strip

NOT_FOUND = "Not found"


def split_locality(c: Column | str) -> Column:
    """'City, ST 12345' as a struct. Without a comma all parts are 'Not found'."""
    parts = F.split(strip(c), ",")
    tail = F.split(strip(F.get(parts, F.lit(1))), " ")
    found = F.size(parts) > 1

    def part(value: Column) -> Column:
        return F.when(found, value).otherwise(F.lit(NOT_FOUND))

    return F.struct(
        part(strip(F.get(parts, F.lit(0)))).alias("city"),
        part(F.get(tail, F.lit(0))).alias("state"),
        part(F.get(tail, F.lit(1))).alias("zip_code"),
    )


def address_line(street: Column | str, locality: Column | str) -> Column:
    """'street, locality'; null when either is missing."""
    return F.concat(strip(street), F.lit(", "), strip(locality))


def contact_line(address: Column | str, city: Column | str, state: Column | str, zip_code: Column | str) -> Column:
    """'address, city state zip', every part trimmed, missing parts left out."""
    place = F.concat_ws(" ", strip(city), strip(state), strip(as_col(zip_code).cast("string")))
    return F.concat_ws(", ", strip(address), place)
