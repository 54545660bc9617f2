"""Money cleaning, rounding and the offer formulas.

Money is decimal until it leaves the engine: binary rounding differs between engines.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parcelflow.functions.text import as_col, strip

MONEY_TYPE = "decimal(18,2)"

# Fixed values of the offer formulas.
CASH_SHARE = "0.75"
MANAGEMENT_SHARE = "0.10"
CAPEX_SHARE = "0.05"
VACANCY_SHARE = "0.05"
DOWNPAYMENT_SHARE = "0.10"
FIXED_MONTHLY_COST = "350.00"
FINANCED_PART = 5  # the balance falls from 90% to 70% of the price: by a fifth of it


def _number(c: Column | str) -> Column:
    """A money text without signs and blanks around it; null where no number is left."""
    text = strip(F.translate(as_col(c).cast("string"), "$,", ""))
    return F.when(text.rlike("^[0-9.eE+-]+$"), text)


def clean_numeric(c: Column | str) -> Column:
    """A money text as double. Sentinels, unparsable and non-finite values are 0."""
    number = _number(c).try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number).otherwise(F.lit(0.0))


def money(c: Column | str) -> Column:
    return as_col(c).cast(MONEY_TYPE)


def clean_money(c: Column | str) -> Column:
    """``clean_numeric`` in decimal, exact to the cent; an amount beyond the type counts as unparsable."""
    return F.coalesce(_number(c).try_cast(MONEY_TYPE), F.lit(0).cast(MONEY_TYPE))


def share_of(amount: Column, share: str) -> Column:
    """``amount * share`` rounded half up to cents."""
    return F.round(amount * F.lit(share).cast("decimal(4,2)"), 2).cast(MONEY_TYPE)


def round_money(c: Column | str, factor: str | None = None) -> Column:
    amount = money(c)
    return amount if factor is None else share_of(amount, factor)


def term_length(price: Column | str, payment: Column | str) -> Column:
    """Months until the balance falls from 90% to 70% of the price; 0 without a payment.

    In whole cents: a payment that divides the amount exactly takes no month more. All sums of ``MONEY_TYPE`` fit a long.
    """
    p, m = ((money(c) * 100).cast("bigint") for c in (price, payment))
    paid = F.when(m > 0, m * FINANCED_PART)
    months = F.call_function("div", p + paid - 1, paid)
    return F.coalesce(F.greatest(F.lit(0).cast("bigint"), months), F.lit(0).cast("bigint"))
