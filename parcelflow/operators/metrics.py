"""Offer metrics as columns of a listing table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from parcelflow.functions.money import (
    CAPEX_SHARE, CASH_SHARE, DOWNPAYMENT_SHARE, FIXED_MONTHLY_COST, MANAGEMENT_SHARE, MONEY_TYPE, VACANCY_SHARE,
    share_of, term_length,
)


def add_offer_metrics(
    df: DataFrame, price: str = "price", rent: str = "rent", insurance: str = "insurance",
    taxes: str = "property_taxes", hoa: str = "hoa_fee",
) -> DataFrame:
    """``df`` plus the eight derived columns, from decimal inputs.

    Without a rent only the cash offer is not 0. The HOA fee is passed on but not subtracted.
    Fees, payment and term follow in three steps, so no expression is evaluated twice.
    """
    zero = F.lit(0).cast(MONEY_TYPE)
    rented = F.col(rent) > 0

    def if_rented(value: Column) -> Column:
        return F.when(rented, value).otherwise(zero)

    fees = df.withColumns({
        "management_fee": if_rented(share_of(F.col(rent), MANAGEMENT_SHARE)),
        "capex_fee": if_rented(share_of(F.col(rent), CAPEX_SHARE)),
        "vacancy_fee": if_rented(share_of(F.col(rent), VACANCY_SHARE)),
        "downpayment": if_rented(share_of(F.col(price), DOWNPAYMENT_SHARE)),
        "cash_offer": share_of(F.col(price), CASH_SHARE),
        "hoa_fee": F.col(hoa),
    })
    costs = F.lit(FIXED_MONTHLY_COST).cast(MONEY_TYPE) + F.col(insurance) + F.col(taxes)
    for fee in ("management_fee", "capex_fee", "vacancy_fee"):
        costs = costs + F.col(fee)
    paid = fees.withColumn("monthly_creative_payments", if_rented((F.col(rent) - costs).cast(MONEY_TYPE)))
    return paid.withColumn("term_length_months", term_length(price, "monthly_creative_payments"))
