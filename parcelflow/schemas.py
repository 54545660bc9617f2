"""Declared schemas. Raw layers are strings; clean layers are typed."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# The listing columns in output order.
LISTING_COLUMNS = [
    "address", "city", "state", "zip_code", "price", "rent", "hoa_fee",
    "property_taxes", "insurance", "agent_name", "phone_number", "Motivated",
    "Trigger Keyword", "Trigger Sentence", "Trigger Context", "url",
]

# The columns that enrichment copies from the provider.
PROVIDER_COLUMNS = [
    "Living Square Feet", "Year Built", "Lot (Acres)", "Lot (Square Feet)", "Bedrooms",
    "Bathrooms", "# of Stories", "Owner 1 First Name", "Owner 1 Last Name", "Owner Mailing Address",
    "Owner Mailing City", "Owner Mailing State", "Owner Mailing Zip", "Owner Type", "Owner Occupied",
    "Vacant?", "Last Sale Date", "Last Sale Amount", "Estimated Value", "Estimated Equity",
    "Equity Percent", "Open Mortgage Balance", "Mortgage Interest Rate", "Mortgage Loan Type",
    "Lender Name", "Deed Type", "Tax Amount", "Assessment Year", "Assessed Total Value",
    "Assessed Land Value", "Assessed Improvement Value", "Market Value", "Market Land Value",
    "Market Improvement Value", "Status", "Default Amount", "Opening bid", "Recording Date",
    "Auction Date",
]

METRIC_COLUMNS = [
    "management_fee", "capex_fee", "vacancy_fee", "monthly_creative_payments",
    "downpayment", "cash_offer", "hoa_fee", "term_length_months",
]


def strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


LISTING_RAW = strings(LISTING_COLUMNS)
PROVIDER_RAW = strings(["County", "Address", *PROVIDER_COLUMNS])
WORK_LIST = strings(["Location", "ZipCodes", "Completed"])
POSTAL = strings(["postal_code", "county_name", "state_name", "state_code"])

URL_STATE = T.StructType([
    T.StructField("url", T.StringType()),
    T.StructField("location", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("attempts", T.IntegerType()),
    T.StructField("first_seen", T.DateType()),
    T.StructField("last_seen", T.DateType()),
])

LOG_LINE = T.StructType([
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("level", T.StringType()),
    T.StructField("message", T.StringType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
