"""The whole cycle: dedup, enrich, metrics, cap, label; and from raw files to merged documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from parcelflow.functions import contact, money
from parcelflow.functions.text import normalize_key, sentinel_to_null, strip
from parcelflow.operators import dedup, documents, enrich
from parcelflow.operators.metrics import add_offer_metrics
from parcelflow.plans.enrichment import INDEX_SQL, PROVIDER_FIELDS, index
from parcelflow.plans.registry import query, table
from parcelflow.session import workdir
from parcelflow.sources import writers


def run_cycle(listings: DataFrame, provider: DataFrame, provider_columns: list[str]) -> DataFrame:
    """Listings with (agent, county, address, price, rent, insurance, property_taxes, hoa_fee,
    seen_at, seq).

    Keeps the newest row per (agent, county, address key), caps each agent, and only then
    joins the provider and computes metrics: both work row by row, so the cap may come first
    and leaves them far fewer rows.
    """
    keyed = listings.withColumn("addr_key", normalize_key("address"))
    newest = dedup.last_wins(keyed.filter("agent IS NOT NULL"), ["agent", "county", "addr_key"], ["seen_at", "seq"])
    ranked = [F.desc("seen_at"), F.desc("seq"), F.col("county"), F.col("addr_key")]
    capped = documents.cap_latest(newest, "agent", ranked)
    arrival = [F.asc("seen_at"), F.asc("seq"), F.desc("county"), F.desc("addr_key")]
    labelled = documents.label_capped(capped, "agent", arrival)
    joined = enrich.enrich(labelled, provider, provider_columns)
    return add_offer_metrics(joined)


CYCLE_SQL = f"""
    WITH {INDEX_SQL},
    raw AS (
        SELECT l_suppkey AS agent, p_brand AS county, lower(regexp_replace(p_name, '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS addr_key,
               CAST(l_extendedprice AS DECIMAL(18,2)) AS price, l_shipdate AS seen_at,
               l_orderkey * 1000 + l_linenumber AS seq, CAST(l_quantity AS DECIMAL(18,2)) AS insurance
        FROM lineitem JOIN part ON l_partkey = p_partkey),
    newest AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY agent, county, addr_key
                                     ORDER BY seen_at DESC, seq DESC, price DESC, insurance DESC) AS rn FROM raw) WHERE rn = 1),
    capped AS (SELECT * FROM (
        SELECT * EXCLUDE (rn), row_number() OVER (PARTITION BY agent ORDER BY seen_at DESC, seq DESC, county, addr_key) AS pos
        FROM newest) WHERE pos <= 15),
    rented AS (
        SELECT c.*, prov_key, p_type, p_size, p_retailprice,
               CAST(round(price * CAST(0.08 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS rent,
               row_number() OVER (PARTITION BY agent ORDER BY pos DESC) AS n
        FROM capped c LEFT JOIN prov p ON c.county = p.county AND c.addr_key = p.addr_key),
    fees AS (
        SELECT *, CAST(round(rent * CAST(0.10 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS management_fee,
               CAST(round(rent * CAST(0.05 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS small_fee FROM rented),
    paid AS (SELECT *, CASE WHEN rent > 0 THEN CAST(rent - (350 + insurance + management_fee + small_fee + small_fee)
                    AS DECIMAL(18,2)) ELSE 0 END AS payment FROM fees)
    SELECT agent, 'Address ' || n AS label, county, addr_key, CAST(price AS DOUBLE) AS price,
           strftime(seen_at, '%Y-%m-%d') AS seen_on, prov_key IS NOT NULL AS matched, prov_key, p_type, p_size,
           CAST(round(price * CAST(0.75 AS DECIMAL(4,2)), 2) AS DOUBLE) AS cash_offer,
           CAST(payment AS DOUBLE) AS monthly_creative_payments,
           CASE WHEN payment > 0 THEN greatest(0, CAST((CAST(price * 100 AS HUGEINT) * 20
                + CAST(payment * 100 AS HUGEINT) * 100 - 1) // (CAST(payment * 100 AS HUGEINT) * 100) AS BIGINT)) ELSE 0 END
                AS term_length_months
    FROM paid
"""


def cycle_listings(spark, sf_dir) -> DataFrame:
    """Line items as listings: the supplier is the agent, the part gives county and address."""
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    price, zero = money.money("l_extendedprice"), F.lit(0).cast(money.MONEY_TYPE)
    return line.join(part, line.l_partkey == part.p_partkey).select(
        F.col("l_suppkey").alias("agent"), F.col("p_brand").alias("county"),
        F.concat(F.upper("p_name"), F.lit(".")).alias("address"),
        F.col("l_shipdate").alias("seen_at"),
        F.struct(
            (F.col("l_orderkey") * 1000 + F.col("l_linenumber")).alias("seq"), price.alias("p"),
            money.money("l_quantity").alias("q"),
        ).alias("seq"),
        price.alias("price"), money.share_of(price, "0.08").alias("rent"),
        money.money("l_quantity").alias("insurance"), zero.alias("property_taxes"), zero.alias("hoa_fee"),
    )


@query("listing_cycle", CYCLE_SQL)
def listing_cycle(spark, sf_dir):
    out = run_cycle(cycle_listings(spark, sf_dir), index(spark, sf_dir), ["prov_key", *PROVIDER_FIELDS])
    return out.select(
        "agent", "label", "county", "addr_key", F.col("price").cast("double").alias("price"),
        F.date_format("seen_at", "yyyy-MM-dd").alias("seen_on"), "matched", "prov_key", "p_type", "p_size",
        F.col("cash_offer").cast("double").alias("cash_offer"),
        F.col("monthly_creative_payments").cast("double").alias("monthly_creative_payments"), "term_length_months",
    )


DOCUMENT_COLUMNS = ["price", "rent", "insurance", "property_taxes", "hoa_fee", "phone_number", "Email_sent"]
RAW_LISTING = T.StructType([
    T.StructField("seq", T.LongType()), *[T.StructField(c, T.StringType()) for c in ("agent", "address", *DOCUMENT_COLUMNS)],
])


def merge_listing_files(spark: SparkSession, path: str, base: str, as_of: Column) -> str:
    """One cycle: raw CSV in, texts cleaned, merged into the stored documents, published as their next version."""
    raw = spark.read.schema(RAW_LISTING).options(header=True, escape='"').csv(path)
    clean = raw.select("seq", *[sentinel_to_null(strip(c)).alias(c) for c in ("agent", "address", *DOCUMENT_COLUMNS)])
    try:
        stored = writers.current(spark, base)
    except FileNotFoundError:
        stored = clean.limit(0).drop("seq").withColumn("timestamp", as_of)
    merged = documents.fill_null_upsert(stored, clean, ["agent", "address"], DOCUMENT_COLUMNS, "timestamp", "seq", as_of)
    return writers.publish(merged.drop("action"), base)


def offer_documents(stored: DataFrame) -> DataFrame:
    """Stored documents with amounts, offer metrics, a placeholder contact where the phone is missing, the newest 15 per agent labelled."""
    amounts = ["price", "rent", "insurance", "property_taxes", "hoa_fee"]
    priced = add_offer_metrics(stored.withColumns({c: money.clean_money(c) for c in amounts}))
    key = F.concat_ws("|", "agent", "address")
    reached = priced.withColumn("email", contact.contact_or_placeholder("phone_number", key))
    capped = documents.cap_latest(reached, "agent", [F.desc("timestamp"), F.desc("address")])
    return documents.label_capped(capped, "agent", [F.asc("timestamp"), F.asc("address")])


@query("document_merge_cycle", """
    WITH raw AS (
        SELECT CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN 1 ELSE 2 END AS run, o_orderkey AS seq, 'Agent ' || o_custkey AS agent,
               o_orderpriority || '/' || year(o_orderdate) AS address,
               CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_totalprice AS DECIMAL(18,2)) END AS price,
               CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderkey % 3000 + 600 AS DECIMAL(18,2)) END AS rent,
               CASE WHEN o_orderkey % 3 > 0 THEN '813-555-' || lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') END AS phone_number,
               CASE WHEN o_orderkey % 11 = 0 THEN 'yes' END AS sent
        FROM orders),
    merged AS (
        SELECT agent, address, arg_min(price, (run, seq)) FILTER (WHERE price IS NOT NULL) AS p, arg_min(rent, (run, seq)) FILTER (WHERE rent IS NOT NULL) AS r,
               arg_min(phone_number, (run, seq)) FILTER (WHERE phone_number IS NOT NULL) AS phone_number,
               arg_min(sent, (run, seq)) FILTER (WHERE sent IS NOT NULL) AS sent, min(run) AS run
        FROM raw GROUP BY agent, address),
    amounts AS (SELECT *, coalesce(p, 0) AS price, coalesce(r, 0) AS rent FROM merged),
    fees AS (SELECT *, CAST(round(rent * CAST(0.10 AS DECIMAL(4,2)), 2) + 2 * round(rent * CAST(0.05 AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS fee FROM amounts),
    capped AS (SELECT *, row_number() OVER (PARTITION BY agent ORDER BY run DESC, address DESC) AS pos FROM fees)
    SELECT agent, 'Address ' || row_number() OVER (PARTITION BY agent ORDER BY run, address) AS label, address, CAST(price AS DOUBLE) AS price,
           CAST(round(price * CAST(0.75 AS DECIMAL(4,2)), 2) AS DOUBLE) AS cash_offer,
           CASE WHEN rent > 0 THEN CAST(rent - 350 - fee AS DOUBLE) ELSE 0 END AS monthly_creative_payments, phone_number,
           CASE WHEN phone_number IS NULL THEN substr(sha256(agent || '|' || address), 1, 32) || '@example.com' END AS email,
           sent AS "Email_sent", CASE WHEN run = 1 THEN '2001-01-01' ELSE '2002-01-01' END AS stamped
    FROM capped WHERE pos <= 15
""")
def document_merge_cycle(spark, sf_dir):
    """Two cycles from raw CSV to labelled documents: the second fills what the first left open and adds new listings."""
    base, orders = workdir(spark, "document_merge"), table(spark, sf_dir, "orders")
    cut, key = F.lit("1996-01-01").cast("timestamp_ntz"), F.col("o_orderkey")
    exact = F.regexp_replace(money.money("o_totalprice").cast("string"), r"([0-9]{3})\.", ",$1.")
    text = {
        "agent": F.concat(F.lit("\tAgent "), F.col("o_custkey").cast("string"), F.lit("\xa0")),
        "address": F.concat("o_orderpriority", F.lit("/"), F.year("o_orderdate").cast("string"), F.lit(" ")),
        "price": F.when(key % 7 > 0, F.concat(F.lit(" $"), exact)).otherwise("Not found"),
        "rent": F.when(key % 5 > 0, F.concat(F.lit("$"), (key % 3000 + 600).cast("string"))).otherwise("N/A"),
        "insurance": F.lit("—"), "property_taxes": F.lit("nan"), "hoa_fee": F.lit(""),
        "phone_number": F.when(key % 3 > 0, F.concat(F.lit("813-555-"), F.lpad((key % 10000).cast("string"), 4, "0"))).otherwise("\tN/A"),
        "Email_sent": F.when(key % 11 == 0, "yes"),
    }
    rows = orders.select("o_orderdate", key.alias("seq"), *[v.alias(c) for c, v in text.items()])
    for run, part in enumerate((rows.filter(F.col("o_orderdate") < cut), rows.filter(F.col("o_orderdate") >= cut)), 1):
        writers.write_csv(part.drop("o_orderdate"), f"{base}/in{run}")
        merge_listing_files(spark, f"{base}/in{run}", f"{base}/documents", F.lit(f"200{run}-01-01").cast("timestamp_ntz"))
    out = offer_documents(writers.current(spark, f"{base}/documents"))
    return out.select(
        "agent", "label", "address", *[F.col(c).cast("double").alias(c) for c in ("price", "cash_offer", "monthly_creative_payments")],
        "phone_number", "email", "Email_sent", F.date_format("timestamp", "yyyy-MM-dd").alias("stamped"),
    )
