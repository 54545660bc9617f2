"""Provider and postal enrichment. Parts play listings and, in another spelling, provider rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelflow.functions.text import normalize_key
from parcelflow.operators import dedup, enrich, rollup
from parcelflow.plans.registry import query, table

PROVIDER_FIELDS = ["p_type", "p_size", "p_retailprice"]

INDEX_SQL = r"""
    prov AS (
        SELECT county, addr_key, p_partkey AS prov_key, p_type, p_size, p_retailprice FROM (
            SELECT trim(' ' || p_brand || ' ') AS county,
                   lower(regexp_replace(p_name, '[^\p{L}\p{N}]', '', 'g')) AS addr_key, *,
                   row_number() OVER (PARTITION BY p_brand, lower(regexp_replace(p_name, '[^\p{L}\p{N}]', '', 'g'))
                                      ORDER BY p_partkey DESC) AS rn
            FROM part WHERE p_size > 25) WHERE rn = 1)
"""
LISTING_SQL = r"""
    listing AS (SELECT p_partkey, p_brand AS county, lower(regexp_replace(upper(replace(p_name, ' ', '-')) || '.',
                       '[^\p{L}\p{N}]', '', 'g')) AS addr_key FROM part)
"""


def index(spark, sf_dir):
    provider = table(spark, sf_dir, "part").filter(F.col("p_size") > 25).withColumn(
        "County", F.concat(F.lit(" "), "p_brand", F.lit(" "))
    ).withColumn("prov_key", F.col("p_partkey"))
    kept = ["County", "p_name", "p_partkey", "prov_key", *PROVIDER_FIELDS]
    return enrich.provider_index(provider.select(*kept), "County", "p_name", ["p_partkey"])


def listings(spark, sf_dir):
    address = F.concat(F.upper(F.replace(F.col("p_name"), F.lit(" "), F.lit("-"))), F.lit("."))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_brand").alias("county"), normalize_key(address).alias("addr_key")
    )


def enriched(spark, sf_dir):
    return enrich.enrich(listings(spark, sf_dir), index(spark, sf_dir), ["prov_key", *PROVIDER_FIELDS])


@query("dedup_last_wins", f"WITH {INDEX_SQL} SELECT county, addr_key, prov_key, p_type, p_size, p_retailprice FROM prov")
def dedup_last_wins(spark, sf_dir):
    return index(spark, sf_dir).select("county", "addr_key", "prov_key", *PROVIDER_FIELDS)


@query("enrich_left_join", f"""
    WITH {INDEX_SQL}, {LISTING_SQL}
    SELECT l.p_partkey, l.county, l.addr_key, prov_key, p_type, p_size, p_retailprice, prov_key IS NOT NULL AS matched
    FROM listing l LEFT JOIN prov p ON l.county = p.county AND l.addr_key = p.addr_key
""")
def enrich_left_join(spark, sf_dir):
    return enriched(spark, sf_dir)


@query("enrich_match_rate", f"""
    WITH {INDEX_SQL}, {LISTING_SQL}
    SELECT l.county, count(*) AS listings, count(prov_key) AS matched, count(*) - count(prov_key) AS unmatched
    FROM listing l LEFT JOIN prov p ON l.county = p.county AND l.addr_key = p.addr_key GROUP BY l.county
""")
def enrich_match_rate(spark, sf_dir):
    return enrich.match_rate(enriched(spark, sf_dir))


@query("broadcast_lookup", """
    SELECT c_custkey, coalesce(n_name, 'Unknown') AS county
    FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey
""")
def broadcast_lookup(spark, sf_dir):
    """Postal lookup; Spark broadcasts the reference when its size allows."""
    customer = table(spark, sf_dir, "customer")
    postal = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") != 2)
    out = enrich.zip_to_county(customer, postal, ("c_nationkey", "n_nationkey"), "n_name")
    return out.select("c_custkey", "county")


@query("count_by_geo", """
    SELECT coalesce(n_name || ', ' || r_name, 'unidentified') AS geo, count(*) AS n
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 3) ON n_regionkey = r_regionkey GROUP BY 1
""")
def count_by_geo(spark, sf_dir):
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region").filter(F.col("r_regionkey") != 3)
    postal = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    placed = customer.join(postal, customer.c_nationkey == postal.n_nationkey, "left")
    return rollup.count_by_geo(placed, "n_name", "r_name")


@query("dedup_by_key", """
    SELECT user_id, event_type, event_id, value FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1
""")
def dedup_by_key(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return dedup.first_wins(events, ["user_id", "event_type"], ["event_id"])
