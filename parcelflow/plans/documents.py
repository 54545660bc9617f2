"""Agent documents. Customers play agents, their orders play listings."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelflow.operators import dedup, documents
from parcelflow.plans.registry import query, table
from parcelflow.sources.writers import document_lines

CUT = "1998-06-01"


def newest_first():
    return [F.desc("o_orderdate"), F.desc("o_orderkey")]


CAPPED_SQL = """
    capped AS (SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
        FROM orders) WHERE rn <= 15)
"""


@query("cap_latest_per_group", f"WITH {CAPPED_SQL} SELECT o_custkey, o_orderkey, o_totalprice FROM capped")
def cap_latest_per_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return documents.cap_latest(orders, "o_custkey", newest_first()).drop("o_orderdate")


@query("retain_latest_3", """
    SELECT o_custkey, o_orderkey FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    WHERE rn <= 3
""")
def retain_latest_3(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return dedup.top_per_group(orders, ["o_custkey"], newest_first(), 3).drop("o_orderdate")


@query("ordinal_labels", """
    SELECT o_custkey, o_orderkey,
           'Address ' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS label FROM orders
""")
def ordinal_labels(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return documents.ordinal_labels(orders, "o_custkey", ["o_orderdate", "o_orderkey"]).drop("o_orderdate")


@query("oldest_per_group", """
    SELECT o_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS oldest FROM orders GROUP BY o_custkey
""")
def oldest_per_group(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(
        F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("oldest")
    )


@query("collect_per_group", """
    WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn
                    FROM orders WHERE o_custkey IS NOT NULL)
    SELECT o_custkey, CAST((rn - 1) // 8 AS BIGINT) AS part,
           string_agg(o_orderkey || ':' || o_orderstatus, '|' ORDER BY rn) AS records
    FROM ranked GROUP BY ALL
""")
def collect_per_group(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    record = F.concat(F.col("o_orderkey").cast("string"), F.lit(":"), "o_orderstatus")
    lists = documents.collect_per_group(orders, "o_custkey", ["o_orderdate", "o_orderkey"], record, part_rows=8)
    return lists.select("o_custkey", "part", F.array_join("records", "|").alias("records"))


# Stored: earlier orders, one per (agent, address), some without a price. Batch: the later orders,
# in which addresses repeat, some without a price or a status.
SIDES_SQL = f"""
    raw AS (SELECT o_custkey AS agent, o_orderpriority || '/' || o_orderstatus AS address, o_orderkey, o_orderdate,
                   CASE WHEN o_totalprice < 150000 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS price,
                   CASE WHEN o_totalprice > 400000 THEN NULL ELSE o_orderkey END AS ref
            FROM orders),
    stored AS (SELECT agent, address, price, ref, o_orderdate AS ts, CAST(-1 AS BIGINT) AS ord FROM (
        SELECT *, row_number() OVER (PARTITION BY agent, address ORDER BY o_orderdate, o_orderkey) AS rn
        FROM raw WHERE o_orderdate < TIMESTAMP '{CUT}') WHERE rn = 1),
    batch AS (SELECT agent, address, price, ref, TIMESTAMP '2002-01-01' AS ts, o_orderkey AS ord
              FROM raw WHERE o_orderdate >= TIMESTAMP '{CUT}'),
    both_sides AS (SELECT * FROM stored UNION ALL SELECT * FROM batch),
    merged AS (
        SELECT agent, address, arg_min(price, ord) FILTER (WHERE price IS NOT NULL) AS price,
               arg_min(ref, ord) FILTER (WHERE ref IS NOT NULL) AS ref,
               coalesce(max(ts) FILTER (WHERE ord < 0), min(ts)) AS ts,
               CASE WHEN min(ord) >= 0 THEN 'inserted'
                    WHEN coalesce(min(ord) FILTER (WHERE price IS NOT NULL), -1) >= 0
                      OR coalesce(min(ord) FILTER (WHERE ref IS NOT NULL), -1) >= 0 THEN 'filled'
                    ELSE 'unchanged' END AS action
        FROM both_sides GROUP BY agent, address)
"""


def sides(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("agent"),
        F.concat("o_orderpriority", F.lit("/"), "o_orderstatus").alias("address"),
        "o_orderkey", "o_orderdate",
        F.when(~(F.col("o_totalprice") < 150000), F.col("o_totalprice").cast("decimal(18,2)")).alias("price"),
        F.when(~(F.col("o_totalprice") > 400000), F.col("o_orderkey")).alias("ref"),
    )
    cut = F.lit(CUT).cast("timestamp_ntz")
    early = raw.filter(F.col("o_orderdate") < cut)
    stored = dedup.first_wins(early, ["agent", "address"], ["o_orderdate", "o_orderkey"])
    return stored.withColumnRenamed("o_orderdate", "ts"), raw.filter(F.col("o_orderdate") >= cut)


def merged(spark, sf_dir):
    stored, batch = sides(spark, sf_dir)
    return documents.fill_null_upsert(
        stored, batch, ["agent", "address"], ["price", "ref"], "ts", "o_orderkey",
        F.lit("2002-01-01").cast("timestamp_ntz"),
    )


@query("upsert_fill_null", f"""
    WITH {SIDES_SQL}
    SELECT agent, address, CAST(price AS DOUBLE) AS price, ref, strftime(ts, '%Y-%m-%d') AS ts, action FROM merged
""")
def upsert_fill_null(spark, sf_dir):
    return merged(spark, sf_dir).select(
        "agent", "address", F.col("price").cast("double").alias("price"), "ref",
        F.date_format("ts", "yyyy-MM-dd").alias("ts"), "action",
    )


@query("merge_summary", f"""
    WITH {SIDES_SQL} SELECT action, count(*) AS rows, count(DISTINCT agent) AS agents FROM merged GROUP BY action
""")
def merge_summary(spark, sf_dir):
    return documents.merge_summary(merged(spark, sf_dir), "agent")


@query("nested_document_json", f"""
    WITH {CAPPED_SQL},
    listed AS (
        SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS i,
               '"Address ' || row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
               || '":{{"address":"' || o_orderkey || '","status":"' || o_orderstatus || '","seen":"'
               || strftime(o_orderdate, '%Y-%m-%d') || '"}}' AS entry
        FROM capped)
    SELECT '{{"' || o_custkey || '":{{' || string_agg(entry, ',' ORDER BY i) || '}}}}' AS value
    FROM listed GROUP BY o_custkey
""")
def nested_document_json(spark, sf_dir):
    """Cap, then nest: no map holds more than the cap."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    capped = documents.cap_latest(orders, "o_custkey", newest_first()).select(
        "o_custkey", "o_orderdate", "o_orderkey", F.col("o_orderkey").cast("string").alias("address"),
        F.col("o_orderstatus").alias("status"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("seen"),
    )
    return document_lines(capped, "o_custkey", ["o_orderdate", "o_orderkey"], ["address", "status", "seen"], capped=True)


@query("agents_by_action", f"""
    WITH {SIDES_SQL} SELECT DISTINCT action, agent FROM merged WHERE action <> 'unchanged'
""")
def agents_by_action(spark, sf_dir):
    return documents.agents_by_action(merged(spark, sf_dir), "agent")
