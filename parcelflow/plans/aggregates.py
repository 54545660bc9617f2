"""Roll-ups and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelflow.operators import rollup
from parcelflow.plans.registry import query, table
from parcelflow.plans.scalars import PHONE_SQL, phone_in_text


def _wide_sql(width: int) -> str:
    return ", ".join(f"max(line) FILTER (WHERE (rn - 1) % {width} = {i}) AS address_{i + 1}" for i in range(width))


@query("contact_rollup_wide", f"""
    WITH ranked AS (
        SELECT n_name AS agent, s_nationkey AS phone, s_name || ', ' || n_name || ' ' || n_regionkey AS line,
               row_number() OVER (PARTITION BY n_name, s_nationkey ORDER BY s_suppkey) AS rn
        FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT agent, phone, CAST((rn - 1) // 3 AS BIGINT) AS part, count(*) AS addresses, {_wide_sql(3)},
           CAST(sum(count(*)) OVER (PARTITION BY agent, phone) AS BIGINT) AS total_addresses
    FROM ranked GROUP BY agent, phone, (rn - 1) // 3
""")
def contact_rollup_wide(spark, sf_dir):
    """Addresses of a contact side by side, three to a row; longer contacts go on in the next part."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    rows = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        F.col("n_name").alias("agent"), F.col("s_nationkey").alias("phone"), "s_suppkey", "s_name", "n_regionkey"
    )
    line = F.concat("s_name", F.lit(", "), "agent", F.lit(" "), F.col("n_regionkey").cast("string"))
    return rollup.contact_rollup(rows, ["agent", "phone"], line, ["s_suppkey"], width=3)


@query("contact_rollup_lines", f"""
    WITH ranked AS (
        SELECT l_orderkey, l_linenumber || '/' || l_partkey || '/' || l_suppkey AS line,
               row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
        FROM lineitem)
    SELECT l_orderkey, CAST((rn - 1) // 8 AS BIGINT) AS part, count(*) AS addresses, {_wide_sql(8)},
           CAST(sum(count(*)) OVER (PARTITION BY l_orderkey) AS BIGINT) AS total_addresses
    FROM ranked GROUP BY l_orderkey, (rn - 1) // 8
""")
def contact_rollup_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    line = F.concat_ws("/", *[F.col(c).cast("string") for c in ("l_linenumber", "l_partkey", "l_suppkey")])
    return rollup.contact_rollup(lines, ["l_orderkey"], line, ["l_linenumber", "l_partkey", "l_suppkey"], width=8)


@query("total_and_distinct", rf"""
    SELECT 'phones' AS counted, count(phone) AS total, count(DISTINCT phone) AS distinct_values
    FROM (SELECT {PHONE_SQL} AS phone FROM documents)
    UNION ALL SELECT 'users', count(user_id), count(DISTINCT user_id) FROM events
""")
def total_and_distinct(spark, sf_dir):
    phones = rollup.total_and_distinct(table(spark, sf_dir, "documents"), phone_in_text())
    users = rollup.total_and_distinct(table(spark, sf_dir, "events"), F.col("user_id"))
    return phones.select(F.lit("phones").alias("counted"), "*").unionByName(users.select(F.lit("users").alias("counted"), "*"))


@query("conditional_counts", """
    SELECT user_id, count(*) FILTER (WHERE event_type <> 'error') AS processed,
           count(*) FILTER (WHERE event_type = 'error') AS failed
    FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE event_type = 'error') >= 10
""")
def conditional_counts(spark, sf_dir):
    return rollup.conditional_counts(table(spark, sf_dir, "events"), "user_id", F.col("event_type") == "error", 10)


@query("null_profile", rf"""
    SELECT count(*) AS rows, count(*) - count(quality) AS missing_quality, count(*) - count(toxic) AS missing_toxic,
           count(*) - count({PHONE_SQL}) AS missing_phone
    FROM documents LEFT JOIN labels ON documents.doc_id = labels.doc_id
""")
def null_profile(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", phone_in_text().alias("phone"))
    joined = docs.join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return rollup.null_profile(joined, ["quality", "toxic", "phone"])


@query("progress_ratio", """
    SELECT count(*) FILTER (WHERE o_orderstatus = 'F') AS done, count(*) AS total,
           count(*) FILTER (WHERE o_orderstatus = 'F') / count(*) AS ratio FROM orders
""")
def progress_ratio(spark, sf_dir):
    return rollup.progress_ratio(table(spark, sf_dir, "orders"), F.col("o_orderstatus") == "F")


@query("ordered_export", """
    SELECT c_mktsegment, c_acctbal, c_custkey, c_name FROM customer ORDER BY c_mktsegment, c_acctbal DESC, c_custkey
""")
def ordered_export(spark, sf_dir):
    """Sorted output. The unique last key lets the range exchange cut inside a frequent first key."""
    customer = table(spark, sf_dir, "customer").select("c_mktsegment", "c_acctbal", "c_custkey", "c_name")
    return customer.orderBy("c_mktsegment", F.desc("c_acctbal"), "c_custkey")
